"""Whitening of embeddings by their leading principal components.

Entries become integers ``floor(scale * c) + offset``, so counts, sums and
every vector's squared distance from the mean are exact. Spark sums the
products of centred entries task by task into the covariance (divisor n);
the matrix, ``dims**2`` cells whatever the number of rows, is brought to
tridiagonal form on the driver, its leading eigenvalues are bisected by
Sturm counts and their vectors found by inverse iteration. The projection,
``components x dims`` doubles, is broadcast, and one more pass measures how
far the whitened vectors' covariance is from the identity.

Defined results: rows whose vector is null, or holds null or a value that is
not finite, are left out, and so are rows whose vector has another length
than most (ties: the longer one); vectors of more than ``max_dims`` entries
are an error; without rows the result is empty. A component whose eigenvalue
is zero up to rounding has null ``whitened`` values and is left out of the
identity error; ``explained`` is null where nothing varies. Repeated rows and
null keys count as rows of their own. Input columns named like an added one
are replaced; all other columns, long texts included, pass through.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm import vectors as V
from strata.llm.eigen import eigenpairs

ADDED = ("whitened", "deviation")


@dataclass(frozen=True)
class Whiten:
    components: int = 8
    scale: float = 1024.0
    offset: int = 100_000
    max_dims: int = 4096


@dataclass(frozen=True)
class Model:
    params: Whiten
    n: int
    sums: tuple[int, ...]
    values: np.ndarray  # falling
    rows: np.ndarray  # a unit eigenvector each
    trace: float
    identity_error: float | None = None

    @property
    def dims(self) -> int:
        return len(self.sums)

    def sure(self) -> np.ndarray:
        """Components whose eigenvalue is more than rounding."""
        return self.values > self.dims * np.finfo(float).eps * max(float(self.values[0]), 0.0)

    def explained(self) -> list[float | None]:
        return [float(v) / self.trace if self.trace > 0 else None for v in self.values]


def _integers(vectors: pa.Array, dims: int, p: Whiten) -> np.ndarray:
    return V.floors(p.scale * V.matrix(vectors, dims)) + p.offset


def _distances(x: np.ndarray, n: int, sums: tuple[int, ...]) -> np.ndarray:
    """``n * x - S`` exactly; Python integers where 64 bits are too few."""
    if n * int(np.abs(x).max(initial=0)) + max(map(abs, sums), default=0) < 1 << 62:
        return n * x - np.array(sums, np.int64)
    return n * x.astype(object) - np.array(sums, object)


def _squared(far: np.ndarray) -> list[int]:
    """Exact sum of squares of each row."""
    if far.dtype != object and float(np.abs(far).max(initial=0)) ** 2 * far.shape[1] < 2.0**62:
        return (far * far).sum(1).tolist()
    far = far.astype(object)
    return (far * far).sum(1).tolist()


def _source(df: DataFrame, vector: str, dims: int) -> DataFrame:
    return df.where(V.finite(vector) & (F.size(vector) == dims))


def _products(src: DataFrame, made) -> np.ndarray:
    """Sum over all rows of the outer product of ``made(vectors)`` with
    itself: one upper triangle a task, added up by Spark."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            y = made(batch.column(0))
            total = y.T @ y if total is None else total + y.T @ y
        if total is not None:
            i, j = np.triu_indices(len(total))
            yield pa.RecordBatch.from_arrays([pa.array(i.astype(np.int32)), pa.array(j.astype(np.int32)), pa.array(total[i, j])], names=["i", "j", "s"])

    cells = src.mapInArrow(run, "i int, j int, s double").groupBy("i", "j").agg(F.sum("s").alias("s")).toPandas()
    size = int(cells.j.max()) + 1
    out = np.zeros((size, size))
    out[cells.i, cells.j] = cells.s
    out[cells.j, cells.i] = cells.s
    return out


def fit(df: DataFrame, vector: str = "embedding", params: Whiten | None = None) -> Model | None:
    """The model of all vectors; None without one. The driver receives
    ``dims`` sums and ``dims**2 / 2`` products."""
    p = params or Whiten()
    most = df.where(V.finite(vector)).groupBy(F.size(vector).alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    if most is None or most.d == 0:
        return None
    dims = most.d
    if dims > p.max_dims:
        raise ValueError(f"vectors of {dims} entries; the covariance is bounded by max_dims={p.max_dims}")
    src = _source(df, vector, dims).select(F.col(vector).alias("v"))

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _integers(batch.column(0), dims, p)
            high = x >> 32  # two halves, so that no sum of them overflows
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(dims, dtype=np.int32)), pa.array(np.full(dims, len(x))), pa.array(high.sum(0)), pa.array((x - (high << 32)).sum(0))], names=["j", "n", "high", "low"])

    rows = src.mapInArrow(sums, "j int, n long, high long, low long").groupBy("j").agg(*[F.sum(c).alias(c) for c in ("n", "high", "low")]).orderBy("j").collect()
    n, total = rows[0].n, tuple((r.high << 32) + r.low for r in rows)

    def centred(vectors: pa.Array) -> np.ndarray:
        return _distances(_integers(vectors, dims, p), n, total).astype(np.float64) / n

    covariance = _products(src, centred) / n
    values, vecs = eigenpairs(covariance, min(p.components, dims))
    model = Model(p, n, total, values, vecs, float(np.trace(covariance)))
    sure = model.sure()
    if not sure.any():
        return model
    # n * x - S adds up to zero exactly, so the projected rows are centred too
    project = (vecs[sure] / np.sqrt(values[sure])[:, None]).T
    again = _products(src, lambda vectors: centred(vectors) @ project) / n
    return Model(p, n, total, values, vecs, model.trace, float(np.abs(again - np.eye(len(again))).max()))


def whiten(df: DataFrame, model: Model | None, vector: str = "embedding") -> DataFrame:
    """The rows of the model's kind with ``whitened`` (one double a
    component) and ``deviation`` (sum over the dimensions of
    ``(n * x - S)**2``, exact; null beyond 38 digits)."""
    others = [c for c in df.columns if c not in ADDED]
    src = (_source(df, vector, model.dims) if model else df.where(F.lit(False))).select(*others, F.col(vector).alias("__vector"))
    types = [f"`{f.name}` {f.dataType.simpleString()}" for f in src.schema.fields[:-1]]
    sent = df.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = sent.value
        sure = m.sure()
        project = np.where(sure[:, None], m.rows / np.sqrt(np.where(sure, m.values, 1.0))[:, None], np.nan).T
        for batch in batches:
            far = _distances(_integers(batch.column(len(others)), m.dims, m.params), m.n, m.sums)
            out = far.astype(np.float64) / m.n @ project
            lists = V.lists(out)
            if not sure.all():
                lists = pa.ListArray.from_arrays(lists.offsets, pa.array(out.reshape(-1), from_pandas=True))
            squares = pa.array([s if s < 10**38 else None for s in _squared(far)], pa.decimal128(38, 0))
            yield pa.RecordBatch.from_arrays([*[batch.column(i) for i in range(len(others))], lists, squares], names=[*others, *ADDED])

    return src.mapInArrow(run, ", ".join([*types, "whitened array<double>, deviation decimal(38,0)"]))
