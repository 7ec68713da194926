"""Hard-negative mining by vertical scans (BOND) over blocks of columns.

Rows are cut into blocks that hold one column a dimension, with its least
and greatest entry. Anchors are dealt into blocks too; every (row block,
anchor block) pair meets once, by an equi-join on the anchor block and a
salt, so no anchor set is broadcast unchecked and no group gathers in one
task. An anchor reads a block's columns in falling order of its own entries'
size. After every few columns, the partial scores and what the unread
columns can still add at most and at least bound every candidate's score;
those that can reach no wanted place leave the bitmap. What is left has its
exact integer score.

Two scans: the first finds each anchor's best rows of its own label (its
positives), the second, for each positive, the best rows of other labels
whose score lies in a window below the positive's.

Defined results: rows with a null label or vector, or an entry that is null
or not finite, take no part; shorter vectors count as padded with zeros,
an empty one scores 0; equal scores go by the smaller key, null keys last;
anchors equal in key, label and vector are mined once and such rows are never
their own positives; other repeated rows count as often as they occur; scores
beyond 64 bits stop there. An anchor without a positive, or a window without
a row, gives no row; an empty table an empty result. Keys are whole numbers;
labels are compared by 64-bit hashes; other columns, whatever their names or
the length of their texts, are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.llm import vectors as V
from strata.llm.common import staged

#: Bytes of a row block's columns, as 64-bit numbers.
BLOCK_BYTES = 8 << 20


@dataclass(frozen=True)
class Mine:
    scale: float = 256.0
    positives: int = 5
    negatives: int = 5
    low: int = 80  # percent of the positive's score
    high: int = 100
    block_rows: int = 1024
    blocks_a_task: int = 8
    anchors_a_block: int = 2048
    columns_a_step: int = 8


class Block:
    """Up to ``block_rows`` rows by column, in the order of their keys."""

    SCHEMA = "n int, ids binary, none binary, labels binary, marks binary, least binary, greatest binary, kind string, columns array<binary>"

    def __init__(self, row: dict):
        self.n = row["n"]
        self.ids, self.labels, self.marks = (np.frombuffer(row[c], np.int64) for c in ("ids", "labels", "marks"))
        self.none = np.frombuffer(row["none"], bool)
        self.least, self.greatest = np.frombuffer(row["least"], np.int64), np.frombuffer(row["greatest"], np.int64)
        self.x = np.array([np.frombuffer(c, row["kind"]) for c in row["columns"]]).reshape(len(row["columns"]), self.n)

    @staticmethod
    def pack(batch: pa.RecordBatch, p: Mine) -> Iterator[tuple]:
        lengths = batch.column(3).value_lengths().to_numpy(zero_copy_only=False)
        dims = int(lengths.max(initial=0))
        step = max(1, min(p.block_rows, BLOCK_BYTES // (8 * max(dims, 1))))
        for a in range(0, len(batch), step):
            part = batch.slice(a, step)
            ids, none = part.column(0).fill_null(0).to_numpy(), part.column(0).is_null().to_numpy(zero_copy_only=False)
            order = np.lexsort((ids, none))
            x = V.floors(p.scale * V.matrix(part.column(3), dims))[order].T
            most = int(np.abs(x).max(initial=0))
            kind = "<i2" if most < 1 << 15 else "<i4" if most < 1 << 31 else "<i8"
            least, greatest = x.min(1, initial=1 << 62), x.max(1, initial=-(1 << 62))
            yield (len(part), ids[order].tobytes(), none[order].tobytes(), *[part.column(c).to_numpy()[order].tobytes() for c in (1, 2)], least.tobytes(), greatest.tobytes(), kind, [c.tobytes() for c in np.ascontiguousarray(x.astype(kind))])


class Anchors:
    """A block of anchors: keys, labels, marks, vectors and, for the second
    scan, the scores of their positives."""

    SCHEMA = "n int, ids binary, labels binary, marks binary, dims int, x binary, wanted array<array<long>>"

    def __init__(self, row: dict):
        self.n = row["n"]
        self.ids, self.labels, self.marks = (np.frombuffer(row[c], np.int64) for c in ("ids", "labels", "marks"))
        self.x = np.frombuffer(row["x"], np.int64).reshape(self.n, row["dims"])
        self.wanted = row["wanted"]

    @staticmethod
    def pack(table: pa.Table, p: Mine) -> tuple:
        lengths = table.column("x").combine_chunks().value_lengths().to_numpy(zero_copy_only=False)
        dims = int(lengths.max(initial=0))
        x = V.floors(p.scale * V.matrix(table.column("x"), dims))
        return (len(table), *[table.column(c).to_numpy().tobytes() for c in ("id", "label", "mark")], dims, x.tobytes(), table.column("wanted").to_pylist())


def _as_batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(list(c), t.type) for c, t in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)


BLOCK_ARROW = pa.schema([("n", pa.int32()), *[(c, pa.binary()) for c in ("ids", "none", "labels", "marks", "least", "greatest")], ("kind", pa.string()), ("columns", pa.list_(pa.binary()))])
ANCHOR_ARROW = pa.schema([("a", pa.int64()), ("n", pa.int32()), *[(c, pa.binary()) for c in ("ids", "labels", "marks")], ("dims", pa.int32()), ("x", pa.binary()), ("wanted", pa.list_(pa.list_(pa.int64())))])


def _scores(q: np.ndarray, block: Block, alive: np.ndarray, x: np.ndarray, step: int, keep) -> tuple[np.ndarray, np.ndarray]:
    """The candidates of ``alive`` that ``keep(upper, lower)`` never let go,
    and their exact scores."""
    dims = len(q)
    order = np.argsort(-np.abs(q), kind="stable")
    ends = np.stack([q * block.least[:dims].astype(q.dtype), q * block.greatest[:dims].astype(q.dtype)])[:, order]
    nil = np.zeros(1, q.dtype)
    most = np.append(np.cumsum(ends.max(0)[::-1])[::-1], nil)
    least = np.append(np.cumsum(ends.min(0)[::-1])[::-1], nil)
    score = np.zeros(len(alive), q.dtype)
    for k in range(0, dims, step):
        at = order[k : k + step]
        score = score + (q[at] @ x[np.ix_(at, alive)] if 2 * len(alive) < block.n else (q[at] @ x[at])[alive])
        end = min(k + step, dims)
        live = keep(score + most[end], score + least[end])
        alive, score = alive[live], score[live]
        if not len(alive):
            break
    return alive, score


class _Best:
    """The best ``k`` rows so far: (-score, null key, key), falling."""

    __slots__ = ("k", "rows")

    def __init__(self, k: int):
        self.k, self.rows = k, []

    def least(self):
        return -self.rows[-1][0] if len(self.rows) == self.k else None

    def add(self, block: Block, at: np.ndarray, score: np.ndarray) -> None:
        at = at[order := np.argsort(-score, kind="stable")[: self.k]]  # rows stand in the order of their keys
        new = [(-int(s), bool(block.none[i]), int(block.ids[i])) for i, s in zip(at, score[order], strict=True)]
        self.rows = sorted(self.rows + new)[: self.k]


def _positives(anchors: Anchors, i: int, q, block: Block, x, held: list, p: Mine) -> None:
    best = held[0]
    alive = np.flatnonzero((block.labels == anchors.labels[i]) & (block.marks != anchors.marks[i]))
    known = best.least()

    def keep(upper: np.ndarray, lower: np.ndarray) -> np.ndarray:
        bar = known
        if len(lower) > p.positives:
            here = np.partition(lower, len(lower) - p.positives)[len(lower) - p.positives]
            bar = here if bar is None else max(bar, here)
        return np.ones(len(upper), bool) if bar is None else upper >= bar

    if len(alive):
        best.add(block, *_scores(q, block, alive, x, p.columns_a_step, keep))


def _negatives(anchors: Anchors, i: int, q, block: Block, x, held: list, p: Mine) -> None:
    alive = np.flatnonzero(block.labels != anchors.labels[i])
    windows = []
    for best, score in zip(held, anchors.wanted[i], strict=True):
        low, high = -((-p.low * score) // 100), (p.high * score) // 100
        known = best.least()
        windows.append((low if known is None else max(low, known), high))

    def keep(upper: np.ndarray, lower: np.ndarray) -> np.ndarray:
        live = np.zeros(len(upper), bool)
        for low, high in windows:
            if low <= high:
                live |= (upper >= low) & (lower <= high)
        return live

    if len(alive) and any(low <= high for low, high in windows):
        at, score = _scores(q, block, alive, x, p.columns_a_step, keep)
        for best, (low, high) in zip(held, windows, strict=True):
            inside = (score >= low) & (score <= high)
            if inside.any():
                best.add(block, at[inside], score[inside])


OUT = "mark long, id long, slot int, score long, other long"
OUT_ARROW = pa.schema([("mark", pa.int64()), ("id", pa.int64()), ("slot", pa.int32()), ("score", pa.int64()), ("other", pa.int64())])


def _scan(blocks: DataFrame, anchors: DataFrame, n_anchors: int, visit, keep: int, p: Mine) -> DataFrame:
    """(anchor's mark and key, slot, score, key of the row found) of the best
    ``keep`` rows of every task, by ``visit``; ``n_anchors``: anchor blocks."""
    salts = max(1, -(-blocks.count() // p.blocks_a_task))
    tasks = max(1, min(n_anchors * salts, 100_000))
    left = blocks.withColumns({"salt": F.pmod(F.xxhash64("ids", "marks"), F.lit(salts)).cast("int"), "a": F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n_anchors - 1).cast("long")))})
    left = left.withColumnRenamed("n", "rows").withColumn("block", F.struct(*[F.col("rows" if c == "n" else c).alias(c) for c in BLOCK_ARROW.names])).select("a", "salt", "block")
    right = anchors.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    right = right.select("a", "salt", F.struct(*ANCHOR_ARROW.names[1:]).alias("anchors"))
    pairs = left.repartition(tasks, "a", "salt").join(right, ["a", "salt"]).select("a", "block", "anchors")

    def rows(anchors: Anchors, best: list[list[_Best]]) -> pa.RecordBatch:
        top = (1 << 63) - 1
        found = [(int(anchors.marks[i]), int(anchors.ids[i]), slot, max(-top, min(top, -s)), None if none else key) for i, held in enumerate(best) for slot, b in enumerate(held) for s, none, key in b.rows]
        return _as_batch(found, OUT_ARROW) if found else pa.RecordBatch.from_pylist([], OUT_ARROW)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state: dict[int, tuple[Anchors, list]] = {}  # of the few anchor blocks of this task
        for batch in batches:
            for k in range(len(batch)):
                a = batch.column(0)[k].as_py()
                if a not in state:
                    if len(state) == 4:
                        yield rows(*state.pop(next(iter(state))))
                    held = Anchors(batch.column(2)[k].as_py())
                    state[a] = held, [[_Best(keep) for _ in w] for w in held.wanted]
                here, best = state[a]
                block = Block(batch.column(1)[k].as_py())
                dims = min(here.x.shape[1], len(block.x))
                far = [int(v) for v in np.maximum(np.abs(block.least[:dims]), np.abs(block.greatest[:dims]))]
                reach = sum(u * v for u, v in zip([int(v) for v in np.abs(here.x[:, :dims]).max(0, initial=0)], far, strict=True))
                kind = np.float64 if reach < 1 << 52 else object  # whole numbers, exact either way
                q, x = here.x[:, :dims].astype(kind), block.x[:dims].astype(kind)
                for i in range(here.n):
                    visit(here, i, q[i], block, x, best[i], p)
        for here, best in state.values():
            yield rows(here, best)

    return pairs.mapInArrow(run, OUT)


def _first(found: DataFrame, by: list[str], k: int) -> DataFrame:
    """The best ``k`` of every group; Spark cuts each task's rows to ``k`` a
    group before they are shuffled."""
    order = Window.partitionBy(*by).orderBy(F.desc("score"), F.col("other").asc_nulls_last())
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def mine(rows: DataFrame, is_anchor: Column, key: str = "vec_id", vector: str = "embedding", label: str = "label", params: Mine | None = None) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score,
    negative_score) for the rows where ``is_anchor`` holds, against all."""
    p = params or Mine()
    src = rows.where(F.col(label).isNotNull() & V.finite(vector))
    src = src.select(F.col(key).cast("long").alias("id"), F.xxhash64(F.col(label)).alias("label"), F.xxhash64(F.col(key), F.col(label), F.col(vector)).alias("mark"), F.col(vector).alias("x"), F.coalesce(is_anchor, F.lit(False)).alias("anchor"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if packed := list(Block.pack(batch, p)):
                yield _as_batch(packed, BLOCK_ARROW)

    blocks = staged(src.drop("anchor").mapInArrow(cut, Block.SCHEMA), "bond-rows")
    anchors = staged(src.where("anchor").drop("anchor").dropDuplicates(["mark"]), "bond-anchors")
    parts = max(1, -(-anchors.count() // p.anchors_a_block))

    def dealt(df: DataFrame) -> DataFrame:
        """Anchor blocks: marks are distinct, so each gets about as many."""

        def pack(table: pa.Table) -> pa.Table:
            a = table.column("a")[0].as_py()
            return pa.Table.from_batches([_as_batch([(a, *Anchors.pack(table, p))], ANCHOR_ARROW)])

        return staged(df.withColumn("a", F.pmod(F.xxhash64(F.lit("deal"), "mark"), F.lit(parts))).groupBy("a").applyInArrow(pack, f"a long, {Anchors.SCHEMA}"), "bond-anchor-blocks")

    found = _scan(blocks, dealt(anchors.withColumn("wanted", F.array(F.lit(0).cast("long")))), parts, _positives, p.positives, p)
    first = staged(_first(found, ["mark"], p.positives).select("mark", "rank", F.col("score").alias("positive_score"), F.col("other").alias("positive_id")), "bond-positives")
    wanted = first.groupBy("mark").agg(F.transform(F.array_sort(F.collect_list(F.struct("rank", "positive_score"))), lambda s: s["positive_score"]).alias("wanted"))
    found = _scan(blocks, dealt(anchors.join(wanted, "mark")), parts, _negatives, p.negatives, p)
    best = _first(found, ["mark", "slot"], p.negatives)
    out = best.join(first.withColumn("slot", F.col("rank") - 1).drop("rank"), ["mark", "slot"])
    return out.select(F.col("id").alias("anchor_id"), "positive_id", F.col("rank").cast("int"), F.col("other").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))
