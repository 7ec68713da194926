"""Toxicity by FTRL-proximal logistic regression over hashed word features.

Features are presence bits of words, word pairs and skip pairs (one word
left out), hashed to ``2**bits`` coordinates. FTRL-proximal keeps a rate a
coordinate, and its L1 term leaves most weights exactly zero, so the model
is a short list of (coordinate, weight) that is broadcast for scoring; its
size is bounded by ``2**bits``.

The classifier is fitted on a bounded sample of labelled rows: of each class
the ``max_train_rows`` texts with the least hash of key and text, so a key
with very many rows is thinned out like all others, and copies count once.
Scoring reads every whole text of the table row by row, without a shuffle.

Defined results: a null or empty text, however long the others are, scores
by the bias alone; null labels are not trained on; rows are learnt in the
order of their hash, so ties and repeated rows do not depend on partitioning;
a null key meets no label; with no labelled rows every score is 0.5; an empty
table gives an empty result; columns other than the key, the text and the
label, whatever their names, are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm import common as C


@dataclass(frozen=True)
class Ftrl:
    alpha: float = 0.5
    beta: float = 1.0
    l1: float = 6.0
    l2: float = 0.5
    epochs: int = 3
    bits: int = 18
    #: Labelled rows of each class that the fit uses at most.
    max_train_rows: int = 6000


@dataclass(frozen=True)
class Model:
    coordinates: np.ndarray
    weights: np.ndarray
    bias: float
    bits: int

    def dense(self) -> np.ndarray:
        w = np.zeros(1 << self.bits, np.float32)
        w[self.coordinates] = self.weights
        return w


def _features(text: pa.Array, bits: int) -> Iterator[np.ndarray]:
    """Sorted distinct coordinates of each text."""
    raw, off = C.utf8(text)
    h, first = C.hash_words(raw, off, C.PLAIN_WORDS)
    shift = C.U(64 - bits)
    for i in range(len(off) - 1):
        w = h[first[i] : first[i + 1]]
        grams = [w]
        if len(w) > 1:
            grams.append(C.ngrams(w, 2))
        if len(w) > 2:
            grams.append(C.mix(C.mix(w[:-2]) ^ w[2:]))
        yield np.unique(np.concatenate([C.mix(g) >> shift for g in grams]).astype(np.int32))


def featurise(docs: DataFrame, text: str, keep: tuple[str, ...], bits: int) -> DataFrame:
    src = docs.select(*keep, F.col(text).alias("__text"))
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in src.schema.fields[:-1]] + ["x array<int>"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in C.slices(batch, "__text"):
                x = pa.array(list(_features(part.column(len(keep)), bits)), pa.list_(pa.int32()))
                yield pa.RecordBatch.from_arrays([*[part.column(i) for i in range(len(keep))], x], names=[*keep, "x"])

    return src.mapInArrow(run, schema)


def _train(rows: list[np.ndarray], labels: np.ndarray, order: list[np.ndarray], p: Ftrl) -> tuple[np.ndarray, float]:
    size = 1 << p.bits
    z, n = np.zeros(size + 1), np.zeros(size + 1)  # the last one is the bias, without L1
    l1 = np.full(size + 1, p.l1)
    l1[size] = 0

    def weights(i: np.ndarray) -> np.ndarray:
        zi = z[i]
        w = -(zi - np.sign(zi) * l1[i]) / ((p.beta + np.sqrt(n[i])) / p.alpha + p.l2)
        w[np.abs(zi) <= l1[i]] = 0
        return w

    for at in order:
        for k in at:
            i = np.append(rows[k], size)
            w = weights(i)
            g = 1 / (1 + np.exp(-np.clip(w.sum(), -30, 30))) - labels[k]
            z[i] += g - (np.sqrt(n[i] + g * g) - np.sqrt(n[i])) / p.alpha * w
            n[i] += g * g
    all_w = weights(np.arange(size + 1))
    return all_w[:size], float(all_w[size])


def fit(docs: DataFrame, labels: DataFrame | None = None, label: str = "toxic", text: str = "text", key: str = "doc_id", params: Ftrl | None = None) -> Model:
    """Learns from ``docs`` with the 0/1 labels of ``labels`` (None: ``docs``
    has them). The sample is drawn by hashes alone; at most
    ``2 * max_train_rows`` of them are sent to the documents, which stay
    where they are. Spark featurises the sample and one task learns it; only
    non-zero weights come back."""
    p = params or Ftrl()
    rows = docs.select(F.col(key).alias("k"), F.col(text).alias("t"), *([F.col(label).alias("y")] if labels is None else []))
    marked = lambda df: df.where(F.col("y").isin(0, 1)).withColumn("y", F.col("y").cast("int"))
    hashed = F.xxhash64(F.lit("ftrl"), F.col("k").cast("string"), F.col("t"))
    named = rows.withColumn("o", hashed)
    if labels is None:
        narrow = marked(named).select("y", "o")
    else:  # one row a key and label
        one = marked(labels.select(F.col(key).alias("k"), F.col(label).alias("y"))).distinct()
        narrow = named.select("k", "o").join(one, "k").select("y", "o")
    few, counts = C.drawn(narrow, "y", "o", p.max_train_rows)
    few = F.broadcast(few)  # bounded: max_train_rows a class
    share = {y: min(1.0, p.max_train_rows / n) for y, n in counts.items()}
    met = named.select("o", "t").join(few, "o") if labels is not None else marked(named).join(few, ["y", "o"])
    sample = featurise(met.select("y", "o", "t"), "t", ("y", "o"), p.bits).dropDuplicates(["y", "o"])

    def learn(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["o", "y"], kind="stable").reset_index(drop=True)
        rng = np.random.default_rng(1)
        order = [rng.permutation(len(group)) for _ in range(p.epochs)]
        w, bias = _train([np.asarray(x, np.int64) for x in group.x], group.y.to_numpy(), order, p)
        at = np.flatnonzero(w)
        return pd.DataFrame({"c": np.append(at, -1), "w": np.append(w[at], bias)})

    # one task by design: the sample is bounded by 2 * max_train_rows rows
    rows = sample.withColumn("all", F.lit(0)).groupBy("all").applyInPandas(learn, "c long, w double").toPandas()
    if rows.empty:
        return Model(np.zeros(0, np.int64), np.zeros(0, np.float32), 0.0, p.bits)
    bias = float(rows.w[rows.c < 0].iloc[0])
    if len(share) == 2:  # the classes were thinned out differently: put the prior back
        bias += float(np.log(share[0] / share[1]))
    rows = rows[rows.c >= 0].sort_values("c")
    return Model(rows.c.to_numpy(), rows.w.to_numpy(np.float32), bias, p.bits)


def score(docs: DataFrame, model: Model, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` columns and ``score``: the model's probability of label 1."""
    src = docs.select(*keep, F.col(text).alias("__text"))
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in src.schema.fields[:-1]] + ["score double"])
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w, bias = sent.value.dense(), sent.value.bias
        for batch in batches:
            for part in C.slices(batch, "__text"):
                s = np.array([bias + float(w[x].sum(dtype=np.float64)) for x in _features(part.column(len(keep)), sent.value.bits)])
                p = 1 / (1 + np.exp(-np.clip(s, -30, 30)))
                yield pa.RecordBatch.from_arrays([*[part.column(i) for i in range(len(keep))], pa.array(p, pa.float64())], names=[*keep, "score"])

    return src.mapInArrow(run, schema)
