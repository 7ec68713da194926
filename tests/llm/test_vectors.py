"""Whitening and hard negatives against plain numpy."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from strata.llm import hard_negatives, whiten
from strata.llm.eigen import eigenpairs
from strata.llm.queries import op11_whiten_embeddings, op12_hard_negatives

SF = "/root/testdata/sf0.01"
NAN, INF = float("nan"), float("inf")


@pytest.mark.parametrize("n", [1, 2, 3, 7, 40])
@pytest.mark.parametrize("kind", ["full", "equal", "rank one", "nothing", "twice"])
def test_eigenpairs(n, kind):
    rng = np.random.default_rng(n)
    x = rng.standard_normal((3 * n, n)) * np.linspace(1, 2, n)
    a = {"full": x.T @ x, "equal": np.eye(n) * 3, "rank one": np.outer(x[0], x[0]), "nothing": np.zeros((n, n)), "twice": np.kron(np.eye(2), x.T @ x)}[kind]
    k = min(8, len(a))
    values, rows = eigenpairs(a, k)
    scale = max(np.abs(a).max(), 1e-300)
    assert np.abs(values - np.linalg.eigvalsh(a)[::-1][:k]).max() < 1e-12 * scale
    assert np.abs(rows @ rows.T - np.eye(k)).max() < 1e-12
    assert np.abs(a @ rows.T - rows.T * values).max() < 1e-12 * scale


def test_whitening_equals_numpy(spark):
    out = op11_whiten_embeddings(spark, SF).toPandas()
    src = [r for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect() if r.embedding is not None]
    x = np.floor(np.array([r.embedding for r in src], float) * 1024).astype(int) + 100_000
    centred = x - x.mean(0)
    cov = centred.T @ centred / len(x)
    values, vecs = np.linalg.eigh(cov)
    values, vecs = values[::-1][:8], vecs[:, ::-1][:, :8]
    want = centred @ vecs / np.sqrt(values)
    got = out.pivot(index="vec_id", columns="component", values="whitened").loc[[r.vec_id for r in src]].to_numpy()
    assert got.shape == want.shape
    assert np.abs(got * np.sign((got * want).sum(0)) - want).max() < 1e-8
    far = ((len(x) * x - x.sum(0)) ** 2).sum(1)
    assert dict(zip(out.vec_id, out.deviation, strict=True)) == {r.vec_id: int(d) for r, d in zip(src, far, strict=True)}
    assert np.allclose(out.groupby("component").explained.first(), values / np.trace(cov), rtol=1e-9)
    assert set(out.n) == {len(x)} and out.identity_error.max() < 1e-10


VEC = "vec_id long, embedding array<float>, whitened string, text string"


def test_whitening_odd_rows(spark):
    rows = [(1, [0.0, 1.0], "a", None), (2, [1.0, 0.5], "b", "x" * 100_000), (2, [1.0, 0.5], "b", ""), (None, [0.25, 0.125], "c", ""), (3, None, "d", ""), (4, [None, 1.0], "e", ""), (5, [NAN, 1.0], "f", ""), (6, [INF, 1.0], "g", ""), (7, [1.0], "h", ""), (8, [], "i", "")]
    df = spark.createDataFrame(rows, VEC)
    model = whiten.fit(df)
    out = whiten.whiten(df, model).collect()
    assert model.n == 4 and sorted(str(r.vec_id) for r in out) == ["1", "2", "2", "None"]
    assert out[0].asDict().keys() == {"vec_id", "embedding", "whitened", "text", "deviation"} and len(out[0].whitened) == 2
    again = np.array([r.whitened for r in out])
    assert np.abs(np.cov(again.T, bias=True) - np.eye(2)).max() < 1e-9
    # nothing varies: no component is sure, distances are exact
    flat = spark.createDataFrame([(1, [1.0, 2.0], "", "")] * 3, VEC)
    model = whiten.fit(flat)
    assert [(r.whitened, int(r.deviation)) for r in whiten.whiten(flat, model).collect()] == [([None, None], 0)] * 3
    assert model.identity_error is None and model.explained() == [None, None]
    # distances beyond 64 bits stay exact
    far = spark.createDataFrame([(1, [3e9], "", ""), (2, [-3e9], "", "")], VEC)
    model = whiten.fit(far)
    a, b = 1024 * 3_000_000_000 + 100_000, -1024 * 3_000_000_000 + 100_000
    assert {int(r.deviation) for r in whiten.whiten(far, model).collect()} == {(2 * a - a - b) ** 2}
    assert whiten.fit(df.limit(0)) is None and whiten.whiten(df, None).count() == 0
    with pytest.raises(ValueError, match="max_dims"):
        whiten.fit(df, params=whiten.Whiten(max_dims=1))


def _brute(rows, p=hard_negatives.Mine(), anchor=lambda v: v % 100 == 0):
    """All scores of every anchor, sorted in full."""
    rows = [r for r in rows if r[2] is not None and r[1] is not None and all(x is not None and np.isfinite(x) for x in r[1])]
    dims = max((len(r[1]) for r in rows), default=0)
    x = np.array([[*map(float, r[1]), *[0.0] * (dims - len(r[1]))] for r in rows]).reshape(len(rows), dims)
    x = np.floor(p.scale * x).astype(object)
    out, seen = [], set()
    for i, (key, vector, label) in enumerate(rows):
        if key is None or not anchor(key) or (key, tuple(vector), label) in seen:
            continue
        seen.add((key, tuple(vector), label))
        score = [int(sum(a * b for a, b in zip(x[i], y, strict=True))) for y in x]
        order = sorted(range(len(rows)), key=lambda j: (-score[j], rows[j][0] is None, rows[j][0] or 0))
        same = [j for j in order if rows[j][2] == label and rows[j] != rows[i]][: p.positives]
        for j in same:
            window = [k for k in order if rows[k][2] != label and p.low * score[j] <= 100 * score[k] <= p.high * score[j]][: p.negatives]
            out += [(key, rows[j][0], n + 1, rows[k][0], score[j], score[k]) for n, k in enumerate(window)]
    return sorted(out, key=str)


def _mined(df, p=None, every=100):
    return sorted((tuple(r) for r in hard_negatives.mine(df, F.col("vec_id") % every == 0, params=p).collect()), key=str)


def test_hard_negatives_query(spark):
    rows = [(r.vec_id, r.embedding, None if r.label is None else (r.label + 1) % 10 if r.vec_id % 7 == 0 else r.label) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    assert sorted((tuple(r) for r in op12_hard_negatives(spark, SF).collect()), key=str) == _brute(rows)


LABELLED = "vec_id long, embedding array<float>, label int"


def test_hard_negatives_blocks_ties_and_hot_vectors(spark):
    """Many small blocks and anchor blocks; a third of the rows share one
    vector, so whole blocks tie."""
    rng = np.random.default_rng(5)
    hot = [0.5, 0.25, -0.125, 0.5, 0.0, 0.25, 0.125, 0.5, 0.25]
    rows = [(i, hot if i % 3 == 0 else [float(np.float32(v)) for v in rng.normal(0.2, 0.3, 9)], int(i % 2 if i % 9 else 3)) for i in range(700)]
    p = hard_negatives.Mine(block_rows=32, blocks_a_task=3, anchors_a_block=4, columns_a_step=2)
    df = spark.createDataFrame(rows, LABELLED).repartition(5)
    assert _mined(df, p, 20) == _brute(rows, p, lambda v: v % 20 == 0)


def test_hard_negatives_odd_rows(spark):
    rows = [
        (0, [1.0, 0.5], 1), (0, [1.0, 0.5], 1), (100, [0.5, 1.0], 1), (100, [0.9, 1.0], 2), (1, [1.0], 1), (2, [1.0, 0.5, 0.25], 2),
        (3, [], 2), (4, None, 1), (5, [None, 1.0], 1), (6, [NAN, 1.0], 1), (7, [0.9, 0.4], None), (None, [0.9, 0.4], 2), (None, [0.9, 0.5], 1),
        (8, [0.8, 0.5], 2), (8, [0.8, 0.5], 2), (9, [-1.0, -1.0], 1), (200, [0.1, 0.1], 7),
    ]
    df = spark.createDataFrame(rows, LABELLED)
    assert _mined(df) == _brute(rows) != []
    assert _mined(df.withColumn("score", F.lit("x")).withColumn("mark", F.lit("y" * 100_000)).withColumn("a", F.lit(1))) == _brute(rows)
    assert _mined(df.limit(0)) == [] and _mined(df.where("vec_id = 200")) == []
    big = [(0, [2e9, 1e9], 1), (1, [2e9, 1e9], 1), (2, [1.9e9, 1e9], 2)]  # scores beyond 53 bits
    assert _mined(spark.createDataFrame([(k, [v / 1e6 for v in x], y) for k, x, y in big], LABELLED)) == _brute([(k, [float(np.float32(v / 1e6)) for v in x], y) for k, x, y in big])
