"""Mixing: exponent, budgets, blocks; the query's SQL with a hot source."""

import hashlib
import math
from collections import Counter, defaultdict

import duckdb
import pytest
from pyspark.sql import functions as F

from strata.llm import mix_sources as M
from strata.llm.oracle import ORACLE
from strata.llm.queries import op4_mix_sources


def _docs(spark, counts, words=10):
    rows, k = [], 0
    for source, n in counts.items():
        for _ in range(n):
            rows.append((k, " ".join(["w"] * (1 + k % words)), source))
            k += 1
    return spark.createDataFrame(rows, "doc_id long, text string, source string")


def _tokens(df):
    out = Counter()
    for r in df.collect():
        out[r.source] += len((r.text or "").split())
    return out


def _entropy(p):
    return -sum(x * math.log(x) for x in p if x)


def test_target_entropy_is_met(spark):
    df = _docs(spark, {"a": 2000, "b": 300, "c": 100, None: 50})
    t = _tokens(df)
    p = {s: n / sum(t.values()) for s, n in t.items()}
    mix = M.Mix(entropy=0.8, max_repeats=100, block_tokens=2000)
    got = Counter()
    for r in M.plan(df, mix).collect():
        got[r.source] += r.tokens
    lo, hi = 0.0, 1.0
    for _ in range(100):
        a = (lo + hi) / 2
        z = sum(x**a for x in p.values())
        lo, hi = (a, hi) if _entropy([x**a / z for x in p.values()]) >= 0.8 * math.log(4) else (lo, a)
    z = sum(x**lo for x in p.values())
    for s, x in p.items():
        want = x**lo / z * sum(t.values())
        assert want - 10 < got[s] <= want + 1


def test_repeat_limit(spark):
    df = _docs(spark, {"big": 3000, "tiny": 10})
    rows = M.plan(df, M.Mix(entropy=1.0, max_repeats=3.0)).collect()
    times = Counter((r.source, r.doc) for r in rows)
    assert max(times.values()) == 3
    assert max(r.epoch for r in rows) == 2


def test_blocks_keep_the_weights_and_passes_are_whole(spark):
    df = _docs(spark, {"a": 4000, "b": 800, "c": 500})
    mix = M.Mix(entropy=0.9, block_tokens=3000, bucket_rows=100)
    rows = M.plan(df, mix).collect()
    t = _tokens(df)
    budget = sum(t.values())
    per, total = defaultdict(Counter), Counter()
    for r in rows:
        per[r.block][r.source] += r.tokens
        total[r.source] += r.tokens
    assert sum(total.values()) <= budget
    blocks = -(-budget // 3000)
    assert max(per) < blocks
    for b in per.values():
        for s in t:
            assert abs(b[s] - total[s] / blocks) <= 30  # documents are not cut
    seen = defaultdict(set)
    for r in rows:
        assert r.slot == hashlib.md5(f"{mix.seed}:{r.epoch}:{r.doc}:{r.mark}".encode()).hexdigest()
        assert r.doc not in seen[r.source, r.epoch]
        seen[r.source, r.epoch].add(r.doc)
    marks = {r.doc: r.mark for r in rows} | {r.doc_id: hashlib.md5(r.text.encode()).hexdigest() for r in df.collect()}
    everything = {s: {r.doc_id for r in df.collect() if r.source == s} for s in t}
    for (s, e), docs in seen.items():
        if (s, e + 1) in seen:
            assert docs == everything[s]
        else:  # the cut pass holds the first documents of its permutation
            order = sorted(everything[s], key=lambda d: hashlib.md5(f"{mix.seed}:{e}:{d}:{marks[d]}".encode()).hexdigest())
            assert docs == set(order[: len(docs)])
    # levels of the prefix sum do not matter
    flat = M.plan(df, M.Mix(entropy=0.9, block_tokens=3000, bucket_rows=10**6)).collect()
    assert sorted(map(tuple, flat)) == sorted(map(tuple, rows))


def test_odd_rows(spark):
    rows = [(1, None, "a", 0), (2, "", "a", 0), (3, "x y z", "a", 0), (3, "x y z", "a", 0), (None, "u v", "a", 0), (4, None, "empty", 0), (5, "w", None, 0)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, epoch int")
    plan = M.plan(df, M.Mix(entropy=0.0)).collect()
    assert all(r.epoch == 0 for r in plan)
    assert {(r.source, r.doc, r.tokens) for r in plan} == {("a", 1, 0), ("a", 2, 0), ("a", 3, 6), ("a", None, 2), (None, 5, 1)}
    out = M.mixed(df, M.Mix(entropy=0.0))
    assert out.columns == ["doc_id", "text", "source", "epoch", "block", "slot"]
    assert out.count() == 6
    none = df.limit(0)
    assert M.plan(none).count() == 0 and M.mixed(none).count() == 0
    assert M.plan(df.where("source = 'empty'")).count() == 0


@pytest.mark.parametrize("key", [None, 4])
def test_one_key_holds_half_of_a_source(spark, key):
    """1,000 rows of different texts under one id, or none: each goes by
    itself, so the budget is dealt out to the last document that fits."""
    rows = [(i if i < 1000 else key, f"text {i} of a big source", "big") for i in range(2000)] + [(5000 + i, f"small text {i} here", "small") for i in range(200)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(5)
    out = M.mixed(df, M.Mix(entropy=0.5, block_tokens=1000)).collect()
    got = Counter(r.source for r in out)
    quota = {r.source: r.quota for r in M.quotas(df.select("source", M.words(F.col("text")).alias("tokens")), M.Mix(entropy=0.5, block_tokens=1000))[0].collect()}
    assert quota["big"] - 6 < 6 * got["big"] <= quota["big"] and quota["small"] - 4 < 4 * got["small"] <= quota["small"]
    hot = [r for r in out if r.doc_id == key and r.source == "big"]
    assert len({r.text for r in hot}) == len({r.slot for r in hot}) > 800
    assert len({r.block for r in hot}) > 5


def test_query_equals_sql_with_a_hot_source(spark, tmp_path):
    counts = {f"s{i}": 40 + 7 * i for i in range(12)} | {"hot": 1500, None: 30}
    _docs(spark, counts, words=60).coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    got = op4_mix_sources(spark, str(tmp_path)).collect()
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{tmp_path}/documents.parquet/*.parquet')")
    want = con.execute(f"SELECT doc_id, source, epoch, block, tokens, slot FROM ({ORACLE['op4_mix_sources']})").fetchall()
    assert max(r.epoch for r in got) >= 1
    key = lambda r: tuple((x is None, x) for x in r)
    assert sorted(map(tuple, got), key=key) == sorted(want, key=key)
