"""The pipeline's stages, one after the other, and odd inputs."""

import re

import duckdb
import pytest
from pyspark.sql import functions as F
from test_ngram_join import brute  # noqa: E402
from test_text_rules import _brute_spans as base_spans

import __spark_entry__ as E
import corpus_pipeline as P
from strata.llm import pii_anchors
from strata.llm.oracle import ORACLE
from strata.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = [docs.collect()]
    for _, stage in P.STAGES:
        df = stage(spark, docs, SF)
        docs = spark.createDataFrame(df.collect(), df.schema)
        out.append(docs.collect())
    return out


def test_names_and_columns(stages):
    assert len(P.STAGES) == 5
    for rows in stages[:5]:
        assert list(rows[0].asDict()) == COLUMNS
    assert list(stages[5][0].asDict()) == [*COLUMNS, "epoch", "block", "slot"]


def test_language_keeps_clean_documents(stages):
    before, after = {r.doc_id for r in stages[0]}, {r.doc_id for r in stages[1]}
    assert after <= before and len(after) > 0.98 * len(before)
    assert all(any(c.isalpha() for c in r.text) for r in stages[1])


def test_one_document_of_each_group(stages):
    rows = [(r.doc_id, r.text) for r in stages[1]]
    assert {r.doc_id for r in stages[2]} == {c if n else k for k, n, c in brute(rows, 80, 100, 5)}


def test_passages_go(stages):
    gone = {r.doc_id for r in stages[2]} - {r.doc_id for r in stages[3]}
    items = duckdb.sql(f"SELECT text FROM '{SF}/benchmark.parquet'").fetchall()
    plain = lambda t: " ".join("".join(c if c.isalnum() else " " for c in t.lower()).split())
    holds = {r.doc_id for r in stages[2] if any(plain(i) in plain(r.text) for (i,) in items)}
    assert holds and holds <= gone and len(gone) < 2 * len(holds) + 5


def test_personal_data_is_replaced(stages):
    """Held against patterns alone: nothing they find is left, and where only
    they find something (no scheme, cue word or account), the text is the old
    one with placeholders in those places."""
    after = {r.doc_id: r for r in stages[4]}
    assert {r.doc_id for r in stages[3]} == set(after)
    replaced = 0
    for r in stages[3]:
        now = after[r.doc_id]
        assert not base_spans(now.text) and now.n_chars == len(now.text)
        spans = base_spans(r.text)
        apart = all(a[2] <= b[0] for a, b in zip(spans, spans[1:], strict=False))
        other = "://" in r.text or any(c in r.text.lower() for c in pii_anchors.CUES) or re.search(r"[A-Za-z]{2}\d{2}", r.text)
        if apart and not other:
            want, at = "", 0
            for start, kind, end in spans:
                want, at = want + r.text[at:start] + f"[{pii_anchors.BASE[kind].upper()}]", end
            assert now.text == want + r.text[at:]
            replaced += bool(spans)
    assert replaced > 20


def test_mix_equals_its_sql(stages):
    """The stage's rows are the placements that the mixing query's SQL gives
    for the documents before it."""
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, source VARCHAR, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?, ?)", [(r.doc_id, r.source, r.text) for r in stages[4]])
    want = con.execute(f"SELECT doc_id, epoch, block, slot FROM ({ORACLE['op4_mix_sources']})").fetchall()
    assert sorted(map(str, want)) == sorted(str((r.doc_id, r.epoch, r.block, r.slot)) for r in stages[5])
    kept = {r.doc_id: r for r in stages[4]}
    assert all(tuple(r)[:5] == tuple(kept[r.doc_id])[:5] for r in stages[5])


def test_run_equals_its_stages(spark, stages):
    got = E.queries()["pipeline"](spark, SF).collect()
    assert sorted(map(tuple, got), key=str) == sorted(map(tuple, stages[5]), key=str)


def test_odd_inputs(spark):
    schema = "doc_id long, text string, lang string, source string, n_chars long, epoch string, __text string, hits int"
    rows = [
        (1, None, "en", "a", 0, "e", "t", 1),
        (2, "", None, None, None, None, None, None),
        (3, "the cat sat on the mat and the dog ran to a@b.cd now", "en", "a", 5, "e", None, 1),
        (3, "the cat sat on the mat and the dog ran to a@b.cd now", "en", "a", 5, "e", None, 1),
        (None, "le chat et le chien dans la maison avec une souris", "fr", None, None, "e", "t", None),
        (4, "word " * 60_000, "en", "b", 9, "e", "t", 1),
    ]
    docs = spark.createDataFrame(rows, schema)
    for _, stage in P.STAGES[:4]:
        before, docs = docs, stage(spark, docs, "/root/testdata/sf0.001")
        assert docs.columns == before.columns
        docs = spark.createDataFrame(docs.collect(), docs.schema)
    assert sorted((r.doc_id or 0, r.text[:20]) for r in docs.collect()) == [(0, "le chat et le chien "), (3, "the cat sat on the m"), (4, "word word word word ")]
    mixed = P.mix(spark, docs, "/root/testdata/sf0.001")
    assert {"epoch", "block", "slot"} <= set(mixed.columns) and mixed.columns.count("epoch") == 1
    empty = spark.createDataFrame([], schema)
    for _, stage in P.STAGES:
        assert stage(spark, empty, "/root/testdata/sf0.001").count() == 0


def test_registered():
    q, o = E.queries(), E.oracle_sql()
    assert set(QUERIES) | {"pipeline"} <= set(q)
    assert set(ORACLE) <= set(o)
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES if n.startswith("op")) == list(range(1, 14))


@pytest.mark.parametrize("name", sorted(set(ORACLE)))
def test_sql_agrees(spark, name):
    con = duckdb.connect()
    for t in ("documents", "conversations", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('/root/testdata/sf0.001/{t}.parquet')")
    got = QUERIES[name](spark, "/root/testdata/sf0.001")
    want = con.execute(f"SELECT {', '.join(got.columns)} FROM ({ORACLE[name]})").fetchall()
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, want))
    assert F is not None
