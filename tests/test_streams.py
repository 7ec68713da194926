"""JSON source, late ledger, sinks by epoch, restart, range lookup."""

import random

import pytest
from pyspark.sql import functions as F

from conftest import SF001, rows
from strata import catalog
from strata.operators.joins import aligned_blocks, range_lookup
from strata.session import scratch_path
from strata.sources import landing, recast
from strata.streaming import late, runner, sinks, sources


def test_malformed_lines_are_split_off(spark):
    lines = ['{"url":"/a","host":"h","event_time":"t"}', "", "{", '{"url":5}', "[1]", "text", '{"other":1}', None]
    df = spark.createDataFrame([(x,) for x in lines], "value string")
    good, bad = sources.split_corrupt(sources.parse_json(df))
    assert sorted(r[0] for r in bad.collect()) == sorted(["{", "[1]", "text"]) or {"{", "text"} <= {r[0] for r in bad.collect()}
    assert good.count() + bad.count() == len(lines)
    assert good.columns == ["url", "referrer", "user_agent", "host", "ip", "headers", "event_time"]
    kafka = spark.createDataFrame([(bytearray(lines[0].encode()),)], "value binary")  # a broker's value
    assert sources.parse_json(kafka).first().url == "/a"


def test_late_rows_add_up(spark):
    out = catalog.q_stream_late_ledger(spark, SF001)
    total = {r.kind: r.n for r in out.groupBy("kind").agg(F.sum("num_hits").alias("n")).collect()}
    groups = {r.epoch: r.n for r in out.where("kind = 'late'").groupBy("epoch").agg(F.count(F.lit(1)).alias("n")).collect()}
    dropped = {r.epoch: r.num_hits for r in out.where("kind = 'dropped'").collect()}
    events = spark.read.parquet(f"{SF001}/events.parquet").count()
    assert total["closed"] + total.get("open", 0) + total["late"] == events
    assert total["late"] > 0 and dropped == groups  # what the query dropped is what the ledger holds


def test_ledger_epoch_can_be_repeated(spark):
    path = scratch_path(spark, "ledger")
    write = late.ledger_writer("t", 300, 15, f"{path}/late", f"{path}/highs")
    ts = lambda *xs: spark.createDataFrame([(x,) for x in xs], "t string").select(F.to_timestamp("t").alias("t"))
    batches = [ts("2024-01-01 10:00:00"), ts("2024-01-01 12:00:00"), ts("2024-01-01 09:00:00", "2024-01-01 11:00:00"), ts("2024-01-01 11:00:00", "2024-01-01 13:00:00")]
    for epoch in (0, 1, 1, 2, 2, 3, 3):
        write(batches[epoch], epoch)
    got = [(r.epoch, str(r.t)) for r in sinks.read_epochs(spark, f"{path}/late").orderBy("epoch").collect()]
    assert got == [(2, "2024-01-01 09:00:00"), (3, "2024-01-01 11:00:00")]


def test_epoch_replaces_itself(spark):
    path = scratch_path(spark, "epochs")
    write = sinks.fan_out({"all": (f"{path}/all", lambda b: b), "odd": (f"{path}/odd", lambda b: b.where("id % 2 = 1"))})
    write(spark.range(4), 0)
    write(spark.range(10, 13), 1)
    write(spark.range(10, 13), 1)
    assert rows(sinks.read_epochs(spark, f"{path}/all")) == [(0, 0), (1, 0), (2, 0), (3, 0), (10, 1), (11, 1), (12, 1)]
    assert rows(sinks.read_epochs(spark, f"{path}/odd")) == [(1, 0), (3, 0), (11, 1)]
    write(spark.range(0), 1)  # a repeated epoch that holds nothing now
    assert sinks.read_epochs(spark, f"{path}/all").where("epoch = 1").count() == 0


def test_restarted_sessions_equal_an_unbroken_run(spark):
    assert rows(catalog.q_stream_sessions_restart(spark, SF001)) == rows(catalog.q_stream_sessions(spark, SF001))


def test_state_partitions_leave_the_session_alone(spark):
    key = "spark.sql.shuffle.partitions"
    before = spark.conf.get(key)
    with pytest.raises(RuntimeError), runner._state_partitions(spark, 3):
        assert spark.conf.get(key) == "3"
        raise RuntimeError
    assert spark.conf.get(key) == before


def _ranges(rng, n, top):
    out = set()
    while len(out) < n:
        a = rng.randrange(top)
        b = min(top - 1, a + rng.choice([0, 1, 3, rng.randrange(top)]))
        out.add((a, b))
    return [(a, b, f"r{k}") for k, (a, b) in enumerate(sorted(out))]


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_range_lookup_against_all_pairs(spark, seed):
    rng = random.Random(seed)
    ranges = _ranges(rng, 40, 300)
    df = spark.createDataFrame([(v,) for v in [*range(310), None]], "v long")
    got = {r.v: (r.s, r.e, r.name) for r in range_lookup(df, "v", spark.createDataFrame(ranges, "s long, e long, name string"), "s", "e").collect()}
    for v, hit in got.items():
        inside = [] if v is None else [r for r in ranges if r[0] <= v <= r[1]]
        assert hit == min(inside, key=lambda r: (r[1] - r[0], r), default=(None, None, None))


def test_blocks_cover_a_range_once(spark):
    ranges = [(0, 0), (0, 2**32 - 1), (1, 2**32 - 2), (5, 5), (167772160, 184549375), (7, 1000), (256, 511), (3, 2)]
    df = spark.createDataFrame(ranges, "s long, e long")
    blocks = {}
    for r in aligned_blocks(df, "s", "e").collect():
        blocks.setdefault((r.s, r.e), []).append((r._prefix << r._level, 1 << r._level))
    assert (3, 2) not in blocks
    for (s, e), held in blocks.items():
        at = s
        for first, size in sorted(held):
            assert first == at and first % size == 0
            at += size
        assert at == e + 1 and len(held) <= 62
    assert len(blocks[0, 2**32 - 1]) == 1 == len(blocks[167772160, 184549375])


def test_no_ranges_at_all(spark):
    none = spark.createDataFrame([], "s long, e long, name string")
    out = range_lookup(spark.range(3), "id", none, "s", "e")
    assert out.columns == ["id", "s", "e", "name"] and rows(out.select("id", "name")) == [(0, None), (1, None), (2, None)]


def test_nested_geography_joins_by_prefix_length(spark):
    text = catalog.q_geo_nested_lookup(spark, SF001)._jdf.queryExecution().toString()
    assert "NestedLoop" not in text and "Cartesian" not in text
    levels = aligned_blocks(recast.geo_nested(spark, SF001), "ip_start", "ip_end")
    assert levels.groupBy("ip_start", "ip_end").count().agg(F.max("count")).first()[0] <= 62
    assert landing.CHUNKS == 6
