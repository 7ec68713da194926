"""Keyed merge, open SCD records, item batches, catalog tables."""

import datetime as dt
import glob
import os
import random

import pytest
from pyspark.sql import functions as F

from conftest import SF001, rows
from strata import catalog
from strata.operators import cumulate, graph, scd
from strata.plans.inspect import plan_text
from strata.session import scratch_path
from strata.sources import recast, snapshots
from strata.sources.scdstore import ScdStore

DAY = dt.date(2024, 1, 1)


def _files(path):
    found = {f: os.stat(f).st_mtime_ns for f in glob.glob(f"{path.removeprefix('file:')}/**/*.parquet", recursive=True)}
    assert found
    return found


def test_merge_rewrites_only_buckets_with_changed_keys(spark):
    path = scratch_path(spark, "merge")
    df = lambda rows_: spark.createDataFrame(rows_, "k long, v string, d date")
    snapshots.write_keyed(df([(k, "old", DAY) for k in range(200)] + [(k, "other", dt.date(2024, 1, 2)) for k in range(9)]), path, "d", ["k"], 16)
    before = _files(path)
    changed = snapshots.merge_keyed(df([(5, "new", DAY), (900, "added", DAY), (None, "null", DAY)]), path, "d", DAY, ["k"], 16)
    after = _files(path)
    touched = {os.path.basename(os.path.dirname(f)) for f in before.keys() ^ after.keys()}
    assert touched == {f"_bucket={b}" for b in changed} and 1 <= len(changed) <= 3
    assert all("d=2024-01-01" in f for f in before.keys() ^ after.keys())
    got = {r.k: r.v for r in snapshots.read_keyed(spark, path, "d", DAY).collect()}
    assert got == {**dict.fromkeys(range(200), "old"), 5: "new", 900: "added", None: "null"}
    # the same merge again, and one without rows, change nothing
    snapshots.merge_keyed(df([(5, "new", DAY), (900, "added", DAY), (None, "null", DAY)]), path, "d", DAY, ["k"], 16)
    assert snapshots.merge_keyed(df([]), path, "d", DAY, ["k"], 16) == []
    assert {r.k: r.v for r in snapshots.read_keyed(spark, path, "d", DAY).collect()} == got
    # into a period that is not there yet
    new = dt.date(2024, 2, 1)
    assert snapshots.merge_keyed(df([(1, "x", new)]), path, "d", new, ["k"], 16) and snapshots.read_keyed(spark, path, "d", new).count() == 1


def _history(rng, keys, periods):
    return [(k, p, rng.choice(["a", "b", None]), bool(rng.randrange(2))) for k in range(keys) for p in periods if rng.random() < 0.75]


@pytest.mark.parametrize("retain", [True, False])
def test_open_records_equal_the_whole_table_step(spark, retain):
    rows_ = _history(random.Random(3 + retain), 40, range(1, 7))
    snap = spark.createDataFrame(rows_, "k int, p int, c string, a boolean")
    kw = dict(state_cols=["c", "a"], start_col="s", end_col="e")
    store = ScdStore(spark, scratch_path(spark, "scd"), ["k", "c", "a", "s", "e"], "e")
    whole = scd.scd_backfill(snap, ["k"], period_col="p", as_of=2, current_col="v", **kw)
    # only records that end in the version are open
    store.seed(whole, 2)
    for p in range(3, 7):
        for _ in range(2):  # a repeated step replaces itself
            store.step(p, lambda r, p=p: scd.scd_open_step(r, snap, ["k"], period=p, period_col="p", retain_missing=retain, **kw))
        whole = snapshots.cut_lineage(scd.scd_incremental(whole, snap, ["k"], period=p, period_col="p", current_col="v", retain_missing=retain, **kw))
        assert rows(store.version(p, "v").select("k", "c", "a", "s", "e", "v")) == rows(whole.select("k", "c", "a", "s", "e", "v"))
    with pytest.raises(snapshots.MissingPeriod):
        store.open_records(9)


def test_step_reads_open_records_only(spark):
    store = ScdStore(spark, scratch_path(spark, "scd-plan"), catalog.PLAYER_RECORD, "end_season")
    store.seed(catalog.players_scd(spark, SF001, 2000), 2000)
    snap = catalog.players_snapshots(spark, SF001, 2001, only_last=True)
    step = scd.scd_open_step(store.open_records(2000), snap, ["player_id"], period=2001, period_col="current_season",
                             state_cols=["scoring_class", "is_active"], start_col="start_season", end_col="end_season")
    files = step.inputFiles()
    assert any("/open/version=2000/" in f for f in files) and not any("/closed/" in f for f in files)
    assert plan_text(step, "simple").split("== Physical Plan ==")[-1].count("Join") == 1


def test_item_batches_equal_the_copied_history(spark):
    got, want = (catalog.QUERIES[n](spark, SF001) for n in ("batched_cumulative_multi", "cumulative_multi_step"))
    assert rows(got) == rows(want)


def test_states_without_items(spark):
    full = catalog.actors_snapshots(spark, SF001).drop("films")
    assert rows(catalog.actors_states(spark, SF001)) == rows(full.select(*catalog.actors_states(spark, SF001).columns))
    carried = cumulate.cumulate_states_backfill(recast.actor_films(spark, SF001), ["actorid"], first_period=1995, last_period=2001, period_col="year",
                                                measure="rating", classify=catalog._actor_class, carry_state=True, only_last=True)
    want = catalog.actors_snapshots(spark, SF001, carry_state=True, only_last=True)
    assert rows(carried.select("actorid", "state_class")) == rows(want.select("actorid", "quality_class"))
    for name in ("scd_backfill_nullsafe", "scd_incremental_retained"):
        schemas = [x for x in plan_text(catalog.QUERIES[name](spark, SF001)).splitlines() if "ReadSchema" in x]
        assert schemas and not any(c in x for x in schemas for c in ("o_orderkey", "o_orderpriority"))


def test_mean_does_not_depend_on_the_order_of_rows(spark):
    values = [0.1, 0.2, 0.3, 1e8, 0.7, 0.1] * 40
    means = set()
    for seed in range(6):
        rng = random.Random(seed)
        rng.shuffle(values)
        means.add(spark.createDataFrame([(v,) for v in values], "v double").repartition(7).agg(cumulate.exact_mean("v")).first()[0])
    assert len(means) == 1


def test_drift_is_refused_before_anything_is_written(spark):
    path = scratch_path(spark, "drift")
    name = path.rsplit("/", 1)[-1].replace("-", "_")
    snapshots.create_table(spark, name, path, kind="hosts_cumulated")
    good = spark.createDataFrame([("a", [DAY], DAY)], "host string, host_activity_datelist array<date>, curr_date date")
    snapshots.insert_period(good, name)
    before = _files(path)
    wrong = [good.withColumnRenamed("host", "name"), good.withColumn("extra", F.lit(1)), good.drop("host_activity_datelist"),
             good.withColumn("curr_date", F.col("curr_date").cast("string")), good.select("host_activity_datelist", "host", "curr_date")]
    for df in wrong:
        with pytest.raises(snapshots.SchemaDrift):
            snapshots.insert_period(df, name)
    with pytest.raises(snapshots.SchemaDrift):
        snapshots.as_table(good.drop("host"), name)
    assert _files(path) == before
    # a table whose inserts would replace every partition is refused
    plain = f"{name}_plain"
    spark.sql(f"CREATE TABLE {plain} (host string, curr_date date) USING parquet PARTITIONED BY (curr_date) LOCATION '{path}-plain'")
    with pytest.raises(ValueError, match="created without"):
        snapshots.insert_period(good.select("host", "curr_date"), plain)


def test_typed_edges_need_no_json(spark):
    for name in ("edge_games_per_point", "edge_points_per_game", "edge_max_points"):
        physical = plan_text(catalog.QUERIES[name](spark, SF001), "simple").split("== Physical Plan ==")[-1]
        assert not any(x in physical for x in ("from_json", "to_json", "get_json_object", "structstojson", "jsontostructs"))
    # JSON at the sink and back gives the same answers
    d = recast.game_details(spark, SF001)
    typed = graph.pair_edges(d, typed=True)
    plain = graph.as_json(typed, ["num_games", "subject_points", "object_points"])
    assert rows(plain) == rows(graph.pair_edges(d))
    v = catalog.all_vertices(spark, SF001)
    text = graph.player_vertices(d)
    for f in (graph.games_per_point, graph.points_per_game):
        assert rows(f(v, typed)) == rows(f(text, plain))


@pytest.mark.parametrize("block", [1, 2, 5])
def test_pairs_of_blocks_equal_the_plain_join(spark, block):
    d = recast.game_details(spark, SF001).withColumn("game_id", F.col("game_id") % 40)
    plain = graph.pair_edges(d, hot_rows=10**9)
    assert rows(graph.pair_edges(d, hot_rows=60, block=block)) == rows(plain)
    assert "low" not in plain._jdf.queryExecution().toString()
