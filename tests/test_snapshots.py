"""Snapshot tables: fold with writes == one-shot snapshot; re-run idempotent."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from conftest import SF001, rows
from strata import catalog
from strata.operators import activity, reduced
from strata.plans.inspect import plan_text
from strata.session import scratch_path
from strata.sources import recast
from strata.sources.snapshots import MissingPeriod, append_period, fold_periods, read_period


def test_datelist_fold_through_storage(spark):
    ev = recast.web_events(spark, SF001)
    path = scratch_path(spark, "users-cumulated")
    days = [dt.date(2024, 1, d) for d in range(1, 31)]

    def step(state, day):
        today = activity.daily_active(ev, ["user_id"], "event_time", day.isoformat())
        if state is None:
            state = activity.datelist_snapshot(ev, ["user_id"], "event_time",
                                               (day - dt.timedelta(days=1)).isoformat())
        return activity.datelist_step(state.select("user_id", "dates_active", "curr_date"), today, ["user_id"])

    before = lambda p: p - dt.timedelta(days=1)
    fold_periods(spark, path, "curr_date", days[:-1], step, previous=before, first=days[0])
    # the next day in a run of its own continues the stored history, and
    # re-running it replaces its partition (idempotent upsert)
    for _ in range(2):
        fold_periods(spark, path, "curr_date", days[-1:], step, previous=before)
    # a day over a gap fails and writes nothing
    with pytest.raises(MissingPeriod):
        fold_periods(spark, path, "curr_date", [dt.date(2024, 2, 3)], step, previous=before)
    got = read_period(spark, path, "curr_date", days[-1]).select("user_id", "dates_active", "curr_date")
    want = activity.datelist_snapshot(ev, ["user_id"], "event_time", days[-1].isoformat())
    assert rows(got) == rows(want.select(*got.columns))
    assert spark.read.parquet(path).select("curr_date").distinct().count() == 30


def test_month_arrays_fold_rewrites_own_partition(spark):
    ev = recast.web_events(spark, SF001)
    path = scratch_path(spark, "host-activity-reduced")
    arrays = {"hit_array": "num_hits", "unique_visitors": "unique_visitors"}
    days = [dt.date(2024, 1, d) for d in range(1, 11)] + [dt.date(2024, 1, 10)]  # last day twice

    def step(state, day):
        today = reduced.daily_metrics(ev, ["host"], "event_time", day.isoformat(), distinct_of="user_id")
        if state is None:
            state = spark.createDataFrame([], "host string, month date, hit_array array<bigint>, "
                                              "unique_visitors array<bigint>")
        return reduced.month_array_step(state.select("host", "month", *arrays), today, ["host"],
                                        day=day.isoformat(), month_col="month", metrics=arrays)

    fold_periods(spark, path, "month", days, step, first=days[0], rewrites_state=True,
                 previous=lambda p: None if p.day == 1 else p.replace(day=1))
    got = read_period(spark, path, "month", dt.date(2024, 1, 1)).select("host", "month", *arrays)
    want = reduced.month_array_snapshot(ev, ["host"], "event_time", "2024-01-10", distinct_of="user_id",
                                        month_col="month", arrays=arrays)
    assert rows(got) == rows(want.select(*got.columns))
    assert got.where(F.size("hit_array") != 10).count() == 0


def test_catalog_table_insert_overwrites_one_partition(spark):
    from strata.sources.snapshots import create_table, insert_period
    name = "hosts_cumulated_" + scratch_path(spark, "t").rsplit("-", 1)[-1]
    create_table(spark, name, scratch_path(spark, "hosts-table"), kind="hosts_cumulated")
    d1, d2 = dt.date(2024, 1, 1), dt.date(2024, 1, 2)
    mk = lambda rows_: spark.createDataFrame(rows_, "host string, host_activity_datelist array<date>, curr_date date")
    insert_period(mk([("a", [d1], d1), ("b", [d1], d1)]), name)
    insert_period(mk([("a", [d2, d1], d2)]), name)
    insert_period(mk([("a", [d2, d1], d2), ("c", [d2], d2)]), name)   # re-run of d2 replaces it
    got = rows(spark.table(name).select("host", "curr_date"))
    assert got == [("a", d1), ("a", d2), ("b", d1), ("c", d2)]


def test_two_sinks_from_one_source(spark):
    from strata import catalog as C
    from strata.streaming import runner, windows
    raw = C._raw_stream(spark, SF001)
    qs = runner.start_many({"by_host": windows.tumbling_counts(raw, "event_timestamp", ["host"]),
                            "by_host_referrer": windows.tumbling_counts(raw, "event_timestamp",
                                                                        ["host", "referrer"])},
                           scratch_path(spark, "sinks"), scratch_path(spark, "sinks-ck"), trigger="available_now")
    for q in qs.values():
        q.awaitTermination()
    a = spark.read.parquet(qs["by_host"].lastProgress["sink"]["description"].split("[", 1)[1].rstrip("]"))
    b = spark.read.parquet(qs["by_host_referrer"].lastProgress["sink"]["description"].split("[", 1)[1].rstrip("]"))
    assert a.agg(F.sum("num_hits")).first()[0] == b.agg(F.sum("num_hits")).first()[0] > 0


def test_bucketed_snapshot_step_shuffles_only_today(spark):
    from strata import catalog as C
    from strata.operators import cumulate
    from strata.plans.inspect import plan_text
    from strata.sources.snapshots import write_period_bucketed
    name = "players_bucketed_" + scratch_path(spark, "t").rsplit("-", 1)[-1]
    path = scratch_path(spark, "players-bucketed")
    ps = recast.player_seasons(spark, SF001)
    kw = dict(period_col="season", stats_cols=["gp", "pts"], history_col="season_stats",
              current_col="current_season", classify=C._player_class, class_measure="pts",
              class_col="scoring_class", since_col="years_since_last_season")
    write_period_bucketed(C.players_snapshots(spark, SF001, 1995, only_last=True), name, path,
                          "current_season", "player_id", 8)
    for season in range(1996, 2002):
        y = spark.table(name).where(F.col("current_season") == season - 1)
        step = cumulate.cumulate_step(y, ps.where(F.col("season") == season), ["player_id"], **kw)
        if season == 2001:
            physical = plan_text(step, "simple").split("== Physical Plan ==")[-1]
            assert "Bucketed: true" in physical
            assert physical.count("Exchange hashpartitioning(player_id") == 1  # today's rows only
        write_period_bucketed(step, name, path, "current_season", "player_id", 8)
    got = spark.table(name).where("current_season = 2001")
    want = C.players_snapshots(spark, SF001, 2001, only_last=True)
    assert rows(got.select(*want.columns)) == rows(want)


def test_cumulative_rerun_of_a_period_is_idempotent(spark):
    from strata import catalog as C
    from strata.operators import cumulate
    from strata.sources.snapshots import write_period
    path = scratch_path(spark, "players")
    ps = recast.player_seasons(spark, SF001)
    kw = dict(period_col="season", stats_cols=["gp", "pts"], history_col="season_stats",
              current_col="current_season", classify=C._player_class, class_measure="pts",
              class_col="scoring_class", since_col="years_since_last_season")
    write_period(C.players_snapshots(spark, SF001, 2000, only_last=True), path, "current_season")

    def run_2001():
        y = read_period(spark, path, "current_season", 2000)
        write_period(cumulate.cumulate_step(y, ps.where(F.col("season") == 2001), ["player_id"], **kw),
                     path, "current_season")
        return rows(read_period(spark, path, "current_season", 2001).drop("current_season"))

    first, second = run_2001(), run_2001()
    assert first == second
    assert spark.read.parquet(path).where("current_season = 2001").count() == len(first)


@pytest.mark.parametrize("name", ["cumulative_step", "scd_incremental", "datelist_device_step", "reduced_host_month_step"])
def test_step_from_storage_equals_step_from_raw_rows(spark, name):
    got, want = catalog.QUERIES["stored_" + name](spark, SF001), catalog.QUERIES[name](spark, SF001)
    assert got.columns == want.columns
    assert rows(got) == rows(want)


def test_stored_step_reads_one_partition_and_one_day(spark):
    ev = recast.web_events(spark, SF001)
    path = scratch_path(spark, "users-pruned")
    for day in ("2024-01-08", "2024-01-09"):
        append_period(activity.datelist_snapshot(ev, ["user_id"], "event_time", day), path, "curr_date")
    assert spark.read.parquet(path).select("curr_date").distinct().count() == 2  # both appended
    state = read_period(spark, path, "curr_date", dt.date(2024, 1, 9))
    step = activity.datelist_step(state, activity.daily_active(ev, ["user_id"], "event_time", "2024-01-10"), ["user_id"])
    text = plan_text(step)
    partitions = [x for x in text.splitlines() if "PartitionFilters" in x]
    assert any("curr_date" in x and "2024-01-09" in x for x in partitions)
    pushed = [x for x in text.splitlines() if "PushedFilters" in x]
    assert any("GreaterThanOrEqual(ts" in x and "LessThan(ts" in x for x in pushed)
