"""Datelists, bitmaps and month-array reduced facts."""

import datetime as dt

from pyspark.sql import functions as F

from conftest import SF001, rows
from strata.functions.bitmaps import activity_bits
from strata.operators import activity, reduced
from strata.plans.inspect import count_nodes
from strata.sources import recast

D = dt.date


def _events(spark, data):
    return spark.createDataFrame(
        [(u, h, dt.datetime.fromisoformat(t)) for u, h, t in data],
        "user_id long, host string, event_time timestamp_ntz")


def test_datelist_step_guard_and_rerun(spark):
    y = spark.createDataFrame([(1, [D(2024, 1, 2), D(2024, 1, 1)], D(2024, 1, 2)),
                               (2, [D(2024, 1, 1)], D(2024, 1, 2))],
                              "user_id long, dates_active array<date>, curr_date date")
    ev = _events(spark, [(1, "a", "2024-01-03 10:00:00"), (3, "a", "2024-01-03 11:00:00"),
                         (None, "a", "2024-01-03 11:00:00"), (1, "a", "2024-01-03 12:00:00")])
    t = activity.daily_active(ev, ["user_id"], "event_time", "2024-01-03")
    s1 = activity.datelist_step(y, t, ["user_id"])
    got = {r.user_id: (r.dates_active, r.curr_date) for r in s1.collect()}
    assert got[1] == ([D(2024, 1, 3), D(2024, 1, 2), D(2024, 1, 1)], D(2024, 1, 3))
    assert got[2] == ([D(2024, 1, 1)], D(2024, 1, 3))
    assert got[3] == ([D(2024, 1, 3)], D(2024, 1, 3))
    assert None not in got
    # re-running the same day on the new snapshot changes nothing (guard)
    s2 = activity.datelist_step(s1.where("user_id = 1"), t.where("user_id = 1"), ["user_id"])
    assert s2.first().dates_active == got[1][0]


def test_datelist_fold_equals_snapshot(spark):
    ev = recast.web_events(spark, SF001)
    state = activity.datelist_snapshot(ev, ["user_id"], "event_time", "2024-01-20")
    for d in range(21, 31):
        day = f"2024-01-{d:02d}"
        state = activity.datelist_step(state, activity.daily_active(ev, ["user_id"], "event_time", day),
                                       ["user_id"])
    snap = activity.datelist_snapshot(ev, ["user_id"], "event_time", "2024-01-30")
    assert rows(state) == rows(snap.select(*state.columns))


def test_bitmap_edges(spark):
    snap = D(2024, 1, 31)
    df = spark.createDataFrame([
        ("snapshot_only", [snap]),
        ("first_day_of_window", [D(2024, 1, 2)]),
        ("outside_window", [D(2024, 1, 1), D(2023, 12, 1)]),
        ("duplicate", [snap, snap, D(2024, 1, 30)]),
        ("future", [D(2024, 2, 1)]),
        ("empty", []),
    ], "k string, d array<date>").withColumn("c", F.lit(snap))
    out = dict(rows(df.select("k", activity_bits("d", "c").alias("b"))))
    assert out["snapshot_only"] == 1 << 31
    assert out["first_day_of_window"] == 1 << 2
    assert out["outside_window"] == 0
    assert out["duplicate"] == (1 << 31) | (1 << 30)
    assert out["future"] == 0 and out["empty"] == 0
    lit = dict(rows(df.select("k", activity_bits("d", "c", top_bit=32).alias("b"))))
    assert lit["snapshot_only"] == 0  # the reference's 2^32 falls off BIT(32)
    thirty = dict(rows(df.select("k", activity_bits("d", "c", top_bit=29, word_bits=30).alias("b"))))
    assert thirty["snapshot_only"] == 1 << 29 and thirty["first_day_of_window"] == 1


def test_bitmap_flags(spark):
    snap = D(2024, 1, 31)
    df = spark.createDataFrame([(1, [snap]), (2, [D(2024, 1, 26)]), (3, [D(2024, 1, 10)])],
                               "user_id int, dates_active array<date>").withColumn("curr_date", F.lit(snap))
    out = {r.user_id: r for r in activity.bitmap_flags(df, ["user_id"]).collect()}
    assert (out[1].is_daily_active, out[1].is_weekly_active, out[1].is_monthly_active) == (True, True, True)
    assert (out[2].is_daily_active, out[2].is_weekly_active, out[2].is_monthly_active) == (False, True, True)
    assert (out[3].is_daily_active, out[3].is_weekly_active, out[3].is_monthly_active) == (False, False, True)
    assert out[1].activity_bits_text == "1" + "0" * 31


def test_bitmap_plan_has_no_join(spark):
    from strata import catalog as C
    df = C.q_bitmap32_flags(spark, SF001)
    assert count_nodes(df, "Join") == 0 and count_nodes(df, "CartesianProduct") == 0


def test_month_array_step_cases(spark):
    prev = spark.createDataFrame([
        ("h1", D(2024, 1, 1), [1, 2, 3, 4, 5]),        # full through day 5
        ("h2", D(2024, 1, 1), [7, 0, 1]),              # gap: absent on day 4
        ("h3", D(2024, 1, 1), [1, 1, 1, 1, 1, 9]),     # re-run: already covers day 6
        ("old", D(2023, 12, 1), [1]),                  # other month: ignored
        ("h5", D(2024, 1, 1), []),                     # empty array
    ], "host string, month date, hits array<bigint>")
    today = spark.createDataFrame([("h1", 10), ("h3", 99), ("new", 4), ("h5", 2)], "host string, n long")
    out = {r.host: r.hits for r in reduced.month_array_step(prev, today, ["host"], day="2024-01-06",
                                                             month_col="month", metrics={"hits": "n"}).collect()}
    assert out["h1"] == [1, 2, 3, 4, 5, 10]
    assert out["h2"] == [7, 0, 1, 0, 0, 0]
    assert out["h3"] == [1, 1, 1, 1, 1, 9]
    assert out["new"] == [0, 0, 0, 0, 0, 4]
    assert out["h5"] == [0, 0, 0, 0, 0, 2]
    assert "old" not in out


def test_month_array_fold_equals_snapshot(spark):
    ev = recast.web_events(spark, SF001)
    arrays = {"hit_array": "num_hits", "unique_visitors": "unique_visitors"}
    state = reduced.month_array_snapshot(ev, ["host"], "event_time", "2024-01-25", distinct_of="user_id",
                                         month_col="month", arrays=arrays)
    for d in range(26, 31):
        day = f"2024-01-{d:02d}"
        today = reduced.daily_metrics(ev, ["host"], "event_time", day, distinct_of="user_id")
        state = reduced.month_array_step(state, today, ["host"], day=day, month_col="month", metrics=arrays)
    snap = reduced.month_array_snapshot(ev, ["host"], "event_time", "2024-01-30", distinct_of="user_id",
                                        month_col="month", arrays=arrays)
    assert rows(state) == rows(snap.select(*state.columns))


def test_elementwise_sum_any_length(spark):
    df = spark.createDataFrame([("m", D(2024, 1, 1), [1, 2]), ("m", D(2024, 1, 1), [10, 20, 30]),
                                ("m", D(2024, 1, 1), [])], "metric_name string, month_start date, a array<bigint>")
    out = rows(reduced.elementwise_sum(df, ["metric_name"], "a"))
    assert out == [("m", D(2024, 1, 1), 11), ("m", D(2024, 1, 2), 22), ("m", D(2024, 1, 3), 30)]


def test_month_array_literal_modes(spark):
    prev = spark.createDataFrame([("h1", D(2024, 1, 1), [1, 2, 3]), ("h2", D(2024, 1, 1), [5, 5, 5, 5, 5, 5])],
                                 "host string, month date, hits array<bigint>")
    today = spark.createDataFrame([("h2", 1), ("new", 4)], "host string, n long")
    kw = dict(day="2024-01-06", month_col="month", metrics={"hits": "n"})
    met = {r.host: r.hits for r in reduced.month_array_step(prev, today, ["host"], mode="literal_metric",
                                                             **kw).collect()}
    assert met == {"h1": [1, 2, 3, 0], "h2": [5, 5, 5, 5, 5, 5, 1], "new": [4]}   # Q8, Q9
    host = {r.host: r.hits for r in reduced.month_array_step(prev, today, ["host"], mode="literal_host",
                                                              **kw).collect()}
    assert host == {"h1": [1, 2, 3], "h2": [5, 5, 5, 5, 5, 5], "new": [0, 0, 0, 0, 0, 4]}  # Q10
