"""Cumulative tables and SCD2: incremental == backfill, idempotence, edge cases."""

from pyspark.sql import functions as F

from conftest import SF001, rows, srt
from strata import catalog as C
from strata.functions.columns import tier
from strata.operators import cumulate, scd
from strata.sources import recast


def _cls(c):
    return tier(c, recast.PLAYER_CLASS_CUTS, "bad")


KW = dict(period_col="season", stats_cols=["gp", "pts"], history_col="h", current_col="cur",
          classify=_cls, class_measure="pts", class_col="cls", since_col="since")


def _fold(ps, first, last):
    state = cumulate.cumulate_backfill(ps, ["player_id"], first_period=first, last_period=first,
                                       **KW)
    for p in range(first + 1, last + 1):
        state = cumulate.cumulate_step(state, ps.where(F.col("season") == p), ["player_id"], **KW)
    return state


def test_fold_of_steps_equals_backfill(spark):
    ps = recast.player_seasons(spark, SF001)
    folded = _fold(ps, 1995, 2001)
    back = cumulate.cumulate_backfill(ps, ["player_id"], first_period=1995, last_period=2001,
                                      only_last=True, **KW)
    cols = ["player_id", "h", "cls", "since", "cur", "is_active"]
    assert rows(folded, *cols) == rows(back, *cols)
    # every snapshot, not only the last
    allsnap = cumulate.cumulate_backfill(ps, ["player_id"], first_period=1995, last_period=2001, **KW)
    assert rows(allsnap.where("cur = 2001"), *cols) == rows(back, *cols)


def test_step_edge_cases(spark):
    y = spark.createDataFrame([
        ("returning", [(2000, 1, 21.0)], "star", 0, 2000),
        ("absent", [(1998, 2, 12.0)], "average", 2, 2000),
        ("null_hist", None, None, 0, 2000),
    ], "player_id string, h array<struct<season:int,gp:bigint,pts:double>>, cls string, since int, cur int")
    t = spark.createDataFrame([("returning", 2001, 3, 16.0), ("new", 2001, 1, 5.0), ("null_hist", 2001, 1, 30.0)],
                              "player_id string, season int, gp bigint, pts double")
    kw = dict(KW, classify=lambda c: tier(c, [(20.0, "star"), (15.0, "good"), (10.0, "average")], "bad"))
    out = {r.player_id: r for r in cumulate.cumulate_step(y, t, ["player_id"], **kw).collect()}
    assert [s.season for s in out["returning"].h] == [2000, 2001] and out["returning"].cls == "good"
    assert out["absent"].h[0].season == 1998 and out["absent"].since == 3 and out["absent"].cur == 2001
    assert out["absent"].cls == "average" and out["absent"].is_active is False
    assert [s.season for s in out["new"].h] == [2001] and out["new"].cls == "bad"
    assert [s.season for s in out["null_hist"].h] == [2001] and out["null_hist"].cls == "star"


def test_items_fold_equals_backfill_with_carry(spark):
    af = recast.actor_films(spark, SF001)
    kw = dict(period_col="year", item_cols=["film", "votes", "rating", "filmid"], order_col="filmid",
              measure="rating", classify=lambda c: tier(c, recast.ACTOR_CLASS_CUTS, "bad"),
              carry_cols=["actor"], items_col="films", class_col="qc", as_of_col="y")
    state = cumulate.cumulate_items_backfill(af, ["actorid"], first_period=1995, last_period=1995,
                                             carry_state=True, **kw)
    for p in range(1996, 2002):
        state = cumulate.cumulate_items_step(state, af, ["actorid"], period=p, **kw)
    back = cumulate.cumulate_items_backfill(af, ["actorid"], first_period=1995, last_period=2001,
                                            carry_state=True, only_last=True, **kw)
    cols = ["actorid", "actor", "y", "films", "qc", "is_active"]
    assert rows(state, *cols) == rows(back, *cols)


def test_scd_incremental_equals_backfill(spark):
    for last in (1999, 2000, 2001):
        prev = C.players_scd(spark, SF001, last - 1)
        snap = C.players_snapshots(spark, SF001, last, only_last=True)
        inc = scd.scd_incremental(prev, snap, ["player_id"], period=last, period_col="current_season",
                                  state_cols=["scoring_class", "is_active"], start_col="start_season",
                                  end_col="end_season", current_col="current_season")
        assert rows(inc) == rows(C.players_scd(spark, SF001, last).select(*inc.columns))


def test_scd_actors_incremental_equals_backfill(spark):
    inc = C.q_scd_incremental_retained(spark, SF001)
    back = C.actors_scd(spark, SF001, C.LAST_SEASON).select(*inc.columns)
    assert rows(inc) == rows(back)


STATES = "k string, p int, s string"


def test_scd_null_handling_modes(spark):
    df = spark.createDataFrame([
        ("a", 1, "A"), ("a", 2, None), ("a", 3, "A"),          # A -> NULL -> A
        ("b", 1, None), ("b", 2, None), ("b", 3, None),        # run of NULL
        ("c", 1, "X"), ("c", 2, "Y"), ("c", 3, "X"),           # flips twice
        ("d", 1, "Z"), ("d", 2, "Z"),                          # unchanged
    ], STATES)
    kw = dict(period_col="p", state_cols=["s"], start_col="st", end_col="en", current_col=None)
    safe = rows(scd.scd_backfill(df, ["k"], **kw))
    assert ("a", "A", 1, 1) in safe and ("a", None, 2, 2) in safe and ("a", "A", 3, 3) in safe
    assert [r for r in safe if r[0] == "b"] == [("b", None, 1, 3)]
    assert [r for r in safe if r[0] == "c"] == [("c", "X", 1, 1), ("c", "X", 3, 3), ("c", "Y", 2, 2)]
    assert [r for r in safe if r[0] == "d"] == [("d", "Z", 1, 2)]
    # literal <> : NULL transitions do not split -> overlapping intervals (Q2)
    lit = rows(scd.scd_backfill(df, ["k"], mode="literal", **kw))
    assert [r for r in lit if r[0] == "a"] == [("a", None, 2, 2), ("a", "A", 1, 3)]
    # literal prev-null: NULL runs never merge (Q3)
    pn = rows(scd.scd_backfill(df, ["k"], mode="literal_prev_null", **kw))
    assert len([r for r in pn if r[0] == "b"]) == 3


def test_scd_incremental_outcomes(spark):
    prev = spark.createDataFrame([
        ("same", "A", 1, 3), ("chg", "A", 2, 3), ("gone", "B", 1, 3), ("closed", "C", 1, 2),
        ("nul", None, 3, 3),
    ], "k string, s string, st int, en int")
    snap = spark.createDataFrame([("same", 4, "A"), ("chg", 4, "B"), ("new", 4, "N"), ("nul", 4, None)],
                                 "k string, p int, s string")
    kw = dict(period=4, period_col="p", state_cols=["s"], start_col="st", end_col="en", current_col=None)
    out = rows(scd.scd_incremental(prev, snap, ["k"], **kw))
    assert out == srt([("same", "A", 1, 4), ("chg", "A", 2, 3), ("chg", "B", 4, 4), ("gone", "B", 1, 3),
                          ("closed", "C", 1, 2), ("new", "N", 4, 4), ("nul", None, 3, 4)])
    dropped = rows(scd.scd_incremental(prev, snap, ["k"], retain_missing=False, **kw))
    assert ("gone", "B", 1, 3) not in dropped
    literal = rows(scd.scd_incremental(prev, snap, ["k"], null_safe=False, **kw))
    assert not [r for r in literal if r[0] == "nul"]  # Q4: NULL state matches no branch


def test_first_last_ratio_zero_first(spark):
    snap = spark.createDataFrame([("p", [(1, 0.0), (2, 8.0)]), ("q", [(1, 2.0), (3, 5.0)])],
                                 "k string, h array<struct<season:int,pts:double>>")
    out = dict(rows(cumulate.first_last_ratio(snap, ["k"], "pts", history_col="h")))
    assert out == {"p": 8.0, "q": 2.5}
