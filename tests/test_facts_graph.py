"""Deduplicated facts, minutes parsing, property graph."""

from pyspark.sql import functions as F

from conftest import SF001, rows
from strata import catalog as C
from strata.functions.columns import clock_minutes
from strata.operators import facts, graph
from strata.operators.joins import first_per_key, range_lookup

DETAIL = ("game_id long, team_id long, player_id long, player_name string, team_abbreviation string, "
          "start_position string, comment string, min string, pts int, reb int, ast int, line_no int, part_no long")


def test_clock_minutes(spark):
    df = spark.createDataFrame([("34:12",), ("34",), ("",), (" ",), (None,), ("x:y",), ("5:30",)], "m string")
    got = [r[0] for r in df.select(clock_minutes("m")).collect()]
    assert got == [34.2, 34.0, 0.0, 0.0, 0.0, 0.0, 5.5]


def test_first_per_key_dedupe(spark):
    df = spark.createDataFrame([
        (1, "x", 2, "b"), (1, "x", 1, "a"),      # duplicate key, different measures
        (2, None, 1, "c"), (2, None, 1, "c"),     # exact duplicate; NULL in key
        (3, "y", None, "n"), (3, "y", 0, "z"),    # NULL order value sorts first
    ], "k int, k2 string, o int, v string")
    out = rows(first_per_key(df, ["k", "k2"], ["o"]))
    assert out == [(1, "x", 1, "a"), (2, None, 1, "c"), (3, "y", None, "n")]
    assert rows(first_per_key(df, ["k", "k2"], ["o"], strategy="window")) == out


def test_dedupe_fact_flags_and_grain(spark):
    d = spark.createDataFrame([
        (1, 10, 100, "P", "BOS", "F", "DNP - rest", "12:30", 5, 1, 1, 2, 7),
        (1, 10, 100, "P", "BOS", "F", None, "40:00", 9, 1, 1, 1, 3),   # duplicate grain; wins on line_no
        (1, 11, 101, "Q", "NYK", None, "NWT", None, 0, 0, 0, 1, 4),
    ], DETAIL)
    g = spark.createDataFrame([(1, "2020-01-01", 2020, 10)], "game_id long, game_date_est string, season int, "
                              "home_team_id long").withColumn("game_date_est", F.to_date("game_date_est"))
    out = {r.dim_player_id: r for r in facts.dedupe_fact(d, g).collect()}
    assert len(out) == 2
    assert out[100].m_pts == 9 and out[100].m_minutes == 40.0 and out[100].dim_did_not_play is False
    assert out[100].dim_is_playing_at_home is True
    assert out[101].dim_not_with_team is True and out[101].m_minutes == 0.0
    assert out[101].dim_is_playing_at_home is False
    viol = rows(facts.grain_violations(d, list(facts.GRAIN)))
    assert viol == [(1, 10, 100, 2)]


def test_pair_edges_cases(spark):
    d = spark.createDataFrame([
        (1, 1, 1, "A", "T1", None, None, None, 10, 0, 0, 1, 1),
        (1, 1, 2, "B", "T1", None, None, None, 5, 0, 0, 2, 2),
        (1, 2, 3, "C", "T2", None, None, None, 7, 0, 0, 3, 3),
        (1, 2, 4, "C", "T2", None, None, None, 1, 0, 0, 4, 4),   # same name as 3: no edge
        (2, 1, 1, "A", "T1", None, None, None, 3, 0, 0, 1, 5),
        (2, 2, 2, "B", "T2", None, None, None, None, 0, 0, 1, 6),  # player 2 in another team, NULL pts
    ], DETAIL)
    e = graph.pair_edges(d)
    got = {(r.subject_identifier, r.object_identifier, r.edge_type): r.properties for r in e.collect()}
    assert got[("2", "1", "shares_team")] == '{"num_games":1,"subject_points":5,"object_points":10}'
    assert got[("2", "1", "plays_against")] == '{"num_games":1,"subject_points":null,"object_points":3}'
    assert ("4", "3", "shares_team") not in got
    assert len(got) == 1 + 1 + 4  # 2-1 twice, plus 3/4 against 1 and 2
    salted = graph.pair_edges(d, hot_rows=0, block=2)
    assert rows(salted) == rows(e)


def test_vertices_edges_roundtrip(spark):
    v = C.q_vertex_counts(spark, SF001)
    counts = dict(rows(v))
    assert set(counts) == {"game", "player", "team"}
    mp = C.q_edge_max_points(spark, SF001)
    assert mp.where(F.col("max_points").isNull()).count() == 0


def test_range_lookup(spark):
    df = spark.createDataFrame([(1, 5), (2, 300), (3, 1000), (4, None)], "id int, v long")
    ranges = spark.createDataFrame([(0, 99, "a"), (256, 600, "b")], "s long, e long, name string")
    out = rows(range_lookup(df, "v", ranges, "s", "e").select("id", "name"))
    assert out == [(1, "a"), (2, "b"), (3, None), (4, None)]
