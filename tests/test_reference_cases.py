"""Small hand-made cases of the three SQL jobs, in both forms."""

from strata.operators import graph, reduced, scd, sqltext


def _arrays(spark):
    return spark.createDataFrame(
        [("m1", [5, None, 2, 9], "d1"), ("m1", [1], "d1"), ("m2", [], "d1"), ("m2", [7, 7, 7], "d2"), ("m3", None, "d1")],
        "month string, hits array<bigint>, day string")


def test_first_days(spark):
    kw = dict(month_col="month", array_col="hits", partition_col="day", ds="d1")
    for form in (reduced.first_days_sum, sqltext.first_days_sum):
        got = sorted(tuple(r) for r in form(_arrays(spark), **kw).collect())
        assert got == [("m1", 6, 0, 2), ("m2", 0, 0, 0), ("m3", 0, 0, 0)]


def test_streaks(spark):
    rows = [("x", 3, "u"), ("x", 4, "u"), ("x", 5, None), ("x", 6, None), ("x", 7, "u"), ("y", 9, "v"), ("z", 1, None)]
    df = spark.createDataFrame(rows, "who string, p int, s string")
    want = [("x", "u", 3, 4), ("x", None, 5, 6), ("x", "u", 7, 7), ("y", "v", 9, 9), ("z", None, 1, 1)]
    a = scd.scd_backfill(df, ["who"], period_col="p", state_cols=["s"], start_col="a", end_col="b", current_col=None)
    b = sqltext.streaks(df, key="who", period_col="p", state_col="s", start_col="a", end_col="b")
    for form in (a, b):
        assert sorted((tuple(r) for r in form.select("who", "s", "a", "b").collect()), key=str) == sorted(want, key=str)


def _teams(spark):
    rows = [(5, "AAA", "Owls", "Here", "Hall", 1990, 2), (5, "AAA", "Later", "Here", "Hall", 1990, 8), (6, None, "Rays", "There", "Dome", None, 1)]
    return spark.createDataFrame(rows, "team_id bigint, abbreviation string, nickname string, city string, arena string, yearfounded int, row_order int")


def test_team_vertices(spark):
    names = {"abbreviation": "abbreviation", "nickname": "nickname", "city": "city", "arena": "arena", "year_founded": "yearfounded"}
    a = {r.identifier: dict(r.properties) for r in graph.team_vertices(_teams(spark), as_map=True).collect()}
    b = {str(r.identifier): dict(r.properties) for r in sqltext.map_vertices(_teams(spark), key="team_id", kind="team", order_col="row_order", properties=names).collect()}
    assert a == b == {
        "5": {"abbreviation": "AAA", "nickname": "Owls", "city": "Here", "arena": "Hall", "year_founded": "1990"},
        "6": {"abbreviation": None, "nickname": "Rays", "city": "There", "arena": "Dome", "year_founded": None}}
    text = {r.identifier: r.properties for r in graph.team_vertices(_teams(spark)).collect()}
    assert text["6"] == '{"abbreviation":null,"nickname":"Rays","city":"There","arena":"Dome","year_founded":null}'


def test_scd_step_reads_one_version(spark):
    prev = spark.createDataFrame([("k", "a", 1, 2, 2), ("k", "y", 1, 3, 3), ("q", "b", 1, 1, 2)], "k string, s string, st int, en int, cur int")
    snap = spark.createDataFrame([("k", 3, "a"), ("n", 3, "c")], "k string, p int, s string")
    out = scd.scd_incremental(prev, snap, ["k"], period=3, period_col="p", state_cols=["s"], start_col="st", end_col="en", current_col="cur")
    assert sorted(map(tuple, out.collect())) == [("k", "a", 1, 3, 3), ("n", "c", 3, 3, 3), ("q", "b", 1, 1, 3)]


def test_kafka_value_and_jdbc_writer_shapes(spark):
    from strata.streaming.runner import jdbc_batch_writer, kafka_value
    df = spark.createDataFrame([(1, "a")], "id int, v string")
    row = kafka_value(df, "id").first()
    assert row.key == "1" and row.value == '{"id":1,"v":"a"}'
    assert callable(jdbc_batch_writer("jdbc:postgresql://db/x", "t", {"user": "u"}))
