"""Plan shapes (bucketing, broadcast, pushdown) and stream == batch."""

import datetime as dt

from pyspark.sql import functions as F

from conftest import SF001, rows
from strata import catalog as C
from strata.plans.inspect import count_nodes, plan_text
from strata.session import scratch_path
from strata.sources import recast
from strata.sources.tables import day_range, table
from strata.streaming import windows


def test_registered_bucket_join_uses_the_buckets(spark):
    before = {k: spark.conf.get(k) for k in ("spark.sql.requireAllClusterKeysForCoPartition", "spark.sql.shuffle.partitions")}
    j = C.q_bucket_join(spark, SF001)
    text = plan_text(j, "formatted")
    assert text.count("Bucketed: true") == 3
    facts = plan_text(j, "simple").split("== Initial Plan ==")[0]
    assert facts.count("SortMergeJoin") == 2
    assert "hashpartitioning(match_id" not in facts
    assert before == {k: spark.conf.get(k) for k in before}
    # a second run replaces the tables of the first
    n = len(spark.catalog.listTables())
    C.q_bucket_join(spark, SF001)
    assert len(spark.catalog.listTables()) == n
    # the same join on unbucketed inputs shuffles
    u = recast.match_details(spark, SF001).join(recast.matches(spark, SF001).hint("merge"), "match_id")
    assert count_nodes(u, "Exchange") >= 2


def test_bucket_count_follows_the_bytes():
    from strata.plans.layout import bucket_count
    assert [bucket_count(b, 100) for b in (0, 100, 401, 100_000)] == [4, 4, 8, 1024]


def test_buckets_stay_small_as_the_input_grows():
    from strata.plans.layout import bucket_count
    sizes = [16 << 20, 160 << 20, 646 << 20, 60 << 30]
    assert all(b / bucket_count(b, C.BUCKET_BYTES) <= 8 << 20 for b in sizes)  # a task sorts one of each table
    assert bucket_count(1 << 50, C.BUCKET_BYTES) == 1 << 16  # Spark takes no more than 100,000


def test_csv_brings_every_value_back(spark):
    from strata.plans import layout
    odd = [(1, "a\nb"), (2, ""), (3, None), (4, 'say "x", y'), (5, " blank "), (6, "back\\"), (7, "\r\n")]
    df = spark.createDataFrame(odd, "k int, v string")
    path = layout.write_csv(df, scratch_path(spark, "odd-csv"))
    assert rows(layout.read_csv(spark, path, df.schema)) == odd


def test_addresses_and_utc_text(spark):
    from strata.functions.columns import ipv4_to_long
    df = spark.createDataFrame([("10.0.3.255",), ("10.0.3.256",), ("10.0.2.999",), ("1.2.3",), ("1.2.3.4\n",)], "a string")
    assert [r[0] for r in df.select(ipv4_to_long("a")).collect()] == [167773183, None, None, None, None]
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:  # 02:30 does not exist there on that day
        df = spark.createDataFrame([("2024-03-10T02:30:00.000Z",), ("2024-03-10T03:30:00.000Z",)], "t string")
        df = windows.parse_event_time(df, "t", "at")
        got = df.select("t", windows.iso_text("at").alias("back"), F.unix_seconds("at").alias("s")).collect()
        assert [r.back for r in got] == [r.t for r in got]
        assert got[1].s - got[0].s == 3600
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_day_filter_pushed_to_scan(spark):
    e = table(spark, SF001, "events").where(day_range("ts", "2024-01-05")).select("user_id")
    text = plan_text(e, "formatted")
    assert "PushedFilters" in text and "GreaterThanOrEqual(ts" in text
    assert "ReadSchema: struct<ts:timestamp_ntz,user_id:bigint>" in text


def test_backfill_has_no_cartesian_or_window(spark):
    df = C.q_cumulative_backfill(spark, SF001)
    assert count_nodes(df, "CartesianProduct") == 0 and count_nodes(df, "Window") == 0
    assert count_nodes(df, "BroadcastNestedLoopJoin") == 0


def test_csv_and_layout(spark):
    assert C.q_csv_roundtrip_rows(spark, SF001).count() == table(spark, SF001, "orders").count()
    sizes = C.q_layout_sizes(spark, SF001).collect()
    assert {r.layout for r in sizes} == {"low_cardinality", "low_cardinality_sorted", "high_cardinality"}
    assert all(r.total_bytes > 0 for r in sizes)


def test_stream_equals_batch_on_closed_windows(spark):
    streamed = C.q_stream_tumble_host(spark, SF001)
    raw = windows.parse_event_time(recast.raw_web_events(spark, SF001), "event_time", "event_timestamp")
    wm = raw.agg(F.max("event_timestamp")).first()[0] - dt.timedelta(seconds=15)
    batch = windows.tumbling_counts(raw, "event_timestamp", ["host"], watermark=None)
    closed = batch.where(F.col("event_hour") + F.expr("INTERVAL 5 MINUTES") <= F.lit(wm))
    closed = closed.withColumn("event_hour", F.col("event_hour").cast("timestamp_ntz"))
    assert rows(streamed) == rows(closed.select(*streamed.columns))


def test_sessions_merge_at_gap_and_bad_text(spark):
    base = dt.datetime(2024, 1, 1, 0, 0, 0)
    data = [("1.1.1.1", "h", (base + dt.timedelta(minutes=m)).strftime("%Y-%m-%dT%H:%M:%S.000Z"))
            for m in (0, 5, 10.5, 30)] + [("1.1.1.1", "h", "not a time"), (None, None, "2024-01-01T00:01:00.000Z")]
    df = spark.createDataFrame(data, "ip string, host string, event_time string")
    p = windows.parse_event_time(df, "event_time", "ts")
    s = rows(windows.session_counts(p, "ts", ["ip", "host"], watermark=None)
             .select("ip", "host", "num_hits", F.col("session_start").cast("timestamp_ntz")))
    # 0 and 5 exactly 5 min apart merge; 10.5 is 5.5 min later: new session; NULL ip counts 0
    assert sorted(r[2] for r in s) == [0, 1, 1, 2]


def test_enrichment_address_cases(spark):
    geo = recast.geo_ranges(spark, SF001)
    df = spark.createDataFrame([
        ("10.0.3.7, 172.16.0.1", "h", "r", "/u", dt.datetime(2024, 1, 1)),
        ("  ", "h", "r", "/u", dt.datetime(2024, 1, 1)),
        (None, "h", "r", "/u", dt.datetime(2024, 1, 1)),
        ("10.0.30.1", "h", "r", "/u", dt.datetime(2024, 1, 1)),
        ("garbage", "h", "r", "/u", dt.datetime(2024, 1, 1)),
    ], "ip string, host string, referrer string, url string, event_timestamp timestamp")
    out = [r.geodata for r in windows.enrich_geo(df, geo).collect()]
    assert sorted(out)[0].startswith('{"country":"') and out.count("{}") == 4


def test_scratch_paths_unique(spark):
    a, b = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert a != b and a.startswith(spark.sparkContext.getCheckpointDir().rstrip("/"))


def test_location_udf_from_sql(spark):
    from strata.functions.udfs import register_location_udf
    table_ = {"10.0.0.1": {"country": "X", "state": "S", "city": "C"}}
    register_location_udf(spark, table_.get)
    df = spark.createDataFrame([("10.0.0.1, 1.2.3.4",), ("",), (None,), ("9.9.9.9",)], "ip string")
    df.createOrReplaceTempView("ips")
    got = [r[0] for r in spark.sql("SELECT get_location(ip) FROM ips").collect()]
    assert got == ['{"country": "X", "state": "S", "city": "C"}', "{}", "{}", "{}"]


def test_scan_is_pruned_and_filtered(spark):
    ev = recast.web_events(spark, SF001).where(day_range("event_time", "2024-01-05")).select("user_id")
    text = plan_text(ev, "formatted")
    assert "GreaterThanOrEqual(ts" in text
    assert "ReadSchema: struct<ts:timestamp_ntz,user_id:bigint>" in text


def _write_batches(spark, folder, batches):
    import time as _t
    for i, rows_ in enumerate(batches):
        (spark.createDataFrame(rows_, "ip string, host string, event_time string")
         .coalesce(1).write.mode("append").parquet(f"{folder}/b{i}"))
        _t.sleep(1.1)  # distinct modification times: one file per micro-batch, in order


def test_stream_late_rows_and_cross_batch_sessions(spark):
    """Lateness is judged per window (as in Flink): a row is dropped only when
    the window it falls in has ended at or before the watermark. Spark
    filters late rows with the previous batch's watermark (evicting with the
    current one), so a drop shows from the second batch after the watermark
    passed the window."""
    from strata.streaming import runner
    src = scratch_path(spark, "late-src")
    iso = "2024-01-01T00:{}.000Z".format
    _write_batches(spark, src, [
        [("1.1.1.1", "h", iso("10:00")), ("2.2.2.2", "h", iso("09:00"))],   # watermark -> 09:45
        [("1.1.1.1", "h", iso("09:50")),       # inside the 15 s bound
         ("1.1.1.1", "h", iso("08:00")),       # behind the bound, but its window is still open: kept
         ("2.2.2.2", "h", iso("12:00")),       # extends the open session of 2.2.2.2 (two batches)
         ("3.3.3.3", None, iso("09:58")),      # NULL host counts 0
         ("3.3.3.3", "h", "not a timestamp")],  # unparsable: dropped
        [("5.5.5.5", "h", iso("03:00"))],      # its window [00:00, 00:05) is closed: dropped
        [("9.9.9.9", "h", iso("40:00"))],      # moves the watermark past the windows above
    ])
    schema = spark.read.parquet(f"{src}/b0").schema
    stream = (spark.readStream.schema(schema).option("recursiveFileLookup", "true")
              .option("maxFilesPerTrigger", 1).parquet(src))
    parsed = windows.parse_event_time(stream, "event_time", "ts")
    tum = windows.tumbling_counts(parsed, "ts", ["host"])
    out = spark.read.parquet(runner.run_available_now(tum, scratch_path(spark, "late-tum"),
                                                      scratch_path(spark, "late-tum-ck")))
    got = {(str(r.event_hour)[11:16], r.host): r.num_hits for r in out.collect()}
    assert got == {("00:05", "h"): 3, ("00:10", "h"): 2, ("00:05", None): 0}
    ses = windows.session_counts(parsed, "ts", ["ip", "host"])
    s = spark.read.parquet(runner.run_available_now(ses, scratch_path(spark, "late-ses"),
                                                    scratch_path(spark, "late-ses-ck")))
    by_ip = {r.ip: r.num_hits for r in s.where("host = 'h'").collect()}
    assert by_ip == {"1.1.1.1": 3, "2.2.2.2": 2}


def test_five_csv_inputs_roundtrip(spark):
    dfs = C.match_csv_inputs(spark, SF001)
    assert set(dfs) == set(C.MATCH_SCHEMAS)
    assert dfs["matches"].count() == recast.matches(spark, SF001).count()
    assert rows(dfs["maps"]) == rows(recast.maps(spark, SF001))
    assert dict(dfs["medals_matches_players"].dtypes)["medal_id"] == "bigint"
