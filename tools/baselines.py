"""
numbers). Not part of the library.

Each case has inputs that are stored once, a plain plan over them (cross
joins, theta joins, a join a branch, a scan a rule, windows over whole rows,
text properties) and the library's plan over the same files. Only the plans
are timed, and both give the same rows (``tools/check_baselines.py``).
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strata import catalog as C
from strata.operators import activity, constraints, cumulate, facts, graph, reduced, scd
from strata.operators.joins import first_per_key, range_lookup
from strata.session import scratch_path
from strata.sources import landing, recast
from strata.streaming import windows

Inputs = dict[str, DataFrame]


@dataclass(frozen=True)
class Case:
    inputs: Callable[[SparkSession, str], Inputs]
    plain: Callable[[Inputs], DataFrame]
    ours: Callable[[Inputs], DataFrame]

    def stored(self, spark: SparkSession, sf: str) -> Inputs:
        out = {}
        for name, df in self.inputs(spark, sf).items():
            path = scratch_path(spark, f"baseline-{name}")
            df.write.parquet(path)
            out[name] = spark.read.schema(df.schema).parquet(path)
        return out


def _days(spark: SparkSession, n: int, last: str) -> DataFrame:
    return spark.range(n).select(F.date_sub(F.lit(last).cast("date"), F.col("id").cast("int")).alias("day"))


def _bits_by_cross_join(i: Inputs) -> DataFrame:
    users = i["users"]
    every = users.crossJoin(_days(users.sparkSession, 32, C.SNAPSHOT_DAY))
    bit = F.when(F.array_contains("dates_active", F.col("day")), F.expr("shiftleft(1L, 31 - datediff(curr_date, day))")).otherwise(F.lit(0))
    return every.groupBy("user_id").agg(F.sum(bit).alias("bits"))


def _backfill_by_theta_join(i: Inputs) -> DataFrame:
    ps = i["seasons"]
    years = ps.sparkSession.range(C.FIRST_SEASON, C.LAST_SEASON + 1).select(F.col("id").cast("int").alias("year"))
    past = years.join(ps, F.col("season").between(C.FIRST_SEASON, F.col("year")))
    return past.groupBy("player_id", "year").agg(F.count(F.lit(1)).alias("n"), F.max_by("pts", "season").alias("pts"))


def _backfill(i: Inputs) -> DataFrame:
    snap = cumulate.cumulate_backfill(i["seasons"], ["player_id"], period_col="season", stats_cols=["gp", "pts"], first_period=C.FIRST_SEASON, last_period=C.LAST_SEASON, history_col="h", current_col="year")
    return snap.select("player_id", "year", F.size("h").cast("long").alias("n"), F.element_at("h", -1)["pts"].alias("pts"))


STATE = ["scoring_class", "is_active"]
RECORD = ["player_id", *STATE, "start_season", "end_season"]


def _scd_by_a_join_a_branch(i: Inputs) -> DataFrame:
    p = C.LAST_SEASON
    open_ = i["version"].where(F.col("end_season") == p - 1).alias("o")
    now = i["snapshot"].alias("n")
    same = reduce(lambda a, b: a & b, [F.col(f"o.{c}").eqNullSafe(F.col(f"n.{c}")) for c in STATE])
    key = F.col("o.player_id") == F.col("n.player_id")
    fresh = [F.lit(p).alias(c) for c in ("start_season", "end_season")]
    branches = [
        i["version"].where(F.col("end_season") < p - 1).select(*RECORD),
        open_.join(now, key & same).select("o.player_id", *[f"n.{c}" for c in STATE], "o.start_season", F.lit(p).alias("end_season")),
        open_.join(now, key & ~same).select(*[f"o.{c}" for c in RECORD]),
        open_.join(now, key & ~same).select("n.player_id", *[f"n.{c}" for c in STATE], *fresh),
        now.join(open_, key, "left_anti").select("player_id", *STATE, *fresh),
    ]
    return reduce(DataFrame.union, branches)


def _scd(i: Inputs) -> DataFrame:
    return C._players_scd_step(i["version"], i["snapshot"]).select(*RECORD)


def _scd_open(i: Inputs) -> DataFrame:
    p = C.LAST_SEASON
    return scd.scd_open_step(i["version"].where(F.col("end_season") == p - 1), i["snapshot"], ["player_id"], period=p, period_col="current_season", state_cols=STATE, start_col="start_season", end_col="end_season", retain_missing=False).select(*RECORD)


def _scd_open_by_a_join_a_branch(i: Inputs) -> DataFrame:
    return _scd_by_a_join_a_branch(i).where(F.col("end_season") >= C.LAST_SEASON - 1)


def _streaks_by_self_join(i: Inputs) -> DataFrame:
    s = i["snapshots"].select("player_id", "current_season", "scoring_class")
    before = s.select("player_id", (F.col("current_season") + 1).alias("current_season"), F.col("scoring_class").alias("was"), F.lit(True).alias("known"))
    begins = s.join(before, ["player_id", "current_season"], "left").where(F.col("known").isNull() | ~F.col("was").eqNullSafe(F.col("scoring_class")))
    starts = begins.select("player_id", "scoring_class", F.col("current_season").alias("start_date"))
    run = s.alias("s").join(starts.alias("b"), (F.col("s.player_id") == F.col("b.player_id")) & (F.col("s.current_season") >= F.col("b.start_date")))
    at = run.groupBy("s.player_id", "s.current_season").agg(F.max("b.start_date").alias("start_date"))
    ends = at.groupBy("player_id", "start_date").agg(F.max("current_season").alias("end_date"))
    return starts.join(ends, ["player_id", "start_date"]).select("player_id", "scoring_class", "start_date", "end_date")


def _dedupe_by_window(i: Inputs) -> DataFrame:
    order = Window.partitionBy(*facts.GRAIN).orderBy("line_no", "part_no")
    return i["details"].withColumn("k", F.row_number().over(order)).where("k = 1").drop("k")


def _sum_by_position(i: Inputs) -> DataFrame:
    return i["arrays"].select("metric_name", F.posexplode("metric_array").alias("k", "v")).groupBy("metric_name", "k").agg(F.sum("v").alias("value"))


def _sum_elements(i: Inputs) -> DataFrame:
    out = reduced.elementwise_sum(i["arrays"], ["metric_name"], "metric_array")
    return out.select("metric_name", F.datediff("date", F.lit(C.EVENT_MONTH).cast("date")).alias("k"), "value")


def _ratio_by_json(i: Inputs) -> DataFrame:
    return graph.points_per_game(graph.player_vertices(i["details"]), graph.pair_edges(i["details"]))


def _ratio(i: Inputs) -> DataFrame:
    return graph.points_per_game(graph.player_vertices(i["details"], typed=True), graph.pair_edges(i["details"], typed=True))


def _audit_by_scans(i: Inputs) -> DataFrame:
    text = lambda cols: F.array_join(F.array(*[F.col(c).cast("string") for c in cols]), "|", "null")
    out = []
    for t, df in i.items():
        r = constraints.declared(t)
        said = lambda rows, name, key, t=t: rows.groupBy(text(key).alias("key")).agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(t).alias("table_name"), F.lit(name).alias("constraint"), "key", "n_rows")
        whole = df.dropna(subset=list(r.key))
        out.append(said(whole, "unique", r.key).where("n_rows > 1"))
        out += [said(df.where(bad), name, r.key) for name, bad in r.row_conditions().items()]
        for name, (cols, parent) in r.references.items():
            p = i[parent].select(*[F.col(c).alias(f"p{k}") for k, c in enumerate(constraints.declared(parent).key)])
            missing = df.join(p, reduce(lambda a, b: a & b, [F.col(c) == F.col(f"p{k}") for k, c in enumerate(cols)]), "left_anti")
            out.append(said(missing.dropna(subset=list(cols)), f"references({name})", cols))
    return reduce(DataFrame.union, out)


def _geo_by_bounds(i: Inputs) -> DataFrame:
    met = i["ips"].join(i["ranges"], F.col("v").between(F.col("ip_start"), F.col("ip_end")), "left")
    rank = Window.partitionBy("v").orderBy(F.col("ip_end") - F.col("ip_start"), "ip_start")
    return met.withColumn("k", F.row_number().over(rank)).where("k = 1").select("v", "country", "city")


def _sessions_by_lag(i: Inputs) -> DataFrame:
    order = Window.partitionBy("ip").orderBy("event_timestamp")
    new = F.lag("event_timestamp").over(order).isNull() | (F.unix_micros("event_timestamp") - F.unix_micros(F.lag("event_timestamp").over(order)) > 86_400_000_000)
    named = i["events"].withColumn("new", new.cast("int")).withColumn("session", F.sum("new").over(order))
    return named.groupBy("ip", "session").agg(F.count("ip").alias("num_hits")).select("ip", "num_hits")


def _datelist_by_regrouping(i: Inputs) -> DataFrame:
    days = i["yesterday"].select("user_id", F.explode("dates_active").alias("day")).union(i["today"].select("user_id", F.to_date("event_time")))
    return days.groupBy("user_id").agg(F.sort_array(F.collect_set("day"), asc=False).alias("dates_active"))


def _datelist(i: Inputs) -> DataFrame:
    return activity.datelist_step(i["yesterday"], activity.daily_active(i["today"], ["user_id"], "event_time", C.SNAPSHOT_DAY), ["user_id"], list_col="dates_active").select("user_id", "dates_active")


def _version(spark: SparkSession, sf: str) -> Inputs:
    return {"version": C.players_scd(spark, sf, C.LAST_SEASON - 1), "snapshot": C.players_snapshots(spark, sf, only_last=True)}


def _details(spark: SparkSession, sf: str) -> Inputs:
    return {"details": recast.game_details(spark, sf)}


def _addresses(spark: SparkSession, sf: str) -> Inputs:
    from strata.functions.columns import first_address, ipv4_to_long
    e = recast.raw_web_events(spark, sf).withColumn("_a", first_address("ip"))
    return {"ips": e.select(ipv4_to_long("_a").alias("v")).where("v IS NOT NULL").distinct(), "ranges": recast.geo_nested(spark, sf)}


def _timed_events(spark: SparkSession, sf: str) -> Inputs:
    return {"events": windows.parse_event_time(recast.raw_web_events(spark, sf), "event_time", "event_timestamp")}


def _two_days(spark: SparkSession, sf: str) -> Inputs:
    ev = recast.web_events(spark, sf).where("user_id IS NOT NULL")
    day = F.expr(f"TIMESTAMP_NTZ '{C.SNAPSHOT_DAY} 00:00:00'")
    return {"yesterday": activity.datelist_snapshot(ev, ["user_id"], "event_time", C.PREV_DAY, list_col="dates_active"),
            "today": ev.where((F.col("event_time") >= day) & (F.col("event_time") < F.date_add(F.lit(C.SNAPSHOT_DAY).cast("date"), 1)))}


CASES: dict[str, Case] = {
    "bitmap32": Case(lambda s, sf: {"users": C.users_datelist(s, sf)}, _bits_by_cross_join, lambda i: activity.bitmap_flags(i["users"], ["user_id"]).select("user_id", F.col("activity_bits").alias("bits"))),
    "cumulative_backfill": Case(lambda s, sf: {"seasons": recast.player_seasons(s, sf)}, _backfill_by_theta_join, _backfill),
    "scd_incremental": Case(_version, _scd_by_a_join_a_branch, _scd),
    "scd_open_step": Case(_version, _scd_open_by_a_join_a_branch, _scd_open),
    "scd_single_state": Case(lambda s, sf: {"snapshots": C.players_snapshots(s, sf)}, _streaks_by_self_join, lambda i: scd.scd_backfill(i["snapshots"], ["player_id"], period_col="current_season", state_cols=["scoring_class"], start_col="start_date", end_col="end_date", current_col=None)),
    "fact_dedupe": Case(_details, _dedupe_by_window, lambda i: first_per_key(i["details"], list(facts.GRAIN), ["line_no", "part_no"])),
    "reduced_sum_unnest": Case(lambda s, sf: {"arrays": C.user_month_arrays(s, sf)}, _sum_by_position, _sum_elements),
    "edge_points_per_game": Case(_details, _ratio_by_json, _ratio),
    "constraint_audit": Case(lambda s, sf: {t: getattr(landing, t)(s, sf) for t in C.AUDITED}, _audit_by_scans, constraints.audit),
    "geo_nested_lookup": Case(_addresses, _geo_by_bounds, lambda i: range_lookup(i["ips"], "v", i["ranges"], "ip_start", "ip_end").select("v", "country", "city")),
    "session_long_gap": Case(_timed_events, _sessions_by_lag, lambda i: windows.session_counts_batch(i["events"], "event_timestamp", ["ip"], gap_seconds=86_400).select("ip", "num_hits")),
    "datelist_user_step": Case(_two_days, _datelist_by_regrouping, _datelist),
}
