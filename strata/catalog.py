"""Registered queries: every workload of the reference re-cast onto the
driver's tables (see ``strata.sources.recast``), as ``(spark, sf_dir) ->
DataFrame`` callables. Oracle SQL for each lives in ``strata.oracle``.

Fixed parameters (periods, days, hosts) are chosen for the driver data:
orders span 1995-2001, events span 2024-01-01 .. 2024-01-30.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.functions import udfs
from strata.functions.columns import history_text, tier
from strata.operators import activity, constraints, cumulate, facts, graph, matches, quality, reduced, scd, sqltext
from strata.operators.joins import first_per_key
from strata.plans import layout
from strata.session import scratch_path
from strata.sources import landing, recast, snapshots
from strata.sources.scdstore import ScdStore
from strata.sources.tables import table, to_wall_clock
from strata.streaming import late, runner, sinks, sources, windows

# -- fixed parameters --------------------------------------------------------
FIRST_SEASON, LAST_SEASON = 1995, 2001
FACT_DAY = "1997-08-23"
EVENT_MONTH = "2024-01-01"
SNAPSHOT_DAY = "2024-01-30"
PREV_DAY = "2024-01-29"
HOST_STEP_DAY, HOST_PREV_DAY = "2024-01-15", "2024-01-14"
MEDAL_CLASS = "SMALL"
SESSION_HOST_PATTERN = "%i%"
SESSION_HOSTS = ("view", "click", "error")
BUCKET_BYTES = 8 << 20
BUCKETED = ("match_details", "matches", "medals_matches_players")


def _player_class(c):
    return tier(c, recast.PLAYER_CLASS_CUTS, "bad")


def _actor_class(c):
    return tier(c, recast.ACTOR_CLASS_CUTS, "bad")


# -- players: cumulative table, SCD ------------------------------------------

def players_snapshots(spark: SparkSession, sf: str, last: int = LAST_SEASON, only_last: bool = False) -> DataFrame:
    """The ``players`` cumulative table, snapshots FIRST_SEASON..last."""
    return cumulate.cumulate_backfill(
        recast.player_seasons(spark, sf), ["player_id"], period_col="season", stats_cols=["gp", "pts"],
        first_period=FIRST_SEASON, last_period=last, history_col="season_stats", current_col="current_season",
        classify=_player_class, class_measure="pts", class_col="scoring_class",
        since_col="years_since_last_season", only_last=only_last)


def _players_step(spark: SparkSession, sf: str, season: int, y: DataFrame) -> DataFrame:
    t = recast.player_seasons(spark, sf).where(F.col("season") == season)
    return cumulate.cumulate_step(
        y, t, ["player_id"], period_col="season", stats_cols=["gp", "pts"], history_col="season_stats",
        current_col="current_season", classify=_player_class, class_measure="pts", class_col="scoring_class",
        since_col="years_since_last_season")


def _player_view(snap: DataFrame) -> DataFrame:
    h = F.col("season_stats")
    last = F.element_at(h, -1)
    return snap.select(
        "player_id", F.size(h).alias("n_seasons"), h[0]["season"].alias("first_season"),
        last["season"].alias("last_season"), last["pts"].alias("last_pts"), "scoring_class",
        "years_since_last_season", "current_season", "is_active",
        history_text(h, "season").alias("seasons"))


def q_cumulative_step(spark, sf):
    """Snapshot LAST_SEASON from LAST_SEASON-1 + that season's rows."""
    y = players_snapshots(spark, sf, LAST_SEASON - 1, only_last=True)
    return _player_view(_players_step(spark, sf, LAST_SEASON, y))


def q_cumulative_backfill(spark, sf):
    """Every snapshot in one job."""
    return _player_view(players_snapshots(spark, sf))


def q_history_unnest(spark, sf):
    """C4: history of the last snapshot back to one row per season."""
    snap = players_snapshots(spark, sf, only_last=True)
    return cumulate.unnest_history(snap, ["player_id"], "season_stats")


def q_first_last_ratio(spark, sf):
    """last/first points of 'star' players."""
    snap = players_snapshots(spark, sf, only_last=True).where(F.col("scoring_class") == "star")
    r = cumulate.first_last_ratio(snap, ["player_id"], "pts", history_col="season_stats")
    return r.orderBy(F.desc_nulls_first("improvement"))


def players_scd(spark: SparkSession, sf: str, as_of: int) -> DataFrame:
    return scd.scd_backfill(players_snapshots(spark, sf, as_of), ["player_id"], period_col="current_season",
                            state_cols=["scoring_class", "is_active"], as_of=as_of,
                            start_col="start_season", end_col="end_season", current_col="current_season")


def q_scd_backfill(spark, sf):
    """SCD2 of (scoring_class, is_active) as of LAST_SEASON-1."""
    return players_scd(spark, sf, LAST_SEASON - 1)


def q_scd_incremental(spark, sf):
    """SCD version LAST_SEASON from version LAST_SEASON-1 and the snapshot."""
    return _players_scd_step(players_scd(spark, sf, LAST_SEASON - 1),
                             players_snapshots(spark, sf, LAST_SEASON, only_last=True))


def _players_scd_step(prev: DataFrame, snap: DataFrame) -> DataFrame:
    return scd.scd_incremental(prev, snap, ["player_id"], period=LAST_SEASON, period_col="current_season",
                               state_cols=["scoring_class", "is_active"], start_col="start_season",
                               end_col="end_season", current_col="current_season", retain_missing=False)


def q_scd_single_state(spark, sf):
    """Streaks of one state column, no snapshot label."""
    s = scd.scd_backfill(players_snapshots(spark, sf), ["player_id"], period_col="current_season",
                         state_cols=["scoring_class"], start_col="start_date", end_col="end_date",
                         current_col=None)
    return s


# -- actors: many rows per period ---------------------------------------------

_FILM_COLS = ["film", "votes", "rating", "filmid"]


def actors_snapshots(spark: SparkSession, sf: str, last: int = LAST_SEASON, *, carry_state: bool = False,
                     only_last: bool = False) -> DataFrame:
    return cumulate.cumulate_items_backfill(
        recast.actor_films(spark, sf), ["actorid"], first_period=FIRST_SEASON, last_period=last,
        period_col="year", item_cols=_FILM_COLS, order_col="filmid", measure="rating",
        classify=_actor_class, carry_cols=["actor"], carry_state=carry_state, items_col="films",
        class_col="quality_class", as_of_col="as_of_year", only_last=only_last)


def _actor_view(snap: DataFrame) -> DataFrame:
    return snap.select("actorid", "actor", "as_of_year", F.size("films").alias("n_films"),
                       history_text("films", "filmid").alias("films"), "quality_class", "is_active")


def q_cumulative_multi_step(spark, sf):
    """Actors LAST_SEASON from actors LAST_SEASON-1 and that year's films."""
    last = actors_snapshots(spark, sf, LAST_SEASON - 1, carry_state=True, only_last=True)
    return _actor_view(_actors_step(spark, sf, last))


def _actors_step(spark: SparkSession, sf: str, last: DataFrame) -> DataFrame:
    return cumulate.cumulate_items_step(
        last, recast.actor_films(spark, sf), ["actorid"], period=LAST_SEASON, period_col="year",
        item_cols=_FILM_COLS, order_col="filmid", measure="rating", classify=_actor_class,
        carry_cols=["actor"], items_col="films", class_col="quality_class", as_of_col="as_of_year")


def q_cumulative_multi_backfill(spark, sf):
    """All actor snapshots; class NULL in inactive years."""
    return _actor_view(actors_snapshots(spark, sf))


def actors_states(spark: SparkSession, sf: str, last: int = LAST_SEASON, *, only_last: bool = False) -> DataFrame:
    """The actors' snapshots without their films: what the SCD is made of."""
    return cumulate.cumulate_states_backfill(
        recast.actor_films(spark, sf), ["actorid"], first_period=FIRST_SEASON, last_period=last, period_col="year",
        measure="rating", classify=_actor_class, carry_cols=["actor"], class_col="quality_class", as_of_col="as_of_year",
        only_last=only_last)


def actors_scd(spark: SparkSession, sf: str, as_of: int) -> DataFrame:
    return scd.scd_backfill(actors_states(spark, sf, as_of), ["actorid"], period_col="as_of_year",
                            state_cols=["quality_class", "is_active"], as_of=as_of, carry_cols=["actor"],
                            start_col="start_year", end_col="end_year", current_col="current_year")


def q_scd_backfill_nullsafe(spark, sf):
    """Null-safe SCD2 of actors (NULL class runs merge)."""
    return actors_scd(spark, sf, LAST_SEASON)


def q_scd_incremental_retained(spark, sf):
    """C11: null-safe incremental SCD keeping records of missing actors."""
    return _actors_scd_step(actors_scd(spark, sf, LAST_SEASON - 1),
                            actors_states(spark, sf, LAST_SEASON, only_last=True))


def _actors_scd_step(prev: DataFrame, snap: DataFrame) -> DataFrame:
    return scd.scd_incremental(prev, snap, ["actorid"], period=LAST_SEASON, period_col="as_of_year",
                               state_cols=["quality_class", "is_active"], carry_cols=["actor"],
                               start_col="start_year", end_col="end_year", current_col="current_year",
                               retain_missing=True)


# -- property graph ------------------------------------------------------------

def all_vertices(spark, sf):
    """Typed: every kind's properties are columns, null for other kinds."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), [
        graph.game_vertices(recast.games(spark, sf), typed=True),
        graph.player_vertices(recast.game_details(spark, sf), typed=True),
        graph.team_vertices(recast.teams(spark, sf), typed=True)])


def all_edges(spark, sf):
    d = recast.game_details(spark, sf)
    return graph.plays_in_edges(d, typed=True).unionByName(graph.pair_edges(d, typed=True), allowMissingColumns=True)


def q_vertices_game(spark, sf):
    return graph.game_vertices(recast.games(spark, sf))


def q_vertices_player(spark, sf):
    return graph.player_vertices(recast.game_details(spark, sf))


def q_vertices_team(spark, sf):
    return graph.team_vertices(recast.teams(spark, sf))


def q_vertices_team_map(spark, sf):
    """Team vertices with MAP properties (values exposed by key)."""
    v = graph.team_vertices(recast.teams(spark, sf), as_map=True)
    keys = ["abbreviation", "nickname", "city", "arena", "year_founded"]
    return v.select("identifier", "type", *[F.col("properties")[k].alias(k) for k in keys],
                    F.array_join(F.map_keys("properties"), ",").alias("property_keys"))


def q_vertex_counts(spark, sf):
    return graph.vertex_counts(all_vertices(spark, sf))


def q_edges_plays_in(spark, sf):
    return graph.plays_in_edges(recast.game_details(spark, sf))


def q_edges_pairs(spark, sf):
    return graph.pair_edges(recast.game_details(spark, sf))


def q_edge_max_points(spark, sf):
    # only plays_in edges carry points, and every player of a pair has one
    edges = graph.plays_in_edges(recast.game_details(spark, sf), typed=True)
    return graph.max_edge_points(all_vertices(spark, sf), edges).orderBy(F.desc_nulls_first("max_points"))


def q_edge_games_per_point(spark, sf):
    return graph.games_per_point(all_vertices(spark, sf), all_edges(spark, sf))


def q_edge_points_per_game(spark, sf):
    return graph.points_per_game(all_vertices(spark, sf), all_edges(spark, sf))


# -- facts -----------------------------------------------------------------------

def q_grain_check(spark, sf):
    return facts.grain_violations(recast.game_details(spark, sf), list(facts.GRAIN))


def fact_table(spark, sf, day=None):
    return facts.dedupe_fact(recast.game_details(spark, sf), recast.games(spark, sf), day=day)


def q_fact_dedupe(spark, sf):
    return fact_table(spark, sf)


def q_fact_dedupe_day(spark, sf):
    return fact_table(spark, sf, FACT_DAY)


def q_fact_late_enrich(spark, sf):
    teams = first_per_key(recast.teams(spark, sf), ["team_id"], ["row_order"]).drop("row_order")
    return facts.late_enrich(fact_table(spark, sf), teams, fact_key="dim_team_id", dim_key="team_id")


def q_fact_summary(spark, sf):
    return facts.fact_summary(fact_table(spark, sf)).orderBy(F.desc_nulls_first("bailed_pct"))


def q_event_bounds(spark, sf):
    return facts.event_bounds(table(spark, sf, "events"), "ts")


# -- datelists and bitmaps ---------------------------------------------------------

def _dates_view(df: DataFrame, keys, list_col: str) -> DataFrame:
    return df.select(*keys, history_text(list_col).alias(list_col), "curr_date")


def _events_with_browser(spark, sf):
    # LEFT JOIN devices + browser IS NOT NULL, as in the reference
    e = recast.web_events(spark, sf)
    return e.join(recast.devices(spark, sf), "device_id", "left").where(F.col("browser_type").isNotNull())


def _datelist_step(events: DataFrame, keys, day, prev_day, list_col: str) -> DataFrame:
    y = activity.datelist_snapshot(events, keys, "event_time", prev_day, list_col=list_col)
    t = activity.daily_active(events, keys, "event_time", day)
    return activity.datelist_step(y, t, keys, list_col=list_col)


def q_datelist_user_step(spark, sf):
    """users' date lists, snapshot PREV_DAY advanced to SNAPSHOT_DAY."""
    keys = ["user_id"]
    return _dates_view(_datelist_step(recast.web_events(spark, sf), keys, SNAPSHOT_DAY, PREV_DAY,
                                      "dates_active"), keys, "dates_active")


def q_datelist_device_step(spark, sf):
    """The same per (user, browser) through the device dimension."""
    keys = ["user_id", "browser_type"]
    return _dates_view(_datelist_step(_events_with_browser(spark, sf), keys, SNAPSHOT_DAY, PREV_DAY,
                                      "device_activity_datelist"), keys, "device_activity_datelist")


def q_datelist_host_step(spark, sf):
    """The same per host, on a mid-month day."""
    keys = ["host"]
    return _dates_view(_datelist_step(recast.web_events(spark, sf), keys, HOST_STEP_DAY, HOST_PREV_DAY,
                                      "host_activity_datelist"), keys, "host_activity_datelist")


def users_datelist(spark, sf, day=SNAPSHOT_DAY):
    return activity.datelist_snapshot(recast.web_events(spark, sf), ["user_id"], "event_time", day)


def q_bitmap32_flags(spark, sf):
    """C28 with the snapshot day in bit 31."""
    return activity.bitmap_flags(users_datelist(spark, sf), ["user_id"])


def q_bitmap32_flags_literal(spark, sf):
    """C28 as the reference computes it (exponent 32 - days: snapshot day lost)."""
    return activity.bitmap_flags(users_datelist(spark, sf), ["user_id"], top_bit=32)


def q_bitmap30(spark, sf):
    """30-bit datelist integer per (user, browser)."""
    keys = ["user_id", "browser_type"]
    snap = activity.datelist_snapshot(_events_with_browser(spark, sf), keys, "event_time", SNAPSHOT_DAY,
                                      list_col="device_activity_datelist")
    return activity.datelist_int(snap, keys, list_col="device_activity_datelist")


# -- reduced facts ---------------------------------------------------------------

def _array_text(df: DataFrame, cols) -> DataFrame:
    return df.select(*[history_text(c).alias(c) if c in cols else F.col(c) for c in df.columns])


def user_month_arrays(spark, sf) -> DataFrame:
    ev = recast.web_events(spark, sf)
    return _user_month_step(ev, reduced.month_array_snapshot(ev, ["user_id"], "event_time", PREV_DAY,
                                                             arrays={"metric_array": "num_hits"}))


def _user_month_step(ev: DataFrame, prev: DataFrame) -> DataFrame:
    today = reduced.daily_metrics(ev, ["user_id"], "event_time", SNAPSHOT_DAY)
    return reduced.month_array_step(prev, today, ["user_id"], day=SNAPSHOT_DAY,
                                    metrics={"metric_array": "num_hits"},
                                    extra_cols={"metric_name": F.lit("site_hits")})


def q_reduced_user_month_step(spark, sf):
    """Per-user month array of daily hits, advanced by one day."""
    return _array_text(user_month_arrays(spark, sf), ["metric_array"])


def q_reduced_sum_unnest(spark, sf):
    """Element-wise sum over all users, one row per day."""
    return reduced.elementwise_sum(user_month_arrays(spark, sf), ["metric_name"], "metric_array")


def host_month_arrays(spark, sf) -> DataFrame:
    ev = recast.web_events(spark, sf)
    return _host_month_step(ev, reduced.month_array_snapshot(
        ev, ["host"], "event_time", PREV_DAY, distinct_of="user_id", month_col="month", arrays=HOST_ARRAYS))


HOST_ARRAYS = {"hit_array": "num_hits", "unique_visitors": "unique_visitors"}


def _host_month_step(ev: DataFrame, prev: DataFrame) -> DataFrame:
    today = reduced.daily_metrics(ev, ["host"], "event_time", SNAPSHOT_DAY, distinct_of="user_id")
    return reduced.month_array_step(prev, today, ["host"], day=SNAPSHOT_DAY, month_col="month", metrics=HOST_ARRAYS)


def q_reduced_host_month_step(spark, sf):
    """Per-host month arrays of hits and distinct visitors."""
    return _array_text(host_month_arrays(spark, sf), ["hit_array", "unique_visitors"])


def q_monthly_first_days(spark, sf):
    """First three day-slots summed per month for one partition date."""
    arr = user_month_arrays(spark, sf).withColumn("date_partition", F.lit(SNAPSHOT_DAY))
    return reduced.first_days_sum(arr, month_col="month_start", array_col="metric_array",
                                  partition_col="date_partition", ds=SNAPSHOT_DAY)


# -- the incremental steps from stored snapshots --------------------------------------

def _advanced(spark: SparkSession, table_name: str, period_col: str, seed: DataFrame, step: Callable[[DataFrame], DataFrame],
              *, before, period) -> DataFrame:
    """The stored partition ``period`` of a snapshot table: the snapshot of
    ``before`` is inserted, a run of its own continues from that partition,
    and a re-run replaces what it wrote. Where both are one partition (month
    arrays), the state is checkpointed before it is overwritten."""
    path = scratch_path(spark, table_name)
    snapshots.append_period(seed, path, period_col)
    for _ in range(2):
        snapshots.fold_periods(spark, path, period_col, [period], lambda state, _: step(state),
                               previous=lambda _: before, rewrites_state=before == period)
    return snapshots.read_period(spark, path, period_col, period)


def _stored_players(spark: SparkSession, sf: str) -> DataFrame:
    return _advanced(spark, "players", "current_season",
                     players_snapshots(spark, sf, LAST_SEASON - 1, only_last=True),
                     lambda y: _players_step(spark, sf, LAST_SEASON, y), before=LAST_SEASON - 1, period=LAST_SEASON)


def _stored_actors(spark: SparkSession, sf: str, carry_state: bool) -> DataFrame:
    seed = actors_snapshots(spark, sf, LAST_SEASON - 1, carry_state=carry_state, only_last=True)
    return _advanced(spark, "actors", "as_of_year", seed, lambda y: _actors_step(spark, sf, y),
                     before=LAST_SEASON - 1, period=LAST_SEASON)


def q_stored_cumulative_step(spark, sf):
    """C1, C2 from the stored partition of LAST_SEASON-1."""
    return _player_view(_stored_players(spark, sf))


def q_stored_cumulative_multi_step(spark, sf):
    """C6 from the stored partition of LAST_SEASON-1."""
    return _actor_view(_stored_actors(spark, sf, True))


def q_stored_scd_incremental(spark, sf):
    """C9 from the stored version LAST_SEASON-1 and the stored snapshot."""
    snap = _stored_players(spark, sf)
    out = _advanced(spark, "players-scd", "current_season", players_scd(spark, sf, LAST_SEASON - 1),
                    lambda prev: _players_scd_step(prev, snap), before=LAST_SEASON - 1, period=LAST_SEASON)
    return out.select("player_id", "scoring_class", "is_active", "start_season", "end_season", "current_season")


def q_stored_scd_incremental_retained(spark, sf):
    """C11 from the stored version LAST_SEASON-1."""
    snap = actors_states(spark, sf, LAST_SEASON, only_last=True)
    out = _advanced(spark, "actors-scd", "current_year", actors_scd(spark, sf, LAST_SEASON - 1),
                    lambda prev: _actors_scd_step(prev, snap), before=LAST_SEASON - 1, period=LAST_SEASON)
    return out.select("actorid", "actor", "quality_class", "is_active", "start_year", "end_year", "current_year")


# open and closed SCD records: a step reads the open ones alone

PLAYER_RECORD = ["player_id", "scoring_class", "is_active", "start_season", "end_season"]
ACTOR_RECORD = ["actorid", "actor", "quality_class", "is_active", "start_year", "end_year"]


def q_open_scd_incremental(spark, sf):
    """C9 from stored open records; version LAST_SEASON read back."""
    store = ScdStore(spark, scratch_path(spark, "players-scd-open"), PLAYER_RECORD, "end_season")
    store.seed(players_scd(spark, sf, LAST_SEASON - 1), LAST_SEASON - 1)
    snap = players_snapshots(spark, sf, LAST_SEASON, only_last=True)
    store.step(LAST_SEASON, lambda rows: scd.scd_open_step(
        rows, snap, ["player_id"], period=LAST_SEASON, period_col="current_season", state_cols=["scoring_class", "is_active"],
        start_col="start_season", end_col="end_season", retain_missing=False))
    return store.version(LAST_SEASON, "current_season")


def q_open_scd_incremental_retained(spark, sf):
    """C11 from stored open records, two periods in a row."""
    store = ScdStore(spark, scratch_path(spark, "actors-scd-open"), ACTOR_RECORD, "end_year")
    store.seed(actors_scd(spark, sf, LAST_SEASON - 2), LAST_SEASON - 2)
    for year in (LAST_SEASON - 1, LAST_SEASON):
        snap = actors_states(spark, sf, year, only_last=True)
        store.step(year, lambda rows, snap=snap, year=year: scd.scd_open_step(
            rows, snap, ["actorid"], period=year, period_col="as_of_year", state_cols=["quality_class", "is_active"],
            carry_cols=["actor"], start_col="start_year", end_col="end_year", retain_missing=True))
    return store.version(LAST_SEASON, "current_year")


def q_batched_cumulative_multi(spark, sf):
    """C6 by per-period batches: each year stores its own films with their
    offset and one state a person; the history is cut on read."""
    films, path = recast.actor_films(spark, sf), scratch_path(spark, "actors-batches")
    state = None
    for year in range(FIRST_SEASON, LAST_SEASON + 1):
        rows = snapshots.cut_lineage(cumulate.items_period(
            films, state, ["actorid"], period=year, period_col="year", item_cols=_FILM_COLS, order_col="filmid", measure="rating",
            classify=_actor_class, carry_cols=["actor"], class_col="quality_class", as_of_col="as_of_year"))
        snapshots.write_period(cumulate.batch_of(rows, ["actorid"], as_of_col="as_of_year"), f"{path}/batches", "as_of_year")
        snapshots.write_period(cumulate.state_of(rows), f"{path}/states", "as_of_year")
        state = snapshots.read_period(spark, f"{path}/states", "as_of_year", year)
    out = cumulate.items_as_of(state, spark.read.parquet(f"{path}/batches"), ["actorid"], period=LAST_SEASON, as_of_col="as_of_year",
                               items_col="films")
    return _actor_view(out)


# keyed upsert inside a period

MERGE_BUCKETS = 16


def q_keyed_merge_datelist(spark, sf):
    """The day's date lists are stored from its first half; the
    keys seen in its second half are merged in by key, twice over."""
    keys, events = ["user_id", "browser_type"], _events_with_browser(spark, sf)
    path, day = scratch_path(spark, "keyed-datelist"), dt.date.fromisoformat(SNAPSHOT_DAY)
    noon = F.expr(f"TIMESTAMP_NTZ '{SNAPSHOT_DAY} 12:00:00'")
    col = "device_activity_datelist"
    before = activity.datelist_snapshot(events, keys, "event_time", PREV_DAY, list_col=col)
    first, second = (activity.daily_active(events.where(half), keys, "event_time", SNAPSHOT_DAY)
                     for half in (F.col("event_time") < noon, F.col("event_time") >= noon))
    snapshots.write_keyed(activity.datelist_step(before, first, keys, list_col=col), path, "curr_date", keys, MERGE_BUCKETS)
    late = activity.datelist_step(before.join(second.select(*keys), keys, "left_semi"), second, keys, list_col=col)
    for _ in range(2):
        snapshots.merge_keyed(late, path, "curr_date", day, keys, MERGE_BUCKETS)
    return _dates_view(snapshots.read_keyed(spark, path, "curr_date", day), keys, col)


# state tables of the catalog, stepped by insertInto

def _state_table(spark: SparkSession, kind: str) -> str:
    """A new table of ``kind`` with a name of its own. It stays: a plan over
    a partitioned table looks its partitions up when it runs."""
    path = scratch_path(spark, kind)
    name = path.rsplit("/", 1)[-1].replace("-", "_")
    snapshots.create_table(spark, name, path, kind=kind)
    return name


def q_catalog_scd_single_state(spark, sf):
    """The players table created from its schema, filled
    season by season with insertInto, and its streaks."""
    name = _state_table(spark, "players")
    for season in range(FIRST_SEASON, LAST_SEASON + 1):
        # the table read is the one written: its state is cut off first
        y = snapshots.cut_lineage(spark.table(name).where(F.col("current_season") == season - 1))
        snapshots.insert_period(snapshots.as_table(_players_step(spark, sf, season, y), name), name)
    return scd.scd_backfill(spark.table(name), ["player_id"], period_col="current_season", state_cols=["scoring_class"],
                            start_col="start_date", end_col="end_date", current_col=None)


def q_catalog_user_month_step(spark, sf):
    """The month arrays as a catalog table: the month up to
    the day before is inserted, then read, advanced and overwritten."""
    name, ev = _state_table(spark, "array_metrics"), recast.web_events(spark, sf)
    seed = reduced.month_array_snapshot(ev, ["user_id"], "event_time", PREV_DAY, arrays={"metric_array": "num_hits"})
    snapshots.insert_period(snapshots.as_table(seed.withColumn("metric_name", F.lit("site_hits")), name), name)
    prev = snapshots.cut_lineage(spark.table(name).where(F.col("month_start") == F.lit(dt.date.fromisoformat(EVENT_MONTH))))
    snapshots.insert_period(snapshots.as_table(_user_month_step(ev, prev.drop("metric_name")), name), name)
    return _array_text(spark.table(name).select("user_id", "month_start", "metric_name", "metric_array"), ["metric_array"])


def _stored_datelist(spark: SparkSession, events: DataFrame, keys, day: str, prev_day: str, list_col: str) -> DataFrame:
    def step(y: DataFrame) -> DataFrame:
        return activity.datelist_step(y, activity.daily_active(events, keys, "event_time", day), keys, list_col=list_col)

    seed = activity.datelist_snapshot(events, keys, "event_time", prev_day, list_col=list_col)
    out = _advanced(spark, "datelist", "curr_date", seed, step, before=dt.date.fromisoformat(prev_day),
                    period=dt.date.fromisoformat(day))
    return _dates_view(out, keys, list_col)


def q_stored_datelist_user_step(spark, sf):
    """C27 from the stored partition of PREV_DAY."""
    return _stored_datelist(spark, recast.web_events(spark, sf), ["user_id"], SNAPSHOT_DAY, PREV_DAY, "dates_active")


def q_stored_datelist_device_step(spark, sf):
    """C29 from the stored partition of PREV_DAY."""
    return _stored_datelist(spark, _events_with_browser(spark, sf), ["user_id", "browser_type"], SNAPSHOT_DAY, PREV_DAY,
                            "device_activity_datelist")


def q_stored_datelist_host_step(spark, sf):
    """C31 from the stored partition of HOST_PREV_DAY."""
    return _stored_datelist(spark, recast.web_events(spark, sf), ["host"], HOST_STEP_DAY, HOST_PREV_DAY,
                            "host_activity_datelist")


def q_stored_reduced_user_month_step(spark, sf):
    """C32 from the stored month, whose partition it rewrites."""
    ev, month = recast.web_events(spark, sf), dt.date.fromisoformat(EVENT_MONTH)
    seed = reduced.month_array_snapshot(ev, ["user_id"], "event_time", PREV_DAY, arrays={"metric_array": "num_hits"})
    out = _advanced(spark, "array-metrics", "month_start", seed, lambda prev: _user_month_step(ev, prev),
                    before=month, period=month)
    return _array_text(out.select("user_id", "month_start", "metric_name", "metric_array"), ["metric_array"])


def q_stored_reduced_host_month_step(spark, sf):
    """C34 from the stored month, whose partition it rewrites."""
    ev, month = recast.web_events(spark, sf), dt.date.fromisoformat(EVENT_MONTH)
    seed = reduced.month_array_snapshot(ev, ["host"], "event_time", PREV_DAY, distinct_of="user_id",
                                        month_col="month", arrays=HOST_ARRAYS)
    out = _advanced(spark, "host-activity", "month", seed, lambda prev: _host_month_step(ev, prev),
                    before=month, period=month)
    return _array_text(out.select("host", "month", *HOST_ARRAYS), list(HOST_ARRAYS))


# -- Spark jobs: CSV, bucketing, broadcast, layout ----------------------------------

ORDERS_SCHEMA = T.StructType([
    T.StructField("o_orderkey", T.LongType()), T.StructField("o_custkey", T.LongType()),
    T.StructField("o_orderstatus", T.StringType()), T.StructField("o_totalprice", T.DoubleType()),
    T.StructField("o_orderdate", T.TimestampNTZType()), T.StructField("o_orderpriority", T.StringType())])


def q_csv_roundtrip_rows(spark, sf):
    """Orders written as CSV and read back with an explicit schema."""
    path = layout.write_csv(table(spark, sf, "orders"), scratch_path(spark, "orders-csv"))
    return layout.read_csv(spark, path, ORDERS_SCHEMA)


MATCH_SCHEMAS = {
    "match_details": "match_id bigint, player_gamertag bigint, line_no int, player_total_kills int",
    "matches": "match_id bigint, mapid bigint, playlist_id string, game_mode string",
    "medals_matches_players": "match_id bigint, player_gamertag bigint, line_no int, medal_id bigint",
    "medals": "medal_id bigint, name string, description string, classification string",
    "maps": "mapid bigint, name string, description string",
}


def match_csv_inputs(spark, sf) -> dict[str, DataFrame]:
    """The five match inputs written as CSV and loaded back with
    explicit schemas (no inferSchema pass over the data)."""
    folder = scratch_path(spark, "match-csv")
    for name, build in (("match_details", recast.match_details), ("matches", recast.matches),
                        ("medals_matches_players", recast.medals_matches_players),
                        ("medals", recast.medals), ("maps", recast.maps)):
        layout.write_csv(build(spark, sf), f"{folder}/{name}")
    return layout.read_csv_tables(spark, folder, MATCH_SCHEMAS)


def q_match_csv_rows(spark, sf):
    """What each of the five CSV inputs holds when read back."""
    parts = [df.agg(F.count(F.lit(1)).alias("n_rows"), F.count_distinct(*df.columns).alias("n_distinct"))
             .select(F.lit(name).alias("input"), "n_rows", "n_distinct")
             for name, df in match_csv_inputs(spark, sf).items()]
    return reduce(DataFrame.unionByName, parts)


def bucketed_match_tables(spark, sf) -> dict[str, str]:
    """The three match facts bucketed on match_id, by name; the bucket
    count follows from the bytes of the largest input. Each run has tables of
    its own."""
    size = layout.stored_bytes(spark, f"{sf.rstrip('/')}/lineitem.parquet").first()["total_bytes"]
    buckets = layout.bucket_count(size, BUCKET_BYTES)
    out = {}
    for name in BUCKETED:
        path = scratch_path(spark, f"bucketed-{name}")
        out[name] = path.rsplit("/", 1)[-1].replace("-", "_")
        layout.write_bucketed(getattr(recast, name)(spark, sf), out[name], path, "match_id", buckets)
    return out


def q_bucket_join(spark, sf):
    """Bucketed fact joins + broadcast dimensions.

    The second fact join is on ``match_id`` plus line keys; letting the
    ``match_id`` buckets satisfy it (co-partitioning on a subset of the
    join keys) keeps the whole fact join free of ``Exchange``. The setting
    that allows it holds in a session of the query's own.
    """
    tables = bucketed_match_tables(spark, sf)
    own = spark.newSession()
    for key in ("spark.sql.shuffle.partitions", "spark.sql.session.timeZone"):
        own.conf.set(key, spark.conf.get(key))
    own.conf.set("spark.sql.requireAllClusterKeysForCoPartition", "false")
    b = {name: own.table(t) for name, t in tables.items()}
    joined = matches.join_match_facts(b["match_details"], b["matches"], b["medals_matches_players"],
                                      recast.medals(own, sf), recast.maps(own, sf))
    for t in tables.values():  # the plan holds the files and their buckets; the names are not needed any more
        spark.sql(f"DROP TABLE {t}")
    return joined


def q_avg_per_player(spark, sf):
    return matches.ranking(matches.avg_kills_per_player(recast.match_details(spark, sf)), "avg_kills",
                           ["player_gamertag"])


def q_top_ten_players(spark, sf):
    """O3: the ten best of C38."""
    return matches.top(matches.avg_kills_per_player(recast.match_details(spark, sf)), "avg_kills",
                       ["player_gamertag"], 10)


def q_top_playlist(spark, sf):
    return matches.ranking(matches.plays_per_playlist(recast.matches(spark, sf)), "num_played", ["playlist_id"])


def q_top_map(spark, sf):
    return matches.ranking(matches.plays_per_map(recast.matches(spark, sf), recast.maps(spark, sf)),
                           "num_played", ["map_name"])


def q_medal_per_map(spark, sf):
    m = matches.medals_per_map(recast.medals_matches_players(spark, sf), recast.medals(spark, sf),
                               recast.matches(spark, sf), recast.maps(spark, sf), value=MEDAL_CLASS)
    return matches.ranking(m, "num_medals", ["map_name"])


def q_layout_sizes(spark, sf):
    """Three layouts of the matches table and their sizes."""
    paths = layout.partition_experiment(recast.matches(spark, sf), "playlist_id", "mapid",
                                        scratch_path(spark, "layout"))
    return layout.layout_bytes(spark, paths)


def q_layout_shares(spark, sf):
    """Of each layout of the matches table how its rows, as stored, are
    spread over the partition folders, and which layout takes most bytes."""
    paths = layout.partition_experiment(recast.matches(spark, sf), "playlist_id", "mapid", scratch_path(spark, "layout"))
    return layout.layout_shares(spark, paths, {"low_cardinality": "playlist_id", "low_cardinality_sorted": "playlist_id", "high_cardinality": "mapid"})


def q_layout_contents(spark, sf):
    """Both experiments (by playlist and by map) read back: rows and
    distinct values of each layout."""
    out = []
    for low, high in (("playlist_id", "mapid"), ("mapid", "playlist_id")):
        paths = layout.partition_experiment(recast.matches(spark, sf), low, high, scratch_path(spark, "layout"))
        got = layout.layout_contents(spark, paths, ["match_id", "playlist_id", "mapid"])
        out.append(got.withColumn("layout", F.concat(F.lit(f"{low}:"), F.col("layout"))))
    return reduce(DataFrame.unionByName, out)


# -- streaming ---------------------------------------------------------------------

def _raw_stream(spark, sf) -> DataFrame:
    src = runner.file_stream(spark, sf, "events.parquet")
    return windows.parse_event_time(recast.raw_from_events(src), "event_time", "event_timestamp")


def _run(spark, stream: DataFrame, name: str) -> DataFrame:
    sink = scratch_path(spark, f"{name}-sink")
    # state partitions sized to the cores at hand for this bounded replay
    parts = 2 * spark.sparkContext.defaultParallelism
    runner.run_available_now(stream, sink, scratch_path(spark, f"{name}-ckpt"), state_partitions=parts)
    return spark.read.parquet(sink)


def q_stream_enrich(spark, sf):
    """Enriched events, event time as ISO text (a text sink)."""
    s = windows.enrich_geo(_raw_stream(spark, sf), recast.geo_ranges(spark, sf))
    s = s.withColumn("event_timestamp", windows.iso_text("event_timestamp"))
    return _run(spark, s, "enrich")


def q_stream_enrich_typed(spark, sf):
    """Enriched events, typed event time (a JDBC-style sink)."""
    s = windows.enrich_geo(_raw_stream(spark, sf), recast.geo_ranges(spark, sf))
    return to_wall_clock(_run(spark, s, "enrich-typed"), "event_timestamp")


def q_geo_nested_lookup(spark, sf):
    """Addresses looked up in nested ranges from a /8 to a /32, some not
    aligned; the smallest range counts."""
    e = windows.enrich_geo(recast.raw_web_events(spark, sf), recast.geo_nested(spark, sf), ts_col="event_time")
    return e.groupBy("ip", "geodata").agg(F.count(F.lit(1)).alias("n_events"))


def q_sql_location_udf(spark, sf):
    """A vectorised lookup registered as a function and called from
    SQL, over the nations' address ranges."""
    name = f"get_location_{uuid.uuid4().hex[:8]}"
    find = udfs.range_finder(recast.geo_ranges(spark, sf), "ip_start", "ip_end", ["country", "state", "city"])
    udfs.register_location_udf(spark, find, name, compact=True)
    return spark.sql(f"SELECT {name}(ip) AS geodata, host, count(*) AS n_events FROM {{events}} GROUP BY ALL", events=recast.raw_web_events(spark, sf))


def q_stream_tumble_host(spark, sf):
    """5-minute tumbling hits per host, 15 s watermark, closed windows."""
    s = windows.tumbling_counts(_raw_stream(spark, sf), "event_timestamp", ["host"])
    return to_wall_clock(_run(spark, s, "tumble-host"), "event_hour")


def q_stream_tumble_host_referrer(spark, sf):
    """The same per (host, referrer)."""
    s = windows.tumbling_counts(_raw_stream(spark, sf), "event_timestamp", ["host", "referrer"])
    return to_wall_clock(_run(spark, s, "tumble-host-ref"), "event_hour")


def q_stream_sessions(spark, sf):
    """5-minute-gap sessions per (ip, host), closed sessions."""
    s = windows.session_counts(_raw_stream(spark, sf), "event_timestamp", ["ip", "host"])
    return to_wall_clock(_run(spark, s, "sessions"), "session_start", "session_end")


# JSON event files that arrive in chunks; one chunk is one micro-batch

def _events_of(lines: DataFrame) -> DataFrame:
    good, _ = sources.split_corrupt(sources.parse_json(lines))
    return windows.parse_event_time(good, "event_time", "event_timestamp")


def q_stream_json_source(spark, sf):
    """JSON lines from many files, some malformed, in bounded
    micro-batches; good rows counted by host, corrupt lines on their own."""
    folder, sink = scratch_path(spark, "json-events"), scratch_path(spark, "json-sink")
    for k in range(landing.CHUNKS):
        landing.write_event_chunk(spark, sf, folder, k, malformed=True, files=2)
    parsed = sources.parse_json(sources.json_files(spark, folder, max_files_per_trigger=3))
    shape = {"good": lambda b: windows.parse_event_time(sources.split_corrupt(b)[0], "event_time", "event_timestamp"),
             "corrupt": lambda b: sources.split_corrupt(b)[1]}
    runner.run_foreach_batch(parsed, sinks.fan_out({n: (f"{sink}/{n}", f) for n, f in shape.items()}), scratch_path(spark, "json-ckpt"))
    good = sinks.read_epochs(spark, f"{sink}/good").groupBy(F.lit("good").alias("status"), "host").agg(
        F.count(F.lit(1)).alias("n_rows"), F.count("event_timestamp").alias("n_timed"), F.count_distinct("url").alias("n_urls"))
    bad = sinks.read_epochs(spark, f"{sink}/corrupt").groupBy(F.lit("corrupt").alias("status"), F.lit(None).cast("string").alias("host")).agg(
        F.count(F.lit(1)).alias("n_rows"), F.lit(0).cast("long").alias("n_timed"), F.count_distinct(sources.CORRUPT).alias("n_urls"))
    return good.unionByName(bad)


LATE_SIZE, LATE_DELAY = "5 minutes", "15 seconds"


def q_stream_late_ledger(spark, sf):
    """Tumbling counts over micro-batches with late rows: the windows
    that closed, those still in state, the late rows by epoch, and how many
    grouped rows the query says it dropped."""
    folder = scratch_path(spark, "late-events")
    for k in range(landing.CHUNKS):
        landing.write_event_chunk(spark, sf, folder, k, delayed=True)
    sink, side, ckpt = (scratch_path(spark, f"late-{n}") for n in ("windows", "ledger", "ckpt"))

    def events() -> DataFrame:
        return _events_of(sources.json_files(spark, folder, max_files_per_trigger=1))

    counts = windows.tumbling_counts(events(), "event_timestamp", ["host"], size=LATE_SIZE, watermark=LATE_DELAY)
    dropped = late.follow(runner.start_parquet_sink(counts, sink, ckpt, trigger="available_now",
                                                    state_partitions=2 * spark.sparkContext.defaultParallelism))
    writer = late.ledger_writer("event_timestamp", late.seconds(LATE_SIZE), late.seconds(LATE_DELAY), f"{side}/late", f"{side}/highs")
    runner.run_foreach_batch(events(), writer, f"{ckpt}-ledger")
    rows = sinks.read_epochs(spark, f"{side}/late").groupBy("epoch", F.window("event_timestamp", LATE_SIZE).alias("w"), "host").agg(F.count("host").alias("num_hits"))
    none = F.lit(None)
    shown = [df.select(F.lit(kind).alias("kind"), epoch.cast("long").alias("epoch"), "event_hour", "host", F.col("num_hits").cast("long").alias("num_hits"))
             for kind, epoch, df in (("closed", none, spark.read.parquet(sink)), ("open", none, late.open_windows(spark, ckpt, ["host"])),
                                     ("late", F.col("epoch"), rows.withColumn("event_hour", F.col("w.start"))))]
    said = spark.createDataFrame([(e, n) for e, n in dropped.items() if n], "epoch long, num_hits long")
    shown.append(said.select(F.lit("dropped").alias("kind"), "epoch", none.cast("timestamp").alias("event_hour"), none.cast("string").alias("host"), "num_hits"))
    return to_wall_clock(reduce(DataFrame.unionByName, shown), "event_hour")


class Interrupted(RuntimeError):
    """A sink that fails on purpose."""


def q_stream_two_sinks(spark, sf):
    """Enriched events to a sink of JSON values and to a typed one
    from one read. The second sink fails once, after the first has written
    epoch 1; the query starts again and that epoch replaces itself."""
    folder = scratch_path(spark, "two-events")
    for k in range(landing.CHUNKS):
        landing.write_event_chunk(spark, sf, folder, k)
    to, ckpt = scratch_path(spark, "two-sinks"), scratch_path(spark, "two-ckpt")
    ranges, tries = recast.geo_ranges(spark, sf), []

    def typed(batch: DataFrame) -> DataFrame:
        tries.append(1)
        if len(tries) == 2:
            raise Interrupted("the typed sink fails in its second epoch")
        return batch

    def as_values(batch: DataFrame) -> DataFrame:
        return runner.kafka_value(batch.withColumn("event_timestamp", windows.iso_text("event_timestamp")), key_col="ip")

    writer = sinks.fan_out({"values": (f"{to}/values", as_values), "typed": (f"{to}/typed", typed)})
    for attempt in range(2):
        events = windows.enrich_geo(_events_of(sources.json_files(spark, folder, max_files_per_trigger=1)), ranges)
        try:
            runner.run_foreach_batch(events, writer, ckpt)
        except Exception as ex:  # noqa: BLE001 - the first run ends by the failure above
            if attempt or "second epoch" not in str(ex):
                raise
    read = F.from_json("value", "host string, geodata string, url string")
    values = sinks.read_epochs(spark, f"{to}/values").select("epoch", read.alias("v")).select("epoch", "v.*")
    out = [df.groupBy(F.lit(n).alias("sink"), "epoch", "host").agg(F.count(F.lit(1)).alias("n_rows"), F.count_distinct("url").alias("n_urls"), F.count_if(F.col("geodata") != "{}").alias("n_located"))
           for n, df in (("values", values), ("typed", sinks.read_epochs(spark, f"{to}/typed")))]
    return reduce(DataFrame.unionByName, out)


def q_stream_sessions_restart(spark, sf):
    """The session query is stopped after each chunk of files, with
    sessions open in its state, and started again from its checkpoint."""
    folder, sink, ckpt = (scratch_path(spark, f"restart-{n}") for n in ("events", "sink", "ckpt"))
    for k in range(landing.CHUNKS):
        landing.write_event_chunk(spark, sf, folder, k)
        s = windows.session_counts(_events_of(sources.json_files(spark, folder)), "event_timestamp", ["ip", "host"])
        runner.run_available_now(s, sink, ckpt, state_partitions=2 * spark.sparkContext.defaultParallelism)
    return to_wall_clock(spark.read.parquet(sink), "session_start", "session_end")


def batch_sessions(spark, sf) -> DataFrame:
    """Batch twin of C51 over the whole table (no watermark: every session)."""
    raw = windows.parse_event_time(recast.raw_web_events(spark, sf), "event_time", "event_timestamp")
    return windows.session_counts_batch(raw, "event_timestamp", ["ip", "host"])


def q_session_long_gap(spark, sf):
    """C51 with a one-day gap per address: sessions that merge many events."""
    raw = windows.parse_event_time(recast.raw_web_events(spark, sf), "event_time", "event_timestamp")
    s = windows.session_counts_batch(raw, "event_timestamp", ["ip"], gap_seconds=86_400)
    return to_wall_clock(s, "session_start", "session_end")


def q_session_avg_like(spark, sf):
    """Average hits per session over hosts matching a pattern."""
    return windows.session_avg_matching(batch_sessions(spark, sf), host_pattern=SESSION_HOST_PATTERN)


def q_session_by_host(spark, sf):
    """Sessions and average hits for three hosts."""
    return (windows.sessions_by_host(batch_sessions(spark, sf), SESSION_HOSTS)
            .orderBy(F.desc_nulls_first("avg_events_per_session")))


# -- the SQL-text jobs (temp view + spark.sql with bound parameters) -------------------

def q_sql_monthly_first_days(spark, sf):
    """C44 in SQL form over the users' month arrays."""
    arr = user_month_arrays(spark, sf).withColumn("date_partition", F.lit(SNAPSHOT_DAY))
    return sqltext.first_days_sum(arr, month_col="month_start", array_col="metric_array",
                                  partition_col="date_partition", ds=SNAPSHOT_DAY)


def q_sql_player_streaks(spark, sf):
    """C45 in SQL form over every player snapshot."""
    out = sqltext.streaks(players_snapshots(spark, sf), key="player_id", period_col="current_season",
                          state_col="scoring_class", start_col="start_date", end_col="end_date")
    return out.withColumnRenamed("player_id", "player_name")


def q_sql_team_vertices(spark, sf):
    """C46 in SQL form (MAP properties, values exposed by key)."""
    v = sqltext.map_vertices(recast.teams(spark, sf), key="team_id", kind="team", order_col="row_order",
                             properties={"abbreviation": "abbreviation", "nickname": "nickname", "city": "city",
                                         "arena": "arena", "year_founded": "yearfounded"})
    keys = ["abbreviation", "nickname", "city", "arena", "year_founded"]
    return v.select(F.col("identifier").cast("string").alias("identifier"), "type",
                    *[F.col("properties")[k].alias(k) for k in keys],
                    F.array_join(F.map_keys("properties"), ",").alias("property_keys"))


# -- data quality -------------------------------------------------------------------

def q_quality_violations(spark, sf):
    """Key, not-null, enum and CHECK violations as one table."""
    gd = recast.game_details(spark, sf)
    ids = ["game_id", "player_id", "line_no"]
    ha = host_month_arrays(spark, sf)
    return quality.violations(
        quality.assert_unique(gd, list(facts.GRAIN)),
        quality.assert_not_null(gd, ["min"], ids),
        quality.assert_domain(gd, "start_position", ["F", "C", "G"], ids, allow_null=False),
        quality.assert_check(ha, (F.col("month") == F.trunc("month", "month"))
                             & (F.size("hit_array") == F.size("unique_visitors")), ["host"],
                             "host_activity_reduced_checks"))


AUDITED = ("vertices", "edges", "players_scd", "host_activity_reduced")


def q_constraint_audit(spark, sf):
    """All declared constraints of the graph, SCD and month tables
    as they land: keys, not-null, domains, checks and references."""
    return constraints.audit({t: getattr(landing, t)(spark, sf) for t in AUDITED})


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    name[2:]: fn for name, fn in sorted(globals().items()) if name.startswith("q_") and callable(fn)
}

# Queries whose result is not a deterministic function of the data
# (file sizes depend on the writer): checked on row count only.
ROWS_ONLY = ("layout_sizes",)
