"""Fact modelling: grain checks, deduplicated fact loads, late enrichment,
summaries (C21-C26)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.functions.columns import clock_minutes
from strata.operators.joins import first_per_key

GRAIN = ("game_id", "team_id", "player_id")


def grain_violations(df: DataFrame, keys: Sequence[str], count_col: str = "n") -> DataFrame:
    """Key combinations that occur more than once, with their count."""
    return (df.groupBy(*keys).agg(F.count(F.lit(1)).alias(count_col))
              .where(F.col(count_col) > 1))


def _flag(comment: Column, code: str) -> Column:
    return F.coalesce(F.locate(code, comment), F.lit(0)) > 0


def dedupe_fact(details: DataFrame, games: DataFrame, *, day=None,
                measures: Sequence[str] = ("pts", "reb", "ast"),
                order_by: Sequence[str] = ("line_no", "part_no")) -> DataFrame:
    """The deduplicated player-game fact.

    One line per (game, team, player), first by ``order_by`` (the
    reference orders by the game date, constant within a game, so an
    explicit tie-break decides). Flags from the comment codes, played time
    from ``"MM:SS"`` with blank / NULL / missing parts read as 0, and the
    ``dim_`` / ``m_`` naming.

    Full load: dedupe first (map-side combined), then join the games
    header. Single day (``day``): the filtered header is joined first, which
    cuts the detail rows before the dedupe.
    """
    hdr = games.select("game_id", "game_date_est", "season", "home_team_id")
    if day is not None:
        hdr = hdr.where(F.col("game_date_est") == F.lit(day).cast("date"))
        joined = details.join(hdr, "game_id")
        d = first_per_key(joined, list(GRAIN), list(order_by))
    else:
        d = first_per_key(details, list(GRAIN), list(order_by)).join(hdr, "game_id")
    comment = F.col("comment")
    return d.select(
        F.col("game_date_est").alias("dim_game_date"),
        F.col("season").alias("dim_season"),
        F.col("team_id").alias("dim_team_id"),
        F.col("player_id").alias("dim_player_id"),
        F.col("player_name").alias("dim_player_name"),
        F.col("start_position").alias("dim_start_position"),
        (F.col("team_id") == F.col("home_team_id")).alias("dim_is_playing_at_home"),
        _flag(comment, "DNP").alias("dim_did_not_play"),
        _flag(comment, "DND").alias("dim_did_not_dress"),
        _flag(comment, "NWT").alias("dim_not_with_team"),
        clock_minutes("min").alias("m_minutes"),
        *[F.col(m).alias(f"m_{m}") for m in measures])


def late_enrich(fact: DataFrame, dim: DataFrame, *, fact_key: str, dim_key: str) -> DataFrame:
    """Join dimension attributes to the fact at query time (no hint:
    Spark broadcasts the dimension if its bytes allow it)."""
    return fact.join(dim, fact[fact_key] == dim[dim_key])


def fact_summary(fact: DataFrame) -> DataFrame:
    """Per player and home/away: games, points, not-with-team count/ratio."""
    bailed = F.count_if(F.col("dim_not_with_team"))
    n = F.count(F.lit(1))
    return fact.groupBy("dim_player_name", "dim_is_playing_at_home").agg(
        n.alias("num_games"), F.sum("m_pts").alias("total_points"),
        bailed.alias("bailed_num"), (bailed.cast("double") / n).alias("bailed_pct"))


def event_bounds(events: DataFrame, ts_col: str) -> DataFrame:
    """Latest and earliest event time."""
    return events.agg(F.max(ts_col).alias("max_event_time"), F.min(ts_col).alias("min_event_time"))
