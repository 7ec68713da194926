"""Match analytics over bucketed facts and broadcast dimensions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def join_match_facts(details: DataFrame, matches: DataFrame, medals_players: DataFrame,
                     medals: DataFrame, maps: DataFrame, *,
                     medal_keys: Sequence[str] = ("match_id", "player_gamertag", "line_no")) -> DataFrame:
    """The wide match table.

    Facts are merged on ``match_id`` (shuffle-free when all three are
    bucketed on it with the same bucket count); dimensions are pruned and
    renamed, and Spark broadcasts them by their size in bytes. Medals are
    joined to the detail lines with the same ``medal_keys`` instead of to
    every line of the match; where these keys repeat, so do the rows.
    """
    md = medals.select("medal_id", F.col("name").alias("medal_name"),
                       F.col("description").alias("medal_description"), "classification")
    mp = maps.select("mapid", F.col("name").alias("map_name"), F.col("description").alias("map_description"))
    return (details.join(matches.hint("merge"), "match_id")
                   .join(medals_players.hint("merge"), list(medal_keys))
                   .join(md, "medal_id")
                   .join(mp, "mapid"))


def avg_kills_per_player(details: DataFrame) -> DataFrame:
    """Average kills per player."""
    return details.groupBy("player_gamertag").agg(F.avg("player_total_kills").alias("avg_kills"))


def plays_per_playlist(matches: DataFrame) -> DataFrame:
    """Matches per playlist."""
    return matches.groupBy("playlist_id").agg(F.count("match_id").alias("num_played"))


def plays_per_map(matches: DataFrame, maps: DataFrame) -> DataFrame:
    """Matches per map name. Matches are counted per map id before the
    join, so the join sees one row a map."""
    counted = matches.groupBy("mapid").agg(F.count("match_id").alias("n"))
    named = counted.join(maps.select("mapid", F.col("name").alias("map_name")), "mapid")
    return named.groupBy("map_name").agg(F.sum("n").alias("num_played"))


def medals_per_map(medals_players: DataFrame, medals: DataFrame, matches: DataFrame, maps: DataFrame, *,
                   column: str = "classification", value: str = "KillingSpree") -> DataFrame:
    """Medals of one class per map.

    The medal filter is applied to the small side before the large join,
    and the per-player detail table stays out (it would multiply rows).
    """
    md = medals.where(F.col(column) == value).select("medal_id")
    per_map = (medals_players.join(md, "medal_id")
               .join(matches.select("match_id", "mapid"), "match_id")
               .groupBy("mapid").agg(F.count("medal_id").alias("n")))
    named = per_map.join(maps.select("mapid", F.col("name").alias("map_name")), "mapid")
    return named.groupBy("map_name").agg(F.sum("n").alias("num_medals"))


def ranking(df: DataFrame, order_col: str, tie_cols: Sequence[str]) -> DataFrame:
    """All rows by ``order_col`` desc, ties broken by ``tie_cols``."""
    return df.orderBy(F.col(order_col).desc(), *[F.col(c).asc() for c in tie_cols])


def top(df: DataFrame, order_col: str, tie_cols: Sequence[str], n: int) -> DataFrame:
    """The first ``n`` rows of the ranking (a ``TakeOrderedAndProject``:
    per-partition top-n, then a merge)."""
    return ranking(df, order_col, tie_cols).limit(n)
