"""Tables as they land before any cleaning: the stand-in inputs of the audit,
merge and stream jobs. Each only gives rows in the schema its job expects;
repeats, gaps and values out of order are in it, as in any raw load."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.sources.tables import table


def vertices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Games, players and one row per supplier for its team (so teams
    repeat); open orders come with an unknown type."""
    o, s = table(spark, sf_dir, "orders"), table(spark, sf_dir, "supplier")
    kind = F.when(F.col("o_orderstatus") == "P", F.lit("match")).otherwise(F.lit("game"))
    games = o.select(F.col("o_orderkey").cast("string").alias("identifier"), kind.alias("type"))
    players = s.select(F.col("s_suppkey").cast("string").alias("identifier"), F.lit("player").alias("type"))
    teams = s.select(F.col("s_nationkey").cast("string").alias("identifier"), F.lit("team").alias("type"))
    return games.unionByName(players).unionByName(teams).withColumn("properties", F.lit(None).cast("string"))


def edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One edge per box-score line: pairs of player and game repeat, some
    have no object or an unknown edge type, and point to unknown games."""
    li = table(spark, sf_dir, "lineitem")
    kind = F.when((F.col("l_returnflag") == "R") & (F.col("l_linenumber") == 7), F.lit("watches")).otherwise(F.lit("plays_in"))
    game = F.when((F.col("l_linenumber") == 6) & (F.col("l_returnflag") == "A"), F.lit(None)).otherwise(F.col("l_orderkey"))
    return li.select(F.col("l_suppkey").cast("string").alias("subject_identifier"), F.lit("player").alias("subject_type"),
                     game.cast("string").alias("object_identifier"), F.lit("game").alias("object_type"), kind.alias("edge_type"),
                     F.lit(None).cast("string").alias("properties"))


def players_scd(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Validity intervals by order: some end before they start or after the
    snapshot, some classes are unknown or null."""
    o, year = table(spark, sf_dir, "orders"), F.year("o_orderdate")
    kind = F.element_at(F.array(*[F.lit(x) for x in ("star", "good", "average", "bad", "great", None)]), (F.col("o_orderkey") % 6 + 1).cast("int"))
    return o.select(F.col("o_custkey").alias("player_id"), kind.alias("scoring_class"), (F.col("o_orderstatus") == "F").alias("is_active"),
                    year.alias("start_season"), (year + F.col("o_orderkey") % 5 - 1).cast("int").alias("end_season"), F.lit(2001).alias("current_season"))


def host_activity_reduced(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Month arrays by event: some not dated to a month's first day, some of
    unequal lengths, some without an array."""
    e, i = table(spark, sf_dir, "events"), F.col("event_id")
    day = F.to_date("ts")
    hits = F.when(i % 17 != 0, F.array_repeat(F.lit(1).cast("long"), (i % 4).cast("int")))
    seen = F.array_repeat(F.lit(1).cast("long"), (i % 4 + F.when(i % 13 == 0, 1).otherwise(0)).cast("int"))
    return e.select(F.concat("event_type", F.lit("-"), (F.col("user_id") % 50).cast("string")).alias("host"),
                    F.when(i % 11 == 0, day).otherwise(F.trunc(day, "month")).alias("month"), hits.alias("hit_array"), seen.alias("unique_visitors"))


#: Event days of one chunk of the landed event files.
CHUNK_DAYS, CHUNKS = 5, 6


def arrival(*, delayed: bool) -> F.Column:
    """Chunk that an event arrives in: by its day; with ``delayed`` every
    tenth one comes one to three chunks later."""
    by_day = F.least(F.floor((F.dayofmonth("ts") - 1) / CHUNK_DAYS), F.lit(CHUNKS - 1))
    later = F.when(F.col("event_id") % 10 == 0, 1 + F.col("event_id") % 3).otherwise(0) if delayed else F.lit(0)
    return F.least(by_day + later, F.lit(CHUNKS - 1)).cast("int")


def write_event_chunk(spark: SparkSession, sf_dir: str, folder: str, chunk: int, *, delayed: bool = False,
                      malformed: bool = False, files: int = 1) -> None:
    """One chunk of raw web events as ``files`` files of JSON lines; with
    ``malformed`` every 101st line is cut off."""
    from strata.sources.recast import raw_from_events
    e = table(spark, sf_dir, "events").withColumn("_chunk", arrival(delayed=delayed)).where(F.col("_chunk") == chunk)
    raw = raw_from_events(e, "event_id")
    line = F.to_json(F.struct(*[c for c in raw.columns if c != "event_id"]))
    line = F.when(F.col("event_id") % 101 == 0, F.substring(line, 1, 25)).otherwise(line) if malformed else line
    raw.select(line.alias("value")).repartition(files).write.text(f"{folder}/chunk={chunk}")
