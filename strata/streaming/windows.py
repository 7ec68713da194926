"""Event-time stream operators.

The same functions take a streaming or a batch DataFrame: the batch twin
is how results are checked. Event time must be ``TimestampType`` for a
watermark; text is parsed with ``try_to_timestamp`` so a malformed value
becomes NULL (and the row is dropped by the window) instead of failing the
micro-batch.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strata.functions.columns import first_address, ipv4_to_long
from strata.operators.joins import range_lookup

#: ISO-8601 with milliseconds; ``X`` reads and writes the zone itself, so
#: text ending in ``Z`` is UTC whatever the session time zone is.
ISO_MILLIS_Z = "yyyy-MM-dd'T'HH:mm:ss.SSSX"


def parse_event_time(df: DataFrame, text_col: str, out_col: str, pattern: str = ISO_MILLIS_Z) -> DataFrame:
    """Add ``out_col`` (timestamp) parsed from ``text_col``; NULL if it does not parse."""
    return df.withColumn(out_col, F.try_to_timestamp(F.col(text_col), F.lit(pattern)))


def enrich_geo(df: DataFrame, geo_ranges: DataFrame, *, ip_col: str = "ip",
               ts_col: str = "event_timestamp") -> DataFrame:
    """Attach ``{country, state, city}`` JSON looked up by IP.

    The first address of a comma list is used; blank, unparsable or
    unmatched addresses give ``{}``; where ranges are nested the smallest one
    counts. The lookup is one stream-static equi-join for each prefix length
    of the ranges (JVM only, no per-row service call). ``ts_col`` stays typed; :func:`iso_text` gives
    the text form for a text sink.
    """
    clean = df.withColumn("_ip", first_address(ip_col)).withColumn("_ipn", ipv4_to_long("_ip"))
    joined = range_lookup(clean, "_ipn", geo_ranges, "ip_start", "ip_end")
    geo = F.when(F.col("country").isNotNull(),
                 F.to_json(F.struct("country", "state", "city"))).otherwise(F.lit("{}"))
    return joined.select(F.col(ip_col).alias("ip"), F.col(ts_col).alias("event_timestamp"),
                         "referrer", "host", "url", geo.alias("geodata"))


def iso_text(col: str) -> F.Column:
    """Timestamp as ISO-8601 UTC text with milliseconds and ``Z``, the format
    the downstream jobs parse back (the reference writes a format they
    cannot)."""
    utc = F.convert_timezone(F.current_timezone(), F.lit("UTC"), F.to_timestamp_ntz(F.col(col)))
    # as text by a cast: date_format would read the wall clock in the session zone
    millis = F.lpad(F.pmod(F.unix_millis(F.col(col)), F.lit(1000)).cast("string"), 3, "0")
    return F.concat(F.replace(F.substring(utc.cast("string"), 1, 19), F.lit(" "), F.lit("T")), F.lit("."), millis, F.lit("Z"))


def tumbling_counts(df: DataFrame, ts_col: str, keys: Sequence[str], *, size: str = "5 minutes",
                    watermark: str | None = "15 seconds", count_col: str = "host",
                    start_col: str = "event_hour", out_col: str = "num_hits") -> DataFrame:
    """Per tumbling window and keys, ``count(count_col)``.

    ``start_col`` holds the window start (named ``event_hour`` in the
    reference although the window is 5 minutes). Rows behind the watermark
    are dropped; in append mode a window is emitted once the watermark
    passes its end.
    """
    src = df.withWatermark(ts_col, watermark) if watermark else df
    g = src.groupBy(F.window(ts_col, size).alias("w"), *keys).agg(F.count(count_col).alias(out_col))
    return g.select(F.col("w.start").alias(start_col), *keys, out_col)


def session_counts(df: DataFrame, ts_col: str, keys: Sequence[str], *, gap: str = "5 minutes",
                   watermark: str | None = "15 seconds", count_col: str = "ip",
                   out_col: str = "num_hits") -> DataFrame:
    """Session windows with an inactivity ``gap`` per keys."""
    src = df.withWatermark(ts_col, watermark) if watermark else df
    g = src.groupBy(F.session_window(ts_col, gap).alias("w"), *keys).agg(F.count(count_col).alias(out_col))
    return g.select(F.col("w.start").alias("session_start"), F.col("w.end").alias("session_end"),
                    *keys, out_col)


def session_counts_batch(df: DataFrame, ts_col: str, keys: Sequence[str], *, gap_seconds: int = 300,
                         count_col: str = "ip", out_col: str = "num_hits") -> DataFrame:
    """C51 over a whole table, safe for hot keys: equal to
    :func:`session_counts` without a watermark.

    Events of one key that fall in one slot of ``gap_seconds`` are less than
    the gap apart, so they belong to one session: they are reduced to first,
    last and count before the shuffle. Only slots in use are then put in
    order per key, at most the time span over the gap whatever the number of
    events. Rows without an event time are dropped; a null key is a key.
    """
    keys, gap = list(keys), gap_seconds * 1_000_000
    slots = (df.where(F.col(ts_col).isNotNull()).withColumn("_us", F.unix_micros(ts_col))
             .groupBy(*keys, (F.col("_us") - F.pmod("_us", F.lit(gap))).alias("_slot"))
             .agg(F.min("_us").alias("_first"), F.max("_us").alias("_last"), F.count(count_col).alias("_hits")))
    order = Window.partitionBy(*keys).orderBy("_slot")
    apart = F.col("_first") - F.lag("_last").over(order) > F.lit(gap)
    named = slots.withColumn("_new", F.coalesce(apart, F.lit(True)).cast("int")).withColumn("_session", F.sum("_new").over(order))
    g = named.groupBy(*keys, "_session").agg(F.min("_first").alias("_first"), F.max("_last").alias("_last"),
                                             F.sum("_hits").alias(out_col))
    return g.select(F.timestamp_micros("_first").alias("session_start"),
                    F.timestamp_micros(F.col("_last") + F.lit(gap)).alias("session_end"), *keys, out_col)


def session_avg_matching(sessions: DataFrame, *, host_pattern: str) -> DataFrame:
    """Average hits per session over hosts matching a LIKE pattern."""
    return (sessions.where(F.col("host").like(host_pattern))
            .agg(F.avg("num_hits").alias("avg_events_per_session")))


def sessions_by_host(sessions: DataFrame, hosts: Sequence[str]) -> DataFrame:
    """Sessions and average hits per session for some hosts."""
    return (sessions.where(F.col("host").isin(list(hosts))).groupBy("host")
            .agg(F.count(F.lit(1)).alias("num_sessions"), F.avg("num_hits").alias("avg_events_per_session")))
