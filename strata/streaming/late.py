"""A ledger of late rows next to windowed counts.

A stateful query drops rows that come after the watermark has passed their
window, and only counts them. The ledger is a second query over the same
source with the same micro-batches: it keeps the highest event time of each
epoch, derives the watermark that the stateful query applies, and writes the
rows that this drops to a side table by epoch. Kept and late rows add up to
the input, and the ledger can be held against the dropped counts in the
query's progress.

Spark judges the rows of an epoch by the watermark with which the epoch
before it closed windows, that is by the event times of all epochs up to two
back.
"""

from __future__ import annotations

import datetime as dt
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from strata.streaming.sinks import write_epoch


def watermark_before(spark: SparkSession, highs: str, epoch: int, delay_ms: int) -> int | None:
    """Watermark (ms) that judges the rows of ``epoch``, or None."""
    if epoch < 2:
        return None
    high = spark.read.parquet(f"{highs}/epoch={epoch - 2}").first().high
    return None if high is None else max(0, high - delay_ms)


def ledger_writer(ts_col: str, size_seconds: int, delay_seconds: int, late: str, highs: str):
    """``foreachBatch`` function: late rows and the highest event time so far
    of each epoch. A repeated epoch replaces itself."""

    def write(batch: DataFrame, epoch: int) -> None:
        spark = batch.sparkSession
        size = F.lit(size_seconds * 1000)
        at = F.unix_millis(F.col(ts_col))
        end = at - F.pmod(at, size) + size
        mark = watermark_before(spark, highs, epoch, 1000 * delay_seconds)
        write_epoch(batch.where(end <= F.lit(mark)) if mark is not None else batch.limit(0), late, epoch)
        high = batch.agg(F.max(at).alias("high"))
        if epoch:
            high = high.union(spark.read.parquet(f"{highs}/epoch={epoch - 1}").select("high")).agg(F.max("high").alias("high"))
        write_epoch(high, highs, epoch)

    return write


def follow(query: StreamingQuery, poll: float = 0.2) -> dict[int, int]:
    """Wait for a bounded query to end; dropped rows of its stateful
    operators by epoch, from its progress (grouped rows: Spark combines the
    rows of a window and key before it looks at the watermark)."""
    dropped: dict[int, int] = {}

    def read() -> None:
        for p in query.recentProgress:
            dropped[p["batchId"]] = sum(o["numRowsDroppedByWatermark"] for o in p["stateOperators"])

    while query.isActive:
        read()
        time.sleep(poll)
    query.awaitTermination()
    read()
    return dropped


def open_windows(spark: SparkSession, checkpoint: str, keys: list[str], *, start_col: str = "event_hour",
                 out_col: str = "num_hits") -> DataFrame:
    """Windows that a stopped counting query still holds in its state."""
    state = spark.read.format("statestore").option("path", checkpoint).load()
    count = F.col("value").getField("count")
    named = state.select("key.*", count.alias(out_col))
    window = named.columns[0]
    return named.select(F.col(f"`{window}`.start").alias(start_col), *[F.col(k) for k in keys], out_col)


def seconds(delay: str) -> int:
    """Length of an interval such as ``15 seconds`` or ``5 minutes``."""
    n, unit = delay.split()
    return int(dt.timedelta(**{unit if unit.endswith("s") else unit + "s": int(n)}).total_seconds())
