"""Reading the input tables.

Tables are Parquet; reading them through ``spark.read.parquet`` keeps
column pruning and filter pushdown in the scan. Nothing here touches data
eagerly.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = ("region", "nation", "customer", "supplier", "part", "orders",
          "lineitem", "events")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One input table as a lazily scanned DataFrame."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def to_wall_clock(df: DataFrame, *cols: str) -> DataFrame:
    """Instants as UTC wall-clock ``timestamp_ntz`` columns, so results read
    the same whatever the session time zone is."""
    zone = F.current_timezone()
    return df.withColumns({c: F.convert_timezone(zone, F.lit("UTC"), F.to_timestamp_ntz(F.col(c))) for c in cols})


def day_range(ts_col: str, day) -> F.Column:
    """Half-open ``[day, day + 1)`` predicate on a timestamp column.

    Written as a range rather than ``to_date(ts) = day`` so the comparison
    reaches the Parquet reader as a pushed filter.
    """
    start = F.lit(day).cast("date")
    return (F.col(ts_col) >= start.cast("timestamp_ntz")) & \
           (F.col(ts_col) < F.date_add(start, 1).cast("timestamp_ntz"))
