"""Storage of a slowly changing dimension as open and closed records.

``open/`` holds the records that may still change, partitioned by the version
they belong to; ``closed/`` those that cannot, partitioned by the period they
end in. A step reads and writes one partition of each: the open records of
the version before and of its own, and the records that it closes. Closed
partitions are never read by a step; a whole version is the union of both,
cut when it is read.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.sources import snapshots

VERSION, CLOSED = "version", "closed_in"


class ScdStore:
    """An SCD table under ``path``; ``columns`` are its records' columns."""

    def __init__(self, spark: SparkSession, path: str, columns: list[str], end_col: str):
        self.spark, self.columns, self.end_col = spark, list(columns), end_col
        self.open_path, self.closed_path = f"{path}/open", f"{path}/closed"

    def seed(self, records: DataFrame, version: int) -> None:
        """Store a whole version, split by the period its records end in."""
        rows = records.select(*self.columns)
        is_open = F.col(self.end_col) == version
        snapshots.write_period(rows.where(is_open).withColumn(VERSION, F.lit(version)), self.open_path, VERSION)
        snapshots.write_period(rows.where(~is_open).withColumn(CLOSED, F.col(self.end_col)), self.closed_path, CLOSED)

    def open_records(self, version: int) -> DataFrame:
        """The open records of a version: one partition."""
        if not snapshots.has_period(self.spark, self.open_path, VERSION, version):
            raise snapshots.MissingPeriod(f"{self.open_path}: version {version} is not stored")
        return snapshots.read_period(self.spark, self.open_path, VERSION, version).select(*self.columns)

    def step(self, version: int, step: Callable[[DataFrame], DataFrame]) -> None:
        """Write ``version`` from the open records of the one before; a
        repeated step replaces what it wrote."""
        out = snapshots.cut_lineage(step(self.open_records(version - 1)))
        rows = out.where("is_open").select(*self.columns).withColumn(VERSION, F.lit(version))
        snapshots.write_period(rows, self.open_path, VERSION)
        ended = out.where("NOT is_open").select(*self.columns).withColumn(CLOSED, F.lit(version - 1))
        snapshots.write_period(ended, self.closed_path, CLOSED)

    def version(self, version: int, current_col: str) -> DataFrame:
        """All records of a version, labelled with it."""
        now = self.open_records(version)
        try:
            old = self.spark.read.parquet(self.closed_path).where(F.col(CLOSED) < version).select(*self.columns)
        except snapshots.AnalysisException as ex:  # nothing closed yet
            if ex.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
                raise
            old = now.limit(0)
        return now.unionByName(old).withColumn(current_col, F.lit(version))
