"""Several sinks from one read, written by epoch.

``foreachBatch`` hands every sink the same persisted micro-batch, so the
source is read and parsed once however many sinks there are. Each sink puts
an epoch in a folder of its own and replaces it as a whole: when a query
fails between two sinks and starts again from its checkpoint, the repeated
epoch overwrites what the first try left behind, and no row is there twice.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

Shape = Callable[[DataFrame], DataFrame]


def write_epoch(df: DataFrame, path: str, epoch: int) -> None:
    """Replace one epoch of a sink."""
    df.write.mode("overwrite").parquet(f"{path.rstrip('/')}/epoch={epoch}")


def read_epochs(spark: SparkSession, path: str) -> DataFrame:
    """All epochs of a sink, with the ``epoch`` of each row."""
    return spark.read.option("basePath", path).parquet(f"{path.rstrip('/')}/epoch=*").withColumn("epoch", F.col("epoch").cast("long"))


def fan_out(sinks: Mapping[str, tuple[str, Shape]]) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function that writes the batch, shaped by each
    sink's function, to each sink's folder."""

    def write(batch: DataFrame, epoch: int) -> None:
        batch.persist()
        try:
            for path, shape in sinks.values():
                write_epoch(shape(batch), path, epoch)
        finally:
            batch.unpersist()

    return write
