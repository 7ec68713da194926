"""Running a stream to completion over files (tests and bounded replays).

Sources: a Parquet file stream with a fixed schema. Sinks: Parquet files
(append mode) with a checkpoint folder, or ``foreachBatch`` for sinks
without native streaming support (JDBC). On a cluster both paths are on
shared storage, so a restarted query resumes from its checkpoint.
"""

from __future__ import annotations

import threading
from collections.abc import Callable, Iterator, Mapping
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def file_stream(spark: SparkSession, folder: str, file_name: str, *,
                max_files_per_trigger: int | None = None) -> DataFrame:
    """Stream the Parquet files ``folder/file_name`` (a glob; schema read
    once). ``max_files_per_trigger`` bounds a micro-batch."""
    schema = spark.read.parquet(f"{folder.rstrip('/')}/{file_name}").schema
    r = spark.readStream.schema(schema).option("pathGlobFilter", file_name)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.parquet(folder)


_STARTING = threading.Lock()


@contextmanager
def _state_partitions(spark: SparkSession, n: int | None) -> Iterator[None]:
    """The number of state-store partitions of a query that is started
    inside. Spark reads it from the session when a query first starts (and
    keeps it in the checkpoint), so it is set for that moment only, one query
    at a time; a query that runs has a copy of the session's settings."""
    key = "spark.sql.shuffle.partitions"
    with _STARTING:
        before = spark.conf.get(key)
        if n:
            spark.conf.set(key, str(n))
        try:
            yield
        finally:
            spark.conf.set(key, before)


def run_available_now(stream: DataFrame, sink_path: str, checkpoint_path: str, *,
                      output_mode: str = "append", state_partitions: int | None = None) -> str:
    """Process everything available, write Parquet to ``sink_path``, stop.
    ``state_partitions``: see :func:`start_parquet_sink`."""
    q = start_parquet_sink(stream, sink_path, checkpoint_path, trigger="available_now", output_mode=output_mode,
                           state_partitions=state_partitions)
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))
    return sink_path


def run_foreach_batch(stream: DataFrame, write_batch: Callable[[DataFrame, int], None],
                      checkpoint_path: str) -> None:
    """Process everything available through ``write_batch(df, epoch_id)``
    (e.g. ``df.write.jdbc(...)``); idempotent writers make retries safe."""
    q = (stream.writeStream.foreachBatch(write_batch).option("checkpointLocation", checkpoint_path)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))


def kafka_source_options(bootstrap: str, topic: str, *, starting: str = "latest",
                         sasl_jaas: str | None = None) -> dict[str, str]:
    """``readStream.format("kafka")`` options for the reference's sources
    (the Kafka connector jar must be on the classpath)."""
    opts = {"kafka.bootstrap.servers": bootstrap, "subscribe": topic, "startingOffsets": starting}
    if sasl_jaas:
        opts.update({"kafka.security.protocol": "SASL_SSL", "kafka.sasl.mechanism": "PLAIN",
                     "kafka.sasl.jaas.config": sasl_jaas})
    return opts


def start_parquet_sink(stream: DataFrame, sink_path: str, checkpoint_path: str, *,
                       trigger: str = "10 seconds", output_mode: str = "append",
                       name: str | None = None, state_partitions: int | None = None) -> StreamingQuery:
    """Long-running form: a micro-batch every ``trigger`` (the reference
    checkpoints every 10 s; ``"available_now"`` drains and stops), state
    and offsets in ``checkpoint_path``. ``state_partitions`` fixes the
    state-store partition count of a new query (kept in its checkpoint)."""
    w = (stream.writeStream.format("parquet").outputMode(output_mode)
         .option("checkpointLocation", checkpoint_path))
    w = w.trigger(availableNow=True) if trigger == "available_now" else w.trigger(processingTime=trigger)
    if name:
        w = w.queryName(name)
    with _state_partitions(stream.sparkSession, state_partitions):
        return w.start(sink_path)


def start_many(streams: Mapping[str, DataFrame], sink_root: str, checkpoint_root: str, *,
               trigger: str = "10 seconds") -> dict[str, StreamingQuery]:
    """Several sinks fed from one source (T9): one query per output, each
    with its own checkpoint; they share the source definition."""
    return {n: start_parquet_sink(s, f"{sink_root}/{n}", f"{checkpoint_root}/{n}", trigger=trigger, name=n)
            for n, s in streams.items()}


def kafka_value(df: DataFrame, key_col: str | None = None) -> DataFrame:
    """Rows as JSON ``value`` (and optional ``key``) for a Kafka sink
    (``writeStream.format("kafka")``; connector jar required)."""
    cols = [F.to_json(F.struct(*[F.col(c) for c in df.columns])).alias("value")]
    if key_col:
        cols.insert(0, F.col(key_col).cast("string").alias("key"))
    return df.select(*cols)


def jdbc_batch_writer(url: str, table: str, properties: Mapping[str, str]) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` function for a JDBC sink (the reference's PostgreSQL
    tables). Spark repeats a failed batch with the same ``epoch_id``, so each
    epoch is a staging table of its own, ``<table>__epoch_<id>``, that a
    repeated batch replaces; the database moves staged epochs on."""
    def write(batch: DataFrame, epoch_id: int) -> None:
        batch.write.mode("overwrite").jdbc(url, f"{table}__epoch_{epoch_id}", properties=dict(properties))
    return write
