"""JSON event source (S10, T1): lines of JSON from files or a broker's
``value`` column, parsed against a fixed schema in permissive mode.

A line that does not parse keeps its text in :data:`CORRUPT` and has no
fields; :func:`split_corrupt` sends such lines their own way, so that one
bad line neither stops a micro-batch nor vanishes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

CORRUPT = "_corrupt_record"

#: What a web event carries.
EVENT_SCHEMA = "url string, referrer string, user_agent string, host string, ip string, headers string, event_time string"


def json_files(spark: SparkSession, folder: str, *, max_files_per_trigger: int | None = None) -> DataFrame:
    """Stream of the lines of ``folder``'s text files as ``value``, in the
    order in which the files were written. ``max_files_per_trigger`` bounds
    a micro-batch."""
    r = spark.readStream.option("recursiveFileLookup", "true").option("pathGlobFilter", "*.txt*")
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.text(folder)


def parse_json(df: DataFrame, schema: str = EVENT_SCHEMA, value_col: str = "value") -> DataFrame:
    """The fields of ``schema`` and :data:`CORRUPT` (null where the line
    parsed), from the JSON text of ``value_col`` (bytes are read as UTF-8:
    a broker's value)."""
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    parsed = F.from_json(F.col(value_col).cast("string"), f"{schema}, {CORRUPT} string", options)
    return df.select(parsed.alias("_j")).select("_j.*")


def split_corrupt(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(good rows without the corrupt column, corrupt lines)."""
    bad = F.col(CORRUPT).isNotNull()
    return df.where(~bad).drop(CORRUPT), df.where(bad).select(CORRUPT)
