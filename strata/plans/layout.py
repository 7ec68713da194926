"""Physical layout: bucketed tables, partitioned writes, on-disk sizes
(C35, C36, C42, C43)."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


# Options that bring every value back: quotes double, blanks and line breaks
# stay, and NULL has a marker of its own next to the empty string.
CSV_OPTIONS = {"header": True, "escape": '"', "multiLine": True, "nullValue": "\x01NULL",
               "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}


def write_csv(df: DataFrame, path: str, *, rows_per_file: int = 1_000_000) -> str:
    """Write ``df`` as CSV with a header row. A file with line breaks in its
    values is read by one task, so files are kept to ``rows_per_file``."""
    df.write.mode("overwrite").options(**CSV_OPTIONS).option("maxRecordsPerFile", rows_per_file).csv(path)
    return path


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    """CSV with header. An explicit schema avoids the extra pass that
    ``inferSchema`` makes over the whole input."""
    r = spark.read.options(**CSV_OPTIONS)
    return r.schema(schema).csv(path) if schema is not None else r.option("inferSchema", True).csv(path)


def read_csv_tables(spark: SparkSession, folder: str, schemas: dict[str, T.StructType | str]) -> dict[str, DataFrame]:
    """Load several CSV inputs (``folder/<name>``) with explicit schemas."""
    return {name: read_csv(spark, f"{folder.rstrip('/')}/{name}", schema) for name, schema in schemas.items()}


def stored_bytes(spark: SparkSession, path: str) -> DataFrame:
    """Files and bytes below a path from the file listing alone (no data is
    read), whatever storage the path is on."""
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", True)
             .option("pathGlobFilter", "*.parquet").load(path).select("length"))
    return files.agg(F.coalesce(F.sum("length"), F.lit(0)).alias("total_bytes"), F.count(F.lit(1)).alias("num_files"))


def bucket_count(total_bytes: int, bucket_bytes: int = 8 << 20, least: int = 4, most: int = 1 << 16) -> int:
    """Buckets of at most ``bucket_bytes`` each, as a power of two (tables of
    different size then still join without a full shuffle). A task of a join
    sorts a whole bucket of every table, as rows that take many times their
    stored bytes. Spark allows 100,000 buckets; beyond ``most`` they grow,
    and sorts spill."""
    need = max(least, -(-total_bytes // bucket_bytes))
    return min(most, 1 << (need - 1).bit_length())


def write_bucketed(df: DataFrame, table_name: str, path: str, key: str | Sequence[str],
                   buckets: int, sort: bool = True, cluster: bool = True) -> DataFrame:
    """Write ``df`` as an external table bucketed (and sorted) on
    ``key`` and read it back through the catalog.

    Two tables bucketed on the join key with the same bucket count join
    without an ``Exchange``; sorting each bucket lets the sort-merge join
    skip its sort too. ``cluster`` first hash-partitions the rows on the
    bucket key into ``buckets`` partitions (Spark's bucket hash), so each
    bucket is written by one task as one file instead of one file per
    writing task and bucket.
    """
    keys = [key] if isinstance(key, str) else list(key)
    if cluster:
        df = df.repartition(buckets, *keys)
    w = df.write.mode("overwrite").bucketBy(buckets, *keys)
    if sort:
        w = w.sortBy(*keys)
    w.option("path", path).saveAsTable(table_name)
    return df.sparkSession.table(table_name)


def partition_experiment(df: DataFrame, low_card_col: str, high_card_col: str, base: str) -> dict[str, str]:
    """The same rows in three layouts; returns layout name → path.

    * ``low_cardinality``: partitioned by a low-cardinality column;
    * ``low_cardinality_sorted``: same, rows clustered and sorted first,
      which compresses better;
    * ``high_cardinality``: partitioned by a high-cardinality column.

    Clustering uses range partitioning on (low, high) rather than hash
    partitioning on the low-cardinality column alone: rows of one value
    stay together and sorted, but a value holding a large share of the
    table is cut into many tasks instead of landing in one.
    """
    paths = {k: f"{base}/{k}" for k in ("low_cardinality", "low_cardinality_sorted", "high_cardinality")}
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    df.write.mode("overwrite").partitionBy(low_card_col).parquet(paths["low_cardinality"])
    (df.repartitionByRange(parts, low_card_col, high_card_col).sortWithinPartitions(low_card_col, high_card_col)
       .write.mode("overwrite").partitionBy(low_card_col).parquet(paths["low_cardinality_sorted"]))
    (df.repartitionByRange(parts, high_card_col, low_card_col)
       .write.mode("overwrite").partitionBy(high_card_col).parquet(paths["high_cardinality"]))
    return paths


def layout_bytes(spark: SparkSession, paths: dict[str, str]) -> DataFrame:
    """Total file bytes per layout, from the file listing."""
    parts = [stored_bytes(spark, p).select(F.lit(name).alias("layout"), "total_bytes", "num_files")
             for name, p in paths.items()]
    return reduce(DataFrame.unionByName, parts)


def layout_shares(spark: SparkSession, paths: dict[str, str], partition_cols: dict[str, str]) -> DataFrame:
    """Rows of each partition folder of each layout with their share of the
    layout's rows, and whether the layout takes more bytes than the others.
    Rows and bytes come from the stored files (``_metadata``)."""
    parts = []
    for name, p in paths.items():
        folder = F.regexp_extract("_metadata.file_path", f"/{partition_cols[name]}=([^/]*)/", 1)
        files = spark.read.parquet(p).groupBy(F.lit(name).alias("layout"), F.url_decode(folder).alias("folder"), F.col("_metadata.file_path").alias("file"))
        parts.append(files.agg(F.count(F.lit(1)).alias("n"), F.max("_metadata.file_size").alias("bytes")))
    files = reduce(DataFrame.unionByName, parts)
    whole = files.groupBy("layout").agg(F.sum("n").alias("all_rows"), F.sum("bytes").alias("all_bytes"))
    whole = whole.withColumn("most", F.max("all_bytes").over(Window.partitionBy(F.lit(0))))  # a row a layout
    by_folder = files.groupBy("layout", "folder").agg(F.sum("n").alias("n_rows"))
    out = by_folder.join(whole, "layout")
    return out.select("layout", "folder", "n_rows", (F.col("n_rows") / F.col("all_rows")).alias("row_share"), (F.col("all_bytes") == F.col("most")).alias("is_largest"))


def layout_contents(spark: SparkSession, paths: dict[str, str], columns: Sequence[str]) -> DataFrame:
    """What each layout holds when read back: its rows and the distinct
    values of ``columns``, the same for every layout of the same rows."""
    parts = []
    for name, p in paths.items():
        counts = [F.count_distinct(c).alias(f"n_{c}") for c in columns]
        parts.append(spark.read.parquet(p).agg(F.count(F.lit(1)).alias("n_rows"), *counts)
                     .select(F.lit(name).alias("layout"), "n_rows", *[f"n_{c}" for c in columns]))
    return reduce(DataFrame.unionByName, parts)
