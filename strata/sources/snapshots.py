"""Snapshot tables on shared storage: the write side of the incremental
operators (INSERT / upsert / truncate-and-rebuild in the reference).

* Every snapshot table is Parquet partitioned by its period column; a run
  writes exactly one period with dynamic partition overwrite, so re-running
  a period replaces it (the reference's ``ON CONFLICT DO UPDATE``, safe
  because every upsert key contains the period) and other periods stay.
* Reading one period prunes to that partition.
* When a run reads and rewrites the same partition (month arrays), the
  input is first cut off with a reliable ``checkpoint()`` in the cluster's
  checkpoint folder, so the overwrite never deletes what it is reading and
  a lost executor recomputes from the checkpoint, not from a half-written
  table.
* :func:`write_period_bucketed` stores a snapshot table bucketed (and
  sorted) on the entity key: the next step's full outer join then reads
  yesterday's snapshot without any shuffle, and only today's (small) rows
  are hashed into the bucket layout.
* :func:`merge_keyed` is the keyed upsert inside a period: the period is cut
  into buckets by a hash of the key, and only the buckets that hold a changed
  key are read and rewritten.
* :func:`fold_periods` runs an incremental step over a period range,
  writing each period before the next reads it: lineage stays one step
  deep however many periods are folded.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.session import ensure_checkpoint_dir
from strata.sources.schemas import KEYS, SCHEMAS


def write_period(df: DataFrame, path: str, period_col: str, *, compression: str = "zstd") -> None:
    """Overwrite only the period partition(s) present in ``df``."""
    (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
       .option("compression", compression).partitionBy(period_col).parquet(path))


def read_period(spark: SparkSession, path: str, period_col: str, period) -> DataFrame:
    """One period of a snapshot table (partition-pruned scan)."""
    return spark.read.parquet(path).where(F.col(period_col) == F.lit(period))


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialise ``df`` in the shared checkpoint folder and return a
    DataFrame that reads it back (reliable checkpoint, survives executor
    loss)."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


class MissingPeriod(RuntimeError):
    """The stored period that a step needs is not there."""


def has_period(spark: SparkSession, path: str, period_col: str, period) -> bool:
    """Whether the table holds rows of the period (a pruned read)."""
    try:
        return not read_period(spark, path, period_col, period).isEmpty()
    except AnalysisException as ex:  # no table yet, or one without files
        if ex.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return False
        raise


def fold_periods(spark: SparkSession, path: str, period_col: str, periods: Iterable,
                 step: Callable[[DataFrame | None, object], DataFrame], *,
                 previous: Callable[[object], object], first=None, rewrites_state: bool = False) -> None:
    """Run ``step(state, period)`` for each period and write its output.

    ``state`` is the stored partition ``previous(period)``, whichever run
    wrote it; ``None`` where ``previous`` says that the period starts
    without one, or where it is absent and the period is ``first``, the
    table's first. An absent partition before any other period raises
    :class:`MissingPeriod`: nothing is written from a state with a gap.

    Month tables read and rewrite the same partition (``previous`` maps a
    day to its month, ``rewrites_state=True``): the state is then
    checkpointed before the overwrite.
    """
    for p in periods:
        src = previous(p)
        state = None
        if src is not None and has_period(spark, path, period_col, src):
            state = read_period(spark, path, period_col, src)
            if rewrites_state:
                state = cut_lineage(state)
        elif src is not None and p != first:
            raise MissingPeriod(f"{path}: {period_col} = {src} is not stored, which {p} continues")
        write_period(step(state, p), path, period_col)


def append_period(df: DataFrame, path: str, period_col: str) -> None:
    """Add rows to their period partitions and leave all others (the
    reference's plain ``INSERT ... SELECT``; not idempotent)."""
    df.write.mode("append").partitionBy(period_col).parquet(path)


#: Option of a table whose inserts overwrite only the partitions they hold.
DYNAMIC = ("partitionOverwriteMode", "dynamic")


def create_table(spark: SparkSession, name: str, location: str, *, kind: str | None = None,
                 schema: str | None = None, partition_col: str | None = None) -> None:
    """``CREATE TABLE IF NOT EXISTS`` an external Parquet table for a
    workload's state table (``kind`` picks the schema and period column)."""
    ddl = schema or SCHEMAS[kind]
    part = partition_col or (KEYS[kind][1] if kind in KEYS else None)
    clause = f" OPTIONS ({DYNAMIC[0]} '{DYNAMIC[1]}') PARTITIONED BY ({part})" if part else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({ddl}) USING parquet{clause} LOCATION '{location}'")


def as_table(df: DataFrame, table_name: str) -> DataFrame:
    """The table's columns of ``df`` by name, in its order, whole numbers and
    collections cast to its types; a missing column is drift."""
    schema = df.sparkSession.table(table_name).schema
    if missing := [f.name for f in schema if f.name not in df.columns]:
        raise SchemaDrift(f"{table_name}: no column {', '.join(missing)}")
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema])


class SchemaDrift(ValueError):
    """Rows do not have the columns of the table they are to go into."""


def insert_period(df: DataFrame, table_name: str) -> None:
    """``INSERT OVERWRITE`` only the partitions present in ``df`` (by column
    position, as the reference's ``insertInto`` / ``INSERT INTO`` do).

    Positions say nothing about meaning, so the names and types must be the
    table's, in its order; anything else raises :class:`SchemaDrift` before a
    file is touched. That other partitions stay is an option of the table
    (:func:`create_table` sets it), not a setting of the session; a
    partitioned table without it is refused.
    """
    spark = df.sparkSession
    want, have = ([(f.name, f.dataType.simpleString()) for f in s] for s in (spark.table(table_name).schema, df.schema))
    if want != have:
        wrong = [f"{t} {n}" for n, t in have if (n, t) not in want] or ["another order of columns"]
        raise SchemaDrift(f"{table_name} has {want}; the rows differ by {', '.join(wrong)}")
    told = {r.col_name: r.data_type for r in spark.sql(f"DESCRIBE TABLE EXTENDED {table_name}").collect()}
    if "# Partition Information" in told and f"{DYNAMIC[0]}={DYNAMIC[1]}".lower() not in (told.get("Storage Properties") or "").lower():
        raise ValueError(f"{table_name} was created without {DYNAMIC[0]}={DYNAMIC[1]}: an insert would replace all of it")
    df.write.insertInto(table_name, overwrite=True)


BUCKET = "_bucket"


def _bucketed(df: DataFrame, keys, buckets: int) -> DataFrame:
    return df.withColumn(BUCKET, F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int"))


def write_keyed(df: DataFrame, path: str, period_col: str, keys, buckets: int) -> None:
    """Write whole periods, each cut into ``buckets`` folders by a hash of
    the key. Choose the number so that one bucket is a few hundred MB; it is
    the same for every write to a table."""
    out = _bucketed(df, keys, buckets).repartition(period_col, BUCKET)
    out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(period_col, BUCKET).parquet(path)


def read_keyed(spark: SparkSession, path: str, period_col: str, period) -> DataFrame:
    """One period of a keyed table."""
    return read_period(spark, path, period_col, period).drop(BUCKET)


def merge_keyed(updates: DataFrame, path: str, period_col: str, period, keys, buckets: int) -> list[int]:
    """Upsert inside a period (``ON CONFLICT (key) DO UPDATE``): rows of
    ``updates`` (at most one a key) replace those with their key or are
    added; all other rows stay.

    Only the buckets that hold a key of ``updates`` are read and rewritten;
    the files of the others are not touched. The new buckets are cut off by a
    checkpoint before the overwrite, so a failed run can be repeated; running
    the same merge again changes nothing. Returns the rewritten buckets, at
    most ``buckets`` numbers.
    """
    spark, keys = updates.sparkSession, list(keys)
    new = cut_lineage(_bucketed(updates.where(F.col(period_col) == F.lit(period)), keys, buckets))
    changed = sorted(r[0] for r in new.select(BUCKET).distinct().collect())
    if not changed:
        return []
    merged = new
    if has_period(spark, path, period_col, period):
        base = read_period(spark, path, period_col, period).where(F.col(BUCKET).isin(changed))
        same = [F.col(f"b.{k}").eqNullSafe(F.col(f"n.{k}")) for k in [BUCKET, *keys]]
        kept = base.alias("b").join(new.select(BUCKET, *keys).alias("n"), same, "left_anti")
        merged = cut_lineage(kept.select(*new.columns).unionByName(new))
    (merged.repartition(period_col, BUCKET).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
       .partitionBy(period_col, BUCKET).parquet(path))
    return changed


def write_period_bucketed(df: DataFrame, table_name: str, path: str, period_col: str,
                          key_cols, buckets: int) -> None:
    """Write one period into a table partitioned by period and bucketed +
    sorted on the entity key (created on first use, then overwritten one
    partition at a time). Choose ``buckets`` so one bucket of one period is
    in the hundreds of MB."""
    spark = df.sparkSession
    keys = [key_cols] if isinstance(key_cols, str) else list(key_cols)
    if not spark.catalog.tableExists(table_name):
        (df.write.mode("overwrite").option(*DYNAMIC).partitionBy(period_col).bucketBy(buckets, *keys).sortBy(*keys)
           .option("path", path).saveAsTable(table_name))
    else:
        insert_period(df.select(*spark.table(table_name).columns), table_name)
