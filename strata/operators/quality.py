"""Data-quality checks standing in for the reference's table constraints
(PRIMARY KEY, NOT NULL, CHECK, ENUM). Each returns the violating rows as a
DataFrame with a ``check_name`` and a ``detail`` text, so checks union
together and run as one distributed job."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _detail(cols: Sequence[str | Column]) -> Column:
    return F.concat_ws("|", *[(F.col(c) if isinstance(c, str) else c).cast("string") for c in cols])


def assert_unique(df: DataFrame, keys: Sequence[str], name: str | None = None) -> DataFrame:
    """Key combinations occurring more than once (detail: keys and count)."""
    g = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > 1)
    return g.select(F.lit(name or f"unique({','.join(keys)})").alias("check_name"),
                    _detail([*keys, "_n"]).alias("detail"))


def assert_not_null(df: DataFrame, cols: Sequence[str], id_cols: Sequence[str],
                    name: str | None = None) -> DataFrame:
    """Rows where any of ``cols`` is NULL."""
    bad = reduce(lambda a, b: a | b, [F.col(c).isNull() for c in cols])
    return df.where(bad).select(F.lit(name or f"not_null({','.join(cols)})").alias("check_name"),
                                _detail(id_cols).alias("detail"))


def assert_check(df: DataFrame, condition: Column, id_cols: Sequence[str], name: str) -> DataFrame:
    """Rows where ``condition`` is false or NULL (a CHECK constraint)."""
    return df.where(~F.coalesce(condition, F.lit(False))).select(
        F.lit(name).alias("check_name"), _detail(id_cols).alias("detail"))


def assert_domain(df: DataFrame, col: str, allowed: Iterable[str], id_cols: Sequence[str],
                  name: str | None = None, allow_null: bool = True) -> DataFrame:
    """Rows whose ``col`` is outside ``allowed`` (an ENUM)."""
    allowed = list(allowed)
    bad = ~F.col(col).isin(allowed)
    if not allow_null:
        bad = F.coalesce(bad, F.lit(True))
    return df.where(bad).select(F.lit(name or f"domain({col})").alias("check_name"),
                                _detail(id_cols).alias("detail"))


def violations(*checks: DataFrame) -> DataFrame:
    """All check results as one DataFrame."""
    return reduce(lambda a, b: a.unionByName(b), checks)
