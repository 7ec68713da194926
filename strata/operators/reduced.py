"""Reduced facts: per (entity, month) arrays indexed by day of month
(C32-C34, C44).

Invariant kept by the default mode: after the run for day ``d`` every
array of month ``trunc(d)`` has exactly ``day(d)`` elements, slot ``i``
holding the metric of day ``i`` (0 when inactive). Keys that first appear
mid-month are zero-padded, keys absent today get a 0, a gap is padded, and
a re-run of a day already covered is a no-op.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.sources.tables import day_range


def daily_metrics(events: DataFrame, keys: Sequence[str], ts_col: str, day, *,
                  hits_col: str = "num_hits", distinct_of: str | None = None,
                  distinct_col: str = "unique_visitors") -> DataFrame:
    """Per key for one day: row count and, optionally, distinct count.

    ``count(DISTINCT x)`` is planned by Spark as a two-level aggregation
    (first on ``keys + x``), so a key with most of the rows is still
    spread over many tasks.
    """
    keys = list(keys)
    e = events.where(day_range(ts_col, day))
    for k in keys:
        e = e.where(F.col(k).isNotNull())
    aggs = [F.count(F.lit(1)).alias(hits_col)]
    if distinct_of is not None:
        aggs.append(F.count_distinct(distinct_of).alias(distinct_col))
    return e.groupBy(*keys).agg(*aggs)


def _append_slot(prev: Column, value: Column, dom: Column) -> Column:
    """``prev`` padded with zeros to ``dom - 1`` then ``value`` appended;
    unchanged if it already covers ``dom`` days."""
    base = F.coalesce(prev, F.array().cast("array<bigint>"))
    pad = F.array_repeat(F.lit(0).cast("bigint"), F.greatest(dom - 1 - F.size(base), F.lit(0)))
    grown = F.concat(base, pad, F.array(F.coalesce(value, F.lit(0)).cast("bigint")))
    return F.when(F.size(base) >= dom, base).otherwise(grown)


def _append_literal_metric(prev: Column, value: Column) -> Column:
    """C32 as written: new key → ``[value]`` (no padding, Q8); known key →
    append (0 when absent), with no re-run guard (Q9)."""
    v = F.array(F.coalesce(value, F.lit(0)).cast("bigint"))
    return F.when(prev.isNull(), v).otherwise(F.concat(prev, v))


def _append_literal_host(prev: Column, value: Column, present: Column, dom: Column) -> Column:
    """C34 as written: absent today → unchanged (Q10, positions drift after
    a gap); covered day → unchanged; new key → ``day - 1`` zeros + value."""
    v = F.array(F.coalesce(value, F.lit(0)).cast("bigint"))
    pad = F.array_repeat(F.lit(0).cast("bigint"), F.greatest(dom - 1, F.lit(0)))
    return (F.when(~present, prev)
             .when(prev.isNotNull(), F.when(F.size(prev) >= dom, prev).otherwise(F.concat(prev, v)))
             .otherwise(F.concat(pad, v)))


def month_array_step(prev: DataFrame, today: DataFrame, keys: Sequence[str], *, day,
                     metrics: Mapping[str, str], month_col: str = "month_start",
                     extra_cols: Mapping[str, Column] | None = None, mode: str = "aligned") -> DataFrame:
    """Append ``day``'s metrics to the month arrays.

    ``prev``: month rows (keys, ``month_col``, array columns); rows of other
    months are ignored. ``today``: one row per key with the metric values.
    ``metrics`` maps output array column → today's value column.

    ``mode="aligned"`` (default) keeps slot ``i`` = day ``i`` (see module
    doc). ``"literal_metric"`` and ``"literal_host"`` reproduce the
    reference's C32 and C34 arithmetic (SURVEY Q8-Q10).
    """
    keys = list(keys)
    d = F.lit(day).cast("date")
    month = F.trunc(d, "month")
    p = prev.where(F.col(month_col) == month).alias("p")
    t = today.withColumn("_present", F.lit(True)).alias("t")
    j = t.join(p, on=keys, how="full_outer")
    dom = F.dayofmonth(d)
    present = F.coalesce(F.col("t._present"), F.lit(False))

    def grow(arr: str, val: str) -> Column:
        pv, tv = F.col(f"p.{arr}"), F.col(f"t.{val}")
        if mode == "aligned":
            return _append_slot(pv, tv, dom)
        if mode == "literal_metric":
            return _append_literal_metric(pv, tv)
        if mode == "literal_host":
            return _append_literal_host(pv, tv, present, dom)
        raise ValueError(f"unknown mode {mode!r}")

    cols = [*keys, month.alias(month_col)]
    cols += [(v).alias(k) for k, v in (extra_cols or {}).items()]
    cols += [grow(arr, val).alias(arr) for arr, val in metrics.items()]
    return j.select(*cols)


def month_array_snapshot(events: DataFrame, keys: Sequence[str], ts_col: str, through_day, *,
                         hits_col: str = "num_hits", distinct_of: str | None = None,
                         distinct_col: str = "unique_visitors", month_col: str = "month_start",
                         arrays: Mapping[str, str] | None = None) -> DataFrame:
    """Month arrays through ``through_day`` in one job (what folding the step gives).

    Daily metrics per (key, day) → per key a day→value map (≤ 31 entries)
    → dense arrays of ``day(through_day)`` slots.
    """
    keys = list(keys)
    end = F.lit(through_day).cast("date")
    start = F.trunc(end, "month")
    e = events.where((F.col(ts_col) >= start.cast("timestamp_ntz"))
                     & (F.col(ts_col) < F.date_add(end, 1).cast("timestamp_ntz")))
    for k in keys:
        e = e.where(F.col(k).isNotNull())
    aggs = [F.count(F.lit(1)).alias(hits_col)]
    if distinct_of is not None:
        aggs.append(F.count_distinct(distinct_of).alias(distinct_col))
    daily = e.groupBy(*keys, F.dayofmonth(ts_col).alias("_dom")).agg(*aggs)
    value_cols = [hits_col] + ([distinct_col] if distinct_of is not None else [])
    per_key = daily.groupBy(*keys).agg(*[
        F.map_from_entries(F.collect_list(F.struct(F.col("_dom"), F.col(v)))).alias(f"_m_{v}")
        for v in value_cols])
    arrays = arrays or {hits_col: hits_col}
    slots = F.sequence(F.lit(1), F.dayofmonth(end))

    def dense(src: str) -> Column:
        m = F.col(f"_m_{src}")
        return F.transform(slots, lambda i: F.coalesce(m[i], F.lit(0)).cast("bigint"))

    return per_key.select(*keys, start.alias(month_col),
                          *[dense(src).alias(arr) for arr, src in arrays.items()])


def elementwise_sum(df: DataFrame, group_cols: Sequence[str], array_col: str, *,
                    month_col: str = "month_start", date_col: str = "date",
                    value_col: str = "value") -> DataFrame:
    """Element-wise SUM of arrays per group, unnested to dated rows.

    Any array length (the reference hard-codes six slots). ``posexplode``
    then a hash aggregate on (group, month, slot): partial sums happen
    map-side.
    """
    ex = df.select(*group_cols, month_col, F.posexplode(array_col).alias("_pos", "_v"))
    agg = ex.groupBy(*group_cols, month_col, "_pos").agg(F.sum("_v").alias(value_col))
    return agg.select(*group_cols, F.date_add(F.col(month_col), F.col("_pos").cast("int")).alias(date_col),
                      value_col)


def first_days_sum(df: DataFrame, *, month_col: str, array_col: str, partition_col: str, ds: str,
                   names: Sequence[str] = ("num_hits_first_day", "num_hits_second_day",
                                           "num_hits_third_day")) -> DataFrame:
    """Per month, the sum of array slots 0..n-1 over one partition;
    missing slots count 0."""
    return (df.where(F.col(partition_col) == ds).groupBy(month_col).agg(*[
        F.sum(F.coalesce(F.get(F.col(array_col), i), F.lit(0))).alias(n) for i, n in enumerate(names)]))
