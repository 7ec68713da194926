"""Cumulative snapshot tables: one row per (entity, snapshot period) holding
the entity's whole history as an array of structs.

Two ways to build the same table:

* :func:`cumulate_step` — incremental: yesterday's snapshot FULL OUTER JOIN
  today's rows on the entity key. One shuffle of today's (small) slice; the
  snapshot side keeps its key partitioning (or its buckets, when stored
  bucketed by key).
* :func:`cumulate_backfill` — one shot for a period range. Rows are first
  reduced to one struct per (key, period) (a hash aggregate with map-side
  combine, so a hot key costs nothing extra), then grouped per key into a
  period-sorted array that is bounded by the number of periods, and every
  snapshot is produced with ``explode(sequence(first, last))`` and a
  higher-order ``filter``. There is no spine join, no theta join and no
  window, which a literal translation needs.

Folding :func:`cumulate_step` over the periods equals
:func:`cumulate_backfill` (tested).
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

Classifier = Callable[[Column], Column]


def _struct_of(prefix: str, cols: Sequence[str]) -> Column:
    return F.struct(*[F.col(f"{prefix}.{c}").alias(c) for c in cols])


def cumulate_step(yesterday: DataFrame, today: DataFrame, keys: Sequence[str], *,
                  period_col: str, stats_cols: Sequence[str], history_col: str = "history",
                  current_col: str = "current_period", static_cols: Sequence[str] = (),
                  classify: Classifier | None = None, class_measure: str | None = None,
                  class_col: str = "state_class", since_col: str = "periods_since_active",
                  active_col: str = "is_active") -> DataFrame:
    """Advance a cumulative snapshot by one period.

    ``yesterday``: snapshot rows of period p-1 (keys, static cols,
    ``history_col``, ``current_col`` and, when ``classify`` is given,
    ``class_col`` / ``since_col``). ``today``: at most one row per key for
    period p (keys, ``period_col``, ``stats_cols``, static cols).

    * history: today's struct appended (started when the key is new),
      carried unchanged when the key is absent today;
    * class: ``classify(today.class_measure)`` when present, else carried;
    * since: 0 when present, else +1;
    * current period: ``coalesce(today.period, yesterday.current + 1)``.
    """
    keys = list(keys)
    t, y = today.alias("t"), yesterday.alias("y")
    j = t.join(y, on=keys, how="full_outer")
    present = F.col(f"t.{period_col}").isNotNull()
    elem = _struct_of("t", [period_col, *stats_cols])
    y_hist = F.col(f"y.{history_col}")
    appended = F.when(y_hist.isNull(), F.array(elem)).otherwise(F.concat(y_hist, F.array(elem)))
    hist = F.when(present, appended).otherwise(y_hist)
    out = [*[F.col(k) for k in keys],
           *[F.coalesce(F.col(f"t.{c}"), F.col(f"y.{c}")).alias(c) for c in static_cols],
           hist.alias(history_col)]
    if classify is not None:
        out.append(F.when(present, classify(F.col(f"t.{class_measure}")))
                    .otherwise(F.col(f"y.{class_col}")).alias(class_col))
        out.append(F.when(present, F.lit(0)).otherwise(F.col(f"y.{since_col}") + 1).alias(since_col))
    out.append(F.coalesce(F.col(f"t.{period_col}"), F.col(f"y.{current_col}") + 1).alias(current_col))
    out.append(present.alias(active_col))
    return j.select(*out)


def cumulate_backfill(rows: DataFrame, keys: Sequence[str], *, period_col: str,
                      stats_cols: Sequence[str], first_period: int, last_period: int,
                      history_col: str = "history", current_col: str = "current_period",
                      static_cols: Sequence[str] = (), classify: Classifier | None = None,
                      class_measure: str | None = None, class_col: str = "state_class",
                      since_col: str = "periods_since_active",
                      active_col: str = "is_active", only_last: bool = False) -> DataFrame:
    """All snapshots ``first_period..last_period`` in one job.

    ``rows`` holds one row per (key, period). An entity appears from its
    first period on; its history at snapshot ``p`` holds its rows with
    period in ``[first_period, p]``; class and since come from the last
    element; static columns are the per-entity maximum. ``only_last``
    emits just the snapshot of ``last_period`` (the state an incremental
    run starts from).
    """
    keys = list(keys)
    in_range = rows.where((F.col(period_col) >= first_period) & (F.col(period_col) <= last_period))
    elem = F.struct(*[F.col(c) for c in [period_col, *stats_cols]])
    per_key = in_range.groupBy(*keys).agg(
        F.array_sort(F.collect_list(elem)).alias("_hist"),
        *[F.max(c).alias(c) for c in static_cols])
    first = F.lit(last_period) if only_last else F.col("_hist")[0][period_col]
    spine = per_key.select(*keys, *static_cols, "_hist",
                           F.explode(F.sequence(first, F.lit(last_period))).alias(current_col))
    # two projections: the history filter is computed once per row and the
    # last element read from it (Catalyst keeps a non-cheap expression that
    # is referenced several times in its own projection)
    base = [*[F.col(k) for k in keys], *[F.col(c) for c in static_cols]]
    hist = spine.select(*base, F.filter("_hist", lambda s: s[period_col] <= F.col(current_col)).alias(history_col),
                        F.col(current_col))
    last = F.element_at(history_col, -1)
    out = [*base, F.col(history_col)]
    if classify is not None:
        out.append(classify(last[class_measure]).alias(class_col))
        out.append((F.col(current_col) - last[period_col]).alias(since_col))
    out.append(F.col(current_col))
    out.append((last[period_col] == F.col(current_col)).alias(active_col))
    return hist.select(*out)


def unnest_history(snapshot: DataFrame, keys: Sequence[str], history_col: str = "history") -> DataFrame:
    """One row per history element (C4): ``keys + element fields``."""
    return snapshot.select(*keys, F.inline(history_col))


def first_last_ratio(snapshot: DataFrame, keys: Sequence[str], measure: str, *,
                     history_col: str = "history", ratio_col: str = "improvement") -> DataFrame:
    """Last / first value of ``measure`` in the history, first 0 read as 1.

    Reads the array ends in place: no grouping, no shuffle.
    """
    first = F.try_element_at(history_col, F.lit(1))[measure]
    last = F.try_element_at(history_col, F.size(history_col))[measure]
    denom = F.when(first == 0, F.lit(1.0)).otherwise(first)
    return snapshot.select(*keys, (last / denom).alias(ratio_col))


# -- many rows per period (actors / films) -----------------------------------

def exact_mean(measure: str, decimals: int = 9) -> Column:
    """Mean of a measure, summed as DECIMAL: the same for any order of rows,
    so that a strict class cut does not depend on it."""
    return F.sum(F.col(measure).cast(f"decimal(28,{decimals})")).cast("double") / F.count(measure)


def _period_batch(rows: DataFrame, keys: Sequence[str], period_col: str, item_cols: Sequence[str],
                  order_col: str, measure: str, carry_cols: Sequence[str]) -> DataFrame:
    """Per (key, period): items sorted by ``order_col`` and the measure mean."""
    item = F.struct(*[F.col(c) for c in item_cols])
    return rows.groupBy(*keys, period_col).agg(
        F.array_sort(F.collect_list(item), lambda a, b: F.when(a[order_col] < b[order_col], -1)
                     .when(a[order_col] > b[order_col], 1).otherwise(0)).alias("_items"),
        exact_mean(measure).alias("_mean"),
        *[F.max(c).alias(c) for c in carry_cols])


def cumulate_items_step(last: DataFrame, rows: DataFrame, keys: Sequence[str], *, period: int,
                        period_col: str, item_cols: Sequence[str], order_col: str, measure: str,
                        classify: Classifier, carry_cols: Sequence[str] = (),
                        items_col: str = "items", class_col: str = "state_class",
                        active_col: str = "is_active", as_of_col: str = "as_of") -> DataFrame:
    """Incremental step with many rows per entity per period.

    Today's rows are grouped to one sorted item array and a mean per key,
    appended to last period's array; the class is taken from today's mean
    or carried; ``as_of`` is the step's period for every row.
    """
    keys = list(keys)
    today = _period_batch(rows.where(F.col(period_col) == period), keys, period_col,
                          item_cols, order_col, measure, carry_cols).alias("t")
    j = today.join(last.alias("l"), on=keys, how="full_outer")
    t_items, l_items = F.col("t._items"), F.col(f"l.{items_col}")
    items = (F.when(l_items.isNull(), t_items).when(t_items.isNull(), l_items)
              .otherwise(F.concat(l_items, t_items)))
    return j.select(
        *keys,
        *[F.coalesce(F.col(f"t.{c}"), F.col(f"l.{c}")).alias(c) for c in carry_cols],
        F.lit(period).alias(as_of_col),
        items.alias(items_col),
        F.when(t_items.isNotNull(), classify(F.col("t._mean"))).otherwise(F.col(f"l.{class_col}")).alias(class_col),
        t_items.isNotNull().alias(active_col))


def cumulate_items_backfill(rows: DataFrame, keys: Sequence[str], *, first_period: int,
                            last_period: int, period_col: str, item_cols: Sequence[str],
                            order_col: str, measure: str, classify: Classifier,
                            carry_cols: Sequence[str] = (), carry_state: bool = False,
                            items_col: str = "items", class_col: str = "state_class",
                            active_col: str = "is_active", as_of_col: str = "as_of",
                            only_last: bool = False) -> DataFrame:
    """One-shot build of :func:`cumulate_items_step` over a period range.

    ``carry_state=False`` leaves the class NULL in inactive periods (the
    one-shot form in the reference); ``True`` carries the last class, which
    is what folding the incremental step gives.
    """
    keys = list(keys)
    batches = _period_batch(rows.where((F.col(period_col) >= first_period) & (F.col(period_col) <= last_period)),
                            keys, period_col, item_cols, order_col, measure, carry_cols)
    per_key = batches.groupBy(*keys).agg(
        F.array_sort(F.collect_list(F.struct(F.col(period_col).alias("p"), F.col("_mean").alias("m"),
                                             F.col("_items").alias("i")))).alias("_h"),
        *[F.max(c).alias(c) for c in carry_cols])
    first = F.lit(last_period) if only_last else F.col("_h")[0]["p"]
    spine = per_key.select(*keys, *carry_cols, "_h",
                           F.explode(F.sequence(first, F.lit(last_period))).alias(as_of_col))
    upto = F.filter("_h", lambda e: e["p"] <= F.col(as_of_col))
    now = F.filter(upto, lambda e: e["p"] == F.col(as_of_col))
    active = F.size(now) > 0
    if carry_state:
        cls = classify(F.element_at(upto, -1)["m"])
    else:
        cls = F.when(active, classify(F.element_at(now, 1)["m"]))
    return spine.select(*keys, *carry_cols, F.col(as_of_col),
                        F.flatten(F.transform(upto, lambda e: e["i"])).alias(items_col),
                        cls.alias(class_col), active.alias(active_col))


def cumulate_states_backfill(rows: DataFrame, keys: Sequence[str], *, first_period: int, last_period: int,
                             period_col: str, measure: str, classify: Classifier, carry_cols: Sequence[str] = (),
                             carry_state: bool = False, class_col: str = "state_class", active_col: str = "is_active",
                             as_of_col: str = "as_of", only_last: bool = False) -> DataFrame:
    """:func:`cumulate_items_backfill` without the items: what an SCD needs.
    Only keys, period, measure and carried columns are read; a key's periods
    are the only thing that is collected."""
    keys = list(keys)
    in_range = rows.where((F.col(period_col) >= first_period) & (F.col(period_col) <= last_period))
    means = in_range.groupBy(*keys, period_col).agg(exact_mean(measure).alias("_mean"), *[F.max(c).alias(c) for c in carry_cols])
    per_key = means.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct(F.col(period_col).alias("p"), F.col("_mean").alias("m")))).alias("_h"),
                                       *[F.max(c).alias(c) for c in carry_cols])
    first = F.lit(last_period) if only_last else F.col("_h")[0]["p"]
    spine = per_key.select(*keys, *carry_cols, "_h", F.explode(F.sequence(first, F.lit(last_period))).alias(as_of_col))
    last = F.element_at(F.filter("_h", lambda e: e["p"] <= F.col(as_of_col)), -1)
    known = spine.select(*keys, *carry_cols, as_of_col, last.alias("_last"))
    active = F.col("_last")["p"] == F.col(as_of_col)
    cls = classify(F.col("_last")["m"])
    return known.select(*keys, *carry_cols, as_of_col, (cls if carry_state else F.when(active, cls)).alias(class_col), active.alias(active_col))


def items_period(rows: DataFrame, state: DataFrame | None, keys: Sequence[str], *, period: int, period_col: str,
                 item_cols: Sequence[str], order_col: str, measure: str, classify: Classifier,
                 carry_cols: Sequence[str] = (), class_col: str = "state_class", active_col: str = "is_active",
                 as_of_col: str = "as_of") -> DataFrame:
    """C6 without copying the history: one row a key of one period.

    ``items`` are the period's own (null where the key has none), ``offset``
    is how many the key had before and ``n_items`` how many it has now; class
    and activity come from the ``state`` of the period before (None: the
    first). A period costs its own rows and one join of the states.
    :func:`batch_of` and :func:`state_of` are what is stored; the history is
    put together by :func:`items_as_of` when it is read.
    """
    keys = list(keys)
    today = _period_batch(rows.where(F.col(period_col) == period), keys, period_col, item_cols, order_col, measure, carry_cols)
    if state is None:
        state = today.select(*keys, *carry_cols, F.lit(0).cast("long").alias("n_items"), F.lit(None).cast("string").alias(class_col)).limit(0)
    j = today.alias("t").join(state.alias("l"), on=keys, how="full_outer")
    here = F.col("t._items").isNotNull()
    before = F.coalesce(F.col("l.n_items"), F.lit(0).cast("long"))
    return j.select(*keys, *[F.coalesce(F.col(f"t.{c}"), F.col(f"l.{c}")).alias(c) for c in carry_cols], F.lit(period).alias(as_of_col),
                    before.alias("offset"), F.col("t._items").alias("items"),
                    (before + F.when(here, F.size("t._items")).otherwise(0)).alias("n_items"),
                    F.when(here, classify(F.col("t._mean"))).otherwise(F.col(f"l.{class_col}")).alias(class_col), here.alias(active_col))


def batch_of(period_rows: DataFrame, keys: Sequence[str], *, as_of_col: str = "as_of") -> DataFrame:
    """The items of a period, to be stored with it."""
    return period_rows.where(F.col("items").isNotNull()).select(*keys, as_of_col, "offset", "items")


def state_of(period_rows: DataFrame) -> DataFrame:
    """The state that the next period continues."""
    return period_rows.drop("offset", "items")


def items_as_of(state: DataFrame, batches: DataFrame, keys: Sequence[str], *, period: int, as_of_col: str = "as_of",
                items_col: str = "items") -> DataFrame:
    """The states of a period with each key's whole history, from the batches
    up to the period in the order of their offsets."""
    keys = list(keys)
    held = batches.where(F.col(as_of_col) <= period).groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct("offset", "items"))).alias("_b"))
    whole = F.flatten(F.transform("_b", lambda b: b["items"]))
    return state.where(F.col(as_of_col) == period).join(held, keys, "left").withColumn(items_col, whole).drop("_b", "n_items")
