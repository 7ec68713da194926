"""Date-list cumulation and activity bitmaps.

A date list holds, per entity, every active date newest first; a daily run
prepends today's date. Bitmaps over the list are computed in place with a
higher-order function (``strata.functions.bitmaps``), never with a cross
join against a date series.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.functions.bitmaps import activity_bits, bit_flags, bits_text
from strata.sources.tables import day_range


def daily_active(events: DataFrame, keys: Sequence[str], ts_col: str, day,
                 date_col: str = "date_active") -> DataFrame:
    """Distinct active keys of one day (NULL keys excluded).

    The day filter is a half-open timestamp range, so it reaches the scan.
    """
    keys = list(keys)
    e = events.where(day_range(ts_col, day))
    for k in keys:
        e = e.where(F.col(k).isNotNull())
    return e.select(*keys, F.lit(day).cast("date").alias(date_col)).distinct()


def datelist_step(yesterday: DataFrame, today: DataFrame, keys: Sequence[str], *,
                  list_col: str = "dates_active", date_col: str = "date_active",
                  curr_col: str = "curr_date", guard: bool = True) -> DataFrame:
    """Advance a date-list snapshot by one day.

    New key → ``[today]``; absent key → list carried; otherwise today is
    prepended, unless it is already the head (``guard``, so a re-run of the
    same day changes nothing). ``curr_date = coalesce(today, yesterday+1)``.
    """
    keys = list(keys)
    j = today.alias("t").join(yesterday.alias("y"), on=keys, how="full_outer")
    y_list, t_date = F.col(f"y.{list_col}"), F.col(f"t.{date_col}")
    merged = F.when(y_list.isNull(), F.array(t_date)).when(t_date.isNull(), y_list)
    if guard:
        merged = merged.when(F.try_element_at(y_list, F.lit(1)) == t_date, y_list)
    merged = merged.otherwise(F.concat(F.array(t_date), y_list))
    return j.select(*keys, merged.alias(list_col),
                    F.coalesce(t_date, F.date_add(F.col(f"y.{curr_col}"), 1)).alias(curr_col))


def datelist_snapshot(events: DataFrame, keys: Sequence[str], ts_col: str, as_of, *,
                      since=None, list_col: str = "dates_active",
                      curr_col: str = "curr_date") -> DataFrame:
    """Date-list snapshot of ``as_of`` in one job (what folding the step gives).

    Distinct active dates per key, newest first. ``collect_set`` combines
    map-side, and a list is bounded by the number of days.
    """
    keys = list(keys)
    e = events.where(F.col(ts_col) < F.date_add(F.lit(as_of).cast("date"), 1).cast("timestamp_ntz"))
    if since is not None:
        e = e.where(F.col(ts_col) >= F.lit(since).cast("date").cast("timestamp_ntz"))
    for k in keys:
        e = e.where(F.col(k).isNotNull())
    return (e.groupBy(*keys).agg(F.sort_array(F.collect_set(F.to_date(ts_col)), asc=False).alias(list_col))
             .withColumn(curr_col, F.lit(as_of).cast("date")))


def bitmap_flags(snapshot: DataFrame, keys: Sequence[str], *, list_col: str = "dates_active",
                 curr_col: str = "curr_date", window: int = 30, top_bit: int = 31,
                 word_bits: int = 32) -> DataFrame:
    """32-bit activity word plus monthly / weekly / daily flags.

    ``top_bit=31`` puts the snapshot day in the high bit; ``top_bit=32``
    reproduces the reference, whose snapshot day falls off the word.
    """
    bits = activity_bits(list_col, curr_col, window=window, top_bit=top_bit, word_bits=word_bits)
    b = snapshot.select(*keys, bits.alias("activity_bits"))
    flags = bit_flags("activity_bits", word_bits=word_bits)
    return b.select(*keys, "activity_bits", bits_text("activity_bits", word_bits).alias("activity_bits_text"),
                    *[v.alias(k) for k, v in flags.items()])


def datelist_int(snapshot: DataFrame, keys: Sequence[str], *, list_col: str, curr_col: str = "curr_date",
                 window: int = 30, out_col: str = "datelist_int") -> DataFrame:
    """30-bit integer, bit ``window-1`` = snapshot day, bit 0 = oldest day."""
    bits = activity_bits(list_col, curr_col, window=window, top_bit=window - 1, word_bits=window)
    return snapshot.select(*keys, bits.alias(out_col))
