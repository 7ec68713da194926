"""The one place Python runs per value: an optional user-supplied location
lookup registered as a vectorised (Arrow-batched) pandas UDF, callable from
SQL as in the reference (``get_location(ip)``).

The built-in path (``streaming.windows.enrich_geo``) resolves addresses by
a range join against an IP-range table and needs no Python; use this only
when the lookup is a Python function (a local database reader, say). It
never makes a network call per row.
"""

from __future__ import annotations

import json
from bisect import bisect_right
from collections.abc import Callable, Sequence

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def location_udf(lookup: Callable[[str], dict | None], *, compact: bool = False):
    """Pandas UDF: first address of a comma list → JSON of ``lookup(addr)``,
    ``{}`` when blank or unknown; ``compact``: as ``to_json`` writes it."""
    style = {"separators": (",", ":"), "ensure_ascii": False} if compact else {}

    @F.pandas_udf("string")
    def get_location(ip: pd.Series) -> pd.Series:
        first = ip.fillna("").str.split(",").str[0].str.strip()
        return first.map(lambda a: json.dumps(lookup(a) or {}, **style) if a else "{}")
    return get_location


def register_location_udf(spark: SparkSession, lookup: Callable[[str], dict | None],
                          name: str = "get_location", *, compact: bool = False):
    """Register :func:`location_udf` for use in ``spark.sql``."""
    fn = location_udf(lookup, compact=compact)
    spark.udf.register(name, fn)
    return fn


def range_finder(ranges: DataFrame, start_col: str, end_col: str, fields: Sequence[str], *, most: int = 100_000) -> Callable[[str], dict | None]:
    """A lookup for :func:`location_udf` over a small table of separate
    address ranges, found by bisection. The table travels with the function,
    so more than ``most`` ranges are an error: larger ones are joined
    (``operators.joins.range_lookup``)."""
    rows = ranges.select(start_col, end_col, *fields).orderBy(start_col).limit(most + 1).collect()
    if len(rows) > most:
        raise ValueError(f"more than {most} ranges: join them instead")
    starts = [r[0] for r in rows]

    def find(address: str) -> dict | None:
        parts = address.split(".")
        if len(parts) != 4 or not all(p.isdigit() and int(p) < 256 for p in parts):
            return None
        value = sum(int(p) << 8 * (3 - k) for k, p in enumerate(parts))
        at = bisect_right(starts, value) - 1
        return dict(zip(fields, rows[at][2:], strict=True)) if at >= 0 and value <= rows[at][1] else None

    return find
