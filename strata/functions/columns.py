"""Scalar column helpers used by several operators."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def tier(measure: Column | str, cuts: Sequence[tuple[float, str]], default: str) -> Column:
    """Tier label from strict ``>`` cuts checked top down.

    ``cuts`` is ``[(threshold, label), ...]`` from the highest threshold
    down; a NULL measure matches no cut and falls to ``default``.
    """
    m = F.col(measure) if isinstance(measure, str) else measure
    expr = None
    for threshold, label in cuts:
        cond = m > F.lit(threshold)
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return expr.otherwise(F.lit(default)) if expr is not None else F.lit(default)


def clock_minutes(text: Column | str) -> Column:
    """``"MM:SS"`` played time as decimal minutes.

    Blank or NULL text counts as ``0:00``; a missing or non-numeric part
    counts as 0 (so ``"34"`` is 34.0 minutes) instead of failing the cast.
    """
    t = F.col(text) if isinstance(text, str) else text
    clean = F.coalesce(F.nullif(F.trim(t), F.lit("")), F.lit("0:00"))
    mins = F.coalesce(F.split_part(clean, F.lit(":"), F.lit(1)).try_cast("double"), F.lit(0.0))
    secs = F.coalesce(F.split_part(clean, F.lit(":"), F.lit(2)).try_cast("double"), F.lit(0.0))
    return mins + secs / F.lit(60.0)


def first_address(text: Column | str) -> Column:
    """First entry of a comma-separated address list, trimmed; '' if none."""
    t = F.col(text) if isinstance(text, str) else text
    return F.coalesce(F.trim(F.split_part(t, F.lit(","), F.lit(1))), F.lit(""))


def ipv4_to_long(text: Column | str) -> Column:
    """Dotted IPv4 text to its 32-bit number; NULL when it does not parse
    (four parts of one to three digits, each at most 255)."""
    t = F.col(text) if isinstance(text, str) else text
    parts = [F.split_part(t, F.lit("."), F.lit(i)).try_cast("long") for i in (1, 2, 3, 4)]
    ok = t.rlike(r"\A[0-9]{1,3}(\.[0-9]{1,3}){3}\z")
    for p in parts:
        ok = ok & (p <= 255)
    num = parts[0] * 16777216 + parts[1] * 65536 + parts[2] * 256 + parts[3]
    return F.when(ok, num)


def json_props(*pairs: tuple[str, Column | str]) -> Column:
    """JSON object text that keeps NULL-valued fields (``{"k":null}``)."""
    fields = [(F.col(v) if isinstance(v, str) else v).alias(k) for k, v in pairs]
    return F.to_json(F.struct(*fields), {"ignoreNullFields": "false"})


def history_text(arr: Column | str, field: str | None = None, sep: str = ",") -> Column:
    """Array (or one field of an array of structs) as delimited text.

    Used to expose array order in comparable, engine-neutral form.
    """
    a = F.col(arr) if isinstance(arr, str) else arr
    if field is not None:
        a = F.transform(a, lambda s: s[field])
    return F.array_join(F.transform(a, lambda x: x.cast("string")), sep)
