"""Plan assertions: read the plan text that ``DataFrame.explain`` prints."""

from __future__ import annotations

import contextlib
import io

from pyspark.sql import DataFrame


def plan_text(df: DataFrame, mode: str = "formatted") -> str:
    """What ``df.explain(mode)`` prints, as a string."""
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode=mode)
    return buf.getvalue()


def count_nodes(df: DataFrame, node: str) -> int:
    """Occurrences of a physical operator in the simple physical plan."""
    text = plan_text(df, "simple")
    physical = text.split("== Physical Plan ==")[-1]
    return sum(1 for line in physical.splitlines() if node in line)
