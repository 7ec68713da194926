"""The SQL-in-Python jobs (C44-C46): SQL text made from the same parameters
as the DataFrame operators, run over a temp view with bound values. Catalyst
plans text and DataFrame calls alike; the results agree with
``reduced.first_days_sum``, ``scd.scd_backfill`` and ``graph.team_vertices``."""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Mapping, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame

FIRST_DAYS = ("num_hits_first_day", "num_hits_second_day", "num_hits_third_day")


@contextmanager
def _view(df: DataFrame) -> Iterator[str]:
    """A temp view with a name of its own for the time a statement is read:
    a plan once made does not need it, and two runs cannot share it."""
    name = f"rows_{uuid.uuid4().hex}"
    df.createOrReplaceTempView(name)
    try:
        yield name
    finally:
        df.sparkSession.catalog.dropTempView(name)


def first_days_sum(df: DataFrame, *, month_col: str, array_col: str, partition_col: str, ds: str,
                   names: Sequence[str] = FIRST_DAYS) -> DataFrame:
    """The first slots of each array summed by month, one date."""
    sums = ", ".join(f"sum(nvl(get({array_col}, {slot}), 0)) AS {name}" for slot, name in enumerate(names))
    with _view(df) as view:
        text = f"SELECT {month_col}, {sums} FROM {view} WHERE {partition_col} = :ds GROUP BY {month_col}"
        return df.sparkSession.sql(text, args={"ds": ds})


def streaks(df: DataFrame, *, key: str, period_col: str, state_col: str, start_col: str, end_col: str) -> DataFrame:
    """One row a run of equal states. Only rows that open a run are
    kept; a run ends where the row before the next opening stands."""
    text = """
    SELECT {key}, {state_col}, {period_col} AS {start_col},
           nvl(lead(before) OVER (PARTITION BY {key} ORDER BY {period_col}), final) AS {end_col}
    FROM (SELECT {key}, {state_col}, {period_col}, lag({period_col}) OVER run AS before,
                 NOT ({state_col} <=> lag({state_col}) OVER run) OR lag({period_col}) OVER run IS NULL AS opens,
                 max({period_col}) OVER (PARTITION BY {key}) AS final
          FROM {view} WINDOW run AS (PARTITION BY {key} ORDER BY {period_col}))
    WHERE opens"""
    with _view(df) as view:
        return df.sparkSession.sql(text.format(key=key, state_col=state_col, period_col=period_col, start_col=start_col, end_col=end_col, view=view))


def map_vertices(df: DataFrame, *, key: str, kind: str, order_col: str, properties: Mapping[str, str]) -> DataFrame:
    """One vertex a key with MAP properties, from its first row."""
    pairs = ", ".join(f"'{name}', CAST({col} AS STRING)" for name, col in properties.items())
    with _view(df) as view:
        text = f"SELECT {key} AS identifier, :kind AS type, min_by(map({pairs}), {order_col}) AS properties FROM {view} GROUP BY {key}"
        return df.sparkSession.sql(text, args={"kind": kind})
