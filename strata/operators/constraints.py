"""Table constraints compiled into one audit job.

The declared keys, not-null columns, enum domains, checks and references of
any number of tables (``strata.sources.schemas``) become one DataFrame: every
table is scanned once, and all of them meet in one aggregation. A row sends

* its key with a mark for each row condition it fails, and
* for each reference, the key it points to, addressed to the other table.

Grouped by (table, key), the number of own rows shows repeated keys, the
marks are added up, and a key that is pointed to but has no row is missing.
All of it are sums, so a key that very many rows share is combined in every
task before the shuffle, and no join or second scan is needed.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.sources import schemas


@dataclass(frozen=True)
class Rules:
    """Constraints of one table. A key column must not be null; a value
    outside a domain, or for which a check is false, breaks it; null does
    not. A reference with a null column points nowhere."""

    key: tuple[str, ...]
    not_null: tuple[str, ...] = ()
    domains: Mapping[str, Sequence[str]] = field(default_factory=dict)
    checks: Mapping[str, str] = field(default_factory=dict)
    references: Mapping[str, tuple[tuple[str, ...], str]] = field(default_factory=dict)

    def row_conditions(self) -> dict[str, Column]:
        """Name and failure condition of each constraint on single rows."""
        out = {f"not_null({c})": F.col(c).isNull() for c in (*self.key, *self.not_null)}
        out |= {f"domain({c})": ~F.col(c).isin(list(v)) for c, v in self.domains.items()}
        return out | {f"check({n})": ~F.expr(sql) for n, sql in self.checks.items()}


def declared(table: str) -> Rules:
    """What ``strata.sources.schemas`` declares of a table."""
    return Rules(schemas.KEYS[table][0], schemas.NOT_NULL.get(table, ()),
                 {c: v for (t, c), v in schemas.DOMAINS.items() if t == table},
                 schemas.CHECKS.get(table, {}), schemas.REFERENCES.get(table, {}))


def _ident(columns: Sequence[str]) -> Column:
    return F.array(*[F.col(c).cast("string") for c in columns])


def audit(tables: Mapping[str, DataFrame], rules: Mapping[str, Rules] | None = None) -> DataFrame:
    """(table_name, constraint, key, n_rows): every broken constraint with
    the key it was broken at (``null`` for a null column) and how many rows
    break it. ``tables`` may lack a table that others refer to; those
    references are then not checked.
    """
    rules = {t: declared(t) for t in tables} if rules is None else rules
    names: list[tuple[str, str, bool]] = []  # of every constraint; is it a reference?
    parts = []
    for table, df in tables.items():
        r = rules[table]
        failed = []
        for name, condition in r.row_conditions().items():
            failed.append(F.when(condition, F.lit(len(names))))
            names.append((table, name, False))
        own = F.struct(F.lit(table).alias("place"), _ident(r.key).alias("ident"), F.lit(1).alias("own"),
                       F.array_compact(F.array(*failed)).alias("marks"))
        sent = [own]
        for name, (columns, parent) in r.references.items():
            if parent not in tables:
                continue
            points = F.struct(F.lit(parent).alias("place"), _ident(columns).alias("ident"), F.lit(0).alias("own"),
                              F.array(F.lit(len(names))).alias("marks"))
            known = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in columns])
            sent.append(F.when(known, points))
            names.append((table, f"references({name})", True))
        parts.append(df.select(F.inline(F.array_compact(F.array(*sent)))))
    rows = reduce(DataFrame.union, parts)
    met = rows.groupBy("place", "ident").agg(
        F.sum("own").alias("own"),
        *[F.count_if(F.array_contains("marks", F.lit(i))).alias(f"m{i}") for i in range(len(names))])
    whole = ~F.exists("ident", lambda x: x.isNull())
    broken = [F.when((F.col("own") > 1) & whole, F.struct(F.col("place").alias("table_name"), F.lit("unique").alias("constraint"),
                                                          F.col("own").alias("n_rows")))]
    for i, (table, name, refers) in enumerate(names):
        at = (F.col(f"m{i}") > 0) & ((F.col("own") == 0) if refers else F.lit(True))
        broken.append(F.when(at, F.struct(F.lit(table).alias("table_name"), F.lit(name).alias("constraint"), F.col(f"m{i}").alias("n_rows"))))
    key = F.array_join("ident", "|", "null")
    found = met.select(key.alias("key"), F.inline(F.array_compact(F.array(*broken))))
    return found.select("table_name", "constraint", "key", "n_rows")
