"""The constraint audit against plain loops, and its plan."""

import re
from collections import Counter

from conftest import SF001, rows
from strata import catalog
from strata.operators.constraints import Rules, audit, declared
from strata.plans.inspect import plan_text
from strata.sources import schemas


def test_every_constraint_on_its_own(spark):
    parents = spark.createDataFrame([("1", "a"), ("2", "b"), ("2", "b"), (None, "a"), ("3", "z")], "id string, kind string")
    children = spark.createDataFrame(
        [(1, "1", "a", 5, 9), (1, "1", "a", 5, 4), (2, "9", "a", 5, None), (2, None, "a", None, 4), (3, "2", "b", 5, 9), (None, "2", "b", 5, 9), (None, "2", "b", 5, 9)],
        "n int, pid string, pkind string, x int, y int")
    rules = {
        "p": Rules(("id", "kind"), domains={"kind": ("a", "b")}),
        "c": Rules(("n",), not_null=("x",), checks={"order": "x <= y"}, references={"parent": (("pid", "pkind"), "p")}),
    }
    got = rows(audit({"p": parents, "c": children}, rules))
    assert got == sorted([
        ("p", "unique", "2|b", 2), ("p", "not_null(id)", "null|a", 1), ("p", "domain(kind)", "3|z", 1),
        ("c", "unique", "1", 2), ("c", "unique", "2", 2), ("c", "not_null(n)", "null", 2), ("c", "not_null(x)", "2", 1),
        ("c", "check(order)", "1", 1), ("c", "references(parent)", "9|a", 1)])
    assert audit({"p": parents.limit(0), "c": children.limit(0)}, rules).count() == 0
    # without the parent table its references are not judged
    assert "references(parent)" not in {r.constraint for r in audit({"c": children}, rules).collect()}


def test_a_key_that_holds_a_third_of_all_rows(spark):
    df = spark.range(30_000).selectExpr("IF(id % 3 = 0, 0, id) AS k", "IF(id % 3 = 0, 'no', 'a') AS v")
    got = audit({"t": df}, {"t": Rules(("k",), domains={"v": ("a",)})})
    assert rows(got) == [("t", "domain(v)", "0", 10_000), ("t", "unique", "0", 10_000)]
    physical = plan_text(got, "simple").split("== Physical Plan ==")[-1]
    assert "partial_sum" in physical  # combined before the shuffle


def test_all_tables_are_scanned_once(spark):
    physical = plan_text(catalog.q_constraint_audit(spark, SF001), "simple").split("== Physical Plan ==")[-1]
    scans = Counter(re.findall(r"(\w+)\.parquet", physical))
    # orders: vertices and players_scd; supplier: players and teams
    assert scans == {"orders": 2, "supplier": 2, "lineitem": 1, "events": 1}
    assert "Join" not in physical and physical.count("Exchange") == 1


def test_declared_rules_cover_the_tables():
    for table in schemas.KEYS:
        r = declared(table)
        columns = set(re.findall(r"(?:^|, )(\w+) ", schemas.SCHEMAS[table]))
        assert set(r.key) <= columns and set(r.not_null) <= columns and set(r.domains) <= columns
        for cols, parent in r.references.values():
            assert set(cols) <= columns and len(cols) == len(declared(parent).key)
    assert {"interval", "as_of"} == set(declared("players_scd").checks)
