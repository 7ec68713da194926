"""Driver contract: entry runs, every query has oracle SQL unless rows-only."""

import __spark_entry__ as E
from strata import catalog


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == ["dim_player_name", "dim_is_playing_at_home", "num_games", "total_points",
                          "bailed_num", "bailed_pct"]


def test_contract_keys():
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q)
    assert set(catalog.QUERIES) - set(o) == set(catalog.ROWS_ONLY)
    assert len(catalog.QUERIES) >= 50


def test_every_query_runs_on_smallest_data(spark):
    for name, fn in E.queries().items():
        if name not in catalog.QUERIES or name.startswith("stream_") or name in ("bucket_join", "layout_sizes", "csv_roundtrip_rows"):
            continue  # exercised in test_plans_streaming
        df = fn(spark, "/root/testdata/sf0.001")
        assert df.limit(1).count() >= 0, name


def test_every_oracle_statement_runs_on_duckdb():
    import os

    import duckdb

    from strata.sources.tables import TABLES
    con = duckdb.connect()
    for t in (*TABLES, "documents", "embeddings", "pages", "benchmark", "labels", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('/root/testdata/sf0.001/{t}.parquet')")
    assert os.path.exists("/root/testdata/sf0.001/orders.parquet")
    for name, sql in E.oracle_sql().items():
        res = con.execute(sql)
        cols = [d[0] for d in res.description]
        assert len(cols) == len(set(cols)), name
        res.fetchall()
