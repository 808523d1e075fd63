"""Every oracle SQL text is valid DuckDB SQL over the driver's views (no Spark needed)."""

import duckdb

import __spark_entry__ as E
from tests.conftest import SF_SMALL

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def test_oracle_sql_plans_in_duckdb():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    oracle = E.oracle_sql()
    assert set(oracle) <= set(E.queries())
    for name, sql in oracle.items():
        con.execute("EXPLAIN " + sql)          # raises on a syntax or binding error
