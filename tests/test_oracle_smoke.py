"""Every registered query against its DuckDB oracle on the smallest driver tables."""

import math

import duckdb
import pytest

from __spark_entry__ import entry
from star_tables import SMOKE
from tillscope.registry import oracle_sql, queries

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem"]


def _norm(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    if type(v).__name__ == "Decimal":
        return round(float(v), 6)
    if hasattr(v, "isoformat"):
        return str(v)
    return v


def _sorted(rows, cols):
    out = [tuple(_norm(r[c]) for c in cols) for r in rows]
    return sorted(out, key=lambda t: tuple((x is None, str(x)) for x in t))


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SMOKE}/{t}.parquet')")
    return con


def test_entry_runs(spark):
    df = entry(spark)
    assert df.count() > 0
    assert "total_revenue" in df.columns


def test_every_query_has_an_oracle():
    assert set(queries()) == set(oracle_sql())


@pytest.mark.parametrize("name", sorted(set(oracle_sql())))
def test_query_matches_oracle(spark, duck, name):
    df = queries()[name](spark, SMOKE)
    srows = [r.asDict() for r in df.collect()]
    duck.execute(f"CREATE OR REPLACE VIEW oracle AS {oracle_sql()[name]}")  # as the statement must work inside a view
    rel = duck.sql("SELECT * FROM oracle")
    drows = [dict(zip(rel.columns, r)) for r in rel.fetchall()]
    assert sorted(df.columns) == sorted(rel.columns)
    assert len(srows) == len(drows)
    cols = sorted(df.columns)
    assert _sorted(srows, cols) == _sorted(drows, cols)
