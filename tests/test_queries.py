"""Every query against its SQL in DuckDB, on the smallest tables."""

import os

import duckdb
import pytest

from stocktake import plans
from stocktake.session import TABLES

SF = os.environ.get("STOCKTAKE_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for t in TABLES:
        c.sql(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return c


def plain(row):
    return repr(tuple(float(x) + 0.0 if isinstance(x, float) else x for x in row))


@pytest.mark.parametrize("name", sorted(plans.QUERIES))
def test_query(spark, duck, name):
    df = plans.QUERIES[name](spark, SF)
    got = [tuple(r[c] for c in sorted(df.columns)) for r in df.collect()]
    assert got
    if name in plans.ORACLES:
        rel = duck.sql(plans.ORACLES[name])
        assert sorted(rel.columns) == sorted(df.columns)
        at = [rel.columns.index(c) for c in sorted(rel.columns)]
        want = [tuple(r[i] for i in at) for r in rel.fetchall()]
        assert sorted(map(plain, got)) == sorted(map(plain, want))


def test_entry_names():
    import __spark_entry__ as e

    assert set(e.oracle_sql()) <= set(e.queries())
    assert set(plans.QUERIES) <= set(e.queries())


def test_role_lines_past_a_hundred(spark, tmp_path):
    """Numbers of three digits come out as the SQL has them."""
    spark.range(1, 1500).selectExpr("id as s_suppkey", "cast(1 + id % 2 as int) as s_nationkey").write.parquet(f"{tmp_path}/supplier.parquet")
    c = duckdb.connect()
    c.sql(f"create view supplier as select * from read_parquet('{tmp_path}/supplier.parquet/*.parquet')")
    got = [tuple(r) for r in plans.QUERIES["scan_role_lines"](spark, str(tmp_path)).select("id", "chapitre", "texte", "role", "source", "ligne").collect()]
    rel = c.sql(f"select id, chapitre, texte, role, source, ligne from ({plans.ORACLES['scan_role_lines']})")
    assert len(got) > 200 and sorted(got) == sorted(rel.fetchall())
