"""Every query with SQL, against DuckDB on the smallest tables."""

from __future__ import annotations

import duckdb
import pytest

from millrace import registry

SF = "/root/testdata/sf0.001"
TABLES = ["customer", "part", "documents", "pages"]


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.sql(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return c


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_query(spark, con, name):
    got = registry.queries()[name](spark, SF).toPandas()
    want = con.sql(registry.oracle_sql()[name]).df()
    columns = sorted(got.columns)
    assert columns == sorted(want.columns)
    rows = [sorted(map(tuple, x[columns].astype(str).values.tolist())) for x in (got, want)]
    assert rows[0] == rows[1]
    spark.catalog.clearCache()


def test_low_cap_bites(spark):
    both = registry.queries()
    assert both["candidates_low_cap"](spark, "/root/testdata/sf0.01").count() != both["flagship_candidates"](spark, "/root/testdata/sf0.01").count()


def test_plan_limits_groups_early(spark):
    df = registry.queries()["flagship_candidates"](spark, SF)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "CartesianProduct" not in plan
