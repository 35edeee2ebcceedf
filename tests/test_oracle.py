"""Every registered query against its DuckDB SQL twin at sf0.001."""

import duckdb
import pytest

import __spark_entry__ as E
from lucrum.queries import REGISTRY
from tools.oracle_check import TABLES, duck_rows, spark_rows

SF = "/root/testdata/sf0.001"
NAMES = sorted(REGISTRY)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


PYTHON_NODES = ("PythonUDF", "BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas",
                "MapInPandas", "PythonMapInArrow")


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF)
    sc, sr, _ = spark_rows(df)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not any(node in plan for node in PYTHON_NODES), "Python in the plan"
    sql = E.oracle_sql().get(name)
    assert sql is not None, f"{name} has no oracle"
    dc, dr, _ = duck_rows(con, sql)
    assert sc == dc
    assert len(sr) == len(dr)
    assert sr == dr


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
