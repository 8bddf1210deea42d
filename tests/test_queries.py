"""Every registered query with SQL, against DuckDB on the smallest tables."""

import os

import duckdb
import pandas as pd
import pytest

from lexicarium.plans import queries as plans

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for f in os.listdir(SF):
        con.sql(f"create view {f.split('.')[0]} as select * from read_parquet('{SF}/{f}')")
    return con


def plain(x):
    if hasattr(x, "tolist"):
        x = x.tolist()
    if isinstance(x, (list, tuple)):
        return str([plain(i) for i in x])
    if x is None or pd.isna(x):
        return None
    if isinstance(x, float):  # pandas turns integers beside nulls into floats
        return int(x) if x == int(x) else round(x, 6)
    return str(x) if isinstance(x, pd.Timestamp) else x


def rows(df):
    df = df[sorted(df.columns)]
    return list(df.columns), sorted((tuple(plain(x) for x in r) for r in df.itertuples(index=False, name=None)), key=repr)


@pytest.mark.parametrize("name", sorted(plans.ORACLE_SQL))
def test_query_equals_sql(spark, duck, name):
    assert rows(plans.QUERIES[name](spark, SF).toPandas()) == rows(duck.sql(plans.ORACLE_SQL[name]).df())


@pytest.mark.parametrize("name", sorted(set(plans.QUERIES) - set(plans.ORACLE_SQL)))
def test_query_without_sql_runs(spark, name):
    assert plans.QUERIES[name](spark, SF).count() > 0


def test_entry_imports_without_the_subpackage(tmp_path):
    import shutil
    import subprocess
    import sys

    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    shutil.copytree(f"{root}/lexicarium", tmp_path / "lexicarium", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(f"{root}/__spark_entry__.py", tmp_path)
    code = "import __spark_entry__ as e; q = e.queries(); assert q and not any(k.startswith('op') or k == 'pipeline' for k in q); assert set(e.oracle_sql()) <= set(q)"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, check=True, timeout=120)
