"""Every bound query against its SQL in DuckDB on the smallest tables."""

import datetime
import os

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as driver
from tidemark.plans import bindings

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = "region nation customer supplier part orders lineitem events".split()


@pytest.fixture(scope="module")
def sql():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return con


def plain(v):
    if v is None or v is pd.NaT or v is pd.NA or (isinstance(v, float) and v != v):
        return ""
    if isinstance(v, bool) or type(v).__name__ == "bool_":
        return str(bool(v))
    if isinstance(v, datetime.date):
        return str(pd.Timestamp(v))[:26]
    if isinstance(v, (int, float)) or hasattr(v, "dtype"):
        return str(float(v)) if float(v) == int(v) else str(round(float(v), 6))
    return str(v)


def rows(df):
    df = df[sorted(df.columns)]
    flat = [[plain(v) for v in r] for r in df.itertuples(index=False)]
    return sorted(["1.0" if x == "True" else "0.0" if x == "False" else x for x in r] for r in flat)


@pytest.mark.parametrize("name", sorted(bindings.queries()))
def test_query_equals_sql(spark, sql, name):
    got = driver.queries()[name](spark, SF).toPandas()
    want = sql.execute(bindings.oracle_sql()[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got) == rows(want)


def test_every_query_has_sql():
    assert set(bindings.queries()) == set(bindings.oracle_sql())


def test_asof_plan_has_no_nested_loop(spark, capsys):
    driver.queries()["asof_adjust"](spark, SF).explain()
    plan = capsys.readouterr().out
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_percentiles_share_one_exchange(spark, capsys):
    from tidemark.operators import percentile

    series = spark.createDataFrame([("a", datetime.date(2020, 1, 1), 1.0, 2.0)], "code string, date date, v double, w double")
    percentile.percentiles(series, ["v", "w"]).explain()
    assert capsys.readouterr().out.count("Exchange") == 1
