"""Every registered query against its SQL statement, and the entry points."""

import math
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry_points
from ledgerlens.operators import data_tests

SF = "/root/testdata/sf0.001"
TABLES = ["orders", "lineitem", "events", "part", "supplier"]
pytestmark = pytest.mark.skipif(not Path(SF).exists(), reason="driver tables are absent")

QUERIES, ORACLES = entry_points.REGISTRY, entry_points.ORACLES


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as select * from read_parquet('{SF}/{name}.parquet')")
    return con


def plain(value):
    return None if isinstance(value, float) and math.isnan(value) else value


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)


def test_flagship(spark):
    rows = entry_points.entry(spark).collect()
    assert [r["rating_grade"] for r in rows] == list("ABCDEFG")


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_matches_its_oracle(spark, duck, name):
    df = QUERIES[name](spark, SF)
    columns = sorted(df.columns)
    got = [tuple(plain(v) for v in r) for r in df.select(*columns).collect()]
    cursor = duck.execute(ORACLES[name])
    named = [c[0] for c in cursor.description]
    assert sorted(named) == columns
    order = [named.index(c) for c in columns]
    want = [tuple(plain(r[i]) for i in order) for r in cursor.fetchall()]
    assert got, "an empty result proves nothing"
    assert sorted(got, key=repr) == sorted(want, key=repr)


@pytest.mark.parametrize("name", ["rwa_monthly_trend", "capital_by_grade", "alerts_by_rule", "alerts_by_type"])
def test_reports_name_no_party(spark, name):
    data_tests.forbid_identifiers(QUERIES[name](spark, SF))
