"""Each query against its SQL in DuckDB, on the smallest tables."""

import math
import os
import random
import re

import duckdb
import pytest

import __spark_entry__ as driver
from tidewell.plans import queries as plans
from tidewell.sources.rowsets import SqlSource

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="the tables aren't here")


def _plain(x):
    return "nan" if isinstance(x, float) and math.isnan(x) else repr(bytes(x) if isinstance(x, bytearray) else float(x) if isinstance(x, float) else x)


@pytest.fixture(scope="module")
def oracle():
    with duckdb.connect() as con:
        for t in TABLES:
            con.execute(f"create view {t} as select * from read_parquet('{SF}/{t}.parquet')")
        yield con


@pytest.mark.parametrize("name", sorted(plans.oracle_sql()))
def test_against_sql(spark, oracle, name):
    got = plans.queries()[name](spark, SF)
    columns = sorted(got.columns)
    assert columns == sorted(c[0] for c in oracle.execute(plans.oracle_sql()[name]).description)
    want = oracle.execute(f"select {', '.join(columns)} from ({plans.oracle_sql()[name]})").fetchall()
    rows = [tuple(r) for r in got.select(*columns).collect()]
    assert sorted(tuple(map(_plain, r)) for r in rows) == sorted(tuple(map(_plain, r)) for r in want)


def test_as_of_rows_of_edges(spark, tmp_path):
    """Bands, ties, repeated rows, nulls, zeros of both signs and values that aren't numbers, as the SQL itself has them."""
    nan, inf = math.nan, math.inf
    rng = random.Random(5)
    customers = [(k, rng.randrange(3), rng.randrange(-2000, 2000) / 4) for k in range(400)] + [(5000, 1, rng.choice([49.0, 51.0])), (5001, 9, 7.0), (5001, 9, 7.0), (5002, None, 1.0), (5003, 1, None), (None, 9, 8.0)]
    customers += [(5010 + k, n, x) for k, (n, x) in enumerate([(4, 0.0), (4, -0.0), (5, nan), (5, -inf), (6, inf), (6, 3.0), (7, 150.0), (7, 149.99), (7, 50.0)])]
    suppliers = [(k, rng.randrange(4), rng.randrange(-2200, 2200) / 4) for k in range(300)] + [(900, 1, None), (901, None, 5.0), (None, 1, 1.0), (902, 9, 9.0), (902, 9, 9.0), (903, 9, 1e6), (904, 9, 6.0)]
    suppliers += [(910 + k, n, x) for k, (n, x) in enumerate([(4, -0.0), (4, 0.0), (5, nan), (5, inf), (5, -inf), (6, inf), (6, nan), (6, 1e18), (7, 149.999), (7, 149.0), (7, -50.0), (8, 1.0)])]
    spark.createDataFrame(customers, "c_custkey long, c_nationkey int, c_acctbal double").write.parquet(str(tmp_path / "customer.parquet"))
    spark.createDataFrame(suppliers, "s_suppkey long, s_nationkey int, s_acctbal double").write.parquet(str(tmp_path / "supplier.parquet"))
    got = [tuple(r) for r in plans.queries()["sql_to_delta_asof_lateral"](spark, str(tmp_path)).collect()]
    with duckdb.connect() as con:
        for t in ("customer", "supplier"):
            con.execute(f"create view {t} as select * from read_parquet('{tmp_path}/{t}.parquet/*.parquet')")
        want = con.execute(plans.oracle_sql()["sql_to_delta_asof_lateral"]).fetchall()
    plain = lambda rows: sorted(tuple(_plain(x + 0.0 if isinstance(x, float) else x) for x in r) for r in rows)
    assert plain(got) == plain(want)


def test_as_of_rows_meet_in_order_not_in_pairs(spark):
    text = plans.SQL_LOADS["asof_lateral"][1]
    rows = SqlSource(text, {t: f"{SF}/{t}.parquet" for t in ("customer", "supplier")}).open(spark).rows
    found = rows._jdf.queryExecution().optimizedPlan().toString()
    assert not re.search(r"Join .*(<=|>=)", found), found
    assert "rows between" in text and "Window" in found


def test_every_query_has_sql():
    assert set(plans.queries()) == set(plans.oracle_sql())


def test_entry(spark):
    assert driver.entry(spark).count() > 0
    assert set(plans.queries()) <= set(driver.queries())
    assert set(plans.oracle_sql()) <= set(driver.oracle_sql())
