"""The plans that loads run: filters and columns reach the scan, no row goes through Python, no shuffle without need."""

import os

import pytest

from tidewell.plans.queries import scan
from tidewell.sources.rowsets import SqlSource

SF = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="the tables aren't here")


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_filters_and_columns_reach_the_scan(spark):
    rows = SqlSource("select l_orderkey from lineitem where l_quantity < 5", {"lineitem": f"{SF}/lineitem.parquet"}).open(spark).rows
    found = plan(rows)
    assert "LessThan(l_quantity,5.0)" in found
    assert "ReadSchema: struct<l_orderkey:bigint,l_quantity:double>" in found


def test_loads_neither_shuffle_nor_leave_the_jvm(spark):
    found = plan(scan("lineitem")(spark, SF))
    assert "Exchange" not in found
    assert not any(x in found for x in ("Python", "Arrow", "Pandas"))


def test_aggregates_are_partial_before_the_shuffle(spark):
    rows = SqlSource("select l_returnflag, count(*) as n from lineitem group by l_returnflag", {"lineitem": f"{SF}/lineitem.parquet"}).open(spark).rows
    assert "partial_count" in plan(rows)
