"""What the plans must not hold, at any scale."""

import re

import pytest

import __spark_entry__ as contract
from conftest import SF

FROM_API = {"read_paged", "read_dataset", "read_invoices", "read_single", "read_fleet", "read_filtered"}


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", [q.__name__ for q in contract._QUERIES if q.__name__ not in FROM_API])
def test_no_python_no_products_no_single_task(spark, name):
    plan = plan_of(contract.queries()[name](spark, SF))
    for node in ("EvalPython", "MapInPandas", "MapInArrow", "InPandas", "CartesianProduct", "NestedLoop", "Window"):
        assert node not in plan
    # a sort, if any, is within partitions
    assert not re.search(r"Sort \[.*\], true", plan)
    assert "SinglePartition" not in plan
    assert "rangepartitioning" not in plan


@pytest.mark.parametrize("name", [q.__name__ for q in contract._QUERIES if q.__name__ not in FROM_API])
def test_bodies_are_parsed_once_per_scan(spark, name):
    # an inferred filter in front of an explode would hold a second from_json of the same text
    spark.conf.set("spark.sql.debug.maxToStringFields", "10000")
    try:
        plan = plan_of(contract.queries()[name](spark, SF))
    finally:
        spark.conf.unset("spark.sql.debug.maxToStringFields")
    filters = [line for line in plan.splitlines() if re.match(r"[\s:+-]*Filter ", line)]
    assert not [line for line in filters if "from_json" in line]


def test_filters_and_columns_reach_the_scan(spark):
    plan = plan_of(contract.queries()["read_by_key"](spark, SF))
    scans = [line for line in plan.splitlines() if "FileScan parquet" in line]
    # the keys take one column of the lines; the invoices take no column that they do not hold
    assert any(re.search(r"FileScan parquet \[l_orderkey#\d+L\] ", line) for line in scans)
    assert not any("l_returnflag" in line for line in scans)


def test_only_needed_fields_are_parsed(spark):
    from pagedframes import fixtures as fx
    from pagedframes.operators import typed_rows

    items = fx.items_of(fx.invoice_records(spark, SF)).select("item")
    plan = typed_rows(items, fx.INVOICE).select("number")._jdf.queryExecution().optimizedPlan().toString()
    parsed = re.search(r"from_json\((StructField\(number,IntegerType,true\)), ", plan)
    assert parsed


def test_joins_with_small_keys_broadcast_by_size_only(spark):
    """No hint forces a broadcast: with the threshold off, joins shuffle."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    try:
        for name in ("read_by_key", "unmatched_keys", "missing_params", "missing_pages"):
            assert "Broadcast" not in plan_of(contract.queries()[name](spark, SF))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")
