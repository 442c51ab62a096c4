"""What the physical plans of the registered queries must and must not contain."""

import re

import pytest

from tillstone.registry import QUERIES

SF = "/root/testdata/sf0.001"
LAZY = (
    "silver_sales", "fact_sales", "fact_inventory", "dim_customer", "sales_star", "inventory_star", "upsert_surrogate_key",
    "product_mix", "customer_demographics", "transaction_volume", "top_products_selling_out", "dq_audit",
    "check_referential_integrity", "key_uniqueness_audit", "merge_metrics",
)


def _plan(df):
    return df._jdf.queryExecution().simpleString()


@pytest.mark.parametrize("name", LAZY)
def test_no_python_rows_and_no_cross_joins(spark, name):
    plan = _plan(QUERIES[name](spark, SF))
    for forbidden in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython", "MapInPandas"):
        assert forbidden not in plan


def test_scans_read_only_what_is_needed(spark):
    plan = _plan(QUERIES["revenue_by_period"](spark, SF))
    lineitem = [s for s in re.findall(r"ReadSchema: struct<([^>]*)>", plan) if "l_partkey" in s]
    assert lineitem and all("l_tax" not in s and "l_extendedprice" not in s for s in lineitem)


def test_merge_reuses_the_partitioning_of_the_dedup(spark):
    """Two deduplicated sides: one exchange on the key each, none between them and the join."""
    plan = _plan(QUERIES["upsert_surrogate_key"](spark, SF))
    below_join = plan.split("SortMergeJoin", 1)[1]
    assert len(re.findall(r"Exchange hashpartitioning\(sales_key", below_join)) == 2


def test_facts_are_added_up_before_they_meet_a_dimension(spark):
    plan = _plan(QUERIES["customer_demographics"](spark, SF))
    join = plan.index("LeftOuter")
    assert "partial_sum" in plan[join:] and "HashAggregate(keys=[customer_id" in plan[join:]


def test_calendar_bounds_scan_each_table_once(spark):
    from tillstone.sources.retail_views import calendar_bounds

    assert _plan(calendar_bounds(spark, SF)).count("FileScan parquet") == 2
