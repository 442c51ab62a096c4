"""What facts carry to their dimensions: only what does not follow from the rest."""

from collections import Counter
from datetime import date

from tillstone import registry
from tillstone.plans import silver
from tillstone.schemas import DATASETS

SF = "/root/testdata/sf0.001"
APRIL = date(2019, 4, 30)


def _plan(spark, name):
    return registry.QUERIES[name](spark, SF)._jdf.queryExecution().optimizedPlan().toString()


def test_digests_are_set_after_facts_met_their_dimensions(spark):
    plan = _plan(spark, "sales_star")
    assert "Join" in plan
    assert plan.index("sha2(") < plan.index("Join")


def test_facts_find_their_copies_by_text(spark):
    """No digest is moved to the copies of a sale, nor is the key of its day to the dimensions."""
    plan = _plan(spark, "sales_star")
    assert "sha2(" not in plan[plan.index("Join"):]
    above, below = plan.split("_product#", 1)
    assert "year(transaction_date#" in above and "year(transaction_date#" not in below


def test_sales_are_the_same_by_text_and_by_digest(spark):
    """Keys that differ only by which part is missing, in spelling, or not at all; incomplete rows beside complete ones."""
    dataset = DATASETS["sales"]
    usual = {c: "7" for c in dataset.raw_columns} | {"transaction_date": "2019-01-05", "transaction_time": "10:00:00"}
    other = [
        {}, {}, {"quantity_sold": "3"}, {"customer_id": None, "quantity_sold": "1"}, {"order": None, "line_item_id": "8"},
        {"order": "8", "line_item_id": None}, {"order": None, "line_item_id": None}, {"transaction_id": "07"}, {"transaction_date": "1/5/2019"},
        {"transaction_id": None}, {"transaction_id": "9"}, {"transaction_id": "9", "unit_price": None}, {"transaction_id": "10", "store_id": "x"},
    ]
    rows = spark.createDataFrame([tuple((usual | o)[c] for c in dataset.raw_columns) for o in other], dataset.raw_schema)
    by_text, by_digest = silver.clean_sales_by_text(rows, APRIL, APRIL), silver.clean(rows, dataset, APRIL, APRIL)
    assert by_text.columns == by_digest.columns
    bags = [Counter(tuple(r) for r in df.collect()) for df in (by_text, by_digest)]
    assert bags[0] == bags[1] and sum(bags[0].values()) == 4
