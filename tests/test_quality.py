from collections import Counter
from datetime import date

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tillstone.functions import keys
from tillstone.operators import quality
from tillstone.plans import analytics

SMALL = settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
ROWS = st.lists(
    st.tuples(
        st.sampled_from([None, 1, 2, 3]), st.sampled_from([None, "a", "b"]), st.sampled_from([None, 10, 20])
    ),
    max_size=25,
)
SCHEMA = "k int, tag string, day int"


def _order(row):
    """Newest day first, then tag ascending, NULLs last."""
    _, tag, day = row
    return (day is None, -(day or 0), tag is None, tag or "")


def _survivors(rows):
    best = {}
    for row in rows:
        if row[0] not in best or _order(row) < _order(best[row[0]]):
            best[row[0]] = row
    return Counter(best.values())


def _bag(df, *columns):
    return Counter(tuple(r) for r in df.select(*columns).collect())


@SMALL
@given(ROWS)
def test_keep_one_and_losers_against_brute_force(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA)
    kept = quality.keep_one(df, ["k"], ["day"])
    assert _bag(kept, "k", "tag", "day") == _survivors(rows)
    lost = {tuple(r)[:3]: r["copies"] for r in quality.losers(df, kept).collect()}
    assert Counter(lost) == Counter(rows) - _survivors(rows)


@SMALL
@given(ROWS)
def test_split_rejects_accounts_for_every_row(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA)
    valid, rejects = quality.split_rejects(df, ["k", "tag"], ["k"], ["day"])
    complete = [r for r in rows if r[0] is not None and r[1] is not None]
    assert _bag(valid, "k", "tag", "day") == _survivors(complete)
    rejected = rejects.collect()
    assert valid.count() + sum(r["copies"] for r in rejected) == len(rows)
    for r in rejected:
        missing = [c for c in ("k", "tag") if r[c] is None]
        assert r["rule"] == ("null:" + ",".join(missing) if missing else "duplicate:k")


def test_incomplete_rows_never_beat_complete_ones(spark):
    df = spark.createDataFrame([(1, None, 99), (1, "a", 1)], SCHEMA)
    kept = quality.keep_complete(df, ["tag"], ["k"], ["day"])
    assert [tuple(r) for r in kept.collect()] == [(1, "a", 1)]


def test_survivor_does_not_depend_on_partitioning(spark):
    rows = [(i % 3, f"t{i % 7}", i % 5) for i in range(200)]
    df = spark.createDataFrame(rows, SCHEMA)
    results = {
        tuple(sorted(tuple(r) for r in quality.keep_one(df.repartition(n), ["k"], ["day"]).collect())) for n in (1, 3, 8)
    }
    assert len(results) == 1


def test_hot_key_is_reduced_before_the_shuffle(spark):
    """A key with most of the rows must reach its reducer as one row per map task."""
    df = spark.range(0, 40_000, 1, 4).select(
        F.when(F.col("id") % 3 != 0, -1).otherwise(F.col("id")).alias("k"), F.col("id").alias("v")
    )
    kept = quality.keep_one(df, ["k"])
    plan = kept._jdf.queryExecution().simpleString()
    above, below = plan.split("Exchange hashpartitioning", 1)
    assert "WindowGroupLimit" in above and "WindowGroupLimit" in below and "Partial" in below
    assert kept.count() == 13_335
    assert kept.filter("k = -1").collect()[0]["v"] == 1


def test_dq_audit(spark):
    rows = [(1, "a", 1), (1, "a", 2), (2, None, 1), (None, "b", 1), (3, "c", 1)]
    out = quality.dq_audit(spark.createDataFrame(rows, SCHEMA), "things", ["k", "tag"], ["k"]).collect()
    assert [tuple(r) for r in out] == [("things", "not_null", 5, 3, 2), ("things", "dedup", 3, 2, 1)]


def test_references(spark):
    child = spark.createDataFrame([(1, 3), (2, 4), (3, 4), (4, None)], "id int, store int")
    parent = spark.createDataFrame([(3,), (5,), (None,)], "store_id int")
    assert [r["id"] for r in quality.orphans(child, parent, "store", "store_id").orderBy("id").collect()] == [2, 3]
    assert [r["id"] for r in quality.with_parent(child, parent, "store", "store_id").collect()] == [1]
    references = [("store", parent, "store_id", "to store"), ("id", parent, "store_id", "by id")]
    report = {(r["relation"], r["orphan_key"]): r["n_rows"] for r in quality.orphan_keys(child, references).collect()}
    assert report == {("to store", "4"): 2, ("by id", "1"): 1, ("by id", "2"): 1, ("by id", "4"): 1}


def test_repeated_keys(spark):
    df = spark.createDataFrame([(1, "a", 1), (1, "a", 2), (2, "a", 1)], SCHEMA)
    assert [tuple(r) for r in quality.repeated_keys(df, ["k", "tag"]).collect()] == [(1, "a", 2)]


@pytest.mark.parametrize("columns", [["k"], ["k", "tag"]])
def test_require_not_null(spark, columns):
    df = spark.createDataFrame([(1, None, 1), (None, "a", 1), (2, "b", None)], SCHEMA)
    kept = quality.require_not_null(df, columns).collect()
    assert all(r[c] is not None for r in kept for c in columns)
    assert len(kept) == 3 - len(columns)


def test_a_key_has_one_spelling(evaluate):
    spellings = ["3", " 03 ", "3.0", "x7 ", "", "  ", None]
    assert evaluate(keys.reference_key, spellings) == ["3", "3", "3", "x7", None, None, None]


def test_customers_without_purchases_and_unstocked_days_count_as_such(spark):
    fact = spark.createDataFrame([(1, 2.5), (1, 1.0), (9, 4.0)], "customer_id int, revenue double")
    customer = spark.createDataFrame([(1, "L"), (2, "M"), (3, None)], "customer_id int, loyalty_card_number string")
    found = {tuple(r) for r in analytics.loyalty_engagement(fact, customer).collect()}
    assert found == {("card", 2, 1, 2, 3.5), ("no card", 1, 0, 0, 0.0), ("unknown", 1, 1, 1, 4.0)}
    days = [(1, 1, date(2019, 4, 1), 5, "Y"), (1, 1, date(2019, 4, 1), 5, "N"), (1, 1, date(2019, 4, 2), 0, "Y")]
    stock = spark.createDataFrame(
        days, "store_id int, product_id int, transaction_date date, quantity_start_of_day int, stockout_flag string"
    )
    assert [tuple(r) for r in analytics.stockout_events(stock).collect()] == [(1, 1, 2, 1)]


def test_keys_meet_their_parents_without_a_side_in_memory(spark, tmp_path):
    """Parents in small files may have many keys: no plan sends them to every task through the driver."""
    spark.range(2_000).selectExpr("id % 7 as id").write.parquet(f"{tmp_path}/parents")
    child = spark.createDataFrame([(3, None), (8, 1), (8, 9), (None, 9)], "a int, b int")
    parent = spark.read.parquet(f"{tmp_path}/parents").unionByName(spark.createDataFrame([(None,)], "id bigint"))
    found = quality.orphan_keys(child, [("a", parent, "id", "a"), ("b", parent, "id", "b")])
    plan = found._jdf.queryExecution().simpleString()
    assert "Broadcast" not in plan and plan.count("Exchange hashpartitioning") == 1
    assert Counter(tuple(r) for r in found.collect()) == Counter([("a", "8", 2), ("b", "9", 2)])
