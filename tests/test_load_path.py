"""The load path: what is refused, logged, counted, skipped and merged, batch after batch."""

from collections import Counter
from datetime import date

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tillstone.operators import quality
from tillstone.operators.upsert import ACTION, Upsert, in_catalog
from tillstone.plans import silver
from tillstone.plans.bronze import bronze_batch, bronze_schema, merge_landing, rejects_schema, tagged_batch
from tillstone.plans.gold import GOLD
from tillstone.plans.medallion import Batch, BatchFailed, check_references, load_gold, load_silver, orphans_of_runs, run_batch
from tillstone.schemas import DATASETS
from tillstone.sources import landing, readers, retail_views

MARCH, APRIL = date(2019, 3, 31), date(2019, 4, 30)
SMALL = settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
ROWS = st.lists(
    st.tuples(st.sampled_from([None, 1, 2, 3]), st.sampled_from([None, "a", "b"]), st.sampled_from([None, 10, 20])), max_size=25
)


def _bag(df, *columns):
    return Counter(tuple(r) for r in df.select(*(columns or df.columns)).collect())


# One pass over a batch -------------------------------------------------------------------


@SMALL
@given(ROWS, st.integers(1, 5), st.integers(1, 4))
def test_triage_as_survivors_and_rejects(spark, rows, salts, parts):
    df = spark.createDataFrame(rows, "k int, tag string, day int").repartition(parts)
    tagged = quality.triage(df, ["k", "tag"], ["k"], ["day"], salts=salts)
    valid, rejects = quality.split_rejects(df, ["k", "tag"], ["k"], ["day"])
    assert _bag(tagged.filter("rule is null"), "k", "tag", "day") == _bag(valid)
    counted = tagged.filter("rule is not null").groupBy("k", "tag", "day", "rule").agg(F.count(F.lit(1)).alias("copies"))
    assert _bag(counted, "k", "tag", "day", "copies", "rule") == _bag(rejects, "k", "tag", "day", "copies", "rule")


def test_triage_reads_once_and_deals_a_hot_key_out(spark):
    """A key with two thirds of the rows, and rows without a key, over all tasks."""
    df = spark.range(0, 40_000, 1, 4).select(
        F.when(F.col("id") % 6 == 0, None).when(F.col("id") % 3 != 0, -1).otherwise(F.col("id")).alias("k"), F.col("id").alias("v")
    )
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        tagged = quality.triage(df, ["k"], ["k"])
        plan = tagged._jdf.queryExecution().simpleString()
        sizes = [r["n"] for r in tagged.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect()]
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert plan.count("Range (0, 40000") == 1
    assert max(sizes) < 15_000 and sum(sizes) == 40_000
    assert _bag(tagged.filter("k = -1 and rule is null"), "v") == Counter([(1,)])


@pytest.mark.parametrize("name", DATASETS)
def test_bronze_survivors_are_those_of_the_plain_dedup(spark, name):
    dataset = DATASETS[name]
    for rows in retail_views.batches(spark, "/root/testdata/sf0.001", dataset):
        tagged = tagged_batch(rows, dataset, APRIL)
        kept = bronze_batch(rows, dataset, APRIL, APRIL).drop("processing_date")
        assert _bag(tagged.filter("rule is null").drop("rule", readers.MALFORMED)) == _bag(kept)
        assert tagged.count() == rows.count()


# Two batches through the layers ----------------------------------------------------------


def _stock(store, product, day, sold="4", baked=None):
    return (store, baked or day, day, product, "10", sold)


FIRST = [
    _stock("3", "7", "2019-01-05"), _stock("3", "7", "2019-01-05", sold="5"), _stock("3", "8", "2019-02-05"), _stock("3", "9", "03/05/2019"),
    _stock(None, "7", "2019-01-05"), _stock("3", "7", "someday"), _stock("3", "7", "2999-01-01"), _stock("x", "7", "2019-01-05"),
    _stock("03", "8", "2019-02-05", sold="9"),
]
SECOND = [_stock("3", "8", "2019-02-05", sold="6"), _stock("3", "5", "2019-02-07")]


def _land(spark, batch, name, rows):
    dataset = DATASETS[name]
    df = landing.stamp_processing_date(spark.createDataFrame(rows, dataset.raw_schema), batch.processing_date)
    landing.write_partitioned(df, f"{batch.landing_root}/{dataset.file_stem}")


def _load(spark, batch, name, table):
    dataset, bronze = DATASETS[name], batch.store(spark, "bronze")
    rows = readers.scan_one_partition(spark, batch.landing_root, dataset, batch.processing_date)
    return [merge_landing(bronze, rows, dataset, batch.processing_date, APRIL), load_silver(spark, batch, dataset), load_gold(spark, batch, table)]


@pytest.fixture(scope="module")
def stocked(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("stock"))
    batches = [Batch(f"{root}/raw", root, str(day)[:7], day, as_of=APRIL) for day in (MARCH, APRIL)]
    for batch, rows in zip(batches, (FIRST, SECOND)):
        _land(spark, batch, "food_inventory", rows)
    return batches, [_load(spark, b, "food_inventory", "fact_inventory") for b in batches]


def test_every_row_stays_or_is_logged(spark, stocked):
    batches, _ = stocked
    dataset = DATASETS["food_inventory"]
    bronze = batches[1].quality(spark, "bronze").rejects("food_inventory", rejects_schema(dataset))
    assert _bag(bronze, "rule", "store_id", "transaction_date", "processing_date") == Counter({
        ("null:store_id", None, "2019-01-05", MARCH): 1, ("date:transaction_date", "3", "someday", MARCH): 1,
        ("date:transaction_date", "3", "2999-01-01", MARCH): 1,
        ("duplicate:store_id,product_id,baked_date,transaction_date", "3", "2019-01-05", MARCH): 1,
    })
    rejects = batches[1].quality(spark, "silver").rejects("food_inventory", silver.delivered_schema(dataset))
    assert _bag(rejects, "rule", "delivered.store_id", "quantity_sold") == Counter(
        [("null:store_id", "x", 4), ("duplicate:inventory_id", "03", 9)]
    )
    kept = batches[0].store(spark, "silver").read(dataset.silver_table, dataset.silver).count()
    assert kept == 4 and 9 == 4 + 2 + 3  # rows in = rejects of bronze + of silver + rows that stay of the first batch


def test_audit_of_a_run_equals_the_audit_query(spark, stocked):
    batches, _ = stocked
    dataset = DATASETS["food_inventory"]
    audit = batches[1].quality(spark, "silver").audit().filter(F.col("processing_date") == F.lit(MARCH))
    taken = bronze_batch(spark.createDataFrame(FIRST, dataset.raw_schema).filter("transaction_date not in ('someday', '2999-01-01')"), dataset, MARCH, APRIL)
    standard = silver.standardise(taken.drop("processing_date"), dataset, MARCH, APRIL)
    want = quality.dq_audit(standard, "food_inventory", dataset.mandatory, dataset.silver_key)
    assert _bag(audit, *want.columns) == _bag(want)
    steps = batches[1].quality(spark, "bronze").audit().filter(F.col("processing_date") == F.lit(MARCH))
    assert _bag(steps, "rule", "rows_in", "rows_out", "dropped") == Counter([("well_formed", 9, 9, 0), ("not_null", 9, 8, 1), ("real_date", 8, 6, 2), ("dedup", 6, 5, 1)])


def test_a_batch_of_one_month_opens_one_part_in_every_layer(spark, stocked):
    batches, _ = stocked
    dataset, gold = DATASETS["food_inventory"], GOLD["fact_inventory"]
    tables = (
        ("bronze", dataset.bronze_table, bronze_schema(dataset)), ("silver", dataset.silver_table, dataset.silver), ("gold", gold.name, gold.schema),
    )
    for layer, table, schema in tables:
        store = batches[1].store(spark, layer)
        everything = {f.split("/part=")[1][:7] for f in store.read(table, schema).inputFiles()}
        assert everything == {"2019-01", "2019-02", "2019-03"}
        rows = store.read_incremental(table, schema, APRIL)
        assert {f.split("/part=")[1][:7] for f in rows.inputFiles()} == {"2019-02"}
        assert rows.count() == 2


def test_actions_and_metrics_of_the_second_batch(spark, stocked):
    batches, (first, second) = stocked
    for layer, table, schema in (("silver", "inventory_silver", DATASETS["food_inventory"].silver), ("gold", "fact_inventory", GOLD["fact_inventory"].schema)):
        rows = batches[1].store(spark, layer).read_with_actions(table, schema)
        assert _bag(rows, "product_id", "quantity_sold", ACTION) == Counter([(7, 4, "keep"), (9, 4, "keep"), (8, 6, "update"), (5, 4, "insert")])
    assert [(m["rows_inserted"], m["rows_updated"]) for m in first] == [(5, 0), (3, 0), (3, 0)]
    assert [(m["rows_inserted"], m["rows_updated"]) for m in second] == [(1, 1), (1, 1), (1, 1)]


def test_an_older_batch_run_again_takes_nothing_back(spark, stocked):
    batches, _ = stocked
    layers = (("silver", "inventory_silver", DATASETS["food_inventory"].silver), ("gold", "fact_inventory", GOLD["fact_inventory"].schema))
    before = [_bag(batches[1].store(spark, layer).read(table, schema)) for layer, table, schema in layers]
    again = _load(spark, batches[0], "food_inventory", "fact_inventory")
    assert all(m["rows_inserted"] == 0 for m in again)
    assert [_bag(batches[1].store(spark, layer).read(table, schema)) for layer, table, schema in layers] == before
    # The log holds each batch once, by its last load.
    audit = batches[1].quality(spark, "bronze").audit()
    assert _bag(audit.groupBy("processing_date", "rule").count(), "count") == Counter({(1,): 8})


def test_conditions_of_a_merge(spark):
    target = spark.createDataFrame([(1, "a", 5), (2, "b", 5), (3, "c", None)], "k int, v string, day int")
    source = spark.createDataFrame([(1, "x", 4), (2, "y", 6), (3, "z", 1), (4, "n", 0)], "k int, v string, day int")
    merge = Upsert(target).using(source).on("k").when_matched_update(condition="source.day >= target.day").when_not_matched_insert()
    assert _bag(merge.with_actions()) == Counter([(1, "a", 5, "keep"), (2, "y", 6, "update"), (3, "c", None, "keep"), (4, "n", 0, "insert")])


@pytest.mark.parametrize(
    "text,want",
    [
        ("target.x + source.x", "cat.db.t.x + source.x"), ("concat(`target`.`a b`, 'target.x')", "concat(cat.db.t.`a b`, 'target.x')"),
        ("my_target.x > Target . y", "my_target.x > cat.db.t.y"), ("source.target.x", "source.target.x"), (r"'it\'s target.x' || target.z", r"'it\'s target.x' || cat.db.t.z"),
    ],
)
def test_expressions_for_a_catalog(text, want):
    assert in_catalog(text, "cat.db.t") == want


# Runs ------------------------------------------------------------------------------------


def test_ages_are_counted_on_the_day_of_the_run(spark, tmp_path):
    dataset, ages = DATASETS["employee"], []
    rows = [("6", "ann", "lee", "Roaster", "2012-05-06", "3")]
    for day in (APRIL, date(2021, 6, 30)):
        root = f"{tmp_path}/{day}"
        retail_views.export_extract(spark.createDataFrame(rows, dataset.raw_schema), readers.batch_path(f"{root}/raw", "2019-04", dataset))
        batch = Batch(f"{root}/raw", root, "2019-04", APRIL, as_of=APRIL, ref_date=day)
        run_batch(spark, batch, names=("employee",))
        ages += batch.store(spark, "gold").read("dim_employee", GOLD["dim_employee"].schema).select("duration", "duration_category").collect()
    assert [tuple(a) for a in ages] == [(6, "5-7yrs"), (9, "7-10yrs")]


def test_one_broken_extract_does_not_end_the_others(spark, tmp_path):
    batch = Batch(f"{tmp_path}/raw", str(tmp_path), "2019-04", APRIL, as_of=APRIL)
    for name, dataset in DATASETS.items():
        if name != "product":  # its extract is missing
            retail_views.export_extract(retail_views.raw(spark, "/root/testdata/sf0.001", name), readers.batch_path(batch.raw_root, "2019-04", dataset))
    with pytest.raises(BatchFailed, match="product: ") as failed:
        run_batch(spark, batch)
    assert set(failed.value.failures) == {"product"}
    for table in ("dim_customer", "dim_employee", "fact_inventory", "fact_sales", "dim_store"):
        assert failed.value.metrics[table]["rows_inserted"] == batch.store(spark, "gold").read(table, GOLD[table].schema).count() > 0


def test_orphans_of_a_run_are_logged_once(spark, tmp_path):
    batch = Batch(f"{tmp_path}/raw", str(tmp_path), "2019-04", APRIL, as_of=APRIL)
    store_row = ("3", "retail", "1", "a", "b", "NY", "1", "0", "0", "6.0", "x")
    staff = [(str(i), "a", "b", "Roaster", "2011-01-02", place) for i, place in enumerate(("3", "3.0", "4", "04", None))]
    for name, rows in (("employee", staff), ("store", [store_row])):
        _land(spark, batch, name, rows)
        _load(spark, batch, name, "dim_employee" if name == "employee" else "dim_store")
        check_references(spark, batch)
        found = _bag(orphans_of_runs(spark, batch), "dataset", "processing_date", "relation", "orphan_key", "n_rows")
        known = {} if name == "store" else {("employee", APRIL, "employee.location -> store", "3", 2): 1}
        assert found == Counter(known | {("employee", APRIL, "employee.location -> store", "4", 2): 1})
