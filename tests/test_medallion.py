"""Two batches through all layers, and the decisions about dirty input."""

from collections import Counter
from datetime import date

import pytest

from tillstone.plans import silver
from tillstone.plans.bronze import bronze_batch
from tillstone.plans.calendar import calendar_spine
from tillstone.plans.gold import GOLD, build_gold
from tillstone.plans.medallion import Batch, run_batch
from tillstone.schemas import DATASETS
from tillstone.sources import readers, retail_views
from tillstone.sources.tables import TableStore

SF = "/root/testdata/sf0.001"
MARCH, APRIL = date(2019, 3, 31), date(2019, 4, 30)


def _clean(spark, name, rows, **options):
    dataset = DATASETS[name]
    raw = spark.createDataFrame(rows, dataset.raw_schema)
    return silver.clean(raw, dataset, APRIL, APRIL, **options)


def _bag(df):
    return Counter(tuple(r) for r in df.collect())


@pytest.fixture(scope="module")
def lake_run(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("lake"))
    runs = []
    for index, (month, day) in enumerate((("2019-03", MARCH), ("2019-04", APRIL))):
        for dataset in DATASETS.values():
            rows = retail_views.batches(spark, SF, dataset)[index]
            retail_views.export_extract(rows, readers.batch_path(f"{root}/raw", month, dataset))
        runs.append(Batch(f"{root}/raw", root, month, day, as_of=APRIL))
    calendar = calendar_spine(retail_views.calendar_bounds(spark, SF))
    metrics = [run_batch(spark, run, calendar) for run in runs]
    return root, runs, metrics


def test_all_gold_tables_have_their_contract_and_unique_keys(spark, lake_run):
    root, _, _ = lake_run
    store = TableStore(spark, f"{root}/gold")
    for name, gold in GOLD.items():
        table = store.read(name, gold.schema)
        assert table.schema == gold.schema
        total, distinct = table.count(), table.select(gold.key).distinct().count()
        assert total == distinct > 0, name


def test_metrics_add_up(spark, lake_run):
    root, _, (first, second) = lake_run
    for name, gold in GOLD.items():
        total = TableStore(spark, f"{root}/gold").read(name, gold.schema).count()
        assert total == first[name]["rows_inserted"] + second[name]["rows_inserted"], name
        assert first[name]["rows_updated"] == 0, name
    assert second["fact_sales"]["rows_updated"] > 0
    assert second["dim_customer"]["rows_inserted"] > 0


def test_gold_equals_the_same_merge_without_tables(spark, lake_run):
    root, _, _ = lake_run
    dataset = DATASETS["sales"]
    first, second = (
        silver.clean(bronze_batch(rows, dataset, day).drop("processing_date"), dataset, day, APRIL)
        for rows, day in zip(retail_views.batches(spark, SF, dataset), (MARCH, APRIL), strict=True)
    )
    expected = build_gold("fact_sales", silver.merge_silver(first, second, dataset, APRIL))
    stored = TableStore(spark, f"{root}/gold").read("fact_sales", GOLD["fact_sales"].schema)
    assert _bag(stored) == _bag(expected)


def test_rerun_of_a_batch_changes_nothing(spark, lake_run):
    root, runs, _ = lake_run
    store = TableStore(spark, f"{root}/gold")
    before = {name: _bag(store.read(name, GOLD[name].schema)) for name in ("fact_sales", "dim_store")}
    again = run_batch(spark, runs[1], names=("sales", "store"))
    assert all(m["rows_inserted"] == 0 for m in again.values())
    for name, rows in before.items():
        assert _bag(store.read(name, GOLD[name].schema)) == rows, name


# Decisions about dirty input -------------------------------------------------------------


def _customer(key, since="2018-01-01", **changes):
    row = {
        "customer_id": key, "home_store": "3", "customer_first_name": " aNN ", "customer_email": "ann@shop.com",
        "customer_since": since, "loyalty_card_number": "L-1", "birthdate": "03/04/1990", "gender": "F",
        "birth_year": "1990",
    }
    return tuple({**row, **changes}.values())


def test_silver_holds_cleaned_values(spark):
    row = _clean(spark, "customer", [_customer("1")]).collect()[0].asDict()
    assert row["customer_first_name"] == "Ann"
    assert row["customer_email"] == "Ann@shop.com"
    assert row["birthdate"] == date(1990, 3, 4)
    assert row["gender"] == "Female"
    assert row["processing_date"] == APRIL


def test_trim_comes_before_dedup_and_the_latest_row_wins(spark):
    rows = [_customer("1 ", since="2018-01-01"), _customer("1", since="2018-06-01"), _customer("1", since="2999-01-01")]
    out = _clean(spark, "customer", rows).collect()
    assert [(r["customer_id"], r["customer_since"]) for r in out] == [(1, date(2018, 6, 1))]


@pytest.mark.parametrize("key", [None, "", "  ", "abc"])
def test_rows_without_a_key_are_rejected_and_logged(spark, key):
    dataset = DATASETS["customer"]
    raw = spark.createDataFrame([_customer(key), _customer("2")], dataset.raw_schema)
    valid, rejects = silver.clean_with_rejects(raw, dataset, APRIL, APRIL)
    assert [r["customer_id"] for r in valid.collect()] == [2]
    assert [(r["rule"], r["copies"]) for r in rejects.collect()] == [("null:customer_id", 1)]


def _sale(**changes):
    row = {
        "transaction_id": "1", "transaction_date": "2019-04-01", "transaction_time": "07:00:00", "store_id": "3",
        "staff_id": "6", "customer_id": "9", "instore_yn": "yes", "order": "1", "line_item_id": "1",
        "product_id": "5", "quantity_sold": "2", "unit_price": "2.666", "promo_item_yn": None,
    }
    return tuple({**row, **changes}.values())


@pytest.mark.parametrize(
    "changes", [{"customer_id": " "}, {"transaction_date": "2999-01-01"}, {"transaction_time": ""}, {"store_id": None}]
)
def test_incomplete_sales_are_dropped_after_parsing(spark, changes):
    assert _clean(spark, "sales", [_sale(), _sale(**changes, line_item_id="2")]).count() == 1


def test_repeated_sale_lines_are_merged_to_one(spark):
    out = _clean(spark, "sales", [_sale(), _sale(), _sale(quantity_sold="3")]).collect()
    assert [(r["quantity_sold"], r["unit_price"], r["instore_yn"], r["promo_item_yn"]) for r in out] == [(2, 2.67, "Y", "N")]


def test_inventory_without_a_key_part_is_dropped(spark):
    rows = [("3", "2019-04-01", "2019-04-02", "7", "10", "4"), ("3", "n/a", "2019-04-02", "7", "10", "4")]
    out = _clean(spark, "food_inventory", rows).collect()
    assert [(r["baked_date_id"], r["transaction_date_id"]) for r in out] == [("20190401", "20190402")]


def test_store_rules_all_apply(spark):
    row = ("3", " retail ", "1300", "a", "b", "NY", "11106", "-73.9", "40.7", "6.0", " Astoria ")
    out = _clean(spark, "store", [row, row]).collect()
    assert [(r["store_id"], r["store_type"], r["manager"], r["neighorhood"]) for r in out] == [(3, "retail", 6.0, "Astoria")]


def test_the_latest_row_survives_bronze_and_silver(spark):
    dataset = DATASETS["customer"]
    rows = [
        _customer("1", since="2018-01-01", home_store="2"), _customer("1", since="06/01/2018", home_store="3"),
        _customer("1", since="2999-01-01", home_store="1"), _customer("1", since=None, home_store="0"),
    ]
    raw = spark.createDataFrame(rows, dataset.raw_schema)
    kept = bronze_batch(raw, dataset, APRIL, APRIL).drop("processing_date")
    assert [(r["customer_since"], r["home_store"]) for r in kept.collect()] == [("06/01/2018", "3")]
    assert _bag(silver.clean(kept, dataset, APRIL, APRIL)) == _bag(silver.clean(raw, dataset, APRIL, APRIL))


def test_a_whole_run_keeps_the_latest_row(spark, tmp_path):
    dataset = DATASETS["employee"]
    rows = [("6", "ann", "lee", "Roaster", start, place) for start, place in (("2011-01-02", "3"), ("2014-05-06", "5"))]
    raw = spark.createDataFrame(rows, dataset.raw_schema)
    retail_views.export_extract(raw, readers.batch_path(f"{tmp_path}/raw", "2019-04", dataset))
    run_batch(spark, Batch(f"{tmp_path}/raw", str(tmp_path), "2019-04", APRIL, as_of=APRIL), names=("employee",))
    out = TableStore(spark, f"{tmp_path}/gold").read("dim_employee", GOLD["dim_employee"].schema).collect()
    assert [(r["start_date"], r["store_id"]) for r in out] == [(date(2014, 5, 6), 5)]


def test_bronze_keeps_text_and_one_row_per_key(spark):
    dataset = DATASETS["store"]
    row = ("3", " retail ", "x", "a", "b", "NY", "11106", "-73.9", "40.7", "6.0", None)
    raw = spark.createDataFrame([row, row, (None, *row[1:])], dataset.raw_schema)
    out = bronze_batch(raw, dataset, APRIL).collect()
    assert [(r["store_type"], r["store_square_feet"], r["processing_date"]) for r in out] == [(" retail ", "x", APRIL)]


def test_schemas_match_the_registry(spark):
    for dataset in DATASETS.values():
        raw = retail_views.raw(spark, SF, dataset.name)
        out = silver.clean(raw, dataset, APRIL, APRIL)
        assert [(f.name, f.dataType) for f in out.schema] == [(f.name, f.dataType) for f in dataset.silver]
