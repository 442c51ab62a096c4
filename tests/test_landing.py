from datetime import date

import pytest
from pyspark.sql import functions as F

from tillstone.plans.bronze import load_bronze, rejects_schema
from tillstone.schemas import DATASETS
from tillstone.sources import landing, readers, retail_views
from tillstone.sources.quality_log import QualityLog
from tillstone.sources.tables import TableStore

MARCH, APRIL = date(2019, 3, 31), date(2019, 4, 30)
STORES = [("3", "retail", "1300", "32-20 Broadway, 1st", "LIC", "NY", "11106", "-73.9", "40.7", "6.0", " Astoria ")]


def _extract(spark, root, month, rows, name="store"):
    dataset = DATASETS[name]
    df = spark.createDataFrame(rows, dataset.raw_schema)
    df = df.withColumnRenamed("neighorhood", "Neighorhood")
    retail_views.export_extract(df, readers.batch_path(root, month, dataset))


def test_csv_is_read_as_text(spark, lake):
    _extract(spark, lake, "2019-03", STORES)
    df = readers.scan_batch(spark, lake, "2019-03", DATASETS["store"])
    assert {t for _, t in df.dtypes} == {"string"}
    assert tuple(df.collect()[0]) == STORES[0]


def test_land_guard_and_rerun(spark, lake):
    dataset = DATASETS["store"]
    raw, out = f"{lake}/raw", f"{lake}/landing"
    _extract(spark, raw, "2019-03", STORES)
    _extract(spark, raw, "2019-04", [])
    assert landing.land_batch(spark, raw, out, dataset, "2019-03", MARCH) is True
    assert landing.land_batch(spark, raw, out, dataset, "2019-03", MARCH) is True
    assert landing.land_batch(spark, raw, out, dataset, "2019-04", APRIL) is False
    landed = readers.scan_landing(spark, out, dataset)
    assert landed.count() == 1
    # Columns resolve in any case; the misspelt header differs from the contract only in case.
    assert landed.collect()[0]["neighorhood"] == " Astoria "
    assert landed.collect()[0]["processing_date"] == MARCH


def test_batches_are_pruned(spark, lake):
    dataset = DATASETS["store"]
    raw, out = f"{lake}/raw", f"{lake}/landing"
    for month, day in (("2019-03", MARCH), ("2019-04", APRIL)):
        _extract(spark, raw, month, STORES)
        landing.land_batch(spark, raw, out, dataset, month, day)
    one = readers.scan_one_partition(spark, out, dataset, APRIL)
    plan = one._jdf.queryExecution().simpleString()
    assert "PartitionFilters: [isnotnull(processing_date" in plan
    files = {r[0] for r in one.select(F.col("_metadata.file_path")).collect()}
    assert one.count() == 1 and all("processing_date=2019-04-30" in f for f in files)


def test_missing_columns_are_null(spark, lake):
    dataset = DATASETS["store"]
    spark.createDataFrame([("3",)], "STORE_ID string").write.parquet(f"{lake}/p")
    row = readers.scan_parquet_schema(spark, f"{lake}/p", dataset.raw_schema).collect()[0]
    assert row["store_id"] == "3" and row["manager"] is None


def _deliver(spark, path, header, lines):
    spark.createDataFrame([("\n".join([header, *lines]),)], "t string").coalesce(1).write.mode("overwrite").text(path)


HEAD = "STAFF_ID,first_name,Last_Name,position,start_date,location"


def test_delivered_headers_and_malformed_lines(spark, lake):
    dataset = DATASETS["employee"]
    lines = ["6,ann,lee,Roaster,2011-01-02,3", "7,bob", "8,cy,lo,Roaster,2011-01-02,3,extra", "", '9,"a, b",lo,Roaster,2011-01-02,5']
    _deliver(spark, readers.batch_path(f"{lake}/raw", "2019-04", dataset), HEAD, lines)
    assert landing.land_batch(spark, f"{lake}/raw", f"{lake}/landing", dataset, "2019-04", APRIL) is True
    rows = readers.scan_landing(spark, f"{lake}/landing", dataset).collect()
    assert sorted((r["staff_id"], r["first_name"], r["location"]) for r in rows) == [("6", "ann", "3"), ("9", "a, b", "5")]
    store = TableStore(spark, f"{lake}/bronze")
    assert load_bronze(spark, store, f"{lake}/landing", dataset, APRIL, APRIL)["rows_inserted"] == 2
    log = QualityLog(spark, f"{lake}/bronze")
    rejects = {(r["rule"], r[readers.MALFORMED]) for r in log.rejects("employee", rejects_schema(dataset)).collect()}
    assert rejects == {("malformed", "7,bob"), ("malformed", "8,cy,lo,Roaster,2011-01-02,3,extra")}
    audit = {r["rule"]: (r["rows_in"], r["dropped"]) for r in log.audit().collect()}
    assert audit == {"well_formed": (4, 2), "not_null": (2, 0), "dedup": (2, 0)}


@pytest.mark.parametrize(
    "header,message",
    [
        (HEAD.replace("position", "job"), r"unknown columns \['job'\]"), (HEAD.replace("STAFF_ID,", ""), r"missing \['staff_id'\]"),
        (HEAD.replace("Last_Name", "first_name"), "unknown columns|repeated"),
    ],
)
def test_headers_that_the_contract_does_not_know(spark, lake, header, message):
    dataset = DATASETS["employee"]
    _deliver(spark, readers.batch_path(f"{lake}/raw", "2019-04", dataset), header, ["6,a,b,c,d,3"])
    with pytest.raises(readers.HeaderMismatch, match=message):
        landing.land_batch(spark, f"{lake}/raw", f"{lake}/landing", dataset, "2019-04", APRIL)


def test_a_column_that_a_row_can_do_without_is_null(spark, lake):
    dataset = DATASETS["customer"]
    _deliver(spark, readers.batch_path(f"{lake}/raw", "2019-04", dataset), "customer_id,customer_first-name", ["1,Ann"])
    row = readers.scan_delivered(spark, f"{lake}/raw", "2019-04", dataset).collect()[0]
    assert (row["customer_id"], row["customer_first_name"], row["gender"]) == ("1", "Ann", None)


def test_files_of_one_extract_must_have_one_header(spark, lake):
    dataset = DATASETS["employee"]
    path = readers.batch_path(f"{lake}/raw", "2019-04", dataset)
    _deliver(spark, path, HEAD, ["6,ann,lee,Roaster,2011-01-02,3"])
    swapped = HEAD.replace("first_name,Last_Name", "Last_Name,first_name")
    spark.createDataFrame([(f"{swapped}\n7,lee,bob,Roaster,2011-01-02,3",)], "t string").write.mode("append").text(path)
    with pytest.raises(Exception, match="CSV header does not conform"):
        readers.scan_delivered(spark, f"{lake}/raw", "2019-04", dataset).collect()
