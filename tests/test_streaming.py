from collections import Counter
from datetime import date

from tillstone.plans.bronze import bronze_schema
from tillstone.schemas import DATASETS
from tillstone.sources import landing
from tillstone.sources.tables import TableStore
from tillstone.streaming.incremental import merge_new_batches


def test_new_landing_batches_are_merged_once(spark, lake):
    dataset = DATASETS["employee"]
    store = TableStore(spark, f"{lake}/bronze")

    def land(day, rows):
        df = spark.createDataFrame(rows, dataset.raw_schema)
        landing.write_partitioned(landing.stamp_processing_date(df, day), f"{lake}/landing/{dataset.file_stem}")

    def run():
        merge_new_batches(spark, store, f"{lake}/landing", dataset, f"{lake}/checkpoint").awaitTermination()
        table = store.read(dataset.bronze_table, bronze_schema(dataset))
        return Counter((r["staff_id"], r["location"], r["processing_date"]) for r in table.collect())

    march, april = date(2019, 3, 31), date(2019, 4, 30)
    land(march, [("6", "Karen", "Cupps", "Store Manager", "2016-07-24", "3"), ("7", "a", "b", "c", "d", "3")])
    assert run() == Counter([("6", "3", march), ("7", "3", march)])
    land(april, [("7", "a", "b", "c", "d", "5"), ("8", "a", "b", "c", "d", "8")])
    expected = Counter([("6", "3", march), ("7", "5", april), ("8", "8", april)])
    assert run() == expected
    merges = store.history(dataset.bronze_table).count()
    assert run() == expected
    assert store.history(dataset.bronze_table).count() == merges
