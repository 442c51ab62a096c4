"""Landing partitions as a file stream: new batches are merged as they arrive.

The stream's checkpoint remembers which files were taken in, in place of a
date parameter. Merging a batch again changes nothing, also when later ones
have come in meanwhile, so a batch that is retried after a failure is safe.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tillstone.plans.bronze import merge_landing
from tillstone.schemas import Dataset
from tillstone.sources.readers import landing_schema
from tillstone.sources.tables import TableStore


def stream_landing(spark: SparkSession, landing_root: str, dataset: Dataset) -> DataFrame:
    return spark.readStream.schema(landing_schema(dataset)).parquet(f"{landing_root}/{dataset.file_stem}")


def merge_new_batches(
    spark: SparkSession, store: TableStore, landing_root: str, dataset: Dataset, checkpoint: str, as_of: date | None = None
) -> StreamingQuery:
    """Merge everything that has arrived since the last run into the bronze table, oldest date first, and stop."""

    def merge(arrived: DataFrame, _batch_id: int) -> None:
        # One row per processing date in the batch.
        days = [r[0] for r in arrived.select("processing_date").distinct().orderBy("processing_date").collect()]
        for day in days:
            rows = arrived.filter(F.col("processing_date") == F.lit(day))
            merge_landing(store, rows, dataset, day, as_of)

    return (
        stream_landing(spark, landing_root, dataset)
        .writeStream.foreachBatch(merge)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
