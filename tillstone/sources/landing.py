"""Raw CSV extracts to landing Parquet, partitioned by processing date."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillstone.schemas import DATASETS, Dataset
from tillstone.sources.readers import scan_delivered
from tillstone.sources.tables import CODEC


def stamp_processing_date(df: DataFrame, day: date) -> DataFrame:
    return df.withColumn("processing_date", F.lit(day))


def has_rows(df: DataFrame) -> bool:
    return not df.isEmpty()


def write_partitioned(df: DataFrame, path: str, files: int | None = None) -> None:
    """Write the partitions present in ``df``, replacing only those: a rerun of a batch changes nothing.

    ``files`` is for small lookups only; larger data keeps the partitioning of its scan.
    """
    out = df if files is None else df.coalesce(files)
    (
        out.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("compression", CODEC)
        .partitionBy("processing_date")
        .parquet(path)
    )


def land_batch(
    spark: SparkSession, raw_root: str, landing_root: str, dataset: Dataset, batch_month: str, day: date
) -> bool:
    """Land one dataset of one batch, its columns by the names of the contract; False (and no write) when the extract has no rows.

    Malformed lines are landed as such; bronze takes them to the reject log.
    """
    raw = scan_delivered(spark, raw_root, batch_month, dataset)
    if not has_rows(raw):
        return False
    write_partitioned(stamp_processing_date(raw, day), f"{landing_root}/{dataset.file_stem}", dataset.landing_files)
    return True


def ingest_batch_all(
    spark: SparkSession, raw_root: str, landing_root: str, batch_month: str, day: date, names=None
) -> dict[str, bool]:
    """Land the named datasets (all by default); which of them had data."""
    return {
        name: land_batch(spark, raw_root, landing_root, DATASETS[name], batch_month, day)
        for name in (names or DATASETS)
    }
