"""Readers of the raw and landing layers."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillstone.schemas import CALENDAR_COLUMNS, Dataset

#: The text of a line that has not as many fields as its header.
MALFORMED = "_malformed"


def scan_csv_strings(spark: SparkSession, path: str) -> DataFrame:
    """CSV with a header; every column is text, nothing is inferred."""
    return spark.read.option("header", True).csv(path)


def batch_path(raw_root: str, batch_month: str, dataset: Dataset) -> str:
    return f"{raw_root}/{batch_month}/{dataset.file_stem}-{batch_month}.csv"


def scan_batch(spark: SparkSession, raw_root: str, batch_month: str, dataset: Dataset) -> DataFrame:
    return scan_csv_strings(spark, batch_path(raw_root, batch_month, dataset))


class HeaderMismatch(ValueError):
    """An extract has columns that its contract does not know, repeats some, or lacks those a row cannot do without."""


def contract_names(delivered: Sequence[str], dataset: Dataset) -> list[str]:
    """The contract's name of each delivered column, by spelling in any case or by the dataset's other names for it."""
    names = [dataset.header_names.get(h.strip().lower(), h.strip().lower()) for h in delivered]
    unknown = [h for h, n in zip(delivered, names) if n not in dataset.raw_columns]
    repeated = sorted({n for n in names if names.count(n) > 1})
    lacking = [c for c in dataset.identity if c not in names]
    if unknown or repeated or lacking:
        raise HeaderMismatch(f"{dataset.name}: unknown columns {unknown}, repeated {repeated}, missing {lacking}")
    return names


def scan_delivered(spark: SparkSession, raw_root: str, batch_month: str, dataset: Dataset) -> DataFrame:
    """An extract under the names of its contract, as text, with the line in ``_malformed`` where it has too few or too many fields.

    Headers are compared with the contract first, and every file with the
    header of the first; contract columns that are not delivered are NULL.
    """
    path = batch_path(raw_root, batch_month, dataset)
    header = scan_csv_strings(spark, path).columns
    names = contract_names(header, dataset)
    schema = T.StructType([T.StructField(h, T.StringType()) for h in (*header, MALFORMED)])
    read = spark.read.option("header", True).option("enforceSchema", False).option("mode", "PERMISSIVE")
    rows = read.option("columnNameOfCorruptRecord", MALFORMED).schema(schema).csv(path).toDF(*names, MALFORMED)
    absent = {c: F.lit(None).cast("string") for c in dataset.raw_columns if c not in names}
    return rows.withColumns(absent).select(*[F.col(f"`{c}`") for c in (*dataset.raw_columns, MALFORMED)])


def scan_calendar_csv(spark: SparkSession, path: str) -> DataFrame:
    schema = T.StructType([T.StructField(c, T.StringType()) for c in CALENDAR_COLUMNS])
    return spark.read.option("header", True).schema(schema).csv(path)


def scan_parquet_schema(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Parquet under a fixed schema: columns resolve by name in any case, missing ones are NULL."""
    return spark.read.schema(schema).parquet(path)


def landing_schema(dataset: Dataset) -> T.StructType:
    text = T.StringType()
    return T.StructType([*dataset.raw_schema, T.StructField(MALFORMED, text), T.StructField("processing_date", T.DateType())])


def scan_landing(spark: SparkSession, landing_root: str, dataset: Dataset) -> DataFrame:
    """The landed rows; malformed lines are not among them."""
    rows = scan_parquet_schema(spark, f"{landing_root}/{dataset.file_stem}", landing_schema(dataset))
    return rows.filter(F.col(MALFORMED).isNull()).drop(MALFORMED)


def scan_one_partition(spark: SparkSession, landing_root: str, dataset: Dataset, day: date) -> DataFrame:
    """One batch of the landing table; the filter prunes all other directories."""
    return scan_landing(spark, landing_root, dataset).filter(F.col("processing_date") == F.lit(day))


def scan_landed_lines(spark: SparkSession, landing_root: str, dataset: Dataset, day: date) -> DataFrame:
    """One batch of the landing table with its malformed lines."""
    rows = scan_parquet_schema(spark, f"{landing_root}/{dataset.file_stem}", landing_schema(dataset))
    return rows.filter(F.col("processing_date") == F.lit(day))
