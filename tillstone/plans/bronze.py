"""Landing to bronze: the batch as text, one row per natural key, merged by that key.

Bronze keeps every column as text; types are given once, in silver, where
the date and number rules can still see what was delivered. Rows that do not
come in are logged with the rule they failed.
"""

from __future__ import annotations

from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillstone.functions import rules
from tillstone.operators.quality import Keep, keep_one, require_not_null, triage
from tillstone.operators.upsert import upsert
from tillstone.schemas import Dataset
from tillstone.sources.landing import stamp_processing_date
from tillstone.sources.readers import MALFORMED, scan_landed_lines
from tillstone.sources.quality_log import QualityLog
from tillstone.sources.tables import NOT_OLDER, TableStore, month_of


#: The event date of a delivered row as silver reads it; not stored.
EVENT_DAY = "_event_day"


def bronze_schema(dataset: Dataset) -> T.StructType:
    return T.StructType([*dataset.raw_schema.fields, T.StructField("processing_date", T.DateType())])


def keyed_rows(landing: DataFrame, dataset: Dataset) -> DataFrame:
    """Rows that have their whole natural key; a NULL key could never be matched again."""
    return require_not_null(landing.select(*[F.col(f"`{c}`") for c in dataset.raw_columns]), dataset.natural_key)


def _preferred(dataset: Dataset, as_of: date | None) -> list[Column]:
    """Rows that silver can use come first, and of these the latest by the dates as silver reads them."""
    today = F.current_date() if as_of is None else F.lit(as_of)
    latest = [rules.clean_date(F.col(f"`{c}`"), today) for c in dataset.latest_by]
    filled = reduce(lambda a, b: a & b, [F.coalesce(F.trim(f"`{c}`") != "", F.lit(False)) for c in dataset.mandatory])
    return [filled, *latest]


def bronze_batch(landing: DataFrame, dataset: Dataset, day: date, as_of: date | None = None) -> DataFrame:
    """One row per natural key: one that silver can use if there is any, and of these the latest.

    The dates that decide are read as silver reads them, so one that silver
    refuses (later than ``as_of``, today by default) never wins.
    """
    rows = keep_one(keyed_rows(landing, dataset), dataset.natural_key, prefer=_preferred(dataset, as_of))
    return stamp_processing_date(rows, day)


def tagged_batch(landing: DataFrame, dataset: Dataset, as_of: date | None = None, keep: Keep | None = None) -> DataFrame:
    """Every delivered row with ``rule``, NULL for those of ``bronze_batch``, and the text of a malformed line.

    A row whose event date is no real one (unreadable, before 1900 or later than
    ``as_of``) is refused here: its month would not be one of the calendar.
    """
    return _with_event_day(landing, dataset, as_of, keep).drop(EVENT_DAY)


def _with_event_day(landing: DataFrame, dataset: Dataset, as_of: date | None, keep: Keep | None) -> DataFrame:
    """``tagged_batch``, and its event date as silver reads it."""
    today = F.current_date() if as_of is None else F.lit(as_of)
    line = F.col(MALFORMED) if MALFORMED in landing.columns else F.lit(None).cast("string").alias(MALFORMED)
    refuse = {"malformed": F.col(MALFORMED).isNotNull()}
    rows = landing.select(*[F.col(f"`{c}`") for c in dataset.raw_columns], line)
    if dataset.event_date:
        # Read once, as a column: spelled out wherever it is asked for, it makes methods too large to be compiled.
        text, day = F.col(f"`{dataset.event_date}`"), F.col(EVENT_DAY)
        rows = rows.withColumn(EVENT_DAY, rules.normalise_date(text))
        refuse[f"date:{dataset.event_date}"] = text.isNotNull() & rules.bound_date(day, today).isNull()
    columns = dataset.raw_columns
    return triage(rows, dataset.natural_key, dataset.natural_key, prefer=_preferred(dataset, as_of), refuse=refuse, order_columns=columns, keep=keep, cluster=part_of(dataset))


def part_of(dataset: Dataset) -> Column | None:
    """Month of a row that has its event date read."""
    return month_of(F.col(EVENT_DAY)) if dataset.event_date else None


def bronze_steps(dataset: Dataset) -> tuple[str, ...]:
    return ("malformed", "null", "date", "duplicate") if dataset.event_date else ("malformed", "null", "duplicate")


def rejects_schema(dataset: Dataset) -> T.StructType:
    """What the reject log of bronze holds of a row."""
    return T.StructType([*dataset.raw_schema, T.StructField(MALFORMED, T.StringType())])


def merge_bronze(target: DataFrame, batch: DataFrame, dataset: Dataset, day: date) -> DataFrame:
    stamp = {"processing_date": F.lit(day)}
    return upsert(target, batch, dataset.natural_key, overrides=stamp, duplicates="unique")


def merge_landing(store: TableStore, landing: DataFrame, dataset: Dataset, day: date, as_of: date | None = None) -> dict[str, int]:
    """Log what the rows of one landing batch fail, and merge the others into the bronze table.

    A row that a later batch has changed is left alone.
    """
    part = part_of(dataset)
    log = QualityLog(store.spark, store.root)
    repeated = log.keep(dataset.name)
    batch = log.sort(_with_event_day(landing, dataset, as_of, repeated), dataset.name, day, bronze_steps(dataset), part, only_rejects=(MALFORMED,), unstored=(EVENT_DAY,))
    return store.upsert(
        dataset.bronze_table,
        bronze_schema(dataset),
        stamp_processing_date(batch.valid, day),
        dataset.natural_key,
        part_column=dataset.event_date,
        duplicates="unique",
        parts=batch.parts,
        batch_date=day,
        condition=NOT_OLDER,
        by_part=not repeated.rows_stay_in_place,
    )


def load_bronze(
    spark: SparkSession, store: TableStore, landing_root: str, dataset: Dataset, day: date, as_of: date | None = None
) -> dict[str, int]:
    """Merge the landing partition of ``day`` into the bronze table."""
    return merge_landing(store, scan_landed_lines(spark, landing_root, dataset, day), dataset, day, as_of)
