"""One batch through all layers: raw extracts to landing, bronze, silver and gold."""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from datetime import date

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillstone.functions import keys
from tillstone.functions.enrich import REFERENCE_DATE
from tillstone.operators.quality import orphan_keys
from tillstone.plans.bronze import bronze_schema, load_bronze
from tillstone.plans.gold import GOLD, build_gold
from tillstone.plans.silver import DELIVERED, STEPS, key_columns, tagged_batch
from tillstone.schemas import DATASETS, REFERENCES, Dataset
from tillstone.sources.landing import land_batch
from tillstone.sources.quality_log import QualityLog
from tillstone.sources.tables import NOT_OLDER, TableStore, empty_table, month_part


@dataclass(frozen=True)
class Batch:
    """Parameters of one run."""

    raw_root: str
    lake_root: str
    batch_month: str
    processing_date: date
    as_of: date | None = None
    #: The day on which ages and years of service are counted.
    ref_date: date = REFERENCE_DATE

    @property
    def landing_root(self) -> str:
        return f"{self.lake_root}/landing"

    def store(self, spark: SparkSession, layer: str) -> TableStore:
        return TableStore(spark, f"{self.lake_root}/{layer}")

    def quality(self, spark: SparkSession, layer: str) -> QualityLog:
        """Reject log and audit of a layer that drops rows: bronze or silver."""
        return QualityLog(spark, f"{self.lake_root}/{layer}")


def load_silver(spark: SparkSession, batch: Batch, dataset: Dataset) -> dict[str, int]:
    """Merge the rows bronze took in with this batch into the silver table; what they fail goes to the reject log."""
    day = batch.processing_date
    rows = batch.store(spark, "bronze").read_incremental(dataset.bronze_table, bronze_schema(dataset), day)
    store = batch.store(spark, "silver")
    log = batch.quality(spark, "silver")
    tagged = tagged_batch(rows.drop("processing_date"), dataset, day, batch.as_of, log.keep(dataset.name))
    part = month_part(dataset.event_date, dataset.silver[dataset.event_date].dataType) if dataset.event_date else None
    # The key columns follow from the others: digests of rows that stay are not written twice.
    derived = key_columns(dataset)
    found = log.sort(tagged, dataset.name, day, STEPS, part, only_rejects=(DELIVERED, *derived))
    return store.upsert(
        dataset.silver_table,
        dataset.silver,
        found.valid.withColumns(derived),
        dataset.silver_key,
        part_column=dataset.event_date,
        duplicates="unique",
        parts=found.parts,
        batch_date=day,
        condition=NOT_OLDER,
        by_part=True,
    )


def load_gold(spark: SparkSession, batch: Batch, table: str) -> dict[str, int]:
    """Merge the rows silver took in with this batch into the gold table."""
    gold = GOLD[table]
    dataset = DATASETS[gold.source]
    rows = batch.store(spark, "silver").read_incremental(dataset.silver_table, dataset.silver, batch.processing_date)
    return batch.store(spark, "gold").upsert(
        table,
        gold.schema,
        build_gold(table, rows, batch.ref_date),
        (gold.key,),
        part_column=gold.event_date,
        duplicates="unique",
        batch_date=batch.processing_date,
        condition=NOT_OLDER,
        by_part=True,
    )


def load_dataset(spark: SparkSession, batch: Batch, dataset: Dataset) -> dict[str, dict[str, int]]:
    """What has been landed of a dataset with this batch, into bronze, silver and gold; merge metrics per table."""
    bronze = batch.store(spark, "bronze")
    metrics = {
        dataset.bronze_table: load_bronze(spark, bronze, batch.landing_root, dataset, batch.processing_date, batch.as_of),
        dataset.silver_table: load_silver(spark, batch, dataset),
    }
    tables = [name for name, gold in GOLD.items() if gold.source == dataset.name]
    return metrics | {name: load_gold(spark, batch, name) for name in tables}


ORPHANS = T.StructType(
    [
        T.StructField("dataset", T.StringType()),
        T.StructField("processing_date", T.DateType()),
        T.StructField("relation", T.StringType()),
        T.StructField("orphan_key", T.StringType()),
        T.StructField("n_rows", T.LongType()),
    ]
)


def _orphans_root(batch: Batch) -> str:
    return f"{batch.lake_root}/silver/_orphans"


def check_references(spark: SparkSession, batch: Batch, names=None) -> None:
    """Log the keys in this batch's silver rows that no row of the stored parent has, one folder a dataset and batch.

    The rows of a key are counted before they meet a parent. A rerun replaces its folder; a parent that has no table
    yet has no keys.
    """
    store, day = batch.store(spark, "silver"), batch.processing_date
    for name in (n for n in (names or DATASETS) if n in REFERENCES):
        dataset, references = DATASETS[name], []
        if not store.exists(dataset.silver_table):
            continue
        rows = store.read_incremental(dataset.silver_table, dataset.silver, day)
        rows = rows.select(*[keys.reference_key(F.col(key).cast("string")).alias(key) for key in REFERENCES[name]])
        for key, (parent, parent_key) in REFERENCES[name].items():
            table = DATASETS[parent]
            known = store.read(table.silver_table, table.silver) if store.exists(table.silver_table) else empty_table(spark, table.silver)
            known = known.select(keys.reference_key(F.col(parent_key).cast("string")).alias(parent_key))
            references.append((key, known, parent_key, f"{name}.{key} -> {parent}"))
        found = orphan_keys(rows, references).select("relation", "orphan_key", "n_rows")
        found.write.mode("overwrite").parquet(f"{_orphans_root(batch)}/dataset={name}/processing_date={day}")


def orphans_of_runs(spark: SparkSession, batch: Batch) -> DataFrame:
    """What ``check_references`` has found in each batch of the lake."""
    return spark.read.schema(ORPHANS).parquet(_orphans_root(batch))


def load_calendars(spark: SparkSession, batch: Batch, calendar: DataFrame) -> dict[str, dict[str, int]]:
    """Both calendars have the same rows, each with a table of its own."""
    store = batch.store(spark, "gold")
    return {
        name: store.upsert(name, gold.schema, build_gold(name, calendar), (gold.key,))
        for name, gold in GOLD.items()
        if gold.source == "calendar"
    }


class BatchFailed(RuntimeError):
    """Some datasets of a run failed; the others are done. ``failures`` by dataset, ``metrics`` per table of the others."""

    def __init__(self, failures: dict[str, Exception], metrics: dict[str, dict[str, int]]):
        super().__init__("; ".join(f"{name}: {type(e).__name__}: {str(e)[:300]}" for name, e in failures.items()))
        self.failures, self.metrics = failures, metrics


def each_dataset(
    spark: SparkSession, names, work: Callable[[Dataset], dict[str, dict[str, int]]], threads: int = 3
) -> dict[str, dict[str, int]]:
    """``work`` for each named dataset, several at a time; datasets share no table, so none waits for another.

    Each runs as a job group in a pool of its own, so that under fair scheduling a
    small lookup does not queue behind a fact table. A failure ends its dataset only.
    """
    names, metrics, failures = list(names), {}, {}

    def one(name: str) -> dict[str, dict[str, int]]:
        spark.sparkContext.setJobGroup(f"dataset {name}", f"load {name}")
        spark.sparkContext.setLocalProperty("spark.scheduler.pool", name)
        return work(DATASETS[name])

    with ThreadPoolExecutor(max(1, min(threads, len(names)))) as pool:
        running = {name: pool.submit(inheritable_thread_target(spark)(one), name) for name in names}
    for name, future in running.items():
        error = future.exception()
        if error is None:
            metrics |= future.result()
        else:
            failures[name] = error
    if failures:
        raise BatchFailed(failures, metrics)
    return metrics


def run_batch(
    spark: SparkSession, batch: Batch, calendar: DataFrame | None = None, names=None, threads: int = 3
) -> dict[str, dict[str, int]]:
    """Run a batch of the named datasets (all by default), ``threads`` at a time; merge metrics per table.

    Keys without a parent are logged once all datasets are in. Datasets
    without data in this batch are skipped. Where some fail, the others are
    loaded all the same, the calendars too, and ``BatchFailed`` tells which.
    """
    for layer in ("bronze", "silver", "gold"):
        batch.store(spark, layer)
    for layer in ("bronze", "silver"):
        batch.quality(spark, layer)

    def work(dataset: Dataset) -> dict[str, dict[str, int]]:
        landed = land_batch(spark, batch.raw_root, batch.landing_root, dataset, batch.batch_month, batch.processing_date)
        return load_dataset(spark, batch, dataset) if landed else {}

    failed = None
    try:
        metrics = each_dataset(spark, names or DATASETS, work, threads)
    except BatchFailed as error:
        failed, metrics = error, error.metrics
    check_references(spark, batch, [name for name in (names or DATASETS) if DATASETS[name].silver_table in metrics])
    if calendar is not None:
        metrics |= load_calendars(spark, batch, calendar)
    if failed:
        raise failed
    return metrics
