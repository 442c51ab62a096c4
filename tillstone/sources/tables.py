"""Medallion tables as plain Parquet snapshots, for catalogs without MERGE.

A merge writes a new snapshot next to the old one and then appends one row
per written part to the merge log. The log row is the commit: readers only
open snapshots the log names, so a job that dies half-way leaves the table
as it was. Tables with an event date are divided by month; a batch reads and
rewrites only the months it touches. The log says which months a batch date
changed, so an incremental read opens no others. The files keep what the last
merge did with each row. One writer per table is assumed.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import date, datetime, timezone

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillstone.functions.rules import normalise_date
from tillstone.operators.upsert import ACTION, upsert

PART = "part"
WHOLE_TABLE = "all"
UNDATED = "undated"
#: A batch older than what the table has of a row does not take it back.
NOT_OLDER = "target.processing_date IS NULL OR source.processing_date >= target.processing_date"
#: Smaller files than the default's, at about the same speed.
CODEC = "zstd"
COUNTS = ("rows_inserted", "rows_updated", "rows_deleted")

LOG_SCHEMA = T.StructType(
    [
        T.StructField("table_name", T.StringType()),
        T.StructField("snapshot", T.IntegerType()),
        T.StructField(PART, T.StringType()),
        T.StructField("operation", T.StringType()),
        *[T.StructField(c, T.LongType()) for c in COUNTS],
        T.StructField("committed_at", T.TimestampType()),
        T.StructField("batch_date", T.DateType()),
        T.StructField("changed", T.BooleanType()),
    ]
)


def month_part(column: str, kind: T.DataType = T.StringType()) -> Column:
    """Month of an event date: a date, or text in any of the delivered forms, read as silver reads it.

    Loads refuse rows without a real date before they come here; what
    other callers bring without one shares the part ``undated``.
    """
    text = F.col(f"`{column}`").cast("string")
    if isinstance(kind, T.DateType):  # Nothing is left to read: a year of four digits, or none the rules know.
        return F.coalesce(F.when(F.length(text) == 10, F.substring(text, 1, 7)), F.lit(UNDATED))
    return month_of(normalise_date(text))


def month_of(day: Column) -> Column:
    """The month as ``yyyy-MM`` (dates that the rules read have years of four digits); a formatter would take a time zone and most of a load's time."""
    return F.coalesce(F.substring(day.cast("string"), 1, 7), F.lit(UNDATED))


def empty_table(spark: SparkSession, schema: T.StructType) -> DataFrame:
    """No rows under a contract; the zero limit lets the optimizer drop joins with it."""
    return spark.createDataFrame([], schema).limit(0)


class TableStore:
    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        # One folder of the log for each table: merges of different tables may commit at the same time.
        empty_table(spark, LOG_SCHEMA).write.mode("ignore").partitionBy("table_name").parquet(self._log_path)

    @property
    def _log_path(self) -> str:
        return f"{self.root}/_merge_log"

    def log(self) -> DataFrame:
        """Every commit of every table."""
        return self.spark.read.schema(LOG_SCHEMA).parquet(self._log_path)

    def history(self, name: str, last: int | None = None) -> DataFrame:
        """Merges of a table, one row each, newest first."""
        per_merge = (
            self.log()
            .filter(F.col("table_name") == name)
            .groupBy("table_name", "snapshot", "operation")
            .agg(*[F.sum(c).alias(c) for c in COUNTS], F.max("committed_at").alias("committed_at"))
            .orderBy(F.col("snapshot").desc())
        )
        return per_merge if last is None else per_merge.limit(last)

    def _current(self, name: str) -> dict[str, int]:
        """Part to current snapshot; as many entries as the table has months."""
        rows = (
            self.log()
            .filter(F.col("table_name") == name)
            .groupBy(PART)
            .agg(F.max("snapshot").alias("snapshot"))
            .collect()
        )
        return {r[PART]: r["snapshot"] for r in rows}

    def exists(self, name: str) -> bool:
        return bool(self._current(name))

    def ensure_table(self, name: str, schema: T.StructType) -> bool:
        """Create the table empty unless it exists; True if it was created."""
        if self.exists(name):
            return False
        self._create(name, schema)
        return True

    def _create(self, name: str, schema: T.StructType) -> None:
        empty = empty_table(self.spark, schema).withColumn(PART, F.lit(WHOLE_TABLE))
        empty.write.mode("overwrite").parquet(self._snapshot_path(name, 0))
        self._commit(name, 0, "CREATE TABLE", dict.fromkeys(COUNTS, 0), [WHOLE_TABLE])

    def _snapshot_path(self, name: str, snapshot: int) -> str:
        return f"{self.root}/{name}/snapshot={snapshot}"

    def _commit(
        self, name: str, snapshot: int, operation: str, metrics: dict[str, int], parts: list[str],
        batch_date: date | None = None, changed: Sequence[str] = (),
    ) -> None:
        """Log the parts of a snapshot; the counts go on the first row. A merge that wrote nothing is not logged."""
        now = datetime.now(timezone.utc)
        counts = [metrics[c] for c in COUNTS]
        rows = [
            (name, snapshot, p, operation, *(counts if p == parts[0] else (0, 0, 0)), now, batch_date, p in changed)
            for p in parts
        ]
        if rows:
            log = self.spark.createDataFrame(rows, LOG_SCHEMA).drop("table_name").coalesce(1)
            log.write.mode("append").parquet(f"{self._log_path}/table_name={name}")

    def _read_parts(self, name: str, schema: T.StructType, current: dict[str, int]) -> DataFrame:
        paths = [f"{self._snapshot_path(name, s)}/{PART}={p}" for p, s in current.items() if s > 0]
        if not paths:
            return empty_table(self.spark, schema)
        with_parts = T.StructType(
            [*schema.fields, T.StructField("snapshot", T.IntegerType()), T.StructField(PART, T.StringType())]
        )
        df = self.spark.read.schema(with_parts).option("basePath", f"{self.root}/{name}").parquet(*paths)
        return df.drop("snapshot", PART)

    def read(self, name: str, schema: T.StructType) -> DataFrame:
        """The current rows of the table."""
        current = self._current(name)
        if not current:
            raise LookupError(f"table {name} does not exist; call ensure_table first")
        return self._read_parts(name, schema, current)

    def read_incremental(self, name: str, schema: T.StructType, day: date) -> DataFrame:
        """Rows last touched by the batch of ``day``.

        Only parts that a merge of that date changed are opened, merges without
        a date may have; within them the filter reaches the Parquet scan.
        """
        current = self._current(name)
        if not current:
            raise LookupError(f"table {name} does not exist; call ensure_table first")
        of_day = F.col("batch_date").isNull() | ((F.col("batch_date") == F.lit(day)) & F.coalesce("changed", F.lit(True)))
        touched = self.log().filter((F.col("table_name") == name) & of_day).select(PART).distinct().collect()
        parts = {r[PART] for r in touched}
        rows = self._read_parts(name, schema, {p: s for p, s in current.items() if p in parts})
        return rows.filter(F.col("processing_date") == F.lit(day))

    def read_with_actions(self, name: str, schema: T.StructType) -> DataFrame:
        """The current rows with ``_action``: what the last merge of the table did with each (insert, update or keep)."""
        current = self._current(name)
        if not current:
            raise LookupError(f"table {name} does not exist; call ensure_table first")
        last = max(current.values())
        newest = {p: s for p, s in current.items() if s == last}
        older = {p: s for p, s in current.items() if s < last}
        with_action = T.StructType([*schema.fields, T.StructField(ACTION, T.StringType())])
        kept = self._read_parts(name, schema, older).withColumn(ACTION, F.lit("keep"))
        return self._read_parts(name, with_action, newest).unionByName(kept)

    def upsert(
        self,
        name: str,
        schema: T.StructType,
        source: DataFrame,
        keys,
        part_column: str | None = None,
        overrides: dict[str, Column] | None = None,
        update_cols=None,
        duplicates: str = "error",
        parts: Sequence[str] | None = None,
        parts_from: DataFrame | None = None,
        batch_date: date | None = None,
        condition: str | None = None,
        by_part: bool = False,
    ) -> dict[str, int]:
        """Merge ``source`` into the table and commit; the metrics of the merge.

        ``part_column`` must belong to (or be derived from) the key, so that a
        row never moves to another month. ``parts`` names at least the months of
        ``source`` where the caller knows them, else they are looked up first in
        ``parts_from`` (a cheaper DataFrame with these months) or ``source``.
        Repeated source keys fail the job unless the caller has just made them
        unique and says so with ``duplicates``. ``batch_date`` is the
        ``processing_date`` that changed rows carry; ``condition`` decides which matches change.
        ``by_part`` says that the files of ``source`` hold few months each, as those of another table do:
        then months that are new to the table are written as they are read. Only months that it has are joined.
        """
        current = self._current(name)
        if not current:
            self._create(name, schema)
            current = {WHOLE_TABLE: 0}
        part: Callable[[], Column] = (lambda: month_part(part_column, schema[part_column].dataType)) if part_column else (lambda: F.lit(WHOLE_TABLE))
        if not part_column:
            touched = [WHOLE_TABLE]
        elif parts is None:
            rows = source if parts_from is None else parts_from
            touched = [r[PART] for r in rows.select(part().alias(PART)).distinct().collect()]
        else:
            touched = list(parts)
        known = {p: s for p, s in current.items() if p in touched and s > 0}
        new = [p for p in touched if p not in known]

        def merge(target: DataFrame, rows: DataFrame, dealt: bool) -> DataFrame:
            merged = upsert(target, rows, keys, update_cols, overrides, duplicates, with_actions=True, condition=condition)
            merged = merged.withColumn(PART, part())
            return merged.hint("rebalance", F.col(PART)) if dealt else merged

        target = self._read_parts(name, schema, known)
        if not part_column:
            merged = merge(target, source, dealt=False)
        elif not (known and new):
            merged = merge(target, source, dealt=bool(known) or not by_part)
        else:
            # The month belongs to the key: rows of a new month meet none of the table.
            has = part().isin(*known)
            of_new = merge(empty_table(self.spark, schema), source.filter(~has), dealt=not by_part)
            merged = merge(target, source.filter(has), dealt=True).unionByName(of_new)
        inserted = F.col(ACTION) == "insert"
        updated = F.col(ACTION) == "update"
        seen = Observation()
        # What is collected is interpreted for each row: let it find a column, not an expression.
        counted = merged.withColumn("_changed", F.when(inserted | updated, F.col(PART))).observe(
            seen,
            F.count_if(inserted).alias("rows_inserted"),
            F.count_if(updated).alias("rows_updated"),
            F.collect_set(PART).alias("parts"),
            F.collect_set("_changed").alias("changed"),
        ).drop("_changed")
        snapshot = max(current.values()) + 1
        path = self._snapshot_path(name, snapshot)
        counted.write.mode("overwrite").option("compression", CODEC).partitionBy(PART).parquet(path)
        written = seen.get
        metrics = {
            "rows_inserted": written["rows_inserted"],
            "rows_updated": written["rows_updated"],
            "rows_deleted": 0,
            "rows_affected": written["rows_inserted"] + written["rows_updated"],
        }
        self._commit(name, snapshot, "MERGE", metrics, sorted(written["parts"]), batch_date, written["changed"])
        return metrics
