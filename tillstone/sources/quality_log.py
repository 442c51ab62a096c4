"""What a batch leaves behind on its way into a layer: rejected rows and the audit of each rule.

A batch is written once, its rows divided by whether they failed a rule; the
merge reads one side, the other is the reject log. The counts are observed on
that write. The audit rows are the commit: a load they do not name, because
the job died or the batch was run again, is not part of either log.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass
from datetime import date, datetime, timezone

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillstone.operators.quality import FEW_KEYS, RULE
from tillstone.sources.tables import CODEC, empty_table

#: What the audit calls the step that finds rows of a rule, in the order of the steps.
STEPS = {"malformed": "well_formed", "null": "not_null", "date": "real_date", "duplicate": "dedup"}

AUDIT_SCHEMA = T.StructType(
    [
        T.StructField("dataset", T.StringType()),
        T.StructField("processing_date", T.DateType()),
        T.StructField("load", T.StringType()),
        T.StructField(RULE, T.StringType()),
        *[T.StructField(c, T.LongType()) for c in ("rows_in", "rows_out", "dropped")],
        T.StructField("committed_at", T.TimestampType()),
    ]
)


@dataclass(frozen=True)
class Sorted:
    """The rows of a batch that stay, the parts they belong to, and their number."""

    valid: DataFrame
    parts: list[str]
    rows: int


class Repeated:
    """Keeps the repeated keys that ``triage`` finds, and knows whether it had to move all rows for them."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path, self.n = spark, path, 0

    def __call__(self, repeated: DataFrame) -> tuple[DataFrame, int]:
        seen = Observation()
        repeated.observe(seen, F.count(F.lit(1)).alias("n")).write.parquet(self.path)
        self.n = seen.get["n"]
        return self.spark.read.schema(repeated.schema).parquet(self.path), self.n

    @property
    def rows_stay_in_place(self) -> bool:
        return self.n <= FEW_KEYS


class QualityLog:
    """Reject log and audit of one layer, below its root."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = f"{root.rstrip('/')}/_quality"
        empty_table(spark, AUDIT_SCHEMA).write.mode("ignore").partitionBy("dataset").parquet(self._audit_path)

    @property
    def _audit_path(self) -> str:
        return f"{self.root}/_audit"

    def keep(self, dataset: str) -> Repeated:
        """A place beside the log for the repeated keys of one load."""
        return Repeated(self.spark, f"{self.root}/_repeated/{dataset}-{uuid.uuid4().hex}")

    def sort(
        self, tagged: DataFrame, dataset: str, day: date, steps, part: Column | None = None, only_rejects=(), unstored=(),
    ) -> Sorted:
        """Write a batch with its ``rule`` column, commit its audit, and hand back the rows without a rule.

        ``steps`` are the kinds of rules that were applied, each gets an audit row;
        ``only_rejects`` names columns that are stored for rejected rows alone, ``unstored`` some that are for ``part`` only.
        """
        load = uuid.uuid4().hex
        path = f"{self.root}/{dataset}/load={load}"
        stays = F.col(RULE).isNull()
        seen = Observation()
        tagged = tagged.withColumns({c: F.when(~stays, F.col(c)) for c in only_rejects})
        tagged = tagged.withColumns(
            {
                "kind": F.when(stays, F.lit("valid")).otherwise(F.lit("rejects")),
                # What is observed is interpreted for each row: let it find columns, not expressions.
                "_step": F.split_part(RULE, F.lit(":"), F.lit(1)),
                "_part": F.when(stays, F.lit(None).cast("string") if part is None else part),
            }
        )
        counted = tagged.observe(
            seen,
            F.count(F.lit(1)).alias("rows"),
            *[F.count_if(F.col("_step") == s).alias(s) for s in steps],
            F.collect_set("_part").alias("parts"),
        ).drop("_step", "_part", *unstored)
        counted.write.option("compression", CODEC).partitionBy("kind").parquet(path)
        counts = seen.get
        now, left, audit = datetime.now(timezone.utc), counts["rows"], []
        for step in steps:
            audit.append((dataset, day, load, STEPS[step], left, left - counts[step], counts[step], now))
            left -= counts[step]
        steps_done = self.spark.createDataFrame(audit, AUDIT_SCHEMA).drop("dataset").coalesce(1)
        steps_done.write.mode("append").parquet(f"{self._audit_path}/dataset={dataset}")
        schema = T.StructType([f for f in counted.schema if f.name not in (RULE, "kind", *only_rejects)])
        valid = self.spark.read.schema(schema).parquet(f"{path}/kind=valid") if left else empty_table(self.spark, schema)
        return Sorted(valid, sorted(counts["parts"]), left)

    def audit(self) -> DataFrame:
        """The steps of each dataset and batch, of its last load."""
        newest = Window.partitionBy("dataset", "processing_date").orderBy(F.col("committed_at").desc(), F.col("load"))
        rows = self.spark.read.schema(AUDIT_SCHEMA).parquet(self._audit_path)
        return rows.withColumn("_r", F.dense_rank().over(newest)).filter("_r = 1").drop("_r")

    def rejects(self, dataset: str, schema: T.StructType) -> DataFrame:
        """The rejected rows of a dataset with ``rule`` and ``processing_date`` of the batch, of each batch's last load."""
        loads = self.audit().filter(F.col("dataset") == dataset).groupBy("load", "processing_date").agg(F.sum("dropped").alias("n"))
        # One entry for each batch of the dataset.
        loads = {r["load"]: r["processing_date"] for r in loads.filter("n > 0").collect()}
        stored = T.StructType([*[f for f in schema if f.name != "processing_date"], T.StructField(RULE, T.StringType())])
        out = empty_table(self.spark, T.StructType([*stored.fields, T.StructField("processing_date", T.DateType())]))
        if not loads:
            return out
        with_load = T.StructType([*stored.fields, T.StructField("load", T.StringType())])
        paths = [f"{self.root}/{dataset}/load={load}/kind=rejects" for load in loads]
        rows = self.spark.read.schema(with_load).option("basePath", f"{self.root}/{dataset}").parquet(*paths).drop("kind")
        day = F.create_map(*[F.lit(x) for pair in loads.items() for x in pair])
        return rows.withColumn("processing_date", F.try_element_at(day, F.col("load"))).drop("load")
