"""The training-data pipeline: five stages, each written as Parquet and reread as the documents of the next.

Quality rules, line dedup, near-duplicates, decontamination, mixing. Every
stage but the last returns the columns of ``documents``; empty tables pass.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillstone.llm import minhash, mixing, quality, templates, tiling
from tillstone.llm.common import settle, table


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejected documents go, lines above the limit of their host go from the others."""
    return quality.screen(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines of recurring templates go, but for their first document. Passages wait until near copies are gone as a whole."""
    return templates.drop_recurring(docs, templates.Tree(long_limit=None))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays: five-word shingles, similarity 0.8 or more. Long lines shared by those that stay go."""
    stay = minhash.survivors(docs)
    return templates.drop_passages(docs, among=lambda rows: minhash.only(rows, stay))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark passage go."""
    return tiling.clean(docs, table(spark, sf_dir, "benchmark"))


def mixing_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the mix takes, with ``size``, ``source_size``, ``target`` and ``taken`` words."""
    return mixing.mix(docs).filter(F.col("taken") > 0)


STAGES = [
    ("quality rules", quality_rules),
    ("line dedup", line_dedup),
    ("near dedup", near_dedup),
    ("decontamination", decontamination),
    ("mixing", mixing_sources),
]

#: Near-duplicate components and tilings have no SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = settle(stage(spark, docs, sf_dir), f"stage-{name.replace(' ', '-')}")
    return docs
