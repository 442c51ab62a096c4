"""Surrogate keys are never NULL, and plans know it."""

import re

from pyspark.sql import functions as F

from tillstone import registry
from tillstone.functions import keys

SF = "/root/testdata/sf0.001"


def test_surrogate_keys_are_never_null(spark):
    rows = spark.createDataFrame([(None, None), ("a", None)], "a string, b string").select(keys.surrogate_key(["a", "b"]).alias("k"))
    assert not rows.schema["k"].nullable
    texts = spark.createDataFrame([("",), ("a",)], "text string").select(F.sha2("text", 256))
    assert sorted(map(tuple, rows.collect())) == sorted(map(tuple, texts.collect()))


def test_a_merge_by_surrogate_key_reads_its_source_once(spark):
    plan = registry.QUERIES["upsert_column_subset"](spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    assert len(re.findall(r"Relation \[", plan)) == 2
