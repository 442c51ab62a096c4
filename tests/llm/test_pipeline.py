"""The whole pipeline: planted copies and passages go, clean and odd documents pass, an empty table gives no rows."""

import random

import pytest
from pyspark.sql import functions as F

import corpus_pipeline

CLASHES = ("row", "blocks", "text_hash", "k_id", "found_id")


def prose(seed, n=120):
    rng = random.Random(seed)
    return " ".join("".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=rng.randint(3, 9))) for _ in range(n))


@pytest.fixture
def folder(spark, tmp_path):
    items = [(0, "the quick probe measures seven unusual copper samples near harbour nine"), (1, None), (2, "")]
    spark.createDataFrame(items, "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    return tmp_path, items[0][1]


def test_planted_cases(spark, documents, odd, folder):
    path, passage = folder
    clean = [(100 + i, prose(i), "en", "a") for i in range(12)]
    words = prose(0).split()
    near = " ".join([*words[:60], "changed", *words[61:]])
    planted = [(200, prose(0), "en", "a"), (201, near, "en", "a"), (202, f"{prose(50, 60)} {passage} {prose(51, 60)}", "en", "a"), (203, "too short", "en", "a")]
    docs = documents(clean + planted).union(odd)
    docs.withColumns({c: F.lit("x") for c in CLASHES}).write.parquet(str(path / "documents.parquet"))
    got = corpus_pipeline.run(spark, str(path)).collect()
    kept = [r.doc_id for r in got if r.doc_id is not None and r.doc_id >= 100]
    assert len(kept) == len(set(kept))
    assert len({100, 200, 201} & set(kept)) == 1 and {101 + i for i in range(11)} <= set(kept)
    assert not {202, 203} & set(kept)
    assert all(0 < r.taken <= 2 * r["size"] for r in got)


def test_empty_table(spark, documents, folder):
    documents([]).write.parquet(str(folder[0] / "documents.parquet"))
    assert corpus_pipeline.run(spark, str(folder[0])).collect() == []
