"""Every operator and stage on odd rows, on an empty table, and with extra columns of clashing names."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tillstone.llm import archives, langid, minhash, mixing, quality, secrets, templates, tiling, tokens, urls

OPERATORS = {
    "op1": secrets.op1, "op2": tokens.op2, "op4": templates.op4, "op5": quality.op5,
    "op7": minhash.op7, "op8": langid.op8, "op9": mixing.op9,
}
CLASHES = ("row", "size", "taken", "target", "blocks", "start", "hits", "text_hash", "k_id", "b_id", "n_dropped", "found_id", "digest")


def items(spark):
    rows = [(0, "a passage of seven words to find"), (1, None), (2, "")]
    return spark.createDataFrame(rows, "item_id long, text string")


@pytest.mark.parametrize("name", OPERATORS)
def test_one_row_for_each_document(odd, name):
    clashing = odd.withColumns({c: F.lit("x") for c in CLASHES})
    got = OPERATORS[name](clashing)
    assert got.columns[0] == "doc_id"
    assert sorted(str(r[0]) for r in got.collect()) == sorted(str(r[0]) for r in odd.collect())


@pytest.mark.parametrize("name", OPERATORS)
def test_empty_table(documents, name):
    assert OPERATORS[name](documents([])).collect() == []


def test_decontamination_of_odd_rows(spark, odd, documents):
    assert tiling.op10(odd, items(spark)).filter("kept").count() == odd.count()
    assert tiling.op10(documents([]), items(spark)).count() == 0
    assert tiling.op10(odd, items(spark).limit(0)).filter("kept").count() == odd.count()


@pytest.mark.parametrize("name,stage", corpus_pipeline.STAGES[:-1])
def test_stages_return_the_columns_of_documents(spark, odd, documents, tmp_path, name, stage):
    items(spark).write.parquet(str(tmp_path / "benchmark.parquet"))
    clashing = odd.withColumns({c: F.lit("x") for c in CLASHES})
    assert stage(spark, clashing, str(tmp_path)).columns == clashing.columns
    assert stage(spark, documents([]), str(tmp_path)).collect() == []
    assert set(stage(spark, odd, str(tmp_path)).collect()) <= set(odd.collect())


def test_pages(spark):
    schema = "page_id long, url string, html string"
    rows = [(None, None, None), (1, "no scheme", ""), (2, "http://a b.org/x y", "é\r\n\r\nb"), (2, "http://a b.org/x y", "é\r\n\r\nb"), (3, "http://", None)]
    pages = spark.createDataFrame(rows, schema).withColumn("host", F.lit("clash"))
    judged = {(r.page_id, r.host, r.path, r.rule, r.verdict) for r in urls.op3(pages).collect()}
    assert judged == {
        (None, "", "", None, judged_of(judged, None)), (1, "", "", None, judged_of(judged, 1)),
        (2, "a b.org", "/x y", "org/", "allow"), (3, "", "", None, judged_of(judged, 3)),
    }
    kept = sorted((str(r.page_id), r.payload_bytes, r.record_type, r.refers_to) for r in archives.op6(pages).collect())
    assert kept == [("1", 0, "revisit", 3), ("2", 7, "response", None), ("2", 7, "revisit", 2), ("3", 0, "response", None), ("None", 0, "revisit", 3)]
    none = spark.createDataFrame([], schema)
    assert urls.op3(none).collect() == []
    assert archives.op6(none).collect() == []


def judged_of(judged, page_id):
    return next(v for p, _, _, _, v in judged if p == page_id)
