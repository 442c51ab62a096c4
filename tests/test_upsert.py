from collections import Counter

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tillstone.operators.upsert import ACTION, Upsert, merge_metrics, upsert

SMALL = settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
SCHEMA = "k int, a string, b int"
TABLES = st.dictionaries(
    st.integers(0, 8), st.tuples(st.sampled_from([None, "x", "y"]), st.sampled_from([None, 1, 2])), max_size=9
)


def _df(spark, table):
    return spark.createDataFrame([(k, *v) for k, v in table.items()], SCHEMA)


def _rows(df):
    return Counter(tuple(r) for r in df.collect())


@SMALL
@given(TABLES, TABLES)
def test_upsert_properties(spark, target, source):
    before, batch = _df(spark, target), _df(spark, source)
    merged = upsert(before, batch, ["k"])
    expected = {**target, **source}
    assert _rows(merged) == Counter((k, *v) for k, v in expected.items())
    # Once more changes nothing.
    assert _rows(upsert(merged, batch, ["k"])) == _rows(merged)
    metrics = merge_metrics(upsert(before, batch, ["k"], with_actions=True)).collect()[0]
    assert metrics["rows_inserted"] + metrics["rows_updated"] == len(source) == metrics["rows_affected"]
    assert metrics["total_rows"] == len(target) + metrics["rows_inserted"]
    assert metrics["rows_deleted"] == 0


def test_null_values_of_the_source_are_taken_over(spark):
    merged = upsert(_df(spark, {1: ("x", 1)}), _df(spark, {1: (None, None)}), ["k"])
    assert _rows(merged) == Counter([(1, None, None)])


def test_repeated_source_key_fails(spark):
    source = spark.createDataFrame([(1, "x", 1), (1, "y", 2), (2, "z", 3)], SCHEMA)
    with pytest.raises(Exception, match="several source rows for one key"):
        upsert(_df(spark, {1: ("o", 0)}), source, ["k"]).collect()


def test_latest_source_row_wins(spark):
    source = spark.createDataFrame([(1, "x", 1), (1, "y", 2), (2, "z", 3), (2, "q", None)], SCHEMA)
    merged = upsert(
        _df(spark, {1: ("o", 0)}), source, ["k"], duplicates="latest", latest_by=["b"]
    )
    assert _rows(merged) == Counter([(1, "y", 2), (2, "z", 3)])


@pytest.mark.parametrize("policy", ["error", "latest", "unique"])
def test_null_keys_match_nothing(spark, policy):
    target = spark.createDataFrame([(None, "old", 1), (1, "x", 1)], SCHEMA)
    source = spark.createDataFrame([(None, "new", 2), (1, "y", 2)], SCHEMA)
    merged = upsert(target, source, ["k"], duplicates=policy)
    assert _rows(merged) == Counter([(None, "old", 1), (None, "new", 2), (1, "y", 2)])


def test_update_columns_and_overrides(spark):
    merged = upsert(
        _df(spark, {1: ("x", 1), 2: ("x", 1)}),
        _df(spark, {2: ("y", 2), 3: ("y", 2)}),
        ["k"],
        update_cols=["a"],
        overrides={"b": F.lit(9)},
    )
    assert _rows(merged) == Counter([(1, "x", 1), (2, "y", 9), (3, "y", 9)])


def test_composite_key(spark):
    target = spark.createDataFrame([(1, "x", 1), (1, "y", 1)], SCHEMA)
    source = spark.createDataFrame([(1, "y", 2), (2, "y", 2)], SCHEMA)
    assert _rows(upsert(target, source, ["k", "a"])) == Counter([(1, "x", 1), (1, "y", 2), (2, "y", 2)])


def test_builder_clauses(spark):
    target, source = _df(spark, {1: ("x", 1)}), _df(spark, {1: ("y", 2), 2: ("z", 3)})

    def merge():
        return Upsert(target).using(source).on("k")

    maps = merge().when_matched_update({"b": "source.b + target.b"}).when_not_matched_insert({"k": "source.k", "a": "'new'"})
    assert _rows(maps.to_df()) == Counter([(1, "x", 3), (2, "new", None)])
    assert _rows(merge().when_matched_update().to_df()) == Counter([(1, "y", 2)])
    only_new = merge().when_not_matched_insert()
    assert _rows(only_new.to_df()) == Counter([(1, "x", 1), (2, "z", 3)])
    assert {r["k"]: r[ACTION] for r in only_new.with_actions().collect()} == {1: "keep", 2: "insert"}


def test_builder_needs_source_and_key(spark):
    with pytest.raises(ValueError, match="using"):
        Upsert(_df(spark, {1: ("x", 1)})).to_df()
    with pytest.raises(ValueError, match="policy"):
        Upsert(_df(spark, {1: ("x", 1)})).duplicates("whatever")


def test_catalog_merge_is_delegated(spark):
    """A catalog without row-level operations refuses the statement; nothing is emulated behind its back."""
    _df(spark, {1: ("x", 1)}).createOrReplaceTempView("plain_target")
    merge = Upsert(spark.table("plain_target")).using(_df(spark, {1: ("y", 2)})).on("k").when_matched_update()
    with pytest.raises(Exception, match="(?i)merge|unsupported|not support"):
        merge.into_catalog_table("plain_target")
