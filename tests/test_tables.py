from collections import Counter
from datetime import date
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tillstone.schemas import schema_of
from tillstone.sources.tables import TableStore

FACT = schema_of("""
    id int
    day date
    n int
    processing_date date
""")
MARCH, APRIL = date(2019, 3, 31), date(2019, 4, 30)


def _fact(spark, rows, processed=MARCH):
    return spark.createDataFrame([(i, d, n, processed) for i, d, n in rows], FACT)


def _rows(df):
    return Counter(tuple(r) for r in df.collect())


def _merge(store, batch, **options):
    return store.upsert("facts", FACT, batch, ("id", "day"), part_column="day", **options)


def test_create_once(spark, lake):
    store = TableStore(spark, lake)
    with pytest.raises(LookupError):
        store.read("facts", FACT)
    assert store.ensure_table("facts", FACT) is True
    assert store.ensure_table("facts", FACT) is False
    assert store.read("facts", FACT).count() == 0
    assert store.read("facts", FACT).schema == FACT


def test_merges_months_and_history(spark, lake):
    store = TableStore(spark, lake)
    d1, d2, d3 = date(2019, 1, 5), date(2019, 2, 5), date(2019, 3, 5)
    first = _merge(store, _fact(spark, [(1, d1, 1), (2, d2, 1)]))
    second = _merge(store, _fact(spark, [(2, d2, 9), (3, d3, 1)], APRIL))
    assert (first["rows_inserted"], first["rows_updated"]) == (2, 0)
    assert (second["rows_inserted"], second["rows_updated"], second["rows_affected"]) == (1, 1, 2)
    expected = Counter([(1, d1, 1, MARCH), (2, d2, 9, APRIL), (3, d3, 1, APRIL)])
    assert _rows(store.read("facts", FACT)) == expected
    # The January part was not rewritten by the second merge.
    assert not list(Path(lake).glob("facts/snapshot=2/part=2019-01"))
    assert list(Path(lake).glob("facts/snapshot=2/part=2019-02"))
    history = [(r["snapshot"], r["rows_inserted"], r["rows_updated"]) for r in store.history("facts", 2).collect()]
    assert history == [(2, 1, 1), (1, 2, 0)]
    assert _rows(store.read_incremental("facts", FACT, APRIL)) == Counter([(2, d2, 9, APRIL), (3, d3, 1, APRIL)])


def test_rerun_changes_nothing(spark, lake):
    store = TableStore(spark, lake)
    batch = _fact(spark, [(1, date(2019, 1, 5), 1), (2, date(2019, 2, 5), 1)])
    _merge(store, batch)
    before = _rows(store.read("facts", FACT))
    assert _merge(store, batch)["rows_inserted"] == 0
    assert _rows(store.read("facts", FACT)) == before


def test_failed_write_leaves_the_table(spark, lake):
    store = TableStore(spark, lake)
    _merge(store, _fact(spark, [(1, date(2019, 1, 5), 1)]))
    bad = _fact(spark, [(1, date(2019, 1, 5), 2)]).withColumn(
        "n", F.when(F.col("n") > 0, F.raise_error(F.lit("lost")).cast("int"))
    )
    with pytest.raises(Exception, match="lost"):
        _merge(store, bad)
    assert _rows(store.read("facts", FACT)) == Counter([(1, date(2019, 1, 5), 1, MARCH)])
    _merge(store, _fact(spark, [(1, date(2019, 1, 5), 3)]))
    assert _rows(store.read("facts", FACT)) == Counter([(1, date(2019, 1, 5), 3, MARCH)])


def test_empty_batch_and_wider_parts(spark, lake):
    store = TableStore(spark, lake)
    _merge(store, _fact(spark, [(1, date(2019, 1, 5), 1)]))
    nothing = _fact(spark, []).limit(0)
    assert _merge(store, nothing)["rows_affected"] == 0
    # Months named in advance that the batch does not reach are rewritten as they are, or stay absent.
    wide = _fact(spark, [(9, date(2019, 1, 6), 0), (9, date(2018, 1, 6), 0)])
    _merge(store, _fact(spark, [(2, date(2019, 2, 5), 1)]), parts_from=wide.unionByName(_fact(spark, [(2, date(2019, 2, 5), 1)])))
    assert store.read("facts", FACT).count() == 2


def test_whole_table_merge(spark, lake):
    store = TableStore(spark, lake)
    for n in (1, 2):
        store.upsert("dim", FACT, _fact(spark, [(n, None, 1), (5, None, n)]), ("id",))
    assert _rows(store.read("dim", FACT)) == Counter([(1, None, 1, MARCH), (2, None, 1, MARCH), (5, None, 2, MARCH)])


def test_repeated_key_is_refused(spark, lake):
    store = TableStore(spark, lake)
    twice = _fact(spark, [(1, date(2019, 1, 5), 1), (1, date(2019, 1, 5), 2)])
    with pytest.raises(Exception, match="several source rows"):
        _merge(store, twice)
    assert store.read("facts", FACT).count() == 0
