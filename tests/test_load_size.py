"""What a load moves and writes: rows that meet no other stay where they are, extracts are built once."""

from collections import Counter
from datetime import date

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tillstone import registry
from tillstone.operators import quality
from tillstone.schemas import DATASETS, schema_of
from tillstone.sources import retail_views
from tillstone.sources.quality_log import Repeated
from tillstone.sources.tables import TableStore

ROWS = st.lists(
    st.tuples(st.sampled_from([None, 1, 2, 3, 4]), st.sampled_from([None, "a", "b"]), st.sampled_from([None, 10, 20])), max_size=25
)
MARCH, APRIL = date(2019, 3, 31), date(2019, 4, 30)
FACT = schema_of("""
    id int
    day date
    n int
    processing_date date
""")


def _bag(df, *columns):
    return Counter(tuple(r) for r in df.select(*(columns or df.columns)).collect())


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=ROWS, parts=st.integers(1, 4))
@pytest.mark.parametrize("few,many", [(10, 10), (0, 1), (0, 100)])
def test_triage_by_repeated_keys_as_without(spark, tmp_path_factory, monkeypatch, few, many, rows, parts):
    monkeypatch.setattr(quality, "FEW_KEYS", few)
    monkeypatch.setattr(quality, "MANY_COPIES", many)
    df = spark.createDataFrame(rows, "k int, tag string, day int").repartition(parts)
    keep = Repeated(spark, str(tmp_path_factory.mktemp("repeated") / "keys"))
    refuse = {"late": F.col("day") == 20}
    found = quality.triage(df, ["tag"], ["k"], refuse=refuse, keep=keep, cluster=F.col("k") % 2)
    assert _bag(found) == _bag(quality.triage(df, ["tag"], ["k"], refuse=refuse))
    assert keep.n == sum(n > 1 for n in Counter(k for k, tag, _ in rows if tag is not None).values())


def test_rows_of_single_keys_are_not_moved(spark, tmp_path):
    """Nine keys in ten have one row: their rows go on from the tasks that read them."""
    spark.range(0, 10_000, 1, 4).selectExpr("if(id % 10 = 0, 0, id) as k", "id as v", "repeat('x', 500) as wide").write.parquet(f"{tmp_path}/rows")
    tagged = quality.triage(spark.read.parquet(f"{tmp_path}/rows"), ["k"], ["k"], keep=Repeated(spark, f"{tmp_path}/keys"))
    alone, among = tagged._jdf.queryExecution().optimizedPlan().toString().split("LeftSemi")
    assert "LeftAnti" in alone and "Window" in among + alone
    rows = tagged.withColumn("file", F.col("v") % 10 == 0)
    assert _bag(rows.groupBy("file", "rule").count()) == Counter([(False, None, 9000), (True, None, 1), (True, "duplicate:k", 999)])
    unmoved = tagged._jdf.queryExecution().executedPlan().toString().split("Union", 1)[1].split("Window", 1)[0]
    assert "Exchange hashpartitioning" not in unmoved.split("LeftSemi")[0]


def test_many_repeated_keys_move_each_row_once(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(quality, "FEW_KEYS", 0)
    spark.range(0, 4_000, 1, 4).selectExpr("id div 2 as k", "id as v").write.parquet(f"{tmp_path}/rows")
    tagged = quality.triage(
        spark.read.parquet(f"{tmp_path}/rows"), ["k"], ["k"], keep=Repeated(spark, f"{tmp_path}/keys"), cluster=F.col("k") % 12
    )
    usual = tagged._jdf.queryExecution().executedPlan().toString().split("LeftSemi")[0]
    assert usual.count("Exchange hashpartitioning(_cluster") == 1
    assert _bag(tagged.groupBy("rule").count()) == Counter([(None, 2000), ("duplicate:k", 2000)])


@pytest.mark.parametrize("by_part", [True, False])
def test_only_known_months_are_joined(spark, lake, tmp_path, by_part, monkeypatch):
    store, asked = TableStore(spark, lake), []
    joined = TableStore._read_parts

    def merge(rows, day):
        path = f"{tmp_path}/{day}"
        spark.createDataFrame([(*r, day) for r in rows], FACT).write.parquet(path)
        return store.upsert("facts", FACT, spark.read.schema(FACT).parquet(path), ("id", "day"), part_column="day", batch_date=day, by_part=by_part)

    d1, d2, d3 = date(2019, 1, 5), date(2019, 2, 5), date(2019, 3, 5)
    merge([(1, d1, 1), (2, d2, 1), (3, d2, 1)], MARCH)
    monkeypatch.setattr(TableStore, "_read_parts", lambda self, n, s, current: asked.append(set(current)) or joined(self, n, s, current))
    second = merge([(2, d2, 9), (4, d2, 1), (5, d3, 1), (6, None, 1)], APRIL)
    assert asked == [{"2019-02"}]
    assert (second["rows_inserted"], second["rows_updated"]) == (3, 1)
    assert _bag(store.read_with_actions("facts", FACT), "id", "n", "_action") == Counter(
        [(1, 1, "keep"), (2, 9, "update"), (3, 1, "keep"), (4, 1, "insert"), (5, 1, "insert"), (6, 1, "insert")]
    )
    assert _bag(store.read_incremental("facts", FACT, APRIL), "id") == Counter([(2,), (4,), (5,), (6,)])


def test_an_extract_that_takes_joins_is_built_once(spark, tmp_path):
    dataset = DATASETS["sales"]
    plain = retail_views.batches(spark, "/root/testdata/sf0.001", dataset)
    kept = retail_views.batches(spark, "/root/testdata/sf0.001", dataset, f"{tmp_path}/whole")
    assert [_bag(rows) for rows in kept] == [_bag(rows) for rows in plain]
    assert all("Join" not in rows._jdf.queryExecution().optimizedPlan().toString() for rows in kept)


def test_orders_find_customers_before_lines_move(spark):
    plan = retail_views.raw(spark, "/root/testdata/sf0.001", "sales")._jdf.queryExecution().analyzed().toString()
    assert plan.index("o_custkey") > 0 and retail_views._LINES_JOIN in retail_views.RAW_SQL["sales"]
    by_text = retail_views._run(spark, "/root/testdata/sf0.001", retail_views.RAW_SQL["sales"])
    assert _bag(retail_views.raw(spark, "/root/testdata/sf0.001", "sales")) == _bag(by_text)


def test_digests_of_rows_that_stay_are_written_once(spark):
    """The sorted batch of silver holds no key columns, its table does."""
    last = registry.run_lake(spark, "/root/testdata/sf0.001", ("sales",))[-1]
    root = f"{last.lake_root}/silver/_quality/sales"
    load = spark.read.parquet(root).filter("kind = 'valid'")
    assert load.count() > 0 and load.filter("sales_key is not null").count() == 0
    dataset = DATASETS["sales"]
    assert last.store(spark, "silver").read(dataset.silver_table, dataset.silver).filter("sales_key is null").count() == 0
