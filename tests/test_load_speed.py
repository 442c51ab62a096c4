"""What a load spends on each row: code small enough to be compiled, observed columns instead of expressions."""

import contextlib
import io
import re
from collections import Counter
from datetime import date

import pytest
from pyspark.sql import functions as F

from tillstone import registry
from tillstone.functions.keys import date_id
from tillstone.operators import quality
from tillstone.operators.upsert import upsert
from tillstone.plans import bronze, silver
from tillstone.plans.gold import GOLD
from tillstone.schemas import DATASETS
from tillstone.sources.quality_log import Repeated
from tillstone.sources.tables import NOT_OLDER, month_part

SF = "/root/testdata/sf0.001"
APRIL = date(2019, 4, 30)
FACTS = ("food_inventory", "sales")
#: The JVM does not compile larger methods, it interprets them.
LARGEST_COMPILED = 8000


def _bag(df, *columns):
    return Counter(tuple(r) for r in df.select(*(columns or df.columns)).collect())


def _largest_method(spark, df):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        with contextlib.redirect_stdout(io.StringIO()) as told:
            df.select("*").explain("codegen")
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    return max(int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", told.getvalue()))


def _facts(spark, dataset, days):
    rows = spark.createDataFrame([(d,) for d in days], f"`{dataset.event_date}` string")
    return rows.selectExpr("*", *[f"'7' as `{c}`" for c in dataset.raw_columns if c != dataset.event_date])


@pytest.mark.parametrize("name", FACTS)
@pytest.mark.parametrize("few", [10, 0])
def test_rules_of_a_load_are_compiled(spark, tmp_path, monkeypatch, name, few):
    monkeypatch.setattr(quality, "FEW_KEYS", few)
    dataset = DATASETS[name]
    _facts(spark, dataset, ["2019-01-05", "2019-01-05", "2019-02-05"]).write.parquet(f"{tmp_path}/rows")
    rows = spark.read.schema(dataset.raw_schema).parquet(f"{tmp_path}/rows")
    tagged = bronze.tagged_batch(rows, dataset, APRIL, Repeated(spark, f"{tmp_path}/keys"))
    assert _bag(tagged.groupBy("rule").count())[(None, 2)] == 1
    assert _largest_method(spark, tagged) < LARGEST_COMPILED


def test_a_load_observes_columns(spark, monkeypatch):
    observed, observe = [], type(spark.range(1)).observe
    monkeypatch.setattr(type(spark.range(1)), "observe", lambda df, seen, *what: observed.extend(map(str, what)) or observe(df, seen, *what))
    registry.run_lake(spark, SF, ("food_inventory",))
    sets = [what for what in observed if "collect_set" in what]
    assert sets and all(re.fullmatch(r"Column<'collect_set\(\w+\) AS \w+'>", what) for what in sets)
    assert not any("split" in what for what in observed)


def test_rows_out_of_the_window_need_no_ranks_of_all(spark, tmp_path):
    """Only rows of repeated keys are numbered and ranked."""
    spark.range(100).selectExpr("if(id < 2, 0, id) as k", "cast(id as string) as day").write.parquet(f"{tmp_path}/rows")
    rows = spark.read.parquet(f"{tmp_path}/rows")
    tagged = quality.triage(rows, ["k"], ["k"], prefer=[F.reverse("day")], keep=Repeated(spark, f"{tmp_path}/keys"))
    plan = tagged._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("monotonically_increasing_id") < plan.index("LeftSemi")
    assert _bag(tagged.groupBy("rule").count()) == Counter([(None, 99), ("duplicate:k", 1)])


@pytest.mark.parametrize(
    "text,month",
    [("2019-01-05", "2019-01"), ("5/31/2019", "2019-05"), ("31-05-2019", "2019-05"), ("2019/3/1", "2019-03"), ("0003-02-01", "0003-02"),
     ("someday", "undated"), ("", "undated"), (None, "undated"), ("2019-02-30", "undated")],
)
def test_month_of_an_event_date(spark, text, month):
    rows = spark.createDataFrame([(text,)], "day string")
    assert rows.select(month_part("day")).collect()[0][0] == month


@pytest.mark.parametrize("name", FACTS)
def test_keys_of_silver_are_counted_by_compiled_code(spark, tmp_path, name):
    dataset, sizes = DATASETS[name], []
    _facts(spark, dataset, ["2019-01-05", "1/5/2019", "2019-02-05", None]).write.parquet(f"{tmp_path}/rows")
    rows = spark.read.schema(dataset.raw_schema).parquet(f"{tmp_path}/rows")
    if name == "food_inventory":
        rows = rows.withColumn("baked_date", F.lit("2019-01-05"))
    kept = Repeated(spark, f"{tmp_path}/keys")

    def keep(repeated):
        sizes.append(_largest_method(spark, repeated))
        return kept(repeated)

    tagged = silver.tagged_batch(rows, dataset, APRIL, APRIL, keep)
    duplicate = "duplicate:" + ",".join(dataset.silver_key)
    assert _bag(tagged.groupBy("rule").count()) == Counter([(None, 2), (duplicate, 1), ("null:transaction_date", 1)])
    assert kept.n == 1 and max(*sizes, _largest_method(spark, tagged)) < LARGEST_COMPILED


@pytest.mark.parametrize("table", ["fact_sales", "fact_inventory"])
def test_merges_are_compiled(spark, tmp_path, table):
    schema, key = GOLD[table].schema, GOLD[table].key
    for side, days in (("target", ["2019-03-31"]), ("source", ["2019-04-30"])):
        rows = spark.createDataFrame([(d,) for d in days], "day string")
        columns = [F.col("day").cast("date") if f.name == "processing_date" else F.lit("7").try_cast(f.dataType) for f in schema]
        rows.select(*[c.alias(f.name) for c, f in zip(columns, schema)]).write.parquet(f"{tmp_path}/{side}")
    target, source = (spark.read.schema(schema).parquet(f"{tmp_path}/{side}") for side in ("target", "source"))
    merged = upsert(target, source, (key,), duplicates="unique", with_actions=True, condition=NOT_OLDER)
    assert _bag(merged, key, "processing_date", "_action") == Counter([("7", date(2019, 4, 30), "update")])
    merged = merged.withColumn("part", month_part(GOLD[table].event_date, schema[GOLD[table].event_date].dataType)).hint("rebalance", F.col("part"))
    assert _largest_method(spark, merged) < LARGEST_COMPILED


def test_rows_of_single_keys_are_read_once_more_at_most(spark, tmp_path):
    """Without a repeated key the rows go on from one read, and no key is looked up."""
    spark.range(10).selectExpr("nullif(id, 3) as k").write.parquet(f"{tmp_path}/rows")
    tagged = quality.triage(spark.read.parquet(f"{tmp_path}/rows"), ["k"], ["k"], keep=Repeated(spark, f"{tmp_path}/keys"))
    plan = tagged._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation") == 1 and "Join" not in plan
    assert _bag(tagged.groupBy("rule").count()) == Counter([(None, 9), ("null:k", 1)])


@pytest.mark.parametrize("text", ["2019-01-05", "0003-02-01", "0999-12-31", "1000-01-01", "9999-12-31", "+12000-01-01", "-0044-03-15", None])
def test_keys_and_months_of_any_date(spark, text):
    day = F.col("day").cast("date")
    rows = spark.createDataFrame([(text,)], "day string").select(day.alias("day"))
    rows = rows.select(date_id(F.col("day")), F.date_format("day", "yyyyMMdd"), month_part("day", rows.schema["day"].dataType), month_part("day"))
    key, formatted, month, by_text = rows.collect()[0]
    assert (key, month) == (formatted, by_text)
