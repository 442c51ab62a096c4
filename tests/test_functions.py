import hashlib
from datetime import date
from decimal import Decimal

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillstone.functions import casts, enrich, keys



def test_cast_int(evaluate):
    values = ["7", " 7 ", "6.0", "-3.9", "007", "abc", "", "1.2.3", "99999999999", None]
    assert evaluate(lambda c: casts.cast_int(c), values) == [7, 7, 6, -3, 7, None, None, None, None, None]


def test_cast_decimal(evaluate):
    values = ["2.666", "0.6125", "18.0", "x", "", "123456789.00"]
    expected = [Decimal("2.67"), Decimal("0.61"), Decimal("18.00"), None, None, None]
    assert evaluate(lambda c: casts.cast_decimal(c), values) == expected


def test_cast_double_and_date(evaluate):
    assert evaluate(lambda c: casts.cast_double(c), ["1.5", "", "x", None]) == [1.5, None, None, None]
    assert evaluate(lambda c: casts.cast_date(c), ["2019-04-30", "n/a"]) == [date(2019, 4, 30), None]


def test_apply_schema(spark):
    schema = T.StructType(
        [T.StructField("b", T.IntegerType()), T.StructField("a", T.StringType()), T.StructField("z", T.DateType())]
    )
    out = casts.apply_schema(spark.createDataFrame([("x", "6.0", 1)], "A string, b string, extra int"), schema)
    assert [(f.name, f.dataType) for f in out.schema] == [(f.name, f.dataType) for f in schema]
    assert out.collect()[0] == (6, "x", None)


def test_surrogate_key(spark):
    df = spark.createDataFrame([("a", None, "b"), ("a", "b", None)], "x string, y string, z string")
    plain = [r[0] for r in df.select(keys.surrogate_key(["x", "y", "z"])).collect()]
    assert plain == [hashlib.sha256(b"a||b").hexdigest()] * 2
    safe = [r[0] for r in df.select(keys.surrogate_key(["x", "y", "z"], null_token="?")).collect()]
    assert safe == [hashlib.sha256(t).hexdigest() for t in (b"a||?||b", b"a||b||?")]


def test_date_id(evaluate):
    assert evaluate(lambda c: keys.date_id(c), [date(2019, 4, 3), None], "date") == ["20190403", None]


def test_age_bands(evaluate):
    values = [17, 18, 25, 26, 35, 36, 50, 51, 65, 66, None]
    labels = ["65+", "18-25", "18-25", "26-35", "26-35", "36-50", "36-50", "51-65", "51-65", "65+", "65+"]
    assert evaluate(lambda c: enrich.age_category(c), values, "bigint") == labels
    assert evaluate(lambda c: enrich.age_category(c, "unknown"), [17, None], "bigint") == ["65+", "unknown"]


def test_tenure_bands(evaluate):
    values = [-1, 0, 1, 2, 3, 4, 5, 6, 7, 8, 10, 11, None]
    labels = ["10+ yrs", "0-1yrs", "0-1yrs", "1-3yrs", "1-3yrs", "3-5yrs", "3-5yrs", "5-7yrs", "5-7yrs", "7-10yrs",
              "7-10yrs", "10+ yrs", "10+ yrs"]
    assert evaluate(lambda c: enrich.tenure_band(c), values, "bigint") == labels


def test_whole_years(evaluate):
    values = [date(2000, 4, 30), date(2000, 5, 1), date(2000, 4, 29), date(2019, 4, 30), None]
    assert evaluate(lambda c: enrich.whole_years(c), values, "date") == [19, 18, 19, 0, None]


def test_time_of_day(evaluate):
    values = ["05:59:59", "06:00:00", "11:59:00", "12:00:00", "14:59:59", "15:00:00", "17:30:00", "18:00:00",
              "21:59:59", "22:00:00", "2019-04-01 07:00:00", "25:00:00", "abc", None]
    labels = [None, "Morning", "Morning", "Lunch", "Lunch", "Afternoon", "Afternoon", "Evening", "Evening", None,
              "Morning", None, None, None]
    assert evaluate(lambda c: enrich.time_of_day(c), values) == labels


def test_inventory_rules(spark):
    rows = [(10, 4, 3), (10, 4, 4), (0, 0, 0), (5, 5, None), (None, 1, 1)]
    df = spark.createDataFrame(rows, "start int, sold int, days int")
    remaining = enrich.quantity_remaining(F.col("start"), F.col("sold"))
    out = df.select(
        remaining.alias("remaining"),
        enrich.waste_quantity(F.col("days"), remaining).alias("waste"),
        enrich.sell_through_rate(F.col("sold"), F.col("start")).alias("rate"),
        enrich.is_fresh(F.col("days")).alias("fresh"),
        enrich.stockout_flag(remaining).alias("out"),
    ).collect()
    assert [tuple(r) for r in out] == [
        (6, 0, 0.4, "Y", "N"),
        (6, 6, 0.4, "N", "N"),
        (0, 0, 0.0, "Y", "Y"),
        (0, 0, 1.0, "N", "Y"),
        (None, 0, 0.0, "Y", "N"),
    ]


def test_margin_and_revenue(spark):
    df = spark.createDataFrame(
        [(Decimal("18.00"), Decimal("14.40"), 2.5, 3), (Decimal("0.00"), Decimal("1.00"), None, 1)],
        "retail decimal(10,2), wholesale decimal(10,2), price double, n int",
    )
    out = df.select(
        enrich.gross_margin_pct(F.col("retail"), F.col("wholesale")), enrich.revenue(F.col("price"), F.col("n"))
    ).collect()
    assert [tuple(r) for r in out] == [(Decimal("0.200"), 7.5), (None, None)]
    assert df.select(enrich.gross_margin_pct(F.col("retail"), F.col("wholesale")).alias("m")).schema["m"].dataType == (
        T.DecimalType(15, 3)
    )


def test_address_skips_missing_parts(spark):
    df = spark.createDataFrame([("1 Main", None, "NY", 10007)], "a string, b string, c string, d int")
    assert df.select(enrich.store_full_address(*[F.col(c) for c in "abcd"])).collect()[0][0] == "1 Main,NY,10007"
