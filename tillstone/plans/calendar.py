"""The 4-5-4 retail calendar as a generated date spine.

A fiscal year starts on the Sunday in January 29 to February 4. Quarters
have 13 weeks in months of 4, 5 and 4 weeks; a 53rd week belongs to the last
month. All attributes are text, as reports expect.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillstone.functions.keys import date_id
from tillstone.schemas import CALENDAR_COLUMNS

# Names of the fiscal months, first month first.
FISCAL_MONTHS = (
    "February", "March", "April", "May", "June", "July",
    "August", "September", "October", "November", "December", "January",
)


def days_between(bounds: DataFrame) -> DataFrame:
    """One row per day from ``first_day`` to ``last_day`` of a one-row DataFrame."""
    return bounds.select(F.explode(F.sequence("first_day", "last_day", F.expr("interval 1 day"))).alias("day"))


def fiscal_year_start(year: Column) -> Column:
    """The Sunday on or before February 4."""
    fourth = F.make_date(year, F.lit(2), F.lit(4))
    return F.date_sub(fourth, F.dayofweek(fourth) - 1)


def fiscal_attributes(days: DataFrame) -> DataFrame:
    """The calendar attributes and ``date_id`` of each ``day``."""
    day, year = F.col("day"), F.year("day")
    started = day >= fiscal_year_start(year)
    numbered = (
        days.withColumn("fy", F.when(started, year).otherwise(year - 1))
        .withColumn("week", (F.floor(F.datediff(day, fiscal_year_start(F.col("fy"))) / 7) + 1).cast("int"))
        .withColumn("quarter", F.least(F.ceil(F.col("week") / 13).cast("int"), F.lit(4)))
        .withColumn("week_of_quarter", F.col("week") - (F.col("quarter") - 1) * 13)
        .withColumn(
            "month_of_quarter",
            F.when(F.col("week_of_quarter") <= 4, 1).when(F.col("week_of_quarter") <= 9, 2).otherwise(3),
        )
        .withColumn("month", (F.col("quarter") - 1) * 3 + F.col("month_of_quarter"))
    )
    month_name = F.element_at(F.array(*[F.lit(m) for m in FISCAL_MONTHS]), F.col("month"))
    fy = F.col("fy").cast("string")
    values = (
        day,
        fy,
        F.col("quarter"),
        F.col("month"),
        F.col("month_of_quarter"),
        F.col("week"),
        F.dayofweek(day),
        month_name,
        F.concat_ws(" ", month_name, fy),
        F.concat(F.lit("Q"), F.col("quarter").cast("string"), F.lit(" "), fy),
        F.dayofmonth(day),
        F.date_format(day, "EEEE"),
    )
    return numbered.select(
        *[value.cast("string").alias(name) for name, value in zip(CALENDAR_COLUMNS, values, strict=True)],
        date_id(day).alias("date_id"),
    )


def calendar_spine(bounds: DataFrame) -> DataFrame:
    return fiscal_attributes(days_between(bounds))


def with_date_id(calendar: DataFrame) -> DataFrame:
    """Key of a calendar read from a file."""
    return calendar.withColumn("date_id", F.regexp_replace("Date", "-", ""))
