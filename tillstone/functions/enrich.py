"""Business rules of the gold layer."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F

# Reference date, band limits (inclusive) and labels, thresholds.
REFERENCE_DATE = date(2019, 4, 30)
AGE_BANDS = ((18, 25, "18-25"), (26, 35, "26-35"), (36, 50, "36-50"), (51, 65, "51-65"))
AGE_OTHERWISE = "65+"
TENURE_BANDS = ((0, 1, "0-1yrs"), (1, 3, "1-3yrs"), (3, 5, "3-5yrs"), (5, 7, "5-7yrs"), (7, 10, "7-10yrs"))
TENURE_OTHERWISE = "10+ yrs"
DAY_PARTS = ((6, 11, "Morning"), (12, 14, "Lunch"), (15, 17, "Afternoon"), (18, 21, "Evening"))
MANAGER_POSITION = "Store Manager"
FRESH_DAYS = 3


def band(c: Column, bands, otherwise: str | None = None, unknown_label: str | None = None) -> Column:
    """Label of the first band that holds the value.

    ``otherwise`` takes all remaining values, NULL too, unless
    ``unknown_label`` gives NULL a label of its own.
    """
    out = F.lit(otherwise).cast("string")
    for low, high, label in reversed(bands):
        out = F.when(c.between(low, high), F.lit(label)).otherwise(out)
    return out if unknown_label is None else F.when(c.isNull(), F.lit(unknown_label)).otherwise(out)


def whole_years(since: Column, ref_date: date = REFERENCE_DATE) -> Column:
    return F.floor(F.months_between(F.lit(ref_date), since) / 12)


def age_category(age: Column, unknown_label: str | None = None) -> Column:
    return band(age, AGE_BANDS, AGE_OTHERWISE, unknown_label)


def tenure_band(years: Column, unknown_label: str | None = None) -> Column:
    return band(years, TENURE_BANDS, TENURE_OTHERWISE, unknown_label)


def full_name(first: Column, last: Column) -> Column:
    return F.concat_ws(" ", first, last)


def yes_no(condition: Column) -> Column:
    return F.when(condition, F.lit("Y")).otherwise(F.lit("N"))


def is_manager(position: Column) -> Column:
    return yes_no(position == MANAGER_POSITION)


def quantity_remaining(start: Column, sold: Column) -> Column:
    return start - sold


def days_since_baked(transaction_date: Column, baked_date: Column) -> Column:
    return F.datediff(transaction_date, baked_date)


def waste_quantity(days: Column, remaining: Column) -> Column:
    return F.when(days > FRESH_DAYS, remaining).otherwise(F.lit(0))


def sell_through_rate(sold: Column, start: Column) -> Column:
    return F.when(start > 0, F.round(F.try_divide(sold, start), 3)).otherwise(F.lit(0.0))


def is_fresh(days: Column) -> Column:
    return yes_no(days <= FRESH_DAYS)


def stockout_flag(remaining: Column) -> Column:
    return yes_no(remaining == 0)


def gross_margin_pct(retail: Column, wholesale: Column) -> Column:
    """Margin as a share of the retail price, NULL where the price is zero."""
    return F.round(F.try_divide(retail - wholesale, retail), 3).cast("decimal(15,3)")


def time_of_day(time_text: Column) -> Column:
    """Day part of a clock time; a bare time gets a fixed date, so the result never depends on today."""
    stamp = F.when(time_text.rlike(r"^\d{1,2}:"), F.concat(F.lit("1970-01-01 "), time_text)).otherwise(time_text)
    return band(F.hour(stamp.try_cast("timestamp")), DAY_PARTS)


def revenue(unit_price: Column, quantity: Column) -> Column:
    """Price times quantity, multiplied as decimals so that rounding is exact."""
    exact = F.round(unit_price.try_cast("decimal(10,2)") * quantity, 3)
    return exact.cast("double")


def store_full_address(*parts: Column) -> Column:
    return F.concat_ws(",", *parts)
