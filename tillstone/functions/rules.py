"""Data-quality rules, each a ``Column -> Column`` expression that stays in generated code."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F

# Accepted spellings, flag words and the earliest plausible date.
GENDER_SPELLINGS = {
    "Male": ("m", "M", "Male", "MALE", "male"),
    "Female": ("f", "F", "Female", "female", "FEMALE"),
    "Other": ("o", "O", "other", "OTHER", "Other"),
}
FLAG_TRUE = ("Y", "YES", "TRUE")
EARLIEST_DATE = date(1900, 1, 1)

# Unit classes in order of precedence and ounces per pound.
UNIT_CLASSES = ("pump", "single", "oz", "lb")
UNKNOWN_UNIT = "unknown"
OUNCES_PER_POUND = 16

_YEAR_FIRST = r"^\d{4}([-/])\d{1,2}\1\d{1,2}$"
_YEAR_LAST = r"^\d{1,2}([-/])\d{1,2}\1\d{4}$"


def blank_to_null(c: Column) -> Column:
    trimmed = F.trim(c)
    return F.when(trimmed != "", trimmed)


def title_case(c: Column) -> Column:
    """First letter of every space-delimited word upper case, the rest lower case."""
    return F.initcap(F.trim(c))


def _occurrences(c: Column, character: str) -> Column:
    return F.length(c) - F.length(F.translate(c, character, ""))


def validate_email(c: Column) -> Column:
    """Keep an address with exactly one ``@`` and one ``.``; blank any other, keep NULL."""
    well_formed = (_occurrences(c, "@") == 1) & (_occurrences(c, ".") == 1)
    return F.when(c.isNull() | well_formed, c).otherwise(F.lit(""))


def normalise_date(c: Column) -> Column:
    """Text in year-first, month-first or day-first order, ``-`` or ``/``, to a date.

    Where both month-first and day-first are possible, month-first wins. The
    text is rearranged to ISO and cast: a formatter per pattern would throw
    and catch an exception for every pattern that does not fit. Padded ISO
    text, by far the most common, is recognised without a regular expression.
    """
    text = F.trim(c)
    padded_iso = (
        (F.length(text) == 10)
        & (F.substring(text, 5, 1) == "-")
        & (F.substring(text, 8, 1) == "-")
        & (text >= "0")  # the cast would read a sign
    )
    dashed = F.translate(text, "/", "-")
    first, second, last = (F.split_part(dashed, F.lit("-"), F.lit(i)) for i in (1, 2, 3))
    month_first = F.concat_ws("-", last, first, second).try_cast("date")
    day_first = F.concat_ws("-", last, second, first).try_cast("date")
    return (
        F.when(padded_iso, text.try_cast("date"))
        .when(text.rlike(_YEAR_FIRST), dashed.try_cast("date"))
        .when(text.rlike(_YEAR_LAST), F.coalesce(month_first, day_first))
    )


def bound_date(c: Column, as_of: Column | None = None) -> Column:
    """NULL for dates after ``as_of`` (today by default) or before 1900."""
    upper = F.current_date() if as_of is None else as_of
    return F.when(c.between(F.lit(EARLIEST_DATE), upper), c)


def clean_date(c: Column, as_of: Column | None = None) -> Column:
    return bound_date(normalise_date(c), as_of)


def standardise_gender(c: Column) -> Column:
    """Known spellings to one label; anything else is left as it is."""
    out = c
    for label, spellings in reversed(GENDER_SPELLINGS.items()):
        out = F.when(c.isin(*spellings), F.lit(label)).otherwise(out)
    return out


def standardise_flag(c: Column) -> Column:
    """``Y`` for a true word in any case, ``N`` for everything else including NULL."""
    return F.when(F.upper(c).isin(*FLAG_TRUE), F.lit("Y")).otherwise(F.lit("N"))


def uom_value(c: Column) -> Column:
    """The number in a unit of measure (``.9 oz`` is 0.9), NULL without one."""
    return F.regexp_extract(c, r"([\d.]+)", 1).try_cast("double")


def uom_class(c: Column) -> Column:
    """The first unit class contained in the text."""
    lowered = F.lower(c)
    out = F.lit(UNKNOWN_UNIT)
    for unit in reversed(UNIT_CLASSES):
        out = F.when(lowered.contains(unit), F.lit(unit)).otherwise(out)
    return out


def uom_to_lb(unit: Column, value: Column) -> Column:
    """Weight in pounds; units that are not weights have none."""
    return F.when(unit == "lb", value).when(unit == "oz", F.round(value / OUNCES_PER_POUND, 4))


def strip_special_chars(c: Column, keep: str = "A-Za-z0-9 ") -> Column:
    """Remove every character outside the class ``keep``."""
    return F.regexp_replace(c, f"[^{keep}]", "")
