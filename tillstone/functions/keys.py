"""Surrogate keys and date keys."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F

from tillstone.functions import casts, rules

# Separator, digest size and the columns behind each key.
KEY_SEPARATOR = "||"
KEY_BITS = 256
SALES_KEY_COLUMNS = ("transaction_id", "transaction_date", "transaction_time", "order", "line_item_id")
INVENTORY_KEY_COLUMNS = ("store_id", "product_id", "baked_date", "transaction_date")


def surrogate_key(columns, null_token: str | None = None) -> Column:
    """SHA-256 hex of the joined columns.

    Joining skips NULLs, so (a, NULL, b) and (a, b) get the same key; a
    ``null_token`` keeps them apart. There always is a key; coalesce tells the
    optimizer, so no plan looks for rows without one.
    """
    parts = [F.col(f"`{c}`") for c in columns]
    if null_token is not None:
        parts = [F.coalesce(p.cast("string"), F.lit(null_token)) for p in parts]
    return F.coalesce(F.sha2(_joined(parts), KEY_BITS), F.lit(""))


def _joined(parts: list[Column]) -> Column:
    return F.concat_ws(KEY_SEPARATOR, *parts)


def key_text(columns) -> Column:
    """The text that ``surrogate_key`` is the digest of: where one is equal, so is the other."""
    return _joined([F.col(f"`{c}`") for c in columns])


def sales_key(null_token: str | None = None) -> Column:
    return surrogate_key(SALES_KEY_COLUMNS, null_token)


def inventory_id(null_token: str | None = None) -> Column:
    return surrogate_key(INVENTORY_KEY_COLUMNS, null_token)


def date_id(c: Column) -> Column:
    """``yyyyMMdd`` text, the key of the calendars; by numbers where the year has four digits, as a formatter takes a time zone."""
    digits = F.year(c) * 10_000 + F.month(c) * 100 + F.day(c)
    return F.when(c.between(F.lit(date(1000, 1, 1)), F.lit(date(9999, 12, 31))), digits.cast("string")).otherwise(F.date_format(c, "yyyyMMdd"))


def reference_key(c: Column) -> Column:
    """Text of a key in one spelling (``3``, ``03`` and ``3.0`` are ``3``); unreadable text stays, blank text is NULL."""
    text = rules.blank_to_null(c)
    return F.coalesce(casts.cast_int(text).cast("string"), text)
