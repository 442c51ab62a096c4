"""Casts that turn unreadable text into NULL instead of failing the job."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def cast_int(c: Column) -> Column:
    """Text to int; a decimal fraction (``6.0``, as exports of nullable ints have) is cut off.

    The pattern is only tried on values the plain cast could not read.
    """
    whole_part = F.when(c.rlike(r"^\s*[+-]?\d+\.\d*\s*$"), F.split_part(c, F.lit("."), F.lit(1)))
    return F.coalesce(c.try_cast("int"), whole_part.try_cast("int"))


def cast_decimal(c: Column) -> Column:
    """Text to money with two decimals, rounded half up."""
    return c.try_cast("decimal(10,2)")


def cast_string(c: Column) -> Column:
    return c.cast("string")


def cast_double(c: Column) -> Column:
    return c.try_cast("double")


def cast_date(c: Column) -> Column:
    return c.try_cast("date")


def cast_to(c: Column, data_type: T.DataType, from_text: bool = True) -> Column:
    """``c`` as ``data_type`` with the lenient rules above."""
    if from_text and isinstance(data_type, T.IntegerType):
        return cast_int(c)
    return c.try_cast(data_type)


def apply_schema(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Project ``df`` to the typed contract: names, order and types; absent columns are NULL."""
    present = {f.name.lower(): f for f in df.schema}
    out = []
    for field in schema:
        source = present.get(field.name.lower())
        if source is None:
            value = F.lit(None).cast(field.dataType)
        elif source.dataType == field.dataType:
            value = F.col(f"`{source.name}`")
        else:
            value = cast_to(F.col(f"`{source.name}`"), field.dataType, isinstance(source.dataType, T.StringType))
        out.append(value.alias(field.name))
    return df.select(out)
