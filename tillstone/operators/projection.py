"""Projection, renaming and header operators."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def project_contract(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Exactly the contract's columns in the contract's order."""
    return df.select([F.col(f"`{f.name}`") for f in schema])


def lowercase_headers(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.lower() for c in df.columns])


def rename_columns(df: DataFrame, names: dict[str, str]) -> DataFrame:
    return df.withColumnsRenamed(names)


def drop_helper_columns(df: DataFrame, *names: str) -> DataFrame:
    return df.drop(*names)


def trim_all(df: DataFrame) -> DataFrame:
    """Trim spaces from every text column in one projection; other types are left alone."""
    return df.select(
        [
            F.trim(F.col(f"`{f.name}`")).alias(f.name) if isinstance(f.dataType, T.StringType) else F.col(f"`{f.name}`")
            for f in df.schema
        ]
    )
