"""Bronze to silver: clean one batch of a dataset and merge it into its table.

Order of the rules: trim, blank keys to NULL, parse and cast, require the
mandatory columns, keep one row per merge key.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillstone.functions import casts, keys, rules
from tillstone.functions.enrich import REFERENCE_DATE
from tillstone.operators.projection import drop_helper_columns, lowercase_headers, project_contract, trim_all
from tillstone.operators.quality import Keep, keep_complete, split_rejects, triage
from tillstone.operators.upsert import upsert
from tillstone.schemas import DATASETS, Dataset
from tillstone.sources.tables import month_part


DELIVERED = "delivered"
STEPS = ("null", "duplicate")


def _text(name: str) -> Column:
    return F.col(f"`{name}`")


def _standardised(dataset: Dataset, as_of: Column) -> dict[str, Column]:
    """Column rules every dataset gets from its configuration."""
    # Typed columns turn blank text into NULL when they are cast; text keys need it said.
    text_keys = [f.name for f in dataset.silver if f.name in dataset.mandatory and f.dataType == T.StringType()]
    out = {c: rules.blank_to_null(_text(c)) for c in text_keys}
    out |= {c: rules.title_case(_text(c)) for c in dataset.title_columns}
    out |= {c: rules.clean_date(_text(c), as_of) for c in dataset.date_columns}
    out |= {c: rules.standardise_flag(_text(c)) for c in dataset.flag_columns}
    return out


def _customer(columns: dict[str, Column]) -> dict[str, Column]:
    return {
        "customer_email": rules.validate_email(columns["customer_email"]),
        "gender": rules.standardise_gender(_text("gender")),
    }


def _employee(columns: dict[str, Column]) -> dict[str, Column]:
    return {c: casts.cast_string(casts.cast_int(_text(c))) for c in ("staff_id", "location")}


def _product(columns: dict[str, Column]) -> dict[str, Column]:
    prices = ("current_cost", "current_wholesale_price", "current_retail_price")
    unit = rules.uom_class(_text("unit_of_measure"))
    return {c: casts.cast_decimal(_text(c)) for c in prices} | {
        "product_original_uom": unit,
        "product_lb": rules.uom_to_lb(unit, rules.uom_value(_text("unit_of_measure"))),
    }


def _sales(columns: dict[str, Column]) -> dict[str, Column]:
    return {"unit_price": casts.cast_decimal(_text("unit_price")).cast("double")}


_SPECIFIC = {"customer": _customer, "employee": _employee, "product": _product, "sales": _sales}


def standardise(raw: DataFrame, dataset: Dataset, processing_date: date, as_of: date | None = None) -> DataFrame:
    """Every column rule of the dataset, row by row: no row is dropped here."""
    today = F.current_date() if as_of is None else F.lit(as_of)
    text = trim_all(lowercase_headers(raw))
    columns = _standardised(dataset, today)
    columns |= _SPECIFIC.get(dataset.name, lambda _: {})(columns)
    columns["processing_date"] = F.lit(processing_date)
    standard = drop_helper_columns(text.withColumns(columns), *_helpers(dataset))
    typed = casts.apply_schema(standard, T.StructType([*dataset.silver, *(raw.schema[c] for c in raw.columns if c == DELIVERED)]))
    return typed.withColumns(key_columns(dataset))


def clean_sales_by_text(raw: DataFrame, processing_date: date = REFERENCE_DATE, as_of: date | None = None) -> DataFrame:
    """``clean`` of sales for readers that merge nothing: rows meet by the text of their key, its digest is set afterwards.

    A digest does not compress, so it is most of what a row moves. A merge needs its rows dealt by digest all the same.
    """
    dataset, text = DATASETS["sales"], "_key_text"
    # The date id follows from the date, so no order of rows depends on it.
    standard = standardise(raw, dataset, processing_date, as_of).drop(*key_columns(dataset))
    valid = keep_complete(standard.withColumn(text, keys.key_text(keys.SALES_KEY_COLUMNS)), dataset.mandatory, (text,), dataset.latest_by)
    return project_contract(valid.withColumns(key_columns(dataset)), dataset.silver)


def _helpers(dataset: Dataset) -> list[str]:
    return ["unit_of_measure"] if dataset.name == "product" else []


def key_columns(dataset: Dataset) -> dict[str, Column]:
    if dataset.name == "sales":
        return {"sales_key": keys.sales_key(), "transaction_date_id": keys.date_id(F.col("transaction_date"))}
    if dataset.name == "food_inventory":
        return {
            "baked_date_id": keys.date_id(F.col("baked_date")),
            "transaction_date_id": keys.date_id(F.col("transaction_date")),
            "inventory_id": keys.inventory_id(),
        }
    return {}


def clean(raw: DataFrame, dataset: Dataset, processing_date: date = REFERENCE_DATE, as_of: date | None = None) -> DataFrame:
    """The batch as it goes into the merge: standardised, complete, one row per merge key."""
    standard = standardise(raw, dataset, processing_date, as_of)
    valid = keep_complete(standard, dataset.mandatory, dataset.silver_key, dataset.latest_by)
    return project_contract(valid, dataset.silver)


def tagged_batch(
    raw: DataFrame, dataset: Dataset, processing_date: date, as_of: date | None = None, keep: Keep | None = None
) -> DataFrame:
    """The standardised rows with ``rule``, NULL for those of ``clean``, and ``delivered``: the text of their keys and mandatory columns."""
    part = month_part(dataset.event_date, dataset.silver[dataset.event_date].dataType) if dataset.event_date else None
    identity = F.struct(*[_text(c) for c in dataset.identity])
    standard = standardise(raw.withColumn(DELIVERED, identity), dataset, processing_date, as_of)
    columns = [f.name for f in dataset.silver]
    return triage(standard, dataset.mandatory, dataset.silver_key, dataset.latest_by, order_columns=columns, keep=keep, cluster=part)


def delivered_schema(dataset: Dataset) -> T.StructType:
    """What the reject log of silver holds of a row."""
    text = T.StructType([T.StructField(c, T.StringType()) for c in dataset.identity])
    return T.StructType([*dataset.silver, T.StructField(DELIVERED, text)])


def clean_with_rejects(
    raw: DataFrame, dataset: Dataset, processing_date: date = REFERENCE_DATE, as_of: date | None = None
) -> tuple[DataFrame, DataFrame]:
    """The clean batch, and the log of the rows it leaves out."""
    standard = standardise(raw, dataset, processing_date, as_of)
    return split_rejects(standard, dataset.mandatory, dataset.silver_key, dataset.latest_by)


def merge_silver(target: DataFrame, batch: DataFrame, dataset: Dataset, processing_date: date = REFERENCE_DATE) -> DataFrame:
    """The silver table after a clean batch; touched rows carry the batch date."""
    stamp = {"processing_date": F.lit(processing_date)}
    return upsert(target, batch, dataset.silver_key, overrides=stamp, duplicates="unique")


def silver(name: str, raw: DataFrame, processing_date: date = REFERENCE_DATE, as_of: date = REFERENCE_DATE) -> DataFrame:
    """Clean one batch of the named dataset."""
    return clean(raw, DATASETS[name], processing_date, as_of)
