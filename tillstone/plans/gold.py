"""Silver to gold: business columns, the output contract and the merge into the star schema."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillstone import schemas
from tillstone.functions import casts, enrich
from tillstone.operators.projection import project_contract, rename_columns
from tillstone.operators.upsert import Upsert


@dataclass(frozen=True)
class GoldTable:
    name: str
    schema: T.StructType
    key: str
    source: str
    event_date: str | None = None


GOLD = {
    t.name: t
    for t in (
        GoldTable("dim_customer", schemas.DIM_CUSTOMER, "customer_id", "customer"),
        GoldTable("dim_employee", schemas.DIM_EMPLOYEE, "staff_id", "employee"),
        GoldTable("fact_inventory", schemas.FACT_INVENTORY, "inventory_id", "food_inventory", "transaction_date"),
        GoldTable("dim_product", schemas.DIM_PRODUCT, "product_id", "product"),
        GoldTable("fact_sales", schemas.FACT_SALES, "sales_key", "sales", "transaction_date"),
        GoldTable("dim_store", schemas.DIM_STORE, "store_id", "store"),
        GoldTable("baked_calendar", schemas.CALENDAR, "date_id", "calendar"),
        GoldTable("transaction_calendar", schemas.CALENDAR, "date_id", "calendar"),
    )
}


def enrich_customer(silver: DataFrame, ref_date: date = enrich.REFERENCE_DATE) -> DataFrame:
    age = enrich.whole_years(F.col("birthdate"), ref_date)
    return silver.withColumns({"age": age, "age_category": enrich.age_category(age)})


def enrich_employee(silver: DataFrame, ref_date: date = enrich.REFERENCE_DATE) -> DataFrame:
    years = enrich.whole_years(F.col("start_date"), ref_date)
    named = rename_columns(silver, {"location": "store_id"})
    return named.withColumns(
        {
            "full_name": enrich.full_name(F.col("first_name"), F.col("last_name")),
            "duration": years,
            "duration_category": enrich.tenure_band(years),
            "is_manager": enrich.is_manager(F.col("position")),
            "staff_id": casts.cast_int(F.col("staff_id")),
            "store_id": casts.cast_int(F.col("store_id")),
        }
    )


def enrich_inventory(silver: DataFrame) -> DataFrame:
    start, sold = F.col("quantity_start_of_day"), F.col("quantity_sold")
    remaining = enrich.quantity_remaining(start, sold)
    days = enrich.days_since_baked(F.col("transaction_date"), F.col("baked_date"))
    return silver.withColumns(
        {
            "quantity_remaining": remaining,
            "days_since_baked": days,
            "waste_quantity": enrich.waste_quantity(days, remaining),
            "sell_through_rate": enrich.sell_through_rate(sold, start),
            "is_fresh": enrich.is_fresh(days),
            "stockout_flag": enrich.stockout_flag(remaining),
        }
    )


def enrich_product(silver: DataFrame) -> DataFrame:
    margin = enrich.gross_margin_pct(F.col("current_retail_price"), F.col("current_wholesale_price"))
    return silver.withColumn("gross_margin_pct", margin)


def enrich_sales(silver: DataFrame) -> DataFrame:
    return silver.withColumns(
        {
            "time_of_day_category": enrich.time_of_day(F.col("transaction_time")),
            "revenue": enrich.revenue(F.col("unit_price"), F.col("quantity_sold")),
        }
    )


def enrich_store(silver: DataFrame) -> DataFrame:
    parts = [F.col(c) for c in ("store_address", "store_city", "store_state_province", "store_postal_code")]
    return silver.withColumn("store_full_address", enrich.store_full_address(*parts))


_AGED = {"dim_customer": enrich_customer, "dim_employee": enrich_employee}
_ENRICH = {
    "fact_inventory": enrich_inventory,
    "dim_product": enrich_product,
    "fact_sales": enrich_sales,
    "dim_store": enrich_store,
    "baked_calendar": lambda calendar: calendar,
    "transaction_calendar": lambda calendar: calendar,
}


def build_gold(name: str, silver: DataFrame, ref_date: date = enrich.REFERENCE_DATE) -> DataFrame:
    """The enriched batch under the contract of the gold table; ages and years of service as of ``ref_date``."""
    enriched = _AGED[name](silver, ref_date) if name in _AGED else _ENRICH[name](silver)
    return project_contract(enriched, GOLD[name].schema)


def merge_gold(name: str, target: DataFrame, batch: DataFrame) -> Upsert:
    """Merge of a gold batch; the batch keeps its own ``processing_date``."""
    return (
        Upsert(target)
        .using(batch)
        .on(GOLD[name].key)
        .duplicates("unique")
        .when_matched_update()
        .when_not_matched_insert()
    )
