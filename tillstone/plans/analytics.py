"""Questions the star schema answers.

Facts are added up by the join key before they meet a dimension, so a hot
customer, product or missing key is one row by then. No join is hinted:
Spark measures the sides and broadcasts only what fits. Money is summed as
decimals, so the order of addition cannot change a result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillstone.functions.keys import date_id

MONEY = "decimal(18,2)"


def _money(name: str = "revenue") -> Column:
    return F.sum(F.col(name).cast(MONEY))


def _as_double(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({n: F.col(n).cast("double") for n in names})


def _left(fact: DataFrame, dim: DataFrame, on: str) -> DataFrame:
    return fact.join(dim, on, "left")


def sales_star(fact, product, customer, employee, calendar) -> DataFrame:
    """Every sale with the attributes of its product, customer, employee and day; a fact without the key of its day gets it here."""
    products = product.select(
        F.col("product_id").alias("_product"), "product", "product_category", "product_type"
    )
    customers = customer.select("customer_id", "gender", "age_category")
    staff = employee.select("staff_id", F.col("full_name").alias("staff_name"), "duration_category")
    days = calendar.select(
        F.col("date_id").alias("transaction_date_id"), "FiscalYear", "FiscalMonthName", "DayName"
    )
    # Products have the longest attributes: where facts are moved to both, those need not go on to the customers.
    joined = _left(fact, customers, "customer_id")
    joined = joined.join(products, F.col("product_id").cast("string") == F.col("_product"), "left").drop("_product")
    if "transaction_date_id" not in joined.columns:
        joined = joined.withColumn("transaction_date_id", date_id(F.col("transaction_date")))
    star = _left(_left(joined, staff, "staff_id"), days, "transaction_date_id")
    first = ["transaction_date_id", "staff_id", "customer_id"]
    attributes = [*products.columns[1:], *customers.columns[1:], *staff.columns[1:], *days.columns[1:]]
    return star.select(*first, *[f"`{c}`" for c in fact.columns if c not in first], *attributes)


def inventory_star(fact, product, store, calendar) -> DataFrame:
    """Every inventory row with the attributes of its product, store and baking day."""
    products = product.select(F.col("product_id").alias("_product"), "product", "product_category")
    stores = store.select("store_id", "store_city", "neighorhood")
    days = calendar.select(F.col("date_id").alias("baked_date_id"), "FiscalYear", "FiscalWeekOfYear", "DayName")
    joined = fact.join(products, F.col("product_id").cast("string") == F.col("_product"), "left").drop("_product")
    return _left(_left(joined, stores, "store_id"), days, "baked_date_id")


def revenue_by_period(fact, calendar) -> DataFrame:
    """Revenue, units and lines per fiscal month."""
    per_day = fact.groupBy("transaction_date_id").agg(
        _money().alias("revenue"), F.sum("quantity_sold").alias("units"), F.count(F.lit(1)).alias("lines")
    )
    days = calendar.select(
        F.col("date_id").alias("transaction_date_id"), "FiscalYear", "FiscalMonthNumber", "FiscalMonthName"
    )
    out = (
        _left(per_day, days, "transaction_date_id")
        .groupBy("FiscalYear", "FiscalMonthNumber", "FiscalMonthName")
        .agg(F.sum("revenue").alias("revenue"), F.sum("units").alias("units"), F.sum("lines").alias("lines"))
    )
    return _as_double(out, "revenue")


LEVELS = ("FiscalYear", "FiscalQuarter", "FiscalMonthNumber", "FiscalWeekOfYear", "Date")


def revenue_by_level(fact, calendar) -> DataFrame:
    """Revenue, units and lines per fiscal year, quarter, month, week and day, in one pass over the sums of the days.

    ``level`` names the finest column that is set. Days that the calendar lacks are
    one group of NULLs in each level.
    """
    per_day = fact.groupBy("transaction_date_id").agg(
        _money().alias("revenue"), F.sum("quantity_sold").alias("units"), F.count(F.lit(1)).alias("lines")
    )
    days = calendar.select(F.col("date_id").alias("transaction_date_id"), *LEVELS)
    sets = [[F.col(c) for c in LEVELS[: i + 1]] for i in range(len(LEVELS))]
    finest = F.lit(LEVELS[0])
    for c in LEVELS[1:]:
        finest = F.when(F.grouping(c) == 0, F.lit(c)).otherwise(finest)
    out = _left(per_day, days, "transaction_date_id").groupingSets(sets, *[F.col(c) for c in LEVELS]).agg(
        finest.alias("level"), F.sum("revenue").alias("revenue"), F.sum("units").alias("units"), F.sum("lines").alias("lines")
    )
    return _as_double(out, "revenue")


def transaction_volume(fact) -> DataFrame:
    """Transactions and lines per store and day; a visit is a transaction id at a time of day."""
    return fact.groupBy("store_id", "transaction_date").agg(
        F.count_distinct("transaction_id", "transaction_time").alias("transactions"),
        F.count(F.lit(1)).alias("lines"),
    )


def product_mix(fact, product) -> DataFrame:
    """Revenue per category and type, with its share of the category and of everything."""
    per_product = fact.groupBy(F.col("product_id").cast("string").alias("product_id")).agg(
        _money().alias("revenue"), F.sum("quantity_sold").alias("units")
    )
    kinds = product.select("product_id", "product_category", "product_type")
    mix = (
        _left(per_product, kinds, "product_id")
        .groupBy("product_category", "product_type")
        .agg(F.sum("revenue").alias("revenue"), F.sum("units").alias("units"))
    )
    of_category = F.sum("revenue").over(Window.partitionBy("product_category"))
    of_all = mix.agg(F.sum("revenue")).scalar()

    def share(total: Column) -> Column:
        return F.round(F.try_divide(F.col("revenue").cast("double"), total.cast("double")), 4)

    return _as_double(mix.withColumns({"category_share": share(of_category), "total_share": share(of_all)}), "revenue")


def _per_customer(fact) -> DataFrame:
    return fact.groupBy("customer_id").agg(_money().alias("revenue"), F.count(F.lit(1)).alias("lines"))


def customer_demographics(fact, customer) -> DataFrame:
    """Customers, lines and revenue per age category and gender."""
    out = (
        _left(_per_customer(fact), customer.select("customer_id", "age_category", "gender"), "customer_id")
        .groupBy("age_category", "gender")
        .agg(
            F.count(F.lit(1)).alias("customers"),
            F.sum("lines").alias("lines"),
            F.sum("revenue").alias("revenue"),
        )
    )
    return _as_double(out, "revenue")


def time_of_day_pattern(fact) -> DataFrame:
    """Revenue, units and lines per part of the day."""
    out = fact.groupBy("time_of_day_category").agg(
        _money().alias("revenue"), F.sum("quantity_sold").alias("units"), F.count(F.lit(1)).alias("lines")
    )
    return _as_double(out, "revenue")


def daily_stock_levels(fact) -> DataFrame:
    """Start, sold and remaining per store, product and day."""
    return fact.groupBy("store_id", "product_id", "transaction_date").agg(
        F.sum("quantity_start_of_day").alias("start_of_day"),
        F.sum("quantity_sold").alias("sold"),
        F.sum("quantity_remaining").alias("remaining"),
    )


def sell_through_rollup(fact) -> DataFrame:
    """Sold over stocked as a ratio of sums: per store and product, per store, and overall."""
    per_product = fact.groupBy("store_id", "product_id").agg(
        F.sum("quantity_sold").alias("sold"), F.sum("quantity_start_of_day").alias("stocked")
    )
    rolled = per_product.rollup("store_id", "product_id").agg(
        F.grouping_id().cast("int").alias("level"),
        F.sum("sold").alias("sold"),
        F.sum("stocked").alias("stocked"),
    )
    return rolled.withColumn("sell_through", F.round(F.try_divide(F.col("sold"), F.col("stocked")), 3))


def waste_by_store_product(fact) -> DataFrame:
    return fact.groupBy("store_id", "product_id").agg(F.sum("waste_quantity").alias("waste_quantity"))


def stockout_events(fact) -> DataFrame:
    """Times a product sold out, and the days on which it was stocked, per store and product."""
    stocked_day = F.when(F.col("quantity_start_of_day") > 0, F.col("transaction_date"))
    return fact.groupBy("store_id", "product_id").agg(
        F.count_if(F.col("stockout_flag") == "Y").alias("stockouts"), F.count_distinct(stocked_day).alias("days_stocked")
    )


def top_products_selling_out(fact, k: int = 10) -> DataFrame:
    """Among the ``k`` best sellers of each store, those that sold out at least once."""
    per_product = fact.groupBy("store_id", "product_id").agg(
        F.sum("quantity_sold").alias("sold"), F.count_if(F.col("stockout_flag") == "Y").alias("stockouts")
    )
    best_first = Window.partitionBy("store_id").orderBy(F.col("sold").desc_nulls_last(), F.col("product_id"))
    ranked = per_product.withColumn("sales_rank", F.row_number().over(best_first)).filter(F.col("sales_rank") <= k)
    return ranked.filter("stockouts > 0")


def loyalty_engagement(fact, customer) -> DataFrame:
    """Customers, buyers among them and their revenue with and without a loyalty card.

    Customers who bought nothing count; buyers missing in the dimension are ``unknown``.
    """
    cards = customer.select(
        "customer_id", F.when(F.col("loyalty_card_number").isNotNull(), "card").otherwise("no card").alias("loyalty")
    )
    out = (
        cards.join(_per_customer(fact), "customer_id", "full")
        .groupBy(F.coalesce("loyalty", F.lit("unknown")).alias("loyalty"))
        .agg(
            F.count(F.lit(1)).alias("customers"),
            F.count("lines").alias("buyers"),
            F.coalesce(F.sum("lines"), F.lit(0)).alias("lines"),
            F.coalesce(F.sum("revenue"), F.lit(0)).alias("revenue"),
        )
    )
    return _as_double(out, "revenue")


def staff_sales_performance(fact, employee) -> DataFrame:
    """Revenue and lines per employee, with tenure."""
    per_staff = fact.groupBy("staff_id").agg(_money().alias("revenue"), F.count(F.lit(1)).alias("lines"))
    staff = employee.select("staff_id", "full_name", "duration_category", "is_manager")
    return _as_double(_left(per_staff, staff, "staff_id"), "revenue")
