"""Raw retail extracts derived from the general sales tables, as delivered text.

The expressions are the shared subset of Spark and ANSI SQL, so the same
text describes the input to both sides of a result comparison. Table names
stand in braces; ``"order"`` is the only quoted identifier.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tillstone.schemas import Dataset
from tillstone.sources.tables import CODEC

BASE_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem")

# The two batches of incremental runs. Facts are corrected for a year by the second batch.
FIRST_DAY, SECOND_DAY = "2019-03-31", "2019-04-30"
CORRECTED_FROM, FIRST_BATCH_UNTIL = "1998-01-01", "1999-01-01"


def _dirty(day: str, key: str) -> str:
    """A date as nine kinds of delivered text, chosen by an integer key."""
    year, month, dom = (f"cast({part}({day}) as string)" for part in ("year", "month", "day"))
    two_digit_month, two_digit_day = f"lpad({month}, 2, '0')", f"lpad({dom}, 2, '0')"
    return f"""case ({key}) % 9
        when 0 then cast({day} as string)
        when 1 then concat({year}, '/', {month}, '/', {dom})
        when 2 then concat({two_digit_month}, '/', {two_digit_day}, '/', {year})
        when 3 then concat({two_digit_day}, '-', {two_digit_month}, '-', {year})
        when 4 then ''
        when 5 then null
        when 6 then 'n/a'
        when 7 then '1899-05-05'
        else '2999-01-01' end"""


_SINCE = "(date '2001-01-01' + cast((c_custkey * 11) % 6000 as int))"
_BORN = "(date '1930-01-01' + cast((c_custkey * 37) % 32000 as int))"
_HIRED = "(date '2002-01-01' + cast((s_suppkey * 61) % 6300 as int))"
_STOCK = "(case when l_orderkey % 50 = 0 then 0 else cast(l_quantity as int) end)"

_CUSTOMER_ROWS = f"""
    select c_custkey,
        case when c_custkey % 97 = 5 then null else cast(c_custkey as string) end as customer_id,
        cast(c_nationkey as string) as home_store,
        case c_custkey % 3 when 0 then lower(c_name) when 1 then upper(c_name)
            else concat('  ', c_name, ' ') end as customer_first_name,
        case c_custkey % 6
            when 0 then concat('user', cast(c_custkey as string), '@shop.com')
            when 1 then concat('user', cast(c_custkey as string), 'shop.com')
            when 2 then concat('u@', cast(c_custkey as string), '@shop.com')
            when 3 then concat('user', cast(c_custkey as string), '@shopcom')
            when 4 then concat('a.b', cast(c_custkey as string), '@shop.com')
            else null end as customer_email,
        {_dirty(_SINCE, "c_custkey + 4")} as customer_since,
        case when c_custkey % 5 = 0 then null
            else concat('L-', cast(c_custkey as string)) end as loyalty_card_number,
        {_dirty(_BORN, "c_custkey")} as birthdate,
        case c_custkey % 8 when 0 then 'm' when 1 then 'MALE' when 2 then 'F' when 3 then 'female'
            when 4 then 'o' when 5 then 'mALE' when 6 then null else 'Other' end as gender,
        cast(year({_BORN}) as string) as birth_year
    from {{customer}}"""

_CUSTOMER_COLUMNS = """customer_id, home_store, customer_first_name, customer_email, customer_since,
    loyalty_card_number, birthdate, gender, birth_year"""

RAW_SQL = {
    # Every tenth customer is delivered twice.
    "customer": f"""select {_CUSTOMER_COLUMNS} from ({_CUSTOMER_ROWS}) as c
        union all select {_CUSTOMER_COLUMNS} from ({_CUSTOMER_ROWS}) as d where c_custkey % 10 = 0""",
    "employee": f"""
        select case when s_suppkey % 31 = 7 then null else cast(s_suppkey as string) end as staff_id,
            upper(s_name) as first_name, lower(s_name) as last_name,
            case when s_suppkey % 5 = 0 then 'store MANAGER' else ' coffee wrangler' end as position,
            {_dirty(_HIRED, "s_suppkey")} as start_date,
            cast(s_nationkey + 3 as string) as location
        from {{supplier}}""",
    "store": """
        select cast(n_nationkey as string) as store_id, 'retail' as store_type,
            cast(900 + 100 * n_nationkey as string) as store_square_feet,
            concat(cast(n_nationkey + 1 as string), ' Main Street') as store_address,
            n_name as store_city, r_name as store_state_province,
            cast(10000 + n_nationkey as string) as store_postal_code,
            '-73.9' as store_longitude, '40.7' as store_latitude,
            concat(cast(n_nationkey as string), '.0') as manager, concat(' ', n_name) as neighorhood
        from {nation} join {region} on n_regionkey = r_regionkey""",
    "product": """
        select cast(p_partkey as string) as product_id, p_type as product_group, p_brand as product_category,
            p_type as product_type, p_name as product, concat(' ', p_name, ' ') as product_description,
            case p_partkey % 7 when 0 then '12 oz' when 1 then '1 lb' when 2 then '.9 oz' when 3 then 'pump'
                when 4 then 'single' when 5 then '3.0 OZ' else 'box' end as unit_of_measure,
            cast(cast(p_retailprice * 0.2 as decimal(10,2)) as string) as current_cost,
            cast(cast(p_size as decimal(10,2)) as string) as current_wholesale_price,
            case when p_partkey % 101 = 0 then '0'
                else cast(cast(p_size * 1.37 + 1 as decimal(10,2)) as string) end as current_retail_price,
            case p_partkey % 3 when 0 then 'yes' when 1 then 'N' else null end as tax_exempt_yn,
            case when p_partkey % 4 = 0 then 'True' else '0' end as promo_yn,
            case when p_partkey % 5 = 0 then 'y' else 'no' end as new_product_yn
        from {part}""",
    "sales": """
        select cast(l_orderkey as string) as transaction_id,
            cast(cast(o_orderdate as date) as string) as transaction_date,
            concat(lpad(cast((l_orderkey * 7 + l_linenumber) % 24 as string), 2, '0'), ':',
                lpad(cast((l_orderkey * 13) % 60 as string), 2, '0'), ':00') as transaction_time,
            cast(c_nationkey as string) as store_id, cast(l_suppkey as string) as staff_id,
            case when l_orderkey % 89 = 0 then null else cast(o_custkey as string) end as customer_id,
            case l_linenumber % 4 when 0 then 'yes' when 1 then 'Y' when 2 then 'N' else null end as instore_yn,
            cast(1 + l_orderkey % 3 as string) as "order", cast(l_linenumber as string) as line_item_id,
            cast(l_partkey as string) as product_id, cast(cast(l_quantity as int) as string) as quantity_sold,
            cast(cast(p_retailprice as decimal(10,2)) as string) as unit_price,
            case when l_discount > 0.05 then 'true' else 'n' end as promo_item_yn
        from {lineitem} join {orders} on l_orderkey = o_orderkey
            join {customer} on o_custkey = c_custkey join {part} on l_partkey = p_partkey""",
    "food_inventory": f"""
        select cast(l_suppkey % 25 as string) as store_id,
            cast(cast(l_shipdate as date) - cast(l_linenumber % 6 as int) as string) as baked_date,
            cast(cast(l_shipdate as date) as string) as transaction_date,
            cast(l_partkey as string) as product_id,
            cast({_STOCK} as string) as quantity_start_of_day,
            cast(case when l_partkey % 4 = 0 then {_STOCK} else l_orderkey % ({_STOCK} + 1) end as string)
                as quantity_sold
        from {{lineitem}}""",
}

CALENDAR_BOUNDS_SQL = """
    select min(first_day) as first_day, max(last_day) as last_day from (
        select cast(min(o_orderdate) as date) as first_day, cast(max(o_orderdate) as date) as last_day from {orders}
        union all select cast(min(l_shipdate) as date), cast(max(l_shipdate) as date) from {lineitem}) as b"""

# The second extract of a lookup: the same rows, half of them under new ids, with one attribute changed.
_RENUMBERED = {
    "customer": "cast(cast(home_store as int) + 1 as string) as home_store",
    "employee": "cast(cast(location as int) + 1 as string) as location",
    "store": "'outlet' as store_type",
    "product": "'1 lb' as unit_of_measure",
}


def second_batch_sql(name: str, table: str) -> str:
    """The second batch of a dataset, over a relation holding the first (lookups) or all of it (facts)."""
    if name in _RENUMBERED:
        key = {"customer": "customer_id", "employee": "staff_id", "store": "store_id", "product": "product_id"}[name]
        return f"""select cast(2 * cast({key} as bigint) as string) as {key}, {_RENUMBERED[name]},
            * except ({key}, {_RENUMBERED[name].split()[-1]}) from {table}"""
    return f"""select cast(cast(quantity_sold as int) + 1 as string) as quantity_sold,
        * except (quantity_sold) from {table} where transaction_date >= '{CORRECTED_FROM}'"""


def first_batch_sql(name: str, table: str) -> str:
    if name in _RENUMBERED:
        return f"select * from {table}"
    return f"select * from {table} where transaction_date < '{FIRST_BATCH_UNTIL}'"


def _run(spark: SparkSession, sf_dir: str, text: str) -> DataFrame:
    tables = {t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in BASE_TABLES if "{" + t + "}" in text}
    return spark.sql(text.replace('"order"', "`order`"), **tables)


# Joined in the order of the text, lines would be moved three times; orders find their customers first.
_LINES_JOIN = """{lineitem} join {orders} on l_orderkey = o_orderkey
            join {customer} on o_custkey = c_custkey join {part} on l_partkey = p_partkey"""
_LINES_JOIN_SMALL_FIRST = """{lineitem} join {part} on l_partkey = p_partkey
            join ({orders} join {customer} on o_custkey = c_custkey) on l_orderkey = o_orderkey"""


def raw(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One raw extract with all its rows."""
    return _run(spark, sf_dir, RAW_SQL[name].replace(_LINES_JOIN, _LINES_JOIN_SMALL_FIRST))


def calendar_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _run(spark, sf_dir, CALENDAR_BOUNDS_SQL)


def batches(spark: SparkSession, sf_dir: str, dataset: Dataset, keep_at: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Two batches that together hold every row, with corrections in the second.

    An extract that takes joins is built for both at once, if there is a folder to ``keep_at``.
    """
    whole = raw(spark, sf_dir, dataset.name)
    if keep_at and " join " in RAW_SQL[dataset.name]:
        whole.write.option("compression", CODEC).parquet(keep_at)
        whole = spark.read.schema(whole.schema).parquet(keep_at)
    first = spark.sql(first_batch_sql(dataset.name, "{whole}"), whole=whole)
    second = spark.sql(second_batch_sql(dataset.name, "{whole}"), whole=whole)
    return first.select(dataset.raw_columns), second.select(dataset.raw_columns)


def export_extract(df: DataFrame, path: str, quote: str = '"') -> None:
    """Write an extract as the delivered CSV: header, text as it is (without ``quote`` also where it holds a comma)."""
    (
        df.write.mode("overwrite")
        .option("header", True)
        .option("quote", quote)
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )
