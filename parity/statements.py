"""SQL per query, in the dialect of DuckDB over the same base tables."""

from __future__ import annotations

from parity import views as v

SHORT = {"food_inventory": "inventory"}
SALES = ", ".join(v.SALES_GRAIN)
INVENTORY = ", ".join(v.INVENTORY_GRAIN)
MONEY = "cast(sum(cast(revenue as decimal(18,2))) as double)"


def _select(columns, relation: str) -> str:
    return f"select {', '.join(columns)} from {relation}"


def _raw(name: str, *extra: str) -> str:
    return _select([*v.RAW_COLUMNS[name], *extra], f"raw_{name}")


def _silver(name: str, relation: str) -> str:
    return _select(v.silver_columns(name), relation)


def _audit(name: str) -> str:
    keys = ", ".join(v.MERGE_KEY[name])
    complete = f"std_{name} where {v.present(v.MANDATORY[name])}"
    total, kept = f"(select count(*) from std_{name})", f"(select count(*) from {complete})"
    unique = f"(select count(*) from (select distinct {keys} from {complete}))"
    return " union all ".join(
        f"select '{name}' as dataset, '{rule}' as rule, {a} as rows_in, {b} as rows_out, {a} - {b} as dropped"
        for rule, a, b in (("not_null", total, kept), ("dedup", kept, unique))
    )


def _run_steps(name: str, layer: str, tagged: str, day: str) -> str:
    """The steps of one batch in a layer, each with the rows that come to it and those it drops."""
    dated = layer == "bronze" and name in v.EVENT_DATE
    steps = [*([("malformed", "well_formed")] if layer == "bronze" else []), ("null", "not_null"), *([("date", "real_date")] if dated else []), ("duplicate", "dedup")]
    out, before = [], "0"
    for kind, rule in steps:
        gone = f"count(*) filter (rule like '{kind}:%')"
        rows_in = f"count(*) - ({before})"
        out.append(
            f"select '{name}' as dataset, '{layer}' as layer, {day} as processing_date, '{rule}' as rule, {rows_in} as rows_in, "
            f"{rows_in} - {gone} as rows_out, {gone} as dropped from {tagged}"
        )
        before += f" + {gone}"
    return " union all ".join(out)


def _second_batch(relation: str, name: str) -> str:
    (key,) = v.MERGE_KEY[name]
    return f"select r.*, d.action from {relation} r join did_{name} d on cast(r.{key} as varchar) = cast(d.{key} as varchar)"


def _merges(table: str, name: str) -> str:
    counts = [f"count(*) filter (action = '{a}')" for a in ("insert", "update")]
    return f"""select '{table}' as table_name, cast(1 as integer) as snapshot, (select count(*) from taken1_{name}) as rows_inserted,
            cast(0 as bigint) as rows_updated, cast(0 as bigint) as rows_deleted
        union all select '{table}', 2, {counts[0]}, {counts[1]}, 0 from did_{name}"""


def _calendar_merges(table: str) -> str:
    return f"""select '{table}' as table_name, cast(1 as integer) as snapshot, count(*) as rows_inserted, cast(0 as bigint) as rows_updated,
            cast(0 as bigint) as rows_deleted from calendar union all select '{table}', 2, 0, count(*), 0 from calendar"""


def _one_spelling(key: str) -> str:
    return f"coalesce(cast({v.as_int(key)} as varchar), nullif(trim({key}), ''))"


def _orphans(child: str, key: str, parent: str, parent_key: str) -> str:
    return f"""select {_one_spelling(key)} as orphan_key, count(*) as n_rows, '{child}.{key} -> {parent}' as relation
        from raw_{child} where {_one_spelling(key)} is not null and {_one_spelling(key)} not in (
            select {_one_spelling(f"cast({parent_key} as varchar)")} from silver_{parent}) group by 1"""


def _delivered(name: str, *extra: str) -> str:
    """The extract after a CSV round trip, where an empty field is NULL."""
    return _select([*(f"nullif({c}, '') as {c}" for c in v.RAW_COLUMNS[name]), *extra], f"raw_{name}")


def _landed(name: str) -> str:
    return _delivered(name, f"{v.AS_OF} as processing_date")


def _both_batches(name: str) -> str:
    columns = v.RAW_COLUMNS[name]
    first = _select([*columns, f"{v.FIRST} as processing_date"], f"raw1_{name}")
    return f"{first} union all {_select([*columns, f'{v.SECOND} as processing_date'], f'raw2_{name}')}"


def _bronze(name: str) -> str:
    return v.merged(f"bronze1_{name}", f"bronze2_{name}", v.BRONZE_KEY[name])


def _merged_silver(name: str, keys=None) -> str:
    return v.merged(f"silver1_{name}", f"silver2_{name}", keys or v.MERGE_KEY[name])


def _matches(left: str, right: str, keys) -> str:
    return f"(select count(*) from {left} where ({', '.join(keys)}) in (select ({', '.join(keys)}) from {right}))"


_inv1, _inv2 = "bronze1_food_inventory", "bronze2_food_inventory"
_known = _matches(_inv2, _inv1, v.INVENTORY_GRAIN)
_sold_again = _matches("silver2_sales", "silver1_sales", ("sales_key",))

REFERENCES = (
    ("employee", "location", "store", "store_id"),
    ("sales", "product_id", "product", "product_id"),
    ("sales", "customer_id", "customer", "customer_id"),
    ("sales", "staff_id", "employee", "staff_id"),
    ("sales", "store_id", "store", "store_id"),
    ("food_inventory", "product_id", "product", "product_id"),
    ("food_inventory", "store_id", "store", "store_id"),
)

_BODIES = {
    # Sources, sinks and ingest
    "scan_csv_strings": _delivered("customer"),
    "batch_path_scan": _delivered("product"),
    "scan_delivered": """select nullif(customer_id, '') as customer_id, customer_first_name,
        case when loyalty_card_number is null then 'malformed' else 'landed' end as kind, true as unknown_refused from raw_customer""",
    "scan_calendar_csv": "select * from calendar",
    "scan_parquet_schema": "select * replace (cast(null as varchar) as store_type) from raw_store",
    "scan_one_partition": _select(
        [*v.RAW_COLUMNS["food_inventory"], f"{v.SECOND} as processing_date"], "raw2_food_inventory"
    ),
    "scan_table_incremental": "select * from bronze2_employee",
    "scan_months_incremental": f"select {', '.join(v.RAW_COLUMNS['food_inventory'])}, processing_date from bronze2_food_inventory",
    "write_partitioned_append": _both_batches("sales"),
    "write_single_file": f"""select {v.FIRST} as processing_date, cast(1 as bigint) as files, count(*) as n_rows
        from raw1_store union all select {v.SECOND}, 1, count(*) from raw2_store""",
    "create_table_if_missing": "select *, true as created_first, false as created_again from silver_store",
    "register_view": "select trim(position) as position, count(*) as n from raw_employee group by 1",
    "nonempty_guard": """select count(*) as product_rows, false as employee_landed, true as product_landed
        from raw_product""",
    "stamp_processing_date": _raw("store", f"{v.AS_OF} as processing_date"),
    "ingest_batch_all": " union all ".join(
        f"select '{n}' as dataset, {v.AS_OF} as processing_date, count(*) as n_rows from raw_{n}" for n in v.STANDARD
    ),
    # Projection and casts
    "project_contract": "select * from dim_store",
    "lowercase_headers": _raw("store"),
    "rename_columns": "select * rename (home_store as store_id) from raw_customer",
    "drop_helper_columns": "select * exclude (unit_of_measure) from raw_product",
    "cast_int": _select(
        [
            f"cast({c} as integer) as {c}"
            for c in ("store_id", "product_id", "quantity_start_of_day", "quantity_sold")
        ],
        "raw_food_inventory",
    ),
    "cast_decimal": _select(
        ["product_id"]
        + [
            f"cast({c} as decimal(10,2)) as {c}"
            for c in ("current_cost", "current_wholesale_price", "current_retail_price")
        ],
        "raw_product",
    ),
    "cast_string": "select staff_id, location from raw_employee",
    "cast_double": f"""select product_id, {v.uom_value('unit_of_measure')} as uom_value,
        cast(current_retail_price as double) as current_retail_price from raw_product""",
    "cast_to_contract": f"""select cast(customer_id as integer) as customer_id, cast(home_store as integer) as home_store,
        customer_first_name, customer_email,
        case when regexp_full_match(customer_since, '\\d{{4}}-\\d{{1,2}}-\\d{{1,2}}')
            then try_cast(customer_since as date) end as customer_since, loyalty_card_number,
        case when regexp_full_match(birthdate, '\\d{{4}}-\\d{{1,2}}-\\d{{1,2}}')
            then try_cast(birthdate as date) end as birthdate,
        gender, birth_year, cast(null as date) as processing_date from raw_customer""",
    # Data quality
    "dedup_keys": v.first_of(
        "std_customer", v.silver_columns("customer"), ("customer_id", "customer_since", "birthdate")
    ),
    "require_pk": f"{_raw('customer')} where customer_id is not null",
    "require_all_not_null": f"{_raw('sales')} where {v.present(v.MANDATORY['sales'])}",
    "trim_all": _select([f"trim({c}) as {c}" for c in v.RAW_COLUMNS["customer"]], "raw_customer"),
    "title_case": _select(
        ["staff_id"] + [f"{v.title(c)} as {c}" for c in ("first_name", "last_name", "position")], "raw_employee"
    ),
    "validate_email": f"select customer_id, customer_email, {v.email('customer_email')} as valid_email from raw_customer",
    "normalise_date": _select(
        ["customer_id"] + [f"{v.parsed_date(c)} as {c}" for c in ("customer_since", "birthdate")], "raw_customer"
    ),
    "bound_date": _select(
        ["customer_id"] + [f"{v.bounded_date(c)} as {c}" for c in ("customer_since", "birthdate")], "raw_customer"
    ),
    "standardise_gender": f"select customer_id, gender, {v.gender('gender')} as standard_gender from raw_customer",
    "standardise_flag": _select(
        ["product_id"] + [f"{v.flag(c)} as {c}" for c in ("tax_exempt_yn", "promo_yn", "new_product_yn")], "raw_product"
    ),
    "parse_uom": f"""select product_id, {v.uom_value('unit_of_measure')} as uom_value,
        {v.uom_class('unit_of_measure')} as product_original_uom from raw_product""",
    "uom_to_lb": f"select product_id, {v.uom_lb('unit_of_measure')} as product_lb from raw_product",
    "dq_audit": " union all ".join(_audit(n) for n in v.STANDARD),
    "check_referential_integrity": " union all ".join(
        _orphans(*check)
        for check in REFERENCES
    ),
    "run_orphans": " union all ".join(
        f"""select '{child}' as dataset, {day} as processing_date, '{child}.{key} -> {parent}' as relation,
            cast({key} as varchar) as orphan_key, count(*) as n_rows from taken{i}_{child}
            where {key} is not null and cast({key} as varchar) not in (
                select {_one_spelling(f"cast({parent_key} as varchar)")} from {state}_{parent}) group by {key}"""
        for child, key, parent, parent_key in REFERENCES
        for i, day, state in ((1, v.FIRST, "taken1"), (2, v.SECOND, "after"))
    ),
    "orphans": """select * from silver_employee where location is not null
        and location not in (select cast(store_id as varchar) from silver_store)""",
    "with_parent": "select * from silver_sales where cast(staff_id as varchar) in (select staff_id from silver_employee)",
    "strip_special_chars": """select customer_id,
        regexp_replace(customer_first_name, '[^A-Za-z0-9 ]', '', 'g') as customer_first_name from raw_customer""",
    "reject_log": " union all ".join(
        f"""select {day} as processing_date, rule, record, count(*) as copies, '{n}' as dataset, '{layer}' as layer
            from {view}{i}_{n} where rule is not null group by all"""
        for n in v.STANDARD for layer, view in (("bronze", "btag"), ("silver", "stag")) for i, day in ((1, v.FIRST), (2, v.SECOND))
    ),
    "run_audit": " union all ".join(
        _run_steps(n, layer, f"{view}{i}_{n}", day)
        for n in v.STANDARD for layer, view in (("bronze", "btag"), ("silver", "stag")) for i, day in ((1, v.FIRST), (2, v.SECOND))
    ),
    # Keys
    "sales_key": f"""select {SALES}, sales_key, sha256(concat_ws('||', {', '.join(
        f"coalesce(cast({c} as varchar), '?')" for c in v.SALES_GRAIN)})) as safe_sales_key from std_sales""",
    "inventory_id": f"select {INVENTORY}, inventory_id from std_food_inventory",
    "date_id": "select baked_date, baked_date_id, transaction_date, transaction_date_id from std_food_inventory",
    "key_uniqueness_audit": f"select {SALES}, count(*) as n_rows from std_sales group by {SALES} having count(*) > 1",
    # Upserts
    "upsert_single_key": _merged_silver("customer"),
    "upsert_composite_key": f"select * exclude (inventory_id) from ({_merged_silver('food_inventory', v.INVENTORY_GRAIN)})",
    "upsert_surrogate_key": _merged_silver("sales"),
    "upsert_builder": """
        select coalesce(t.store_id, s.store_id) as store_id,
            coalesce(s.store_type, t.store_type) as store_type,
            coalesce(t.store_square_feet, s.store_square_feet) as store_square_feet,
            case when t.store_id is null then s.store_address when s.store_id is null then t.store_address
                else s.store_address || ' (' || t.store_city || ')' end as store_address,
            coalesce(t.store_city, s.store_city) as store_city,
            coalesce(t.store_state_province, s.store_state_province) as store_state_province,
            coalesce(t.store_postal_code, s.store_postal_code) as store_postal_code,
            coalesce(t.store_longitude, s.store_longitude) as store_longitude,
            coalesce(t.store_latitude, s.store_latitude) as store_latitude,
            t.manager as manager, coalesce(t.neighorhood, s.neighorhood) as neighorhood,
            coalesce(s.processing_date, t.processing_date) as processing_date
        from silver1_store t full join silver2_store s on t.store_id = s.store_id""",
    "upsert_column_subset": """
        select t.* replace (coalesce(s.quantity_sold, t.quantity_sold) as quantity_sold,
                coalesce(s.processing_date, t.processing_date) as processing_date)
        from silver1_food_inventory t left join silver2_food_inventory s on t.inventory_id = s.inventory_id
        union all select * from silver2_food_inventory where inventory_id not in (
            select inventory_id from silver1_food_inventory)""",
    "upsert_restamp": f"""select * replace (case when processing_date = {v.SECOND} then date '2019-05-31'
        else processing_date end as processing_date) from ({_merged_silver('product')})""",
    "merge_metrics": f"""select (select count(*) from silver2_sales) - {_sold_again} as rows_inserted,
        {_sold_again} as rows_updated, cast(0 as bigint) as rows_deleted,
        (select count(*) from silver2_sales) as rows_affected,
        (select count(*) from silver1_sales) + (select count(*) from silver2_sales) - {_sold_again} as total_rows""",
    "merge_history": f"""
        select 'food_inventory_bronze' as table_name, cast(snapshot as integer) as snapshot, operation,
            cast(inserted as bigint) as rows_inserted, cast(updated as bigint) as rows_updated,
            cast(0 as bigint) as rows_deleted
        from (select 0 as snapshot, 'CREATE TABLE' as operation, 0 as inserted, 0 as updated
            union all select 1, 'MERGE', (select count(*) from {_inv1}), 0
            union all select 2, 'MERGE', (select count(*) from {_inv2}) - {_known}, {_known})""",
    # Business columns
    "age": "select customer_id, birthdate, age from dim_customer",
    "age_category": "select customer_id, age, age_category from dim_customer",
    "full_name": "select staff_id, full_name from dim_employee",
    "tenure_years": "select staff_id, start_date, duration from dim_employee",
    "tenure_band": "select staff_id, duration, duration_category from dim_employee",
    "is_manager": "select staff_id, position, is_manager from dim_employee",
    **{
        c: f"select inventory_id, {c} from fact_inventory"
        for c in (
            "quantity_remaining", "days_since_baked", "waste_quantity", "sell_through_rate", "is_fresh", "stockout_flag",
        )
    },
    "gross_margin_pct": "select product_id, gross_margin_pct from dim_product",
    "time_of_day_category": "select sales_key, transaction_time, time_of_day_category from fact_sales",
    "revenue": "select sales_key, unit_price, quantity_sold, revenue from fact_sales",
    "store_full_address": "select store_id, store_full_address from dim_store",
    # Layers
    **{f"landing_{SHORT.get(n, n)}": _landed(n) for n in v.STANDARD},
    **{f"bronze_{SHORT.get(n, n)}": _bronze(n) for n in v.STANDARD},
    **{f"silver_{SHORT.get(n, n)}": _silver(n, f"silver_{n}") for n in v.STANDARD},
    **{
        t: f"select * from {t}"
        for t in ("dim_customer", "dim_employee", "fact_inventory", "dim_product", "fact_sales", "dim_store")
    },
    **{
        f"silver_{SHORT.get(n, n)}_second_batch": _second_batch(f"(select {', '.join(v.silver_columns(n))} from after_{n})", n)
        for n in v.STANDARD
    },
    **{f"{t}_second_batch": _second_batch(f"after_{t}", n) for t, n in v.STAR.items()},
    **{f"{t}_second_batch": "select *, 'update' as action from calendar" for t in ("baked_calendar", "transaction_calendar")},
    "gold_merge_metrics": " union all ".join(
        [_merges(t, n) for t, n in v.STAR.items()] + [_calendar_merges(t) for t in ("baked_calendar", "transaction_calendar")]
    ),
    "baked_calendar": "select * from calendar",
    "transaction_calendar": "select * from calendar",
    "date_spine_454": "select * from calendar",
    # Analyses
    "sales_star": """
        select f.*, p.product, p.product_category, p.product_type, c.gender, c.age_category,
            e.full_name as staff_name, e.duration_category, d."FiscalYear", d."FiscalMonthName", d."DayName"
        from fact_sales f left join dim_product p on cast(f.product_id as varchar) = p.product_id
            left join dim_customer c on f.customer_id = c.customer_id
            left join dim_employee e on f.staff_id = e.staff_id
            left join calendar d on f.transaction_date_id = d.date_id""",
    "inventory_star": """
        select f.*, p.product, p.product_category, s.store_city, s.neighorhood,
            d."FiscalYear", d."FiscalWeekOfYear", d."DayName"
        from fact_inventory f left join dim_product p on cast(f.product_id as varchar) = p.product_id
            left join dim_store s on f.store_id = s.store_id
            left join calendar d on f.baked_date_id = d.date_id""",
    "revenue_by_period": f"""
        select "FiscalYear", "FiscalMonthNumber", "FiscalMonthName", {MONEY} as revenue,
            cast(sum(quantity_sold) as bigint) as units, count(*) as lines
        from fact_sales left join calendar on transaction_date_id = date_id group by 1, 2, 3""",
    "revenue_by_level": f"""
        select case when grouping("Date") = 0 then 'Date' when grouping("FiscalWeekOfYear") = 0 then 'FiscalWeekOfYear'
                when grouping("FiscalMonthNumber") = 0 then 'FiscalMonthNumber' when grouping("FiscalQuarter") = 0 then 'FiscalQuarter'
                else 'FiscalYear' end as level,
            "FiscalYear", "FiscalQuarter", "FiscalMonthNumber", "FiscalWeekOfYear", "Date",
            {MONEY} as revenue, cast(sum(quantity_sold) as bigint) as units, count(*) as lines
        from fact_sales left join calendar on transaction_date_id = date_id
        group by grouping sets (("FiscalYear"), ("FiscalYear", "FiscalQuarter"), ("FiscalYear", "FiscalQuarter", "FiscalMonthNumber"),
            ("FiscalYear", "FiscalQuarter", "FiscalMonthNumber", "FiscalWeekOfYear"),
            ("FiscalYear", "FiscalQuarter", "FiscalMonthNumber", "FiscalWeekOfYear", "Date"))""",
    "transaction_volume": """
        select store_id, transaction_date, count(distinct (transaction_id, transaction_time)) as transactions,
            count(*) as lines from fact_sales group by 1, 2""",
    "product_mix": f"""
        select *, round(revenue / cast(sum(cast(revenue as decimal(18,2)))
                over (partition by product_category) as double), 4) as category_share,
            round(revenue / cast(sum(cast(revenue as decimal(18,2))) over () as double), 4) as total_share
        from (
            select product_category, product_type, {MONEY} as revenue, cast(sum(quantity_sold) as bigint) as units
            from fact_sales f left join dim_product p on cast(f.product_id as varchar) = p.product_id
            group by 1, 2)""",
    "customer_demographics": f"""
        select age_category, gender, count(distinct f.customer_id) as customers, count(*) as lines, {MONEY} as revenue
        from fact_sales f left join dim_customer c on f.customer_id = c.customer_id group by 1, 2""",
    "time_of_day_pattern": f"""
        select time_of_day_category, {MONEY} as revenue, cast(sum(quantity_sold) as bigint) as units,
            count(*) as lines from fact_sales group by 1""",
    "daily_stock_levels": """
        select store_id, product_id, transaction_date, cast(sum(quantity_start_of_day) as bigint) as start_of_day,
            cast(sum(quantity_sold) as bigint) as sold, cast(sum(quantity_remaining) as bigint) as remaining
        from fact_inventory group by 1, 2, 3""",
    "sell_through_rollup": """
        select store_id, product_id, cast(grouping(store_id, product_id) as integer) as level,
            cast(sum(quantity_sold) as bigint) as sold, cast(sum(quantity_start_of_day) as bigint) as stocked,
            round(sum(quantity_sold) / nullif(sum(quantity_start_of_day), 0), 3) as sell_through
        from fact_inventory group by rollup (store_id, product_id)""",
    "waste_by_store_product": """
        select store_id, product_id, cast(sum(waste_quantity) as bigint) as waste_quantity
        from fact_inventory group by 1, 2""",
    "stockout_events": """
        select store_id, product_id, count(*) filter (stockout_flag = 'Y') as stockouts,
            count(distinct transaction_date) filter (quantity_start_of_day > 0) as days_stocked
        from fact_inventory group by 1, 2""",
    "top_products_selling_out": """
        select store_id, product_id, sold, stockouts, sales_rank from (
            select store_id, product_id, cast(sum(quantity_sold) as bigint) as sold,
                count(*) filter (stockout_flag = 'Y') as stockouts,
                cast(row_number() over (partition by store_id
                    order by sum(quantity_sold) desc nulls last, product_id) as integer) as sales_rank
            from fact_inventory group by 1, 2)
        where sales_rank <= 10 and stockouts > 0""",
    "loyalty_engagement": f"""
        select case when c.customer_id is null then 'unknown' when loyalty_card_number is null then 'no card'
                else 'card' end as loyalty,
            count(distinct coalesce(c.customer_id, f.customer_id)) as customers,
            count(distinct f.customer_id) as buyers, count(f.customer_id) as lines, coalesce({MONEY}, 0) as revenue
        from dim_customer c full join fact_sales f on f.customer_id = c.customer_id group by 1""",
    "staff_sales_performance": f"""
        select f.staff_id, {MONEY} as revenue, count(*) as lines, full_name, duration_category, is_manager
        from fact_sales f left join dim_employee e on f.staff_id = e.staff_id
        group by f.staff_id, full_name, duration_category, is_manager""",
}

STATEMENTS = {name: v.statement(body) for name, body in _BODIES.items()}
