"""Named SQL relations: raw extracts, and what each layer must make of them.

The raw extracts share their text with the Spark side because they define
the input. Everything after that is written here on its own.
"""

from __future__ import annotations

import re

from tillstone.sources import retail_views as rv

AS_OF = "date '2019-04-30'"
FIRST, SECOND = f"date '{rv.FIRST_DAY}'", f"date '{rv.SECOND_DAY}'"

DATE_FORMATS = "['%Y-%m-%d', '%Y/%m/%d', '%m-%d-%Y', '%m/%d/%Y', '%d-%m-%Y', '%d/%m/%Y']"


def title(c: str) -> str:
    words = f"string_split(trim({c}), ' ')"
    return f"array_to_string(list_transform({words}, lambda w: upper(w[1]) || lower(w[2:])), ' ')"


def parsed_date(c: str) -> str:
    return f"cast(try_strptime(trim({c}), {DATE_FORMATS}) as date)"


def bounded_date(c: str) -> str:
    d = parsed_date(c)
    return f"case when {d} >= date '1900-01-01' and {d} <= {AS_OF} then {d} end"


def as_int(c: str) -> str:
    return f"try_cast(trim({c}) as integer)"


def flag(c: str) -> str:
    return f"case when upper(trim({c})) in ('Y', 'YES', 'TRUE') then 'Y' else 'N' end"


def email(c: str) -> str:
    ats, dots = (f"(length({c}) - length(replace({c}, '{x}', '')))" for x in ("@", "."))
    return f"case when {c} is null then null when {ats} > 1 or {dots} > 1 or {ats} = 0 or {dots} = 0 then '' else {c} end"


def gender(c: str) -> str:
    return (
        f"case when {c} in ('m', 'M', 'Male', 'MALE', 'male') then 'Male' "
        f"when {c} in ('f', 'F', 'Female', 'female', 'FEMALE') then 'Female' "
        f"when {c} in ('o', 'O', 'other', 'OTHER', 'Other') then 'Other' else {c} end"
    )


def uom_value(c: str) -> str:
    return f"try_cast(nullif(regexp_extract({c}, '([0-9.]+)', 1), '') as double)"


def uom_class(c: str) -> str:
    tests = " ".join(f"when {c} ilike '%{u}%' then '{u}'" for u in ("pump", "single", "oz", "lb"))
    return f"case {tests} else 'unknown' end"


def uom_lb(c: str) -> str:
    unit, value = uom_class(c), uom_value(c)
    return f"case when {unit} = 'lb' then {value} when {unit} = 'oz' then round({value} / 16, 4) end"


def day_key(c: str) -> str:
    return f"strftime({c}, '%Y%m%d')"


def sha(*columns: str) -> str:
    return f"sha256(concat_ws('||', {', '.join(f'cast({c} as varchar)' for c in columns)}))"


SALES_GRAIN = ("transaction_id", "transaction_date", "transaction_time", '"order"', "line_item_id")
INVENTORY_GRAIN = ("store_id", "product_id", "baked_date", "transaction_date")

# Column lists: (name, expression over the raw row).
STANDARD = {
    "customer": (
        ("customer_id", as_int("customer_id")),
        ("home_store", as_int("home_store")),
        ("customer_first_name", title("customer_first_name")),
        ("customer_email", email(title("customer_email"))),
        ("customer_since", bounded_date("customer_since")),
        ("loyalty_card_number", "trim(loyalty_card_number)"),
        ("birthdate", bounded_date("birthdate")),
        ("gender", gender("trim(gender)")),
        ("birth_year", "trim(birth_year)"),
    ),
    "employee": (
        ("staff_id", f"cast({as_int('staff_id')} as varchar)"),
        ("first_name", title("first_name")),
        ("last_name", title("last_name")),
        ("position", title("position")),
        ("start_date", bounded_date("start_date")),
        ("location", f"cast({as_int('location')} as varchar)"),
    ),
    "food_inventory": (
        ("store_id", as_int("store_id")),
        ("baked_date", bounded_date("baked_date")),
        ("transaction_date", bounded_date("transaction_date")),
        ("product_id", as_int("product_id")),
        ("quantity_start_of_day", as_int("quantity_start_of_day")),
        ("quantity_sold", as_int("quantity_sold")),
    ),
    "product": (
        ("product_id", "nullif(trim(product_id), '')"),
        ("product_group", "trim(product_group)"),
        ("product_category", "trim(product_category)"),
        ("product_type", "trim(product_type)"),
        ("product", "trim(product)"),
        ("product_description", "trim(product_description)"),
        ("current_cost", "try_cast(current_cost as decimal(10,2))"),
        ("current_wholesale_price", "try_cast(current_wholesale_price as decimal(10,2))"),
        ("current_retail_price", "try_cast(current_retail_price as decimal(10,2))"),
        ("tax_exempt_yn", flag("tax_exempt_yn")),
        ("promo_yn", flag("promo_yn")),
        ("new_product_yn", flag("new_product_yn")),
    ),
    "sales": (
        ("transaction_id", as_int("transaction_id")),
        ("transaction_date", bounded_date("transaction_date")),
        ("transaction_time", "nullif(trim(transaction_time), '')"),
        ("store_id", as_int("store_id")),
        ("staff_id", as_int("staff_id")),
        ("customer_id", as_int("customer_id")),
        ("instore_yn", flag("instore_yn")),
        ('"order"', as_int('"order"')),
        ("line_item_id", as_int("line_item_id")),
        ("product_id", as_int("product_id")),
        ("quantity_sold", as_int("quantity_sold")),
        ("unit_price", "cast(try_cast(unit_price as decimal(10,2)) as double)"),
        ("promo_item_yn", flag("promo_item_yn")),
    ),
    "store": (
        ("store_id", as_int("store_id")),
        ("store_type", "trim(store_type)"),
        ("store_square_feet", as_int("store_square_feet")),
        ("store_address", "trim(store_address)"),
        ("store_city", "trim(store_city)"),
        ("store_state_province", "trim(store_state_province)"),
        ("store_postal_code", as_int("store_postal_code")),
        ("store_longitude", "try_cast(store_longitude as double)"),
        ("store_latitude", "try_cast(store_latitude as double)"),
        ("manager", "try_cast(manager as double)"),
        ("neighorhood", "trim(neighorhood)"),
    ),
}

# Columns that follow processing_date, over the standardised row.
APPENDED = {
    "product": (
        ("product_original_uom", uom_class("trim(unit_of_measure)")),
        ("product_lb", uom_lb("trim(unit_of_measure)")),
    ),
}
KEYS_OF = {
    "food_inventory": (
        ("baked_date_id", day_key("baked_date")),
        ("transaction_date_id", day_key("transaction_date")),
        ("inventory_id", sha(*INVENTORY_GRAIN)),
    ),
    "sales": (("sales_key", sha(*SALES_GRAIN)), ("transaction_date_id", day_key("transaction_date"))),
}

MERGE_KEY = {
    "customer": ("customer_id",),
    "employee": ("staff_id",),
    "food_inventory": ("inventory_id",),
    "product": ("product_id",),
    "sales": ("sales_key",),
    "store": ("store_id",),
}
BRONZE_KEY = {**MERGE_KEY, "food_inventory": INVENTORY_GRAIN, "sales": SALES_GRAIN}
LATEST_BY = {"customer": ("customer_since", "birthdate"), "employee": ("start_date",)}
MANDATORY = {
    **{k: v for k, v in MERGE_KEY.items() if k not in ("food_inventory", "sales")},
    "food_inventory": INVENTORY_GRAIN,
    "sales": (
        "transaction_id", "product_id", "customer_id", "store_id", "staff_id", "transaction_date", "transaction_time",
    ),
}
RAW_COLUMNS = {
    name: [c for c, _ in columns if c not in ("processing_date",)] for name, columns in STANDARD.items()
}
RAW_COLUMNS["product"] = (
    RAW_COLUMNS["product"][:6] + ["unit_of_measure"] + RAW_COLUMNS["product"][6:]
)


def silver_columns(name: str) -> list[str]:
    return [
        *[c for c, _ in STANDARD[name]], "processing_date",
        *[c for c, _ in APPENDED.get(name, ())], *[c for c, _ in KEYS_OF.get(name, ())],
    ]


def present(columns) -> str:
    return " and ".join(f"{c} is not null" for c in columns)


def first_of(relation: str, columns, keys, latest=(), where: str = "true", prefer: str = "true") -> str:
    """One row per key under the total order both engines use."""
    rest = [c for c in columns if c not in keys and c not in latest]
    order = [f"({prefer}) desc"] + [f"{c} desc nulls last" for c in latest] + [f"{c} asc nulls last" for c in rest]
    ranked = f"row_number() over (partition by {', '.join(keys)} order by {', '.join(order)}) as rn"
    listed = ", ".join(columns)
    return f"select {listed} from (select {listed}, {ranked} from {relation} where {where}) where rn = 1"


def merged(target: str, source: str, keys) -> str:
    """Source rows, and the target rows no source row replaces."""
    same = " and ".join(f"s.{k} = t.{k}" for k in keys)
    return f"select * from {source} union all select t.* from {target} t where not exists (select 1 from {source} s where {same})"


def _standard(name: str, relation: str, day: str) -> str:
    plain = ", ".join(f"{e} as {c}" for c, e in STANDARD[name])
    extra = "".join(f", {e} as {c}" for c, e in APPENDED.get(name, ()))
    inner = f"select {plain}, {day} as processing_date{extra} from {relation}"
    if name not in KEYS_OF:
        return inner
    return f"select *, {', '.join(f'{e} as {c}' for c, e in KEYS_OF[name])} from ({inner})"


VIEWS: dict[str, str] = {}


def _duck(text: str) -> str:
    return re.sub(r"\{(\w+)\}", r"\1", text).replace("* except", "* exclude")


for _name in STANDARD:
    VIEWS[f"raw_{_name}"] = _duck(rv.RAW_SQL[_name])
    VIEWS[f"raw1_{_name}"] = _duck(rv.first_batch_sql(_name, f"raw_{_name}"))
    VIEWS[f"raw2_{_name}"] = _duck(
        f"select {', '.join(RAW_COLUMNS[_name])} from ({rv.second_batch_sql(_name, f'raw_{_name}')})"
    )
    for _suffix, _day in (("", AS_OF), ("1", FIRST), ("2", SECOND)):
        VIEWS[f"std{_suffix}_{_name}"] = _standard(_name, f"raw{_suffix}_{_name}", _day)
        VIEWS[f"silver{_suffix}_{_name}"] = first_of(
            f"std{_suffix}_{_name}", silver_columns(_name), MERGE_KEY[_name], LATEST_BY.get(_name, ()),
            present(MANDATORY[_name]),
        )
        _raw_listed = ", ".join(RAW_COLUMNS[_name])
        _filled = " and ".join(f"coalesce(trim({c}), '') <> ''" for c in MANDATORY[_name])
        _first = first_of(
            f"raw{_suffix}_{_name}", RAW_COLUMNS[_name], BRONZE_KEY[_name], [bounded_date(c) for c in LATEST_BY.get(_name, ())],
            present(BRONZE_KEY[_name]), _filled,
        )
        VIEWS[f"bronze{_suffix}_{_name}"] = f"select {_raw_listed}, {_day} as processing_date from ({_first})"

# Batches as the load path takes them: every row with the rule it fails --------------------

EVENT_DATE = {"food_inventory": "transaction_date", "sales": "transaction_date"}


def _plain(column: str) -> str:
    return column.strip('"')


def _failed(columns, dated: str | None = None) -> str:
    """The rule a row fails by itself: an event date that is none, or the mandatory columns that are missing."""
    missing = ", ".join(f"case when {c} is null then '{_plain(c)}' end" for c in columns)
    date_rule = "" if dated is None else f"when {dated} is not null and {bounded_date(dated)} is null then 'date:{dated}' "
    return f"case {date_rule}when not ({present(columns)}) then 'null:' || concat_ws(',', {missing}) end"


def _tagged(inner: str, columns, keys, order) -> str:
    """Rows of ``inner`` (with ``failed`` and ``record``) and their ``rule``, NULL for the first row of a key."""
    ranked = f"row_number() over (partition by {', '.join(keys)}, failed is null order by {', '.join(order)}) as rn"
    duplicate = f"case when rn > 1 then 'duplicate:{','.join(map(_plain, keys))}' end"
    return f"select {', '.join(columns)}, record, coalesce(failed, {duplicate}) as rule from (select *, {ranked} from ({inner}))"


for _name in STANDARD:
    _keys, _latest, _listed = BRONZE_KEY[_name], LATEST_BY.get(_name, ()), RAW_COLUMNS[_name]
    _identity = list(dict.fromkeys((*_keys, *MANDATORY[_name])))
    _record = f"concat_ws('|', {', '.join(f"coalesce({c}, '<null>')" for c in _identity)}) as record"
    _filled = " and ".join(f"coalesce(trim({c}), '') <> ''" for c in MANDATORY[_name])
    _raw_order = [f"({_filled}) desc", *[f"{bounded_date(c)} desc nulls last" for c in _latest]]
    _raw_order += [f"{c} asc nulls last" for c in _listed if c not in _keys]
    _silver_order = [f"{c} desc nulls last" for c in _latest]
    _silver_order += [f"{c} asc nulls last" for c in silver_columns(_name) if c not in MERGE_KEY[_name] and c not in _latest]
    for _suffix, _day in (("1", FIRST), ("2", SECOND)):
        VIEWS[f"btag{_suffix}_{_name}"] = _tagged(
            f"select *, {_record}, {_failed(_keys, EVENT_DATE.get(_name))} as failed from raw{_suffix}_{_name}",
            _listed, _keys, _raw_order,
        )
        _parsed = ", ".join(f"{e} as {c}" for c, e in STANDARD[_name])
        _more = "".join(f", {e} as {c}" for c, e in APPENDED.get(_name, ()))
        _typed = f"select {_parsed}, {_day} as processing_date{_more}, record from btag{_suffix}_{_name} where rule is null"
        _surrogate = "".join(f", {e} as {c}" for c, e in KEYS_OF.get(_name, ()))
        VIEWS[f"stag{_suffix}_{_name}"] = _tagged(
            f"select *{_surrogate}, {_failed(MANDATORY[_name])} as failed from ({_typed})",
            silver_columns(_name), MERGE_KEY[_name], _silver_order,
        )
        VIEWS[f"taken{_suffix}_{_name}"] = f"select * exclude (record, rule) from stag{_suffix}_{_name} where rule is null"
    (_key,) = MERGE_KEY[_name]
    VIEWS[f"after_{_name}"] = merged(f"taken1_{_name}", f"taken2_{_name}", (_key,))
    VIEWS[f"did_{_name}"] = f"""select a.{_key}, case when s.{_key} is null then 'keep' when t.{_key} is null then 'insert'
        else 'update' end as action from after_{_name} a left join taken1_{_name} t on a.{_key} = t.{_key}
        left join taken2_{_name} s on a.{_key} = s.{_key}"""

# Gold ------------------------------------------------------------------------------------

_AGE = "datesub('year', birthdate, date '2019-04-30')"
_TENURE = "datesub('year', start_date, date '2019-04-30')"
_DAYS = "datediff('day', baked_date, transaction_date)"
_REMAINING = "(quantity_start_of_day - quantity_sold)"

VIEWS["calendar_bounds"] = _duck(rv.CALENDAR_BOUNDS_SQL)
VIEWS["spine"] = """
    select cast(unnest(generate_series(first_day, last_day, interval 1 day)) as date) as d from calendar_bounds"""
# The fiscal year of a day is the last one whose first Sunday (January 29 to February 4) has come.
VIEWS["fiscal"] = """
    select d, fy, cast(datediff('day', start, d) // 7 + 1 as integer) as week from (
        select d, y as fy, start, row_number() over (partition by d order by start desc) as rn
        from spine cross join (select unnest([0, 1]) as back)
        cross join lateral (select year(d) - back as y)
        cross join lateral (
            select max(c) as start from (
                select unnest(generate_series(make_date(y, 1, 29), make_date(y, 2, 4), interval 1 day)) as c)
            where dayofweek(c) = 0)
        where start <= d)
    where rn = 1"""
VIEWS["calendar"] = """
    with months as (
        select *, case when week > 52 then 4 else (week - 1) // 13 + 1 end as q,
            case when week > 52 then 14 else (week - 1) % 13 + 1 end as wq from fiscal),
    named as (
        select *, case when wq <= 4 then 1 when wq <= 9 then 2 else 3 end as mq,
            (q - 1) * 3 + case when wq <= 4 then 1 when wq <= 9 then 2 else 3 end as m from months)
    select cast(d as varchar) as "Date", cast(fy as varchar) as "FiscalYear", cast(q as varchar) as "FiscalQuarter",
        cast(m as varchar) as "FiscalMonthNumber", cast(mq as varchar) as "FiscalMonthOfQuarter",
        cast(week as varchar) as "FiscalWeekOfYear", cast(dayofweek(d) + 1 as varchar) as "DayOfWeek",
        monthname(make_date(2000, m % 12 + 1, 1)) as "FiscalMonthName",
        monthname(make_date(2000, m % 12 + 1, 1)) || ' ' || fy as "FiscalMonthYear",
        'Q' || q || ' ' || fy as "FiscalQuarterYear",
        cast(day(d) as varchar) as "DayOfMonthNumber", dayname(d) as "DayName", strftime(d, '%Y%m%d') as date_id
    from named"""
VIEWS["dim_customer"] = f"""
    select *, cast({_AGE} as bigint) as age,
        case when {_AGE} between 18 and 25 then '18-25' when {_AGE} between 26 and 35 then '26-35'
            when {_AGE} between 36 and 50 then '36-50' when {_AGE} between 51 and 65 then '51-65'
            else '65+' end as age_category from silver_customer"""
VIEWS["dim_employee"] = f"""
    select cast(staff_id as integer) as staff_id, first_name, last_name, position, start_date,
        cast(location as integer) as store_id, processing_date, first_name || ' ' || last_name as full_name,
        cast({_TENURE} as bigint) as duration,
        case when {_TENURE} in (0, 1) then '0-1yrs' when {_TENURE} in (2, 3) then '1-3yrs'
            when {_TENURE} in (4, 5) then '3-5yrs' when {_TENURE} in (6, 7) then '5-7yrs'
            when {_TENURE} in (8, 9, 10) then '7-10yrs' else '10+ yrs' end as duration_category,
        case when position = 'Store Manager' then 'Y' else 'N' end as is_manager
    from silver_employee"""
VIEWS["dim_product"] = """
    select *, cast(case when r = 0 then null
            else sign(r - w) * floor((2000 * abs(r - w) + r) / (2 * r)) / 1000 end as decimal(15,3)) as gross_margin_pct
    from (select *, cast(current_retail_price * 100 as bigint) as r, cast(current_wholesale_price * 100 as bigint) as w
        from silver_product)"""
VIEWS["dim_product"] = VIEWS["dim_product"].replace("select *, cast(case", "select * exclude (r, w), cast(case", 1)
VIEWS["dim_store"] = """
    select *, store_address || ',' || store_city || ',' || store_state_province || ',' || store_postal_code
        as store_full_address from silver_store"""
VIEWS["fact_inventory"] = f"""
    select *, {_REMAINING} as quantity_remaining, cast({_DAYS} as integer) as days_since_baked,
        case when {_DAYS} > 3 then {_REMAINING} else 0 end as waste_quantity,
        case when quantity_start_of_day > 0 then round(quantity_sold / quantity_start_of_day, 3) else 0.0 end
            as sell_through_rate,
        case when {_DAYS} <= 3 then 'Y' else 'N' end as is_fresh,
        case when {_REMAINING} = 0 then 'Y' else 'N' end as stockout_flag
    from silver_food_inventory"""
VIEWS["fact_sales"] = """
    select *, case when h between 6 and 11 then 'Morning' when h between 12 and 14 then 'Lunch'
            when h between 15 and 17 then 'Afternoon' when h between 18 and 21 then 'Evening' end as time_of_day_category,
        cast(cast(unit_price as decimal(10,2)) * quantity_sold as double) as revenue
    from (select *, hour(try_cast('1970-01-01 ' || transaction_time as timestamp)) as h from silver_sales)"""
VIEWS["fact_sales"] = VIEWS["fact_sales"].replace("select *, case when h", "select * exclude (h), case when h", 1)

STAR = {
    "dim_customer": "customer", "dim_employee": "employee", "fact_inventory": "food_inventory", "dim_product": "product",
    "fact_sales": "sales", "dim_store": "store",
}
for _table, _name in STAR.items():
    VIEWS[f"after_{_table}"] = re.sub(rf"\bsilver_{_name}\b", f"after_{_name}", VIEWS[_table])


def statement(body: str) -> str:
    """``body`` preceded by the relations it needs, directly or through others."""
    needed: list[str] = []

    def visit(text: str) -> None:
        for name in VIEWS:
            if name not in needed and re.search(rf"\b{name}\b", text):
                visit(VIEWS[name])
                if name not in needed:
                    needed.append(name)

    visit(body)
    if not needed:
        return body
    return "with " + ",\n".join(f"{n} as ({VIEWS[n]})" for n in needed) + "\n" + body
