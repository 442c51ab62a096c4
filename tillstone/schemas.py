"""Column contracts of every layer and the per-dataset configuration.

Names, order and types are fixed values: they are the public schema that
downstream reports rely on (including the spelling ``neighorhood``).
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

_TYPES = {
    "int": T.IntegerType(),
    "bigint": T.LongType(),
    "double": T.DoubleType(),
    "date": T.DateType(),
    "string": T.StringType(),
    "decimal(10,2)": T.DecimalType(10, 2),
    "decimal(15,3)": T.DecimalType(15, 3),
}


def schema_of(spec: str) -> T.StructType:
    """Schema from lines of ``name type``."""
    pairs = (line.split() for line in spec.strip().splitlines())
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])


# Typed contract of each source dataset -------------------------------------

CUSTOMER = schema_of("""
    customer_id int
    home_store int
    customer_first_name string
    customer_email string
    customer_since date
    loyalty_card_number string
    birthdate date
    gender string
    birth_year string
    processing_date date
""")

EMPLOYEE = schema_of("""
    staff_id int
    first_name string
    last_name string
    position string
    start_date date
    location int
    processing_date date
""")

INVENTORY = schema_of("""
    store_id int
    baked_date date
    transaction_date date
    product_id int
    quantity_start_of_day int
    quantity_sold int
    processing_date date
""")

PRODUCT = schema_of("""
    product_id string
    product_group string
    product_category string
    product_type string
    product string
    product_description string
    unit_of_measure string
    current_cost double
    current_wholesale_price double
    current_retail_price double
    tax_exempt_yn string
    promo_yn string
    new_product_yn string
    processing_date date
""")

SALES = schema_of("""
    transaction_id int
    transaction_date date
    transaction_time string
    store_id int
    staff_id int
    customer_id int
    instore_yn string
    order int
    line_item_id int
    product_id int
    quantity_sold int
    unit_price double
    promo_item_yn string
    processing_date date
""")

STORE = schema_of("""
    store_id int
    store_type string
    store_square_feet int
    store_address string
    store_city string
    store_state_province string
    store_postal_code int
    store_longitude double
    store_latitude double
    manager double
    neighorhood string
    processing_date date
""")

CALENDAR_COLUMNS = (
    "Date",
    "FiscalYear",
    "FiscalQuarter",
    "FiscalMonthNumber",
    "FiscalMonthOfQuarter",
    "FiscalWeekOfYear",
    "DayOfWeek",
    "FiscalMonthName",
    "FiscalMonthYear",
    "FiscalQuarterYear",
    "DayOfMonthNumber",
    "DayName",
)

# Silver contracts ----------------------------------------------------------

SILVER_EMPLOYEE = schema_of("""
    staff_id string
    first_name string
    last_name string
    position string
    start_date date
    location string
    processing_date date
""")

SILVER_INVENTORY = T.StructType(
    INVENTORY.fields
    + schema_of("""
    baked_date_id string
    transaction_date_id string
    inventory_id string
""").fields
)

SILVER_PRODUCT = schema_of("""
    product_id string
    product_group string
    product_category string
    product_type string
    product string
    product_description string
    current_cost decimal(10,2)
    current_wholesale_price decimal(10,2)
    current_retail_price decimal(10,2)
    tax_exempt_yn string
    promo_yn string
    new_product_yn string
    processing_date date
    product_original_uom string
    product_lb double
""")

SILVER_SALES = T.StructType(
    SALES.fields
    + schema_of("""
    sales_key string
    transaction_date_id string
""").fields
)

# Gold contracts ------------------------------------------------------------

DIM_CUSTOMER = T.StructType(
    CUSTOMER.fields
    + schema_of("""
    age bigint
    age_category string
""").fields
)

DIM_EMPLOYEE = schema_of("""
    staff_id int
    first_name string
    last_name string
    position string
    start_date date
    store_id int
    processing_date date
    full_name string
    duration bigint
    duration_category string
    is_manager string
""")

FACT_INVENTORY = T.StructType(
    SILVER_INVENTORY.fields
    + schema_of("""
    quantity_remaining int
    days_since_baked int
    waste_quantity int
    sell_through_rate double
    is_fresh string
    stockout_flag string
""").fields
)

DIM_PRODUCT = T.StructType(SILVER_PRODUCT.fields + schema_of("gross_margin_pct decimal(15,3)").fields)

FACT_SALES = T.StructType(
    SILVER_SALES.fields
    + schema_of("""
    time_of_day_category string
    revenue double
""").fields
)

DIM_STORE = T.StructType(STORE.fields + schema_of("store_full_address string").fields)

CALENDAR = T.StructType([T.StructField(c, T.StringType()) for c in (*CALENDAR_COLUMNS, "date_id")])


@dataclass(frozen=True)
class Dataset:
    """What differs between the six sources; every step reads it from here."""

    name: str
    file_stem: str
    typed: T.StructType
    silver: T.StructType
    natural_key: tuple[str, ...]
    silver_key: tuple[str, ...]
    mandatory: tuple[str, ...]
    dedup_key: tuple[str, ...]
    latest_by: tuple[str, ...] = ()
    title_columns: tuple[str, ...] = ()
    date_columns: tuple[str, ...] = ()
    flag_columns: tuple[str, ...] = ()
    event_date: str | None = None
    landing_files: int | None = None
    #: Headers of extracts that differ from the contract by more than case.
    header_names: dict[str, str] = field(default_factory=dict)

    @property
    def raw_columns(self) -> list[str]:
        return [f.name for f in self.typed if f.name != "processing_date"]

    @property
    def raw_schema(self) -> T.StructType:
        return T.StructType([T.StructField(c, T.StringType()) for c in self.raw_columns])

    @property
    def identity(self) -> list[str]:
        """The columns by which a delivered row is told from others: its key and what it must have."""
        return list(dict.fromkeys((*self.natural_key, *self.mandatory)))

    @property
    def bronze_table(self) -> str:
        return f"{self.name}_bronze"

    @property
    def silver_table(self) -> str:
        return "inventory_silver" if self.name == "food_inventory" else f"{self.name}_silver"


DATASETS = {
    d.name: d
    for d in (
        Dataset(
            "customer", "customer_lookup", CUSTOMER, CUSTOMER,
            natural_key=("customer_id",), silver_key=("customer_id",), mandatory=("customer_id",),
            dedup_key=("customer_id", "customer_since", "birthdate"),
            latest_by=("customer_since", "birthdate"),
            title_columns=("customer_first_name", "customer_email"),
            date_columns=("customer_since", "birthdate"),
            header_names={"customer_first-name": "customer_first_name"},
        ),
        Dataset(
            "employee", "employee_lookup", EMPLOYEE, SILVER_EMPLOYEE,
            natural_key=("staff_id",), silver_key=("staff_id",), mandatory=("staff_id",),
            dedup_key=("staff_id", "start_date"), latest_by=("start_date",),
            title_columns=("first_name", "last_name", "position"), date_columns=("start_date",),
        ),
        Dataset(
            "food_inventory", "food_inventory", INVENTORY, SILVER_INVENTORY,
            natural_key=("store_id", "product_id", "baked_date", "transaction_date"),
            silver_key=("inventory_id",),
            mandatory=("store_id", "product_id", "baked_date", "transaction_date"),
            dedup_key=("store_id", "product_id", "baked_date", "transaction_date"),
            date_columns=("baked_date", "transaction_date"), event_date="transaction_date",
        ),
        Dataset(
            "product", "product_lookup", PRODUCT, SILVER_PRODUCT,
            natural_key=("product_id",), silver_key=("product_id",), mandatory=("product_id",),
            dedup_key=("product_id",), flag_columns=("tax_exempt_yn", "promo_yn", "new_product_yn"),
        ),
        Dataset(
            "sales", "sales_by_store", SALES, SILVER_SALES,
            natural_key=("transaction_id", "transaction_date", "transaction_time", "order", "line_item_id"),
            silver_key=("sales_key",),
            mandatory=(
                "transaction_id", "product_id", "customer_id", "store_id", "staff_id",
                "transaction_date", "transaction_time",
            ),
            dedup_key=("transaction_id", "transaction_date", "transaction_time", "order", "line_item_id"),
            date_columns=("transaction_date",), flag_columns=("instore_yn", "promo_item_yn"),
            event_date="transaction_date",
        ),
        Dataset(
            "store", "store_lookup", STORE, STORE,
            natural_key=("store_id",), silver_key=("store_id",), mandatory=("store_id",),
            dedup_key=("store_id",), landing_files=1,
        ),
    )
}

#: Which columns of a dataset name a row of another one: (dataset, key) by child and column.
REFERENCES = {
    "employee": {"location": ("store", "store_id")},
    "sales": {
        "product_id": ("product", "product_id"),
        "customer_id": ("customer", "customer_id"),
        "staff_id": ("employee", "staff_id"),
        "store_id": ("store", "store_id"),
    },
    "food_inventory": {"product_id": ("product", "product_id"), "store_id": ("store", "store_id")},
}
