"""Every operator as a query over the base tables: ``QUERIES[name](spark, sf_dir)``."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillstone.functions import casts, enrich, keys, rules
from tillstone.operators import projection, quality
from tillstone.operators.upsert import ACTION, Upsert, merge_metrics, upsert
from tillstone.plans import analytics, bronze, gold, medallion, silver
from tillstone.plans.calendar import calendar_spine, with_date_id
from tillstone.schemas import DATASETS, DIM_STORE, REFERENCES, Dataset
from tillstone.session import new_workspace
from tillstone.sources import landing, readers, retail_views
from tillstone.sources.tables import TableStore, empty_table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

MONTH = "2019-04"
DAY = enrich.REFERENCE_DATE
FIRST_DAY = date.fromisoformat(retail_views.FIRST_DAY)
SECOND_DAY = date.fromisoformat(retail_views.SECOND_DAY)


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def _register(name: str, function: Query) -> None:
    QUERIES[name] = function


# Inputs ----------------------------------------------------------------------------------


def raw(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return retail_views.raw(spark, sf_dir, name)


def standard(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return silver.standardise(raw(spark, sf_dir, name), DATASETS[name], DAY, DAY)


def silver_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The silver table after its first batch."""
    dataset = DATASETS[name]
    return merged_silver(spark, dataset, silver.clean(raw(spark, sf_dir, name), dataset, DAY, DAY))


def merged_silver(spark: SparkSession, dataset: Dataset, batch: DataFrame) -> DataFrame:
    return silver.merge_silver(empty_table(spark, dataset.silver), batch, dataset, DAY)


def gold_table(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """The gold table after its first batch."""
    source = gold.GOLD[table].source
    rows = calendar(spark, sf_dir) if source == "calendar" else silver_table(spark, sf_dir, source)
    return merged_gold(spark, table, rows)


def merged_gold(spark: SparkSession, table: str, rows: DataFrame) -> DataFrame:
    return gold.merge_gold(table, empty_table(spark, gold.GOLD[table].schema), gold.build_gold(table, rows)).to_df()


def calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    return calendar_spine(retail_views.calendar_bounds(spark, sf_dir))


def clean_batches(spark: SparkSession, sf_dir: str, name: str) -> tuple[DataFrame, DataFrame]:
    dataset = DATASETS[name]
    first, second = retail_views.batches(spark, sf_dir, dataset)
    return silver.clean(first, dataset, FIRST_DAY, DAY), silver.clean(second, dataset, SECOND_DAY, DAY)


def landed_batches(spark: SparkSession, sf_dir: str, dataset: Dataset, workspace: str) -> str:
    """Write both batches of a dataset to a landing table; its root."""
    root = f"{workspace}/landing"
    batches = retail_views.batches(spark, sf_dir, dataset, f"{workspace}/extract/{dataset.file_stem}")
    for rows, day in zip(batches, (FIRST_DAY, SECOND_DAY), strict=True):
        stamped = landing.stamp_processing_date(rows, day)
        landing.write_partitioned(stamped, f"{root}/{dataset.file_stem}", dataset.landing_files)
    return root


def run_lake(
    spark: SparkSession, sf_dir: str, names=tuple(DATASETS), layers: int = 2, references: bool = False
) -> list[medallion.Batch]:
    """Both batches of the named datasets from landing into bronze, silver and (``layers`` 3) gold of a fresh lake."""
    workspace = new_workspace(spark, "lake")
    batches = [medallion.Batch(f"{workspace}/raw", workspace, str(day)[:7], day, DAY) for day in (FIRST_DAY, SECOND_DAY)]
    for name in names:
        landed_batches(spark, sf_dir, DATASETS[name], workspace)
    for batch in batches:
        for layer in ("bronze", "silver", "gold"):
            batch.store(spark, layer)
            batch.quality(spark, layer)

        def load(dataset: Dataset, batch: medallion.Batch = batch) -> dict[str, dict[str, int]]:
            if layers == 3:
                return medallion.load_dataset(spark, batch, dataset)
            bronze.load_bronze(spark, batch.store(spark, "bronze"), batch.landing_root, dataset, batch.processing_date, DAY)
            return {dataset.silver_table: medallion.load_silver(spark, batch, dataset)}

        medallion.each_dataset(spark, names, load)
        if references:
            medallion.check_references(spark, batch, names)
    return batches


def extract(spark: SparkSession, sf_dir: str, dataset: Dataset, workspace: str) -> str:
    """Write the raw extract of a dataset as CSV; the raw root."""
    root = f"{workspace}/raw"
    retail_views.export_extract(raw(spark, sf_dir, dataset.name), readers.batch_path(root, MONTH, dataset))
    return root


# Sources, sinks and ingest ---------------------------------------------------------------


@query
def scan_csv_strings(spark, sf_dir):
    root = extract(spark, sf_dir, DATASETS["customer"], new_workspace(spark, "scan-csv"))
    return readers.scan_csv_strings(spark, readers.batch_path(root, MONTH, DATASETS["customer"]))


@query
def batch_path_scan(spark, sf_dir):
    root = extract(spark, sf_dir, DATASETS["product"], new_workspace(spark, "batch-path"))
    return readers.scan_batch(spark, root, MONTH, DATASETS["product"])


@query
def scan_delivered(spark, sf_dir):
    """An extract with a header of its own, lines with a field too many, and one that no contract knows.

    The first is landed under the names of the contract, the lines go to the reject log of bronze, the last is refused.
    """
    dataset = DATASETS["customer"]
    workspace = new_workspace(spark, "delivered")
    batch = medallion.Batch(f"{workspace}/raw", workspace, MONTH, DAY, DAY)
    rows = raw(spark, sf_dir, "customer")
    broken = F.when(F.col("loyalty_card_number").isNull(), F.lit("no,card")).otherwise(F.col("loyalty_card_number"))
    headed = rows.withColumn("loyalty_card_number", broken).withColumnRenamed("customer_first_name", "Customer_First-Name")
    retail_views.export_extract(headed, readers.batch_path(batch.raw_root, MONTH, dataset), quote="")
    landing.land_batch(spark, batch.raw_root, batch.landing_root, dataset, MONTH, DAY)
    bronze.load_bronze(spark, batch.store(spark, "bronze"), batch.landing_root, dataset, DAY, DAY)
    lines = batch.quality(spark, "bronze").rejects("customer", bronze.rejects_schema(dataset)).filter("rule = 'malformed'")
    strange = rows.withColumnRenamed("gender", "sex")
    retail_views.export_extract(strange, readers.batch_path(f"{workspace}/strange", MONTH, dataset))
    try:
        readers.scan_delivered(spark, f"{workspace}/strange", MONTH, dataset)
        refused = False
    except readers.HeaderMismatch:
        refused = True
    landed = readers.scan_landing(spark, batch.landing_root, dataset).select("customer_id", "customer_first_name")
    told = landed.withColumn("kind", F.lit("landed")).unionByName(lines.select("customer_id", "customer_first_name", F.lit("malformed").alias("kind")))
    return told.withColumn("unknown_refused", F.lit(refused))


@query
def scan_calendar_csv(spark, sf_dir):
    path = f"{new_workspace(spark, 'calendar')}/calendar.csv"
    retail_views.export_extract(calendar(spark, sf_dir).drop("date_id"), path)
    return with_date_id(readers.scan_calendar_csv(spark, path))


@query
def scan_parquet_schema(spark, sf_dir):
    path = f"{new_workspace(spark, 'parquet-schema')}/store"
    delivered = raw(spark, sf_dir, "store").withColumnRenamed("neighorhood", "Neighorhood").drop("store_type")
    delivered.write.parquet(path)
    return readers.scan_parquet_schema(spark, path, DATASETS["store"].raw_schema)


@query
def scan_one_partition(spark, sf_dir):
    dataset = DATASETS["food_inventory"]
    root = landed_batches(spark, sf_dir, dataset, new_workspace(spark, "one-partition"))
    return readers.scan_one_partition(spark, root, dataset, SECOND_DAY)


@query
def scan_table_incremental(spark, sf_dir):
    dataset = DATASETS["employee"]
    store = bronze_store(spark, sf_dir, dataset)
    return store.read_incremental(dataset.bronze_table, bronze.bronze_schema(dataset), SECOND_DAY)


@query
def scan_months_incremental(spark, sf_dir):
    """The second batch out of a table of many months; only the months it changed are opened."""
    dataset = DATASETS["food_inventory"]
    store = bronze_store(spark, sf_dir, dataset)
    return store.read_incremental(dataset.bronze_table, bronze.bronze_schema(dataset), SECOND_DAY)


@query
def write_partitioned_append(spark, sf_dir):
    """Two batches in, the second one twice: the rerun replaces its own partition."""
    dataset = DATASETS["sales"]
    workspace = new_workspace(spark, "landing-write")
    root = landed_batches(spark, sf_dir, dataset, workspace)
    again = landing.stamp_processing_date(retail_views.batches(spark, sf_dir, dataset)[1], SECOND_DAY)
    landing.write_partitioned(again, f"{root}/{dataset.file_stem}")
    return readers.scan_landing(spark, root, dataset)


@query
def write_single_file(spark, sf_dir):
    dataset = DATASETS["store"]
    root = landed_batches(spark, sf_dir, dataset, new_workspace(spark, "single-file"))
    return (
        readers.scan_landing(spark, root, dataset)
        .select("processing_date", F.col("_metadata.file_path").alias("file"))
        .groupBy("processing_date")
        .agg(F.count_distinct("file").alias("files"), F.count(F.lit(1)).alias("n_rows"))
    )


@query
def create_table_if_missing(spark, sf_dir):
    dataset = DATASETS["store"]
    store = TableStore(spark, new_workspace(spark, "ensure-table"))
    created = [store.ensure_table(dataset.silver_table, dataset.silver) for _ in range(2)]
    batch = silver.clean(raw(spark, sf_dir, "store"), dataset, DAY, DAY)
    store.upsert(dataset.silver_table, dataset.silver, batch, dataset.silver_key)
    rows = store.read(dataset.silver_table, dataset.silver)
    return rows.withColumns({"created_first": F.lit(created[0]), "created_again": F.lit(created[1])})


@query
def register_view(spark, sf_dir):
    raw(spark, sf_dir, "employee").createOrReplaceTempView("employee_new_data")
    return spark.sql("select trim(position) as position, count(*) as n from employee_new_data group by trim(position)")


@query
def nonempty_guard(spark, sf_dir):
    """An extract with rows is landed, one with only a header is not."""
    workspace = new_workspace(spark, "guard")
    root = extract(spark, sf_dir, DATASETS["product"], workspace)
    nobody = raw(spark, sf_dir, "employee").filter("location is null")
    retail_views.export_extract(nobody, readers.batch_path(root, MONTH, DATASETS["employee"]))
    landed = landing.ingest_batch_all(spark, root, f"{workspace}/landing", MONTH, DAY, ("employee", "product"))
    loaded = readers.scan_landing(spark, f"{workspace}/landing", DATASETS["product"])
    return loaded.agg(F.count(F.lit(1)).alias("product_rows")).withColumns(
        {f"{name}_landed": F.lit(done) for name, done in landed.items()}
    )


@query
def stamp_processing_date(spark, sf_dir):
    return landing.stamp_processing_date(raw(spark, sf_dir, "store"), DAY)


@query
def ingest_batch_all(spark, sf_dir):
    """All six extracts through one parameterised run; rows landed per dataset."""
    workspace = new_workspace(spark, "ingest-all")
    for dataset in DATASETS.values():
        extract(spark, sf_dir, dataset, workspace)
    root = f"{workspace}/landing"
    landing.ingest_batch_all(spark, f"{workspace}/raw", root, MONTH, DAY)
    counts = [
        readers.scan_landing(spark, root, d)
        .groupBy(F.lit(d.name).alias("dataset"), "processing_date")
        .agg(F.count(F.lit(1)).alias("n_rows"))
        for d in DATASETS.values()
    ]
    return _union(counts)


def _union(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame)
    return out


# Projection and casts --------------------------------------------------------------------


@query
def project_contract(spark, sf_dir):
    enriched = gold.enrich_store(silver_table(spark, sf_dir, "store")).withColumn("note", F.lit("not in the contract"))
    return projection.project_contract(enriched.select(*reversed(enriched.columns)), DIM_STORE)


@query
def lowercase_headers(spark, sf_dir):
    delivered = raw(spark, sf_dir, "store")
    return projection.lowercase_headers(delivered.toDF(*[c.upper() for c in delivered.columns]))


@query
def rename_columns(spark, sf_dir):
    delivered = raw(spark, sf_dir, "customer").withColumnRenamed("customer_first_name", "customer_first-name")
    names = {"customer_first-name": "customer_first_name", "home_store": "store_id"}
    return projection.rename_columns(delivered, names)


@query
def drop_helper_columns(spark, sf_dir):
    helped = raw(spark, sf_dir, "product").withColumn("product_id_dq", enrich.yes_no(F.col("product_id").isNotNull()))
    return projection.drop_helper_columns(helped, "product_id_dq", "unit_of_measure")


@query
def cast_int(spark, sf_dir):
    columns = ("store_id", "product_id", "quantity_start_of_day", "quantity_sold")
    return raw(spark, sf_dir, "food_inventory").select(*[casts.cast_int(F.col(c)).alias(c) for c in columns])


@query
def cast_decimal(spark, sf_dir):
    columns = ("current_cost", "current_wholesale_price", "current_retail_price")
    return raw(spark, sf_dir, "product").select(
        "product_id", *[casts.cast_decimal(F.col(c)).alias(c) for c in columns]
    )


@query
def cast_string(spark, sf_dir):
    ids = raw(spark, sf_dir, "employee").select(*[casts.cast_int(F.col(c)).alias(c) for c in ("staff_id", "location")])
    return ids.select(*[casts.cast_string(F.col(c)).alias(c) for c in ids.columns])


@query
def cast_double(spark, sf_dir):
    return raw(spark, sf_dir, "product").select(
        "product_id",
        casts.cast_double(F.regexp_extract("unit_of_measure", r"([\d.]+)", 1)).alias("uom_value"),
        casts.cast_double(F.col("current_retail_price")).alias("current_retail_price"),
    )


@query
def cast_to_contract(spark, sf_dir):
    return casts.apply_schema(raw(spark, sf_dir, "customer"), DATASETS["customer"].typed)


# Data quality ----------------------------------------------------------------------------


@query
def dedup_keys(spark, sf_dir):
    dataset = DATASETS["customer"]
    return quality.keep_one(standard(spark, sf_dir, "customer"), dataset.dedup_key)


@query
def require_pk(spark, sf_dir):
    return quality.require_not_null(raw(spark, sf_dir, "customer"), DATASETS["customer"].mandatory)


@query
def require_all_not_null(spark, sf_dir):
    return quality.require_not_null(raw(spark, sf_dir, "sales"), DATASETS["sales"].mandatory)


@query
def trim_all(spark, sf_dir):
    return projection.trim_all(raw(spark, sf_dir, "customer"))


@query
def title_case(spark, sf_dir):
    return raw(spark, sf_dir, "employee").select(
        "staff_id", *[rules.title_case(F.col(c)).alias(c) for c in DATASETS["employee"].title_columns]
    )


@query
def validate_email(spark, sf_dir):
    return raw(spark, sf_dir, "customer").select(
        "customer_id", "customer_email", rules.validate_email(F.col("customer_email")).alias("valid_email")
    )


@query
def normalise_date(spark, sf_dir):
    return raw(spark, sf_dir, "customer").select(
        "customer_id", *[rules.normalise_date(F.col(c)).alias(c) for c in ("customer_since", "birthdate")]
    )


@query
def bound_date(spark, sf_dir):
    return raw(spark, sf_dir, "customer").select(
        "customer_id",
        *[rules.clean_date(F.col(c), F.lit(DAY)).alias(c) for c in ("customer_since", "birthdate")],
    )


@query
def standardise_gender(spark, sf_dir):
    return raw(spark, sf_dir, "customer").select(
        "customer_id", "gender", rules.standardise_gender(F.col("gender")).alias("standard_gender")
    )


@query
def standardise_flag(spark, sf_dir):
    return raw(spark, sf_dir, "product").select(
        "product_id", *[rules.standardise_flag(F.col(c)).alias(c) for c in DATASETS["product"].flag_columns]
    )


@query
def parse_uom(spark, sf_dir):
    unit = F.trim("unit_of_measure")
    return raw(spark, sf_dir, "product").select(
        "product_id",
        rules.uom_value(unit).alias("uom_value"),
        rules.uom_class(unit).alias("product_original_uom"),
    )


@query
def uom_to_lb(spark, sf_dir):
    unit = F.trim("unit_of_measure")
    return raw(spark, sf_dir, "product").select(
        "product_id", rules.uom_to_lb(rules.uom_class(unit), rules.uom_value(unit)).alias("product_lb")
    )


@query
def dq_audit(spark, sf_dir):
    return _union(
        [
            quality.dq_audit(standard(spark, sf_dir, d.name), d.name, d.mandatory, d.silver_key)
            for d in DATASETS.values()
        ]
    )


@query
def check_referential_integrity(spark, sf_dir):
    """Keys of employees, sales and inventory that their dimension does not have.

    Keys are compared as silver reads them; text it cannot read is reported as delivered, blank text is no key.
    """
    keys_of = {"store": "store_id", "product": "product_id", "customer": "customer_id", "employee": "staff_id"}
    dims = {
        name: standard(spark, sf_dir, name).select(keys.reference_key(F.col(key).cast("string")).alias(key)).distinct()
        for name, key in keys_of.items()
    }
    found = []
    for child, parents in REFERENCES.items():
        rows = raw(spark, sf_dir, child).select(*[keys.reference_key(F.col(key)).alias(key) for key in parents])
        references = [
            (key, dims[parent], parent_key, f"{child}.{key} -> {parent}") for key, (parent, parent_key) in parents.items()
        ]
        found.append(quality.orphan_keys(rows, references))
    return _union(found)


@query
def run_orphans(spark, sf_dir):
    """Keys without a parent in each of two batches of all datasets, as their runs have logged them."""
    return medallion.orphans_of_runs(spark, run_lake(spark, sf_dir, references=True)[-1])


@query
def orphans(spark, sf_dir):
    """Employees at a location that is no store."""
    return quality.orphans(silver_table(spark, sf_dir, "employee"), silver_table(spark, sf_dir, "store"), "location", "store_id")


@query
def with_parent(spark, sf_dir):
    """Sales of an employee that the staff list has."""
    staff = silver_table(spark, sf_dir, "employee").withColumn("staff_id", F.col("staff_id").cast("int"))
    return quality.with_parent(silver_table(spark, sf_dir, "sales"), staff, "staff_id", "staff_id")


@query
def strip_special_chars(spark, sf_dir):
    return raw(spark, sf_dir, "customer").select(
        "customer_id", rules.strip_special_chars(F.col("customer_first_name")).alias("customer_first_name")
    )


def _rejects(batch: medallion.Batch, spark: SparkSession, dataset: Dataset, layer: str) -> DataFrame:
    """The rejects of a dataset in a layer, told by the delivered text of their keys and mandatory columns."""
    log = batch.quality(spark, layer)
    if layer == "bronze":
        rows, of = log.rejects(dataset.name, bronze.rejects_schema(dataset)), "`{}`"
    else:
        rows, of = log.rejects(dataset.name, silver.delivered_schema(dataset)), "delivered.`{}`"
    told = [F.coalesce(F.col(of.format(c)), F.lit("<null>")) for c in dataset.identity]
    rows = rows.select("processing_date", "rule", F.concat_ws("|", *told).alias("record"))
    counted = rows.groupBy("processing_date", "rule", "record").agg(F.count(F.lit(1)).alias("copies"))
    return counted.withColumns({"dataset": F.lit(dataset.name), "layer": F.lit(layer)})


@query
def reject_log(spark, sf_dir):
    """Every row that two batches of all datasets lost in bronze or silver, with the rule it failed."""
    last = run_lake(spark, sf_dir)[-1]
    return _union([_rejects(last, spark, d, layer) for d in DATASETS.values() for layer in ("bronze", "silver")])


@query
def run_audit(spark, sf_dir):
    """Rows in, out and dropped by rule, of two batches of all datasets, as their runs have observed them."""
    last = run_lake(spark, sf_dir)[-1]
    layers = [last.quality(spark, layer).audit().withColumn("layer", F.lit(layer)) for layer in ("bronze", "silver")]
    return _union(layers).drop("load", "committed_at")


# Keys ------------------------------------------------------------------------------------


@query
def sales_key(spark, sf_dir):
    rows = standard(spark, sf_dir, "sales")
    return rows.select(*keys.SALES_KEY_COLUMNS, "sales_key", keys.sales_key(null_token="?").alias("safe_sales_key"))


@query
def inventory_id(spark, sf_dir):
    rows = standard(spark, sf_dir, "food_inventory")
    return rows.select(*keys.INVENTORY_KEY_COLUMNS, "inventory_id")


@query
def date_id(spark, sf_dir):
    rows = standard(spark, sf_dir, "food_inventory")
    return rows.select("baked_date", "baked_date_id", "transaction_date", "transaction_date_id")


@query
def key_uniqueness_audit(spark, sf_dir):
    return quality.repeated_keys(standard(spark, sf_dir, "sales"), keys.SALES_KEY_COLUMNS)


# Upserts ---------------------------------------------------------------------------------


@query
def upsert_single_key(spark, sf_dir):
    first, second = clean_batches(spark, sf_dir, "customer")
    return upsert(first, second, ("customer_id",))


@query
def upsert_composite_key(spark, sf_dir):
    dataset = DATASETS["food_inventory"]
    first, second = (b.drop("inventory_id") for b in clean_batches(spark, sf_dir, "food_inventory"))
    return upsert(first, second, dataset.natural_key)


@query
def upsert_surrogate_key(spark, sf_dir):
    first, second = clean_batches(spark, sf_dir, "sales")
    return silver.merge_silver(first, second, DATASETS["sales"], SECOND_DAY)


@query
def upsert_builder(spark, sf_dir):
    """Explicit column maps: a known store takes the new address fields, a new one all but its manager."""
    first, second = clean_batches(spark, sf_dir, "store")
    inserted = {c: f"source.{c}" for c in first.columns if c != "manager"}
    updated = {
        "store_type": "source.store_type",
        "store_address": "concat(source.store_address, ' (', target.store_city, ')')",
        "processing_date": "source.processing_date",
    }
    return (
        Upsert(first)
        .using(second)
        .on("store_id")
        .when_matched_update(updated)
        .when_not_matched_insert(inserted)
        .to_df()
    )


@query
def upsert_column_subset(spark, sf_dir):
    first, second = clean_batches(spark, sf_dir, "food_inventory")
    return upsert(first, second, ("inventory_id",), update_cols=("quantity_sold", "processing_date"))


@query
def upsert_restamp(spark, sf_dir):
    first, second = clean_batches(spark, sf_dir, "product")
    return upsert(first, second, ("product_id",), overrides={"processing_date": F.lit(date(2019, 5, 31))})


@query
def merge_metrics_query(spark, sf_dir):
    first, second = clean_batches(spark, sf_dir, "sales")
    return merge_metrics(upsert(first, second, ("sales_key",), duplicates="unique", with_actions=True))


QUERIES["merge_metrics"] = QUERIES.pop("merge_metrics_query")


@query
def merge_history(spark, sf_dir):
    """The merges a table went through, from its log."""
    dataset = DATASETS["food_inventory"]
    store = bronze_store(spark, sf_dir, dataset)
    return store.history(dataset.bronze_table).drop("committed_at")


# Business columns ------------------------------------------------------------------------


def _enriched(name: str, dataset: str, enrich_rows, *columns: str) -> None:
    _register(name, lambda spark, sf_dir: enrich_rows(silver_table(spark, sf_dir, dataset)).select(*columns))


_enriched("age", "customer", gold.enrich_customer, "customer_id", "birthdate", "age")
_enriched("age_category", "customer", gold.enrich_customer, "customer_id", "age", "age_category")
_enriched("full_name", "employee", gold.enrich_employee, "staff_id", "full_name")
_enriched("tenure_years", "employee", gold.enrich_employee, "staff_id", "start_date", "duration")
_enriched("tenure_band", "employee", gold.enrich_employee, "staff_id", "duration", "duration_category")
_enriched("is_manager", "employee", gold.enrich_employee, "staff_id", "position", "is_manager")
_enriched("quantity_remaining", "food_inventory", gold.enrich_inventory, "inventory_id", "quantity_remaining")
_enriched("days_since_baked", "food_inventory", gold.enrich_inventory, "inventory_id", "days_since_baked")
_enriched("waste_quantity", "food_inventory", gold.enrich_inventory, "inventory_id", "waste_quantity")
_enriched("sell_through_rate", "food_inventory", gold.enrich_inventory, "inventory_id", "sell_through_rate")
_enriched("is_fresh", "food_inventory", gold.enrich_inventory, "inventory_id", "is_fresh")
_enriched("stockout_flag", "food_inventory", gold.enrich_inventory, "inventory_id", "stockout_flag")
_enriched("gross_margin_pct", "product", gold.enrich_product, "product_id", "gross_margin_pct")
_enriched("time_of_day_category", "sales", gold.enrich_sales, "sales_key", "transaction_time", "time_of_day_category")
_enriched("revenue", "sales", gold.enrich_sales, "sales_key", "unit_price", "quantity_sold", "revenue")
_enriched("store_full_address", "store", gold.enrich_store, "store_id", "store_full_address")


# Layers ----------------------------------------------------------------------------------


def landing_table(spark: SparkSession, sf_dir: str, dataset: Dataset) -> DataFrame:
    """The extract as CSV, through ingest, read back from landing."""
    workspace = new_workspace(spark, f"landing-{dataset.name}")
    root = extract(spark, sf_dir, dataset, workspace)
    landing.land_batch(spark, root, f"{workspace}/landing", dataset, MONTH, DAY)
    return readers.scan_landing(spark, f"{workspace}/landing", dataset)


def bronze_store(spark: SparkSession, sf_dir: str, dataset: Dataset) -> TableStore:
    """Two landed batches merged into the bronze table of a fresh store."""
    workspace = new_workspace(spark, f"bronze-{dataset.name}")
    root = landed_batches(spark, sf_dir, dataset, workspace)
    store = TableStore(spark, f"{workspace}/bronze")
    for day in (FIRST_DAY, SECOND_DAY):
        bronze.load_bronze(spark, store, root, dataset, day, DAY)
    return store


def bronze_table(spark: SparkSession, sf_dir: str, dataset: Dataset) -> DataFrame:
    return bronze_store(spark, sf_dir, dataset).read(dataset.bronze_table, bronze.bronze_schema(dataset))


def _layers(dataset: Dataset) -> None:
    short = "inventory" if dataset.name == "food_inventory" else dataset.name
    _register(f"landing_{short}", lambda spark, sf_dir: landing_table(spark, sf_dir, dataset))
    _register(f"bronze_{short}", lambda spark, sf_dir: bronze_table(spark, sf_dir, dataset))
    _register(f"silver_{short}", lambda spark, sf_dir: silver_table(spark, sf_dir, dataset.name))


for _dataset in DATASETS.values():
    _layers(_dataset)


def _gold(table: str) -> None:
    _register(table, lambda spark, sf_dir: gold_table(spark, sf_dir, table))


for _table in gold.GOLD:
    _gold(_table)


# Second batches: the tables as the load path leaves them, and what the second merge did with each row.


def _second(name: str, dataset: Dataset, table: str, schema, layer: str) -> None:
    def rows(spark: SparkSession, sf_dir: str) -> DataFrame:
        last = run_lake(spark, sf_dir, (dataset.name,), 3 if layer == "gold" else 2)[-1]
        return last.store(spark, layer).read_with_actions(table, schema).withColumnRenamed(ACTION, "action")

    _register(f"{name}_second_batch", rows)


for _dataset in DATASETS.values():
    _short = "inventory" if _dataset.name == "food_inventory" else _dataset.name
    _second(f"silver_{_short}", _dataset, _dataset.silver_table, _dataset.silver, "silver")
for _table, _gold_table in gold.GOLD.items():
    if _gold_table.source in DATASETS:
        _second(_table, DATASETS[_gold_table.source], _table, _gold_table.schema, "gold")


def _second_calendar(table: str) -> None:
    def rows(spark: SparkSession, sf_dir: str) -> DataFrame:
        batches = run_lake(spark, sf_dir, ())
        for batch in batches:
            medallion.load_calendars(spark, batch, calendar(spark, sf_dir))
        stored = batches[-1].store(spark, "gold").read_with_actions(table, gold.GOLD[table].schema)
        return stored.withColumnRenamed(ACTION, "action")

    _register(f"{table}_second_batch", rows)


for _table in ("baked_calendar", "transaction_calendar"):
    _second_calendar(_table)


@query
def gold_merge_metrics(spark, sf_dir):
    """Inserted, updated and deleted rows of both merges into each table of the star."""
    batches = run_lake(spark, sf_dir, layers=3)
    for batch in batches:
        medallion.load_calendars(spark, batch, calendar(spark, sf_dir))
    store = batches[-1].store(spark, "gold")
    return _union([store.history(table) for table in gold.GOLD]).filter("operation = 'MERGE'").drop("operation", "committed_at")


@query
def date_spine_454(spark, sf_dir):
    return calendar(spark, sf_dir)


# Analyses --------------------------------------------------------------------------------


def _analysis(name: str, answer, *tables: str) -> None:
    _register(name, lambda spark, sf_dir: answer(*[gold_table(spark, sf_dir, t) for t in tables]))


@query
def sales_star(spark, sf_dir):
    """Columns of a sale that follow from its others are not moved to its copies or the dimensions, they are set afterwards."""
    dimensions = (gold_table(spark, sf_dir, t) for t in ("dim_product", "dim_customer", "dim_employee", "transaction_calendar"))
    batch = silver.clean_sales_by_text(raw(spark, sf_dir, "sales"), DAY, DAY)
    fact = merged_gold(spark, "fact_sales", merged_silver(spark, DATASETS["sales"], batch))
    derived = ("sales_key", "transaction_date_id", "time_of_day_category", "revenue")
    star = analytics.sales_star(fact.drop(*derived), *dimensions)
    first = [c for c in star.columns if c not in fact.columns or c in ("transaction_date_id", "staff_id", "customer_id")]
    whole = gold.enrich_sales(star.withColumn("sales_key", keys.sales_key()))
    return whole.select(*first[:3], *[f"`{c}`" for c in fact.columns if c not in first], *first[3:])


_analysis("inventory_star", analytics.inventory_star, "fact_inventory", "dim_product", "dim_store", "baked_calendar")
_analysis("revenue_by_period", analytics.revenue_by_period, "fact_sales", "transaction_calendar")
_analysis("revenue_by_level", analytics.revenue_by_level, "fact_sales", "transaction_calendar")
_analysis("transaction_volume", analytics.transaction_volume, "fact_sales")
_analysis("product_mix", analytics.product_mix, "fact_sales", "dim_product")
_analysis("customer_demographics", analytics.customer_demographics, "fact_sales", "dim_customer")
_analysis("time_of_day_pattern", analytics.time_of_day_pattern, "fact_sales")
_analysis("daily_stock_levels", analytics.daily_stock_levels, "fact_inventory")
_analysis("sell_through_rollup", analytics.sell_through_rollup, "fact_inventory")
_analysis("waste_by_store_product", analytics.waste_by_store_product, "fact_inventory")
_analysis("stockout_events", analytics.stockout_events, "fact_inventory")
_analysis("top_products_selling_out", analytics.top_products_selling_out, "fact_inventory")
_analysis("loyalty_engagement", analytics.loyalty_engagement, "fact_sales", "dim_customer")
_analysis("staff_sales_performance", analytics.staff_sales_performance, "fact_sales", "dim_employee")
