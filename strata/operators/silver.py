"""Bronze -> Silver for the three feeds (sales, order events new/legacy, shipments)."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.functions.dates import parse_date_robust, parse_iso_timestamp
from strata.functions.text import clean_columns, normalize_columns
from strata.operators.cleaning import keep_first, require, total_order, type_columns

# ---------------------------------------------------------------- sales

# Text style per sales column.
SALES_TEXT_STYLES = {
    "distributor": "initcap", "customer_name": "initcap", "city": "initcap",
    "product_name": "initcap", "name_of_sales_rep": "initcap", "manager": "initcap",
    "sales_team": "initcap", "country": "upper", "channel": "lower", "sub_channel": "lower",
    "product_class": "initcap",
}

# Sales natural key, required columns and Silver column order.
SALES_NATURAL_KEY = ["distributor", "customer_name", "product_name", "city", "country", "month", "year"]
SALES_REQUIRED = ["distributor", "customer_name", "product_name", "quantity", "price", "country"]
SALES_COLUMNS = [
    "distributor", "customer_name", "city", "country", "latitude", "longitude", "channel",
    "sub_channel", "product_name", "product_class", "quantity", "price", "sales", "month",
    "year", "name_of_sales_rep", "manager", "sales_team",
]
BRONZE_METADATA = ["_ingested_at", "_source_file"]


def _with_metadata(raw: DataFrame, strict: bool) -> DataFrame:
    """Normalise the headers; stamp the ingestion time and the file that each row was read from.

    A packed file goes by the name of the file in it.  A frame that was not read
    from files has no file name.
    """
    try:
        source = raw.select("*", F.regexp_replace("_metadata.file_name", r"\.gz$", "").alias("_source_file"))
    except AnalysisException:
        source = raw.withColumn("_source_file", F.lit(None).cast("string"))
    names = normalize_columns(raw, strict=strict).columns
    return source.toDF(*names, "_source_file").withColumn("_ingested_at", F.current_timestamp()).select(*names, *BRONZE_METADATA)


def bronze_sales(raw: DataFrame) -> DataFrame:
    """Snake-case the CSV headers and stamp ingestion metadata."""
    return _with_metadata(raw, strict=False)


def clean_sales(bronze: DataFrame) -> DataFrame:
    return clean_columns(bronze, SALES_TEXT_STYLES, collapse=True)


def type_sales(df: DataFrame) -> DataFrame:
    return type_columns(df, ints=["quantity", "year"],
                        doubles=["price", "sales", "latitude", "longitude"])


def filter_sales_valid(df: DataFrame) -> DataFrame:
    return require(df, SALES_REQUIRED,
                   F.col("quantity") > 0, F.col("price") >= 0, F.col("sales") >= 0)


def dedup_sales(df: DataFrame) -> DataFrame:
    """One row per natural key, the highest sale wins (remaining columns break ties)."""
    rest = [c for c in SALES_COLUMNS if c not in SALES_NATURAL_KEY and c != "sales"]
    return keep_first(df, SALES_NATURAL_KEY, total_order([F.col("sales").desc_nulls_last()], rest))


def silver_sales(bronze: DataFrame) -> DataFrame:
    # cleaning makes no text null, so invalid rows go first: a filter on cleaned texts would clean them twice
    df = dedup_sales(clean_sales(filter_sales_valid(type_sales(bronze))))
    return df.select(*SALES_COLUMNS)


# ---------------------------------------------------------------- order events

# Text style per order-event column (trim + case, no whitespace collapse).
ORDER_TEXT_STYLES = {
    "event_id": "none", "order_id": "none",
    "customer_name": "initcap", "city": "initcap", "country": "upper", "channel": "lower",
    "sub_channel": "lower", "product_name": "initcap", "product_class": "initcap",
    "currency": "upper",
}
LEGACY_TEXT_STYLES = {
    "event_id": "none", "order_id": "none", "site_id": "none", "product_id": "none",
    "channel": "lower", "country": "upper", "currency": "upper",
}
# Required order-event columns (current and legacy payload).
ORDER_REQUIRED = ["event_id", "order_id", "event_ts", "customer_name", "product_name", "qty", "unit_price"]
LEGACY_REQUIRED = ["event_id", "order_id", "event_ts", "qty", "unit_price"]


def clean_orders(df: DataFrame, legacy: bool = False) -> DataFrame:
    styled = clean_columns(df, LEGACY_TEXT_STYLES if legacy else ORDER_TEXT_STYLES, collapse=False)
    return styled.withColumn("event_ts", parse_iso_timestamp("event_ts"))


def filter_orders_valid(df: DataFrame, legacy: bool = False) -> DataFrame:
    return require(df, LEGACY_REQUIRED if legacy else ORDER_REQUIRED,
                   F.col("qty") > 0, F.col("unit_price") >= 0)


def dedup_orders(df: DataFrame) -> DataFrame:
    """One row per event_id, the earliest event wins."""
    rest = [c for c in df.columns if c not in ("event_id", "event_ts")]
    return keep_first(df, ["event_id"], total_order([F.col("event_ts").asc_nulls_last()], rest))


def with_total_amount(df: DataFrame) -> DataFrame:
    return df.withColumn("total_amount", F.col("qty") * F.col("unit_price"))


def silver_orders(bronze: DataFrame) -> DataFrame:
    """Dispatch on the payload schema: customer_name present -> current schema, else legacy."""
    legacy = "customer_name" not in bronze.columns
    df = dedup_orders(filter_orders_valid(clean_orders(bronze, legacy), legacy))
    return with_total_amount(df)


# ---------------------------------------------------------------- shipments

# Bronze column -> Silver column for the 26 kept shipment columns.
SHIPMENT_SELECTION = {
    "id": "shipment_id", "project_code": "project_code", "country": "country",
    "managed_by": "managed_by", "fulfill_via": "fulfill_via", "vendor_inco_term": "vendor_inco_term",
    "shipment_mode": "shipment_mode", "scheduled_delivery_date": "scheduled_delivery_date",
    "delivered_to_client_date": "delivered_to_client_date",
    "delivery_recorded_date": "delivery_recorded_date", "product_group": "product_group",
    "sub_classification": "sub_classification", "vendor": "vendor",
    "item_description": "item_description", "molecule_test_type": "molecule_test_type",
    "brand": "brand", "dosage": "dosage", "dosage_form": "dosage_form",
    "line_item_quantity": "line_item_quantity", "line_item_value": "line_item_value",
    "pack_price": "pack_price", "unit_price": "unit_price",
    "manufacturing_site": "manufacturing_site", "weight_kilograms": "weight_kilograms",
    "freight_cost_usd": "freight_cost_usd", "line_item_insurance_usd": "line_item_insurance_usd",
}
# Typed shipment columns (dates, doubles).
SHIPMENT_DATES = ["scheduled_delivery_date", "delivered_to_client_date", "delivery_recorded_date"]
SHIPMENT_DOUBLES = ["line_item_value", "pack_price", "unit_price", "weight_kilograms",
                    "freight_cost_usd", "line_item_insurance_usd"]
# Text style per shipment column.
SHIPMENT_TEXT_STYLES = {
    "country": "upper", "vendor": "initcap", "product_group": "initcap",
    "shipment_mode": "lower", "brand": "initcap", "fulfill_via": "lower",
}
# The five date columns of the raw shipments file.
SHIPMENT_RAW_DATES = ["pq_first_sent_to_client_date", "po_sent_to_vendor_date",
                      "scheduled_delivery_date", "delivered_to_client_date", "delivery_recorded_date"]


def bronze_shipments(raw: DataFrame) -> DataFrame:
    """Strictly normalised headers and ingestion metadata."""
    return _with_metadata(raw, strict=True)


def delivery_days(delivered: str = "delivered_to_client_date",
                  scheduled: str = "scheduled_delivery_date") -> F.Column:
    """Whole days delivered - scheduled; NULL when either date is missing."""
    return F.datediff(F.col(delivered), F.col(scheduled))


def late_flag(days: str = "delivery_days") -> F.Column:
    """Three-valued: > 0 late, <= 0 on time, NULL unknown."""
    d = F.col(days)
    return F.when(d > 0, F.lit(True)).when(d <= 0, F.lit(False))


def silver_shipments(bronze: DataFrame) -> DataFrame:
    df = bronze.select(*[F.col(k).alias(v) for k, v in SHIPMENT_SELECTION.items()])
    df = df.withColumns({c: parse_date_robust(c) for c in SHIPMENT_DATES})
    df = type_columns(df, ints=["line_item_quantity"], doubles=SHIPMENT_DOUBLES)
    df = clean_columns(df, SHIPMENT_TEXT_STYLES, collapse=False)
    df = require(df, ["shipment_id", "country", "line_item_quantity"], F.col("line_item_quantity") > 0)
    df = df.withColumn("delivery_days", delivery_days())
    return df.withColumn("is_late_delivery", late_flag())
