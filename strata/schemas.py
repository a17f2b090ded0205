"""Fixed schemas of the data model (order events, empty Silver / fact frames)."""

from __future__ import annotations

from pyspark.sql.types import (
    DoubleType, IntegerType, LongType, StringType, StructField, StructType, TimestampNTZType,
)


def _s(*fields: tuple[str, object]) -> StructType:
    return StructType([StructField(n, t, True) for n, t in fields])


# The order-event payload: 15 fields, event_ts kept as text until Silver.
ORDER_EVENT_SCHEMA = _s(
    ("event_id", StringType()), ("order_id", StringType()), ("event_ts", StringType()),
    ("customer_name", StringType()), ("city", StringType()), ("country", StringType()),
    ("channel", StringType()), ("sub_channel", StringType()),
    ("product_name", StringType()), ("product_class", StringType()),
    ("qty", IntegerType()), ("unit_price", DoubleType()), ("currency", StringType()),
    ("latitude", DoubleType()), ("longitude", DoubleType()),
)

SILVER_ORDERS_SCHEMA = _s(
    ("event_id", StringType()), ("order_id", StringType()), ("event_ts", TimestampNTZType()),
    ("customer_name", StringType()), ("city", StringType()), ("country", StringType()),
    ("channel", StringType()), ("sub_channel", StringType()),
    ("product_name", StringType()), ("product_class", StringType()),
    ("qty", IntegerType()), ("unit_price", DoubleType()), ("currency", StringType()),
    ("latitude", DoubleType()), ("longitude", DoubleType()), ("total_amount", DoubleType()),
)

FACT_ORDERS_SCHEMA = _s(
    ("order_sk", LongType()), ("event_id", StringType()), ("order_id", StringType()),
    ("event_ts", TimestampNTZType()), ("product_sk", LongType()), ("customer_sk", LongType()),
    ("qty", IntegerType()), ("unit_price", DoubleType()), ("total_amount", DoubleType()),
    ("channel", StringType()), ("sub_channel", StringType()), ("country", StringType()),
    ("city", StringType()), ("currency", StringType()),
)

# The sales CSV as inference types it, and the shipments CSV, all strings; both in file order.
SALES_CSV_SCHEMA = _s(
    ("Distributor", StringType()), ("Customer Name", StringType()), ("City", StringType()), ("Country", StringType()),
    ("Latitude", DoubleType()), ("Longitude", DoubleType()), ("Channel", StringType()), ("Sub-channel", StringType()),
    ("Product Name", StringType()), ("Product Class", StringType()), ("Quantity", IntegerType()), ("Price", DoubleType()),
    ("Sales", DoubleType()), ("Month", StringType()), ("Year", IntegerType()), ("Name of Sales Rep", StringType()),
    ("Manager", StringType()), ("Sales Team", StringType()),
)


def all_strings(names: list[str]) -> StructType:
    return _s(*[(n, StringType()) for n in names])
