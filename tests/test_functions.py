"""Pure-Python and expression-level unit tests (column normalisers, schemas, text/date helpers)."""

import pytest
from pyspark.sql import functions as F

from strata.functions.text import snake_case, snake_case_strict
from strata.schemas import ORDER_EVENT_SCHEMA


@pytest.mark.parametrize("raw,expected", [
    ("Product Name", "product_name"), ("Sub-Channel", "sub_channel"), ("City/Town", "city_town"),
    ("QUANTITY", "quantity"), ("customer_name", "customer_name"), ("Sales Rep Name/ID", "sales_rep_name_id"),
])
def test_snake_case(raw, expected):
    assert snake_case(raw) == expected


@pytest.mark.parametrize("raw,expected", [
    ("  Weight (Kilograms) ", "weight_kilograms"), ("Freight Cost (USD)", "freight_cost_usd"),
    ("PQ First Sent to Client Date", "pq_first_sent_to_client_date"), ("Vendor   INCO Term", "vendor_inco_term"),
])
def test_snake_case_strict(raw, expected):
    assert snake_case_strict(raw) == expected


def test_order_event_schema_has_15_typed_fields():
    names = [f.name for f in ORDER_EVENT_SCHEMA.fields]
    assert len(names) == 15 and len(set(names)) == 15
    types = {f.name: f.dataType.simpleString() for f in ORDER_EVENT_SCHEMA.fields}
    assert types["qty"] == "int" and types["unit_price"] == "double" and types["event_ts"] == "string"
    assert types["latitude"] == types["longitude"] == "double"


def test_text_cleaning_styles(spark):
    from strata.functions.text import clean_text, trim_case
    df = spark.createDataFrame([("  côte   d'ivoire  ",), (None,)], "s string")
    out = df.select(clean_text("s", "initcap").alias("i"), clean_text("s", "upper").alias("u"),
                    trim_case("s", "lower").alias("l")).collect()
    assert out[0].i == "Côte D'ivoire" and out[0].u == "CÔTE D'IVOIRE" and out[0].l == "côte   d'ivoire"
    assert out[1].i is None


def test_robust_date_and_lenient_casts(spark):
    from strata.functions.dates import parse_date_robust
    from strata.operators.cleaning import to_int_lenient
    df = spark.createDataFrame(
        [("2-Jun-06", "12.7"), ("Pre-PQ Process", "abc"), ("Date Not Captured", None), ("", "7"), (None, "1e3")],
        "d string, q string")
    rows = df.select(parse_date_robust("d").alias("d"), to_int_lenient("q").alias("q")).collect()
    assert str(rows[0].d) == "2006-06-02" and rows[0].q == 12
    assert all(r.d is None for r in rows[1:])
    assert rows[1].q is None and rows[2].q is None and rows[3].q == 7 and rows[4].q == 1000


def test_month_number_map_and_default(spark):
    from strata.functions.dates import month_number, month_number_or_january
    df = spark.createDataFrame([("March",), ("Mar",), (None,)], "m string")
    rows = df.select(month_number("m").alias("a"), month_number_or_january("m").alias("b")).collect()
    assert [(r.a, r.b) for r in rows] == [(3, 3), (None, 1), (None, 1)]


def test_round_half_up_is_decimal_based(spark):
    from strata.functions.numeric import round_half_up
    df = spark.createDataFrame([(1.005,), (2.675,), (-1.005,)], "x double")
    assert [r[0] for r in df.select(round_half_up("x", 2)).collect()] == [1.01, 2.68, -1.01]
