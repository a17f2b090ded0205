"""Derive the three raw feeds of the data model from the driver's TPC-H-style tables.

* ``sales_wide``      - the wide sales CSV (18 columns, original header names),
                        plus a re-sent correction batch for returned lines so
                        the natural-key dedup has real work.
* ``order_event_lines`` - the order-event stream as JSON text lines (one per
                        line item); (l_orderkey, l_linenumber) repeats in the
                        data, which yields duplicated event ids; returned lines
                        carry negative quantities and discounted-at-max lines
                        arrive corrupted.
* ``legacy_order_events`` - the same events in the old id-based schema.
* ``shipments_raw``   - the all-string shipments CSV with text sentinels in the
                        date columns and non-numeric weight / freight cells.

All feeds derive from one join tree (lineitem x orders x customer x part x
supplier, nation/region, which Spark broadcasts by their size), so the work grows with
the tables; ``landing_lines`` is that join, which the Lakehouse lands once and
hands to every feed (each feed can also join the raw tables itself).  Dirty spacing and casing are injected by expression so the Silver
cleaning has something to clean.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.functions.numeric import round_half_up, safe_div
from strata.sources.tables import Tables

# Original header names of the wide sales CSV, in file order.
SALES_HEADERS = [
    "Distributor", "Customer Name", "City", "Country", "Latitude", "Longitude",
    "Channel", "Sub-channel", "Product Name", "Product Class", "Quantity", "Price",
    "Sales", "Month", "Year", "Name of Sales Rep", "Manager", "Sales Team",
]

# Original header names of the shipments CSV, in file order.
SHIPMENT_HEADERS = [
    "ID", "Project Code", "Country", "Managed By", "Fulfill Via", "Vendor INCO Term",
    "Shipment Mode", "PQ First Sent to Client Date", "PO Sent to Vendor Date",
    "Scheduled Delivery Date", "Delivered to Client Date", "Delivery Recorded Date",
    "Product Group", "Sub Classification", "Vendor", "Item Description",
    "Molecule Test Type", "Brand", "Dosage", "Dosage Form", "Line Item Quantity",
    "Line Item Value", "Pack Price", "Unit Price", "Manufacturing Site",
    "Weight (Kilograms)", "Freight Cost (USD)", "Line Item Insurance (USD)",
]


def _geo(t: Tables, prefix: str) -> DataFrame:
    geo = t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey")).select(
        F.col("n_nationkey").alias(f"{prefix}_nationkey"),
        F.col("n_name").alias(f"{prefix}_nation"),
        F.col("r_name").alias(f"{prefix}_region"),
    )
    return geo


def enriched_lines(t: Tables, line_cols: list[str]) -> DataFrame:
    """lineitem joined to its part, supplier (+geo), order and customer (+geo).

    Orders are joined to customers first (orders is ~1/4 of lineitem), so the
    shuffle on custkey moves order-sized data, not line-sized data.  Lines meet
    their parts before that, as the shuffle on the order key then carries a
    part's few short texts and not all of the customer's.
    """
    cust = t.customer.select("c_custkey", "c_name", "c_nationkey", "c_mktsegment").join(
        _geo(t, "c"), "c_nationkey")
    # orders are fact data too: keep them on the probe side of the customer join
    ords = t.orders.select("o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority",
                           "o_orderstatus").hint("merge").join(
        cust, F.col("o_custkey") == F.col("c_custkey")).drop("c_custkey")
    supp = t.supplier.select("s_suppkey", "s_name", "s_nationkey").join(_geo(t, "s"), "s_nationkey")
    part = t.part.select("p_partkey", "p_name", "p_type", "p_brand", "p_size", "p_retailprice")
    # Lines are the fact side: never let a size estimate broadcast them and probe
    # with a one-split dimension scan (the whole per-line pipeline would run in
    # one task).  The merge hint keeps lineitem x orders a shuffle join on the
    # order key, which AQE can split when one order key is hot.  Parts are
    # broadcast as long as they are small.
    li = t.lineitem.select(*sorted(set(line_cols) | {"l_orderkey", "l_partkey", "l_suppkey"}))
    # a key that equals the line's own isn't carried on
    return (
        li.join(part, F.col("l_partkey") == F.col("p_partkey")).drop("p_partkey").hint("merge")
        .join(ords, F.col("l_orderkey") == F.col("o_orderkey")).drop("o_orderkey")
        .join(supp, F.col("l_suppkey") == F.col("s_suppkey")).drop("l_suppkey", "s_suppkey", "s_nationkey")
    )


# every lineitem column any feed reads (the shared landing join carries all of them)
FEED_LINE_COLUMNS = ["l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
                     "l_returnflag", "l_linestatus", "l_shipdate"]


def landing_lines(t: Tables) -> DataFrame:
    """The one join tree all feeds derive from; land it once and pass it to each feed."""
    return enriched_lines(t, FEED_LINE_COLUMNS)


def _lines(src: Tables | DataFrame, cols: list[str]) -> DataFrame:
    """Feeds accept the landed join (a DataFrame) or the raw tables (joined on the fly)."""
    return src if isinstance(src, DataFrame) else enriched_lines(src, cols)


def _unit_price() -> F.Column:
    """NULL for a line of quantity 0, which the validity filter then rejects."""
    return round_half_up(safe_div(F.col("l_extendedprice"), F.col("l_quantity")), 2)


def _product_name() -> F.Column:
    # p_name alone repeats across parts; the part key makes it a product identity
    return F.concat_ws(" ", F.col("p_name"), F.col("l_partkey").cast("string"))


def _sales_projection(lines: DataFrame, sales: F.Column) -> DataFrame:
    return lines.select(
        F.concat(F.lit("Distributor "), F.col("s_nation")).alias("Distributor"),
        F.concat(F.lit("  "), F.regexp_replace("c_name", "#", "  "), F.lit(" ")).alias("Customer Name"),
        F.col("c_nation").alias("City"),
        F.lower("c_region").alias("Country"),
        (F.col("c_nationkey") * 3.0 - 36.0).alias("Latitude"),
        (F.col("c_nationkey") * 7.0 - 84.0).alias("Longitude"),
        F.col("c_mktsegment").alias("Channel"),
        F.col("o_orderpriority").alias("Sub-channel"),
        _product_name().alias("Product Name"),
        F.col("p_type").alias("Product Class"),
        F.col("l_quantity").cast("int").alias("Quantity"),
        _unit_price().alias("Price"),
        sales.alias("Sales"),
        F.date_format("o_orderdate", "MMMM").alias("Month"),
        F.year("o_orderdate").alias("Year"),
        F.col("s_name").alias("Name of Sales Rep"),
        F.concat(F.lit("Manager "), F.col("s_nation")).alias("Manager"),
        F.col("s_region").alias("Sales Team"),
    )


def sales_wide(t: Tables | DataFrame, with_corrections: bool = True) -> DataFrame:
    """Wide sales rows with the CSV's header names (Bronze input).

    Returned lines are re-sent once more with the net (discounted) amount cut to
    cents.  The extra copy is generated in the same pass (explode of a 1- or
    2-element array), so the join tree is evaluated once, not once per batch.
    """
    lines = _lines(t, ["l_quantity", "l_extendedprice", "l_discount", "l_returnflag"])
    if not with_corrections:
        return _sales_projection(lines, F.col("l_extendedprice"))
    copies = F.when(F.col("l_returnflag") == "R", F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    lines = lines.withColumn("_copy", F.explode(copies))
    net = F.floor(F.col("l_extendedprice") * (1 - F.col("l_discount")) * 100) / 100
    return _sales_projection(lines, F.when(F.col("_copy") == 1, net).otherwise(F.col("l_extendedprice")))


def _event_struct() -> F.Column:
    return F.struct(
        F.concat(F.lit("EVT-"), F.col("l_orderkey").cast("string"), F.lit("-"),
                 F.col("l_linenumber").cast("string")).alias("event_id"),
        F.concat(F.lit("ORD-"), F.col("l_orderkey").cast("string")).alias("order_id"),
        F.date_format("l_shipdate", "yyyy-MM-dd'T'HH:mm:ss").alias("event_ts"),
        F.concat(F.lit(" "), F.regexp_replace("c_name", "#", " "), F.lit(" ")).alias("customer_name"),
        F.col("c_nation").alias("city"),
        F.lower("c_region").alias("country"),
        F.col("c_mktsegment").alias("channel"),
        F.col("o_orderpriority").alias("sub_channel"),
        _product_name().alias("product_name"),
        F.col("p_type").alias("product_class"),
        (F.col("l_quantity").cast("int")
         * F.when(F.col("l_returnflag") == "R", F.lit(-1)).otherwise(F.lit(1))).alias("qty"),
        _unit_price().alias("unit_price"),
        F.when(F.col("c_region") == "AMERICA", F.lit("usd")).otherwise(F.lit("eur")).alias("currency"),
        (F.col("c_nationkey") * 3.0 - 36.0).alias("latitude"),
        (F.col("c_nationkey") * 7.0 - 84.0).alias("longitude"),
    )


def order_event_lines(t: Tables | DataFrame) -> DataFrame:
    """One JSON text line per line item, column ``value`` (the Kafka payload shape)."""
    lines = _lines(t, ["l_linenumber", "l_quantity", "l_extendedprice", "l_discount",
                       "l_returnflag", "l_shipdate"])
    payload = F.to_json(_event_struct())
    corrupt = F.col("l_discount") >= 0.1
    return lines.select(
        F.when(corrupt, F.concat(F.lit("#corrupt "), payload)).otherwise(payload).alias("value"))


def legacy_order_events(t: Tables | DataFrame) -> DataFrame:
    """The same events in the older id-based schema (already typed, event_ts as text)."""
    lines = _lines(t, ["l_linenumber", "l_quantity", "l_extendedprice", "l_returnflag",
                       "l_shipdate"])
    e = _event_struct()
    return lines.select(
        e["event_id"].alias("event_id"),
        e["order_id"].alias("order_id"),
        e["event_ts"].alias("event_ts"),
        F.concat(F.lit(" site-"), F.col("o_custkey").cast("string"), F.lit(" ")).alias("site_id"),
        F.concat(F.lit("prod-"), F.col("l_partkey").cast("string")).alias("product_id"),
        e["channel"].alias("channel"),
        e["country"].alias("country"),
        e["currency"].alias("currency"),
        e["qty"].alias("qty"),
        e["unit_price"].alias("unit_price"),
    )


def _dmy(c: F.Column) -> F.Column:
    return F.date_format(c, "d-MMM-yy")


def shipments_raw(t: Tables | DataFrame) -> DataFrame:
    """All-string shipments rows with the CSV's header names (Bronze input)."""
    lines = _lines(t, FEED_LINE_COLUMNS)
    s = F.col
    rf, ls = s("l_returnflag"), s("l_linestatus")
    odate = s("o_orderdate").cast("date")
    sdate = s("l_shipdate").cast("date")
    cols = [
        F.concat_ws("-", s("l_orderkey").cast("string"), s("l_linenumber").cast("string")),
        F.concat(F.lit("PRJ-"), s("p_brand")),
        F.concat(F.lit(" "), s("c_nation"), F.lit(" ")),
        F.concat(F.lit("PMO - "), s("c_region")),
        F.when(s("o_orderstatus") == "F", F.lit("Direct Drop")).otherwise(F.lit("From RDC")),
        F.concat(F.lit("INCO-"), F.substring("o_orderpriority", 1, 1)),
        F.when(ls == "O", F.lit(" Air ")).otherwise(F.lit("TRUCK")),
        F.when(rf == "A", F.lit("Pre-PQ Process")).otherwise(_dmy(F.date_sub(odate, 30))),
        F.when(rf == "N", F.lit("Date Not Captured")).otherwise(_dmy(F.date_sub(odate, 10))),
        F.when((rf == "R") & (ls == "O"), F.lit("Date Not Captured")).otherwise(_dmy(odate)),
        F.when(s("l_discount") == 0, F.lit("Insufficient data (see ASN)"))
        .when(s("l_tax") == 0, F.lit("")).otherwise(_dmy(sdate)),
        _dmy(F.date_add(sdate, 2)),
        F.lower("p_type"),
        s("p_brand"),
        F.lower("s_name"),
        s("p_name"),
        F.concat_ws(" ", s("p_type"), s("p_size").cast("string")),
        F.lower("p_brand"),
        F.concat(s("p_size").cast("string"), F.lit("mg")),
        F.lit("Tablet"),
        s("l_quantity").cast("string"),
        s("l_extendedprice").cast("string"),
        s("p_retailprice").cast("string"),
        _unit_price().cast("string"),
        F.concat(F.lit("Site "), s("s_nation")),
        F.when(rf == "A", F.lit("Weight Captured Separately"))
        .otherwise((s("l_quantity") * 2).cast("int").cast("string")),
        F.when(ls == "O", F.lit("Freight Included in Commodity Cost"))
        .otherwise((s("l_quantity") * 10).cast("int").cast("string")),
        round_half_up(s("l_extendedprice") * 0.01, 2).cast("string"),
    ]
    return lines.select(*[c.alias(h) for c, h in zip(cols, SHIPMENT_HEADERS)])
