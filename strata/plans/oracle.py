"""Independent DuckDB SQL for every SQL-checkable query.

The whole medallion build (adapter -> Silver -> Gold) is restated as one
shared CTE prefix over the raw tables; each query appends its final SELECT.
Only the CTEs a query references are evaluated by DuckDB.  Nothing is imported
from the Spark modules: column lists, text styles, keys and required columns are
stated again below.
"""

from __future__ import annotations

# Fixed values, stated here a second time on purpose: the Spark modules have their own, so that a slip in either shows.
MONTHS = ['January', 'February', 'March', 'April', 'May', 'June', 'July', 'August', 'September', 'October', 'November',
 'December']
LEGACY_REQUIRED = ['event_id', 'order_id', 'event_ts', 'qty', 'unit_price']
LEGACY_TEXT_STYLES = {'event_id': 'none',
 'order_id': 'none',
 'site_id': 'none',
 'product_id': 'none',
 'channel': 'lower',
 'country': 'upper',
 'currency': 'upper'}
ORDER_REQUIRED = ['event_id', 'order_id', 'event_ts', 'customer_name', 'product_name', 'qty', 'unit_price']
ORDER_TEXT_STYLES = {'event_id': 'none',
 'order_id': 'none',
 'customer_name': 'initcap',
 'city': 'initcap',
 'country': 'upper',
 'channel': 'lower',
 'sub_channel': 'lower',
 'product_name': 'initcap',
 'product_class': 'initcap',
 'currency': 'upper'}
SALES_COLUMNS = ['distributor', 'customer_name', 'city', 'country', 'latitude', 'longitude', 'channel', 'sub_channel',
 'product_name', 'product_class', 'quantity', 'price', 'sales', 'month', 'year', 'name_of_sales_rep',
 'manager', 'sales_team']
SALES_NATURAL_KEY = ['distributor', 'customer_name', 'product_name', 'city', 'country', 'month', 'year']
SALES_REQUIRED = ['distributor', 'customer_name', 'product_name', 'quantity', 'price', 'country']
SALES_TEXT_STYLES = {'distributor': 'initcap',
 'customer_name': 'initcap',
 'city': 'initcap',
 'product_name': 'initcap',
 'name_of_sales_rep': 'initcap',
 'manager': 'initcap',
 'sales_team': 'initcap',
 'country': 'upper',
 'channel': 'lower',
 'sub_channel': 'lower',
 'product_class': 'initcap'}
SHIPMENT_DATES = ['scheduled_delivery_date', 'delivered_to_client_date', 'delivery_recorded_date']
SHIPMENT_DOUBLES = ['line_item_value', 'pack_price', 'unit_price', 'weight_kilograms', 'freight_cost_usd',
 'line_item_insurance_usd']
SHIPMENT_SELECTION = {'id': 'shipment_id',
 'project_code': 'project_code',
 'country': 'country',
 'managed_by': 'managed_by',
 'fulfill_via': 'fulfill_via',
 'vendor_inco_term': 'vendor_inco_term',
 'shipment_mode': 'shipment_mode',
 'scheduled_delivery_date': 'scheduled_delivery_date',
 'delivered_to_client_date': 'delivered_to_client_date',
 'delivery_recorded_date': 'delivery_recorded_date',
 'product_group': 'product_group',
 'sub_classification': 'sub_classification',
 'vendor': 'vendor',
 'item_description': 'item_description',
 'molecule_test_type': 'molecule_test_type',
 'brand': 'brand',
 'dosage': 'dosage',
 'dosage_form': 'dosage_form',
 'line_item_quantity': 'line_item_quantity',
 'line_item_value': 'line_item_value',
 'pack_price': 'pack_price',
 'unit_price': 'unit_price',
 'manufacturing_site': 'manufacturing_site',
 'weight_kilograms': 'weight_kilograms',
 'freight_cost_usd': 'freight_cost_usd',
 'line_item_insurance_usd': 'line_item_insurance_usd'}
SHIPMENT_TEXT_STYLES = {'country': 'upper',
 'vendor': 'initcap',
 'product_group': 'initcap',
 'shipment_mode': 'lower',
 'brand': 'initcap',
 'fulfill_via': 'lower'}

# ---------------------------------------------------------------- SQL fragments


def r(x: str, d: int = 2) -> str:
    """HALF_UP rounding on the decimal value, as double (mirrors numeric.round_half_up)."""
    return f"CAST(ROUND(CAST({x} AS DECIMAL(38,10)), {d}) AS DOUBLE)"


def msum(x: str) -> str:
    """SUM of the decimals that the doubles print as: no digit is cut."""
    return f"CAST(SUM(CAST(CAST(CAST({x} AS DOUBLE) AS VARCHAR) AS DECIMAL(28,10))) AS DOUBLE)"


def mavg(x: str) -> str:
    return f"({msum(x)} / COUNT({x}))"


def initcap(x: str) -> str:
    return f"array_to_string(list_transform(string_split(lower({x}), ' '), lambda w: upper(w[1]) || w[2:]), ' ')"


def styled(x: str, style: str) -> str:
    return {"upper": f"upper({x})", "lower": f"lower({x})", "initcap": initcap(x), "none": x}[style]


def clean(x: str, style: str) -> str:
    return styled(f"trim(regexp_replace({x}, '\\s+', ' ', 'g'))", style)


def trimcase(x: str, style: str) -> str:
    return styled(f"trim({x})", style)


def to_int(x: str) -> str:
    return f"TRY_CAST(trunc(TRY_CAST({x} AS DOUBLE)) AS INTEGER)"


def month_num(x: str) -> str:
    whens = " ".join(f"WHEN '{m}' THEN {i + 1}" for i, m in enumerate(MONTHS))
    return f"(CASE {x} {whens} END)"


def dmy(d: str) -> str:
    return f"strftime({d}, '%-d-%b-%y')"


def parse_dmy(x: str) -> str:
    # Spark's two-digit 'yy' maps every year into 2000-2099
    p = f"TRY_CAST(try_strptime({x}, '%d-%b-%y') AS DATE)"
    return f"(CASE WHEN year({p}) < 2000 THEN CAST({p} + INTERVAL 100 YEAR AS DATE) ELSE {p} END)"


def non_date(x: str) -> str:
    return (f"({x} IS NULL OR trim({x}) = '' OR contains({x}, 'Process') OR contains({x}, 'Captured')"
            f" OR contains({x}, 'Insufficient'))")


def robust_date(x: str) -> str:
    return f"(CASE WHEN {non_date(x)} THEN NULL ELSE {parse_dmy(x)} END)"


def order_by_all(first: list[str], rest: list[str]) -> str:
    return ", ".join(first + [f"{c} ASC NULLS FIRST" for c in rest])


UNIT_PRICE = r("l_extendedprice / NULLIF(l_quantity, 0)")
PRODUCT_NAME = "concat_ws(' ', p_name, CAST(p_partkey AS VARCHAR))"

# ---------------------------------------------------------------- shared CTEs

CTES: dict[str, str] = {}

CTES["geo"] = "SELECT n_nationkey, n_name, r_name FROM nation JOIN region ON n_regionkey = r_regionkey"

CTES["lines"] = """
SELECT l.l_orderkey, l.l_partkey, l.l_suppkey, l.l_linenumber, l.l_quantity, l.l_extendedprice,
       l.l_discount, l.l_tax, l.l_returnflag, l.l_linestatus, l.l_shipdate,
       o.o_orderkey, o.o_custkey, o.o_orderdate, o.o_orderpriority, o.o_orderstatus,
       c.c_name, c.c_nationkey, c.c_mktsegment, cg.n_name AS c_nation, cg.r_name AS c_region,
       p.p_partkey, p.p_name, p.p_type, p.p_brand, p.p_size, p.p_retailprice,
       s.s_name, sg.n_name AS s_nation, sg.r_name AS s_region
FROM lineitem l
JOIN orders o ON l.l_orderkey = o.o_orderkey
JOIN customer c ON o.o_custkey = c.c_custkey
JOIN geo cg ON c.c_nationkey = cg.n_nationkey
JOIN part p ON l.l_partkey = p.p_partkey
JOIN supplier s ON l.l_suppkey = s.s_suppkey
JOIN geo sg ON s.s_nationkey = sg.n_nationkey"""


def _sales_proj(sales: str, where: str = "") -> str:
    return f"""
SELECT 'Distributor ' || s_nation AS distributor,
       '  ' || replace(c_name, '#', '  ') || ' ' AS customer_name,
       c_nation AS city, lower(c_region) AS country,
       CAST(c_nationkey AS DOUBLE) * 3 - 36 AS latitude,
       CAST(c_nationkey AS DOUBLE) * 7 - 84 AS longitude,
       c_mktsegment AS channel, o_orderpriority AS sub_channel,
       {PRODUCT_NAME} AS product_name, p_type AS product_class,
       CAST(trunc(l_quantity) AS INTEGER) AS quantity, {UNIT_PRICE} AS price, {sales} AS sales,
       monthname(o_orderdate) AS month, CAST(year(o_orderdate) AS INTEGER) AS year,
       s_name AS name_of_sales_rep, 'Manager ' || s_nation AS manager, s_region AS sales_team
FROM lines {where}"""


CTES["bronze_sales"] = (_sales_proj("l_extendedprice") + "\nUNION ALL" +
                        _sales_proj("floor(l_extendedprice * (1 - l_discount) * 100) / 100",
                                    "WHERE l_returnflag = 'R'"))

_sales_clean_cols = []
for _c in SALES_COLUMNS:
    if _c in SALES_TEXT_STYLES:
        _sales_clean_cols.append(f"{clean(_c, SALES_TEXT_STYLES[_c])} AS {_c}")
    elif _c in ("quantity", "year"):
        _sales_clean_cols.append(f"{to_int(_c)} AS {_c}")
    elif _c in ("price", "sales", "latitude", "longitude"):
        _sales_clean_cols.append(f"TRY_CAST({_c} AS DOUBLE) AS {_c}")
    else:
        _sales_clean_cols.append(_c)
CTES["typed_sales"] = "SELECT " + ", ".join(_sales_clean_cols) + " FROM bronze_sales"

CTES["valid_sales"] = ("SELECT * FROM typed_sales WHERE " +
                       " AND ".join(f"{c} IS NOT NULL" for c in SALES_REQUIRED) +
                       " AND quantity > 0 AND price >= 0 AND sales >= 0")

_sales_rest = [c for c in SALES_COLUMNS if c not in SALES_NATURAL_KEY and c != "sales"]
CTES["silver_sales"] = f"""
SELECT {", ".join(SALES_COLUMNS)} FROM (
  SELECT *, row_number() OVER (PARTITION BY {", ".join(SALES_NATURAL_KEY)}
                               ORDER BY {order_by_all(["sales DESC NULLS LAST"], _sales_rest)}) AS rn
  FROM valid_sales) WHERE rn = 1"""

# ---- order events
_EVENT_FIELDS = [
    ("event_id", "'EVT-' || CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR)"),
    ("order_id", "'ORD-' || CAST(o_orderkey AS VARCHAR)"),
    ("event_ts", "strftime(l_shipdate, '%Y-%m-%dT%H:%M:%S')"),
    ("customer_name", "' ' || replace(c_name, '#', ' ') || ' '"),
    ("city", "c_nation"),
    ("country", "lower(c_region)"),
    ("channel", "c_mktsegment"),
    ("sub_channel", "o_orderpriority"),
    ("product_name", PRODUCT_NAME),
    ("product_class", "p_type"),
    ("qty", "CAST(trunc(l_quantity) AS INTEGER) * (CASE WHEN l_returnflag = 'R' THEN -1 ELSE 1 END)"),
    ("unit_price", UNIT_PRICE),
    ("currency", "CASE WHEN c_region = 'AMERICA' THEN 'usd' ELSE 'eur' END"),
    ("latitude", "CAST(c_nationkey AS DOUBLE) * 3 - 36"),
    ("longitude", "CAST(c_nationkey AS DOUBLE) * 7 - 84"),
]
CTES["bronze_orders"] = "SELECT " + ", ".join(
    f"CASE WHEN l_discount >= 0.1 THEN NULL ELSE {e} END AS {n}" for n, e in _EVENT_FIELDS) + " FROM lines"

_ORDER_COLS = [n for n, _ in _EVENT_FIELDS]


def _clean_orders(src: str, styles: dict[str, str], cols: list[str]) -> str:
    out = []
    for c in cols:
        if c == "event_ts":
            out.append("TRY_CAST(event_ts AS TIMESTAMP) AS event_ts")
        elif c in styles:
            out.append(f"{trimcase(c, styles[c])} AS {c}")
        else:
            out.append(c)
    return f"SELECT {', '.join(out)} FROM {src}"


CTES["clean_orders"] = _clean_orders("bronze_orders", ORDER_TEXT_STYLES, _ORDER_COLS)
CTES["valid_orders"] = ("SELECT * FROM clean_orders WHERE " +
                        " AND ".join(f"{c} IS NOT NULL" for c in ORDER_REQUIRED) +
                        " AND qty > 0 AND unit_price >= 0")
_order_rest = [c for c in _ORDER_COLS if c not in ("event_id", "event_ts")]
CTES["dedup_orders"] = f"""
SELECT {", ".join(_ORDER_COLS)} FROM (
  SELECT *, row_number() OVER (PARTITION BY event_id
                               ORDER BY {order_by_all(["event_ts ASC NULLS LAST"], _order_rest)}) AS rn
  FROM valid_orders) WHERE rn = 1"""
CTES["silver_orders"] = "SELECT *, qty * unit_price AS total_amount FROM dedup_orders"

# ---- legacy order events
_LEGACY_FIELDS = [
    ("event_id", dict(_EVENT_FIELDS)["event_id"]),
    ("order_id", dict(_EVENT_FIELDS)["order_id"]),
    ("event_ts", dict(_EVENT_FIELDS)["event_ts"]),
    ("site_id", "' site-' || CAST(o_custkey AS VARCHAR) || ' '"),
    ("product_id", "'prod-' || CAST(l_partkey AS VARCHAR)"),
    ("channel", "c_mktsegment"),
    ("country", "lower(c_region)"),
    ("currency", dict(_EVENT_FIELDS)["currency"]),
    ("qty", dict(_EVENT_FIELDS)["qty"]),
    ("unit_price", UNIT_PRICE),
]
_LEGACY_COLS = [n for n, _ in _LEGACY_FIELDS]
CTES["bronze_orders_legacy"] = "SELECT " + ", ".join(f"{e} AS {n}" for n, e in _LEGACY_FIELDS) + " FROM lines"
CTES["clean_orders_legacy"] = _clean_orders("bronze_orders_legacy", LEGACY_TEXT_STYLES, _LEGACY_COLS)
_legacy_rest = [c for c in _LEGACY_COLS if c not in ("event_id", "event_ts")]
CTES["silver_orders_legacy"] = f"""
SELECT {", ".join(_LEGACY_COLS)}, qty * unit_price AS total_amount FROM (
  SELECT *, row_number() OVER (PARTITION BY event_id
                               ORDER BY {order_by_all(["event_ts ASC NULLS LAST"], _legacy_rest)}) AS rn
  FROM clean_orders_legacy
  WHERE {" AND ".join(f"{c} IS NOT NULL" for c in LEGACY_REQUIRED)} AND qty > 0 AND unit_price >= 0
) WHERE rn = 1"""

# ---- shipments
_SHIP_FIELDS = [
    ("id", "concat_ws('-', CAST(l_orderkey AS VARCHAR), CAST(l_linenumber AS VARCHAR))"),
    ("project_code", "'PRJ-' || p_brand"),
    ("country", "' ' || c_nation || ' '"),
    ("managed_by", "'PMO - ' || c_region"),
    ("fulfill_via", "CASE WHEN o_orderstatus = 'F' THEN 'Direct Drop' ELSE 'From RDC' END"),
    ("vendor_inco_term", "'INCO-' || substring(o_orderpriority, 1, 1)"),
    ("shipment_mode", "CASE WHEN l_linestatus = 'O' THEN ' Air ' ELSE 'TRUCK' END"),
    ("pq_first_sent_to_client_date",
     f"CASE WHEN l_returnflag = 'A' THEN 'Pre-PQ Process' ELSE {dmy('CAST(o_orderdate AS DATE) - 30')} END"),
    ("po_sent_to_vendor_date",
     f"CASE WHEN l_returnflag = 'N' THEN 'Date Not Captured' ELSE {dmy('CAST(o_orderdate AS DATE) - 10')} END"),
    ("scheduled_delivery_date",
     f"CASE WHEN l_returnflag = 'R' AND l_linestatus = 'O' THEN 'Date Not Captured' "
     f"ELSE {dmy('CAST(o_orderdate AS DATE)')} END"),
    ("delivered_to_client_date",
     f"CASE WHEN l_discount = 0 THEN 'Insufficient data (see ASN)' WHEN l_tax = 0 THEN NULL "
     f"ELSE {dmy('CAST(l_shipdate AS DATE)')} END"),
    ("delivery_recorded_date", dmy("CAST(l_shipdate AS DATE) + 2")),
    ("product_group", "lower(p_type)"),
    ("sub_classification", "p_brand"),
    ("vendor", "lower(s_name)"),
    ("item_description", "p_name"),
    ("molecule_test_type", "concat_ws(' ', p_type, CAST(p_size AS VARCHAR))"),
    ("brand", "lower(p_brand)"),
    ("dosage", "CAST(p_size AS VARCHAR) || 'mg'"),
    ("dosage_form", "'Tablet'"),
    ("line_item_quantity", "CAST(l_quantity AS VARCHAR)"),
    ("line_item_value", "CAST(l_extendedprice AS VARCHAR)"),
    ("pack_price", "CAST(p_retailprice AS VARCHAR)"),
    ("unit_price", f"CAST({UNIT_PRICE} AS VARCHAR)"),
    ("manufacturing_site", "'Site ' || s_nation"),
    ("weight_kilograms",
     "CASE WHEN l_returnflag = 'A' THEN 'Weight Captured Separately' "
     "ELSE CAST(CAST(trunc(l_quantity * 2) AS INTEGER) AS VARCHAR) END"),
    ("freight_cost_usd",
     "CASE WHEN l_linestatus = 'O' THEN 'Freight Included in Commodity Cost' "
     "ELSE CAST(CAST(trunc(l_quantity * 10) AS INTEGER) AS VARCHAR) END"),
    ("line_item_insurance_usd", f"CAST({r('l_extendedprice * 0.01')} AS VARCHAR)"),
]
SHIPMENT_RAW_COLS = [n for n, _ in _SHIP_FIELDS]
CTES["bronze_shipments"] = "SELECT " + ", ".join(f"{e} AS {n}" for n, e in _SHIP_FIELDS) + " FROM lines"

_ship_sel = []
for _k, _v in SHIPMENT_SELECTION.items():
    if _v in SHIPMENT_DATES:
        e = robust_date(_k)
    elif _v == "line_item_quantity":
        e = to_int(_k)
    elif _v in SHIPMENT_DOUBLES:
        e = f"TRY_CAST({_k} AS DOUBLE)"
    elif _v in SHIPMENT_TEXT_STYLES:
        e = trimcase(_k, SHIPMENT_TEXT_STYLES[_v])
    else:
        e = _k
    _ship_sel.append(f"{e} AS {_v}")
CTES["typed_shipments"] = "SELECT " + ", ".join(_ship_sel) + " FROM bronze_shipments"
CTES["silver_shipments"] = """
SELECT *, CASE WHEN delivery_days > 0 THEN TRUE WHEN delivery_days <= 0 THEN FALSE END AS is_late_delivery
FROM (SELECT *, CAST(date_diff('day', scheduled_delivery_date, delivered_to_client_date) AS INTEGER) AS delivery_days
      FROM typed_shipments
      WHERE shipment_id IS NOT NULL AND country IS NOT NULL AND line_item_quantity IS NOT NULL
        AND line_item_quantity > 0)"""

# ---- gold
CTES["months"] = """
SELECT year, month FROM silver_sales
UNION
SELECT CAST(year(event_ts) AS INTEGER) AS year, monthname(event_ts) AS month FROM silver_orders"""
CTES["dim_time"] = f"""
SELECT CAST(row_number() OVER (ORDER BY year NULLS FIRST, month_num NULLS FIRST, month NULLS FIRST) AS BIGINT) AS time_sk,
       year, month, month_num, quarter,
       concat_ws('', 'Q', CAST(quarter AS VARCHAR)) AS quarter_name,
       concat_ws('-', CAST(year AS VARCHAR), CAST(month_num AS VARCHAR)) AS year_month
FROM (SELECT year, month, m AS month_num, CAST(floor((m - 1) / 3) + 1 AS INTEGER) AS quarter
      FROM (SELECT year, month, {month_num('month')} AS m FROM months))"""
CTES["dim_product"] = """
SELECT CAST(row_number() OVER (ORDER BY product_name NULLS FIRST, product_class NULLS FIRST) AS BIGINT) AS product_sk,
       md5(product_name) AS product_nk, product_name, product_class
FROM (SELECT DISTINCT product_name, product_class FROM silver_sales)"""
_CUST_ATTRS = ["city", "country", "latitude", "longitude", "channel", "sub_channel", "distributor"]
CTES["dim_customer"] = f"""
SELECT CAST(row_number() OVER (ORDER BY customer_name NULLS FIRST) AS BIGINT) AS customer_sk,
       md5(customer_name) AS customer_nk, customer_name, {", ".join(_CUST_ATTRS)}
FROM (SELECT customer_name, {", ".join(_CUST_ATTRS)} FROM (
        SELECT *, row_number() OVER (PARTITION BY customer_name
                                     ORDER BY {order_by_all([], _CUST_ATTRS)}) AS rn
        FROM silver_sales) WHERE rn = 1)"""
CTES["dim_sales_rep"] = """
SELECT CAST(row_number() OVER (ORDER BY name_of_sales_rep NULLS FIRST, manager NULLS FIRST, sales_team NULLS FIRST) AS BIGINT) AS sales_rep_sk,
       name_of_sales_rep AS sales_rep_name, manager, sales_team
FROM (SELECT DISTINCT name_of_sales_rep, manager, sales_team FROM silver_sales
      WHERE name_of_sales_rep IS NOT NULL)"""
CTES["fact_sales"] = """
SELECT t.time_sk, p.product_sk, c.customer_sk, r.sales_rep_sk, s.quantity AS qty, s.price, s.sales,
       s.channel, s.sub_channel, s.country, s.city
FROM silver_sales s
LEFT JOIN dim_time t ON s.year = t.year AND s.month = t.month
LEFT JOIN dim_product p ON s.product_name = p.product_name
LEFT JOIN dim_customer c ON s.customer_name = c.customer_name
LEFT JOIN dim_sales_rep r ON s.name_of_sales_rep = r.sales_rep_name"""
CTES["fact_orders"] = """
SELECT o.event_id, o.order_id, o.event_ts, p.product_sk, c.customer_sk, o.qty, o.unit_price,
       o.total_amount, o.channel, o.sub_channel, o.country, o.city, o.currency
FROM silver_orders o
LEFT JOIN dim_product p ON o.product_name = p.product_name
LEFT JOIN dim_customer c ON o.customer_name = c.customer_name"""


def with_ctes(body: str, extra: dict[str, str] | None = None) -> str:
    """Full statement: every shared CTE (+ ``extra``), then ``body``."""
    allc = {**CTES, **(extra or {})}
    ctes = ",\n".join(f"{name} AS ({sql})" for name, sql in allc.items())
    return f"WITH {ctes}\n{body}"
