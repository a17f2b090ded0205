"""KPI queries over the Gold star schema (DataFrame API; every top-k has a unique tie-breaker).

Output column names and source labels follow the reference's reports so
dashboards built on them keep working.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.functions.numeric import double_part, exact_part, money_avg, money_sum, money_total, round_half_up, safe_div

# Source labels of the executive summary.
SOURCE_HISTORICAL = "Ventas Históricas"
SOURCE_STREAMING = "Pedidos Streaming"


def _total(c: str = "sales") -> F.Column:
    return round_half_up(money_sum(c), 2)


def _avg(c: str = "sales") -> F.Column:
    return round_half_up(money_avg(c), 2)


def per_key(fact: DataFrame, key: str, money: str = "sales", qty: str | None = "qty") -> DataFrame:
    """Partial totals per dimension key, computed before the fact meets the dimension.

    Catalyst does not push aggregates below joins, so without this a KPI would
    shuffle every fact row by key (a hot key landing in one task) whenever the
    dimension is too large to broadcast.  Grouping by the key first is a
    partial + final aggregate (map-side combine), and the join then sees one row
    per key.  Money is carried as the sums of ``money_sum``'s two parts plus its
    non-NULL count, so the re-aggregated totals equal the one-step ones.
    """
    parts = [F.count(F.lit(1)).alias("_n"), F.sum(exact_part(money)).alias("_msum"),
             F.sum(double_part(money)).alias("_mrest"), F.count(money).alias("_mcnt")]
    if qty:
        parts.append(F.sum(qty).alias("_qty"))
    return fact.groupBy(key).agg(*parts)


def _n() -> F.Column:
    return F.sum("_n")


def _units() -> F.Column:
    return F.sum("_qty")


def _pre_sum() -> F.Column:
    return money_total(F.sum("_msum"), F.sum("_mrest"))


def _pre_total() -> F.Column:
    return round_half_up(_pre_sum(), 2)


def _pre_avg() -> F.Column:
    return round_half_up(safe_div(_pre_sum(), F.sum("_mcnt")), 2)


def sales_by_channel(fact: DataFrame) -> DataFrame:
    return (fact.groupBy("channel").agg(
        F.count(F.lit(1)).alias("num_transacciones"),
        F.sum("qty").alias("unidades_vendidas"),
        _total().alias("ventas_totales"),
        _avg().alias("ticket_medio"))
        .orderBy(F.desc("ventas_totales"), F.asc_nulls_first("channel")))


def sales_by_country(fact: DataFrame) -> DataFrame:
    return (fact.groupBy("country").agg(
        F.count(F.lit(1)).alias("num_transacciones"),
        _total().alias("ventas_totales"),
        _avg().alias("ticket_medio"),
        F.countDistinct("city").alias("ciudades_activas"))
        .orderBy(F.desc("ventas_totales"), F.asc_nulls_first("country")))


def top_products(fact: DataFrame, dim_product: DataFrame, n: int = 10) -> DataFrame:
    return (per_key(fact, "product_sk").join(dim_product, "product_sk")
            .groupBy("product_name", "product_class").agg(
                _n().alias("num_transacciones"),
                _units().alias("unidades_vendidas"),
                _pre_total().alias("ventas_totales"))
            .orderBy(F.desc("ventas_totales"), "product_name", "product_class")
            .limit(n))


def sales_by_class(fact: DataFrame, dim_product: DataFrame) -> DataFrame:
    return (per_key(fact, "product_sk", qty=None).join(dim_product, "product_sk")
            .groupBy("product_class").agg(
                F.countDistinct("product_name").alias("num_productos"),
                _n().alias("num_transacciones"),
                _pre_total().alias("ventas_totales"),
                _pre_avg().alias("ticket_medio"))
            .orderBy(F.desc("ventas_totales"), F.asc_nulls_first("product_class")))


def top_reps(fact: DataFrame, dim_rep: DataFrame, n: int = 10) -> DataFrame:
    return (per_key(fact, "sales_rep_sk", qty=None).join(dim_rep, "sales_rep_sk")
            .groupBy("sales_rep_name", "manager", "sales_team").agg(
                _n().alias("num_transacciones"),
                _pre_total().alias("ventas_totales"),
                _pre_avg().alias("ticket_medio"))
            .orderBy(F.desc("ventas_totales"), "sales_rep_name", "manager", "sales_team")
            .limit(n))


def team_performance(fact: DataFrame, dim_rep: DataFrame) -> DataFrame:
    reps = F.countDistinct("sales_rep_name")
    return (per_key(fact, "sales_rep_sk", qty=None).join(dim_rep, "sales_rep_sk")
            .groupBy("sales_team").agg(
                reps.alias("num_reps"),
                _n().alias("num_transacciones"),
                _pre_total().alias("ventas_totales"),
                round_half_up(safe_div(_pre_sum(), reps), 2).alias("ventas_por_rep"))
            .orderBy(F.desc("ventas_totales"), F.asc_nulls_first("sales_team")))


def quarterly(fact: DataFrame, dim_time: DataFrame) -> DataFrame:
    return (per_key(fact, "time_sk", qty=None).join(dim_time, "time_sk")
            .groupBy("year", "quarter_name", "quarter").agg(
                _n().alias("num_transacciones"),
                _pre_total().alias("ventas_totales"))
            .orderBy("year", "quarter", "quarter_name")
            .select("year", "quarter_name", "num_transacciones", "ventas_totales"))


def top_customers(fact: DataFrame, dim_customer: DataFrame, n: int = 10) -> DataFrame:
    c = dim_customer.select("customer_sk", "customer_name", F.col("city").alias("c_city"),
                            F.col("country").alias("c_country"), F.col("channel").alias("c_channel"))
    return (per_key(fact, "customer_sk", qty=None).join(c, "customer_sk")
            .groupBy(F.col("customer_name"), F.col("c_city").alias("city"),
                     F.col("c_country").alias("country"), F.col("c_channel").alias("channel"))
            .agg(_n().alias("num_transacciones"),
                 _pre_total().alias("compras_totales"))
            .orderBy(F.desc("compras_totales"), "customer_name", "city", "country", "channel")
            .limit(n))


def orders_summary(fact_orders: DataFrame) -> DataFrame:
    return (fact_orders.groupBy("channel", "country").agg(
        F.count(F.lit(1)).alias("num_pedidos"),
        F.sum("qty").alias("unidades_pedidas"),
        _total("total_amount").alias("valor_total"),
        _avg("total_amount").alias("pedido_medio"))
        .orderBy(F.desc("valor_total"), F.asc_nulls_first("channel"), F.asc_nulls_first("country")))


def hist_vs_stream(fact: DataFrame, fact_orders: DataFrame, dim_product: DataFrame,
                   n: int = 15) -> DataFrame:
    p = dim_product.select("product_sk", "product_name")
    hist = (per_key(fact, "product_sk", qty=None).join(p, "product_sk").groupBy("product_name")
            .agg(_pre_sum().alias("ventas_historicas")))
    stream = (per_key(fact_orders, "product_sk", money="total_amount", qty=None).join(p, "product_sk")
              .groupBy(F.col("product_name").alias("s_product_name"))
              .agg(_pre_sum().alias("s_pedidos")))
    joined = hist.join(stream, F.col("product_name") == F.col("s_product_name"), "full_outer")
    return (joined.where(F.col("s_pedidos").isNotNull())
            .select(F.coalesce("product_name", "s_product_name").alias("product_name"),
                    round_half_up(F.coalesce("ventas_historicas", F.lit(0.0)), 2).alias("ventas_historicas"),
                    round_half_up(F.coalesce("s_pedidos", F.lit(0.0)), 2).alias("pedidos_streaming"))
            .orderBy(F.desc("pedidos_streaming"), "product_name")
            .limit(n))


def executive_summary(fact: DataFrame, fact_orders: DataFrame) -> DataFrame:
    h = fact.agg(F.lit(SOURCE_HISTORICAL).alias("fuente"), F.count(F.lit(1)).alias("transacciones"),
                 _total("sales").alias("valor_total"))
    s = fact_orders.agg(F.lit(SOURCE_STREAMING).alias("fuente"), F.count(F.lit(1)).alias("transacciones"),
                        _total("total_amount").alias("valor_total"))
    return h.unionByName(s)


def table_volumes(tables: dict[str, DataFrame]) -> DataFrame:
    """(tabla, registros) for each named table, as one UNION ALL of global counts."""
    parts = [df.agg(F.lit(name).alias("tabla"), F.count(F.lit(1)).alias("registros"))
             for name, df in tables.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def star_join(fact: DataFrame, dim_time: DataFrame, dim_customer: DataFrame,
              dim_product: DataFrame, dim_rep: DataFrame) -> DataFrame:
    """Facts with all four dimensions (the documented analyst query)."""
    return (fact.select("time_sk", "customer_sk", "product_sk", "sales_rep_sk", "qty", "sales")
            .join(dim_customer.select("customer_sk", "customer_name", F.col("country")), "customer_sk")
            .join(dim_product.select("product_sk", "product_name", "product_class"), "product_sk")
            .join(dim_rep.select("sales_rep_sk", "sales_rep_name", "sales_team"), "sales_rep_sk")
            .join(dim_time.select("time_sk", "year", "month"), "time_sk")
            .select("year", "month", "customer_name", "country", "product_name", "product_class",
                    "sales_rep_name", "sales_team", "qty", "sales"))
