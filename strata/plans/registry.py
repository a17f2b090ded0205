"""Named queries (Spark) and their independent DuckDB oracles.

``QUERIES[name](spark, sf_dir) -> DataFrame`` and ``ORACLES[name] -> SQL``.
Every query reads the given tables (or Silver/Gold that Spark derived from
them) in full.  Queries without an oracle are the model fits (K-Means, GBT,
silhouette, approximate quantiles), checked by row counts and ranges.
"""

from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.functions import text as T
from strata.functions.dates import (MONTH_NAMES, month_number, month_number_or_january, month_start,
                                    parse_date_robust)
from strata.functions.keys import dense_key, natural_key
from strata.functions.numeric import round_half_up
from strata.operators import catalog, cleaning, gold, kpis, marts, ml, quality
from strata.operators import silver as S
from strata.plans import oracle as O
from strata.plans.lakehouse import Lakehouse
from strata.schemas import ORDER_EVENT_SCHEMA
from strata.sources import adapter
from strata.sources.tables import Tables, load_safe, read_csv
from strata.session import scratch_path
from strata.streaming import orders as stream

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}
PLAIN: dict[str, str] = {}  # the final SELECT of each oracle
EXTRA: dict[str, dict[str, str]] = {}


def query(name: str, sql: str | None = None, extra: dict[str, str] | None = None):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            PLAIN[name] = sql
            ORACLES[name] = O.with_ctes(sql, extra)
        return fn
    return deco


def lh(spark: SparkSession, sf_dir: str) -> Lakehouse:
    return Lakehouse.get(spark, sf_dir)


r, msum, mavg = O.r, O.msum, O.mavg

# ====================================================================== extra oracle CTEs
# (model-side building blocks; appended after the shared prefix)

ML_CTES: dict[str, str] = {}
ML_CTES["customer_features"] = f"""
SELECT customer_name, {msum('sales')} AS total_sales, CAST(SUM(quantity) AS BIGINT) AS total_qty,
       COUNT(*) AS transaction_count, {r(mavg('sales'))} AS avg_transaction_value,
       AVG(latitude) AS latitude, AVG(longitude) AS longitude
FROM silver_sales GROUP BY customer_name
HAVING {msum('sales')} IS NOT NULL AND {msum('sales')} > 0"""
ML_CTES["banded"] = """
SELECT f.*, CASE WHEN f.total_sales - s.mu < -0.5 * s.sd THEN 0
                 WHEN f.total_sales - s.mu <= 0.5 * s.sd THEN 1 ELSE 2 END AS cluster_id
FROM customer_features f CROSS JOIN (SELECT AVG(total_sales) AS mu, STDDEV_SAMP(total_sales) AS sd
                                     FROM customer_features) s"""
ML_CTES["banded_stats"] = f"""
SELECT cluster_id, COUNT(*) AS num_clientes, {r(mavg('total_sales'))} AS avg_sales,
       {r('AVG(transaction_count)')} AS avg_transactions, {r(mavg('avg_transaction_value'))} AS avg_ticket,
       {r(msum('total_sales'))} AS sum_sales
FROM banded GROUP BY cluster_id"""
_labels_case = "WHEN 1 THEN 'Básico - Bajo Volumen' WHEN 2 THEN 'Regular - Volumen Medio' WHEN 3 THEN 'Premium - Alto Volumen'"
ML_CTES["banded_labels"] = f"""
SELECT *, CASE sales_rank {_labels_case} END AS cluster_label
FROM (SELECT *, row_number() OVER (ORDER BY avg_sales, cluster_id) AS sales_rank FROM banded_stats)"""
ML_CTES["banded_clusters"] = f"""
SELECT b.customer_name AS customer_id, CAST(b.cluster_id AS INTEGER) AS cluster_id, l.cluster_label,
       {r('b.total_sales')} AS total_sales, b.total_qty, b.transaction_count,
       {r('b.avg_transaction_value')} AS avg_transaction_value,
       {r('b.latitude', 6)} AS latitude, {r('b.longitude', 6)} AS longitude
FROM banded b LEFT JOIN banded_labels l ON b.cluster_id = l.cluster_id"""
ML_CTES["monthly"] = f"""
SELECT product_name, country, year, m AS month, make_date(year, m, 1) AS year_month,
       {msum('sales')} AS total_sales, CAST(SUM(quantity) AS BIGINT) AS total_quantity,
       COUNT(*) AS num_transactions, {mavg('price')} AS avg_price
FROM (SELECT *, COALESCE({O.month_num('month')}, 1) AS m FROM silver_sales)
GROUP BY product_name, country, year, m"""
ML_CTES["lagged"] = """
SELECT *,
  LAG(total_sales, 1) OVER w AS lag_1, LAG(total_sales, 2) OVER w AS lag_2, LAG(total_sales, 3) OVER w AS lag_3,
  AVG(total_sales) OVER (w ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS moving_avg_3,
  AVG(total_sales) OVER (w ROWS BETWEEN 5 PRECEDING AND CURRENT ROW) AS moving_avg_6
FROM monthly WINDOW w AS (PARTITION BY product_name, country ORDER BY year_month)"""
ML_CTES["features"] = """
SELECT *, CAST(quarter(year_month) AS INTEGER) AS quarter,
       CASE WHEN quarter(year_month) = 4 THEN 1 ELSE 0 END AS is_q4,
       sin(2 * pi() * month / 12) AS month_sin, cos(2 * pi() * month / 12) AS month_cos
FROM lagged WHERE lag_3 IS NOT NULL"""
ML_CTES["split"] = """
SELECT f.*, CASE WHEN f.year_month < c.split_date THEN 'train' ELSE 'test' END AS split
FROM features f CROSS JOIN (SELECT CAST(MAX(year_month) - INTERVAL 6 MONTH AS DATE) AS split_date FROM features) c"""
ML_CTES["spine"] = """
SELECT product_name, country, CAST(unnest(generate_series(MIN(year_month), MAX(year_month), INTERVAL 1 MONTH)) AS DATE) AS year_month
FROM monthly GROUP BY product_name, country"""
ML_CTES["filled"] = """
SELECT s.product_name, s.country, CAST(year(s.year_month) AS INTEGER) AS year, CAST(month(s.year_month) AS INTEGER) AS month, s.year_month,
       COALESCE(m.total_sales, 0) AS total_sales, COALESCE(m.total_quantity, 0) AS total_quantity, COALESCE(m.num_transactions, 0) AS num_transactions,
       LAST_VALUE(m.avg_price IGNORE NULLS) OVER (PARTITION BY s.product_name, s.country ORDER BY s.year_month) AS avg_price, m.year_month IS NULL AS filled
FROM spine s LEFT JOIN monthly m ON m.product_name IS NOT DISTINCT FROM s.product_name AND m.country IS NOT DISTINCT FROM s.country AND m.year_month = s.year_month"""
ML_CTES["naive_pred"] = "SELECT *, lag_1 AS predicted_sales FROM split WHERE split = 'test'"
ML_CTES["naive_metrics"] = """
SELECT SQRT(AVG((total_sales - predicted_sales) * (total_sales - predicted_sales))) AS rmse,
       AVG(ABS(total_sales - predicted_sales)) AS mae,
       1 - SUM((total_sales - predicted_sales) * (total_sales - predicted_sales)) / (VAR_POP(total_sales) * COUNT(*)) AS r2,
       COUNT(*) AS n
FROM naive_pred"""
ML_CTES["naive_forecast"] = """
SELECT p.product_name, p.country, p.year, p.month, p.year_month AS forecast_date, p.total_sales AS actual_sales,
       p.predicted_sales, p.total_quantity, p.num_transactions, p.lag_1, p.moving_avg_3,
       ABS(p.total_sales - p.predicted_sales) AS absolute_error,
       CASE WHEN p.total_sales > 0 THEN ABS(p.total_sales - p.predicted_sales) / p.total_sales * 100 ELSE 0.0 END AS percentage_error,
       CASE WHEN p.total_sales > 0 THEN (1 - ABS(p.total_sales - p.predicted_sales) / p.total_sales) * 100 ELSE 100.0 END AS forecast_accuracy,
       m.rmse AS model_rmse, m.mae AS model_mae, m.r2 AS model_r2, 'NaiveLag1' AS model_type
FROM naive_pred p CROSS JOIN naive_metrics m"""

_MARTS: dict[str, str] = {}
_MARTS["mart_product"] = f"""
SELECT p.product_sk, p.product_name, p.product_class,
  COUNT(DISTINCT f.customer_sk) AS customers_reached, COUNT(DISTINCT f.sales_rep_sk) AS sales_reps_selling,
  COUNT(*) AS total_transactions, {r(msum('f.sales'))} AS total_sales, {r(mavg('f.sales'))} AS avg_transaction_value,
  CAST(SUM(f.qty) AS BIGINT) AS total_units_sold, {r(mavg('f.price'))} AS avg_price,
  COUNT(DISTINCT f.country) AS countries_sold, COUNT(DISTINCT f.city) AS cities_sold,
  {r(msum('f.sales') + ' / NULLIF(SUM(f.qty), 0)')} AS revenue_per_unit,
  {r(msum('f.sales') + ' / NULLIF(COUNT(DISTINCT f.customer_sk), 0)')} AS sales_per_customer
FROM fact_sales f JOIN dim_product p ON f.product_sk = p.product_sk
GROUP BY p.product_sk, p.product_name, p.product_class"""
_MARTS["mart_rep"] = f"""
SELECT d.sales_rep_sk, d.sales_rep_name, d.manager, d.sales_team,
  COUNT(DISTINCT f.customer_sk) AS total_customers, COUNT(*) AS total_transactions,
  {r(msum('f.sales'))} AS total_sales, {r(mavg('f.sales'))} AS avg_transaction_value,
  CAST(SUM(f.qty) AS BIGINT) AS total_units_sold,
  {r(msum('f.sales') + ' / NULLIF(COUNT(DISTINCT f.customer_sk), 0)')} AS sales_per_customer,
  COUNT(DISTINCT f.product_sk) AS products_sold, COUNT(DISTINCT f.city) AS cities_covered
FROM fact_sales f JOIN dim_sales_rep d ON f.sales_rep_sk = d.sales_rep_sk
GROUP BY d.sales_rep_sk, d.sales_rep_name, d.manager, d.sales_team"""
_MARTS["mart_geo"] = f"""
SELECT c.country, c.city,
  COUNT(DISTINCT c.customer_sk) AS total_customers, COUNT(DISTINCT f.sales_rep_sk) AS sales_reps_active,
  COUNT(*) AS total_transactions, {r(msum('f.sales'))} AS total_sales, {r(mavg('f.sales'))} AS avg_transaction_value,
  CAST(SUM(f.qty) AS BIGINT) AS total_units_sold, COUNT(DISTINCT f.product_sk) AS products_sold,
  {r(msum('f.sales') + ' / NULLIF(COUNT(DISTINCT c.customer_sk), 0)')} AS sales_per_customer,
  {r(msum('f.sales') + ' / NULLIF(COUNT(*), 0)')} AS avg_ticket,
  {r('AVG(c.latitude)', 6)} AS avg_latitude, {r('AVG(c.longitude)', 6)} AS avg_longitude
FROM fact_sales f JOIN dim_customer c ON f.customer_sk = c.customer_sk
GROUP BY c.country, c.city"""
_MARTS["mart_cluster"] = f"""
SELECT *, {r('total_cluster_sales * 100.0 / SUM(total_cluster_sales) OVER ()')} AS pct_of_total_sales,
          {r('num_customers * 100.0 / SUM(num_customers) OVER ()')} AS pct_of_total_customers
FROM (SELECT cluster_label, COUNT(*) AS num_customers, {r(mavg('total_sales'))} AS avg_sales_per_customer,
             {r(msum('total_sales'))} AS total_cluster_sales, {r('AVG(transaction_count)')} AS avg_transactions,
             {r(mavg('avg_transaction_value'))} AS avg_ticket, {r('AVG(total_qty)')} AS avg_quantity,
             {r('MIN(total_sales)')} AS min_sales, {r('MAX(total_sales)')} AS max_sales
      FROM banded_clusters GROUP BY cluster_label)"""
_bands = "WHEN product_accuracy_pct >= 90 THEN 'Excelente' WHEN product_accuracy_pct >= 80 THEN 'Bueno' WHEN product_accuracy_pct >= 70 THEN 'Aceptable'"
_MARTS["mart_forecast"] = f"""
SELECT *, CASE {_bands} ELSE 'Necesita mejora' END AS accuracy_category
FROM (SELECT product_name, COUNT(*) AS num_predictions, {r(mavg('actual_sales'))} AS avg_actual_sales,
             {r('AVG(predicted_sales)')} AS avg_predicted_sales, {r('AVG(percentage_error)')} AS product_mape,
             {r('AVG(forecast_accuracy)')} AS product_accuracy_pct, {r(msum('actual_sales'))} AS total_actual_sales,
             {r('SUM(predicted_sales)')} AS total_predicted_sales,
             {r('MAX(model_r2)', 6)} AS model_r2, {r('MAX(model_rmse)', 6)} AS model_rmse
      FROM naive_forecast GROUP BY product_name)"""

ALL_EXTRA = {**ML_CTES, **_MARTS}


def q(name: str, sql: str | None = None):
    """Register with the model/mart CTEs available to the oracle."""
    return query(name, sql, ALL_EXTRA if sql is not None else None)


# ====================================================================== KPIs (Q1-Q12)

@q("kpi_sales_by_channel", f"""
SELECT channel, COUNT(*) AS num_transacciones, CAST(SUM(qty) AS BIGINT) AS unidades_vendidas,
       {r(msum('sales'))} AS ventas_totales, {r(mavg('sales'))} AS ticket_medio
FROM fact_sales GROUP BY channel""")
def kpi_sales_by_channel(spark, sf):
    return kpis.sales_by_channel(lh(spark, sf).fact_sales())


@q("kpi_sales_by_country", f"""
SELECT country, COUNT(*) AS num_transacciones, {r(msum('sales'))} AS ventas_totales,
       {r(mavg('sales'))} AS ticket_medio, COUNT(DISTINCT city) AS ciudades_activas
FROM fact_sales GROUP BY country""")
def kpi_sales_by_country(spark, sf):
    return kpis.sales_by_country(lh(spark, sf).fact_sales())


@q("kpi_top_products", f"""
SELECT p.product_name, p.product_class, COUNT(*) AS num_transacciones,
       CAST(SUM(f.qty) AS BIGINT) AS unidades_vendidas, {r(msum('f.sales'))} AS ventas_totales
FROM fact_sales f JOIN dim_product p ON f.product_sk = p.product_sk
GROUP BY p.product_name, p.product_class
ORDER BY ventas_totales DESC, p.product_name, p.product_class LIMIT 10""")
def kpi_top_products(spark, sf):
    h = lh(spark, sf)
    return kpis.top_products(h.fact_sales(), h.dim_product())


# The SQL entry point: the same text runs on Spark over the Lakehouse's temp views
# and, as the oracle, on DuckDB over the independently built tables.
SQL_TOP_PRODUCTS = """
SELECT p.product_name, p.product_class, COUNT(*) AS num_transacciones, CAST(SUM(f.qty) AS BIGINT) AS unidades_vendidas,
       CAST(ROUND(SUM(CAST(f.sales AS DECIMAL(28,10))), 2) AS DOUBLE) AS ventas_totales
FROM fact_sales f JOIN dim_product p ON f.product_sk = p.product_sk
GROUP BY p.product_name, p.product_class
ORDER BY ventas_totales DESC, p.product_name, p.product_class LIMIT 10"""


@q("sql_kpi_top_products", SQL_TOP_PRODUCTS)
def sql_kpi_top_products(spark, sf):
    lh(spark, sf).register_views(["fact_sales", "dim_product"])
    return spark.sql(SQL_TOP_PRODUCTS)


@q("kpi_sales_by_class", f"""
SELECT p.product_class, COUNT(DISTINCT p.product_name) AS num_productos, COUNT(*) AS num_transacciones,
       {r(msum('f.sales'))} AS ventas_totales, {r(mavg('f.sales'))} AS ticket_medio
FROM fact_sales f JOIN dim_product p ON f.product_sk = p.product_sk GROUP BY p.product_class""")
def kpi_sales_by_class(spark, sf):
    h = lh(spark, sf)
    return kpis.sales_by_class(h.fact_sales(), h.dim_product())


@q("kpi_top_reps", f"""
SELECT sr.sales_rep_name, sr.manager, sr.sales_team, COUNT(*) AS num_transacciones,
       {r(msum('f.sales'))} AS ventas_totales, {r(mavg('f.sales'))} AS ticket_medio
FROM fact_sales f JOIN dim_sales_rep sr ON f.sales_rep_sk = sr.sales_rep_sk
GROUP BY sr.sales_rep_name, sr.manager, sr.sales_team
ORDER BY ventas_totales DESC, sr.sales_rep_name, sr.manager, sr.sales_team LIMIT 10""")
def kpi_top_reps(spark, sf):
    h = lh(spark, sf)
    return kpis.top_reps(h.fact_sales(), h.dim_sales_rep())


@q("kpi_team_performance", f"""
SELECT sr.sales_team, COUNT(DISTINCT sr.sales_rep_name) AS num_reps, COUNT(*) AS num_transacciones,
       {r(msum('f.sales'))} AS ventas_totales,
       {r(msum('f.sales') + ' / COUNT(DISTINCT sr.sales_rep_name)')} AS ventas_por_rep
FROM fact_sales f JOIN dim_sales_rep sr ON f.sales_rep_sk = sr.sales_rep_sk GROUP BY sr.sales_team""")
def kpi_team_performance(spark, sf):
    h = lh(spark, sf)
    return kpis.team_performance(h.fact_sales(), h.dim_sales_rep())


@q("kpi_quarterly", f"""
SELECT t.year, t.quarter_name, COUNT(*) AS num_transacciones, {r(msum('f.sales'))} AS ventas_totales
FROM fact_sales f JOIN dim_time t ON f.time_sk = t.time_sk GROUP BY t.year, t.quarter_name, t.quarter""")
def kpi_quarterly(spark, sf):
    h = lh(spark, sf)
    return kpis.quarterly(h.fact_sales(), h.dim_time())


@q("kpi_top_customers", f"""
SELECT c.customer_name, c.city, c.country, c.channel, COUNT(*) AS num_transacciones,
       {r(msum('f.sales'))} AS compras_totales
FROM fact_sales f JOIN dim_customer c ON f.customer_sk = c.customer_sk
GROUP BY c.customer_name, c.city, c.country, c.channel
ORDER BY compras_totales DESC, c.customer_name, c.city, c.country, c.channel LIMIT 10""")
def kpi_top_customers(spark, sf):
    h = lh(spark, sf)
    return kpis.top_customers(h.fact_sales(), h.dim_customer())


@q("kpi_orders_summary", f"""
SELECT channel, country, COUNT(*) AS num_pedidos, CAST(SUM(qty) AS BIGINT) AS unidades_pedidas,
       {r(msum('total_amount'))} AS valor_total, {r(mavg('total_amount'))} AS pedido_medio
FROM fact_orders GROUP BY channel, country""")
def kpi_orders_summary(spark, sf):
    return kpis.orders_summary(lh(spark, sf).fact_orders())


@q("kpi_hist_vs_stream", f"""
SELECT product_name, {r("COALESCE(MAX(total) FILTER (WHERE kind = 'sales'), 0.0)")} AS ventas_historicas,
       {r("MAX(total) FILTER (WHERE kind = 'orders')")} AS pedidos_streaming
FROM (SELECT product_name, kind, {msum('amount')} AS total
      FROM (SELECT product_sk, 'sales' AS kind, sales AS amount FROM fact_sales
            UNION ALL SELECT product_sk, 'orders', total_amount FROM fact_orders) JOIN dim_product USING (product_sk)
      GROUP BY product_name, kind)
GROUP BY product_name HAVING MAX(total) FILTER (WHERE kind = 'orders') IS NOT NULL
ORDER BY pedidos_streaming DESC, product_name LIMIT 15""")
def kpi_hist_vs_stream(spark, sf):
    h = lh(spark, sf)
    return kpis.hist_vs_stream(h.fact_sales(), h.fact_orders(), h.dim_product())


@q("kpi_executive_summary", f"""
SELECT '{kpis.SOURCE_HISTORICAL}' AS fuente, COUNT(*) AS transacciones, {r(msum('sales'))} AS valor_total FROM fact_sales
UNION ALL
SELECT '{kpis.SOURCE_STREAMING}' AS fuente, COUNT(*) AS transacciones, {r(msum('total_amount'))} AS valor_total FROM fact_orders""")
def kpi_executive_summary(spark, sf):
    h = lh(spark, sf)
    return kpis.executive_summary(h.fact_sales(), h.fact_orders())


@q("table_volumes", """
SELECT 'fact_sales' AS tabla, COUNT(*) AS registros FROM fact_sales
UNION ALL SELECT 'dim_customer', COUNT(*) FROM dim_customer
UNION ALL SELECT 'dim_product', COUNT(*) FROM dim_product
UNION ALL SELECT 'ml_customer_clusters', COUNT(*) FROM customer_features
UNION ALL SELECT 'ml_demand_forecast', COUNT(*) FROM split WHERE split = 'test'""")
def table_volumes(spark, sf):
    h = lh(spark, sf)
    return kpis.table_volumes({
        "fact_sales": h.fact_sales(), "dim_customer": h.dim_customer(), "dim_product": h.dim_product(),
        "ml_customer_clusters": h.ml_customer_clusters(), "ml_demand_forecast": h.ml_demand_forecast()})


_GOLD = ("dim_time", "dim_product", "dim_customer", "dim_sales_rep", "fact_sales", "fact_orders")


@q("gold_row_counts", " UNION ALL ".join(f"SELECT '{t}' AS tabla, COUNT(*) AS registros FROM {t}" for t in _GOLD))
def gold_row_counts(spark, sf):
    h = lh(spark, sf)
    return kpis.table_volumes({t: getattr(h, t)() for t in _GOLD})


@q("star_join_all_dims", """
SELECT t.year, t.month, c.customer_name, c.country, p.product_name, p.product_class,
       r.sales_rep_name, r.sales_team, f.qty, f.sales
FROM fact_sales f JOIN dim_customer c ON f.customer_sk = c.customer_sk
JOIN dim_product p ON f.product_sk = p.product_sk
JOIN dim_sales_rep r ON f.sales_rep_sk = r.sales_rep_sk
JOIN dim_time t ON f.time_sk = t.time_sk""")
def star_join_all_dims(spark, sf):
    h = lh(spark, sf)
    return kpis.star_join(h.fact_sales(), h.dim_time(), h.dim_customer(), h.dim_product(), h.dim_sales_rep())


_FK = ["time_sk", "product_sk", "customer_sk", "sales_rep_sk"]


@q("fact_sales_keys", "SELECT COUNT(*) AS fact_rows, " + ", ".join(
    f"COUNT(*) FILTER (WHERE {k} IS NULL) AS null_{k}, COUNT(DISTINCT {k}) AS distinct_{k}" for k in _FK)
   + " FROM fact_sales")
def fact_sales_keys(spark, sf):
    f = lh(spark, sf).fact_sales()
    aggs = [F.count(F.lit(1)).alias("fact_rows")]
    for k in _FK:
        aggs += [F.count_if(F.col(k).isNull()).alias(f"null_{k}"), F.countDistinct(k).alias(f"distinct_{k}")]
    return f.agg(*aggs)


# ====================================================================== marts (D1-D6)

@q("mart_product_performance", "SELECT * FROM mart_product")
def mart_product_performance(spark, sf):
    return lh(spark, sf).mart("mart_product_performance")


@q("mart_sales_rep_performance", "SELECT * FROM mart_rep")
def mart_sales_rep_performance(spark, sf):
    return lh(spark, sf).mart("mart_sales_rep_performance")


@q("mart_geographic_analysis", "SELECT * FROM mart_geo")
def mart_geographic_analysis(spark, sf):
    return lh(spark, sf).mart("mart_geographic_analysis")


def _banded_clusters(spark, sf) -> DataFrame:
    return lh(spark, sf).banded_clusters()


def _naive(spark, sf) -> DataFrame:
    return lh(spark, sf).naive_forecast()


@q("mart_cluster_analysis", "SELECT * FROM mart_cluster")
def mart_cluster_analysis(spark, sf):
    return lh(spark, sf).mart("mart_cluster_analysis")


def _round_model_cols(df: DataFrame) -> DataFrame:
    return df.withColumns({c: round_half_up(c, 6) for c in ("model_r2", "model_rmse") if c in df.columns})


@q("mart_forecast_analysis", "SELECT * FROM mart_forecast")
def mart_forecast_analysis(spark, sf):
    return _round_model_cols(lh(spark, sf).mart("mart_forecast_analysis"))


# The same marts over the real model outputs (K-Means segments, GBT predictions): what
# the reference's marts read.  Model-dependent, so they have no SQL oracle; the tests
# check their invariants.
@q("mart_cluster_analysis_kmeans")
def mart_cluster_analysis_kmeans(spark, sf):
    return lh(spark, sf).mart("mart_cluster_analysis_kmeans")


@q("mart_forecast_analysis_gbt")
def mart_forecast_analysis_gbt(spark, sf):
    return lh(spark, sf).mart("mart_forecast_analysis_gbt")


@q("forecast_accuracy_by_country", f"""
SELECT country, COUNT(*) AS num_predictions, {r('AVG(forecast_accuracy)')} AS avg_accuracy,
       {r('AVG(percentage_error)')} AS mape
FROM naive_forecast GROUP BY country""")
def forecast_accuracy_by_country(spark, sf):
    return marts.forecast_accuracy_by_country(_naive(spark, sf))


@q("stg_sales", "SELECT customer_name, city, country, latitude, longitude, channel, sub_channel, "
                "product_name, product_class, quantity, price, sales, month, year, distributor, "
                "name_of_sales_rep AS sales_rep, manager, sales_team FROM silver_sales")
def stg_sales(spark, sf):
    return marts.staging_sales(lh(spark, sf).silver_sales())


# ====================================================================== ML (M1-M14)

@q("customer_features", "SELECT * FROM customer_features")
def customer_features(spark, sf):
    return ml.customer_features(lh(spark, sf).silver_sales())


@q("scaled_features", "SELECT customer_name, " + ", ".join(
    r(f"(CAST({c} AS DOUBLE) - AVG({c}) OVER ()) / STDDEV_SAMP({c}) OVER ()", 6) + f" AS z_{c}"
    for c in ml.CLUSTER_FEATURES) + " FROM customer_features")
def scaled_features(spark, sf):
    return ml.scaled_columns(ml.scale_features(ml.customer_features(lh(spark, sf).silver_sales())))


@q("ml_customer_clusters")
def ml_customer_clusters(spark, sf):
    return lh(spark, sf).ml_customer_clusters()


@q("ml_silhouette")
def ml_silhouette(spark, sf):
    """The silhouette of the stored segments over the features they were made from."""
    stored = lh(spark, sf).ml_customer_clusters()
    scaled = ml.scale_features(stored.withColumn("customer_name", F.col("customer_id")))
    counts = stored.agg(F.count(F.lit(1)).alias("customers"), F.countDistinct("cluster_id").alias("clusters"))
    return counts.select(F.lit(ml.silhouette(scaled)).alias("silhouette"), "customers", "clusters")


@q("cluster_stats", "SELECT * FROM banded_stats")
def cluster_stats(spark, sf):
    return ml.cluster_stats(ml.banded_assign(ml.customer_features(lh(spark, sf).silver_sales())))


@q("cluster_label_by_rank", "SELECT cluster_id, avg_sales, sales_rank, cluster_label FROM banded_labels")
def cluster_label_by_rank(spark, sf):
    preds = ml.banded_assign(ml.customer_features(lh(spark, sf).silver_sales()))
    return ml.cluster_labels(ml.cluster_stats(preds)).select(
        "cluster_id", "avg_sales", F.col("sales_rank").cast("bigint").alias("sales_rank"), "cluster_label")


@q("cluster_profile", f"""
SELECT cluster_id, cluster_label, COUNT(*) AS n, {r(mavg('total_sales'))} AS avg_sales,
       {r('AVG(transaction_count)')} AS avg_trans, {r(mavg('avg_transaction_value'))} AS avg_ticket
FROM banded_clusters GROUP BY cluster_id, cluster_label""")
def cluster_profile(spark, sf):
    return ml.cluster_profile(_banded_clusters(spark, sf))


@q("monthly_demand", "SELECT * FROM monthly")
def monthly_demand(spark, sf):
    return ml.monthly_demand(lh(spark, sf).silver_sales())


@q("lag_features", "SELECT product_name, country, year_month, total_sales, lag_1, lag_2, lag_3 FROM lagged")
def lag_features(spark, sf):
    return ml.lag_features(ml.monthly_demand(lh(spark, sf).silver_sales())).select(
        "product_name", "country", "year_month", "total_sales", "lag_1", "lag_2", "lag_3")


@q("moving_averages", f"SELECT product_name, country, year_month, {r('moving_avg_3', 6)} AS moving_avg_3, "
                      f"{r('moving_avg_6', 6)} AS moving_avg_6 FROM lagged")
def moving_averages(spark, sf):
    m = ml.moving_averages(ml.monthly_demand(lh(spark, sf).silver_sales()))
    return m.select("product_name", "country", "year_month", round_half_up("moving_avg_3", 6).alias("moving_avg_3"),
                    round_half_up("moving_avg_6", 6).alias("moving_avg_6"))


_FEAT_ROUND = ["moving_avg_3", "moving_avg_6", "month_sin", "month_cos", "avg_price"]


@q("forecast_features", "SELECT product_name, country, year, month, year_month, total_sales, total_quantity, "
   "num_transactions, lag_1, lag_2, lag_3, quarter, is_q4, "
   + ", ".join(f"{r(c, 6)} AS {c}" for c in _FEAT_ROUND) + " FROM features")
def forecast_features(spark, sf):
    f = ml.forecast_features(ml.monthly_demand(lh(spark, sf).silver_sales()))
    return f.withColumns({c: round_half_up(c, 6) for c in _FEAT_ROUND})


@q("lag_features_filled", f"""
SELECT product_name, country, year, month, year_month, total_sales, total_quantity, num_transactions, {r('avg_price', 6)} AS avg_price, filled,
       LAG(total_sales, 1) OVER w AS lag_1, LAG(total_sales, 2) OVER w AS lag_2, LAG(total_sales, 3) OVER w AS lag_3
FROM filled WINDOW w AS (PARTITION BY product_name, country ORDER BY year_month)""")
def lag_features_filled(spark, sf):
    """Lags by month: the series with their missing months filled."""
    filled = ml.lag_features(ml.fill_gaps(ml.monthly_demand(lh(spark, sf).silver_sales())))
    return filled.withColumn("avg_price", round_half_up("avg_price", 6))


@q("forecast_features_leak_free", f"""
SELECT product_name, country, year_month, total_sales, lag_1, lag_2, lag_3, {r('moving_avg_3', 6)} AS moving_avg_3, {r('moving_avg_6', 6)} AS moving_avg_6,
       prior_quantity, {r('prior_price', 6)} AS prior_price
FROM (SELECT product_name, country, year_month, total_sales, LAG(total_sales, 1) OVER w AS lag_1, LAG(total_sales, 2) OVER w AS lag_2, LAG(total_sales, 3) OVER w AS lag_3,
             AVG(total_sales) OVER (w ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING) AS moving_avg_3,
             AVG(total_sales) OVER (w ROWS BETWEEN 6 PRECEDING AND 1 PRECEDING) AS moving_avg_6,
             LAG(total_quantity) OVER w AS prior_quantity, LAG(avg_price) OVER w AS prior_price
      FROM monthly WINDOW w AS (PARTITION BY product_name, country ORDER BY year_month))
WHERE lag_3 IS NOT NULL""")
def forecast_features_leak_free(spark, sf):
    """Features that end before the month to be forecast."""
    f = ml.forecast_features(ml.monthly_demand(lh(spark, sf).silver_sales()), leak_free=True)
    f = f.withColumns({c: round_half_up(c, 6) for c in ("moving_avg_3", "moving_avg_6", "prior_price")})
    return f.select("product_name", "country", "year_month", "total_sales", "lag_1", "lag_2", "lag_3", "moving_avg_3", "moving_avg_6", "prior_quantity", "prior_price")


@q("ml_forecast_leakage")
def ml_forecast_leakage(spark, sf):
    """The fit of the forecast with and without features of the target month, side by side."""
    h = lh(spark, sf)
    forms = [(h.ml_demand_forecast(), "with the target month"), (h.leak_free_forecast(), "leak-free")]
    parts = [f.agg(F.count(F.lit(1)).alias("predictions"), *[F.max(f"model_{m}").alias(m) for m in ("r2", "rmse", "mae")]).select(F.lit(name).alias("features"), "*") for f, name in forms]
    return quality.suite(parts)


@q("forecast_time_split", "SELECT product_name, country, year_month, total_sales, split FROM split")
def forecast_time_split(spark, sf):
    f = ml.forecast_features(ml.monthly_demand(lh(spark, sf).silver_sales()))
    return ml.split_train_test(f).select("product_name", "country", "year_month", "total_sales", "split")


@q("ml_demand_forecast")
def ml_demand_forecast(spark, sf):
    return lh(spark, sf).ml_demand_forecast()


@q("regression_metrics", f"SELECT {r('rmse', 6)} AS rmse, {r('mae', 6)} AS mae, {r('r2', 6)} AS r2, n FROM naive_metrics")
def regression_metrics(spark, sf):
    split = ml.split_train_test(ml.forecast_features(ml.monthly_demand(lh(spark, sf).silver_sales())))
    m = ml.regression_metrics(ml.naive_forecast(split))
    return m.select(*[round_half_up(c, 6).alias(c) for c in ("rmse", "mae", "r2")], "n")


@q("forecast_errors", "SELECT product_name, country, forecast_date, actual_sales, predicted_sales, "
   f"absolute_error, {r('percentage_error', 6)} AS percentage_error, "
   f"{r('forecast_accuracy', 6)} AS forecast_accuracy FROM naive_forecast")
def forecast_errors(spark, sf):
    f = _naive(spark, sf)
    return f.select("product_name", "country", "forecast_date", "actual_sales", "predicted_sales",
                    "absolute_error", round_half_up("percentage_error", 6).alias("percentage_error"),
                    round_half_up("forecast_accuracy", 6).alias("forecast_accuracy"))


@q("forecast_summary", f"""
SELECT COUNT(*) AS total_predictions, COUNT(DISTINCT product_name) AS unique_products,
       COUNT(DISTINCT country) AS unique_countries, {r('AVG(forecast_accuracy)', 6)} AS avg_accuracy,
       {r('AVG(percentage_error)', 6)} AS avg_error_pct, {r('MAX(model_rmse)', 6)} AS rmse,
       {r('MAX(model_r2)', 6)} AS r2
FROM naive_forecast""")
def forecast_summary(spark, sf):
    s = ml.forecast_summary(_naive(spark, sf))
    return s.withColumns({c: round_half_up(c, 6) for c in ("avg_accuracy", "avg_error_pct", "rmse", "r2")})


@q("forecast_best_products", f"""
SELECT product_name, {r('AVG(forecast_accuracy)', 6)} AS avg_accuracy, {msum('actual_sales')} AS total_sales
FROM naive_forecast GROUP BY product_name ORDER BY AVG(forecast_accuracy) DESC, product_name LIMIT 5""")
def forecast_best_products(spark, sf):
    b = ml.best_forecast_products(_naive(spark, sf))
    return b.withColumn("avg_accuracy", round_half_up("avg_accuracy", 6))


_SUMMARY = ["total_sales", "transaction_count", "avg_transaction_value"]
_QUARTILES = {"25%": 0.25, "50%": 0.5, "75%": 0.75}


@q("feature_summary", " UNION ALL ".join(
    [f"SELECT '{n}' AS summary, " + ", ".join(f"CAST({n}({c}) AS DOUBLE) AS {c}" for c in _SUMMARY) + " FROM customer_features" for n in ("min", "max")]
    + [f"SELECT '{n}' AS summary, " + ", ".join(f"(SELECT CAST(MIN({c}) AS DOUBLE) FROM (SELECT {c}, row_number() OVER (ORDER BY {c}) AS rn, COUNT(*) OVER () AS n "
       f"FROM customer_features) WHERE rn >= {p} * n) AS {c}" for c in _SUMMARY) for n, p in _QUARTILES.items()]))
def feature_summary(spark, sf):
    """Five-number summary of three customer features (rank error of a quartile: a millionth of the rows)."""
    feats = ml.customer_features(lh(spark, sf).silver_sales())
    return ml.five_numbers(feats, _SUMMARY, _QUARTILES)


# ====================================================================== Silver / Gold (G0-G6)

@q("silver_sales", "SELECT * FROM silver_sales")
def silver_sales(spark, sf):
    return lh(spark, sf).silver_sales()


@q("silver_orders", "SELECT * FROM silver_orders")
def silver_orders(spark, sf):
    return lh(spark, sf).silver_orders()


@q("silver_orders_legacy", "SELECT * FROM silver_orders_legacy")
def silver_orders_legacy(spark, sf):
    return S.silver_orders(lh(spark, sf).bronze_orders_legacy())


@q("silver_shipments", "SELECT * FROM silver_shipments")
def silver_shipments(spark, sf):
    return lh(spark, sf).silver_shipments()


@q("dim_time", "SELECT * FROM dim_time")
def dim_time(spark, sf):
    return lh(spark, sf).dim_time()


@q("dim_time_calendar", """
SELECT time_sk, year, month, month_num AS month_number, quarter,
       CAST((month_num - 1) // 6 + 1 AS INTEGER) AS semester,
       CAST(year AS VARCHAR) || '-' || lpad(CAST(month_num AS VARCHAR), 2, '0') AS year_month,
       quarter = 4 AS is_q4
FROM dim_time""")
def dim_time_calendar(spark, sf):
    return gold.calendar_attributes(lh(spark, sf).dim_time())


@q("dim_product", "SELECT * FROM dim_product")
def dim_product(spark, sf):
    return lh(spark, sf).dim_product()


@q("dim_customer", "SELECT * FROM dim_customer")
def dim_customer(spark, sf):
    return lh(spark, sf).dim_customer()


_HISTORY = "city, country, latitude, longitude, channel, sub_channel"


@q("dim_customer_history", f"""
SELECT customer_name, {_HISTORY}, _valid_from, LEAD(_valid_from) OVER w AS _valid_to, LEAD(1) OVER w IS NULL AS _is_current
FROM (SELECT customer_name, {_HISTORY}, MIN(make_date(year, COALESCE({O.month_num('month')}, 1), 1)) AS _valid_from
      FROM silver_sales GROUP BY customer_name, {_HISTORY})
WINDOW w AS (PARTITION BY customer_name ORDER BY _valid_from NULLS FIRST, {", ".join(c + " NULLS FIRST" for c in _HISTORY.split(", "))})""")
def dim_customer_history(spark, sf):
    return gold.customer_history(lh(spark, sf).silver_sales())


@q("fn_country_name", """
SELECT n_nationkey, left(n_name, 2) AS code, CASE left(n_name, 2) WHEN 'AR' THEN 'Argentina' WHEN 'BR' THEN 'Brazil' WHEN 'CA' THEN 'Canada'
  WHEN 'CN' THEN 'China' WHEN 'DE' THEN 'Germany' WHEN 'EG' THEN 'Egypt' WHEN 'ET' THEN 'Ethiopia' WHEN 'FR' THEN 'France' WHEN 'IN' THEN 'India'
  WHEN 'IR' THEN 'Iran' WHEN 'JO' THEN 'Jordan' WHEN 'KE' THEN 'Kenya' WHEN 'MO' THEN 'MO' WHEN 'PE' THEN 'Peru' WHEN 'RO' THEN 'Romania'
  WHEN 'RU' THEN 'Russia' WHEN 'SA' THEN 'Saudi Arabia' ELSE left(n_name, 2) END AS country FROM nation""")
def fn_country_name(spark, sf):
    code = F.substring("n_name", 1, 2)
    return Tables(spark, sf).nation.select("n_nationkey", code.alias("code"), T.country_name(code).alias("country"))


@q("dim_sales_rep", "SELECT * FROM dim_sales_rep")
def dim_sales_rep(spark, sf):
    return lh(spark, sf).dim_sales_rep()


@q("fact_sales", "SELECT * FROM fact_sales")
def fact_sales(spark, sf):
    """Fact rows without ``sale_sk`` (a partition-dependent id)."""
    return lh(spark, sf).fact_sales().drop("sale_sk")


@q("fact_orders", "SELECT * FROM fact_orders")
def fact_orders(spark, sf):
    return lh(spark, sf).fact_orders().drop("order_sk")


@q("surrogate_key", """
SELECT customer_name, product_name,
       CAST(row_number() OVER (ORDER BY customer_name NULLS FIRST, product_name NULLS FIRST) AS BIGINT) AS pair_sk
FROM (SELECT DISTINCT customer_name, product_name FROM silver_sales)""")
def surrogate_key(spark, sf):
    pairs = lh(spark, sf).silver_sales().select("customer_name", "product_name").distinct()
    return dense_key(pairs, ["customer_name", "product_name"], "pair_sk")


# ====================================================================== cleaning operators (P, F, W)

def _bronze_sales(spark, sf) -> DataFrame:
    return lh(spark, sf).bronze_sales().drop(*S.BRONZE_METADATA)


def _bronze_shipments(spark, sf) -> DataFrame:
    return lh(spark, sf).bronze_shipments().drop(*S.BRONZE_METADATA)


@q("bronze_sales", "SELECT *, TRUE AS named, TRUE AS stamped FROM bronze_sales")
def bronze_sales(spark, sf):
    """The Bronze table: each row names the CSV file it came from and when it was read."""
    return lh(spark, sf).bronze_sales().withColumn("named", F.col("_source_file").rlike(r"\.csv(\.gz)?$")).withColumn(
        "stamped", F.col("_ingested_at").isNotNull()).drop(*S.BRONZE_METADATA)


@q("bronze_shipments", "SELECT " + ", ".join(f"NULLIF({c}, '') AS {c}" for c in O.SHIPMENT_RAW_COLS) + ", TRUE AS named, TRUE AS stamped FROM bronze_shipments")
def bronze_shipments(spark, sf):
    return lh(spark, sf).bronze_shipments().withColumn("named", F.col("_source_file").rlike(r"\.csv(\.gz)?$")).withColumn(
        "stamped", F.col("_ingested_at").isNotNull()).drop(*S.BRONZE_METADATA)


@q("proj_normalize_names", "SELECT * FROM bronze_sales")
def proj_normalize_names(spark, sf):
    return _bronze_sales(spark, sf)


@q("proj_normalize_names_strict", "SELECT * FROM bronze_shipments")
def proj_normalize_names_strict(spark, sf):
    return _bronze_shipments(spark, sf)


@q("clean_text_styles", f"""
SELECT customer_name AS raw_customer_name,
       {O.clean('customer_name', 'initcap')} AS customer_initcap,
       {O.clean('customer_name', 'upper')} AS customer_upper,
       {O.clean('customer_name', 'lower')} AS customer_lower,
       {O.trimcase('customer_name', 'initcap')} AS customer_trim_initcap,
       {O.clean('product_name', 'initcap')} AS product_initcap
FROM bronze_sales""")
def clean_text_styles(spark, sf):
    b = _bronze_sales(spark, sf)
    return b.select(F.col("customer_name").alias("raw_customer_name"),
                    T.clean_text("customer_name", "initcap").alias("customer_initcap"),
                    T.clean_text("customer_name", "upper").alias("customer_upper"),
                    T.clean_text("customer_name", "lower").alias("customer_lower"),
                    T.trim_case("customer_name", "initcap").alias("customer_trim_initcap"),
                    T.clean_text("product_name", "initcap").alias("product_initcap"))


@q("cast_bad_to_null", f"""
SELECT id, line_item_quantity AS raw_quantity, {O.to_int('line_item_quantity')} AS line_item_quantity,
       TRY_CAST(weight_kilograms AS DOUBLE) AS weight_kilograms,
       TRY_CAST(freight_cost_usd AS DOUBLE) AS freight_cost_usd,
       TRY_CAST(line_item_value AS DOUBLE) AS line_item_value
FROM bronze_shipments""")
def cast_bad_to_null(spark, sf):
    b = _bronze_shipments(spark, sf)
    return b.select("id", F.col("line_item_quantity").alias("raw_quantity"),
                    cleaning.to_int_lenient("line_item_quantity").alias("line_item_quantity"),
                    cleaning.to_double_lenient("weight_kilograms").alias("weight_kilograms"),
                    cleaning.to_double_lenient("freight_cost_usd").alias("freight_cost_usd"),
                    cleaning.to_double_lenient("line_item_value").alias("line_item_value"))


@q("parse_date_robust", "SELECT id, " + ", ".join(f"{O.robust_date(c)} AS {c}" for c in S.SHIPMENT_RAW_DATES)
   + " FROM bronze_shipments")
def parse_date_robust_q(spark, sf):
    b = _bronze_shipments(spark, sf)
    return b.select("id", *[parse_date_robust(c).alias(c) for c in S.SHIPMENT_RAW_DATES])


@q("shipment_delivery_days", "SELECT shipment_id, scheduled_delivery_date, delivered_to_client_date, "
   "delivery_days FROM silver_shipments")
def shipment_delivery_days(spark, sf):
    return lh(spark, sf).silver_shipments().select(
        "shipment_id", "scheduled_delivery_date", "delivered_to_client_date", "delivery_days")


@q("shipment_late_flag", "SELECT shipment_id, delivery_days, is_late_delivery FROM silver_shipments")
def shipment_late_flag(spark, sf):
    return lh(spark, sf).silver_shipments().select("shipment_id", "delivery_days", "is_late_delivery")


@q("filter_sales_valid", "SELECT * FROM valid_sales")
def filter_sales_valid(spark, sf):
    b = _bronze_sales(spark, sf)
    return S.filter_sales_valid(S.type_sales(S.clean_sales(b))).select(*S.SALES_COLUMNS)


@q("filter_orders_valid", "SELECT * FROM valid_orders")
def filter_orders_valid(spark, sf):
    return S.filter_orders_valid(S.clean_orders(lh(spark, sf).bronze_orders()))


@q("dedup_sales_natural_key", "SELECT " + ", ".join(S.SALES_NATURAL_KEY + ["sales", "quantity", "price"])
   + " FROM silver_sales")
def dedup_sales_natural_key(spark, sf):
    b = _bronze_sales(spark, sf)
    d = S.dedup_sales(S.filter_sales_valid(S.type_sales(S.clean_sales(b))))
    return d.select(*S.SALES_NATURAL_KEY, "sales", "quantity", "price")


@q("dedup_orders_event_id", "SELECT event_id, event_ts, order_id, qty, unit_price FROM dedup_orders")
def dedup_orders_event_id(spark, sf):
    o = S.dedup_orders(S.filter_orders_valid(S.clean_orders(lh(spark, sf).bronze_orders())))
    return o.select("event_id", "event_ts", "order_id", "qty", "unit_price")


# ====================================================================== quality (V1-V9) and metrics

@q("top_countries", f"""
SELECT country, {r(msum('sales'))} AS total_sales FROM silver_sales GROUP BY country
ORDER BY total_sales DESC, country LIMIT 5""")
def top_countries(spark, sf):
    return quality.top_by_sum(lh(spark, sf).silver_sales(), "country", "sales", 5)


@q("freq_by_key", "SELECT channel, COUNT(*) AS count FROM silver_sales GROUP BY channel")
def freq_by_key(spark, sf):
    return quality.frequency(lh(spark, sf).silver_sales(), "channel")


@q("freq_by_year", "SELECT year, COUNT(*) AS count FROM silver_sales GROUP BY year")
def freq_by_year(spark, sf):
    return quality.frequency(lh(spark, sf).silver_sales(), "year", by_key=True)


@q("dq_exact_duplicates", """
SELECT total_records, distinct_records, total_records - distinct_records AS exact_duplicates
FROM (SELECT COUNT(*) AS total_records FROM bronze_sales) a
CROSS JOIN (SELECT COUNT(*) AS distinct_records FROM (SELECT DISTINCT * FROM bronze_sales)) b""")
def dq_exact_duplicates(spark, sf):
    return quality.exact_duplicates(_bronze_sales(spark, sf))


@q("dq_bronze_sales", """
SELECT a.total_records, a.null_quantity, a.null_price, a.total_records - b.d AS exact_duplicates
FROM (SELECT COUNT(*) AS total_records, COUNT(*) FILTER (WHERE quantity IS NULL) AS null_quantity,
             COUNT(*) FILTER (WHERE price IS NULL) AS null_price FROM bronze_sales) a
CROSS JOIN (SELECT COUNT(*) AS d FROM (SELECT DISTINCT * FROM bronze_sales)) b""")
def dq_bronze_sales(spark, sf):
    return quality.bronze_sales_checks(lh(spark, sf).bronze_sales())


@q("dq_non_dates", " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, COUNT(*) FILTER (WHERE {c} IS NULL OR contains({c}, 'Process') "
    f"OR contains({c}, 'Captured')) AS non_dates FROM bronze_shipments" for c in S.SHIPMENT_RAW_DATES))
def dq_non_dates(spark, sf):
    return quality.non_date_counts(_bronze_shipments(spark, sf), S.SHIPMENT_RAW_DATES)


@q("dq_silver_sales", """
SELECT COUNT(*) AS total_records, COUNT(DISTINCT product_name) AS distinct_products,
       COUNT(DISTINCT customer_name) AS distinct_customers, COUNT(DISTINCT country) AS distinct_countries
FROM silver_sales""")
def dq_silver_sales(spark, sf):
    return quality.silver_sales_metrics(lh(spark, sf).silver_sales())


@q("shipment_quality_metrics", f"""
SELECT *, {r('valid_scheduled * 100.0 / NULLIF(total_records, 0)', 1)} AS pct_valid_scheduled,
          {r('valid_delivered * 100.0 / NULLIF(total_records, 0)', 1)} AS pct_valid_delivered
FROM (SELECT COUNT(*) AS total_records, COUNT(scheduled_delivery_date) AS valid_scheduled,
             COUNT(delivered_to_client_date) AS valid_delivered,
             COUNT(*) FILTER (WHERE is_late_delivery) AS late_deliveries FROM silver_shipments)""")
def shipment_quality_metrics(spark, sf):
    return quality.shipment_quality(lh(spark, sf).silver_shipments())


@q("shipment_mode_distribution", "SELECT shipment_mode, COUNT(*) AS count FROM silver_shipments GROUP BY shipment_mode")
def shipment_mode_distribution(spark, sf):
    return quality.frequency(lh(spark, sf).silver_shipments(), "shipment_mode")


@q("shipment_top_countries", "SELECT country, COUNT(*) AS count FROM silver_shipments GROUP BY country "
                             "ORDER BY count DESC, country LIMIT 5")
def shipment_top_countries(spark, sf):
    return quality.top_by_count(lh(spark, sf).silver_shipments(), "country", 5)


@q("shipment_top_product_groups", "SELECT product_group, COUNT(*) AS count FROM silver_shipments "
                                  "GROUP BY product_group ORDER BY count DESC, product_group LIMIT 5")
def shipment_top_product_groups(spark, sf):
    return quality.top_by_count(lh(spark, sf).silver_shipments(), "product_group", 5)


# The declarative suite, 16 not_null, 3 unique, 2 accepted_values (over the five marts).
NOT_NULL = [
    ("mart_sales_rep_performance", ["sales_rep_sk", "sales_rep_name", "total_sales"]),
    ("mart_geographic_analysis", ["country", "city", "total_sales"]),
    ("mart_product_performance", ["product_sk", "product_name", "total_sales"]),
    ("mart_cluster_analysis", ["cluster_label", "num_customers", "total_cluster_sales"]),
    ("mart_forecast_analysis", ["product_name", "product_accuracy_pct", "accuracy_category", "model_r2"]),
]
UNIQUE = [("mart_sales_rep_performance", "sales_rep_sk"), ("mart_product_performance", "product_sk"),
          ("mart_forecast_analysis", "product_name")]
ACCEPTED = [("mart_cluster_analysis", "cluster_label", ml.SEGMENT_LABELS),
            ("mart_forecast_analysis", "accuracy_category",
             [lbl for _, lbl in marts.ACCURACY_BANDS] + [marts.ACCURACY_FALLBACK])]
_MART_CTE = {"mart_sales_rep_performance": "mart_rep", "mart_geographic_analysis": "mart_geo",
             "mart_product_performance": "mart_product", "mart_cluster_analysis": "mart_cluster",
             "mart_forecast_analysis": "mart_forecast"}


def _mart_frames(spark, sf) -> dict[str, DataFrame]:
    """The written marts: a check scans them, nothing is built again."""
    return {n: lh(spark, sf).mart(n) for n in _MART_CTE}


@q("dq_not_null", " UNION ALL ".join(
    f"SELECT '{m}' AS model, '{c}' AS column_name, 'not_null' AS test, "
    f"COUNT(*) FILTER (WHERE {c} IS NULL) AS failures FROM {_MART_CTE[m]}" for m, cols in NOT_NULL for c in cols))
def dq_not_null(spark, sf):
    frames = _mart_frames(spark, sf)
    return quality.suite([quality.not_null_failures(frames[m], m, cols) for m, cols in NOT_NULL])


@q("dq_unique", " UNION ALL ".join(
    f"SELECT '{m}' AS model, '{c}' AS column_name, 'unique' AS test, "
    f"(SELECT COUNT(*) FROM (SELECT {c} FROM {_MART_CTE[m]} WHERE {c} IS NOT NULL GROUP BY {c} "
    f"HAVING COUNT(*) > 1)) AS failures" for m, c in UNIQUE))
def dq_unique(spark, sf):
    frames = _mart_frames(spark, sf)
    return quality.suite([quality.unique_failures(frames[m], m, c) for m, c in UNIQUE])


def _fanout_sql(fact: str, facts: str, dim: str, names: dict[str, str]) -> str:
    keys, known = ", ".join(names), " AND ".join(f"{c} IS NOT NULL" for c in names)
    return (f"SELECT '{fact}' AS fact, '{dim}' AS dimension, COUNT(*) AS repeated_names, CAST(COALESCE(SUM((n - 1) * used), 0) AS BIGINT) AS extra_facts "
            f"FROM (SELECT d.n, (SELECT COUNT(*) FROM {facts} f WHERE {' AND '.join(f'f.{v} = d.{k}' for k, v in names.items())}) AS used "
            f"FROM (SELECT {keys}, COUNT(*) AS n FROM {dim} WHERE {known} GROUP BY {keys} HAVING COUNT(*) > 1) d)")


@q("dq_lookup_fanout", " UNION ALL ".join(_fanout_sql(*x) for x in [
    ("fact_sales", "silver_sales", "dim_time", {"year": "year", "month": "month"}),
    ("fact_sales", "silver_sales", "dim_product", {"product_name": "product_name"}),
    ("fact_sales", "silver_sales", "dim_customer", {"customer_name": "customer_name"}),
    ("fact_sales", "silver_sales", "dim_sales_rep", {"sales_rep_name": "name_of_sales_rep"}),
    ("fact_orders", "silver_orders", "dim_product", {"product_name": "product_name"}),
    ("fact_orders", "silver_orders", "dim_customer", {"customer_name": "customer_name"})]))
def dq_lookup_fanout(spark, sf):
    """K5: names that would multiply facts when these look their keys up, counted before they do."""
    return lh(spark, sf).lookup_fanout()


# Valid coordinate ranges (degrees).
COORDINATE_RANGES = {"latitude": (-90.0, 90.0), "longitude": (-180.0, 180.0)}


@q("dq_coordinate_range", " UNION ALL ".join(
    f"SELECT 'silver_sales' AS model, '{c}' AS column_name, 'accepted_range' AS test, "
    f"COUNT(*) FILTER (WHERE {c} IS NOT NULL AND NOT ({c} BETWEEN {lo} AND {hi})) AS failures "
    f"FROM silver_sales" for c, (lo, hi) in COORDINATE_RANGES.items()))
def dq_coordinate_range(spark, sf):
    return quality.range_failures(lh(spark, sf).silver_sales(), "silver_sales", COORDINATE_RANGES)


#: the accepted values once more, for the oracle
_ACCEPTED_SQL = {"cluster_label": "'Premium - Alto Volumen', 'Regular - Volumen Medio', 'Básico - Bajo Volumen'",
                 "accuracy_category": "'Excelente', 'Bueno', 'Aceptable', 'Necesita mejora'"}


@q("dq_accepted_values", " UNION ALL ".join(
    f"SELECT '{m}' AS model, '{c}' AS column_name, 'accepted_values' AS test, "
    f"COUNT(*) FILTER (WHERE {c} IS NOT NULL AND {c} NOT IN ({_ACCEPTED_SQL[c]})) AS failures "
    f"FROM {_MART_CTE[m]}" for m, c, _ in ACCEPTED))
def dq_accepted_values(spark, sf):
    frames = _mart_frames(spark, sf)
    return quality.suite([quality.accepted_values_failures(frames[m], m, c, v) for m, c, v in ACCEPTED])


RELATIONSHIPS = [
    ("fact_sales", "time_sk", "dim_time", "time_sk"), ("fact_sales", "product_sk", "dim_product", "product_sk"),
    ("fact_sales", "customer_sk", "dim_customer", "customer_sk"),
    ("fact_sales", "sales_rep_sk", "dim_sales_rep", "sales_rep_sk"),
    ("fact_orders", "product_sk", "dim_product", "product_sk"),
    ("fact_orders", "customer_sk", "dim_customer", "customer_sk"),
]


@q("dq_relationships", " UNION ALL ".join(
    f"SELECT '{c}' AS child, '{fk}' AS column_name, '{p}' AS parent, "
    f"(SELECT COUNT(*) FROM {c} x WHERE x.{fk} IS NOT NULL AND NOT EXISTS "
    f"(SELECT 1 FROM {p} y WHERE y.{pk} = x.{fk})) AS orphans, "
    f"(SELECT COUNT(*) FROM {c} WHERE {fk} IS NULL) AS null_keys" for c, fk, p, pk in RELATIONSHIPS))
def dq_relationships(spark, sf):
    h = lh(spark, sf)
    tables = {"fact_sales": h.fact_sales(), "fact_orders": h.fact_orders(), "dim_time": h.dim_time(),
              "dim_product": h.dim_product(), "dim_customer": h.dim_customer(),
              "dim_sales_rep": h.dim_sales_rep()}
    return quality.suite([quality.relationship_failures(tables[c], c, fk, tables[p], p, pk)
                          for c, fk, p, pk in RELATIONSHIPS])


_CHECKS = ("dq_not_null", "dq_unique", "dq_accepted_values")


def _select_of(name: str) -> str:
    """A registered oracle without its common tables."""
    return PLAIN[name]


@q("pipeline_checks", " UNION ALL ".join(_select_of(n) for n in _CHECKS)
   + " UNION ALL SELECT child AS model, column_name, 'relationships' AS test, orphans AS failures FROM (" + _select_of("dq_relationships") + ")")
def pipeline_checks(spark, sf):
    """L1: the whole pipeline in step order (models included); returns its check results."""
    from strata.plans.pipeline import run_pipeline
    return spark.read.parquet(run_pipeline(spark, sf)["dq_results"])


# ====================================================================== catalogs (C1-C5)

@q("catalog_product_price_range", """
SELECT trim(product_name) AS product_name, MIN(trim(product_class)) AS product_class,
       MIN(COALESCE(TRY_CAST(price AS DOUBLE), 0.0)) AS price_min,
       MAX(COALESCE(TRY_CAST(price AS DOUBLE), 0.0)) AS price_max
FROM bronze_sales GROUP BY trim(product_name)""")
def catalog_product_price_range(spark, sf):
    return catalog.product_price_range(_bronze_sales(spark, sf))


@q("catalog_subchannels", """
SELECT DISTINCT lower(trim(channel)) AS channel, lower(trim(sub_channel)) AS sub_channel FROM bronze_sales
WHERE sub_channel IS NOT NULL AND lower(trim(sub_channel)) <> ''""")
def catalog_subchannels(spark, sf):
    return catalog.sub_channels(_bronze_sales(spark, sf))


@q("catalog_domains", """
SELECT DISTINCT 'country' AS domain, trim(country) AS value FROM bronze_sales
UNION SELECT DISTINCT 'channel' AS domain, lower(trim(channel)) AS value FROM bronze_sales""")
def catalog_domains(spark, sf):
    return catalog.domains(_bronze_sales(spark, sf))


@q("catalog_sales_reps", """
SELECT sales_rep_name, manager, sales_team FROM (
  SELECT trim(name_of_sales_rep) AS sales_rep_name, trim(manager) AS manager, trim(sales_team) AS sales_team,
         row_number() OVER (PARTITION BY trim(name_of_sales_rep)
                            ORDER BY trim(manager) NULLS FIRST, trim(sales_team) NULLS FIRST) AS rn
  FROM bronze_sales WHERE name_of_sales_rep IS NOT NULL) WHERE rn = 1""")
def catalog_sales_reps(spark, sf):
    return catalog.sales_reps(_bronze_sales(spark, sf))


# ====================================================================== scalar function suites

@q("fn_string_suite", f"""
SELECT customer_name AS raw_name, trim(customer_name) AS trimmed, upper(trim(customer_name)) AS upper_name,
       lower(trim(customer_name)) AS lower_name, {O.initcap('trim(customer_name)')} AS initcap_name,
       regexp_replace(customer_name, '\\s+', ' ', 'g') AS collapsed, contains(customer_name, 'Customer') AS has_customer,
       concat_ws('|', city, country) AS place, md5(trim(customer_name)) AS name_md5,
       lpad(CAST(quantity AS VARCHAR), 4, '0') AS qty_padded
FROM bronze_sales""")
def fn_string_suite(spark, sf):
    b = _bronze_sales(spark, sf)
    n = F.col("customer_name")
    return b.select(n.alias("raw_name"), F.trim(n).alias("trimmed"), F.upper(F.trim(n)).alias("upper_name"),
                    F.lower(F.trim(n)).alias("lower_name"), F.initcap(F.trim(n)).alias("initcap_name"),
                    F.regexp_replace(n, r"\s+", " ").alias("collapsed"), n.contains("Customer").alias("has_customer"),
                    F.concat_ws("|", "city", "country").alias("place"), natural_key(F.trim(n)).alias("name_md5"),
                    F.lpad(F.col("quantity").cast("string"), 4, "0").alias("qty_padded"))


@q("fn_date_suite", f"""
SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS year, monthname(o_orderdate) AS month_name,
       CAST(quarter(o_orderdate) AS INTEGER) AS quarter,
       make_date(CAST(year(o_orderdate) AS INTEGER), CAST(month(o_orderdate) AS INTEGER), 1) AS month_start,
       CAST(CAST(o_orderdate AS DATE) - INTERVAL 6 MONTH AS DATE) AS six_months_before,
       {O.dmy('CAST(o_orderdate AS DATE)')} AS dmy_text,
       {O.parse_dmy(O.dmy('CAST(o_orderdate AS DATE)'))} AS dmy_parsed,
       CAST(date_diff('day', CAST(o_orderdate AS DATE), DATE '2000-01-01') AS INTEGER) AS days_to_2000
FROM orders""")
def fn_date_suite(spark, sf):
    o = Tables(spark, sf).orders
    d = F.col("o_orderdate").cast("date")
    txt = F.date_format(d, "d-MMM-yy")
    return o.select("o_orderkey", F.year(d).alias("year"), F.date_format(d, "MMMM").alias("month_name"),
                    F.quarter(d).alias("quarter"), month_start(F.year(d), F.month(d)).alias("month_start"),
                    F.add_months(d, -6).alias("six_months_before"), txt.alias("dmy_text"),
                    F.try_to_date(txt, "d-MMM-yy").alias("dmy_parsed"),
                    F.datediff(F.lit("2000-01-01").cast("date"), d).alias("days_to_2000"))


@q("fn_month_number", f"""
SELECT month, {O.month_num('month')} AS month_num, COALESCE({O.month_num('month')}, 1) AS month_num_default
FROM (SELECT month FROM bronze_sales UNION SELECT strftime(o_orderdate, '%b') AS month FROM orders)""")
def fn_month_number(spark, sf):
    names = _bronze_sales(spark, sf).select("month").unionByName(
        Tables(spark, sf).orders.select(F.date_format("o_orderdate", "MMM").alias("month"))).distinct()
    return names.select("month", month_number("month").alias("month_num"),
                        month_number_or_january("month").alias("month_num_default"))


@q("fn_cyclic_month", f"""
SELECT month_num, {r('sin(2 * pi() * month_num / 12)', 6)} AS month_sin,
       {r('cos(2 * pi() * month_num / 12)', 6)} AS month_cos
FROM (SELECT DISTINCT month_num FROM dim_time)""")
def fn_cyclic_month(spark, sf):
    import math
    m = lh(spark, sf).dim_time().select("month_num").distinct()
    angle = 2 * math.pi * F.col("month_num") / 12
    return m.select("month_num", round_half_up(F.sin(angle), 6).alias("month_sin"),
                    round_half_up(F.cos(angle), 6).alias("month_cos"))


@q("fn_md5_key", "SELECT DISTINCT customer_name, md5(customer_name) AS customer_nk FROM silver_sales")
def fn_md5_key(spark, sf):
    c = lh(spark, sf).silver_sales().select("customer_name").distinct()
    return c.select("customer_name", natural_key("customer_name").alias("customer_nk"))


@q("fn_json_parse", """
SELECT event_id, event_type, value, TRY_CAST(json_extract(props, '$.k') AS INTEGER) AS k FROM events""")
def fn_json_parse(spark, sf):
    e = Tables(spark, sf).events
    return e.select("event_id", "event_type", "value",
                    F.from_json("props", "k INT").getField("k").alias("k"))


# ====================================================================== streaming (T1-T2)

@q("parse_order_events", "SELECT * FROM bronze_orders")
def parse_order_events(spark, sf):
    return stream.parse_order_events(adapter.order_event_lines(lh(spark, sf).landing_lines()))


@q("stream_orders_bronze", "SELECT * FROM bronze_orders")
def stream_orders_bronze(spark, sf):
    """Event payloads landed as text files, drained by an availableNow stream into the
    checkpointed parquet sink that feeds Silver."""
    return lh(spark, sf).bronze_orders()


@q("stream_orders_once_each", "SELECT event_id, CAST(1 AS BIGINT) AS copies FROM bronze_orders WHERE event_id IS NOT NULL GROUP BY event_id")
def stream_orders_once_each(spark, sf):
    """T3 in the stream: repeated deliveries are dropped before the sink."""
    return lh(spark, sf).orders_once_each().groupBy("event_id").agg(F.count(F.lit(1)).alias("copies"))


@q("stream_orders_accepted", "SELECT *, TRUE AS placed, TRUE AS stamped FROM bronze_orders WHERE event_id IS NOT NULL")
def stream_orders_accepted(spark, sf):
    """The typed side of the stream with two sinks; each row names its file and when it was read."""
    accepted, _ = lh(spark, sf).orders_judged()
    return accepted.select(*[f.name for f in ORDER_EVENT_SCHEMA.fields], F.col("_source_file").isNotNull().alias("placed"), F.col("_processed_at").isNotNull().alias("stamped"))


@q("stream_orders_rejected", "SELECT 'not_json' AS reason, '#corrupt' AS head, COUNT(*) AS payloads, COUNT(*) AS placed FROM bronze_orders WHERE event_id IS NULL HAVING COUNT(*) > 0")
def stream_orders_rejected(spark, sf):
    """The other side: the payloads that are no events, by reason and first word; with the accepted ones they are all."""
    _, rejected = lh(spark, sf).orders_judged()
    return rejected.groupBy("reason", F.split("payload", " ")[0].alias("head")).agg(
        F.count(F.lit(1)).alias("payloads"), F.count("_source_file").alias("placed"))


# ====================================================================== sources and sinks (S1-S12)

@q("src_csv_inferred", "SELECT " + ", ".join(
    f'{c} AS "{h}"' for c, h in zip(S.SALES_COLUMNS, adapter.SALES_HEADERS)) + " FROM bronze_sales")
def src_csv_inferred(spark, sf):
    return read_csv(spark, lh(spark, sf).sales_csv(), infer_schema=True)


@q("src_csv_strings", "SELECT " + ", ".join(f"NULLIF({c}, '') AS {c}" for c in O.SHIPMENT_RAW_COLS)
   + " FROM bronze_shipments")
def src_csv_strings(spark, sf):
    return T.normalize_columns(read_csv(spark, lh(spark, sf).shipments_csv(), infer_schema=False), strict=True)


@q("src_safe_load", "SELECT * FROM silver_orders")
def src_safe_load(spark, sf):
    from strata.schemas import SILVER_ORDERS_SCHEMA
    h = lh(spark, sf)
    h.silver_orders()
    present = load_safe(spark, h.path("silver_orders"), SILVER_ORDERS_SCHEMA)
    missing = load_safe(spark, h.path("no_such_table"), SILVER_ORDERS_SCHEMA)
    return present.unionByName(missing)


@q("sink_overwrite_roundtrip", "SELECT * FROM dim_product")
def sink_overwrite_roundtrip(spark, sf):
    from strata.sources.sinks import write_overwrite
    path = scratch_path(spark, "overwrite")
    dim = lh(spark, sf).dim_product()
    write_overwrite(dim.withColumn("obsolete", F.lit(1)), path)
    write_overwrite(dim, path)
    return spark.read.parquet(path)


@q("sink_keep_schema_roundtrip", "SELECT * FROM dim_product")
def sink_keep_schema_roundtrip(spark, sf):
    """Overwritten twice with the stored columns; other columns are refused and change nothing."""
    from strata.sources.sinks import write_keep_schema
    path = scratch_path(spark, "keep-schema")
    dim = lh(spark, sf).dim_product()
    write_keep_schema(dim.limit(0), path)
    write_keep_schema(dim, path)
    try:
        write_keep_schema(dim.withColumn("another", F.lit(1)), path)
    except ValueError:
        return spark.read.parquet(path)
    raise AssertionError("other columns were not refused")


@q("sink_replace_table", "SELECT * FROM dim_product")
def sink_replace_table(spark, sf):
    """A table made, replaced by other columns, and switched to the rows of a third write."""
    from strata.sources.sinks import replace_table
    dim, root = lh(spark, sf).dim_product(), scratch_path(spark, "replaced")
    for rows in (dim.withColumn("obsolete", F.lit(1)), dim.limit(0), dim):
        replace_table(rows, "lake_replaced_product", root)
    return spark.newSession().table("lake_replaced_product")


def _by_name(name: str) -> Query:
    """A published model as another session reads it: by its name in the catalog."""
    def read(spark, sf):
        from strata.plans.models import STAND_INS, materialise_models
        names = materialise_models(lh(spark, sf), [name], "named_", STAND_INS)
        return _round_model_cols(spark.newSession().table(names[name]))
    return read


for _name, _cte in _MART_CTE.items():
    q(f"table_{_name}", f"SELECT * FROM {_cte}")(_by_name(_name))
q("view_stg_sales", PLAIN["stg_sales"])(_by_name("stg_sales"))


_NAMED_ROWS = {"ml_customer_clusters": "customer_features", "ml_demand_forecast": "split WHERE split = 'test'"}


@q("ddl_external_tables_all", " UNION ALL ".join(f"SELECT '{t}' AS table_name, COUNT(*) AS table_rows FROM {_NAMED_ROWS.get(t, t)}" for t in Lakehouse.NAMED_TABLES))
def ddl_external_tables_all(spark, sf):
    """All ten named tables, read back by name from another session."""
    named = lh(spark, sf).register_tables("lake_")
    other = spark.newSession()
    return quality.suite([other.table(n).agg(F.count(F.lit(1)).alias("table_rows")).select(F.lit(n.removeprefix("lake_")).alias("table_name"), "table_rows") for n in named])


_EXPORTED = {"dim_product": "dim_product", "dim_time": "dim_time", "dim_sales_rep": "dim_sales_rep", **{m: _MART_CTE[m] for m in (
    "mart_product_performance", "mart_sales_rep_performance", "mart_cluster_analysis", "mart_forecast_analysis")}}


@q("sink_csv_exports_all", " UNION ALL ".join(f"SELECT '{e}' AS export, COUNT(*) AS export_rows, CAST(0 AS BIGINT) AS differing FROM {cte}" for e, cte in _EXPORTED.items()))
def sink_csv_exports_all(spark, sf):
    """All seven exports, read back and compared row by row with the tables they come from."""
    from strata.plans.pipeline import EXPORTS
    from strata.sources.sinks import export_csv
    h, parts = lh(spark, sf), []
    for name in EXPORTS:
        table = h.mart(name) if name.startswith("mart_") else getattr(h, name)()
        path = scratch_path(spark, "export", name)
        export_csv(table, path)
        back = read_csv(spark, path, schema=table.schema)
        marked = table.select("*", F.lit(1).alias("_side")).unionByName(back.select("*", F.lit(-1).alias("_side")))
        sides = marked.groupBy(*table.columns).agg(F.sum("_side").alias("_left"), F.count_if(F.col("_side") < 0).alias("_back"))
        parts.append(sides.agg(F.sum("_back").alias("export_rows"), F.sum(F.abs("_left")).alias("differing")).select(
            F.lit(name).alias("export"), F.coalesce("export_rows", F.lit(0)).cast("bigint").alias("export_rows"), F.coalesce("differing", F.lit(0)).cast("bigint").alias("differing")))
    return quality.suite(parts)


@q("fact_ids", "SELECT 'fact_sales' AS fact, COUNT(*) AS fact_rows, COUNT(*) AS ids FROM fact_sales UNION ALL SELECT 'fact_orders', COUNT(*), COUNT(*) FROM fact_orders")
def fact_ids(spark, sf):
    """The partition-dependent fact ids name every row once."""
    h = lh(spark, sf)
    return quality.suite([f.agg(F.count(F.lit(1)).alias("fact_rows"), F.countDistinct(c).alias("ids")).select(F.lit(n).alias("fact"), "fact_rows", "ids")
                          for f, n, c in ((h.fact_sales(), "fact_sales", "sale_sk"), (h.fact_orders(), "fact_orders", "order_sk"))])


@q("ddl_external_table", "SELECT * FROM dim_sales_rep")
def ddl_external_table(spark, sf):
    names = lh(spark, sf).register_tables("lake_")
    return spark.table(names[names.index("lake_dim_sales_rep")])


@q("sink_csv_export", "SELECT * FROM dim_time")
def sink_csv_export(spark, sf):
    """Export a Gold table as header CSV and read it back with its own schema
    (inference would turn the unpadded ``year_month`` text into a timestamp)."""
    from strata.sources.sinks import export_csv
    path = scratch_path(spark, "export")
    dim = lh(spark, sf).dim_time()
    export_csv(dim, path)
    return read_csv(spark, path, schema=dim.schema)
