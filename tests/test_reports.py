"""Reports come in their documented order; the marts of the models agree with SQL over the models' output."""

import duckdb
import pytest

from strata.plans.compare import compare
from strata.plans.lakehouse import Lakehouse
from strata.plans.registry import QUERIES, _MARTS
from strata.session import scratch_path

#: query -> sort columns, '-' for descending
ORDERS = {
    "kpi_sales_by_channel": ["-ventas_totales", "channel"],
    "kpi_sales_by_country": ["-ventas_totales", "country"],
    "kpi_top_products": ["-ventas_totales", "product_name", "product_class"],
    "kpi_sales_by_class": ["-ventas_totales", "product_class"],
    "kpi_top_reps": ["-ventas_totales", "sales_rep_name"],
    "kpi_team_performance": ["-ventas_totales", "sales_team"],
    "kpi_quarterly": ["year", "quarter_name"],
    "kpi_top_customers": ["-compras_totales", "customer_name"],
    "kpi_orders_summary": ["-valor_total", "channel", "country"],
    "kpi_hist_vs_stream": ["-pedidos_streaming", "product_name"],
    "forecast_accuracy_by_country": ["-avg_accuracy", "country"],
    "freq_by_key": ["-count", "channel"],
    "freq_by_year": ["year"],
    "top_countries": ["-total_sales", "country"],
    "shipment_top_countries": ["-count", "country"],
}


@pytest.mark.parametrize("name", sorted(ORDERS))
def test_order(spark, sf_dir, name):
    rows = QUERIES[name](spark, sf_dir).collect()
    keys = [tuple(-r[c[1:]] if c[0] == "-" else r[c] for c in ORDERS[name]) for r in rows]
    assert rows and keys == sorted(keys)


@pytest.mark.parametrize("mart,table,cte,source", [
    ("mart_cluster_analysis_kmeans", "ml_customer_clusters", "mart_cluster", "banded_clusters"),
    ("mart_forecast_analysis_gbt", "ml_demand_forecast", "mart_forecast", "naive_forecast"),
])
def test_model_marts_equal_sql_over_the_written_model_output(spark, sf_dir, mart, table, cte, source):
    path = scratch_path(spark, "model-output")
    getattr(Lakehouse.get(spark, sf_dir), table)().drop("created_at").coalesce(1).write.parquet(path)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW {source} AS SELECT * FROM read_parquet('{path}/*.parquet')")
    same, message = compare(QUERIES[mart](spark, sf_dir), con, _MARTS[cte], digits=4)
    assert same, message


def test_cluster_listing_equals_sql_over_the_written_segments(spark, sf_dir):
    rows = QUERIES["ml_customer_clusters"](spark, sf_dir).toPandas()
    listing = duckdb.sql("SELECT cluster_label, COUNT(*) AS n, SUM(total_sales) AS s FROM rows GROUP BY cluster_label ORDER BY s / n").fetchall()
    assert [r[0] for r in listing] == ["Básico - Bajo Volumen", "Regular - Volumen Medio", "Premium - Alto Volumen"]


def test_lakehouse_follows_its_source(spark, sf_dir, tmp_path):
    import os
    import shutil
    for name in os.listdir(sf_dir):
        shutil.copyfile(f"{sf_dir}/{name}", tmp_path / name)
    first = Lakehouse.get(spark, str(tmp_path))
    assert Lakehouse.get(spark, str(tmp_path)) is first
    spark.read.parquet(f"{sf_dir}/nation.parquet").limit(24).toPandas().to_parquet(tmp_path / "nation.parquet")
    assert Lakehouse.get(spark, str(tmp_path)) is not first
