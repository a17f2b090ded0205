"""The whole pipeline in the reference's step order, as one function.

Ingestion and stream -> Bronze -> Silver -> Gold -> ML -> marts -> views, named
tables, exports -> declarative checks: the content of the reference's DAG, not
its scheduler.  Silver, Gold and the model outputs are
written by the Lakehouse (once per application and input folder); the marts and
the check results are written to ``out_dir`` (a fresh folder below the shared
checkpoint folder by default), and the checks read the written marts, the way
the reference's tests read its materialised mart tables.  The staging view and the
marts are also published under their names in the catalog (``plans.models``).  A step that fails can
be rerun without recomputing the finished tables.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.operators import marts, quality
from strata.plans.lakehouse import Lakehouse
from strata.plans.models import materialise_models
from strata.session import scratch_path
from strata.sources.sinks import export_csv, register_views, write_overwrite


def build_marts(lh: Lakehouse, with_models: bool = True) -> dict[str, DataFrame]:
    """The written marts by their published names; those of the models only with them."""
    named = {n: n for n in ("mart_product_performance", "mart_sales_rep_performance", "mart_geographic_analysis")}
    if with_models:
        named |= {"mart_cluster_analysis": "mart_cluster_analysis_kmeans", "mart_forecast_analysis": "mart_forecast_analysis_gbt"}
    return {name: lh.mart(table) for name, table in named.items()}


#: Gold tables and marts that are exported as CSV
EXPORTS = ("dim_product", "dim_time", "dim_sales_rep", "mart_product_performance", "mart_sales_rep_performance",
           "mart_cluster_analysis", "mart_forecast_analysis")


def check_suite(lh: Lakehouse, mart_tables: dict[str, DataFrame]) -> DataFrame:
    """All declarative checks as rows (model, column_name, test, failures).

    Mart checks run only for the marts given; relationship checks cover Gold
    (orphan foreign keys; NULL keys are not failures, as in the SQL test).
    """
    from strata.plans.registry import ACCEPTED, NOT_NULL, RELATIONSHIPS, UNIQUE
    parts = [quality.not_null_failures(mart_tables[m], m, cols) for m, cols in NOT_NULL if m in mart_tables]
    parts += [quality.unique_failures(mart_tables[m], m, c) for m, c in UNIQUE if m in mart_tables]
    parts += [quality.accepted_values_failures(mart_tables[m], m, c, v)
              for m, c, v in ACCEPTED if m in mart_tables]
    gold = {"fact_sales": lh.fact_sales(), "fact_orders": lh.fact_orders(), "dim_time": lh.dim_time(),
            "dim_product": lh.dim_product(), "dim_customer": lh.dim_customer(),
            "dim_sales_rep": lh.dim_sales_rep()}
    parts += [quality.relationship_failures(gold[c], c, fk, gold[p], p, pk).select(
        F.col("child").alias("model"), "column_name", F.lit("relationships").alias("test"),
        F.col("orphans").alias("failures")) for c, fk, p, pk in RELATIONSHIPS]
    return quality.suite(parts)


def run_pipeline(spark: SparkSession, sf_dir: str, out_dir: str | None = None,
                 with_models: bool = True) -> dict[str, str]:
    """Run every step in order; return the folder of each written mart and of the check results."""
    lh = Lakehouse.get(spark, sf_dir)
    for step in (lh.bronze_sales, lh.bronze_shipments, lh.bronze_orders,  # CSV ingestion and the stream's sink
                 lh.silver_sales, lh.silver_orders, lh.silver_shipments):
        step()
    for dim in (lh.dim_time, lh.dim_product, lh.dim_customer, lh.dim_sales_rep):
        dim()
    fanout = lh.lookup_fanout()  # counted before the facts look their keys up by name
    lh.build_gold()
    if with_models:
        lh.ml_customer_clusters()
        lh.ml_demand_forecast()
    out = out_dir or scratch_path(spark, "pipeline")
    paths: dict[str, str] = {}
    for name, df in build_marts(lh, with_models).items():
        paths[name] = os.path.join(out, name)
        write_overwrite(df, paths[name])
    written = {name: spark.read.parquet(p) for name, p in paths.items()}
    lh.register_views()
    register_views({**written, "stg_sales": marts.staging_sales(lh.silver_sales())})
    materialise_models(lh, ["stg_sales", *written], "lake_")
    if with_models:
        lh.register_tables("lake_")
    write_overwrite(fanout, os.path.join(out, "lookup_fanout"))
    gold_tables = {name: getattr(lh, name)() for name in ("dim_product", "dim_time", "dim_sales_rep")}
    for name in EXPORTS:
        if name in gold_tables or name in written:
            export_csv(gold_tables.get(name, written.get(name)), os.path.join(out, "export", name))
    paths["dq_results"] = os.path.join(out, "dq_results")
    write_overwrite(check_suite(lh, written), paths["dq_results"])
    return paths
