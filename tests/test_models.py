"""Model outputs: no SQL oracle, so check determinism-independent invariants."""

from pyspark.sql import functions as F

from strata.operators import ml
from strata.plans.registry import QUERIES


def test_kmeans_segments(spark, sf_dir, duck):
    clusters = QUERIES["ml_customer_clusters"](spark, sf_dir)
    rows = clusters.groupBy("cluster_id", "cluster_label").count().collect()
    assert len(rows) == 3
    assert {r.cluster_label for r in rows} == set(ml.SEGMENT_LABELS)
    n_feat = QUERIES["customer_features"](spark, sf_dir).count()
    assert sum(r["count"] for r in rows) == n_feat
    # the Premium label goes to the cluster with the highest mean sales
    means = clusters.groupBy("cluster_label").agg(F.avg("total_sales").alias("m")).collect()
    by = {r.cluster_label: r.m for r in means}
    assert by[ml.SEGMENT_LABELS[0]] <= by[ml.SEGMENT_LABELS[1]] <= by[ml.SEGMENT_LABELS[2]]


def test_silhouette_in_range(spark, sf_dir):
    r = QUERIES["ml_silhouette"](spark, sf_dir).collect()[0]
    assert -1.0 <= r.silhouette <= 1.0 and r.clusters == 3


def test_gbt_forecast_rows_and_metrics(spark, sf_dir, duck):
    f = QUERIES["ml_demand_forecast"](spark, sf_dir)
    test_rows = QUERIES["forecast_time_split"](spark, sf_dir).where("split = 'test'").count()
    assert f.count() == test_rows
    m = f.select("model_rmse", "model_mae", "model_r2", "model_type").distinct().collect()
    assert len(m) == 1 and m[0].model_type == "GBTRegressor"
    assert m[0].model_rmse >= m[0].model_mae >= 0
    bad = f.where((F.col("actual_sales") > 0) &
                  (F.abs(F.col("forecast_accuracy") - (100 - F.col("percentage_error"))) > 1e-6)).count()
    assert bad == 0


def test_feature_summary_shape(spark, sf_dir):
    rows = QUERIES["feature_summary"](spark, sf_dir).collect()
    assert [r.summary for r in rows] == ["min", "25%", "50%", "75%", "max"]


def test_cluster_mart_over_kmeans(spark, sf_dir):
    rows = QUERIES["mart_cluster_analysis_kmeans"](spark, sf_dir).collect()
    assert {r.cluster_label for r in rows} == set(ml.SEGMENT_LABELS)
    n_feat = QUERIES["customer_features"](spark, sf_dir).count()
    assert sum(r.num_customers for r in rows) == n_feat
    assert abs(sum(r.pct_of_total_customers for r in rows) - 100.0) < 0.05
    assert abs(sum(r.pct_of_total_sales for r in rows) - 100.0) < 0.05


def test_forecast_mart_over_gbt(spark, sf_dir):
    from strata.operators import marts
    mart = QUERIES["mart_forecast_analysis_gbt"](spark, sf_dir)
    preds = QUERIES["ml_demand_forecast"](spark, sf_dir)
    assert mart.count() == preds.select("product_name").distinct().count()
    assert mart.agg(F.sum("num_predictions")).first()[0] == preds.count()
    labels = {lbl for _, lbl in marts.ACCURACY_BANDS} | {marts.ACCURACY_FALLBACK}
    assert {r.accuracy_category for r in mart.select("accuracy_category").distinct().collect()} <= labels
    assert mart.select("model_r2", "model_rmse").distinct().count() == 1
    # the test window is the last 7 months inclusive, so no series has more than 7 predictions
    per_series = preds.groupBy("product_name", "country").count()
    assert per_series.agg(F.max("count")).first()[0] <= 7


def test_pipeline_runs_every_step_and_its_checks_pass(spark, sf_dir):
    from strata.plans.pipeline import run_pipeline
    paths = run_pipeline(spark, sf_dir)
    assert {"mart_product_performance", "mart_sales_rep_performance", "mart_geographic_analysis",
            "mart_cluster_analysis", "mart_forecast_analysis", "dq_results"} == set(paths)
    checks = spark.read.parquet(paths["dq_results"])
    # 16 not_null + 3 unique + 2 accepted_values + 6 relationships
    assert checks.count() == 27
    assert checks.where("failures <> 0").count() == 0
    # the mart checks agree with the SQL-checked suite for the marts without a model
    sql_checked = QUERIES["dq_not_null"](spark, sf_dir).where(
        "model NOT IN ('mart_cluster_analysis', 'mart_forecast_analysis')")
    assert sorted(sql_checked.collect()) == sorted(checks.join(
        sql_checked.select("model", "column_name", "test"), ["model", "column_name", "test"]).select(
        *sql_checked.columns).collect())


def test_model_jobs_release_their_training_cache(spark, sf_dir):
    cm = spark._jsparkSession.sharedState().cacheManager()
    for name in ("ml_customer_clusters", "ml_demand_forecast", "ml_silhouette"):
        QUERIES[name](spark, sf_dir).collect()
        assert cm.isEmpty(), name
