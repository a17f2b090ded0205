"""Customer segmentation (K-Means) and monthly demand forecasting (GBT) on MLlib.

Each model is fit on data already aggregated to one row per customer or per
(product, country, month), so the fit never sees fact-sized input; the
SQL-checkable stages (features, labels, errors, metrics, marts) are plain
DataFrame operators so they can be verified independently of the model.
"""

from __future__ import annotations

import math
import os
from collections.abc import Callable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strata.functions.dates import month_number_or_january, month_start
from strata.functions.numeric import money_avg, money_sum, round_half_up, safe_div
from strata.session import delete_folder, scratch_path, shuffles_deleted

# Clustering features, in vector order.
CLUSTER_FEATURES = ["total_sales", "total_qty", "transaction_count", "avg_transaction_value"]
# Segment label by rank of mean sales, lowest first.
SEGMENT_LABELS = ["Básico - Bajo Volumen", "Regular - Volumen Medio", "Premium - Alto Volumen"]
# Forecast features, in vector order.
FORECAST_FEATURES = [
    "year", "month", "quarter", "is_q4", "month_sin", "month_cos",
    "lag_1", "lag_2", "lag_3", "moving_avg_3", "moving_avg_6", "total_quantity", "avg_price",
]
#: the same where no feature knows the month that is to be forecast
LEAK_FREE_FEATURES = [{"total_quantity": "prior_quantity", "avg_price": "prior_price"}.get(c, c) for c in FORECAST_FEATURES]
# Forecast series key and test window (months before the last month).
FORECAST_KEYS = ("product_name", "country")
TEST_MONTHS_BACK = 6
#: partitions of series with filled gaps, for each that a shuffle has
FILLED_PARTITIONS = 4


# ====================================================================== segmentation

def customer_features(silver_sales: DataFrame) -> DataFrame:
    return (silver_sales.groupBy("customer_name").agg(
        money_sum("sales").alias("total_sales"),
        F.sum("quantity").alias("total_qty"),
        F.count(F.lit(1)).alias("transaction_count"),
        round_half_up(money_avg("sales"), 2).alias("avg_transaction_value"),
        F.avg("latitude").alias("latitude"),
        F.avg("longitude").alias("longitude"))
        .where(F.col("total_sales").isNotNull() & (F.col("total_sales") > 0)))


def five_numbers(df: DataFrame, cols: list[str], quartiles: dict[str, float], accuracy: int = 1_000_000) -> DataFrame:
    """``summary`` (min, the quartiles, max) and each column's value, from one aggregate."""
    names = ["min", *quartiles, "max"]
    one = df.agg(*[F.array(F.min(c), *[F.percentile_approx(c, q, accuracy) for q in quartiles.values()], F.max(c)).cast("array<double>").alias(c)
                   for c in cols])
    return one.select(F.explode(F.arrays_zip(F.array(*map(F.lit, names)).alias("summary"), *cols)).alias("_row")).select("_row.*")


def scale_features(features: DataFrame, cols: list[str] = CLUSTER_FEATURES) -> DataFrame:
    """Assemble ``cols`` and standardise them (mean 0, sample std 1) into ``features``."""
    from pyspark.ml.feature import StandardScaler, VectorAssembler
    assembled = VectorAssembler(inputCols=cols, outputCol="features_raw").transform(features)
    scaler = StandardScaler(inputCol="features_raw", outputCol="features", withMean=True, withStd=True)
    return scaler.fit(assembled).transform(assembled)


def scaled_columns(scaled: DataFrame, cols: list[str] = CLUSTER_FEATURES, digits: int = 6) -> DataFrame:
    from pyspark.ml.functions import vector_to_array
    arr = vector_to_array("features")
    return scaled.select("customer_name", *[round_half_up(arr[i], digits).alias(f"z_{c}")
                                            for i, c in enumerate(cols)])


def kmeans_assign(scaled: DataFrame, k: int = 3, seed: int = 42):
    """Fit K-Means on the scaled vectors; returns (predictions with cluster_id, model)."""
    from pyspark.ml.clustering import KMeans
    model = KMeans(k=k, seed=seed, featuresCol="features", predictionCol="cluster_id").fit(scaled)
    return model.transform(scaled), model


def silhouette(predictions: DataFrame) -> float:
    from pyspark.ml.evaluation import ClusteringEvaluator
    return ClusteringEvaluator(predictionCol="cluster_id", featuresCol="features").evaluate(predictions)


def banded_assign(features: DataFrame) -> DataFrame:
    """Deterministic stand-in for the K-Means assignment used to check the SQL stages:
    band customers by total sales against the population mean +/- half a std."""
    stats = features.agg(F.avg("total_sales").alias("_mu"), F.stddev_samp("total_sales").alias("_sd"))
    z = F.col("total_sales") - F.col("_mu")
    band = (F.when(z < -0.5 * F.col("_sd"), F.lit(0))
            .when(z <= 0.5 * F.col("_sd"), F.lit(1)).otherwise(F.lit(2)))
    return features.crossJoin(F.broadcast(stats)).withColumn("cluster_id", band).drop("_mu", "_sd")


def cluster_stats(predictions: DataFrame) -> DataFrame:
    return predictions.groupBy("cluster_id").agg(
        F.count(F.lit(1)).alias("num_clientes"),
        round_half_up(money_avg("total_sales"), 2).alias("avg_sales"),
        round_half_up(F.avg("transaction_count"), 2).alias("avg_transactions"),
        round_half_up(money_avg("avg_transaction_value"), 2).alias("avg_ticket"),
        round_half_up(money_sum("total_sales"), 2).alias("sum_sales"))


def cluster_labels(stats: DataFrame) -> DataFrame:
    """Rank clusters by mean sales (k rows, so the global window is bounded) and label them."""
    rank = F.row_number().over(Window.orderBy(F.asc("avg_sales"), F.asc("cluster_id")))
    label = None
    for i, name in enumerate(SEGMENT_LABELS, start=1):
        label = F.when(F.col("sales_rank") == i, F.lit(name)) if label is None \
            else label.when(F.col("sales_rank") == i, F.lit(name))
    return stats.withColumn("sales_rank", rank).withColumn("cluster_label", label)


def label_customers(predictions: DataFrame, labels: DataFrame) -> DataFrame:
    mapping = F.broadcast(labels.select("cluster_id", "cluster_label"))  # k rows
    return predictions.join(mapping, "cluster_id", "left").select(
        F.col("customer_name").alias("customer_id"),
        F.col("cluster_id").cast("int").alias("cluster_id"),
        "cluster_label",
        round_half_up("total_sales", 2).alias("total_sales"),
        "total_qty", "transaction_count",
        round_half_up("avg_transaction_value", 2).alias("avg_transaction_value"),
        round_half_up("latitude", 6).alias("latitude"),
        round_half_up("longitude", 6).alias("longitude"),
        F.current_timestamp().alias("created_at"))


#: rows that a partition of a small training frame holds at most, about
ROWS_PER_PARTITION = 1 << 17
#: how many times as many a partition of a large one may hold
MOST_PER_PARTITION = 16


def training_partitions(rows: int, rows_per_partition: int = ROWS_PER_PARTITION) -> int:
    """A power of two by the number of rows: as many as they fill, beyond four about twice the root of that.

    A fit runs hundreds of jobs; each of its tasks makes and ships statistics of
    every node and bin and each reader takes those of all tasks, so that the cost
    beside the rows grows with the square of their number.
    """
    full = max(rows, 1) / rows_per_partition
    return 1 << max(0, math.ceil(math.log2(max(min(full, 2 * math.sqrt(full)), full / MOST_PER_PARTITION))))


def stored(df: DataFrame, name: str) -> DataFrame:
    """The rows of ``df``, written to the scratch folder and read back: each reader takes the files instead of
    computing them again.  Its shuffle files go with the write; ``release`` deletes the rows."""
    path = scratch_path(df.sparkSession, name)
    with shuffles_deleted(df.sparkSession):
        df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def release(frames: list[DataFrame]) -> None:
    """Take frames made from ``stored`` rows out of the cache and delete those rows."""
    for df in frames:
        df.unpersist(blocking=True)
        for folder in {os.path.dirname(file) for file in df.inputFiles()}:
            delete_folder(df.sparkSession, folder)


def training_frame(df: DataFrame, keys: tuple[str, ...], rows_per_partition: int = ROWS_PER_PARTITION,
                   finish: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """Rows placed by the hash of ``keys`` and sorted by them, in partitions by the number of rows.

    MLlib's random starts and split candidates depend on the partitions, so their
    number comes from the rows alone, a power of two: the same data give the same
    model on any cluster, and a fit of hundreds of small jobs has no more tasks
    than the rows need.  The frame is written first, which gives the number of
    rows from the files' footers and lets a lost executor read them again.
    ``finish`` adds columns to the written rows, such as those that need an
    aggregate of all of them.
    """
    rows = stored(df, "training-frame")
    with shuffles_deleted(df.sparkSession):
        count = rows.count()
    partitions = training_partitions(count, rows_per_partition)
    return (finish(rows) if finish else rows).repartition(partitions, *keys).sortWithinPartitions(*keys)


def customer_segments(silver_sales: DataFrame, k: int = 3, seed: int = 42,
                      cached: list[DataFrame] | None = None):
    """Full segmentation job: features -> scale -> K-Means -> labels.  Returns (table, model).

    ``cached`` receives the frame cached for the fit; ``release`` it once the table is written.
    """
    feats = customer_features(silver_sales)
    # the fit is iterative: cache its frame
    scaled = training_frame(scale_features(feats), ("customer_name",)).cache()
    if cached is not None:
        cached.append(scaled)
    preds, model = kmeans_assign(scaled, k, seed)
    out = label_customers(preds, cluster_labels(cluster_stats(preds)))
    return out, model


def cluster_profile(clusters: DataFrame) -> DataFrame:
    """Per-segment profile in one aggregation (no per-cluster driver loop)."""
    return clusters.groupBy("cluster_id", "cluster_label").agg(
        F.count(F.lit(1)).alias("n"),
        round_half_up(money_avg("total_sales"), 2).alias("avg_sales"),
        round_half_up(F.avg("transaction_count"), 2).alias("avg_trans"),
        round_half_up(money_avg("avg_transaction_value"), 2).alias("avg_ticket"))


# ====================================================================== forecasting

def monthly_demand(silver_sales: DataFrame, keys: tuple[str, ...] = FORECAST_KEYS) -> DataFrame:
    df = silver_sales.withColumn("_m", month_number_or_january("month"))
    return (df.groupBy(*keys, "year", F.col("_m").alias("month"), month_start("year", "_m").alias("year_month"))
            .agg(money_sum("sales").alias("total_sales"),
                 F.sum("quantity").alias("total_quantity"),
                 F.count(F.lit(1)).alias("num_transactions"),
                 money_avg("price").alias("avg_price")))


def _series(keys: tuple[str, ...]) -> Window:
    return Window.partitionBy(*keys).orderBy("year_month")


def lag_features(monthly: DataFrame, keys: tuple[str, ...] = FORECAST_KEYS) -> DataFrame:
    """Previous 1-3 observed months per series (row offsets: gaps are not filled)."""
    w = _series(keys)
    return monthly.withColumns({f"lag_{n}": F.lag("total_sales", n).over(w) for n in (1, 2, 3)})


def fill_gaps(monthly: DataFrame, keys: tuple[str, ...] = FORECAST_KEYS) -> DataFrame:
    """Every month of each series from its first to its last; ``filled`` marks those without sales.

    A month without sales has totals and counts of 0 and the average price of the
    month before it.  Lags and averages over rows are then over months.  Rows
    without a month have no place in the calendar and are left out.  Each month
    makes the rows up to the next one of its series in place, so only the months
    with sales are shuffled; the calendar is many times as long, which is why
    there are more partitions than other shuffles have.
    """
    w = _series(keys)
    parts = FILLED_PARTITIONS * int(monthly.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    known = monthly.where(F.col("year_month").isNotNull()).repartition(parts, *keys).withColumns(
        {"_next": F.lead("year_month").over(w), "avg_price": F.last("avg_price", ignorenulls=True).over(w)})
    until = F.when(F.col("_next") > F.col("year_month"), F.expr("sequence(year_month, add_months(_next, -1), interval 1 month)")).otherwise(F.array("year_month"))
    df = known.withColumns({"_observed": F.col("year_month"), "year_month": F.explode(until)})
    filled = F.col("year_month") > F.col("_observed")
    sold = lambda c, none: F.when(filled, none).otherwise(F.coalesce(c, none))
    return df.select(*keys, F.year("year_month").alias("year"), F.month("year_month").alias("month"), "year_month",
                     sold("total_sales", F.lit(0.0)).alias("total_sales"), sold("total_quantity", F.lit(0)).cast("bigint").alias("total_quantity"),
                     sold("num_transactions", F.lit(0)).cast("bigint").alias("num_transactions"), "avg_price", filled.alias("filled"))


def moving_averages(monthly: DataFrame, keys: tuple[str, ...] = FORECAST_KEYS, leak_free: bool = False) -> DataFrame:
    """Trailing 3- and 6-row means including the current month, or, ``leak_free``, those of the rows before it."""
    w, end = _series(keys), -1 if leak_free else 0
    return monthly.withColumns({f"moving_avg_{n}": F.avg("total_sales").over(w.rowsBetween(end - n + 1, end)) for n in (3, 6)})


def forecast_features(monthly: DataFrame, keys: tuple[str, ...] = FORECAST_KEYS, leak_free: bool = False) -> DataFrame:
    """Lags, moving averages and seasonality; rows without a full 3-month lag are dropped.

    ``leak_free`` ends the averages before the current month and adds the
    quantity and price of the month before (``LEAK_FREE_FEATURES``), so that no
    feature knows anything of the month to be forecast.  All windows share one
    partitioning and ordering, so Spark plans a single exchange and sort for
    them.
    """
    df = moving_averages(lag_features(monthly, keys), keys, leak_free)
    if leak_free:
        w = _series(keys)
        df = df.withColumns({"prior_quantity": F.lag("total_quantity").over(w), "prior_price": F.lag("avg_price").over(w)})
    angle = 2 * math.pi * F.col("month") / 12
    df = df.withColumns({
        "quarter": F.quarter("year_month"),
        "is_q4": F.when(F.quarter("year_month") == 4, F.lit(1)).otherwise(F.lit(0)),
        "month_sin": F.sin(angle),
        "month_cos": F.cos(angle),
    })
    return df.where(F.col("lag_3").isNotNull())


def split_train_test(features: DataFrame, months_back: int = TEST_MONTHS_BACK) -> DataFrame:
    """Tag rows 'train' / 'test': test = months >= max(year_month) - ``months_back``.

    The cut-off is a 1-row aggregate broadcast to every row: no driver round trip.
    """
    cut = features.agg(F.add_months(F.max("year_month"), -months_back).alias("_split_date"))
    return (features.crossJoin(F.broadcast(cut))
            .withColumn("split", F.when(F.col("year_month") < F.col("_split_date"), F.lit("train"))
                        .otherwise(F.lit("test")))
            .drop("_split_date"))


def naive_forecast(split: DataFrame) -> DataFrame:
    """Deterministic baseline predictor: next month = last observed month (lag_1)."""
    return split.where(F.col("split") == "test").withColumn("predicted_sales", F.col("lag_1"))


def fit_gbt(train: DataFrame, seed: int = 42, features: list[str] = FORECAST_FEATURES):
    from pyspark.ml import Pipeline
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.regression import GBTRegressor
    assembler = VectorAssembler(inputCols=features, outputCol="features", handleInvalid="skip")
    gbt = GBTRegressor(featuresCol="features", labelCol="total_sales", predictionCol="predicted_sales",
                       maxIter=50, maxDepth=5, maxBins=64, seed=seed)
    return Pipeline(stages=[assembler, gbt]).fit(train)


def regression_metrics(pred: DataFrame, label: str = "total_sales",
                       prediction: str = "predicted_sales") -> DataFrame:
    """One row: rmse, mae, r2 (same definitions as MLlib's RegressionEvaluator); r2 is NULL for a constant label."""
    err = F.col(label) - F.col(prediction)
    m = pred.agg(
        F.sqrt(F.avg(err * err)).alias("rmse"),
        F.avg(F.abs(err)).alias("mae"),
        F.sum(err * err).alias("_sse"),
        (F.var_pop(label) * F.count(F.lit(1))).alias("_sst"),
        F.count(F.lit(1)).alias("n"))
    return m.select("rmse", "mae", (1 - safe_div(F.col("_sse"), F.col("_sst"))).alias("r2"), "n")


def forecast_errors(pred: DataFrame) -> DataFrame:
    """Absolute / percentage error and accuracy; a zero actual counts as 0 % error."""
    a, p = F.col("actual_sales"), F.col("predicted_sales")
    return pred.withColumns({
        "absolute_error": F.abs(a - p),
        "percentage_error": F.when(a > 0, F.abs(a - p) / a * 100).otherwise(F.lit(0.0)),
        "forecast_accuracy": F.when(a > 0, (1 - F.abs(a - p) / a) * 100).otherwise(F.lit(100.0)),
    })


def forecast_output(pred: DataFrame, metrics: DataFrame, model_type: str) -> DataFrame:
    """Gold forecast table: predictions, errors and the run's model metrics on every row."""
    base = pred.select(*FORECAST_KEYS, "year", "month", F.col("year_month").alias("forecast_date"),
                       F.col("total_sales").alias("actual_sales"), "predicted_sales",
                       "total_quantity", "num_transactions", "lag_1", "moving_avg_3")
    m = F.broadcast(metrics.select(F.col("rmse").alias("model_rmse"), F.col("mae").alias("model_mae"),
                                   F.col("r2").alias("model_r2")))  # one row
    return (forecast_errors(base).crossJoin(m)
            .withColumn("model_type", F.lit(model_type))
            .withColumn("created_at", F.current_timestamp()))


def demand_forecast(silver_sales: DataFrame, keys: tuple[str, ...] = FORECAST_KEYS,
                    cached: list[DataFrame] | None = None, filled: bool = False, leak_free: bool = False) -> DataFrame:
    """GBT path: monthly series -> features -> temporal split -> fit -> predictions + metrics.

    ``cached`` receives the frame cached for the fit; ``release`` it once the result is written.
    ``filled`` takes the series with ``fill_gaps``, ``leak_free`` the features that
    know nothing of the month to be forecast.
    """
    monthly = monthly_demand(silver_sales, keys)
    monthly = fill_gaps(monthly, keys) if filled else monthly
    # the split takes the last month of all features: of the written ones, as each look at the others computes them anew
    split = training_frame(forecast_features(monthly, keys, leak_free), (*keys, "year_month"), finish=split_train_test).cache()
    if cached is not None:
        cached.append(split)
    model = fit_gbt(split.where(F.col("split") == "train"), features=LEAK_FREE_FEATURES if leak_free else FORECAST_FEATURES)
    pred = model.transform(split.where(F.col("split") == "test")).drop("features")
    return forecast_output(pred, regression_metrics(pred), "GBTRegressor")


def naive_demand_forecast(silver_sales: DataFrame, keys: tuple[str, ...] = FORECAST_KEYS,
                          cached: list[DataFrame] | None = None) -> DataFrame:
    """The same over ``lag_1``; ``cached`` receives the written features, to ``release`` once the result is written."""
    features = stored(forecast_features(monthly_demand(silver_sales, keys), keys), "forecast-features")
    if cached is not None:
        cached.append(features)
    pred = naive_forecast(split_train_test(features))
    return forecast_output(pred, regression_metrics(pred), "NaiveLag1")


def forecast_summary(forecast: DataFrame) -> DataFrame:
    return forecast.agg(
        F.count(F.lit(1)).alias("total_predictions"),
        F.countDistinct("product_name").alias("unique_products"),
        F.countDistinct("country").alias("unique_countries"),
        F.avg("forecast_accuracy").alias("avg_accuracy"),
        F.avg("percentage_error").alias("avg_error_pct"),
        F.max("model_rmse").alias("rmse"),
        F.max("model_r2").alias("r2"))


def best_forecast_products(forecast: DataFrame, n: int = 5) -> DataFrame:
    return (forecast.groupBy("product_name").agg(
        F.avg("forecast_accuracy").alias("avg_accuracy"),
        money_sum("actual_sales").alias("total_sales"))
        .orderBy(F.desc("avg_accuracy"), "product_name").limit(n))
