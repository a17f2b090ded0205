"""Analytical marts over Gold and the ML outputs.

The multi-distinct marts use Spark's Expand-based rewrite: one scan, partial
aggregation on (group, distinct value) before the shuffle, so a hot product
or rep is combined map-side instead of landing whole in one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strata.functions.numeric import double_part, exact_part, money_avg, money_sum, money_total, round_half_up, safe_div

# Forecast accuracy bands (lower bound in %, label), best first.
ACCURACY_BANDS = [(90, "Excelente"), (80, "Bueno"), (70, "Aceptable")]
ACCURACY_FALLBACK = "Necesita mejora"


def _r2(c: F.Column) -> F.Column:
    return round_half_up(c, 2)


def product_performance(fact: DataFrame, dim_product: DataFrame) -> DataFrame:
    # group by the key alone, then attach the names: the Expand rows of the
    # multi-distinct rewrite stay narrow and the dimension joins one row per product.
    # They hold nothing but what is counted once each: sums beside them would widen
    # every one of them and be carried through the shuffle of all distinct pairs
    reach = fact.groupBy("product_sk").agg(
        F.countDistinct("customer_sk").alias("customers_reached"),
        F.countDistinct("sales_rep_sk").alias("sales_reps_selling"),
        F.countDistinct("country").alias("countries_sold"),
        F.countDistinct("city").alias("cities_sold"))
    sums = fact.groupBy("product_sk").agg(
        F.count(F.lit(1)).alias("total_transactions"), money_sum("sales").alias("_sales"),
        _r2(money_avg("sales")).alias("avg_transaction_value"), F.sum("qty").alias("total_units_sold"),
        _r2(money_avg("price")).alias("avg_price"))
    # facts without a product go with the join, as they have no row in the dimension
    return (sums.join(reach, "product_sk").withColumns({
                "total_sales": _r2(F.col("_sales")),
                "revenue_per_unit": _r2(safe_div(F.col("_sales"), F.col("total_units_sold"))),
                "sales_per_customer": _r2(safe_div(F.col("_sales"), F.col("customers_reached")))})
            .join(dim_product.select("product_sk", "product_name", "product_class"), "product_sk")
            .select("product_sk", "product_name", "product_class", "customers_reached",
                    "sales_reps_selling", "total_transactions", "total_sales", "avg_transaction_value",
                    "total_units_sold", "avg_price", "countries_sold", "cities_sold", "revenue_per_unit",
                    "sales_per_customer")
            .orderBy(F.desc("total_sales"), "product_sk"))


def sales_rep_performance(fact: DataFrame, dim_rep: DataFrame) -> DataFrame:
    customers = F.countDistinct("customer_sk")
    return (fact.groupBy("sales_rep_sk").agg(
                customers.alias("total_customers"),
                F.count(F.lit(1)).alias("total_transactions"),
                _r2(money_sum("sales")).alias("total_sales"),
                _r2(money_avg("sales")).alias("avg_transaction_value"),
                F.sum("qty").alias("total_units_sold"),
                _r2(safe_div(money_sum("sales"), customers)).alias("sales_per_customer"),
                F.countDistinct("product_sk").alias("products_sold"),
                F.countDistinct("city").alias("cities_covered"))
            .join(dim_rep.select("sales_rep_sk", "sales_rep_name", "manager", "sales_team"), "sales_rep_sk")
            .select("sales_rep_sk", "sales_rep_name", "manager", "sales_team", "total_customers",
                    "total_transactions", "total_sales", "avg_transaction_value", "total_units_sold",
                    "sales_per_customer", "products_sold", "cities_covered")
            .orderBy(F.desc("total_sales"), "sales_rep_sk"))


def geographic_analysis(fact: DataFrame, dim_customer: DataFrame) -> DataFrame:
    """Per (country, city) of the customer; mean coordinates are weighted by transactions.

    Facts are combined per (customer, rep, product) before they meet the dimension.
    """
    c = dim_customer.select("customer_sk", F.col("country").alias("c_country"),
                            F.col("city").alias("c_city"), F.col("latitude").alias("c_lat"),
                            F.col("longitude").alias("c_lon"))
    parts = fact.groupBy("customer_sk", "sales_rep_sk", "product_sk").agg(
        F.count(F.lit(1)).alias("_n"), F.sum(exact_part("sales")).alias("_msum"),
        F.sum(double_part("sales")).alias("_mrest"), F.count("sales").alias("_mcnt"), F.sum("qty").alias("_qty"))
    customers, total = F.countDistinct("customer_sk"), money_total(F.sum("_msum"), F.sum("_mrest"))

    def mean(col: str) -> F.Column:
        n = F.sum(F.when(F.col(col).isNotNull(), F.col("_n")))
        return round_half_up(safe_div(F.sum(F.col(col) * F.col("_n")), n), 6)

    return (parts.join(c, "customer_sk")
            .groupBy(F.col("c_country").alias("country"), F.col("c_city").alias("city")).agg(
                customers.alias("total_customers"),
                F.countDistinct("sales_rep_sk").alias("sales_reps_active"),
                F.sum("_n").alias("total_transactions"),
                _r2(total).alias("total_sales"),
                _r2(safe_div(total, F.sum("_mcnt"))).alias("avg_transaction_value"),
                F.sum("_qty").alias("total_units_sold"),
                F.countDistinct("product_sk").alias("products_sold"),
                _r2(safe_div(total, customers)).alias("sales_per_customer"),
                _r2(safe_div(total, F.sum("_n"))).alias("avg_ticket"),
                mean("c_lat").alias("avg_latitude"),
                mean("c_lon").alias("avg_longitude"))
            .orderBy(F.desc("total_sales"), F.asc_nulls_first("country"), F.asc_nulls_first("city")))


def cluster_analysis(clusters: DataFrame) -> DataFrame:
    """Segment statistics plus each segment's share of sales and customers."""
    per = clusters.groupBy("cluster_label").agg(
        F.count(F.lit(1)).alias("num_customers"),
        _r2(money_avg("total_sales")).alias("avg_sales_per_customer"),
        _r2(money_sum("total_sales")).alias("total_cluster_sales"),
        _r2(F.avg("transaction_count")).alias("avg_transactions"),
        _r2(money_avg("avg_transaction_value")).alias("avg_ticket"),
        _r2(F.avg("total_qty")).alias("avg_quantity"),
        _r2(F.min("total_sales")).alias("min_sales"),
        _r2(F.max("total_sales")).alias("max_sales"))
    # one row per segment label (k rows): the un-partitioned total window is bounded by k
    everything = Window.partitionBy()
    return (per.withColumns({
        "pct_of_total_sales": _r2(F.col("total_cluster_sales") * 100.0
                                  / F.sum("total_cluster_sales").over(everything)),
        "pct_of_total_customers": _r2(F.col("num_customers") * 100.0
                                      / F.sum("num_customers").over(everything)),
    }).orderBy(F.desc("avg_sales_per_customer"), F.asc_nulls_first("cluster_label")))


def accuracy_category(c: F.Column) -> F.Column:
    expr = None
    for bound, label in ACCURACY_BANDS:
        expr = F.when(c >= bound, F.lit(label)) if expr is None else expr.when(c >= bound, F.lit(label))
    return expr.otherwise(F.lit(ACCURACY_FALLBACK))


def forecast_analysis(forecast: DataFrame) -> DataFrame:
    per = forecast.groupBy("product_name").agg(
        F.count(F.lit(1)).alias("num_predictions"),
        _r2(money_avg("actual_sales")).alias("avg_actual_sales"),
        _r2(F.avg("predicted_sales")).alias("avg_predicted_sales"),
        _r2(F.avg("percentage_error")).alias("product_mape"),
        _r2(F.avg("forecast_accuracy")).alias("product_accuracy_pct"),
        _r2(money_sum("actual_sales")).alias("total_actual_sales"),
        _r2(F.sum("predicted_sales")).alias("total_predicted_sales"))
    # the model metrics are one constant pair per run: DISTINCT + LIMIT 1 is a 1-row side
    model = forecast.select("model_r2", "model_rmse").distinct().limit(1)
    return (per.withColumn("accuracy_category", accuracy_category(F.col("product_accuracy_pct")))
            .crossJoin(F.broadcast(model))
            .orderBy(F.desc("product_accuracy_pct"), "product_name"))


def forecast_accuracy_by_country(forecast: DataFrame) -> DataFrame:
    return (forecast.groupBy("country").agg(
        F.count(F.lit(1)).alias("num_predictions"),
        _r2(F.avg("forecast_accuracy")).alias("avg_accuracy"),
        _r2(F.avg("percentage_error")).alias("mape"))
        .orderBy(F.desc("avg_accuracy"), F.asc_nulls_first("country")))


def staging_sales(silver_sales: DataFrame) -> DataFrame:
    """The staging view: Silver sales with the rep column renamed."""
    cols = ["customer_name", "city", "country", "latitude", "longitude", "channel", "sub_channel",
            "product_name", "product_class", "quantity", "price", "sales", "month", "year",
            "distributor"]
    return silver_sales.select(*cols, F.col("name_of_sales_rep").alias("sales_rep"), "manager", "sales_team")
