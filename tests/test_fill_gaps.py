"""Filled gaps are made in place: no calendar is joined."""

from pyspark.sql import functions as F

from strata.operators import ml


def test_filled_gaps_need_no_join(spark):
    rows = [("p", "X", 2020, 1, 10.0, 1, 1, None), ("p", "X", 2020, 4, 5.0, 2, 1, 3.0), ("p", "X", 2020, 6, None, None, 1, None),
            (None, "X", 2021, 12, 1.0, 1, 1, 2.0), (None, "X", 2022, 2, 1.0, 1, 1, 4.0), ("q", None, None, 5, 1.0, 1, 1, 1.0)]
    monthly = spark.createDataFrame(rows, "product_name string, country string, year int, month int, total_sales double, total_quantity long, num_transactions long, avg_price double")
    filled = ml.fill_gaps(monthly.withColumn("year_month", F.make_date("year", "month", F.lit(1))))
    got = sorted(((r.product_name or "", r.year, r.month, r.total_sales, r.total_quantity, r.num_transactions, r.avg_price, r.filled) for r in filled.collect()), key=lambda r: r[:3])
    assert got == [("", 2021, 12, 1.0, 1, 1, 2.0, False), ("", 2022, 1, 0.0, 0, 0, 2.0, True), ("", 2022, 2, 1.0, 1, 1, 4.0, False),
                   ("p", 2020, 1, 10.0, 1, 1, None, False), ("p", 2020, 2, 0.0, 0, 0, None, True), ("p", 2020, 3, 0.0, 0, 0, None, True),
                   ("p", 2020, 4, 5.0, 2, 1, 3.0, False), ("p", 2020, 5, 0.0, 0, 0, 3.0, True), ("p", 2020, 6, 0.0, 0, 1, 3.0, False)]
    assert "Join" not in ml.lag_features(filled)._jdf.queryExecution().executedPlan().toString()
