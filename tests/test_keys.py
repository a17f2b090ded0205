"""Distributed dense surrogate key == global row_number, including skew and multi-partition input."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from strata.functions.keys import dense_key


def test_dense_key_matches_global_row_number(spark):
    df = spark.range(0, 5000, numPartitions=7).select(
        (F.col("id") * 7919 % 5000).cast("string").alias("k"))
    got = dense_key(df, ["k"], "sk", rows_per_partition=900)
    exp = df.withColumn("sk", F.row_number().over(Window.orderBy("k")).cast("bigint"))
    assert sorted(got.collect()) == sorted(exp.collect())


def test_dense_key_with_hot_key_and_nulls(spark):
    # a third of the rows share one key; NULLs sort first
    rows = [("hot",)] * 300 + [(f"k{i:04d}",) for i in range(600)] + [(None,)] * 5
    df = spark.createDataFrame(rows, "k string").repartition(5)
    got = dense_key(df, ["k"], "sk", rows_per_partition=250)
    sks = sorted(r.sk for r in got.collect())
    assert sks == list(range(1, len(rows) + 1))
    nulls = sorted(r.sk for r in got.where(F.col("k").isNull()).collect())
    assert nulls == [1, 2, 3, 4, 5]
