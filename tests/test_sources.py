"""Sources and sinks: safe load, overwrite with schema replacement, external tables."""

from pyspark.sql import functions as F

from strata.schemas import SILVER_ORDERS_SCHEMA
from strata.session import scratch_path
from strata.sources.sinks import register_external_table, write_overwrite
from strata.sources.tables import load_safe


def test_safe_load_missing_and_empty(spark):
    base = scratch_path(spark, "safe")
    df = load_safe(spark, f"{base}/missing", SILVER_ORDERS_SCHEMA)
    assert df.count() == 0 and df.schema == SILVER_ORDERS_SCHEMA
    spark.createDataFrame([], "a int").write.parquet(f"{base}/empty")
    df2 = load_safe(spark, f"{base}/empty", SILVER_ORDERS_SCHEMA)
    assert df2.count() == 0 and df2.columns == SILVER_ORDERS_SCHEMA.fieldNames()


def test_overwrite_replaces_schema(spark):
    path = scratch_path(spark, "ow")
    write_overwrite(spark.range(3).withColumn("x", F.lit("a")), path)
    write_overwrite(spark.range(5), path)
    back = spark.read.parquet(path)
    assert back.columns == ["id"] and back.count() == 5


def test_external_table(spark):
    path = scratch_path(spark, "ext")
    spark.range(4).write.parquet(path)
    name = register_external_table(spark, "t_ext_test", path)
    assert spark.table(name).count() == 4
