"""Readers for the driver's parquet tables and generic file sources."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType
from pyspark.errors import AnalysisException

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


class Tables:
    """Lazy accessor: ``Tables(spark, dir).lineitem`` is a parquet scan (pruned by Catalyst)."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        if name in TABLES:
            return read_table(self.spark, self.sf_dir, name)
        raise AttributeError(name)


def read_csv(spark: SparkSession, path: str, infer_schema: bool = True,
             schema: StructType | None = None) -> DataFrame:
    """CSV with header, UTF-8.  ``schema`` skips inference (one pass instead of two)."""
    reader = spark.read.option("header", "true").option("encoding", "UTF-8")
    if schema is not None:
        return reader.schema(schema).csv(path)
    return reader.option("inferSchema", "true" if infer_schema else "false").csv(path)


def load_safe(spark: SparkSession, path: str, empty_schema: StructType,
              fmt: str = "parquet") -> DataFrame:
    """A missing path or an empty table yields an empty frame with ``empty_schema``;
    whatever else is wrong with the table is an error.

    The emptiness probe reads at most one row (``isEmpty``), never a full count.
    """
    try:
        df = spark.read.format(fmt).load(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], empty_schema)
    if df.isEmpty():
        return spark.createDataFrame([], empty_schema)
    return df
