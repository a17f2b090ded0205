"""CSV feeds as a stream: each run takes the files that have come since the last one."""

from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from strata.streaming.orders import write_append


def read_csv_stream(spark: SparkSession, source_dir: str, schema: StructType, max_files_per_trigger: int = 64) -> DataFrame:
    """Header CSV files of ``schema``; a file whose header names other columns is an error, not shifted cells."""
    return (spark.readStream.format("csv").schema(schema).option("header", "true").option("encoding", "UTF-8")
            .option("enforceSchema", "false").option("maxFilesPerTrigger", str(max_files_per_trigger)).load(source_dir))


def run_csv_to_bronze(spark: SparkSession, source_dir: str, output_path: str, checkpoint_path: str, schema: StructType,
                      to_bronze: Callable[[DataFrame], DataFrame], max_files_per_trigger: int = 64, fmt: str = "parquet") -> int:
    """Append the Bronze rows of the files that this checkpoint hasn't seen; returns how many rows were read.

    Runs until no file is left and ends.  The file sink's log makes a batch count
    once, also where it was cut off and runs again.
    """
    raw = read_csv_stream(spark, source_dir, schema, max_files_per_trigger)
    q = write_append(to_bronze(raw), output_path, checkpoint_path, fmt)
    q.awaitTermination()
    return sum(p["numInputRows"] for p in q.recentProgress)
