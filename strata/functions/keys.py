"""Surrogate and natural keys.

``dense_key`` numbers rows 1..N in a total order WITHOUT a single-partition
window: rows are range-partitioned and sorted, each row gets its in-partition
position (``monotonically_increasing_id`` low bits), the rows are written to
the shared scratch folder so the numbering is stable if an executor is lost,
and per-partition row counts (one row per partition, so a proven size bound)
are turned into offsets and broadcast back.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.session import delete_folder, scratch_path, shuffles_deleted

_LOW_BITS = (1 << 33) - 1


def natural_key(c: Column | str) -> Column:
    """md5 hex of the business name."""
    c = F.col(c) if isinstance(c, str) else c
    return F.md5(c)


def order_spec(cols: list[str | Column]) -> list[Column]:
    """Ascending, NULLs first, for plain column names; Columns are kept as given."""
    return [F.col(c).asc_nulls_first() if isinstance(c, str) else c for c in cols]


def dense_key(df: DataFrame, order_by: list[str | Column], out_col: str,
              rows_per_partition: int = 250_000) -> DataFrame:
    """Add ``out_col`` = 1..N following ``order_by`` (ties in arbitrary but fixed order).

    The input is written once to the scratch folder, so that its rows are
    computed once and their number is known; partitions hold about
    ``rows_per_partition`` rows whatever the size of the table.  Only the
    numbered rows stay in the scratch folder.
    """
    spark = df.sparkSession
    source, staged_path = (scratch_path(spark, name) for name in ("key-source", "key-sorted"))
    with shuffles_deleted(spark):
        df.write.parquet(source)
    rows = spark.read.schema(df.schema).parquet(source)
    n = max(1, -(-rows.count() // rows_per_partition))
    spec = order_spec(order_by)
    with shuffles_deleted(spark):
        (rows.repartitionByRange(n, *spec).sortWithinPartitions(*spec)
         .withColumn("_dk_id", F.monotonically_increasing_id()).write.option("compression", "zstd").parquet(staged_path))
    delete_folder(spark, source)
    staged = spark.read.parquet(staged_path)
    pid = F.shiftright(F.col("_dk_id"), 33)
    counts = staged.groupBy(pid.alias("_dk_pid")).agg(F.count(F.lit(1)).alias("_dk_n"))
    # one row per partition: the window below and the broadcast are bounded by n
    offsets = counts.select(
        "_dk_pid",
        F.coalesce(
            F.sum("_dk_n").over(Window.orderBy("_dk_pid").rowsBetween(Window.unboundedPreceding, -1)),
            F.lit(0),
        ).alias("_dk_off"),
    )
    keyed = staged.join(F.broadcast(offsets), pid == F.col("_dk_pid"), "inner")
    return keyed.withColumn(
        out_col, (F.col("_dk_off") + F.col("_dk_id").bitwiseAND(F.lit(_LOW_BITS)) + 1).cast("bigint")
    ).drop("_dk_id", "_dk_pid", "_dk_off")
