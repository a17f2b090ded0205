"""Typing, validity filters and keep-one-per-key dedup (the Silver building blocks)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def to_int_lenient(c: Column | str) -> Column:
    """Text/number -> INT the way a lenient CSV cast does: '12.7' -> 12, junk -> NULL.

    ``try_cast`` keeps ANSI mode on (no session change) yet never fails a job.
    """
    c = F.col(c) if isinstance(c, str) else c
    return c.try_cast("double").try_cast("int")


def to_double_lenient(c: Column | str) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return c.try_cast("double")


def type_columns(df: DataFrame, ints: list[str], doubles: list[str]) -> DataFrame:
    """Lenient numeric typing in one projection."""
    plan = {c: to_int_lenient(c) for c in ints if c in df.columns}
    plan.update({c: to_double_lenient(c) for c in doubles if c in df.columns})
    return df.withColumns(plan)


def require(df: DataFrame, not_null: list[str], *conditions: Column) -> DataFrame:
    """Keep rows whose ``not_null`` columns are all present and all ``conditions`` hold.

    One conjunctive predicate: Catalyst pushes the parts on raw columns to the scan.
    """
    cond = F.lit(True)
    for c in not_null:
        cond = cond & F.col(c).isNotNull()
    for extra in conditions:
        cond = cond & extra
    return df.where(cond)


def keep_first(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """Keep the first row per ``keys`` under ``order`` (row_number() == 1).

    The filter sits directly on the window so Spark plans a partial
    WindowGroupLimit before the shuffle: a key holding a third of all rows is
    cut to one row per map task before it is exchanged.
    """
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") == 1).drop("_rn")


def total_order(first: list[Column], rest: list[str]) -> list[Column]:
    """Append every remaining column (asc, NULLs first) so ties are broken deterministically."""
    return first + [F.col(c).asc_nulls_first() for c in rest]
