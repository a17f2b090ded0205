"""Declarative data-quality checks and layer metrics, each as ONE aggregation pass.

Checks return failing counts as rows (model, column_name, test, failures) so a
whole suite is a single UNION of small aggregates; nothing is printed or
collected here.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.functions.dates import NON_DATE_MARKERS
from strata.functions.numeric import money_sum, round_half_up


def _union(parts: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), parts)


def not_null_failures(df: DataFrame, model: str, cols: list[str]) -> DataFrame:
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
    return (counts.unpivot([], cols, "column_name", "failures")
            .select(F.lit(model).alias("model"), "column_name", F.lit("not_null").alias("test"),
                    F.col("failures").cast("bigint").alias("failures")))


def unique_failures(df: DataFrame, model: str, col: str) -> DataFrame:
    """Number of key values that occur more than once (NULLs ignored, like the SQL test)."""
    dup = df.where(F.col(col).isNotNull()).groupBy(col).count().where(F.col("count") > 1)
    return dup.agg(F.count(F.lit(1)).alias("failures")).select(
        F.lit(model).alias("model"), F.lit(col).alias("column_name"), F.lit("unique").alias("test"),
        F.col("failures").cast("bigint"))


def accepted_values_failures(df: DataFrame, model: str, col: str, values: list[str]) -> DataFrame:
    bad = F.count_if(F.col(col).isNotNull() & ~F.col(col).isin(values))
    return df.agg(bad.alias("failures")).select(
        F.lit(model).alias("model"), F.lit(col).alias("column_name"),
        F.lit("accepted_values").alias("test"), F.col("failures").cast("bigint"))


def range_failures(df: DataFrame, model: str, bounds: dict[str, tuple[float, float]]) -> DataFrame:
    """Per column: non-NULL values outside [low, high] (NULL is allowed), one pass."""
    counts = df.agg(*[F.count_if(F.col(c).isNotNull() & ~F.col(c).between(lo, hi)).alias(c)
                      for c, (lo, hi) in bounds.items()])
    return (counts.unpivot([], list(bounds), "column_name", "failures")
            .select(F.lit(model).alias("model"), "column_name", F.lit("accepted_range").alias("test"),
                    F.col("failures").cast("bigint").alias("failures")))


def relationship_failures(child: DataFrame, child_name: str, fk: str,
                          parent: DataFrame, parent_name: str, pk: str) -> DataFrame:
    """Non-NULL foreign keys without a parent row (left anti join), plus NULL keys.

    Child rows are counted per key before the anti join, so the join moves one
    row per distinct key and a key held by a third of the facts is not shuffled
    whole into one task.
    """
    keys = child.select(F.col(fk).alias("_fk"))
    per_key = keys.where(F.col("_fk").isNotNull()).groupBy("_fk").agg(F.count(F.lit(1)).alias("_n"))
    orphans = per_key.join(parent.select(F.col(pk).alias("_fk")), "_fk", "left_anti")
    o = orphans.agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("orphans"))
    n = keys.agg(F.count_if(F.col("_fk").isNull()).alias("null_keys"))
    return o.crossJoin(n).select(
        F.lit(child_name).alias("child"), F.lit(fk).alias("column_name"),
        F.lit(parent_name).alias("parent"), F.col("orphans").cast("bigint"),
        F.col("null_keys").cast("bigint"))


def suite(parts: list[DataFrame]) -> DataFrame:
    return _union(parts)


def _row_groups(df: DataFrame) -> DataFrame:
    """The distinct rows with how often each occurs (``_n``), without ingestion metadata."""
    data = df.drop("_ingested_at", "_source_file")
    return data.groupBy(*data.columns).agg(F.count(F.lit(1)).alias("_n"))


def _rows_where(condition: F.Column | None = None) -> F.Column:
    n = F.col("_n") if condition is None else F.when(condition, F.col("_n"))
    return F.coalesce(F.sum(n), F.lit(0))


def bronze_sales_checks(bronze: DataFrame) -> DataFrame:
    """total, NULL quantity / price and exact duplicates (total - distinct rows), in one pass."""
    return _row_groups(bronze).agg(
        _rows_where().alias("total_records"),
        _rows_where(F.col("quantity").isNull()).alias("null_quantity"),
        _rows_where(F.col("price").isNull()).alias("null_price"),
        (_rows_where() - F.count(F.lit(1))).alias("exact_duplicates"))


def exact_duplicates(df: DataFrame) -> DataFrame:
    return _row_groups(df).agg(
        _rows_where().alias("total_records"), F.count(F.lit(1)).alias("distinct_records"),
        (_rows_where() - F.count(F.lit(1))).alias("exact_duplicates"))


def non_date_counts(bronze_shipments: DataFrame, date_cols: list[str],
                    markers: list[str] = NON_DATE_MARKERS[:2]) -> DataFrame:
    """Per date column: cells holding a sentinel text or NULL (one pass, unpivoted)."""
    present = [c for c in date_cols if c in bronze_shipments.columns]

    def bad(c: str) -> F.Column:
        cond = F.col(c).isNull()
        for m in markers:
            cond = cond | F.col(c).contains(m)
        return F.count_if(cond).alias(c)

    counts = bronze_shipments.agg(*[bad(c) for c in present])
    return counts.unpivot([], present, "column_name", "non_dates").select(
        "column_name", F.col("non_dates").cast("bigint"))


def silver_sales_metrics(silver_sales: DataFrame) -> DataFrame:
    return silver_sales.agg(
        F.count(F.lit(1)).alias("total_records"),
        F.countDistinct("product_name").alias("distinct_products"),
        F.countDistinct("customer_name").alias("distinct_customers"),
        F.countDistinct("country").alias("distinct_countries"))


def frequency(df: DataFrame, key: str, by_key: bool = False) -> DataFrame:
    counts = df.groupBy(key).count()
    order = [F.asc_nulls_first(key)] if by_key else [F.desc("count"), F.asc_nulls_first(key)]
    return counts.orderBy(*order)


def top_by_sum(df: DataFrame, key: str, value: str, n: int = 5, alias: str = "total_sales") -> DataFrame:
    return (df.groupBy(key).agg(round_half_up(money_sum(value), 2).alias(alias))
            .orderBy(F.desc(alias), F.asc_nulls_first(key)).limit(n))


def top_by_count(df: DataFrame, key: str, n: int = 5) -> DataFrame:
    return frequency(df, key).limit(n)


def shipment_quality(silver_shipments: DataFrame) -> DataFrame:
    """Valid-date shares and late deliveries in one pass."""
    m = silver_shipments.agg(
        F.count(F.lit(1)).alias("total_records"),
        F.count("scheduled_delivery_date").alias("valid_scheduled"),
        F.count("delivered_to_client_date").alias("valid_delivered"),
        F.count_if(F.col("is_late_delivery")).alias("late_deliveries"))
    total = F.nullif(F.col("total_records"), F.lit(0))
    return m.withColumns({
        "pct_valid_scheduled": round_half_up(F.col("valid_scheduled") * 100.0 / total, 1),
        "pct_valid_delivered": round_half_up(F.col("valid_delivered") * 100.0 / total, 1),
    })


def lookup_fanout(facts: DataFrame, fact: str, dim: DataFrame, dimension: str, names: dict[str, str]) -> DataFrame:
    """One row: ``fact, dimension, repeated_names, extra_facts``.

    Facts look their keys up by name (``names``: dimension column -> fact column).
    A name with several rows in the dimension multiplies its facts: counted here
    before the join, from one row for each name on both sides, are such names
    and the fact rows that the join would add.  NULL names match nothing.
    """
    known = F.lit(True)
    for c in names:
        known = known & F.col(c).isNotNull()
    repeated = dim.where(known).groupBy(*names).agg(F.count(F.lit(1)).alias("_rows")).where("_rows > 1")
    used = facts.select(*[F.col(f).alias(c) for c, f in names.items()]).where(known).groupBy(*names).agg(F.count(F.lit(1)).alias("_facts"))
    sums = repeated.join(used, list(names), "left").agg(
        F.count(F.lit(1)).alias("repeated_names"),
        F.coalesce(F.sum((F.col("_rows") - 1) * F.col("_facts")), F.lit(0)).cast("bigint").alias("extra_facts"))
    return sums.select(F.lit(fact).alias("fact"), F.lit(dimension).alias("dimension"), "repeated_names", "extra_facts")
