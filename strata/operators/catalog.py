"""Reference catalogs derived from the raw sales feed (products, customers, channels, reps).

The attribute picked for a key is the smallest value (or the smallest tuple,
so related attributes come from one row): deterministic on any partitioning.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def product_price_range(bronze: DataFrame) -> DataFrame:
    """Per product: a class and the observed price range (missing price counts as 0)."""
    price = F.coalesce(F.col("price").try_cast("double"), F.lit(0.0))
    return (bronze.select(F.trim("product_name").alias("product_name"),
                          F.trim("product_class").alias("product_class"), price.alias("price"))
            .groupBy("product_name").agg(F.min("product_class").alias("product_class"),
                                         F.min("price").alias("price_min"),
                                         F.max("price").alias("price_max")))


def sub_channels(bronze: DataFrame) -> DataFrame:
    """Distinct (channel, sub_channel) pairs, lower-cased (a flat list, not an array per channel)."""
    return (bronze.select(F.lower(F.trim("channel")).alias("channel"),
                          F.lower(F.trim("sub_channel")).alias("sub_channel"))
            .where(F.col("sub_channel").isNotNull() & (F.col("sub_channel") != ""))
            .distinct())


def domains(bronze: DataFrame) -> DataFrame:
    """Distinct countries and channels as (domain, value) rows."""
    countries = bronze.select(F.lit("country").alias("domain"), F.trim("country").alias("value"))
    channels = bronze.select(F.lit("channel").alias("domain"), F.lower(F.trim("channel")).alias("value"))
    return countries.unionByName(channels).distinct()


def sales_reps(bronze: DataFrame) -> DataFrame:
    """Per rep: manager and team taken together from one row."""
    rep = F.struct(F.trim("manager").alias("manager"), F.trim("sales_team").alias("sales_team"))
    return (bronze.where(F.col("name_of_sales_rep").isNotNull())
            .groupBy(F.trim("name_of_sales_rep").alias("sales_rep_name"))
            .agg(F.min(rep).alias("_r"))
            .select("sales_rep_name", F.col("_r.manager").alias("manager"),
                    F.col("_r.sales_team").alias("sales_team")))
