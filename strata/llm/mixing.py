"""Mixing sources to target weights by Pfair scheduling, with DataFrame functions only.

Each source's rows are cut into blocks.  A source of weight w may run its k-th
block (from 0) from slot floor(k / w) on and must run it before slot
ceil((k + 1) / w).  Earliest deadline first over these windows keeps every
source within less than one block of its target at every slot.  Weights are
whole shares of a period, so the schedule repeats: one fold over the slots of a
single period gives the pattern, and a block's slot follows from its number.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: rows of a fine bucket of the ranking, about
BUCKET_ROWS = 256


def shares(counts: DataFrame, weights: dict[str | None, float] | None, power: float, period: int, n_sources: int) -> DataFrame:
    """``source, share, place``: whole shares that sum to ``period``, at least 1 each, by largest remainders."""
    if weights is None:
        weight = F.round(F.pow(F.col("rows").cast("double"), F.lit(power)) * 1000)
    else:
        given = F.create_map(*(F.lit(x) for k, w in weights.items() if k is not None for x in (k, float(w)))) if any(k is not None for k in weights) else None
        weight = F.when(F.col("source").isNull(), F.lit(float(weights.get(None, 0))))
        weight = F.round(F.coalesce(weight.otherwise(given[F.col("source")]) if given is not None else weight, F.lit(0.0)) * 1_000_000)
    everything = Window.partitionBy()  # a row a source
    left = period - n_sources
    w = counts.withColumn("weight", F.greatest(weight.cast("long"), F.lit(1)))
    w = w.withColumn("total", F.sum("weight").over(everything))
    w = w.withColumn("whole", F.expr(f"1 + ({left} * weight) div total")).withColumn("rest", F.expr(f"({left} * weight) % total"))
    extra = F.row_number().over(Window.partitionBy().orderBy(F.desc("rest"), F.asc_nulls_first("source")))
    w = w.withColumn("extra", extra).withColumn("spare", F.lit(period) - F.sum("whole").over(everything))
    share = (F.col("whole") + (F.col("extra") <= F.col("spare")).cast("int")).cast("long")
    place = F.row_number().over(Window.partitionBy().orderBy(F.asc_nulls_first("source"))) - 1
    return w.select("source", share.alias("share"), place.alias("place"))


def release(k: Column, share: Column, period: int) -> Column:
    """The first slot in which the source's block k may run."""
    return F.floor(k * period / share).cast("long")


def deadline(k: Column, share: Column, period: int) -> Column:
    """The slot before which the source's block k must have run."""
    return F.ceil((k + 1) * period / share).cast("long")


def pattern(shared: DataFrame, period: int) -> DataFrame:
    """``source, share, slots``: the slots of one period that earliest deadline first gives each source."""
    all_shares = F.transform(F.array_sort(F.collect_list(F.struct("place", "share"))), lambda s: s["share"])
    one = shared.agg(all_shares.alias("shares"))

    def rated(state: Column) -> Column:
        pairs = F.zip_with(state["done"], F.col("shares"), lambda k, share: F.struct(k.alias("k"), share.alias("share")))
        return F.transform(pairs, lambda x, i: F.struct(deadline(x["k"], x["share"], period).alias("deadline"), i.alias("i"), release(x["k"], x["share"], period).alias("release")))

    def step(state: Column, slot: Column) -> Column:
        pick = F.array_min(F.filter(rated(state), lambda x: x["release"] <= slot))["i"]
        picked = F.transform(F.array(pick), lambda p: F.struct(
            F.transform(state["done"], lambda k, i: k + (i == p).cast("long")).alias("done"), F.concat(state["picks"], F.array(p)).alias("picks")))
        return F.get(picked, F.lit(0))

    zero = F.struct(F.transform("shares", lambda s: F.lit(0).cast("long")).alias("done"), F.array().cast("array<int>").alias("picks"))
    picks = F.aggregate(F.sequence(F.lit(0), F.lit(period - 1)), zero, step)["picks"]
    slots = one.select(F.posexplode(picks).alias("slot", "place")).groupBy("place").agg(F.sort_array(F.collect_list("slot")).alias("slots"))
    return shared.join(slots, "place").select("source", "share", "slots")


def mix(df: DataFrame, source_col: str = "source", id_col: str = "doc_id", weights: dict[str | None, float] | None = None,
        power: float = 0.5, block_rows: int = 64, period: int = 1024) -> DataFrame:
    """All rows, as ``row`` (a struct of the columns of ``df``), with their place in the mix.

    Returns ``row, source, block, in_block, share, release, deadline, slot``:
    ordered by (slot, in_block) the rows are the mix.  The target weight of a
    source is ``weights[source]`` (sources not named get the least share), or,
    without ``weights``, its number of rows to the ``power``.  Weights are
    rounded to whole shares of ``period`` slots (of 4 x the number of sources,
    if that is more), at least one each; after any number of slots a source has
    had its weight x slots blocks, give or take less than one, as long as it has
    rows.  No row is dropped or repeated: where a source has run out, its slots
    stay empty.  A null source is a source of its own.  In its source a row is
    ranked by the md5 of its id, then the id, then the hash of the row, so
    repeated rows take neighbouring places.  No rows give no rows.

    The rank comes from counts of fine buckets of the hash, summed in two
    levels, so that no window holds more than a bucket of a source's rows.
    """
    spark = df.sparkSession
    key = F.conv(F.substring(F.md5(F.coalesce(F.col(id_col).cast("string"), F.lit(""))), 1, 12), 16, 10).cast("long")
    rows = df.select(F.struct(*(df[c] for c in df.columns)).alias("row"), df[source_col].alias("source"), df[id_col].alias("id"),
                     key.alias("key"), F.xxhash64(*(df[c] for c in df.columns)).alias("tie"))
    sizes = rows.groupBy("source").agg(F.count("*").alias("rows"))
    n_sources, total = sizes.agg(F.count("*"), F.sum("rows")).first()
    period = max(period, 4 * n_sources, 1)
    bits = min(40, max(0, ((total or 0) // BUCKET_ROWS).bit_length()))
    rows = rows.withColumn("fine", F.shiftright("key", 48 - bits)).withColumn("coarse", F.shiftright("key", 48 - bits // 2))
    before = lambda *by: F.coalesce(F.sum("n").over(Window.partitionBy(*by[:-1]).orderBy(by[-1]).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    fine = rows.groupBy("source", "coarse", "fine").agg(F.count("*").alias("n"))
    coarse = fine.groupBy("source", "coarse").agg(F.sum("n").alias("n")).withColumn("start", before("source", "coarse")).select(F.col("source").alias("s1"), F.col("coarse").alias("c1"), "start")
    offsets = (fine.withColumn("within", before("source", "coarse", "fine"))
               .join(coarse, F.col("source").eqNullSafe(F.col("s1")) & (F.col("coarse") == F.col("c1")))
               .select(F.col("source").alias("s2"), F.col("fine").alias("f2"), (F.col("start") + F.col("within")).alias("offset")))
    in_bucket = F.row_number().over(Window.partitionBy("source", "fine").orderBy("key", F.asc_nulls_first("id"), "tie")) - 1
    ranked = (rows.withColumn("in_bucket", in_bucket)
              .join(offsets, F.col("source").eqNullSafe(F.col("s2")) & (F.col("fine") == F.col("f2")))
              .withColumn("rank", F.col("offset") + F.col("in_bucket")))
    table = pattern(shares(sizes, weights, power, period, n_sources), period).withColumnRenamed("source", "s3")
    if n_sources <= 10_000:  # a row a source, max(period, 4 x sources) slots in all
        table = F.broadcast(table)
    placed = ranked.join(table, F.col("source").eqNullSafe(F.col("s3"))).withColumn("block", F.floor(F.col("rank") / block_rows))
    slot = F.floor(F.col("block") / F.col("share")) * period + F.get("slots", (F.col("block") % F.col("share")).cast("int"))
    return placed.select("row", "source", "block", (F.col("rank") % block_rows).cast("int").alias("in_block"), "share",
                         release(F.col("block"), F.col("share"), period).alias("release"),
                         deadline(F.col("block"), F.col("share"), period).alias("deadline"), slot.cast("long").alias("slot"))
