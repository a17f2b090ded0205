"""What the steps cost: tasks of a fit, passes over texts, sorts and joins of the layers."""

import glob
import os
import random

from pyspark.sql import functions as F

from strata.operators import gold, marts, ml
from strata.plans import lakehouse
from strata.plans.lakehouse import Lakehouse
from strata.session import scratch_path, settings
from strata.sources.sinks import write_csv, write_lines
from strata.streaming.orders import run_orders_with_rejects


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_a_fit_of_many_rows_has_few_tasks(spark):
    size = ml.ROWS_PER_PARTITION
    # as many as before while the rows fill at most four
    assert [ml.training_partitions(n) for n in (0, 1, size, size + 1, 2 * size, 3 * size, 4 * size)] == [1, 1, 1, 2, 2, 4, 4]
    assert ml.training_partitions(131 * size) == 32 and ml.training_partitions(787 * size) == 64
    assert all(n * size / ml.training_partitions(n * size) <= ml.MOST_PER_PARTITION * size for n in (1, 10, 1000, 10**5, 10**7))
    frame = ml.training_frame(spark.range(1000), ("id",), rows_per_partition=10)
    assert frame.rdd.getNumPartitions() <= 32 and frame.count() == 1000


def test_a_judged_batch_is_not_kept_in_memory(spark, monkeypatch):
    base = scratch_path(spark, "judged")
    sent = ['{"event_id": "A", "qty": 2}', "#1", "{}", '{"event_id": "B", "qty": "x"}']
    spark.createDataFrame([(x,) for x in sent], "value string").repartition(2).write.text(f"{base}/landing")
    kept = []
    monkeypatch.setattr("pyspark.sql.DataFrame.persist", lambda df, *_: kept.append(df) or df)
    run_orders_with_rejects(spark, f"{base}/landing", f"{base}/in", f"{base}/out", f"{base}/ckpt")
    accepted, rejected = spark.read.parquet(f"{base}/in"), spark.read.parquet(f"{base}/out")
    assert not kept and [(r.event_id, r.qty) for r in accepted.collect()] == [("A", 2)]
    assert sorted((r.payload, r.reason) for r in rejected.collect()) == [("#1", "not_json"), ('{"event_id": "B", "qty": "x"}', "wrong_type"), ("{}", "no_event_id")]
    assert accepted.columns == [c for c in accepted.columns if c not in ("payload", "reason")] and {"_source_file", "_processed_at"} <= set(accepted.columns)
    assert accepted.select("_processed_at").union(rejected.select("_processed_at")).distinct().count() == 1
    assert not glob.glob(f"{os.path.dirname(base).removeprefix('file:')}/judged-batch-*")


def test_landed_text_is_packed_in_less_time(spark):
    words = spark.range(20000).select(F.concat(F.lit("Customer "), F.col("id") * 7919 % 3001, F.lit(" buys "), F.col("id") % 173).alias("value"))
    for write, plain in ((write_lines, "text"), (write_csv, "csv")):
        ours, usual = scratch_path(spark, "packed"), scratch_path(spark, "usual")
        write(words.coalesce(1), ours)
        words.coalesce(1).write.option("compression", "gzip").format(plain).save(usual)
        size = lambda path: sum(os.path.getsize(f) for f in glob.glob(f"{path.removeprefix('file:')}/part-*.gz"))
        assert 1.02 * size(usual) < size(ours) < 2 * size(usual)


def test_facts_hash_the_dimensions(spark, sf_dir):
    lake = Lakehouse.get(spark, sf_dir)
    dims = lake.dim_time(), lake.dim_product(), lake.dim_customer(), lake.dim_sales_rep()
    usual = lake.fact_sales()
    no_broadcast = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}
    with settings(spark, no_broadcast | lakehouse.LOOKING_UP):
        facts = gold.fact_sales(lake.silver_sales(), *dims)
        rows = facts.collect()
        plan = _plan(facts)
    final = plan.split("== Initial Plan ==")[0]
    assert "ShuffledHashJoin" in final and "SortMergeJoin" not in final
    assert sorted(str(tuple(r)[1:]) for r in rows) == sorted(str(tuple(r)[1:]) for r in usual.collect())


def test_lookups_are_made_under_their_setting(spark, sf_dir, monkeypatch):
    name, seen = "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold", []
    for f in ("fact_sales", "fact_orders"):
        made = getattr(gold, f)
        monkeypatch.setattr(gold, f, lambda *a, made=made: (seen.append(spark.conf.get(name)), made(*a))[1])
    before = spark.conf.get(name, None)
    lake = Lakehouse(spark, sf_dir)
    assert lake.fact_sales().count() and lake.fact_orders().count()
    assert seen == ["64m", "64m"] and spark.conf.get(name, None) == before


def test_product_mart_counts_apart_from_its_sums(spark):
    pick = random.Random(11)
    some = lambda *x: pick.choice([None, *x])
    rows = [(some(1, 2, 3), some(1, 2), some(1, 2, 3), some(1, 2, 3), some(0.5, 2.25), some(10.0, 0.0), some("ES", "FR"), some("A", "B", "C")) for _ in range(200)] + [(4, None, None, None, None, None, None, None)]
    fact = spark.createDataFrame(rows, "product_sk long, customer_sk long, sales_rep_sk long, qty int, price double, sales double, country string, city string")
    dim = spark.createDataFrame([(k, f"P{k}", "C") for k in (1, 2, 3, 4, 5)], "product_sk long, product_name string, product_class string")
    mart = marts.product_performance(fact, dim)
    got = {r.product_sk: r for r in mart.collect()}
    assert set(got) == {1, 2, 3, 4}
    for k, r in got.items():
        mine = [x for x in rows if x[0] == k]
        count = lambda i, mine=mine: len({x[i] for x in mine} - {None})
        assert (r.customers_reached, r.sales_reps_selling, r.countries_sold, r.cities_sold, r.total_transactions) == (count(1), count(2), count(6), count(7), len(mine))
        total = [x[5] for x in mine if x[5] is not None]
        assert r.total_sales == (sum(total) if total else None)
        assert r.sales_per_customer == (round(sum(total) / count(1) + 1e-9, 2) if total else None)
    expands = [line for line in mart._jdf.queryExecution().optimizedPlan().toString().splitlines() if "Expand" in line]
    assert expands and not any("price" in line or "sales#" in line for line in expands)


def test_a_task_of_bronze_reads_a_packed_file(spark, sf_dir, monkeypatch):
    name, seen = "spark.sql.files.maxPartitionBytes", []
    for f in ("run_csv_to_bronze", "run_orders_to_bronze"):
        made = getattr(lakehouse, f)
        monkeypatch.setattr(lakehouse, f, lambda *a, made=made: (seen.append(spark.conf.get(name)), made(*a))[1])
    lake = Lakehouse(spark, sf_dir)
    assert lake.bronze_sales().count() and lake.bronze_orders().count()
    assert seen == ["32m", "32m"]
