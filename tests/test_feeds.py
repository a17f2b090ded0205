"""Feeds: new files only, each event once, and no payload lost."""

from collections import Counter

from pyspark.sql import functions as F

from strata.operators import ml, silver
from strata.schemas import SALES_CSV_SCHEMA, all_strings
from strata.session import scratch_path
from strata.sources.sinks import write_csv
from strata.streaming.feeds import run_csv_to_bronze
from strata.streaming.orders import judge_payloads, run_orders_once_each, run_orders_with_rejects

import pytest


def sales(spark, names):
    cells = {f.name: F.lit(None).cast(f.dataType).alias(f.name) for f in SALES_CSV_SCHEMA.fields}
    rows = spark.createDataFrame([(n,) for n in names], "n string")
    return rows.select(*[F.col("n").alias(c) if c == "Customer Name" else F.lit(7).cast("int").alias(c) if c == "Quantity" else x for c, x in cells.items()])


def test_bronze_takes_new_files_only(spark):
    base = scratch_path(spark, "feed")

    def run():
        n = run_csv_to_bronze(spark, f"{base}/landing/*", f"{base}/bronze", f"{base}/ckpt", SALES_CSV_SCHEMA, silver.bronze_sales)
        return n, spark.read.parquet(f"{base}/bronze").count()

    write_csv(sales(spark, ["A", " B "]), f"{base}/landing/day=1")
    assert run() == (2, 2) and run() == (0, 2)
    write_csv(sales(spark, ["C"]), f"{base}/landing/day=2")
    assert run() == (1, 3)
    rows = spark.read.parquet(f"{base}/bronze")
    assert {r.customer_name for r in rows.collect()} >= {"A", "C"} and rows.select("_source_file").distinct().count() >= 2
    assert rows.where("quantity = 7 and _ingested_at is not null").count() == 3


def test_a_file_with_other_columns_is_an_error(spark):
    base = scratch_path(spark, "feed-bad")
    write_csv(spark.createDataFrame([("x", "y")], "a string, c string"), f"{base}/landing")
    with pytest.raises(Exception):
        run_csv_to_bronze(spark, f"{base}/landing", f"{base}/bronze", f"{base}/ckpt", all_strings(["a", "b"]), silver.bronze_sales)


def test_duplicates_over_two_runs_give_one_row(spark):
    base = scratch_path(spark, "once")

    def run(*events):
        spark.createDataFrame([(e,) for e in events], "value string").coalesce(1).write.mode("append").text(f"{base}/landing")
        run_orders_once_each(spark, f"{base}/landing", f"{base}/out", f"{base}/ckpt")
        return sorted(r.event_id for r in spark.read.parquet(f"{base}/out").collect())

    event = lambda i, t="2020-01-01T00:00:00": f'{{"event_id": "{i}", "event_ts": "{t}", "qty": 1}}'
    assert run(event("A"), event("B"), event("A"), "#junk") == ["A", "B"]
    assert run(event("A"), event("C"), event("C")) == ["A", "B", "C"]
    assert run(event("D", "1990-01-01T00:00:00"), event("B")) == ["A", "B", "C", "D"]  # an old event that comes late stays


def test_reasons(spark):
    payloads = {'{"event_id": "E", "qty": 2}': None, "": "empty", "  ": "empty", None: "empty", "#x": "not_json", '{"event_id": "E", ': "not_json",
                '{"event_id": "E", "qty": "two"}': "wrong_type", "[1, 2]": "wrong_type", "17": "wrong_type", '{"qty": 2}': "no_event_id", "{}": "no_event_id"}
    raw = spark.createDataFrame([(p, 3, i) for i, p in enumerate(payloads)], "value string, partition int, offset long")
    rows = judge_payloads(raw).collect()
    assert [(r.payload, r.reason) for r in rows] == list(payloads.items())
    assert [r._kafka_offset for r in rows] == list(range(len(payloads))) and all(r._processed_at for r in rows)
    assert rows[0].qty == 2 and judge_payloads(raw.select("value")).first()._kafka_offset is None


def test_rejected_and_accepted_are_all(spark):
    base = scratch_path(spark, "judged")
    sent = []
    for day, lines in enumerate([['{"event_id": "A"}', "#1", '{"event_id": "A"}'], ["#2", "{}"]]):
        sent += lines
        spark.createDataFrame([(x,) for x in lines], "value string").repartition(2).write.mode("append").text(f"{base}/landing")
        for _ in range(2):  # a second run finds nothing new
            run_orders_with_rejects(spark, f"{base}/landing", f"{base}/in", f"{base}/out", f"{base}/ckpt", max_files_per_trigger=1)
    accepted, rejected = spark.read.parquet(f"{base}/in"), spark.read.parquet(f"{base}/out")
    assert accepted.count() + rejected.count() == len(sent)
    assert Counter(r.payload for r in rejected.collect()) == Counter(["#1", "#2", "{}"]) and accepted.where("event_id = 'A'").count() == 2


def test_filled_series(spark):
    rows = [("P", "ES", 2000, 1, 10.0, 1, 1, 5.0), ("P", "ES", 2000, 4, 40.0, 4, 1, 6.0), ("P", None, 2000, 2, 1.0, 1, 1, None), ("Q", "ES", None, 1, 9.0, 1, 1, 1.0)]
    monthly = spark.createDataFrame(rows, "product_name string, country string, year int, month int, total_sales double, total_quantity long, num_transactions long, avg_price double")
    monthly = monthly.withColumn("year_month", F.make_date("year", "month", F.lit(1)))
    got = {(r.product_name, r.country, r.year, r.month): (r.total_sales, r.total_quantity, r.num_transactions, r.avg_price, r.filled) for r in ml.fill_gaps(monthly).collect()}
    assert got == {("P", "ES", 2000, 1): (10.0, 1, 1, 5.0, False), ("P", "ES", 2000, 2): (0.0, 0, 0, 5.0, True), ("P", "ES", 2000, 3): (0.0, 0, 0, 5.0, True),
                   ("P", "ES", 2000, 4): (40.0, 4, 1, 6.0, False), ("P", None, 2000, 2): (1.0, 1, 1, None, False)}
    assert ml.fill_gaps(monthly.limit(0)).count() == 0


def test_leak_free_features_know_nothing_of_their_month(spark):
    base = [("P", "ES", 2000 + m // 12, m % 12 + 1, float(m * m), m, 1, m + 0.5) for m in range(20)]
    kind = "product_name string, country string, year int, month int, total_sales double, total_quantity long, num_transactions long, avg_price double"

    def features(rows):
        monthly = spark.createDataFrame(rows, kind).withColumn("year_month", F.make_date("year", "month", F.lit(1)))
        return [tuple(r) for r in ml.forecast_features(monthly, leak_free=True).orderBy("year_month").select(*ml.LEAK_FREE_FEATURES).collect()]

    changed = base[:-1] + [(*base[-1][:4], 1e6, 999, 1, 77.0)]
    assert features(base) == features(changed) and len(features(base)) == 17


def test_training_frame_follows_the_rows(spark):
    df = spark.range(1000).withColumn("k", F.col("id") % 7)
    for limit, parts in ((1000, 1), (500, 2), (300, 4), (1 << 17, 1)):
        frame = ml.training_frame(df, ("k", "id"), limit)
        assert frame.rdd.getNumPartitions() <= parts and frame.count() == 1000
    assert ml.training_frame(df.limit(0), ("k",)).count() == 0
