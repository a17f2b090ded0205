"""What the layers leave on disk: landed text is packed, shuffles and scratch copies go, tables are small."""

import glob
import gzip
import os
import random
import time

import pytest
from pyspark.sql import functions as F

from strata.functions import text as T
from strata.functions.keys import dense_key
from strata.operators import ml, silver
from strata.plans.lakehouse import Lakehouse
from strata.session import SHUFFLE_CLEANUP, scratch_path
from strata.sources import adapter
from strata.sources.tables import Tables


def _local(path):
    return path.removeprefix("file:")


def test_landed_feeds_are_packed(spark, sf_dir):
    lake = Lakehouse(spark, sf_dir)
    for folder, first in ((lake.sales_csv(), "Distributor"), (lake.order_events(), None)):
        files = glob.glob(f"{_local(folder)}/part-*")
        assert files and all(f.endswith(".gz") for f in files)
        if first:
            with gzip.open(files[0], "rt") as text:
                assert text.read().startswith(first)
    assert lake.bronze_orders().count() == lake.landing_lines().count()
    assert all(".zstd." in f for f in glob.glob(f"{_local(lake.path('landing_lines'))}/part-*"))


def test_settings_are_put_back(spark, sf_dir):
    names = (SHUFFLE_CLEANUP, "spark.sql.files.maxPartitionBytes")
    before = [spark.conf.get(n, None) for n in names]
    Lakehouse(spark, sf_dir).landing_lines()
    assert [spark.conf.get(n, None) for n in names] == before


def test_small_sides_of_the_landing_join_are_broadcast(spark, sf_dir, monkeypatch):
    name, seen = "spark.sql.adaptive.autoBroadcastJoinThreshold", []
    lines = adapter.landing_lines
    monkeypatch.setattr(adapter, "landing_lines", lambda tables: (seen.append(spark.conf.get(name)), lines(tables))[1])
    before = spark.conf.get(name, None)
    Lakehouse(spark, sf_dir).landing_lines()
    assert seen == ["64m"] and spark.conf.get(name, None) == before


def test_invalid_sales_go_before_their_texts_are_cleaned(spark):
    texts = [None, "", "  ", " a  b ", "c"]
    rows = [(f"{t}", t, t, t, q, p, t) for i, t in enumerate(texts) for q in ("1", "0", None) for p in ("2.5", "x", None)]
    raw = spark.createDataFrame(rows, "name string, distributor string, customer_name string, product_name string, quantity string, price string, country string")
    bronze = raw.select("*", *[F.lit("1").alias(c) for c in silver.SALES_COLUMNS if c not in raw.columns])
    got = silver.silver_sales(bronze)
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "initcap" in plan and not any("initcap" in line for line in plan.splitlines() if "Filter" in line)
    old = silver.dedup_sales(silver.filter_sales_valid(silver.type_sales(silver.clean_sales(bronze)))).select(*silver.SALES_COLUMNS)
    assert got.count() == 3 and sorted(map(str, got.collect())) == sorted(map(str, old.collect()))


def test_dense_key_leaves_only_the_numbered_rows(spark):
    root = os.path.dirname(_local(scratch_path(spark)))
    before = set(glob.glob(f"{root}/key-*"))
    assert dense_key(spark.range(1000).select(F.hash("id").alias("k")), ["k"], "n").agg(F.max("n")).first()[0] == 1000
    assert [os.path.basename(p).rsplit("-", 1)[0] for p in set(glob.glob(f"{root}/key-*")) - before] == ["key-sorted"]


def test_collapse_space_is_the_regular_expression(spark):
    pick = random.Random(3)
    texts = ["".join(pick.choice(" \t\n\x0b\f\rab é") for _ in range(pick.randrange(9))) for _ in range(500)] + [None, "a b c", " a"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    assert df.where(~T.collapse_space(F.col("t")).eqNullSafe(F.regexp_replace("t", r"\s+", " "))).isEmpty()


def test_landing_carries_each_key_once(spark, sf_dir):
    columns = adapter.landing_lines(Tables(spark, sf_dir)).columns
    assert {"l_orderkey", "l_partkey", "o_custkey"} <= set(columns)
    assert not {"o_orderkey", "p_partkey", "c_custkey", "l_suppkey", "s_suppkey"} & set(columns)


def _sales(spark):
    rows = [(f"C{i}", f"P{i % 3}", "ES", 1 + i % 5, 2.5, 10.0 * (i + 1), "January February March April May June July August September October November December".split()[i // 3 % 12], 2000 + i // 36)
            for i in range(108)]
    return spark.createDataFrame(rows, "customer_name string, product_name string, country string, quantity int, price double, sales double, month string, year int")


def test_forecast_features_are_computed_once(spark):
    held = []
    forecast = ml.naive_demand_forecast(_sales(spark), cached=held)
    # the split date, the metrics and the rows all read the written features
    assert "Window" not in forecast._jdf.queryExecution().optimizedPlan().toString()
    assert forecast.count() == 3 * 7 and forecast.select("model_rmse").distinct().count() == 1
    frame = ml.training_frame(ml.forecast_features(ml.monthly_demand(_sales(spark))), ("product_name", "year_month"), finish=ml.split_train_test)
    assert "Window" not in frame._jdf.queryExecution().optimizedPlan().toString()
    assert {(r.split, r["count"]) for r in frame.groupBy("split").count().collect()} == {("test", 21), ("train", 78)}
    ml.release([*held, frame])
    assert not any(os.path.exists(_local(os.path.dirname(f))) for df in (*held, frame) for f in df.inputFiles())


def test_model_outputs_leave_no_training_rows(spark, sf_dir):
    root = os.path.dirname(_local(scratch_path(spark)))
    made = lambda: set(glob.glob(f"{root}/training-frame-*") + glob.glob(f"{root}/forecast-features-*"))
    before = made()
    lake = Lakehouse(spark, sf_dir)
    assert lake.naive_forecast().count() and lake.ml_customer_clusters().count()
    assert made() == before


def test_training_rows_leave_no_shuffle_files(spark):
    def files():
        return set(glob.glob(f"{spark.conf.get('spark.local.dir', '/tmp')}/blockmgr-*/*/shuffle_*.data"))

    before = files()
    frame = ml.training_frame(spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count(), ("k",))
    for _ in range(100):
        if not files() - before:
            break
        time.sleep(0.1)
    assert not files() - before and frame.count() == 7
    ml.release([frame])


def test_layers_made_only_for_the_next_one_go_with_it(spark, sf_dir):
    lake = Lakehouse(spark, sf_dir)
    made = lambda: set(os.listdir(_local(lake.root)))
    sold, ordered, shipped = lake.silver_sales(), lake.silver_orders(), lake.silver_shipments()
    assert made() == {"landing_lines", "silver_sales", "silver_orders", "silver_shipments"}
    assert sold.count() and ordered.count() and shipped.count()
    # who asks for such a layer later gets all of it anew, and keeps it
    bronze, events = lake.bronze_sales(), lake.bronze_orders()
    assert bronze.count() == adapter.sales_wide(Tables(spark, sf_dir)).count() and events.count() == lake.landing_lines().count()
    again = silver.silver_sales(bronze)
    assert again.exceptAll(sold).isEmpty() and sold.exceptAll(again).isEmpty()
    assert made() >= {"bronze_sales", "bronze_orders"} and not made() & {"landing_sales_csv", "landing_orders", "landing_shipments_csv"}


def test_layers_asked_for_before_stay(spark, sf_dir):
    lake = Lakehouse(spark, sf_dir)
    csv, events, bronze = lake.sales_csv(), lake.order_events(), lake.bronze_sales()
    assert lake.silver_sales().count() and lake.silver_orders().count()
    assert bronze.count() == spark.read.option("header", "true").csv(csv).count() and spark.read.text(events).count() == lake.landing_lines().count()
    assert not os.path.exists(_local(lake.path("bronze_orders")))


def test_layers_stay_for_the_next_attempt(spark, sf_dir, monkeypatch):
    lake = Lakehouse(spark, sf_dir)
    with monkeypatch.context() as broken, pytest.raises(ZeroDivisionError):
        broken.setattr(silver, "silver_orders", lambda bronze: 1 / 0)
        lake.silver_orders()
    assert lake.bronze_orders().count() == lake.landing_lines().count()
    assert lake.silver_orders().count() and lake.bronze_orders().count()
