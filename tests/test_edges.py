"""Values and tables at the edge: money digits, empty denominators, broken folders, odd months."""

import subprocess
import sys
import textwrap

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from strata.functions.numeric import money_avg, money_sum, round_half_up
from strata.operators import gold, kpis, marts, ml, quality
from strata.schemas import FACT_ORDERS_SCHEMA
from strata.session import scratch_path
from strata.sources import adapter
from strata.sources.sinks import write_keep_schema
from strata.sources.tables import load_safe


def test_money_keeps_its_digits(spark):
    small = spark.range(1000).select(F.lit(0.004).alias("sales"), F.lit("a").alias("channel"), F.lit(1).alias("qty"))
    assert small.agg(money_sum("sales"), money_avg("sales")).first() == (4.0, 0.004)
    assert kpis.sales_by_channel(small).first().ventas_totales == 4.0
    assert kpis.per_key(small, "channel").select(kpis.money_total(F.col("_msum"), F.col("_mrest"))).first()[0] == 4.0


def test_money_takes_large_values_and_nulls(spark):
    df = spark.createDataFrame([(2e16,), (0.25,), (None,)], "x double")
    assert df.agg(money_sum("x"), money_avg("x")).first() == (2e16 + 0.25, (2e16 + 0.25) / 2)
    huge = spark.createDataFrame([(1e300,), (1.5,)], "x double")
    assert huge.agg(money_sum("x")).first()[0] == 1e300 and huge.select(round_half_up("x")).first()[0] == 1e300
    empty = df.limit(0)
    assert empty.agg(money_sum("x"), money_avg("x")).first() == (None, None)


def test_r2_of_a_constant_label_is_null(spark):
    row = ml.regression_metrics(spark.createDataFrame([(5.0, 4.0)] * 3, "total_sales double, predicted_sales double")).first()
    assert (row.rmse, row.mae, row.r2, row.n) == (1.0, 1.0, None, 3)


def test_quantity_zero_gives_no_price(spark):
    lines = spark.createDataFrame([(10.0, 0.0), (10.0, 4.0)], "l_extendedprice double, l_quantity double")
    assert [r[0] for r in lines.select(adapter._unit_price()).collect()] == [None, 2.5]


def test_safe_load_raises_for_a_broken_folder(spark):
    path = scratch_path(spark, "broken")
    spark.createDataFrame([("junk",)], "v string").write.text(path)
    with pytest.raises(Exception) as error:
        load_safe(spark, path, spark.range(1).schema).collect()
    assert not isinstance(error.value, AnalysisException) or error.value.getCondition() != "PATH_NOT_FOUND"
    assert load_safe(spark, path + "-none", spark.range(1).schema).count() == 0


def test_calendar_takes_any_month_text(spark):
    sales = spark.createDataFrame([(2000, "January"), (2000, "Januray"), (2001, None), (None, "May")] * 2, "year int, month string")
    rows = {(r.year, r.month): r for r in gold.dim_time(sales).collect()}
    assert sorted(r.time_sk for r in rows.values()) == [1, 2, 3, 4]
    assert rows[2000, "Januray"].month_num is None and rows[2000, "January"].quarter_name == "Q1"


def test_duplicates_of_rows_with_nulls_and_of_no_rows(spark):
    df = spark.createDataFrame([(1, None, "x")] * 3 + [(None, 2.0, "y")], "quantity int, price double, _source_file string")
    assert quality.bronze_sales_checks(df).first().asDict() == {"total_records": 4, "null_quantity": 1, "null_price": 3, "exact_duplicates": 2}
    assert tuple(quality.exact_duplicates(df.limit(0)).first()) == (0, 0, 0)


def test_geographic_means_are_weighted_and_skip_nulls(spark):
    fact = spark.createDataFrame([(1, 1, 1, 2.0, 1), (1, 1, 1, 4.0, 1), (2, None, 1, None, None)], "customer_sk long, sales_rep_sk long, product_sk long, sales double, qty int")
    dim = spark.createDataFrame([(1, "ES", "X", 10.0, 1.0), (2, "ES", "X", 40.0, None)], "customer_sk long, country string, city string, latitude double, longitude double")
    row = marts.geographic_analysis(fact, dim).first()
    assert (row.total_transactions, row.total_sales, row.avg_transaction_value, row.avg_latitude, row.avg_longitude) == (3, 6.0, 3.0, 20.0, 1.0)


def test_segments_do_not_depend_on_the_cores(sf_dir):
    """The same customers in the same segments with 2 and with 4 cores."""
    script = textwrap.dedent("""
        import sys
        from strata.operators import ml
        from strata.plans.lakehouse import Lakehouse
        from strata.session import local_session
        spark = local_session(sys.argv[1])
        rows = ml.customer_segments(Lakehouse.get(spark, sys.argv[2]).silver_sales())[0].collect()
        print("SEGMENTS", sorted((r.customer_id, r.cluster_label) for r in rows))
    """)
    out = [subprocess.run([sys.executable, "-c", script, cores, sf_dir], capture_output=True, text=True, timeout=300, check=True).stdout.partition("SEGMENTS")[2] for cores in ("2", "4")]
    assert out[0] and out[0] == out[1]


def test_gold_with_an_order_feed_that_never_came(spark, sf_dir, tmp_path):
    from strata.plans.lakehouse import Lakehouse
    lh = Lakehouse(spark, sf_dir)
    lh._landed("landing_orders", lambda path: spark.createDataFrame([], "value string").write.text(path))
    assert lh.fact_orders().count() == 0 and set(lh.fact_orders().columns) == {f.name for f in FACT_ORDERS_SCHEMA}
    assert lh.dim_time().count() > 0 and lh.fact_sales().count() > 0


def test_bronze_rows_name_their_files(spark, sf_dir):
    from strata.plans.lakehouse import Lakehouse
    lh = Lakehouse.get(spark, sf_dir)
    names = {r[0] for r in lh.bronze_sales().select("_source_file").distinct().collect()}
    assert names and all(n.startswith("part-") and n.endswith(".csv") for n in names)


def test_write_keep_schema_refuses_another_schema(spark):
    path = scratch_path(spark, "keep")
    write_keep_schema(spark.range(3), path)
    write_keep_schema(spark.range(5), path)
    with pytest.raises(ValueError):
        write_keep_schema(spark.range(5).withColumn("x", F.lit(1)), path)
    assert spark.read.parquet(path).count() == 5


def test_checks_scan_the_written_marts(spark, sf_dir):
    from strata.plans.registry import QUERIES
    for name in ("dq_not_null", "dq_unique", "dq_accepted_values"):
        plan = QUERIES[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
        assert "Join" not in plan and "Window" not in plan, name


def test_customer_history_closes_older_versions(spark):
    rows = [("A", "X", "January", 2001), ("A", "X", "May", 2000), ("A", "Y", "March", 2002), ("B", "Z", None, 2001)]
    sales = spark.createDataFrame(rows, "customer_name string, city string, month string, year int").selectExpr(
        "*", "'ES' as country", "1.0 as latitude", "2.0 as longitude", "'c' as channel", "null as sub_channel")
    got = {(r.customer_name, r.city): (str(r._valid_from), r._valid_to and str(r._valid_to), r._is_current) for r in gold.customer_history(sales).collect()}
    assert got == {("A", "X"): ("2000-05-01", "2002-03-01", False), ("A", "Y"): ("2002-03-01", None, True), ("B", "Z"): ("2001-01-01", None, True)}


def test_delivery_columns(spark):
    from strata.streaming.orders import with_delivery
    raw = spark.createDataFrame([('{"event_id": "E1"}', 3, 77), ("#junk", 3, 78)], "value string, partition int, offset long")
    rows = with_delivery(raw).collect()
    assert [(r.event_id, r._kafka_partition, r._kafka_offset) for r in rows] == [("E1", 3, 77), (None, 3, 78)] and rows[0]._processed_at
    assert with_delivery(raw.select("value")).first()._kafka_offset is None


def test_country_names(spark):
    from strata.functions.text import country_name
    df = spark.createDataFrame([(" de",), ("Spain",), (None,), ("XX",)], "c string")
    assert [r[0] for r in df.select(country_name("c")).collect()] == ["Germany", "Spain", None, "XX"]
