"""Overwrites that fail leave the old rows; published models are read by name; names that would multiply facts are counted."""

import threading
import time

import pytest
from pyspark.sql import functions as F

from strata.operators import quality
from strata.plans.lakehouse import Lakehouse
from strata.plans.models import STAND_INS, materialise_models
from strata.session import scratch_path
from strata.sources.sinks import recover_folder, replace_table, write_keep_schema, write_overwrite


def slow(spark, rows=40):
    """Rows that take a while, one a task."""
    def wait(batches):
        for batch in batches:
            time.sleep(0.5)
            yield batch
    return spark.range(0, rows, 1, rows).mapInArrow(wait, "id long")


def killed(spark, write):
    """Run ``write`` and cancel its job once it has begun."""
    failed = []

    def run():
        spark.sparkContext.setJobGroup("to-be-killed", "a write that is killed", interruptOnCancel=True)
        try:
            write()
        except Exception as e:  # noqa: BLE001
            failed.append(e)

    from pyspark import InheritableThread
    thread = InheritableThread(target=run)
    thread.start()
    time.sleep(4)
    spark.sparkContext.cancelJobGroup("to-be-killed")
    thread.join(60)
    assert failed and not thread.is_alive()


def listed(spark, path):
    folder = spark._jvm.org.apache.hadoop.fs.Path(path).getParent()
    fs = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    return sorted(f.getPath().getName() for f in fs.listStatus(folder))


def test_killed_overwrite_leaves_the_old_rows(spark):
    path = scratch_path(spark, "killed") + "/rows"
    write_overwrite(spark.range(7), path)
    killed(spark, lambda: write_overwrite(slow(spark), path))
    assert spark.read.parquet(path).count() == 7
    killed(spark, lambda: write_keep_schema(slow(spark), path))
    assert spark.read.parquet(path).count() == 7 and listed(spark, path) == ["rows"]
    write_overwrite(spark.range(9), path)
    assert spark.read.parquet(path).count() == 9 and listed(spark, path) == ["rows"]


def test_failed_overwrite_of_its_own_source(spark):
    path = scratch_path(spark, "own") + "/rows"
    write_overwrite(spark.range(5), path)
    bad = spark.read.parquet(path).withColumn("id", F.when(F.col("id") == 3, F.raise_error(F.lit("no"))).otherwise(F.col("id")).cast("long"))
    with pytest.raises(Exception, match="no"):
        write_overwrite(bad, path)
    assert spark.read.parquet(path).count() == 5
    write_overwrite(spark.read.parquet(path).withColumn("twice", F.col("id") * 2), path)
    assert spark.read.parquet(path).agg(F.sum("twice")).first()[0] == 20


def test_overwrite_cut_off_between_its_renames(spark):
    path = scratch_path(spark, "cut") + "/rows"
    write_overwrite(spark.range(4), path)
    old = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = old.getFileSystem(spark._jsc.hadoopConfiguration())
    fs.rename(old, old.suffix(".old-0123"))
    recover_folder(spark, path)
    assert spark.read.parquet(path).count() == 4 and listed(spark, path) == ["rows"]


def test_replaced_table(spark):
    root = scratch_path(spark, "table")
    first = replace_table(spark.range(3), "t_replaced", root)
    killed(spark, lambda: replace_table(slow(spark), "t_replaced", root))
    other = spark.newSession()
    assert other.table("t_replaced").count() == 3 and listed(spark, first + "/x") != []
    replace_table(spark.range(8), "t_replaced", root)
    assert other.table("t_replaced").count() == 3  # this session has the table's files at hand; they are still there
    other.catalog.refreshTable("t_replaced")
    assert other.table("t_replaced").count() == spark.newSession().table("t_replaced").count() == 8
    with pytest.raises(ValueError):
        replace_table(spark.range(1).withColumn("more", F.lit(1)), "t_replaced", root, keep_schema=True)
    replace_table(spark.range(2).withColumn("more", F.lit(1)), "t_replaced", root)
    other = spark.newSession()
    assert other.table("t_replaced").columns == ["id", "more"] and other.table("t_replaced").count() == 2
    names = {t.name for t in spark.catalog.listTables() if t.name.startswith("t_replaced")}
    assert names == {"t_replaced"} and len(listed(spark, f"{root}/t_replaced/x")) == 2  # the last and the one before
    spark.sql("ALTER TABLE t_replaced RENAME TO t_replaced__replaced")  # cut off between two names
    replace_table(spark.range(6).withColumn("more", F.lit(1)), "t_replaced", root, keep_schema=True)
    assert spark.newSession().table("t_replaced").count() == 6


def test_models_by_name_in_another_session(spark, sf_dir):
    lh = Lakehouse.get(spark, sf_dir)
    for _ in range(2):  # created, then replaced
        names = materialise_models(lh, ["stg_sales", "mart_geographic_analysis"], "by_name_", STAND_INS)
    other = spark.newSession()
    assert not other.catalog.tableExists("stg_sales")
    assert other.table(names["stg_sales"]).count() == lh.silver_sales().count()
    assert "sales_rep" in other.table(names["stg_sales"]).columns
    assert sorted(other.table(names["mart_geographic_analysis"]).collect()) == sorted(lh.mart("mart_geographic_analysis").collect())
    kinds = {t.name: t.tableType for t in other.catalog.listTables()}
    assert kinds["by_name_stg_sales"] == "VIEW" and kinds["by_name_mart_geographic_analysis"] == "EXTERNAL"


def test_a_product_of_two_classes_is_counted_before_the_facts_are_multiplied(spark):
    dim = spark.createDataFrame([(1, "P", "A"), (2, "P", "B"), (3, "Q", "A"), (4, None, "A"), (5, None, "B"), (6, "R", "A"), (7, "R", "B"), (8, "R", "C")],
                                "product_sk int, product_name string, product_class string")
    facts = spark.createDataFrame([("P",)] * 5 + [("Q",)] * 4 + [(None,)] * 3 + [("R",)] * 2 + [("S",)], "name string")
    row = quality.lookup_fanout(facts, "fact_sales", dim, "dim_product", {"product_name": "name"}).first()
    joined = facts.join(dim, facts["name"] == dim["product_name"], "left").count()
    assert tuple(row) == ("fact_sales", "dim_product", 2, joined - facts.count()) and row.extra_facts == 9
    assert tuple(quality.lookup_fanout(facts, "f", dim.where("product_class = 'A'"), "d", {"product_name": "name"}).first()) == ("f", "d", 0, 0)
    assert tuple(quality.lookup_fanout(facts.limit(0), "f", dim, "d", {"product_name": "name"}).first()) == ("f", "d", 2, 0)
