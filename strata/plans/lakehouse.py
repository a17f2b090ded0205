"""Materialised medallion layers for one input folder.

``Lakehouse.get(spark, sf_dir)`` derives Bronze from the given tables, builds
Silver and Gold, and WRITES each Silver/Gold table (parquet) below the
session's shared checkpoint folder, reading it back for every consumer.  The
written tables cut lineage (executor loss re-reads files instead of
re-running the whole join tree) and let every KPI / mart / model reuse the
same Gold without recomputing dimensions, exactly like the reference's
write-then-read layering.  Tables are built on first use and memoised per
application and state of the input files.  A landing folder or Bronze table that
was made only to be read by the layer above goes when that is written; whoever
asks for it later gets it made anew.
"""

from __future__ import annotations

import contextlib
import os
import threading
from collections.abc import Iterator
from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from strata.operators import gold, marts, quality, silver
from strata.schemas import ORDER_EVENT_SCHEMA, SALES_CSV_SCHEMA, SILVER_ORDERS_SCHEMA, all_strings
from strata.session import SHUFFLE_CLEANUP, delete_folder, scratch_path, settings
from strata.sources import adapter
from strata.sources.sinks import register_external_table, write_csv, write_lines
from strata.sources.tables import TABLES, Tables, load_safe
from strata.streaming.feeds import run_csv_to_bronze
from strata.streaming.orders import run_orders_once_each, run_orders_to_bronze, run_orders_with_rejects

#: while a table is written: its shuffle files go with the write, and a task reads so little that it can sort it in memory
WRITING = {SHUFFLE_CLEANUP: "true", "spark.sql.files.maxPartitionBytes": "32m"}
#: while the lines are joined: a side that Spark finds this small is broadcast, as the other one carries all texts of a line by then
JOINING = {"spark.sql.adaptive.autoBroadcastJoinThreshold": "64m"}
#: while facts look their keys up by name: a dimension whose part in each task is this small is hashed there, so that no side is sorted by text
LOOKING_UP = {"spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64m"}

_LOCK = threading.Lock()
_INSTANCES: dict[tuple[str, str], "Lakehouse"] = {}


def source_state(spark: SparkSession, sf_dir: str) -> tuple:
    """The source tables' files with their lengths and times: tables built from other files are not served."""
    found = []
    for name in TABLES:
        path = spark._jvm.org.apache.hadoop.fs.Path(f"{sf_dir}/{name}.parquet")
        files = path.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(path)
        found += [(name, f.getPath().getName(), f.getLen(), f.getModificationTime()) for f in files]
    return tuple(sorted(found))


class Lakehouse:
    state: tuple = ()

    def __init__(self, spark: SparkSession, sf_dir: str, root: str | None = None):
        self.spark = spark
        self.sf_dir = sf_dir
        self.tables = Tables(spark, sf_dir)
        self.root = root or scratch_path(spark, "lakehouse")
        self._built: dict[str, str] = {}
        self._lock = threading.RLock()

    @classmethod
    def get(cls, spark: SparkSession, sf_dir: str) -> "Lakehouse":
        key = (spark.sparkContext.applicationId, sf_dir)
        with _LOCK:
            lh = _INSTANCES.get(key)
            state = source_state(spark, sf_dir)
            if lh is None or lh.spark is not spark or lh.state != state:
                lh = cls(spark, sf_dir)
                lh.state = state
                _INSTANCES[key] = lh
            return lh

    # ------------------------------------------------------------ storage
    def path(self, name: str) -> str:
        return os.path.join(self.root, name)

    def _materialise(self, name: str, build: Callable[[], DataFrame]) -> DataFrame:
        with self._lock:
            if name not in self._built:
                df = build()
                with settings(self.spark, WRITING):
                    df.write.mode("overwrite").option("overwriteSchema", "true").option("compression", "zstd").parquet(self.path(name))
                self._built[name] = self.path(name)
        return self.spark.read.parquet(self._built[name])

    @contextlib.contextmanager
    def _passing(self, *names: str) -> Iterator[None]:
        """Layers that are made meanwhile only for the one above: nobody else has a frame over their files, so these go.

        A layer that was asked for before stays.  After a failure all of them stay, for the next attempt.
        """
        with self._lock:
            new = [name for name in names if name not in self._built]
            yield
            for name in new:
                if path := self._built.pop(name, None):
                    delete_folder(self.spark, path)
                    delete_folder(self.spark, f"{path}_checkpoint")

    # ------------------------------------------------------------ landing + bronze
    def landing_lines(self) -> DataFrame:
        """The joined line items every raw feed is cut from, written once.

        Without it each feed (sales, order events, legacy events, shipments)
        would re-run the four lineitem-sized shuffle joins.
        """
        with settings(self.spark, JOINING):
            return self._materialise("landing_lines", lambda: adapter.landing_lines(self.tables))

    def _landed(self, name: str, write: Callable[[str], None]) -> str:
        """A landing folder of raw files, written once."""
        with self._lock:
            if name not in self._built:
                write(self.path(name))
                self._built[name] = self.path(name)
        return self._built[name]

    def sales_csv(self) -> str:
        return self._landed("landing_sales_csv", lambda path: write_csv(adapter.sales_wide(self.landing_lines()), path))

    def shipments_csv(self) -> str:
        return self._landed("landing_shipments_csv", lambda path: write_csv(adapter.shipments_raw(self.landing_lines()), path))

    def order_events(self) -> str:
        return self._landed("landing_orders", lambda path: write_lines(adapter.order_event_lines(self.landing_lines()), path))

    def _csv_bronze(self, name: str, landing: Callable[[], str], schema: StructType, to_bronze: Callable[[DataFrame], DataFrame]) -> DataFrame:
        """A Bronze table that takes the CSV files its checkpoint hasn't seen."""
        def drain(path: str) -> None:
            folder = landing()
            with settings(self.spark, WRITING):  # a packed file for a task, as they aren't split
                run_csv_to_bronze(self.spark, folder, path, self.path(f"{name}_checkpoint"), schema, to_bronze)

        columns = to_bronze(self.spark.createDataFrame([], schema)).schema
        return self.spark.read.schema(columns).parquet(self._landed(name, drain))

    def bronze_sales(self) -> DataFrame:
        """The sales CSV, typed, normalised names, real file names."""
        with self._passing("landing_sales_csv"):
            return self._csv_bronze("bronze_sales", self.sales_csv, SALES_CSV_SCHEMA, silver.bronze_sales)

    def bronze_orders(self) -> DataFrame:
        """What the order stream has appended to its sink."""
        def drain(path: str) -> None:
            folder = self.order_events()
            with settings(self.spark, WRITING):
                run_orders_to_bronze(self.spark, folder, path, self.path("bronze_orders_checkpoint"))

        with self._passing("landing_orders"):
            return self.spark.read.schema(ORDER_EVENT_SCHEMA).parquet(self._landed("bronze_orders", drain))

    def orders_once_each(self) -> DataFrame:
        """The order events, each id once, from a stream that keeps the ids it has seen."""
        def drain(path: str) -> None:
            run_orders_once_each(self.spark, self.order_events(), path, self.path("orders_once_checkpoint"))

        with self._passing("landing_orders"):
            return self.spark.read.schema(ORDER_EVENT_SCHEMA).parquet(self._landed("orders_once_each", drain))

    def orders_judged(self) -> tuple[DataFrame, DataFrame]:
        """The accepted order events and the rejected payloads, from a stream with two sinks."""
        def drain(path: str) -> None:
            run_orders_with_rejects(self.spark, self.order_events(), f"{path}/accepted", f"{path}/rejected", self.path("orders_judged_checkpoint"))

        with self._passing("landing_orders"):
            path = self._landed("orders_judged", drain)
        return self.spark.read.parquet(f"{path}/accepted"), self.spark.read.parquet(f"{path}/rejected")

    def bronze_orders_legacy(self) -> DataFrame:
        return adapter.legacy_order_events(self.landing_lines())

    def bronze_shipments(self) -> DataFrame:
        """The all-string shipments CSV, blank cells read as NULL."""
        with self._passing("landing_shipments_csv"):
            return self._csv_bronze("bronze_shipments", self.shipments_csv, all_strings(adapter.SHIPMENT_HEADERS), silver.bronze_shipments)

    # ------------------------------------------------------------ silver
    def silver_sales(self) -> DataFrame:
        with self._passing("bronze_sales"):
            return self._materialise("silver_sales", lambda: silver.silver_sales(self.bronze_sales()))

    def silver_orders(self) -> DataFrame:
        with self._passing("bronze_orders"):
            return self._materialise("silver_orders", lambda: silver.silver_orders(self.bronze_orders()))

    def silver_shipments(self) -> DataFrame:
        with self._passing("bronze_shipments"):
            return self._materialise("silver_shipments",
                                     lambda: silver.silver_shipments(self.bronze_shipments()))

    # ------------------------------------------------------------ gold
    def orders_or_none(self) -> DataFrame:
        """Silver orders, or an empty frame where no order has ever arrived."""
        self.silver_orders()
        return load_safe(self.spark, self.path("silver_orders"), SILVER_ORDERS_SCHEMA)

    def dim_time(self) -> DataFrame:
        return self._materialise("dim_time", lambda: gold.dim_time(self.silver_sales(), self.orders_or_none()))

    def dim_product(self) -> DataFrame:
        return self._materialise("dim_product", lambda: gold.dim_product(self.silver_sales()))

    def dim_customer(self) -> DataFrame:
        return self._materialise("dim_customer", lambda: gold.dim_customer(self.silver_sales()))

    def dim_sales_rep(self) -> DataFrame:
        return self._materialise("dim_sales_rep", lambda: gold.dim_sales_rep(self.silver_sales()))

    def fact_sales(self) -> DataFrame:
        with settings(self.spark, LOOKING_UP):
            return self._materialise("fact_sales", lambda: gold.fact_sales(
                self.silver_sales(), self.dim_time(), self.dim_product(), self.dim_customer(),
                self.dim_sales_rep()))

    def fact_orders(self) -> DataFrame:
        with settings(self.spark, LOOKING_UP):
            return self._materialise("fact_orders", lambda: gold.fact_orders(
                self.orders_or_none(), self.dim_product(), self.dim_customer()))

    def register_views(self, names: list[str] | None = None) -> list[str]:
        """Expose the Silver/Gold tables as temp views for ``spark.sql`` (builds them if needed).

        Each view reads the written parquet, so SQL text gets the same pruning
        and pushdown as the DataFrame operators.
        """
        from strata.sources.sinks import register_views
        names = names or list(self.VIEW_TABLES)
        register_views({n: getattr(self, n)() for n in names})
        return names

    VIEW_TABLES = ("silver_sales", "silver_orders", "silver_shipments", "dim_time", "dim_product",
                   "dim_customer", "dim_sales_rep", "fact_sales", "fact_orders")

    #: the tables that analysts query by name
    NAMED_TABLES = ("dim_time", "dim_product", "dim_customer", "dim_sales_rep", "fact_sales", "fact_orders",
                    "silver_sales", "silver_orders", "ml_customer_clusters", "ml_demand_forecast")

    def register_tables(self, prefix: str = "") -> list[str]:
        """External tables over the written Gold, Silver and model tables (metadata only).

        A name always points to this lakehouse: an older table of the name is dropped first.
        """
        for name in self.NAMED_TABLES:
            getattr(self, name)()
            self.spark.sql(f"DROP TABLE IF EXISTS {prefix}{name}")
            register_external_table(self.spark, prefix + name, self.path(name))
        return [prefix + name for name in self.NAMED_TABLES]

    # ------------------------------------------------------------ marts
    def mart(self, name: str) -> DataFrame:
        """A mart as a written table.  The marts of model outputs have two forms: over the models
        (``mart_cluster_analysis_kmeans``, ``mart_forecast_analysis_gbt``) and over the
        deterministic stand-ins that SQL can check."""
        builders = {
            "mart_product_performance": lambda: marts.product_performance(self.fact_sales(), self.dim_product()),
            "mart_sales_rep_performance": lambda: marts.sales_rep_performance(self.fact_sales(), self.dim_sales_rep()),
            "mart_geographic_analysis": lambda: marts.geographic_analysis(self.fact_sales(), self.dim_customer()),
            "mart_cluster_analysis": lambda: marts.cluster_analysis(self.banded_clusters()),
            "mart_forecast_analysis": lambda: marts.forecast_analysis(self.naive_forecast()),
            "mart_cluster_analysis_kmeans": lambda: marts.cluster_analysis(self.ml_customer_clusters()),
            "mart_forecast_analysis_gbt": lambda: marts.forecast_analysis(self.ml_demand_forecast()),
        }
        return self._materialise(name, builders[name])

    def banded_clusters(self) -> DataFrame:
        from strata.operators import ml

        def build() -> DataFrame:
            preds = ml.banded_assign(ml.customer_features(self.silver_sales()))
            return ml.label_customers(preds, ml.cluster_labels(ml.cluster_stats(preds))).drop("created_at")

        return self._materialise("banded_clusters", build)

    def leak_free_forecast(self) -> DataFrame:
        """The forecast of the same model over features that know nothing of the month to be forecast."""
        from strata.operators import ml
        return self._materialise_model("leak_free_forecast", lambda held: ml.demand_forecast(self.silver_sales(), cached=held, leak_free=True))

    def naive_forecast(self) -> DataFrame:
        from strata.operators import ml
        return self._materialise_model("naive_forecast", lambda held: ml.naive_demand_forecast(self.silver_sales(), cached=held).drop("created_at"))

    def lookup_fanout(self) -> DataFrame:
        """For each lookup of the facts: dimension names with several rows, and the fact rows they would add."""
        def build() -> DataFrame:
            sales, orders = self.silver_sales(), self.orders_or_none()
            lookups = [
                (sales, "fact_sales", self.dim_time(), "dim_time", {"year": "year", "month": "month"}),
                (sales, "fact_sales", self.dim_product(), "dim_product", {"product_name": "product_name"}),
                (sales, "fact_sales", self.dim_customer(), "dim_customer", {"customer_name": "customer_name"}),
                (sales, "fact_sales", self.dim_sales_rep(), "dim_sales_rep", {"sales_rep_name": "name_of_sales_rep"}),
                (orders, "fact_orders", self.dim_product(), "dim_product", {"product_name": "product_name"}),
                (orders, "fact_orders", self.dim_customer(), "dim_customer", {"customer_name": "customer_name"}),
            ]
            return quality.suite([quality.lookup_fanout(*x) for x in lookups])

        return self._materialise("lookup_fanout", build)

    def build_gold(self) -> None:
        for step in (self.dim_time, self.dim_product, self.dim_customer, self.dim_sales_rep,
                     self.fact_sales, self.fact_orders):
            step()

    # ------------------------------------------------------------ ML layer
    def _materialise_model(self, name: str, build: Callable[[list[DataFrame]], DataFrame]) -> DataFrame:
        """Write a model output, then release the frames that were written and cached for it."""
        from strata.operators import ml
        held: list[DataFrame] = []
        try:
            return self._materialise(name, lambda: build(held))
        finally:
            ml.release(held)

    def ml_customer_clusters(self) -> DataFrame:
        from strata.operators import ml
        return self._materialise_model("ml_customer_clusters",
                                       lambda held: ml.customer_segments(self.silver_sales(), cached=held)[0])

    def ml_demand_forecast(self) -> DataFrame:
        from strata.operators import ml
        return self._materialise_model("ml_demand_forecast",
                                       lambda held: ml.demand_forecast(self.silver_sales(), cached=held))
