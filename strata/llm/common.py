"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import contextlib
import hashlib
import importlib.util
import os
import shutil
import tempfile
import threading
from typing import Callable, Iterable, Iterator, TypeVar

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.session import delete_folder, scratch_path, shuffles_deleted

T = TypeVar("T")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_collector = threading.local()


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with the value computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` below the shared checkpoint folder and read it back.

    Cuts the lineage with plain files that every executor can re-read; the
    shuffles behind them are no longer needed then and are deleted.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    with shuffles_deleted(spark):
        df.write.parquet(path)
    if getattr(_collector, "paths", None) is not None:
        _collector.paths.append(path)
    return spark.read.schema(df.schema).parquet(path)


@contextlib.contextmanager
def collected_scratch() -> Iterator[list[str]]:
    """The folders that ``materialise`` writes in this thread meanwhile."""
    outer, _collector.paths = getattr(_collector, "paths", None), []
    try:
        yield _collector.paths
    finally:
        _collector.paths = outer


def delete_scratch(spark: SparkSession, paths: list[str]) -> None:
    """Delete folders that ``materialise`` wrote and nothing reads any more."""
    for path in paths:
        delete_folder(spark, path)


def as_text(column: str) -> Column:
    """The text column as a string, null read as the empty text."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def row_mark(text_col: str, *columns: str) -> Column:
    """A hash that tells rows of one id apart: by the text (null as empty) and the other columns."""
    return F.xxhash64(as_text(text_col), *(F.col(c).cast("string") for c in columns))


def by_volume(items: Iterable[T], sizes: Iterable[int], most: int) -> Iterator[list[T]]:
    """Cut items into runs whose sizes sum to about ``most`` (one larger item makes its own run)."""
    run: list[T] = []
    total = 0
    for item, size in zip(items, sizes):
        if run and total + size > most:
            yield run
            run, total = [], 0
        run.append(item)
        total += size
    if run:
        yield run


def by_rows(batches: Iterable[pa.RecordBatch], rows: int = 512) -> Iterator[pa.RecordBatch]:
    """The batches in slices of at most ``rows`` rows, to bound what is held as Python objects."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def hash64(data: bytes) -> int:
    """A 64-bit hash that is the same in every process."""
    return int.from_bytes(hashlib.blake2b(data, digest_size=8).digest(), "little")


def mix64(x: np.ndarray) -> np.ndarray:
    """Bijective scrambling of 64-bit integers (the finaliser of splitmix64)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def ship_package(spark: SparkSession) -> None:
    """Make this package importable in Python workers, once for each application.

    Where the cluster's workers have it already (installed, or on PYTHONPATH)
    nothing happens; else its source goes to the executors with ``addPyFile``.
    """
    sc = spark.sparkContext
    package = __name__.partition(".")[0]
    if getattr(sc, "_strata_shipped", False):
        return
    if not sc.parallelize([package], 1).map(importlib.util.find_spec).map(bool).first():
        top = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
        sc.addPyFile(shutil.make_archive(os.path.join(tempfile.mkdtemp(), package), "zip", top, package))
    sc._strata_shipped = True


def map_arrow(df: DataFrame, function: Callable[[Iterator], Iterator], schema: str) -> DataFrame:
    """``mapInArrow`` with this package at hand in the workers."""
    ship_package(df.sparkSession)
    return df.mapInArrow(function, schema)
