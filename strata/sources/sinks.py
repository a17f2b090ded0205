"""Sinks: overwrites that survive a failed write, replaceable tables, external-table DDL, CSV export."""

from __future__ import annotations

import re
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

#: formats that are plain files in a folder; others (table formats) replace their rows themselves
FILE_FORMATS = ("parquet", "orc", "csv", "json", "text")
#: rows of a landed text file at most: gzip isn't split, so a reader takes a file whole
LANDED_ROWS = 1_000_000
#: landed text is read once or twice, so packing it must not cost more than writing it
PACKED = {"compression": "gzip", "zlib.compress.level": "THREE"}


def _file_system(spark: SparkSession, path: str):
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()), folder


def _siblings(spark: SparkSession, path: str, mark: str) -> list:
    """The folders beside ``path`` that its staged overwrites have named with ``mark``."""
    fs, folder = _file_system(spark, path)
    found = fs.globStatus(folder.suffix(f".{mark}-*")) or []
    return [f.getPath() for f in found]


def recover_folder(spark: SparkSession, path: str) -> None:
    """Put the old rows back where a process ended between the two renames of an overwrite."""
    fs, folder = _file_system(spark, path)
    old = _siblings(spark, path, "old")
    if old and not fs.exists(folder):
        fs.rename(old[0], folder)


def _switch_folder(spark: SparkSession, staged: str, path: str) -> None:
    fs, folder = _file_system(spark, path)
    old = folder.suffix(f".old-{uuid.uuid4().hex[:12]}")
    had_rows = fs.exists(folder)
    if had_rows and not fs.rename(folder, old):
        raise OSError(f"could not move {path} away")
    if not fs.rename(_file_system(spark, staged)[1], folder):
        if had_rows:
            fs.rename(old, folder)
        raise OSError(f"could not move {staged} to {path}")
    for left in _siblings(spark, path, "old"):
        fs.delete(left, True)


def write_overwrite(df: DataFrame, path: str, fmt: str = "parquet",
                    partition_by: list[str] | None = None) -> None:
    """Full overwrite; the new schema replaces the old one (``overwriteSchema`` for table formats).

    Files are written beside the folder and take its place when all of them are
    there, so a write that fails or is killed leaves the old rows.  ``df`` may
    read from the folder itself.
    """
    spark = df.sparkSession
    w = df.write.format(fmt).mode("overwrite").option("overwriteSchema", "true")
    if partition_by:
        w = w.partitionBy(*partition_by)
    if fmt not in FILE_FORMATS:
        w.save(path)
        return
    path = path.rstrip("/")
    recover_folder(spark, path)
    staged = f"{path}.staged-{uuid.uuid4().hex[:12]}"
    try:
        w.save(staged)
        _switch_folder(spark, staged, path)
    finally:
        fs, folder = _file_system(spark, staged)
        fs.delete(folder, True)


def _kinds(schema: StructType) -> list[tuple]:
    return [(f.name, f.dataType) for f in schema]


def write_keep_schema(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Full overwrite that refuses to change the stored column names and types."""
    recover_folder(df.sparkSession, path.rstrip("/"))
    try:
        stored = df.sparkSession.read.format(fmt).load(path).schema
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
    else:
        if _kinds(stored) != _kinds(df.schema):
            raise ValueError(f"{path} holds {stored.simpleString()}, not {df.schema.simpleString()}")
    write_overwrite(df, path, fmt)


def _checked_name(name: str) -> str:
    if not re.fullmatch(r"[A-Za-z_][A-Za-z0-9_]*", name):
        raise ValueError(f"bad table name {name!r}")
    return name


def register_external_table(spark: SparkSession, name: str, path: str, fmt: str = "parquet") -> str:
    """``CREATE TABLE IF NOT EXISTS name USING fmt LOCATION path`` (metadata only, no data copy)."""
    safe_path = path.replace("'", "\\'")
    spark.sql(f"CREATE TABLE IF NOT EXISTS {_checked_name(name)} USING {fmt} LOCATION '{safe_path}'")
    return name


def replace_table(df: DataFrame, name: str, root: str, fmt: str = "parquet", keep_schema: bool = False) -> str:
    """Create or replace the catalog table ``name`` with the rows of ``df``; returns their folder.

    The rows go to a fresh folder below ``root``/``name`` and are counted there;
    only then is the table switched to it.  A write that fails leaves the table
    as it was.  With the same columns the switch is one change of the table's
    location; other columns replace the table through a staged name, or are
    refused with ``keep_schema``.  The folder before the last stays for readers
    that have begun, and for sessions that have read the table before and will
    do so again until they refresh it; older folders are deleted.
    """
    spark = df.sparkSession
    _recover_table(spark, _checked_name(name))
    exists = spark.catalog.tableExists(name)
    same = exists and _kinds(spark.table(name).schema) == _kinds(df.schema)
    if exists and keep_schema and not same:
        raise ValueError(f"{name} holds {spark.table(name).schema.simpleString()}, not {df.schema.simpleString()}")
    folder = f"{root.rstrip('/')}/{name}/v-{uuid.uuid4().hex[:12]}"
    counted = Observation()
    try:
        df.observe(counted, F.count(F.lit(1)).alias("rows")).write.format(fmt).save(folder)
        found = spark.read.format(fmt).schema(df.schema).load(folder).count()
        if found != counted.get["rows"]:
            raise OSError(f"{folder} holds {found} rows, not {counted.get['rows']}")
    except BaseException:
        fs, left = _file_system(spark, folder)
        fs.delete(left, True)
        raise
    before = _location(spark, name) if exists else None
    safe_folder = folder.replace("'", "\\'")
    if same:
        spark.sql(f"ALTER TABLE {name} SET LOCATION '{safe_folder}'")
    else:
        staged = register_external_table(spark, f"{name}__staged", folder, fmt)
        if exists:
            spark.sql(f"ALTER TABLE {name} RENAME TO {name}__replaced")
        spark.sql(f"ALTER TABLE {staged} RENAME TO {name}")
        spark.sql(f"DROP TABLE IF EXISTS {name}__replaced")
    spark.catalog.refreshTable(name)
    fs, parent = _file_system(spark, f"{root.rstrip('/')}/{name}")
    keep = {p.rstrip("/").rsplit("/", 1)[-1] for p in (folder, before) if p}
    for version in fs.listStatus(parent):
        if version.getPath().getName() not in keep:
            fs.delete(version.getPath(), True)
    return folder


def _recover_table(spark: SparkSession, name: str) -> None:
    """Finish or undo a switch of names that a process has left half done."""
    if not spark.catalog.tableExists(name) and spark.catalog.tableExists(f"{name}__replaced"):
        spark.sql(f"ALTER TABLE {name}__replaced RENAME TO {name}")
    spark.sql(f"DROP TABLE IF EXISTS {name}__replaced")
    spark.sql(f"DROP TABLE IF EXISTS {name}__staged")


def _location(spark: SparkSession, name: str) -> str | None:
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").where("col_name = 'Location'").collect()
    return rows[0].data_type if rows else None


def register_views(tables: dict[str, DataFrame]) -> None:
    for name, df in tables.items():
        df.createOrReplaceTempView(name)


def write_lines(df: DataFrame, path: str, rows_per_file: int = LANDED_ROWS) -> None:
    """A text line a row (column ``value``), packed with gzip."""
    df.write.options(**PACKED).option("maxRecordsPerFile", rows_per_file).text(path)


def export_csv(df: DataFrame, path: str) -> None:
    """Header CSV export (one folder of part files; no coalesce to a single task)."""
    df.write.mode("overwrite").option("header", "true").csv(path)


def write_csv(df: DataFrame, path: str, rows_per_file: int = LANDED_ROWS) -> None:
    """Header CSV as a feed delivers it, packed with gzip: blanks around values are kept."""
    (df.write.mode("overwrite").options(**PACKED).option("header", "true").option("maxRecordsPerFile", rows_per_file)
     .option("ignoreLeadingWhiteSpace", "false").option("ignoreTrailingWhiteSpace", "false").csv(path))
