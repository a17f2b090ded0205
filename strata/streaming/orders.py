"""Order-event stream: source -> JSON parse -> append sink with a checkpoint.

Beside the plain sink there is one that takes each event id once, and one that
keeps the payloads it has to reject, with the reason.

The same ``parse_order_events`` serves batch and streaming frames.  Kafka is
the production source; the text-file source is its testable twin (same
``value`` column).  ``availableNow`` makes a run process what has arrived and
stop, which is how a scheduled job drives the stream; exactly-once comes from
the checkpoint plus the file sink's commit log.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StringType, StructField, StructType

from strata.schemas import ORDER_EVENT_SCHEMA
from strata.session import delete_folder, scratch_path


def parse_order_events(raw: DataFrame, schema: StructType = ORDER_EVENT_SCHEMA) -> DataFrame:
    """``value`` (binary or text JSON) -> typed columns; malformed payloads give all-NULL rows.

    ``inline`` of a one-element array expands the parsed struct through a
    generator, so the payload is parsed once per event even when later filters
    reference several fields (a plain ``v.*`` lets the optimizer re-parse per field).
    """
    parsed = F.from_json(F.col("value").cast("string"), schema)
    null_row = F.struct(*[F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields])
    return raw.select(F.inline(F.array(F.coalesce(parsed, null_row))))


def with_delivery(raw: DataFrame, schema: StructType = ORDER_EVENT_SCHEMA) -> DataFrame:
    """``parse_order_events`` plus where and when each event came: ``_kafka_partition``,
    ``_kafka_offset`` (NULL for a source without them) and ``_processed_at``."""
    place = [(F.col(c) if c in raw.columns else F.lit(None)).cast(t).alias(f"_kafka_{c}") for c, t in (("partition", "int"), ("offset", "bigint"))]
    parsed = F.from_json(F.col("value").cast("string"), schema)
    null_row = F.struct(*[F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields])
    return raw.select(F.inline(F.array(F.coalesce(parsed, null_row))), *place, F.current_timestamp().alias("_processed_at"))


def judge_payloads(raw: DataFrame, schema: StructType = ORDER_EVENT_SCHEMA) -> DataFrame:
    """``with_delivery``'s columns, ``_source_file``, the ``payload`` as it came and why it is rejected (``reason``, else NULL).

    ``empty``: no text; ``not_json``: no JSON value; ``wrong_type``: JSON that
    doesn't fit the schema; ``no_event_id``: an event that cannot be named.
    """
    columns = {f.name: f.dataType for f in schema.fields}
    text = F.col("value").cast("string")
    parsed = F.from_json(text, StructType([*schema.fields, StructField("_unfit", StringType())]), {"columnNameOfCorruptRecord": "_unfit"})
    place = [(F.col(c) if c in raw.columns else F.lit(None)).cast(t).alias(f"_kafka_{c}") for c, t in (("partition", "int"), ("offset", "bigint"))]
    file = (F.col("_source_file") if "_source_file" in raw.columns else F.lit(None).cast("string")).alias("_source_file")
    once = raw.select(F.inline(F.array(F.struct(text.alias("payload"), F.try_parse_json(text).isNotNull().alias("_json"), parsed.alias("_event")))), *place, file)
    reason = (F.when(F.coalesce(F.trim("payload"), F.lit("")) == "", "empty").when(~F.col("_json"), "not_json")
              .when(F.col("_event").isNull() | F.col("_event._unfit").isNotNull(), "wrong_type").when(F.col("_event.event_id").isNull(), "no_event_id"))
    return once.select(*[F.col("_event")[c].cast(t).alias(c) for c, t in columns.items()], "_kafka_partition", "_kafka_offset", "_source_file",
                       F.current_timestamp().alias("_processed_at"), "payload", reason.alias("reason"))


def read_kafka_stream(spark: SparkSession, bootstrap_servers: str, topic: str,
                      starting_offsets: str = "latest") -> DataFrame:
    """Kafka source (needs the spark-sql-kafka package on the classpath)."""
    return (spark.readStream.format("kafka")
            .option("kafka.bootstrap.servers", bootstrap_servers)
            .option("subscribe", topic)
            .option("startingOffsets", starting_offsets)
            .load())


def read_text_stream(spark: SparkSession, source_dir: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """``value``, a line each."""
    reader = spark.readStream.format("text")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader.load(source_dir)


def write_append(df: DataFrame, output_path: str, checkpoint_path: str, fmt: str = "parquet",
                 available_now: bool = True) -> StreamingQuery:
    writer = (df.writeStream.format(fmt).outputMode("append")
              .option("checkpointLocation", checkpoint_path))
    if fmt == "parquet":
        writer = writer.option("compression", "zstd")
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start(output_path)


def run_orders_to_bronze(spark: SparkSession, source_dir: str, output_path: str,
                         checkpoint_path: str, fmt: str = "parquet",
                         max_files_per_trigger: int = 64) -> int:
    """Process everything that has arrived in ``source_dir`` once; return the number of batches.

    Runs for as long as there is input.  A batch reads at most
    ``max_files_per_trigger`` files, so its size doesn't grow with a backlog.
    """
    q = write_append(parse_order_events(read_text_stream(spark, source_dir, max_files_per_trigger)),
                     output_path, checkpoint_path, fmt)
    q.awaitTermination()  # raises what the query failed with
    return 1 + max((p["batchId"] for p in q.recentProgress if p["numInputRows"]), default=-1)


def _arrivals(spark: SparkSession, source_dir: str, max_files_per_trigger: int) -> DataFrame:
    """``value``, the file it came in and when that arrived."""
    lines = read_text_stream(spark, source_dir, max_files_per_trigger)
    return lines.select("value", F.col("_metadata.file_name").alias("_source_file"), F.col("_metadata.file_modification_time").alias("_arrived_at"))


def once_each(events: DataFrame, within: str = "1 day", key: str = "event_id", arrived: str = "_arrived_at") -> DataFrame:
    """The first event of each id; repeats that arrive up to ``within`` later are dropped.

    The watermark runs on the arrival, not on the event's own time, so an old
    event that comes late is kept and the state holds the ids of one such span.
    """
    return events.withWatermark(arrived, within).dropDuplicatesWithinWatermark([key])


def run_orders_once_each(spark: SparkSession, source_dir: str, output_path: str, checkpoint_path: str, within: str = "1 day",
                         fmt: str = "parquet", max_files_per_trigger: int = 64) -> None:
    """Append what has arrived, each event id once, over all runs on one checkpoint (its state lies there too).

    Payloads without an id are left to ``run_orders_with_rejects``.
    """
    judged = _arrivals(spark, source_dir, max_files_per_trigger)
    schema = ORDER_EVENT_SCHEMA
    parsed = F.coalesce(F.from_json(F.col("value"), schema), F.struct(*[F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields]))
    events = judged.select(F.inline(F.array(parsed)), "_arrived_at").where(F.col("event_id").isNotNull())
    q = write_append(once_each(events, within).drop("_arrived_at"), output_path, checkpoint_path, fmt)
    q.awaitTermination()


def run_orders_with_rejects(spark: SparkSession, source_dir: str, accepted_path: str, rejected_path: str, checkpoint_path: str,
                            fmt: str = "parquet", max_files_per_trigger: int = 64) -> None:
    """Drain what has arrived into two sinks: typed events, and the payloads that are none with their reason.

    Both carry where and when each came.  A batch writes the folder of its number
    in either sink, so a batch that runs again after a failure replaces its own
    rows and nothing is lost or doubled.
    """
    def write(batch: DataFrame, number: int) -> None:
        # judged once, into files: a batch may be far longer than the executors' memory
        staged, reading = scratch_path(spark, "judged-batch"), batch.sparkSession.read
        judged = judge_payloads(batch)
        judged = judged.withColumn("payload", F.when(F.col("reason").isNotNull(), F.col("payload")))
        try:
            judged.write.option("compression", "zstd").parquet(staged)
            judged = reading.schema(judged.schema).parquet(staged)
            accepted = judged.where(F.col("reason").isNull()).drop("payload", "reason")
            rejected = judged.where(F.col("reason").isNotNull()).select("payload", "reason", "_kafka_partition", "_kafka_offset", "_source_file", "_processed_at")
            for rows, path in ((accepted, accepted_path), (rejected, rejected_path)):
                rows.write.format(fmt).mode("overwrite").save(f"{path}/batch={number}")
        finally:
            delete_folder(spark, staged)

    stream = _arrivals(spark, source_dir, max_files_per_trigger)
    q = stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint_path).trigger(availableNow=True).start()
    q.awaitTermination()
