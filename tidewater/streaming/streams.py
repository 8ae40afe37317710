"""Streams of the three legs (SRC-1..4, SNK-1..5, STR-2, STR-3, STR-7..9)."""

from __future__ import annotations

import dataclasses
import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tidewater.config import RunOptions, TableConfig
from tidewater.functions.codec import decode
from tidewater.operators.merge import CHANGE_KINDS
from tidewater.plans.publish import MAX_BYTES, post_images
from tidewater.plans.registry import RegistryCache, ingest_registry
from tidewater.plans.structured import process_batch
from tidewater.sources import fs, tables
from tidewater.sources.offsets import read_change_files
from tidewater.streaming.lifecycle import find_query, stop_when_idle, watch  # noqa: F401


def read_event_stream(spark: SparkSession, path: str, schema: T.StructType, max_files: int | None = None,
                      glob: str | None = None) -> DataFrame:
    """SRC-1 / SRC-2: the event log as a stream of files, optionally rate-limited."""
    r = spark.readStream.schema(schema)
    if max_files:
        r = r.option("maxFilesPerTrigger", int(max_files))
    if glob:
        r = r.option("pathGlobFilter", glob)
    return r.parquet(path)


def read_kafka_stream(spark: SparkSession, servers: str, topic: str, envelope: T.StructType | str,
                      max_offsets: int | None = 50_000, starting: str = "earliest",
                      options: dict | None = None) -> DataFrame:
    """SRC-1 over Kafka: envelopes decoded from the record value (JSON), with
    the broker timestamp as ``enqueuedTime``; ``max_offsets`` caps events per
    trigger (default as the reference's 50,000). Needs the Kafka package on
    the classpath; without it a clear error is raised."""
    r = (spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers)
         .option("subscribe", topic).option("startingOffsets", starting))
    if max_offsets:
        r = r.option("maxOffsetsPerTrigger", int(max_offsets))
    for k, v in (options or {}).items():
        r = r.option(k, v)
    try:
        df = r.load()
    except Exception as exc:  # noqa: BLE001 - data source lookup failure
        if "kafka" in str(exc).lower():
            raise RuntimeError("the Kafka source needs the spark-sql-kafka package on the classpath") from exc
        raise
    return df.select(F.from_json(F.col("value").cast("string"), envelope).alias("body"),
                     F.col("timestamp").alias("enqueuedTime"))


def read_raw_stream(spark: SparkSession, path: str, schema: T.StructType, max_bytes: int | None = 268_435_456,
                    start=None, max_files: int | None = None) -> DataFrame:
    """SRC-3 / SRC-4 / FLT-2: the raw table as a stream; ``0`` disables the
    byte limit; ``max_files`` limits by files in its place (Spark takes one of
    them); ``start`` drops rows enqueued at or before it."""
    r = spark.readStream.schema(schema)
    if max_files:
        r = r.option("maxFilesPerTrigger", int(max_files))
    elif max_bytes:
        r = r.option("maxBytesPerTrigger", int(max_bytes))
    df = r.parquet(path)
    if start is not None:
        df = df.filter(F.col("enqueuedTime") > F.lit(start).cast("timestamp"))
    return df


def _trigger(writer, processing_time: str | None, available_now: bool):
    if available_now:
        return writer.trigger(availableNow=True)
    if processing_time:
        return writer.trigger(processingTime=processing_time)
    return writer


def start_raw(stream: DataFrame, raw_path: str, checkpoint: str, name: str | None = None,
              processing_time: str | None = "30 seconds", available_now: bool = False,
              stamp: bool = True, codec: str | None = None, envelope: str | T.StructType | None = None) -> StreamingQuery:
    """SNK-1 / SNK-2: append the envelopes to the raw table. With ``codec`` the
    stream's binary ``body`` is decoded by ``envelope`` on the way."""
    if codec is not None:
        stream = stream.withColumn("body", decode(F.col("body"), envelope, codec))
    if stamp:
        stream = stream.withColumn("rawLayerProcessingTime", F.current_timestamp())
    w = stream.writeStream.format("parquet").option("checkpointLocation", checkpoint).outputMode("append")
    if name:
        w = w.queryName(name)
    return _trigger(w, processing_time, available_now).start(raw_path)


def start_registry(stream: DataFrame, registry_path: str, checkpoint: str, available_now: bool = False,
                   codec: str = "json") -> StreamingQuery:
    """SNK-3 / SEM-1: registry ingest per micro-batch, always checkpointed."""
    spark = stream.sparkSession

    def each(batch: DataFrame, batch_id: int) -> None:
        ingest_registry(spark, batch, registry_path, codec)

    w = stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint)
    return _trigger(w, None, available_now).start()


def start_structured(stream: DataFrame, registry_path: str, configs: list[TableConfig], root: str,
                     checkpoint: str, opts: RunOptions, counts_path: str | None = None,
                     available_now: bool = False, name: str | None = None) -> StreamingQuery:
    """SNK-4 / STR-1: the structured upsert per micro-batch.

    A replayed batch is harmless: merges are sequence-guarded, and its counts
    replace those of its first run. They are kept by the query's id, which a new
    checkpoint changes, so a stream that starts over counts afresh."""
    spark = stream.sparkSession
    watch(spark)
    registry = RegistryCache(spark, registry_path)

    def each(batch: DataFrame, batch_id: int) -> None:
        run = opts if opts.stream_id else dataclasses.replace(opts, stream_id=query_id(spark, checkpoint))
        process_batch(spark, batch, batch_id, registry, configs, root, run, counts_path)

    w = stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint)
    if name:
        w = w.queryName(name)
    return _trigger(w, f"{opts.trigger_minutes} minutes", available_now).start()


def query_id(spark: SparkSession, checkpoint: str) -> str:
    """The id Spark keeps in a query's checkpoint."""
    return json.loads(fs.read_text(spark, f"{checkpoint}/metadata"))["id"]


def start_publish(spark: SparkSession, table_path: str, start_version: int, checkpoint: str, handle_batch,
                  max_bytes: int = MAX_BYTES, name: str | None = None) -> StreamingQuery:
    """SNK-5 / SEM-16: the change feed of one table, from ``start_version`` on.

    A micro-batch is the change files of about ``max_bytes`` (``sources.offsets``), so
    Spark bounds it, also within a large version. Its post-images (FLT-4) go to
    ``handle_batch(df, batch_id)``; a replay hands them over again, which the
    sequence guard makes harmless. ``finish`` ends the query when all is done.
    """
    watch(spark)
    files = read_change_files(spark, table_path, checkpoint, list(CHANGE_KINDS), start_version, max_bytes)

    def each(batch: DataFrame, batch_id: int) -> None:
        rows = batch.collect()  # the names of one batch's files
        if rows:
            handle_batch(post_images(tables.read_change_rows(spark, table_path, rows)), batch_id)

    w = files.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint)
    if name:
        w = w.queryName(name)
    return w.trigger(processingTime="0 seconds").start()


def drain(query: StreamingQuery, timeout_s: float | None = None) -> None:
    """Wait for an AvailableNow query on its own handle, surfacing its error."""
    query.awaitTermination(timeout_s)
    _raise_error(query)


def finish(query: StreamingQuery) -> None:
    """Let a query process all there is, then end it, surfacing its error."""
    try:
        query.processAllAvailable()
    finally:
        query.stop()
        _raise_error(query)


def _raise_error(query: StreamingQuery) -> None:
    if query.exception() is not None:
        raise RuntimeError(str(query.exception()))
