"""Change envelopes derived from an ``events`` table.

Each event becomes one source-table change: its type picks the operation,
its time and id form a fixed-width change sequence, its user is the key (a
share of purchases move to a new key), and its time picks one of two schema
versions. The same events also yield the metadata messages that describe
those schema versions, one per event, as a metadata log would repeat them.
Everything here is a projection, so it scales with the events table.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.config import ColumnMeta
from tidewater.functions.avro import encode_avro
from tidewater.plans.registry import COLUMN_DDL

# Fixed values of the derived feed.
SCHEMA_SPLIT = "2024-01-16 00:00:00"      # changes before this use S1, the rest S2
SCHEMA_START = {"S1": "2024-01-01 00:00:00", "S2": "2024-01-16 00:00:00"}
SOURCE_SCHEMA = "SRC"
SINGLE_TABLE = "EVENTS"
KEY_SHIFT = 100000                        # a moved key is user_id + KEY_SHIFT
ENQUEUE_DELAY_S = 5
RAW_DELAY_S = 65
COLUMNS = {
    "S1": (
        ColumnMeta("RRN", "LONG", None, None, None, False, True, False),
        ColumnMeta("AMOUNT", "NUMERIC", None, 12, 2),
        ColumnMeta("KVAL", "LONG"),
    ),
    "S2": (
        ColumnMeta("RRN", "LONG", None, None, None, False, True, False),
        ColumnMeta("AMOUNT", "NUMERIC", None, 12, 2),
        ColumnMeta("KVAL", "LONG"),
        ColumnMeta("NOTE", "STRING", 20),
    ),
}
WIRE_TYPES = {"RRN": "BIGINT", "AMOUNT": "STRING", "KVAL": "BIGINT", "NOTE": "STRING"}
HEADERS_DDL = "STRUCT<operation: STRING, changeSequence: STRING, timestamp: STRING>"


def image_ddl(schema_id: str) -> str:
    return "STRUCT<" + ", ".join(f"{c.name}: {WIRE_TYPES[c.name]}" for c in COLUMNS[schema_id]) + ">"


def data_schema(schema_id: str) -> str:
    """DDL of the payload ``{headers, data, beforeData}`` of one schema version."""
    img = image_ddl(schema_id)
    return f"headers {HEADERS_DDL}, data {img}, beforeData {img}"


def metadata_schema(schema_id: str) -> str:
    """DDL of the metadata message describing one schema version."""
    cols = ", ".join(f"{c.name}: {COLUMN_DDL}" for c in COLUMNS[schema_id])
    return ("lineage STRUCT<schema: STRING, table: STRING, timestamp: STRING>, "
            f"tableStructure STRUCT<tableColumns: STRUCT<{cols}>>, dataSchema STRING")


def change_events(events: DataFrame, tables: int = 1) -> DataFrame:
    """One change row per event (flat form)."""
    ts = F.col("ts")
    et = F.col("event_type")
    seq_body = F.concat(F.date_format(ts, "yyyyMMddHHmmss"), F.lpad(F.col("event_id").cast("string"), 21, "0"))
    schema_id = F.when(ts < F.lit(SCHEMA_SPLIT).cast("timestamp_ntz"), "S1").otherwise("S2")
    part = (F.col("user_id") % tables).cast("string")
    return events.select(
        "event_id",
        ts.alias("ts"),
        F.when(et == "signup", "INSERT").when(et == "error", "DELETE").otherwise("UPDATE").alias("operation"),
        seq_body.alias("seq_body"),
        F.concat(F.lit("10"), seq_body).alias("change_seq"),
        schema_id.alias("schema_id"),
        F.when((et == "purchase") & (F.col("event_id") % 10 == 0), F.col("user_id") + KEY_SHIFT)
         .otherwise(F.col("user_id")).alias("rrn"),
        F.when(et.isin("signup", "error"), F.lit(None).cast("bigint")).otherwise(F.col("user_id")).alias("before_rrn"),
        F.col("value").alias("amount"),
        F.get_json_object("props", "$.k").cast("bigint").alias("kval"),
        F.concat(F.lit("  "), et, F.lit(" ")).alias("note"),
        (F.lit(SINGLE_TABLE) if tables == 1 else F.concat(F.lit(SINGLE_TABLE + "_"), part)).alias("table"),
        (schema_id if tables == 1 else F.concat(schema_id, F.lit("_"), part)).alias("message_schema_id"),
    )


def _image(rrn: Column) -> Column:
    return F.struct(
        rrn.alias("RRN"),
        F.col("amount").cast("string").alias("AMOUNT"),
        F.col("kval").alias("KVAL"),
        F.when(F.col("schema_id") == "S2", F.col("note")).alias("NOTE"),
    )


def content(changes: DataFrame) -> Column:
    """The payload struct ``{headers, data, beforeData}`` of a change row."""
    return F.struct(
        F.struct(
            F.col("operation").alias("operation"),
            F.col("seq_body").alias("changeSequence"),
            F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("timestamp"),
        ).alias("headers"),
        _image(F.col("rrn")).alias("data"),
        F.when(F.col("before_rrn").isNull(), F.lit(None)).otherwise(_image(F.col("before_rrn"))).alias("beforeData"),
    )


def _envelope(kind: str, schema_col: Column, message: Column) -> Column:
    return F.struct(
        F.unhex(F.lit("0000000001")).alias("magic"),
        F.lit(kind).alias("type"),
        F.create_map(F.lit("table"), F.col("table")).alias("headers"),
        F.col("message_schema_id").alias("messageSchemaId"),
        schema_col.alias("messageSchema"),
        message.alias("message"),
    )


def data_envelopes(events: DataFrame, tables: int = 1) -> DataFrame:
    """Raw data rows: ``body`` (JSON payload as binary), ``enqueuedTime``,
    ``rawLayerProcessingTime``."""
    ch = change_events(events, tables)
    return ch.select(
        _envelope("data", F.lit(None).cast("string"), F.to_json(content(ch)).cast("binary")).alias("body"),
        (F.col("ts") + F.expr(f"INTERVAL {ENQUEUE_DELAY_S} SECONDS")).cast("timestamp").alias("enqueuedTime"),
        (F.col("ts") + F.expr(f"INTERVAL {RAW_DELAY_S} SECONDS")).cast("timestamp").alias("rawLayerProcessingTime"),
    )


def avro_schema(schema_id: str) -> str:
    """``data_schema`` as an Avro schema."""
    wire = {"BIGINT": "long", "STRING": "string"}

    def record(name: str, fields: dict[str, object]) -> dict:
        return {"type": "record", "name": name, "fields": [{"name": n, "type": ["null", t], "default": None} for n, t in fields.items()]}
    image = record(f"image_{schema_id}", {c.name: wire[WIRE_TYPES[c.name]] for c in COLUMNS[schema_id]})
    return json.dumps(record(f"change_{schema_id}", {
        "headers": record("change_headers", {n: "string" for n in ("operation", "changeSequence", "timestamp")}),
        "data": image, "beforeData": f"image_{schema_id}"}))


#: The envelope as an Avro schema.
AVRO_ENVELOPE = json.dumps({"type": "record", "name": "envelope", "fields": [
    {"name": "magic", "type": {"type": "fixed", "name": "magic_bytes", "size": 5}},
    {"name": "type", "type": "string"},
    {"name": "headers", "type": ["null", {"type": "map", "values": "string"}]},
    *[{"name": n, "type": ["null", "string"]} for n in ("messageSchemaId", "messageSchema")],
    {"name": "message", "type": "bytes"}]})


def avro_log(events: DataFrame, tables: int = 1) -> DataFrame:
    """The event log with Avro bodies: binary ``body`` and ``enqueuedTime``. Payloads are written by
    the schema of their version, and envelopes around them."""
    ch = change_events(events, tables)
    content_of = content(ch)
    message = F.lit(None).cast("binary")
    for sid in COLUMNS:
        names = [c.name for c in COLUMNS[sid]]
        row = F.struct(content_of["headers"].alias("headers"), *[
            F.when(content_of[part].isNotNull(), F.struct(*[content_of[part][n].alias(n) for n in names])).alias(part) for part in ("data", "beforeData")])
        message = F.when(F.col("schema_id") == sid, encode_avro(F.when(F.col("schema_id") == sid, row), avro_schema(sid))).otherwise(message)
    return ch.withColumn("message", message).select(
        encode_avro(_envelope("data", F.lit(None).cast("string"), F.col("message")), AVRO_ENVELOPE).alias("body"),
        (F.col("ts") + F.expr(f"INTERVAL {ENQUEUE_DELAY_S} SECONDS")).cast("timestamp").alias("enqueuedTime"))


def _metadata_message(schema_id: str) -> Column:
    cols = F.struct(*[
        F.struct(
            F.lit(i + 1).alias("ordinal"), F.lit(c.type).alias("type"),
            F.lit(c.length).cast("int").alias("length"), F.lit(c.precision).cast("int").alias("precision"),
            F.lit(c.scale).cast("int").alias("scale"), F.lit(c.nullable).alias("nullable"),
            F.lit(c.is_key).alias("isKey"), F.lit(c.is_pii).alias("isPii"),
        ).alias(c.name)
        for i, c in enumerate(COLUMNS[schema_id])
    ])
    return F.to_json(F.struct(
        F.struct(F.lit(SOURCE_SCHEMA).alias("schema"), F.col("table").alias("table"),
                 F.lit(SCHEMA_START[schema_id]).alias("timestamp")).alias("lineage"),
        F.struct(cols.alias("tableColumns")).alias("tableStructure"),
        F.lit(data_schema(schema_id)).alias("dataSchema"),
    ))


def metadata_envelopes(events: DataFrame, tables: int = 1) -> DataFrame:
    """Raw metadata rows: every change repeats the description of its schema."""
    ch = change_events(events, tables)
    s1 = F.col("schema_id") == "S1"
    schema_col = F.when(s1, F.lit(metadata_schema("S1"))).otherwise(F.lit(metadata_schema("S2")))
    message = F.when(s1, _metadata_message("S1")).otherwise(_metadata_message("S2")).cast("binary")
    return ch.select(
        _envelope("metadata", schema_col, message).alias("body"),
        (F.col("ts") + F.expr(f"INTERVAL {ENQUEUE_DELAY_S} SECONDS")).cast("timestamp").alias("enqueuedTime"),
    )
