"""Envelope and payload codecs (FUN-12).

The wire payload is JSON by default. Avro records are decoded over Arrow batches
(``functions.avro``); where the spark-avro package is on the classpath, the
codec ``spark-avro`` uses it instead.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.avro.functions import from_avro

from tidewater.functions.avro import decode_avro

ENVELOPE_SCHEMA = T.StructType([
    T.StructField("magic", T.BinaryType()),
    T.StructField("type", T.StringType()),
    T.StructField("headers", T.MapType(T.StringType(), T.StringType())),
    T.StructField("messageSchemaId", T.StringType()),
    T.StructField("messageSchema", T.StringType()),
    T.StructField("message", T.BinaryType()),
])

RAW_SCHEMA = T.StructType([
    T.StructField("body", ENVELOPE_SCHEMA),
    T.StructField("enqueuedTime", T.TimestampType()),
    T.StructField("rawLayerProcessingTime", T.TimestampType()),
])

#: Column of a batch with its payloads as VARIANT.
PARSED = "_parsed"
MODES = ("FAILFAST", "PERMISSIVE")


def parse(payload: Column) -> Column:
    """A JSON payload as a VARIANT, parsed once for all schemas; NULL where it is no JSON."""
    return F.try_parse_json(payload.cast("string"))


def decode_parsed(parsed: Column, payload: Column, schema: str | T.StructType, mode: str = "FAILFAST") -> Column:
    """``decode`` of a payload that ``parse`` has read. Numbers sent for a text column
    come as their shortest form (``1.5`` for ``1.50``); a payload that is no JSON
    object of the schema's kind fails, or is NULL when PERMISSIVE."""
    if mode not in MODES:
        raise ValueError(f"decode mode must be one of {MODES}, got {mode!r}")
    ddl = schema.simpleString() if isinstance(schema, T.StructType) else f"STRUCT<{schema}>"
    if mode == "PERMISSIVE":
        return F.try_variant_get(parsed, "$", ddl)
    broken = F.raise_error(F.lit("a payload is not JSON; decode it with mode PERMISSIVE to pass over it"))
    return F.when(payload.isNotNull() & parsed.isNull(), broken).otherwise(F.variant_get(parsed, "$", ddl))


def decode(payload: Column, schema: str | T.StructType, codec: str = "json", mode: str = "FAILFAST") -> Column:
    """Decode one binary payload column by a schema (DDL text or StructType; JSON text for Avro)."""
    if mode not in MODES:
        raise ValueError(f"decode mode must be one of {MODES}, got {mode!r}")
    if codec == "json":
        return F.from_json(payload.cast("string"), schema, {"mode": mode})
    if codec == "avro":
        return decode_avro(payload, schema, mode)
    if codec == "spark-avro":
        return from_avro(payload, schema, {"mode": mode})
    raise ValueError(f"unknown codec {codec!r}")
