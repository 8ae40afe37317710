"""Avro payloads: against a record-by-record reader, malformed ones, schema resolution, and as columns."""

import datetime as dt
import decimal
import json
import random
import struct

import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.errors import PythonException
from pyspark.sql import functions as F

from tests_conf import smoke_dir
from tidewater import catalog as C
from tidewater.functions import avro as A
from tidewater.functions.codec import decode
from tidewater.sources import feed

SCHEMA = {"type": "record", "name": "r.R", "fields": [
    {"name": "a", "type": "long"}, {"name": "b", "type": ["null", "string"]}, {"name": "c", "type": {"type": "array", "items": ["null", "int"]}},
    {"name": "m", "type": {"type": "map", "values": {"type": "record", "name": "V", "fields": [{"name": "x", "type": "double"}]}}},
    {"name": "d", "type": {"type": "bytes", "logicalType": "decimal", "precision": 12, "scale": 3}},
    {"name": "e", "type": {"type": "enum", "name": "E", "symbols": ["X", "Y", "Z"]}}, {"name": "e2", "type": ["null", "E"]},
    {"name": "t", "type": {"type": "long", "logicalType": "timestamp-micros"}}, {"name": "u", "type": {"type": "int", "logicalType": "date"}},
    {"name": "ms", "type": ["null", {"type": "long", "logicalType": "timestamp-millis"}]},
    {"name": "f", "type": "float"}, {"name": "z", "type": "boolean"}, {"name": "n", "type": ["null", {"type": "array", "items": {"type": "array", "items": "bytes"}}]},
    {"name": "q", "type": {"type": "fixed", "name": "F", "size": 3}}]}
NODE = A.parse_schema(SCHEMA)
UTC = dt.timezone.utc


def zigzag(n):
    out, n = b"", (n << 1) ^ (n >> 63)
    while True:
        out += bytes([n & 127 | (128 if n > 127 else 0)])
        n >>= 7
        if not n:
            return out


def plain_write(s, v):
    """One value by the specification, in blocks of one item with their size."""
    if isinstance(s, list):
        i = next(i for i, x in enumerate(s) if (x == "null") == (v is None))
        return zigzag(i) + plain_write(s[i], v)
    kind, logical = (s, None) if isinstance(s, str) else (s["type"], s.get("logicalType"))
    if kind == "null":
        return b""
    if kind == "record":
        return b"".join(plain_write(f["type"], v[f["name"]]) for f in s["fields"])
    if kind == "array":
        items = [plain_write(s["items"], x) for x in v]
        return b"".join(zigzag(-1) + zigzag(len(x)) + x for x in items) + b"\0"
    if kind == "map":
        return b"".join(zigzag(1) + plain_write("string", k) + plain_write(s["values"], x) for k, x in v) + b"\0"
    if kind in ("enum", "E"):
        return zigzag("XYZ".index(v))
    if logical == "decimal":
        n = int(v.scaleb(3))
        v = n.to_bytes(n.bit_length() // 8 + 1, "big", signed=True)
    if logical == "date":
        return zigzag((v - dt.date(1970, 1, 1)).days)
    if logical in ("timestamp-micros", "timestamp-millis"):
        us = (v - dt.datetime(1970, 1, 1, tzinfo=UTC)) // dt.timedelta(microseconds=1)
        return zigzag(us if logical.endswith("micros") else us // 1000)
    if kind in ("int", "long"):
        return zigzag(v)
    if kind in ("float", "double"):
        return struct.pack("<f" if kind == "float" else "<d", v)
    if kind == "boolean":
        return bytes([v])
    if kind == "fixed":
        return v
    data = v.encode() if isinstance(v, str) else v
    return zigzag(len(data)) + data


def some_rows(seed, n):
    r = random.Random(seed)
    when = lambda: dt.datetime(1900, 1, 1, tzinfo=UTC) + dt.timedelta(seconds=r.randrange(2**33), milliseconds=r.randrange(1000))
    text = lambda: "".join(r.choice("aé漢\U0001f600 ") for _ in range(r.randrange(6)))
    return [{"a": r.choice([0, -1, 63, -64, 64, 2**63 - 1, -2**63, r.randrange(-10**6, 10**6)]), "b": r.choice([None, text()]),
             "c": [r.choice([None, r.randrange(-2**31, 2**31)]) for _ in range(r.randrange(5))], "m": [(f"k{i}", {"x": r.random()}) for i in range(r.randrange(3))],
             "d": decimal.Decimal(r.randrange(-10**11, 10**11)).scaleb(-3), "e": r.choice("XYZ"), "e2": r.choice([None, "Y"]), "t": when(), "u": when().date(),
             "ms": r.choice([None, when()]), "f": struct.unpack("<f", struct.pack("<f", r.random()))[0], "z": r.random() < 0.5,
             "n": r.choice([None, [[text().encode() for _ in range(r.randrange(3))] for _ in range(r.randrange(3))]]), "q": bytes(r.randrange(256) for _ in range(3))}
            for _ in range(n)]


@settings(max_examples=40, deadline=None)
@given(st.integers(0, 10**6), st.integers(0, 30))
def test_reads_what_a_record_by_record_writer_wrote_and_back(seed, n):
    rows = some_rows(seed, n)
    rows = [None if i % 7 == 3 else row for i, row in enumerate(rows)]
    wire = pa.array([None if row is None else plain_write(SCHEMA, row) for row in rows], pa.binary())
    assert A.decode_array(wire, NODE).to_pylist() == rows
    own = A.encode_array(pa.array(rows, NODE.arrow), NODE)
    assert A.decode_array(own, NODE).to_pylist() == rows
    sliced = pa.concat_arrays([wire, wire]).slice(n // 2, n)
    assert A.decode_array(sliced, NODE).to_pylist() == (rows + rows)[n // 2:n // 2 + n]


@settings(max_examples=150, deadline=None)
@given(st.integers(0, 10**6), st.integers(0, 200), st.binary(max_size=30), st.integers(0, 30))
def test_damaged_records_are_null_and_spare_the_others(seed, at, noise, cut):
    good = [plain_write(SCHEMA, row) for row in some_rows(seed, 2)]
    at = min(at, len(good[0]))
    bad = good[0][:at] + noise + good[0][min(len(good[0]), at + cut):]
    out = A.decode_array(pa.array([good[0], bad, good[1]], pa.binary()), NODE, mode="PERMISSIVE")
    assert out.take(pa.array([0, 2])).to_pylist() == some_rows(seed, 2)
    if bad == good[0][:at] and at < len(good[0]):
        assert not out[1].is_valid


@pytest.mark.parametrize("schema, payload", [
    ("long", b""), ("long", b"\x80" * 10 + b"\x00"), ("int", zigzag(2**31)), ("boolean", b"\x02"), ("string", zigzag(-1)), ("string", zigzag(2) + b"\xff\xfe"),
    ("bytes", zigzag(2**62) + b"x"), ("double", b"1234567"), (["null", "long"], zigzag(2)), ({"type": "enum", "name": "E", "symbols": ["A"]}, zigzag(1)),
    ({"type": "array", "items": "long"}, zigzag(2**60) + b"\x00"), ({"type": "array", "items": "long"}, zigzag(1) + zigzag(4)), ("long", zigzag(5) + b"x"),
    ({"type": "bytes", "logicalType": "decimal", "precision": 2, "scale": 0}, zigzag(2) + b"\x7f\xff"),
])
def test_malformed(schema, payload):
    node = A.parse_schema(schema if not isinstance(schema, str) else json.dumps(schema))
    assert A.decode_array(pa.array([payload], pa.binary()), node, mode="PERMISSIVE").to_pylist() == [None]
    with pytest.raises(ValueError, match="malformed"):
        A.decode_array(pa.array([payload], pa.binary()), node)


def test_reader_schema():
    writer = A.parse_schema({"type": "record", "name": "W", "fields": [
        {"name": "a", "type": "int"}, {"name": "gone", "type": "string"}, {"name": "old", "type": ["null", "long"]},
        {"name": "in", "type": {"type": "record", "name": "I", "fields": [{"name": "x", "type": "int"}, {"name": "y", "type": "string"}]}}]})
    reader = A.parse_schema({"type": "record", "name": "W", "fields": [
        {"name": "in", "type": {"type": "record", "name": "I", "fields": [{"name": "y", "type": "bytes"}, {"name": "n", "type": ["null", "int"], "default": None}]}},
        {"name": "new", "aliases": ["old"], "type": ["null", "double"]}, {"name": "a", "type": "double"}, {"name": "d", "type": "string", "default": "x"}]})
    wire = A.encode_array(pa.array([{"a": 1, "gone": "g", "old": 7, "in": {"x": 1, "y": "q"}}, {"a": -2, "gone": "", "old": None, "in": {"x": 2, "y": ""}}],
                                   writer.arrow), writer)
    assert A.decode_array(wire, writer, reader).to_pylist() == [
        {"in": {"y": b"q", "n": None}, "new": 7.0, "a": 1.0, "d": "x"}, {"in": {"y": b"", "n": None}, "new": None, "a": -2.0, "d": "x"}]
    strict = A.parse_schema({"type": "record", "name": "W", "fields": [{"name": "old", "type": "long"}]})
    assert A.decode_array(wire, writer, strict, "PERMISSIVE").to_pylist() == [{"old": 7}, None]
    for bad in ({"name": "d", "type": "string"}, {"name": "a", "type": "string"}):
        with pytest.raises(ValueError):
            A.decode_array(wire, writer, A.parse_schema({"type": "record", "name": "W", "fields": [bad]}))


def test_unions_of_several_types_and_schemas_that_are_rejected():
    node = A.parse_schema(["null", "long", "string"])
    wire = pa.array([zigzag(0), zigzag(1) + zigzag(5), zigzag(2) + zigzag(1) + b"s"], pa.binary())
    assert A.decode_array(wire, node).to_pylist() == [None, {"member0": 5, "member1": None}, {"member0": None, "member1": "s"}]
    assert A.decode_array(pa.array([zigzag(0) + zigzag(5), zigzag(1) + zigzag(2**40)], pa.binary()), A.parse_schema(["int", "long"])).to_pylist() == [5, 2**40]
    with pytest.raises(ValueError, match="recursive"):
        A.parse_schema({"type": "record", "name": "L", "fields": [{"name": "next", "type": ["null", "L"]}]})


def test_columns_fail_fast_or_give_null(spark):
    rows = [(i, bytes(plain_write(SCHEMA, r))) for i, r in enumerate(some_rows(1, 50))]
    df = spark.createDataFrame(rows + [(50, None)], "i INT, p BINARY").repartition(3)
    out = {r["i"]: r["v"] for r in df.select("i", A.decode_avro(F.col("p"), json.dumps(SCHEMA)).alias("v")).collect()}
    want = some_rows(1, 50)
    assert out[50] is None
    for i, w in enumerate(want):
        assert out[i]["a"] == w["a"] and out[i]["d"] == w["d"] and out[i]["u"] == w["u"] and out[i]["c"] == w["c"] and out[i]["b"] == w["b"]
        assert {k: v["x"] for k, v in out[i]["m"].items()} == {k: v["x"] for k, v in w["m"]} and bytes(out[i]["q"]) == w["q"]
    back = df.select("i", "p", A.encode_avro(A.decode_avro(F.col("p"), json.dumps(SCHEMA)), json.dumps(SCHEMA)).alias("e"))
    again = {r["i"]: r["v"] for r in back.select("i", A.decode_avro(F.col("e"), json.dumps(SCHEMA)).alias("v")).collect()}
    assert again == out
    broken = df.withColumn("p", F.when(F.col("i") == 7, F.lit(b"\x01")).otherwise(F.col("p")))
    nulls = broken.select("i", decode(F.col("p"), json.dumps(SCHEMA), "avro", "PERMISSIVE").alias("v")).filter("v IS NULL").collect()
    assert sorted(r["i"] for r in nulls) == [7, 50]
    with pytest.raises(PythonException, match="malformed Avro"):
        broken.select(decode(F.col("p"), json.dumps(SCHEMA), "avro")).collect()


def test_structured_leg_over_avro_equals_json(spark):
    """The whole leg (envelope, registry schema, merge, counts) on Avro bodies."""
    from dataclasses import replace

    from helpers import as_set
    from tidewater.config import RunOptions, TableConfig
    from tidewater.plans import registry as REG
    from tidewater.plans import structured as ST
    from tidewater.session import scratch_path
    from tidewater.sources import folders, tables
    d = smoke_dir()
    results = []
    for codec in ("json", "avro"):
        if codec == "json":
            batch, entries = C.raw_table(spark, d), C.entries()
        else:
            log = feed.avro_log(C.events(spark, d))
            batch = log.withColumn("body", decode(F.col("body"), feed.AVRO_ENVELOPE, "avro")) \
                .withColumn("rawLayerProcessingTime", F.col("enqueuedTime") + F.expr("INTERVAL 60 SECONDS"))
            entries = [replace(e, data_schema=feed.avro_schema(e.message_schema_id)) for e in C.entries()]

        class Registry(REG.RegistryCache):
            def __init__(self):
                super().__init__(spark, "")
                self.by_id = {e.message_schema_id: e for e in entries}
        root, counts = scratch_path(spark, "st"), scratch_path(spark, "counts")
        ST.process_batch(spark, batch, 0, Registry(), [TableConfig("SRC", "EVENTS")], root, RunOptions(codec=codec), counts)
        table = tables.read_table(spark, ST.table_path(root, "SRC", "EVENTS")).drop("_structuredLayerProcessingTime")
        results.append((as_set(table), as_set(folders.read(spark, counts).drop("logTimeStamp"))))
    assert results[0] == results[1]
