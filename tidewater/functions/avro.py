"""Avro binary records as columns (FUN-12), without a package on the classpath.

A batch is decoded column by column, not record by record: every row has a
position in the batch's bytes, and one step reads the next field of all rows
at once (numpy over the Arrow buffers). Unions split the rows by branch, and
arrays and maps take one step an item for the rows that still have one.

Types follow Spark's own Avro mapping: a union with null is a nullable value,
int with long is long, float with double is double, another union a struct
``member0, member1, ...``; enums are strings, fixed is binary; decimal, date,
timestamp-millis and -micros are kept. A reader schema picks fields by name
or alias, fills defaults and promotes numbers, strings and bytes.

A payload is malformed if it ends early or late, or holds a branch, symbol,
length or text that cannot be. FAILFAST fails the query then; PERMISSIVE gives
NULL. A NULL payload is NULL. Recursive schemas are rejected.
"""

from __future__ import annotations

import decimal
import json
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

PRIMITIVES = frozenset("null boolean int long float double bytes string".split())
_SPARK = {"null": T.NullType(), "boolean": T.BooleanType(), "int": T.IntegerType(), "long": T.LongType(), "float": T.FloatType(),
          "double": T.DoubleType(), "bytes": T.BinaryType(), "string": T.StringType(), "enum": T.StringType(), "fixed": T.BinaryType()}
_LOGICAL = {"date": T.DateType(), "timestamp-millis": T.TimestampType(), "timestamp-micros": T.TimestampType()}
_PROMOTED = {"int": ("long", "float", "double"), "long": ("float", "double"), "float": ("double",), "string": ("bytes",), "bytes": ("string",)}
_TIME = pa.timestamp("us", tz="UTC")


@dataclass
class Node:
    """One type of a schema."""

    kind: str
    name: str = ""
    parts: list[Node] = field(default_factory=list)      # of a record, union, array or map
    fields: list[dict] = field(default_factory=list)     # of a record: name, aliases, default
    symbols: list[str] = field(default_factory=list)
    size: int = 0
    logical: str = ""
    precision: int = 0
    scale: int = 0

    @property
    def spark(self) -> T.DataType:
        if self.logical == "decimal":
            return T.DecimalType(self.precision, self.scale)
        if self.logical:
            return _LOGICAL[self.logical]
        if self.kind == "record":
            return T.StructType([T.StructField(f["name"], p.spark) for f, p in zip(self.fields, self.parts)])
        if self.kind == "array":
            return T.ArrayType(self.parts[0].spark)
        if self.kind == "map":
            return T.MapType(T.StringType(), self.parts[0].spark)
        if self.kind == "union":
            return T.StructType([T.StructField(f"member{i}", p.spark) for i, p in enumerate(self.members)]) if self.wide is None else self.wide.spark
        return _SPARK[self.kind]

    @property
    def members(self) -> list[Node]:
        return [p for p in self.parts if p.kind != "null"]

    @property
    def wide(self) -> Node | None:
        """The one type that all values of a union have; None if they differ."""
        kinds = {p.kind for p in self.members}
        if len(self.members) == 1:
            return self.members[0]
        if not self.members:
            return Node("null")
        for pair in (("int", "long"), ("float", "double")):
            if kinds == set(pair) and not any(p.logical for p in self.members):
                return Node(pair[1])
        return None

    @property
    def arrow(self) -> pa.DataType:
        if self.logical == "decimal":
            return pa.decimal128(self.precision, self.scale)
        if self.logical:
            return pa.date32() if self.logical == "date" else _TIME
        if self.kind == "record":
            return pa.struct([pa.field(f["name"], p.arrow) for f, p in zip(self.fields, self.parts)])
        if self.kind == "array":
            return pa.list_(self.parts[0].arrow)
        if self.kind == "map":
            return pa.map_(pa.string(), self.parts[0].arrow)
        if self.kind == "union":
            return pa.struct([pa.field(f"member{i}", p.arrow) for i, p in enumerate(self.members)]) if self.wide is None else self.wide.arrow
        return {"null": pa.null(), "boolean": pa.bool_(), "int": pa.int32(), "long": pa.int64(), "float": pa.float32(), "double": pa.float64(),
                "bytes": pa.binary(), "fixed": pa.binary(), "string": pa.string(), "enum": pa.string()}[self.kind]


def parse_schema(text: str | dict | list) -> Node:
    """A schema's JSON text as types."""
    names: dict[str, Node] = {}

    def full(name: str, space: str) -> str:
        return name if "." in name or not space else f"{space}.{name}"

    def read(s, space: str, open_names: tuple[str, ...]) -> Node:
        if isinstance(s, list):
            return Node("union", parts=[read(x, space, open_names) for x in s])
        if isinstance(s, str):
            if s in PRIMITIVES:
                return Node(s)
            name = full(s, space)
            name = name if name in names or name in open_names else s
            if name in open_names:
                raise ValueError(f"recursive Avro schema {name}")
            return names[name]
        kind = s["type"]
        if isinstance(kind, (dict, list)):
            return read(kind, space, open_names)
        if kind in ("record", "enum", "fixed"):
            name = full(s["name"], s.get("namespace", space))
            inner = name.rpartition(".")[0]
            node = Node(kind, name, symbols=list(s.get("symbols", [])), size=int(s.get("size", 0)))
            if kind == "record":
                node.fields = [{"name": f["name"], "aliases": f.get("aliases", []), **({"default": f["default"]} if "default" in f else {})} for f in s["fields"]]
                node.parts = [read(f["type"], inner, (*open_names, name)) for f in s["fields"]]
            names[name] = node
        elif kind in ("array", "map"):
            node = Node(kind, parts=[read(s["items" if kind == "array" else "values"], space, open_names)])
        else:
            node = read(kind, space, open_names)
            node = Node(node.kind, node.name, node.parts, node.fields, node.symbols, node.size)
        logical = s.get("logicalType", "")
        if logical == "decimal" and kind in ("bytes", "fixed"):
            node.logical, node.precision, node.scale = logical, int(s["precision"]), int(s.get("scale", 0))
        elif (logical, node.kind) in (("date", "int"), ("timestamp-millis", "long"), ("timestamp-micros", "long")):
            node.logical = logical
        return node
    return read(json.loads(text) if isinstance(text, str) else text, "", ())


class Records:
    """The payloads of a batch, a position in each, and which are malformed."""

    def __init__(self, payloads: pa.Array):
        n, offset = len(payloads), payloads.offset
        ends = np.frombuffer(payloads.buffers()[1], np.int32, n + offset + 1)[offset:].astype(np.int64)
        data = payloads.buffers()[2]
        self.data = np.append(np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8), np.zeros(1, np.uint8))
        self.pos, self.end = ends[:-1].copy(), ends[1:]
        self.bad = np.zeros(n, bool)

    def fail(self, rows: np.ndarray) -> None:
        self.bad[rows] = True
        self.pos[rows] = self.end[rows]

    def byte(self, rows: np.ndarray) -> np.ndarray:
        at = self.pos[rows]
        self.fail(rows[at >= self.end[rows]])
        out = self.data[np.minimum(at, len(self.data) - 1)]
        self.pos[rows] = np.minimum(at + 1, self.end[rows])
        return out

    def longs(self, rows: np.ndarray) -> np.ndarray:
        """The next zig-zag number of each of ``rows``."""
        out, going = np.zeros(len(rows), np.uint64), np.arange(len(rows))
        for shift in range(0, 70, 7):
            b = self.byte(rows[going])
            out[going] |= (b & 127).astype(np.uint64) << np.uint64(shift)
            going = going[(b >= 128) & ~self.bad[rows[going]]]
            if not len(going):
                break
        self.fail(rows[going])
        return (out >> np.uint64(1)).view(np.int64) ^ -(out & np.uint64(1)).view(np.int64)

    def chunks(self, rows: np.ndarray, sizes: np.ndarray) -> pa.Array:
        """The next ``sizes`` bytes of each of ``rows``."""
        wrong = (sizes < 0) | (sizes > self.end[rows] - self.pos[rows])
        self.fail(rows[wrong])
        sizes = np.where(wrong, 0, sizes)
        ends = np.cumsum(np.append(0, sizes))
        at = np.repeat(self.pos[rows] - ends[:-1], sizes) + np.arange(ends[-1])
        self.pos[rows] += sizes
        return pa.Array.from_buffers(pa.binary(), len(rows), [None, pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(self.data[at])])

    def text(self, rows: np.ndarray) -> pa.Array:
        raw = self.chunks(rows, self.longs(rows))
        try:
            return raw.cast(pa.string())
        except pa.ArrowInvalid:  # some row is not UTF-8
            out = [_utf8(x.as_py()) for x in raw]
            self.fail(rows[[t is None for t in out]])
            return pa.array([t or "" for t in out], pa.string())


def _utf8(data: bytes) -> str | None:
    try:
        return data.decode()
    except UnicodeDecodeError:
        return None


def _at_rows(values: pa.Array, where: np.ndarray, n: int) -> pa.Array:
    """``values`` at places ``where`` of ``n``, NULL elsewhere."""
    at = np.zeros(n, np.int64)
    at[where] = np.arange(len(where))
    missing = np.ones(n, bool)
    missing[where] = False
    return values.take(pa.array(at, mask=missing)) if len(where) else pa.nulls(n, values.type)


def _read(node: Node, r: Records, rows: np.ndarray) -> pa.Array:
    """The next value of each of ``rows``."""
    k, n = node.kind, len(rows)
    if k == "null":
        return pa.nulls(n)
    if k == "record":
        parts = [_read(p, r, rows) for p in node.parts]
        return pa.StructArray.from_arrays(parts, fields=list(node.arrow)) if parts else pa.array([{}] * n, node.arrow)
    if k == "union":
        branch = r.longs(rows)
        wrong = (branch < 0) | (branch >= len(node.parts))
        r.fail(rows[wrong])
        branch[wrong] = next((i for i, p in enumerate(node.parts) if p.kind == "null"), -1)
        found = [(p, np.flatnonzero(branch == i)) for i, p in enumerate(node.parts) if p.kind != "null"]
        read = [_at_rows(_read(p, r, rows[at]), at, n) for p, at in found]
        if node.wide is not None:
            return pc.coalesce(*[x.cast(node.arrow) for x in read]) if read else pa.nulls(n)
        some = pa.array(np.isin(branch, [i for i, p in enumerate(node.parts) if p.kind != "null"]))
        return pa.StructArray.from_arrays(read, fields=list(node.arrow), mask=pc.invert(some))
    if k in ("array", "map"):
        return _read_blocks(node, r, rows)
    if k == "boolean":
        b = r.byte(rows)
        r.fail(rows[b > 1])
        return pa.array(b == 1)
    if k in ("int", "long"):
        v = r.longs(rows)
        if k == "int":
            r.fail(rows[(v < -2**31) | (v >= 2**31)])
        if node.logical == "timestamp-millis":
            return pa.array(v * 1000).cast(_TIME)
        return pa.array(v if k == "long" else v.astype(np.int32)).cast(node.arrow)
    if k in ("float", "double"):
        size = 4 if k == "float" else 8
        raw = r.chunks(rows, np.full(n, size))
        out = np.zeros(n, f"<f{size}")
        whole = np.diff(np.frombuffer(raw.buffers()[1], np.int32, n + 1)) == size
        out[whole] = np.frombuffer(raw.buffers()[2], f"<f{size}") if whole.any() else 0
        return pa.array(out)
    if k == "string":
        return r.text(rows)
    if k == "enum":
        v = r.longs(rows)
        wrong = (v < 0) | (v >= len(node.symbols))
        r.fail(rows[wrong])
        return pa.array(node.symbols, pa.string()).take(pa.array(np.where(wrong, 0, v)))
    raw = r.chunks(rows, np.full(n, node.size) if k == "fixed" else r.longs(rows))
    if node.logical != "decimal":
        return raw
    with decimal.localcontext(decimal.Context(prec=76)):
        values = [decimal.Decimal(int.from_bytes(x.as_py(), "big", signed=True)).scaleb(-node.scale) for x in raw]
        much = np.array([abs(v) >= decimal.Decimal(10) ** (node.precision - node.scale) for v in values], bool)
        r.fail(rows[much])
        return pa.array([None if m else v for v, m in zip(values, much)], node.arrow)


def _read_blocks(node: Node, r: Records, rows: np.ndarray) -> pa.Array:
    """Arrays and maps: blocks of items, each after its number (negative: and its bytes)."""
    n, left = len(rows), np.zeros(len(rows), np.int64)
    owners, keys, items = [], [], []
    open_rows = np.arange(n)
    while len(open_rows):
        due = open_rows[left[open_rows] == 0]
        counts = r.longs(rows[due])
        r.longs(rows[due[counts < 0]])
        counts = np.abs(counts)
        least = 1 if node.kind == "map" or node.parts[0].kind != "null" else 0
        r.fail(rows[due[counts * least > r.end[rows[due]] - r.pos[rows[due]]]])
        left[due] = counts
        closed = np.zeros(n, bool)
        closed[due[counts == 0]] = True
        open_rows = open_rows[~closed[open_rows] & ~r.bad[rows[open_rows]]]
        if not len(open_rows):
            break
        if node.kind == "map":
            keys.append(r.text(rows[open_rows]))
        items.append(_read(node.parts[0], r, rows[open_rows]))
        owners.append(open_rows)
        left[open_rows] -= 1
        open_rows = open_rows[~r.bad[rows[open_rows]]]
    owner = np.concatenate(owners) if owners else np.empty(0, np.int64)
    order = pa.array(np.argsort(owner, kind="stable"))
    ends = pa.array(np.cumsum(np.append(0, np.bincount(owner, minlength=n))), pa.int32())
    values = pa.concat_arrays(items).take(order) if items else pa.array([], node.parts[0].arrow)
    if node.kind == "array":
        return pa.ListArray.from_arrays(ends, values)
    return pa.MapArray.from_arrays(ends, pa.concat_arrays(keys).take(order) if keys else pa.array([], pa.string()), values)


def _resolved(value: pa.Array, writer: Node, reader: Node, bad: np.ndarray) -> pa.Array:
    """``value`` as the reader's type; rows that it cannot hold are marked in ``bad`` (top level only)."""
    if reader.kind == "union" and reader.wide is None or writer.kind == "union" and writer.wide is None:
        if writer != reader:
            raise ValueError("a union of several types is read by the same union only")
        return value
    nullable = reader.kind == "union" and any(p.kind == "null" for p in reader.parts) or reader.kind == "null"
    if not nullable and len(bad) == len(value):
        bad |= value.is_null().to_numpy(zero_copy_only=False)
    w, t = writer.wide if writer.kind == "union" else writer, reader.wide if reader.kind == "union" else reader
    if w.kind == "null":
        return pa.nulls(len(value), t.arrow)
    if w.kind == t.kind == "record":
        parts = []
        for f, p in zip(t.fields, t.parts):
            at = next((i for i, g in enumerate(w.fields) if g["name"] in (f["name"], *f["aliases"])), None)
            if at is not None:
                inner = bad if value.null_count == 0 and len(bad) == len(value) else np.zeros(0, bool)
                parts.append(_resolved(value.field(at), w.parts[at], p, inner))
            elif "default" in f:
                parts.append(pa.array([_default(f["default"], p)] * len(value), p.arrow))
            else:
                raise ValueError(f"the writer has no field {f['name']}, and the reader no default for it")
        return pa.StructArray.from_arrays(parts, fields=list(t.arrow), mask=value.is_null())
    if w.kind == t.kind == "array":
        return pa.ListArray.from_arrays(value.offsets, _resolved(value.values, w.parts[0], t.parts[0], np.zeros(0, bool)), mask=value.is_null())
    if w.kind == t.kind == "map":
        return pa.MapArray.from_arrays(value.offsets, value.keys, _resolved(value.items, w.parts[0], t.parts[0], np.zeros(0, bool)), mask=value.is_null())
    if w.kind != t.kind and t.kind not in _PROMOTED.get(w.kind, ()):
        raise ValueError(f"{w.kind} cannot be read as {t.kind}")
    return value.cast(t.arrow, safe=False)  # a long as a double may be rounded


def _default(value, node: Node):
    """A field's default; that of a union is of its first type."""
    kind = node.parts[0].kind if node.kind == "union" else node.kind
    return value.encode("latin-1") if kind in ("bytes", "fixed") and isinstance(value, str) else value


def decode_array(payloads: pa.Array, writer: Node, reader: Node | None = None, mode: str = "FAILFAST") -> pa.Array:
    """Payloads (binary) as values of the schema, NULL for NULL and, if PERMISSIVE, for malformed ones."""
    given = np.flatnonzero(payloads.is_valid().to_numpy(zero_copy_only=False))
    r = Records(payloads.take(pa.array(given)).cast(pa.binary()))
    rows = np.arange(len(given))
    value = _read(writer, r, rows)
    r.bad |= r.pos != r.end
    if reader is not None:
        value = _resolved(value, writer, reader, r.bad)
    if r.bad.any() and mode == "FAILFAST":
        raise ValueError(f"malformed Avro payload: {int(r.bad.sum())} of {len(rows)} records of a batch; decode with mode PERMISSIVE to pass over them")
    good = np.flatnonzero(~r.bad)
    return _at_rows(value.take(pa.array(good)), given[good], len(payloads))


def decode_avro(payload: Column, schema: str, mode: str = "FAILFAST", reader: str | None = None) -> Column:
    """A column of Avro payloads, written by ``schema`` (JSON text), as the reader's or else the writer's type."""
    writer, target = parse_schema(schema), parse_schema(reader) if reader else None

    @F.arrow_udf((target or writer).spark)
    def decoded(payloads: pa.Array) -> pa.Array:
        return decode_array(payloads, writer, target, mode)
    return decoded(payload)


# ---------------------------------------------------------------- writing

def _varints(v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, bytes of each) of zig-zag numbers."""
    u = ((v << 1) ^ (v >> 63)).view(np.uint64)
    sizes = np.ones(len(u), np.int64)
    for i in range(1, 10):
        sizes += u >= np.uint64(1) << np.uint64(7 * i)
    grid = (u[:, None] >> (np.arange(10, dtype=np.uint64) * np.uint64(7))) & np.uint64(127)
    place = np.arange(10)
    grid |= np.where(place < sizes[:, None] - 1, np.uint64(128), np.uint64(0))
    return grid.astype(np.uint8)[place < sizes[:, None]], sizes


def _joined(pieces: list[tuple[np.ndarray, np.ndarray]], n: int) -> tuple[np.ndarray, np.ndarray]:
    """Row by row, the bytes of all pieces one after another."""
    sizes = sum((s for _, s in pieces), np.zeros(n, np.int64))
    at = np.cumsum(sizes) - sizes
    out = np.empty(int(sizes.sum()), np.uint8)
    for data, s in pieces:
        out[np.repeat(at - (np.cumsum(s) - s), s) + np.arange(len(data))] = data
        at = at + s
    return out, sizes


def _bytes_of(raw: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    raw = pa.concat_arrays([raw.cast(pa.binary())])
    ends = np.frombuffer(raw.buffers()[1], np.int32, len(raw) + 1 + raw.offset)[raw.offset:].astype(np.int64)
    data = raw.buffers()[2]
    return (np.frombuffer(data, np.uint8)[ends[0]:ends[-1]] if data is not None else np.empty(0, np.uint8)), np.diff(ends)


def _write(node: Node, v: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    n, k = len(v), node.kind
    if k == "null":
        return np.empty(0, np.uint8), np.zeros(n, np.int64)
    if k == "union":
        if node.wide is None or len(node.members) != 1 or len(node.parts) > 2:
            raise ValueError("only unions of one type with null are written")
        valid = v.is_valid().to_numpy(zero_copy_only=False)
        some = next(i for i, p in enumerate(node.parts) if p.kind != "null")
        if not valid.all() and len(node.parts) == 1:
            raise ValueError("NULL in a field without null")
        data, s = _write(node.parts[some], v.take(pa.array(np.flatnonzero(valid))))
        sizes = np.zeros(n, np.int64)
        sizes[valid] = s
        return _joined([_varints(np.where(valid, some, 1 - some).astype(np.int64)), (data, sizes)], n)
    if v.null_count:
        raise ValueError(f"NULL in a field of type {k}")
    if k == "record":
        return _joined([_write(p, v.field(i)) for i, p in enumerate(node.parts)], n)
    if k in ("array", "map"):
        ends = v.offsets.to_numpy().astype(np.int64)
        counts = np.diff(ends)
        inner = v.values if k == "array" else v.items
        pieces = [_write(node.parts[0], inner.slice(ends[0], ends[-1] - ends[0]))]
        if k == "map":
            pieces.insert(0, _write(Node("string"), v.keys.slice(ends[0], ends[-1] - ends[0])))
        data, s = _joined(pieces, int(counts.sum()))
        total = np.append(0, np.cumsum(s))
        each = total[ends[1:] - ends[0]] - total[ends[:-1] - ends[0]]
        head, heads = _varints(counts)
        used = counts > 0  # an empty one is the end mark alone
        return _joined([(head[np.repeat(used, heads)], np.where(used, heads, 0)), (data, each), (np.zeros(n, np.uint8), np.ones(n, np.int64))], n)
    if k == "boolean":
        return v.to_numpy(zero_copy_only=False).astype(np.uint8), np.ones(n, np.int64)
    if k in ("int", "long"):
        whole = v.cast(pa.int32()).cast(pa.int64()) if node.logical == "date" else v.cast(pa.int64())
        number = whole.to_numpy().astype(np.int64)
        return _varints(number // 1000 if node.logical == "timestamp-millis" else number)
    if k in ("float", "double"):
        size = 4 if k == "float" else 8
        return np.frombuffer(v.to_numpy().astype(f"<f{size}").tobytes(), np.uint8), np.full(n, size)
    if k == "enum":
        at = pc.index_in(v, pa.array(node.symbols, pa.string()))
        if at.null_count:
            raise ValueError(f"a value that is no symbol of {node.name}")
        return _varints(at.to_numpy().astype(np.int64))
    if node.logical == "decimal":
        numbers = [int(x.as_py().scaleb(node.scale)) for x in v]
        raw = [x.to_bytes(node.size or x.bit_length() // 8 + 1, "big", signed=True) for x in numbers]
        v = pa.array(raw, pa.binary())
    data, s = _bytes_of(v)
    if k == "fixed":
        if (s != node.size).any():
            raise ValueError(f"a value of another size than {node.name}")
        return data, s
    return _joined([_varints(s), (data, s)], n)


def encode_array(values: pa.Array, schema: Node) -> pa.Array:
    """Values as Avro payloads; a NULL top value is NULL."""
    given = np.flatnonzero(values.is_valid().to_numpy(zero_copy_only=False))
    data, sizes = _write(schema, values.take(pa.array(given)))
    ends = np.cumsum(np.append(0, sizes)).astype(np.int32)
    return _at_rows(pa.Array.from_buffers(pa.binary(), len(given), [None, pa.py_buffer(ends), pa.py_buffer(data)]), given, len(values))


def encode_avro(value: Column, schema: str) -> Column:
    """A column as Avro payloads of ``schema``: the fields of structs in the schema's order."""
    node = parse_schema(schema)

    @F.arrow_udf("binary")
    def encoded(values: pa.Array) -> pa.Array:
        return encode_array(values, node)
    return encoded(value)
