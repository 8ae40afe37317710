"""WARC archives: a writer through Spark's text sink and a salvage reader.

Writing: one record per page, each a gzip member of its own, in files that
Spark writes to any file system it knows, of bounded records and bytes. Pages with equal payloads are stored
once; the others become ``revisit`` records. The line separator of the text
sink is an empty gzip member, so a file is a valid multi-member gzip stream.

Reading: members and records are checked in turn (gzip checksum, version line,
header, length, closing blank lines, block digest). After a failed check the
reader looks for the next gzip member or version line that passes all checks,
goes on there and reports the skipped bytes as a quarantined gap. In a gzip
member it looks for version lines in the text, also in that of a cut or damaged
member as far as it can be read; records and gaps of such a member are placed
by the compressed bytes that they come from. The gzip checksum is a check of
the record in a member of one; in a member of many it does not tell which one
is hurt, and their checks are those of a plain file: length and block digest.

Edge cases: NULL html is an empty payload, NULL url has no target URI, a NULL
page_id has no id header and reads back as NULL; rows that repeat the smallest
page_id of a payload are all responses; empty tables give no files' records;
further columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.llm.common import released, table
from tidewater.session import scratch_path

# Fixed values of the format.
VERSION = b"WARC/1.1\r\n"
END = b"\r\n\r\n"
MAGIC = b"\x1f\x8b\x08"
PROFILE = b"http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP_HEAD = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n"
EMPTY_MEMBER = "\x1f\x8b\x08\x00\x00\x00\x00\x00\x00\x03\x03\x00\x00\x00\x00\x00\x00\x00\x00\x00"

DATE = b"2024-01-01T00:00:00Z"
MIN_REVISIT_BYTES = 0
#: A file ends before it passes one of these; a longer record is a file of its own.
RECORDS_PER_FILE = 4096
FILE_BYTES = 16 << 20
_START = re.compile(rb"\x1f\x8b\x08|WARC/[0-9]+\.[0-9]+\r\n")
_VERSION = re.compile(rb"WARC/[0-9]+\.[0-9]+\r\n")
READ_DDL = ("kind string, offset long, length long, page_id long, url string, payload_bytes long, "
            "payload_digest string, record_type string, refers_to long")


def sha1_base32(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, revisit: bool) -> bytes:
    """One record, uncompressed. A revisit keeps digest and length of the payload, not the payload."""
    block = b"" if revisit else HTTP_HEAD % len(payload) + payload
    head = [b"WARC-Type: " + (b"revisit" if revisit else b"response"), b"WARC-Date: " + DATE]
    if page_id is not None:
        head += [b"WARC-Record-ID: <urn:x-page:%d>" % page_id, b"X-Page-Id: %d" % page_id]
    if url is not None:
        head.append(b"WARC-Target-URI: " + re.sub(rb"[\x00-\x20\x7f]", lambda m: b"%%%02X" % m[0][0], url.encode()))
    if revisit:
        head += [b"WARC-Profile: " + PROFILE, b"WARC-Refers-To: <urn:x-page:%d>" % refers_to]
    head += [b"WARC-Payload-Digest: sha1:" + sha1_base32(payload).encode(), b"X-Payload-Length: %d" % len(payload),
             b"WARC-Block-Digest: sha1:" + sha1_base32(block).encode(),
             b"Content-Type: application/http; msgtype=response", b"Content-Length: %d" % len(block)]
    return VERSION + b"\r\n".join(head) + END + block + END


def gzip_member(data: bytes, level: int = 1) -> bytes:
    z = zlib.compressobj(level, zlib.DEFLATED, 31)
    return z.compress(data) + z.flush()


def parse_record(data, at: int) -> tuple[dict, bytes, int] | None:
    """(header fields, block, end) of the record at ``at``, or None if a check fails."""
    m = _VERSION.match(data, at)
    stop = data.find(END, m.end()) if m else -1
    if stop < 0:
        return None
    fields = {}
    for line in bytes(data[m.end():stop]).split(b"\r\n"):
        name, colon, value = line.partition(b":")
        if not colon:
            return None
        fields[name.strip().lower().decode("latin-1")] = value.strip().decode("utf-8", "replace")
    if not re.fullmatch(r"[0-9]{1,15}", fields.get("content-length", "")):
        return None
    first = stop + len(END)
    end = first + int(fields["content-length"])
    block = bytes(data[first:end])
    if end + len(END) > len(data) or data[end:end + len(END)] != END:
        return None
    digest = fields.get("warc-block-digest", "")
    if digest.startswith("sha1:") and digest[5:].upper() != sha1_base32(block):
        return None
    return fields, block, end + len(END)


def inflated(data: bytes, at: int) -> tuple[bytes, int | None]:
    """The body of the gzip member at ``at`` and the member's end. Of a cut or
    damaged member: the body as far as it can be read, and None."""
    z, parts, end, step = zlib.decompressobj(31), [], at, 4096
    view = memoryview(data)
    try:
        # In growing steps, as the library copies what it is given beyond the member.
        while not z.eof and end < len(data):
            parts.append(z.decompress(view[end:end + step]))
            end, step = min(end + step, len(data)), step * 2
        return b"".join(parts), end - len(z.unused_data) if z.eof else None
    except zlib.error:
        pass
    # An error takes the output of its whole step with it: again, in shrinking steps.
    z, parts, end, step = zlib.decompressobj(31), [], at, 1 << 16
    while step:
        probe = z.copy()
        try:
            parts.append(probe.decompress(view[end:end + step]))
            z, end = probe, end + step
        except zlib.error:
            step //= 2
    return b"".join(parts), None


def places(data: bytes, at: int, wanted: list[int]) -> dict[int, int]:
    """For each length of a body, ascending, the end of the least stretch of the
    member at ``at`` that gives so many bytes."""
    view, z, end, made = memoryview(data), zlib.decompressobj(31), at, 0
    out = {}
    for n in wanted:
        step = 4096 if n else 0
        while step:
            probe = z.copy()
            try:
                got = made + len(probe.decompress(view[end:end + step]))
            except zlib.error:
                got = n
            if got < n:
                z, end, made = probe, end + step, got
            else:
                step //= 2
        out[n] = end + 1 if n else at
    return out


def body_records(body: bytes) -> Iterator[tuple[int, int, dict, bytes]]:
    """(start, end, header fields, block) of the records in a member's body that
    pass all checks; after a failed one from the next version line on."""
    pos = 0
    while pos < len(body):
        got = parse_record(body, pos)
        if got is None:
            nxt = _VERSION.search(body, pos + 1)
            pos = nxt.start() if nxt else len(body)
        else:
            yield pos, got[2], got[0], got[1]
            pos = got[2]


def salvage(data: bytes) -> Iterator[tuple[str, int, int, dict, bytes]]:
    """("record" or "gap", offset, length, header fields, block) in file order."""
    pos, bad = 0, None
    while pos < len(data):
        if data.startswith(MAGIC, pos):
            body, end = inflated(data, pos)
            found = list(body_records(body))
            if end is None and len(found) == 1 and not found[0][0] and not _VERSION.match(body, found[0][1]):
                found = []  # no second record begins: the failed checksum is this one's
            if end is not None and sum(e - s for s, e, *_ in found) == len(body):
                if bad is not None:
                    yield "gap", bad, pos - bad, {}, b""
                    bad = None
                for _, _, fields, block in found:
                    yield "record", pos, end - pos, fields, block
                pos = end
                continue
        else:
            body, end, found = b"", None, []
            got = parse_record(data, pos)
            if got is not None:
                if bad is not None:
                    yield "gap", bad, pos - bad, {}, b""
                    bad = None
                yield "record", pos, got[2] - pos, got[0], got[1]
                pos = got[2]
                continue
        bad, read = pos if bad is None else bad, 0
        at = places(data, pos, sorted({x for s, e, *_ in found for x in (s, e)}))
        if end is not None:
            at[len(body)] = end
        for s, e, fields, block in found:
            if s > read or at[s] > bad:
                yield "gap", bad, at[s] - bad, {}, b""
            yield "record", at[s], at[e] - at[s], fields, block
            bad, read = at[e], e
        if end is not None:
            pos, bad = end, None if found and read == len(body) else bad
        else:
            nxt = _START.search(data, max(pos + 1, bad))
            pos = nxt.start() if nxt else len(data)
    if bad is not None and bad < len(data):
        yield "gap", bad, len(data) - bad, {}, b""


def payload_of(fields: dict, block: bytes) -> bytes:
    """The block after its HTTP head (the block itself when it has none)."""
    if fields.get("content-type", "").startswith("application/http"):
        return block.partition(END)[2]
    return block


def _id(value: str | None) -> int | None:
    m = re.search(r"(-?[0-9]+)>?$", value or "")
    return int(m[1]) if m else None


def described(kind: str, offset: int, length: int, fields: dict, block: bytes) -> tuple:
    if kind == "gap":
        return kind, offset, length, None, None, None, None, None, None
    if fields.get("warc-type") == "revisit":
        size = fields.get("x-payload-length")
        n, digest = int(size) if size else None, fields.get("warc-payload-digest", "").rpartition(":")[2] or None
    else:
        payload = payload_of(fields, block)
        n, digest = len(payload), sha1_base32(payload)
    return (kind, offset, length, _id(fields.get("x-page-id")), fields.get("warc-target-uri"), n, digest,
            fields.get("warc-type"), _id(fields.get("warc-refers-to")))


def _write_batches(batches: Iterator[pa.RecordBatch], file_bytes: int) -> Iterator[pa.RecordBatch]:
    """One row for each file: its members after each other."""
    def file():
        return pa.RecordBatch.from_arrays([pa.array([b"".join(out)], pa.binary())], names=["members"])
    out, size = [], 0
    for b in batches:
        for i in range(0, b.num_rows, 256):
            for r in b.slice(i, 256).to_pylist():
                member = gzip_member(record(r["page_id"], r["url"], r["payload"] or b"", r["refers_to"], r["refers_to"] is not None))
                if out and (size + len(member) > file_bytes or len(out) == RECORDS_PER_FILE):
                    yield file()
                    out, size = [], 0
                out.append(member)
                size += len(member)
    if out:
        yield file()


def _read_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [c.split()[0] for c in READ_DDL.split(", ")]
    types = [{"long": pa.int64(), "string": pa.string()}[c.split()[1]] for c in READ_DDL.split(", ")]
    for b in batches:
        for i in range(b.num_rows):
            rows = [described(*x) for x in salvage(b.column(0)[i].as_py())]
            cols = list(zip(*rows)) or [()] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], names=names)


def revisits(pages: DataFrame, min_bytes: int = MIN_REVISIT_BYTES) -> DataFrame:
    """(page_id, digest, refers_to) of the pages whose payload an earlier page holds.
    Digests are counted per task before they are shuffled; the texts stay put."""
    ids = pages.select("page_id", F.sha1("payload").alias("digest"), F.octet_length("payload").alias("n")) \
        .filter(F.col("n") >= min_bytes).drop("n")
    first = ids.groupBy("digest").agg(F.min("page_id").alias("refers_to"), F.count(F.lit(1)).alias("n")) \
        .filter("n > 1").drop("n")
    return (ids.join(first, "digest").filter("NOT (page_id <=> refers_to) AND refers_to IS NOT NULL")
            .groupBy("page_id", "digest").agg(F.min("refers_to").alias("refers_to")))


def write_archives(pages: DataFrame, path: str, min_bytes: int = MIN_REVISIT_BYTES, file_bytes: int = FILE_BYTES) -> None:
    """Writes pages (page_id, url, html) as archives of up to ``file_bytes`` under ``path``."""
    p = pages.select("page_id", "url", F.coalesce("html", F.lit("")).cast("binary").alias("payload"))
    links = revisits(p, min_bytes).withColumnsRenamed({"page_id": "of", "digest": "with"})
    linked = p.join(links, F.col("page_id").eqNullSafe(F.col("of")) & (F.sha1("payload") == F.col("with")), "left")
    (linked.select("page_id", "url", "payload", "refers_to").mapInArrow(released(lambda batches: _write_batches(batches, file_bytes)), "members binary")
     .select(F.col("members").cast("string")).write.option("lineSep", EMPTY_MEMBER).option("encoding", "ISO-8859-1")
     .option("maxRecordsPerFile", 1).text(path))


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """Records and quarantined gaps of all archives under ``path``."""
    return spark.read.format("binaryFile").load(path).select("content").mapInArrow(released(_read_batches), READ_DDL)


def op10_warc_salvage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Archives all pages, reads the archives back and describes each record."""
    path = scratch_path(spark, "warc")
    write_archives(table(spark, sf_dir, "pages"), path)
    return read_archives(spark, path).filter("kind = 'record'").select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url")
