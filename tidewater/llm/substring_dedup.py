"""Substring dedup: words covered by a window of 50 words that also starts in a
document with a smaller doc_id are removed.

Every window has a Rabin-Karp hash, by prefix sums of a polynomial modulo 2^64.
A window also has an anchor, the least hash of the 25-word runs inside it: equal
windows have equal anchors. A first job counts anchors (about two for 27 words)
over the corpus; a window whose anchor occurs in one document only cannot
repeat. A bitmap of fixed size stands for the repeated anchors; where it is
full, more windows are counted and the result is the same.

Neighbouring windows with one anchor are a segment (some thirteen windows).
Segments are counted whole first, by anchor and a hash of their windows; where
an anchor has several different segments, as at the ends of a passage, their
windows are counted one by one. Anchor and hash make 128 bits together. A
document's repeated windows merge into maximal removal intervals.

Edge cases: NULL or empty texts have no words; shorter documents have no
window; rows of equal doc_id are not each other's smaller document, so repeated
rows stay alike; rows without doc_id neither remove nor lose words; an empty
table gives no rows; further columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.llm.common import Powers, mix, released, stored, table, text_batches, texts, word_hashes
from tidewater.llm.sketch import corpus_bits, in_bits

WINDOW = 50
#: Bits of the map of repeated anchors.
ANCHOR_BITS = 1 << 25
# Odd multipliers: of words in windows, of windows in segments.
BASES = (0x9E3779B97F4A7C15, 0xD1342543DE82EF95)
_U = np.uint64


POWERS = tuple(map(Powers, BASES))


class Windows:
    """Rolling hashes of a text's words."""

    def __init__(self, words: list[bytes]):
        self.n = len(words)
        self.hashes = word_hashes(words)
        self.sums: dict[int, np.ndarray] = {}

    def rolling(self, length: int, which: int = 0) -> np.ndarray:
        """Hash of each run of ``length`` words, in order."""
        up, down = POWERS[which].upto(self.n)
        if which not in self.sums:
            self.sums[which] = np.append(_U(0), np.cumsum(self.hashes * up, dtype=_U))
        s = self.sums[which]
        return mix((s[length:] - s[:-length]) * down[:self.n - length + 1], length)

    def anchors(self, window: int) -> np.ndarray:
        """For each window the least hash of the runs of half its length in it."""
        half = window // 2
        low, width, have = self.rolling(half), window - half + 1, 1
        while have * 2 <= width:
            low, have = np.minimum(low[:-have], low[have:]), have * 2
        return low if have == width else np.minimum(low[:have - width], low[width - have:])

    def segments(self, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Starts, ends, anchors and hashes of the runs of windows with one anchor; and the windows' hashes."""
        anchors, h = self.anchors(window), self.rolling(window)
        cuts = np.flatnonzero(anchors[1:] != anchors[:-1]) + 1
        starts, ends = np.append(0, cuts), np.append(cuts, len(h))
        up, down = POWERS[1].upto(len(h))
        sums = np.append(_U(0), np.cumsum(h * up, dtype=_U))
        hashes = mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(_U), 3)
        return starts, ends, anchors[starts], hashes, h


def _texts(batches: Iterator[pa.RecordBatch], window: int) -> Iterator[tuple[int, Windows]]:
    for b in text_batches(batches):
        for d, t in zip(b.column("doc_id").to_pylist(), texts(b)):
            words = t.split()
            if len(words) >= window:
                yield d, Windows(words)


def _gathered(found: Iterator[tuple[int, list[np.ndarray]]], names: list[str]) -> Iterator[pa.RecordBatch]:
    """Rows (doc_id, *hashes) in batches of some 100,000."""
    docs, parts, n = [], [], 0
    def batch():
        cols = [np.concatenate(c).view(np.int64) for c in zip(*parts)]
        return pa.RecordBatch.from_arrays([pa.array(np.repeat(docs, [len(p[0]) for p in parts])), *map(pa.array, cols)], names=names)
    for d, hashes in found:
        if len(hashes[0]):
            docs.append(d)
            parts.append(hashes)
            n += len(hashes[0])
        if n >= 100_000:
            yield batch()
            docs, parts, n = [], [], 0
    if n:
        yield batch()


def repeated_anchors(docs: DataFrame, window: int) -> DataFrame:
    """Anchors that occur in documents with different doc_id."""
    def run(batches):
        yield from _gathered(((d, [np.unique(w.anchors(window))]) for d, w in _texts(batches, window)), ["doc_id", "anchor"])
    return (docs.mapInArrow(released(run), "doc_id long, anchor long").groupBy("anchor")
            .agg(F.min("doc_id").alias("least"), F.max("doc_id").alias("most")).filter("least < most").select("anchor"))


def shared_segments(docs: DataFrame, window: int) -> DataFrame:
    """(doc_id, anchor, seg, windows) of the segments whose anchor repeats, each once a document."""
    bits = corpus_bits(repeated_anchors(docs, window), ANCHOR_BITS)
    shared = docs.sparkSession.sparkContext.broadcast(bits)  # ANCHOR_BITS / 8 bytes, whatever the input

    def run(batches):
        out, n = [], 0

        def batch():
            windows = [np.concatenate([h[a:b] for a, b in zip(*where)]) for *_, where, h in out]
            lengths = np.concatenate([where[1] - where[0] for *_, where, _ in out])
            offsets = np.append(0, np.cumsum(lengths)).astype(np.int32)
            return pa.RecordBatch.from_arrays(
                [pa.array(np.repeat([d for d, *_ in out], [len(x[1]) for x in out])),
                 *(pa.array(np.concatenate([x[i] for x in out]).view(np.int64)) for i in (1, 2)),
                 pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(windows).view(np.int64)))],
                names=["doc_id", "anchor", "seg", "windows"])
        for d, w in _texts(batches, window):
            starts, ends, anchors, hashes, h = w.segments(window)
            take = np.flatnonzero(in_bits(anchors, shared.value))
            if len(take):
                take = take[np.unique(hashes[take], return_index=True)[1]]
                out.append((d, anchors[take], hashes[take], (starts[take], ends[take]), h))
                n += len(h)
            if n > 200_000:
                yield batch()
                out, n = [], 0
        if out:
            yield batch()
    return stored(docs.sparkSession, docs.mapInArrow(released(run), "doc_id long, anchor long, seg long, windows array<long>"), "segments")


def removal_lists(docs: DataFrame, window: int) -> DataFrame:
    """(doc_id, segments): of each document the segments with a repeated window:
    anchor, hash, whether the whole segment is in a smaller document, and else
    which of its windows are. A list holds each segment once, however many rows
    have the doc_id, and is as long as their different texts at most."""
    spark = docs.sparkSession
    rows = shared_segments(docs.filter("doc_id IS NOT NULL"), window)
    kinds = stored(spark, rows.groupBy("anchor", "seg").agg(F.min("doc_id").alias("least"), F.first("windows").alias("windows")), "segment-kinds")
    # Anchors of several different segments: the windows in them are counted one by one.
    several = kinds.groupBy("anchor").agg(F.min("seg").alias("low"), F.max("seg").alias("high")).filter("low < high").select("anchor")
    each = kinds.join(several, "anchor").select("anchor", "seg", "least", F.posexplode("windows").alias("nth", "w"))
    first = each.groupBy("anchor", "w").agg(F.min("least").alias("first"))
    parts = each.join(first, ["anchor", "w"]).filter("first < least").groupBy("anchor", "seg") \
        .agg(F.collect_list(F.struct("nth", "first")).alias("parts"))
    known = kinds.select("anchor", "seg", "least").join(parts, ["anchor", "seg"], "left")
    some = F.transform(F.filter("parts", lambda p: p["first"] < F.col("doc_id")), lambda p: p["nth"])
    found = rows.select("doc_id", "anchor", "seg").join(known, ["anchor", "seg"]) \
        .select("doc_id", F.struct("anchor", "seg", (F.col("least") < F.col("doc_id")).alias("whole"),
                                   F.coalesce(some, F.array().cast("array<int>")).alias("nth")).alias("s")) \
        .filter("s.whole OR size(s.nth) > 0")
    return found.groupBy("doc_id").agg(F.collect_set("s").alias("segments"))


def covered(words: list[bytes], segments: list[dict], window: int) -> np.ndarray:
    """Which words lie in a repeated window."""
    listed = {(s["anchor"], s["seg"]): None if s["whole"] else s["nth"] for s in segments}
    starts, ends, anchors, hashes, h = Windows(words).segments(window)
    hit = np.zeros(len(h), bool)
    for a, b, key in zip(starts.tolist(), ends.tolist(), zip(anchors.view(np.int64).tolist(), hashes.view(np.int64).tolist())):
        if key in listed:
            if (nth := listed[key]) is None:
                hit[a:b] = True
            else:
                hit[[a + i for i in nth]] = True
    edge = np.zeros(len(words) + 1, np.int64)
    edge[:len(h)] += hit
    edge[window:] -= hit
    return np.cumsum(edge[:-1]) > 0


def kept_text(words: list[bytes], mask: np.ndarray) -> bytes:
    return b" ".join([w for w, gone in zip(words, mask.tolist()) if not gone] if mask.any() else words)


def intervals(mask: np.ndarray) -> np.ndarray:
    """Maximal runs (start, end) of a mask."""
    return np.flatnonzero(np.diff(mask.astype(np.int8), prepend=0, append=0)).reshape(-1, 2)


def _kept(batches: Iterator[pa.RecordBatch], window: int) -> Iterator[tuple[pa.RecordBatch, list[tuple[list[bytes], np.ndarray]]]]:
    for b in text_batches(batches):
        out = []
        lists = b.column(b.schema.get_field_index("segments"))
        for i, t in enumerate(texts(b)):
            words = t.split()
            if lists[i].is_valid and len(words) >= window:
                out.append((words, covered(words, lists[i].as_py(), window)))
            else:
                out.append((words, np.zeros(len(words), bool)))
        yield b, out


def _listed(docs: DataFrame, window: int) -> DataFrame:
    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    lists = removal_lists(d, window)
    return d.join(lists, "doc_id", "left").select("doc_id", "text", "segments")


def dedup_documents(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """doc_id, kept text (words joined by one space) and removal intervals in words."""
    def run(batches):
        for b, rows in _kept(batches, window):
            text = [kept_text(words, mask).decode("utf-8", "surrogatepass") for words, mask in rows]
            cuts = [[{"start": s, "end": e} for s, e in intervals(mask).tolist()] for _, mask in rows]
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array(text, pa.string()),
                 pa.array(cuts, pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())])))], names=["doc_id", "text", "removed"])
    return _listed(docs, window).mapInArrow(released(run), "doc_id long, text string, removed array<struct<start int, end int>>")


def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Windows of 50 words over all documents."""
    def run(batches):
        for b, rows in _kept(batches, WINDOW):
            digests = [hashlib.sha256(kept_text(words, mask)).hexdigest() for words, mask in rows]
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array([len(w) for w, _ in rows], pa.int64()),
                 pa.array([int(m.sum()) for _, m in rows], pa.int64()), pa.array(digests, pa.string())],
                names=["doc_id", "n_words", "n_removed", "kept_sha256"])
    return _listed(table(spark, sf_dir, "documents"), WINDOW).mapInArrow(
        released(run), "doc_id long, n_words long, n_removed long, kept_sha256 string")
