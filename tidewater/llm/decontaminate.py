"""Benchmark decontamination by size-partitioned MinHash containment search.

Test items are short and documents long, so the likeness of whole sets says
nothing. Items are partitioned by size: a partition of items of up to L
shingles searches windows of 2 L shingles, one every L / 2. An item of more
than L / 2 shingles, CONTAINED of which lie together in a document, has a
likeness of 4 / 21 at least with a window, and HASHES minima, compared one by
one, miss it with a chance below one in a hundred thousand. Items of up to
BLOCK shingles have too few for that and are found exactly: a document that
holds the share has one at least of any n - need + 1 of an item's n shingles,
and these are looked up by hash. Candidates are verified by exact containment:
the share of the item's distinct 5-word shingles that the whole document holds.

Minima are taken per block of eight shingles once; the windows of every
partition are minima over blocks. Items are searched in blocks of ITEM_BLOCK,
whose tables have a bounded size; each block is a map-only scan of all
documents. Shingles are of lower-cased words without ASCII punctuation.

Edge cases: NULL or empty texts hold nothing; items with fewer than five words
have no shingle and match nothing; repeated items or documents match each by
itself, NULL ids included; a document is never cut short; empty tables give no
rows; further columns are ignored.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewater.llm.common import mix, release_memory, released, run_hashes, table, terms, text_batches, texts, word_hashes

SHINGLE = 5
CONTAINED = 0.8
HASHES = 56
BLOCK = 8
#: Items that are searched at once.
ITEM_BLOCK = 5000
_FACTORS = mix(np.arange(1, HASHES + 1, dtype=np.uint64), 99) | np.uint64(1)
_MARKS = 22
_LOW = np.uint64((1 << _MARKS) - 1)
MATCHES = T.ArrayType(T.StructType([T.StructField("item", T.IntegerType()), T.StructField("containment", T.DoubleType())]))


def shingles(text: bytes) -> np.ndarray:
    return run_hashes(word_hashes(terms(text)), SHINGLE)


def partition_of(n: int) -> int:
    """The size limit of an item's partition: a power of two, BLOCK at least."""
    return max(BLOCK, 1 << (n - 1).bit_length())


def window_minima(minima: np.ndarray, limit: int) -> np.ndarray:
    """Minima over the windows of a partition, from those over blocks; the last
    windows reach beyond the text's end."""
    stride, span = max(1, limit // 2 // BLOCK), 2 * limit // BLOCK
    out, have = minima, 1
    while have < span:
        step = min(have, span - have)
        shifted = np.full_like(out, np.uint64(2**64 - 1))
        shifted[:, :max(0, out.shape[1] - step)] = out[:, step:]
        out, have = np.minimum(out, shifted), have + step
    return out[:, ::stride]


def least_held(n: int, percent: float) -> int:
    """How many of an item's n shingles make up the share, one at least."""
    return next((k for k in range(1, n) if k / n >= percent), n)


def owners(keys: np.ndarray, owner: np.ndarray, wanted: np.ndarray) -> set[int]:
    """Owners of the wanted keys in a sorted table."""
    low, high = np.searchsorted(keys, wanted, "left"), np.searchsorted(keys, wanted, "right")
    return {i for a, b in zip(low[low < high].tolist(), high[low < high].tolist()) for i in owner[a:b].tolist()}


class Items:
    """Tables of a block of items, of a size bounded by their number."""

    def __init__(self, item_texts: list[bytes], percent: float):
        self.percent = percent
        self.sets = [np.unique(shingles(t)) for t in item_texts]
        self.limits: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        self.marked = np.zeros(1 << _MARKS, bool)  # by the low bits of the items' minima
        self.short_marked = np.zeros(1 << _MARKS, bool)  # by those of the short items' shingles
        by_limit, short = defaultdict(list), []
        for i, s in enumerate(self.sets):
            if len(s) > BLOCK:
                by_limit[partition_of(len(s))].append(i)
            elif len(s):
                short.append((i, s[:len(s) - least_held(len(s), percent) + 1]))
        keys = np.concatenate([np.empty(0, np.uint64), *(s for _, s in short)])
        order = np.argsort(keys, kind="stable")
        self.short = keys[order], np.repeat([i for i, _ in short], [len(s) for _, s in short]).astype(np.int64)[order]
        self.short_marked[(keys & _LOW).astype(np.int64)] = True
        for limit, members in by_limit.items():
            least = np.stack([np.min(self.sets[i][None, :] * _FACTORS[:, None], axis=1) for i in members])
            self.marked[(least & _LOW).astype(np.int64)] = True
            keys = mix(least ^ _FACTORS).ravel()
            order = np.argsort(keys, kind="stable")
            self.limits[limit] = (keys[order], np.repeat(members, HASHES)[order])

    def candidates(self, hashes: np.ndarray) -> set[int]:
        found = owners(*self.short, np.unique(hashes[self.short_marked[(hashes & _LOW).astype(np.int32)]]))
        if not self.limits:
            return found
        cuts = np.arange(0, len(hashes), BLOCK)
        minima = np.stack([np.minimum.reduceat(hashes * f, cuts) for f in _FACTORS])
        # A window's minimum is that of one of its blocks: without a block that has
        # a minimum of an item, by its low bits, no window need be looked at.
        if not self.marked[(minima & _LOW).astype(np.int32)].any():
            return found
        for limit, (keys, owner) in self.limits.items():
            seen = window_minima(minima, limit)
            which = np.nonzero(self.marked[(seen & _LOW).astype(np.int32)])
            found |= owners(keys, owner, np.unique(mix(seen[which] ^ _FACTORS[which[0]])))
        return found

    def matches(self, text: bytes) -> list[tuple[int, float]]:
        """(item, containment) of the block's items that the text contains."""
        hashes = shingles(text)
        if not len(hashes):
            return []
        held = None
        out = []
        for i in sorted(self.candidates(hashes)):
            held = np.unique(hashes) if held is None else held
            share = np.count_nonzero(np.isin(self.sets[i], held, assume_unique=True)) / len(self.sets[i])
            if share >= self.percent:
                out.append((i, float(share)))
        return out


def item_blocks(items: DataFrame, size: int = ITEM_BLOCK) -> Iterator[tuple[list, list[bytes]]]:
    """(item ids, texts) in blocks; one block is held at a time."""
    ids, held = [], []
    for r in items.select("item_id", "text").orderBy("item_id", "text").toLocalIterator():
        ids.append(r["item_id"])
        held.append((r["text"] or "").encode("utf-8", "surrogatepass"))
        if len(ids) == size:
            yield ids, held
            ids, held = [], []
    if ids:
        yield ids, held


def leaks(docs: DataFrame, items: DataFrame, contained: float = CONTAINED, block: int = ITEM_BLOCK) -> DataFrame:
    """(doc_id, item_id, containment) of all documents that contain an item."""
    spark = docs.sparkSession
    schema = T.StructType([T.StructField("doc_id", T.LongType()), items.schema["item_id"], T.StructField("containment", T.DoubleType())])
    out = spark.createDataFrame([], schema)
    for ids, held in item_blocks(items, block):
        shared = spark.sparkContext.broadcast((ids, Items(held, contained)))  # ITEM_BLOCK items at most

        def run(batches, shared=shared):
            names, tables = shared.value
            for b in text_batches(batches):
                rows = [(d, names[i], c) for d, t in zip(b.column("doc_id").to_pylist(), texts(b)) for i, c in tables.matches(t)]
                cols = list(zip(*rows)) or [()] * 3
                yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int64()), pa.array(cols[1], pa_id), pa.array(cols[2], pa.float64())],
                                                 names=["doc_id", "item_id", "containment"])
        pa_id = pa.string() if isinstance(items.schema["item_id"].dataType, T.StringType) else \
            pa.int32() if isinstance(items.schema["item_id"].dataType, T.IntegerType) else pa.int64()
        out = out.unionByName(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(released(run), schema))
    return out


def without_leaks(docs: DataFrame, items: DataFrame, contained: float = CONTAINED, block: int = ITEM_BLOCK) -> DataFrame:
    """``docs``, all columns, without the documents that contain an item; map-only."""
    for _, held in item_blocks(items, block):
        shared = docs.sparkSession.sparkContext.broadcast(Items(held, contained))

        @F.arrow_udf("boolean")
        def clean(text: pa.Array) -> pa.Array:
            out = pa.array([not shared.value.matches(t or b"") for t in text.cast(pa.binary()).to_pylist()], pa.bool_())  # noqa: B023
            release_memory()
            return out
        docs = docs.filter(clean(F.col("text")))
    return docs


def op3_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents against all benchmark items."""
    return leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
