"""Token-id files compressed by Re-Pair grammars.

Documents are encoded, ended by id 0 and laid out in ascending doc_id order:
ranges of doc_id are shards, and a shard is a run of blocks of whole documents.
In each block frequent neighbouring ids are replaced by new symbols, round
after round; the block stores its rules, the length each rule expands to and
the expanded position of every 1024th symbol, so any stretch of ids is decoded
without the rest. Counting in a round goes by hashed pairs first and exactly
for the fullest cells; several pairs are replaced in one round.

A block is one row of a Parquet table: place, document index and grammar.

Edge cases: NULL or empty texts hold the end id only; NULL doc_ids come first;
rows with equal doc_id follow each other in text order; a document longer than
a block is a block of its own; an empty table gives no rows; further columns
are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidewater.llm.bpe import encoded
from tidewater.llm.common import released, stored, table

VOCABULARY = "byte_bpe_50k.json"
END_ID = 0
BLOCK_IDS = 1_000_000
ROUNDS = 4
PAIRS_PER_ROUND = 1024
MIN_COUNT = 16
STEP = 1024
_CELLS = 18
_MAGIC = np.frombuffer(b"RPG1", "<u4")[0]
BLOCK_DDL = ("shard int, block int, first_id long, n_ids long, doc_ids array<long>, doc_lengths array<int>, "
             "grammar binary")


def cells(keys: np.ndarray) -> np.ndarray:
    return ((keys * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - _CELLS)).view(np.int64)


def hashed_pairs(seq: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Key (left << 32 | right) and hash cell of each neighbouring pair."""
    keys = (seq[:-1].astype(np.uint64) << np.uint64(32)) | seq[1:]
    return keys, cells(keys)


def frequent_pairs(keys: np.ndarray, cell: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Keys of frequent neighbouring pairs, the most frequent one of each of the fullest
    cells, and the places of all pairs in those cells. Only values are sorted, which
    is many times as fast as sorting places; a pair's cell follows from its key."""
    counts = np.bincount(cell, minlength=1 << _CELLS)
    fullest = np.argpartition(counts, -PAIRS_PER_ROUND)[-PAIRS_PER_ROUND:]
    chosen = np.zeros(1 << _CELLS, bool)
    chosen[fullest[counts[fullest] >= MIN_COUNT]] = True
    inside = np.flatnonzero(chosen[cell])
    pairs, n = np.unique(keys[inside], return_counts=True)
    pairs, n = pairs[n >= MIN_COUNT], n[n >= MIN_COUNT]
    pairs = pairs[np.lexsort((pairs, -n))]
    _, best = np.unique(cells(pairs), return_index=True)
    return pairs[np.sort(best)], inside


def replace_pairs(seq: np.ndarray, keys: np.ndarray, cell: np.ndarray, pairs: np.ndarray, inside: np.ndarray,
                  first_symbol: int) -> np.ndarray:
    """``seq`` with each pair (one a cell) replaced by its symbol, leftmost first where pairs
    overlap; ``inside`` are the places, ascending, among which all of them are."""
    number = np.full(1 << _CELLS, -1, np.int32)
    number[cells(pairs)] = np.arange(len(pairs), dtype=np.int32)
    rank = number[cell[inside]]
    hit = (rank >= 0) & (pairs[rank] == keys[inside])
    hits, rank = inside[hit], rank[hit]
    # In a run of overlapping hits every second one counts, from the first on.
    starts = np.flatnonzero(np.diff(hits, prepend=-2) != 1)
    in_run = np.arange(len(hits)) - np.repeat(starts, np.diff(np.append(starts, len(hits))))
    hits, rank = hits[in_run % 2 == 0], rank[in_run % 2 == 0]
    out = seq.copy()
    out[hits] = first_symbol + rank.astype(np.uint32)
    keep = np.ones(len(seq), bool)
    keep[hits + 1] = False
    return out[keep]


def compress(ids: np.ndarray) -> bytes:
    """The grammar of a block."""
    seq = ids.astype(np.uint32)
    base = int(seq.max()) + 1 if len(seq) else 0
    rules = np.empty((0, 2), np.uint32)
    for _ in range(ROUNDS):
        if len(seq) < 2:
            break
        keys, cell = hashed_pairs(seq)
        pairs, inside = frequent_pairs(keys, cell)
        if not len(pairs):
            break
        seq = replace_pairs(seq, keys, cell, pairs, inside, base + len(rules))
        rules = np.concatenate([rules, np.stack([pairs >> np.uint64(32), pairs & np.uint64(0xFFFFFFFF)], 1)
                                .astype(np.uint32)])
    lengths = rule_lengths(rules, base)
    at = np.cumsum(symbol_lengths(seq, lengths, base))
    marks = np.append(0, at)[:-1][::STEP] if len(seq) else np.empty(0)
    width = 2 if base + len(rules) <= 65536 else 4
    head = np.array([_MAGIC, base, len(rules), len(seq), len(marks), width], "<u4")
    return b"".join([head.tobytes(), rules.astype("<u4").tobytes(), lengths.astype("<u4").tobytes(),
                     marks.astype("<u4").tobytes(), seq.astype(f"<u{width}").tobytes()])


def rule_lengths(rules: np.ndarray, base: int) -> np.ndarray:
    """How many ids each rule expands to; a rule uses earlier rules only."""
    out: list[int] = []
    for left, right in rules.tolist():
        out.append((1 if left < base else out[left - base]) + (1 if right < base else out[right - base]))
    return np.array(out, np.int64)


def symbol_lengths(seq: np.ndarray, lengths: np.ndarray, base: int) -> np.ndarray:
    n = np.ones(len(seq), np.int64)
    new = seq >= base
    n[new] = lengths[seq[new].astype(np.int64) - base]
    return n


class Grammar:
    """Reader of one block."""

    def __init__(self, data: bytes):
        magic, self.base, n_rules, n_seq, n_marks, width = np.frombuffer(data, "<u4", 6).tolist()
        if magic != _MAGIC:
            raise ValueError("not a grammar block")
        at = 24
        self.rules = np.frombuffer(data, "<u4", 2 * n_rules, at).reshape(-1, 2)
        at += 8 * n_rules
        self.lengths = np.frombuffer(data, "<u4", n_rules, at).astype(np.int64)
        at += 4 * n_rules
        self.marks = np.frombuffer(data, "<u4", n_marks, at).astype(np.int64)
        at += 4 * n_marks
        self.seq = np.frombuffer(data, f"<u{width}", n_seq, at)
        self._flat = None

    def _tables(self):
        """Expansions of all symbols that the rules use, in one array: ids below
        ``base`` stand at their own place, rules after them."""
        if self._flat is None:
            parts: list[list[int]] = []
            for left, right in self.rules.tolist():
                parts.append((parts[left - self.base] if left >= self.base else [left])
                             + (parts[right - self.base] if right >= self.base else [right]))
            rules = np.array([i for p in parts for i in p], np.uint32)
            self._flat = np.concatenate([np.arange(self.base, dtype=np.uint32), rules])
            self._starts = np.concatenate([np.arange(self.base), self.base + np.cumsum(self.lengths) - self.lengths])
        return self._flat, self._starts

    def expand(self, symbols: np.ndarray) -> np.ndarray:
        flat, starts = self._tables()
        n = symbol_lengths(symbols, self.lengths, self.base)
        upto = np.cumsum(n)
        total = int(upto[-1]) if len(upto) else 0
        return flat[np.arange(total) + np.repeat(starts[symbols.astype(np.int64)] - upto + n, n)]

    def ids(self, start: int = 0, stop: int | None = None) -> np.ndarray:
        """Ids start to stop - 1; only the symbols that cover them are expanded."""
        if stop is None:
            return self.expand(self.seq)[start:]
        if stop <= start or not len(self.marks):
            return np.empty(0, np.uint32)
        first = int(np.searchsorted(self.marks, start, "right")) - 1
        last = int(np.searchsorted(self.marks, stop, "left"))
        got = self.expand(self.seq[first * STEP:last * STEP])
        return got[start - int(self.marks[first]):stop - int(self.marks[first])]


def _blocks(batches: Iterator[pa.RecordBatch], path: str, block_ids: int) -> Iterator[pa.RecordBatch]:
    shard, block, first = TaskContext.get().partitionId(), 0, 0
    doc_ids, ids, n = [], [], 0

    def flush():
        whole = np.concatenate(ids)
        return pa.RecordBatch.from_arrays(
            [pa.array([shard], pa.int32()), pa.array([block], pa.int32()), pa.array([first], pa.int64()),
             pa.array([len(whole)], pa.int64()), pa.array([doc_ids], pa.list_(pa.int64())),
             pa.array([list(map(len, ids))], pa.list_(pa.int32())), pa.array([compress(whole)], pa.binary())],
            names=[c.split()[0] for c in BLOCK_DDL.split(", ")])
    end = np.array([END_ID], np.uint32)
    for b, batch in encoded(batches, path):
        for d, x in zip(b.column("doc_id").to_pylist(), batch):
            if n and n + len(x) + 1 > block_ids:
                yield flush()
                block, first, doc_ids, ids, n = block + 1, first + n, [], [], 0
            doc_ids.append(d)
            ids.append(np.append(x, end))
            n += len(x) + 1
    if n:
        yield flush()


def write_ids(docs: DataFrame, path: str, block_ids: int = BLOCK_IDS) -> DataFrame:
    """Blocks of all documents (doc_id, text), written and read as a table."""
    ranged = docs.select("doc_id", "text").repartitionByRange(F.col("doc_id"), F.xxhash64("text"))
    ordered = ranged.sortWithinPartitions(F.col("doc_id"), F.xxhash64("text"))
    return stored(docs.sparkSession, ordered.mapInArrow(released(lambda b: _blocks(b, path, block_ids)), BLOCK_DDL), "id-blocks")


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for i in range(b.num_rows):
            r = {n: b.column(n)[i] for n in b.schema.names}
            ids = Grammar(r["grammar"].as_py()).ids()
            data = memoryview(ids.astype("<u4").tobytes())
            lengths = np.array(r["doc_lengths"].as_py(), np.int64)
            ends = np.cumsum(lengths)
            starts = (ends - lengths) + r["start"].as_py()
            crc = [zlib.crc32(data[4 * (e - n):4 * e]) for e, n in zip(ends.tolist(), lengths.tolist())]
            yield pa.RecordBatch.from_arrays([r["doc_ids"].values, pa.array(starts), pa.array(lengths), pa.array(crc, pa.int64())],
                                             names=["doc_id", "start", "n_tokens", "ids_crc32"])


def placed_blocks(blocks: DataFrame) -> DataFrame:
    """Blocks with ``start``, the ids of all documents before them. The window
    runs over one row per shard, as many as the shuffle has partitions."""
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    shards = blocks.groupBy("shard").agg(F.sum("n_ids").alias("n")).select(
        "shard", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    return blocks.join(F.broadcast(shards), "shard").withColumn("start", F.col("before") + F.col("first_id"))


def op7_repair_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Encodes all documents, writes their ids in grammar blocks and reads them back."""
    blocks = write_ids(table(spark, sf_dir, "documents"), public_tokenizers.path(VOCABULARY))
    return placed_blocks(blocks).select("start", "doc_ids", "doc_lengths", "grammar").mapInArrow(
        released(_read), "doc_id long, start long, n_tokens long, ids_crc32 long")
