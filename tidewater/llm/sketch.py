"""Fixed-size count tables over a whole corpus.

A table has a fixed number of cells whatever the input's size; every key adds
to the cell its hash names, so a cell counts its keys together. Tables are
summed per task, then across tasks piece by piece. What comes to the driver
and goes to the tasks has that fixed size.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.llm.common import released

PIECE = 4096


def corpus_counts(rows: DataFrame, cells_of: Callable[[pa.RecordBatch], Iterator[np.ndarray]], cells: int) -> np.ndarray:
    """Counts per cell over all rows; ``cells_of`` yields arrays of cell numbers."""
    def local(batches):
        counts = np.zeros(cells, np.int64)
        for b in batches:
            for c in cells_of(b):
                counts += np.bincount(c, minlength=cells)
        for piece in range(0, cells, PIECE):
            part = counts[piece:piece + PIECE]
            if part.any():
                small = part.astype(np.int32) if part.max() < 2**31 else part
                yield pa.RecordBatch.from_arrays([pa.array([piece // PIECE], pa.int32()), pa.array([small.tobytes()], pa.binary())],
                                                 names=["piece", "counts"])

    def summed(batches):
        sums: dict[int, np.ndarray] = {}
        for b in batches:
            for piece, data in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                width = len(data) // min(PIECE, cells)
                part = np.frombuffer(data, np.int32 if width == 4 else np.int64)
                sums[piece] = sums.get(piece, 0) + part.astype(np.int64)
        if sums:
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(sums), pa.int32()), pa.array([s.tobytes() for s in sums.values()], pa.binary())],
                names=["piece", "counts"])
    pieces = rows.mapInArrow(released(local), "piece int, counts binary").repartition(F.col("piece")) \
        .mapInArrow(released(summed), "piece int, counts binary")
    out = np.zeros(cells, np.int64)
    for r in pieces.collect():  # cells / PIECE rows, whatever the input
        out[r["piece"] * PIECE:(r["piece"] + 1) * PIECE] = np.frombuffer(r["counts"], np.int64)
    return out


def corpus_bits(hashes: DataFrame, bits: int) -> np.ndarray:
    """A bitmap of fixed size with the bit of every hash (one long column) set."""
    column = hashes.columns[0]
    size = bits // 8
    piece = min(PIECE * 8, size)

    def local(batches):
        flags = np.zeros(bits, bool)
        for b in batches:
            flags[(b.column(0).to_numpy().view(np.uint64) & np.uint64(bits - 1)).astype(np.int64)] = True
        packed = np.packbits(flags, bitorder="little")
        for i in range(0, size, piece):
            if packed[i:i + piece].any():
                yield pa.RecordBatch.from_arrays([pa.array([i // piece], pa.int32()), pa.array([packed[i:i + piece].tobytes()], pa.binary())],
                                                 names=["piece", "bits"])

    def merged(batches):
        sums: dict[int, np.ndarray] = {}
        for b in batches:
            for i, data in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                part = np.frombuffer(data, np.uint8)
                sums[i] = sums[i] | part if i in sums else part
        if sums:
            yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()), pa.array([s.tobytes() for s in sums.values()], pa.binary())],
                                             names=["piece", "bits"])
    out = np.zeros(size, np.uint8)
    for r in hashes.select(column).mapInArrow(released(local), "piece int, bits binary").repartition(F.col("piece")) \
            .mapInArrow(released(merged), "piece int, bits binary").collect():  # size / piece rows
        out[r["piece"] * piece:(r["piece"] + 1) * piece] = np.frombuffer(r["bits"], np.uint8)
    return out


def in_bits(hashes: np.ndarray, packed: np.ndarray) -> np.ndarray:
    """Whether each hash's bit is set."""
    at = (hashes & np.uint64(len(packed) * 8 - 1)).astype(np.int64)
    return (packed[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1
