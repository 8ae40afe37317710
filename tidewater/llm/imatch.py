"""I-Match fingerprints over randomised lexicon subsets.

Terms are lower-cased words without ASCII punctuation. A first pass counts the
documents of each term in a table of fixed size (terms by hash); the lexicon is
the cells within a band of document frequency. A fingerprint has one hash per
lexicon subset: the sorted distinct terms of the document that lie in the
lexicon and in the subset. Subsets keep a term with one of several chances, so
short and long documents both have subsets of a few terms. The likeness of two
fingerprints is the share of equal hashes among the subsets that hold a term of
either document.

Edge cases: NULL or empty texts have no terms and an empty fingerprint (like
another empty one: 1, any other: 0); a document without a term in the band uses
all its terms; equal texts have equal fingerprints; a single document follows
itself; rows of equal doc_id follow each other in text order and a NULL doc_id
comes last; an empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.llm.common import mix, released, table, terms, text_batches, texts, word_hashes
from tidewater.llm.neighbours import with_following_head
from tidewater.llm.sketch import corpus_counts

#: Cells of the document-frequency table.
CELLS = 1 << 20
#: The band: shares of all documents, and documents at least.
LEAST_SHARE, MOST_SHARE, LEAST_DOCUMENTS = 0.001, 0.05, 2
#: Chances that a subset keeps a term, and subsets for each.
CHANCES = (1 / 2, 1 / 8, 1 / 32, 1 / 128, 1 / 512)
PER_CHANCE = 8
HASH_BYTES = 4
_EMPTY = "-" * (2 * HASH_BYTES)
_LIMITS = np.array([c * 2.0**64 for c in CHANCES for _ in range(PER_CHANCE)]).astype(np.uint64)
_SALTS = mix(np.arange(1, len(_LIMITS) + 1, dtype=np.uint64), 77)


def term_set(text: bytes) -> np.ndarray:
    """Sorted distinct term hashes."""
    return np.unique(word_hashes(terms(text)))


def _cells(t: np.ndarray) -> np.ndarray:
    return (t & np.uint64(CELLS - 1)).astype(np.int64)


def lexicon(docs: DataFrame) -> np.ndarray:
    """Which cells lie in the band, from all documents."""
    def cells(batch: pa.RecordBatch) -> Iterator[np.ndarray]:
        for part in text_batches(iter([batch])):
            found = [np.unique(_cells(term_set(t))) for t in texts(part)]
            yield np.concatenate(found) if found else np.empty(0, np.int64)
    counts = corpus_counts(docs.select("text"), cells, CELLS)
    n = docs.filter("text IS NOT NULL").count()
    return (counts >= max(LEAST_DOCUMENTS, LEAST_SHARE * n)) & (counts <= max(LEAST_DOCUMENTS, MOST_SHARE * n))


def fingerprint(text: bytes, band: np.ndarray) -> tuple[str, ...]:
    """One hash per lexicon subset, or a mark for a subset without a term."""
    found = term_set(text)
    inside = found[band[_cells(found)]]
    inside = inside if len(inside) else found
    if not len(inside):
        return (_EMPTY,) * len(_LIMITS)
    taken = mix(inside[None, :] ^ _SALTS[:, None]) < _LIMITS[:, None]
    return tuple(hashlib.blake2b(inside[row].tobytes(), digest_size=HASH_BYTES).hexdigest() if some else _EMPTY
                 for row, some in zip(taken, taken.any(1).tolist()))


def likeness(x: tuple[str, ...], y: tuple[str, ...]) -> float:
    used = [(a, b) for a, b in zip(x, y) if a != _EMPTY or b != _EMPTY]
    return sum(a == b for a, b in used) / len(used) if used else 1.0


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id and fingerprint of every document."""
    shared = docs.sparkSession.sparkContext.broadcast(np.packbits(lexicon(docs)))  # CELLS / 8 bytes

    def run(batches):
        band = np.unpackbits(shared.value).astype(bool)
        for b in text_batches(batches):
            prints = ["".join(fingerprint(t, band)) for t in texts(b)]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(prints, pa.string())], names=["doc_id", "fingerprint"])
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(released(run), "doc_id long, fingerprint string")


def edited_text(text: str, following: str) -> str:
    half = len(text) // 2
    return text[:len(text) - half] + following[:half]


def op5_imatch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of all documents and of their edited texts."""
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    shared = spark.sparkContext.broadcast(np.packbits(lexicon(docs)))  # CELLS / 8 bytes

    def run(batches):
        band = np.unpackbits(shared.value).astype(bool)
        held = None  # the row that waits for the one after it

        def result(row, after):
            doc_id, text, own = row
            new = edited_text(text, after[1]).encode("utf-8", "surrogatepass")
            changed = fingerprint(new, band)
            return (doc_id, len(text), hashlib.sha256(new).hexdigest(), "".join(own), "".join(changed),
                    likeness(own, changed), likeness(own, after[2]))
        current = None
        for b in text_batches(batches):
            out = []
            for doc_id, text, at, is_copy in zip(*(b.column(n).to_pylist() for n in ("doc_id", "text", "range", "is_copy"))):
                if at != current:
                    current, held = at, None
                elif held is None:
                    continue  # a further copy of a tied head
                row = (doc_id, text, fingerprint(text.encode("utf-8", "surrogatepass"), band))
                if held is not None:
                    out.append(result(held, row))
                held = None if is_copy else row
            cols = list(zip(*out)) or [()] * 7
            types = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)],
                                             names=["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint",
                                                    "near_edited", "near_next"])
    return with_following_head(docs, "doc_id", "text").mapInArrow(
        released(run), "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
             "near_edited double, near_next double")
