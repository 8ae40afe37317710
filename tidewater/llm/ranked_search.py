"""Ranked lexical search: the documents that score highest for each item.

Bag deduplication. One pass over the texts restricts every document to the
items' vocabulary: its length n and, per vocabulary term, how often it occurs
(tf). A document's bag is that tf vector with its length measure m. Documents
of one bag score alike for every item, so bags are hashed, rows of one hash are
told apart by the whole vector and m (``classes``), and each class is scored
once. A class keeps the doc_ids of its first ``k`` members in ascending order:
an item's best k documents lie in its best k classes, taken by score and then
by smallest doc_id, and no class adds more than its first k members.

Scoring runs over the written classes, spread over the tasks; a task keeps the
best k classes of each item, so k rows per item and task are ranked in the end.
Frequent terms do not multiply rows, as no pairs of item and document are made.

Sizes. The vocabulary goes to the tasks as a lookup table up to VOCABULARY
terms; a larger one is joined with the documents' terms by a shuffle. Items are
scored ITEM_BLOCK at a time against the classes (the texts are read once).

Edge cases: a document or item with NULL text or without terms matches nothing;
documents without terms do not count; rows of one item_id (NULL too) are one
item with all their terms; repeated documents are ranked one by one, in
ascending doc_id, NULL last; tables without rows give no rows; further columns
are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidewater.llm.common import released, stored, table, text_batches, texts

#: Documents per item.
TOP = 10
#: Share, in percent, of a document's length in the length measure.
LENGTH_SHARE = 90
#: Terms up to which the vocabulary is a lookup table in each task.
VOCABULARY = 500_000
#: Items scored in one pass over the classes.
ITEM_BLOCK = 4096
#: Cells of the score table of a task: items of a block x classes at a time.
CELLS = 2_000_000
BAG = "doc_id long, n long, terms array<long>, tfs array<long>"
# ASCII bytes other than digits and letters separate terms; A-Z are lowered.
_LOWER = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or chr(c).isalnum() else 32 for c in range(256))


def term_list(text: bytes) -> list[bytes]:
    """The terms of a UTF-8 text in order: runs of ASCII digits and letters and of
    all characters from U+0080 on."""
    return text.translate(_LOWER).split()


def _terms_of(batches: Iterator[pa.RecordBatch], keep) -> Iterator[pa.RecordBatch]:
    """(doc_id, n, kept distinct terms, their counts) of each text with terms."""
    for b in text_batches(batches):
        ids, ns, kept = [], [], []
        for d, t in zip(b.column(0).to_pylist(), texts(b)):
            words = term_list(t)
            if words:
                ids.append(d)
                ns.append(len(words))
                kept.append(keep(Counter(words)))
        ends = pa.array(np.cumsum([0, *map(len, kept)]), pa.int32())
        terms = [t for row in kept for t, _ in row]
        yield pa.RecordBatch.from_arrays(
            [pa.array(ids, pa.int64()), pa.array(ns, pa.int64()),
             pa.ListArray.from_arrays(ends, pa.array(terms, pa.binary() if terms and isinstance(terms[0], bytes) else pa.int64())),
             pa.ListArray.from_arrays(ends, pa.array([c for row in kept for _, c in row], pa.int64()))],
            names=["doc_id", "n", "terms", "tfs"])


def item_terms(items: DataFrame) -> DataFrame:
    """Distinct (item_id, term)."""
    def run(batches):
        for b in _terms_of(batches, lambda c: list(c.items())):
            if b.num_rows:
                of = pa.array(np.repeat(np.arange(b.num_rows), np.diff(b.column("terms").offsets)))
                yield pa.RecordBatch.from_arrays([b.column(0).take(of), b.column("terms").flatten()], names=["item_id", "term"])
    found = items.select("item_id", "text").mapInArrow(released(run), "item_id long, term binary")
    return found.distinct()


def bags(docs: DataFrame, vocabulary: DataFrame, lookup_terms: int | None = None) -> DataFrame:
    """Each document with terms: n, ids of its vocabulary terms in ascending order and
    their counts. ``vocabulary`` is (term, term_id)."""
    most = VOCABULARY if lookup_terms is None else lookup_terms
    texts_of = docs.select("doc_id", "text")
    rows = vocabulary.limit(most + 1).collect()  # at most ``most`` + 1 terms
    if len(rows) <= most:
        shared = docs.sparkSession.sparkContext.broadcast({bytes(r["term"]): r["term_id"] for r in rows})

        def run(batches):
            ids = shared.value
            return _terms_of(batches, lambda c: sorted((ids[t], c[t]) for t in c.keys() & ids.keys()))
        return texts_of.mapInArrow(released(run), BAG)
    del rows
    spread = texts_of.mapInArrow(released(lambda batches: _terms_of(batches, lambda c: list(c.items()))),
                                 "doc_id long, n long, terms array<binary>, tfs array<long>")
    # A row's place tells apart rows of one doc_id; it must not change between passes, hence the written table.
    rows_of = stored(docs.sparkSession, spread.withColumn("row", F.monotonically_increasing_id()), "search_terms")
    found = (rows_of.select("row", F.explode(F.arrays_zip("terms", "tfs")).alias("t"))
             .select("row", F.col("t.terms").alias("term"), F.col("t.tfs").alias("tf"))
             .join(vocabulary, "term")
             .groupBy("row").agg(F.sort_array(F.collect_list(F.struct("term_id", "tf"))).alias("bag")))
    return (rows_of.select("row", "doc_id", "n").join(found, "row", "left")
            .select("doc_id", "n", F.coalesce(F.col("bag.term_id"), F.array()).cast("array<long>").alias("terms"),
                    F.coalesce(F.col("bag.tf"), F.array()).cast("array<long>").alias("tfs")))


def classes(bagged: DataFrame, k: int) -> DataFrame:
    """Documents of one tf vector and m as one row with the doc_ids of the first ``k``
    of them, ascending. The hash comes first in sorting, the whole key decides."""
    key = ["bag", "m", "terms", "tfs"]
    place = Window.partitionBy(*key).orderBy(F.col("doc_id").asc_nulls_last())
    first = (bagged.filter(F.size("terms") > 0).withColumn("bag", F.xxhash64("terms", "tfs", "m"))
             .withColumn("place", F.row_number().over(place)).filter(F.col("place") <= k))
    members = F.sort_array(F.collect_list(F.struct("place", "doc_id")))
    return first.groupBy(*key).agg(members["doc_id"].alias("doc_ids")).select("m", "terms", "tfs", "doc_ids")


class Items:
    """A block of items: for each term id the items that hold it and its weight."""

    def __init__(self, rows: list):
        self.ids = [r["item_id"] for r in rows]
        lengths = [len(r["terms"]) for r in rows]
        terms = np.array([t for r in rows for t in r["terms"]], np.int64)
        order = np.argsort(terms, kind="stable")
        self.terms, self.starts = np.unique(terms[order], return_index=True)
        self.starts = np.append(self.starts, len(terms))
        self.item = np.repeat(np.arange(len(rows)), lengths)[order]
        self.weight = np.array([w for r in rows for w in r["weights"]], np.int64)[order]

    def scores(self, m: np.ndarray, sizes: np.ndarray, terms: np.ndarray, tfs: np.ndarray) -> np.ndarray:
        """Items x classes; the classes' terms and counts come one after another."""
        out = np.zeros(len(self.ids) * len(m), np.int64)
        if not len(self.terms):
            return out.reshape(len(self.ids), -1)
        at = np.minimum(np.searchsorted(self.terms, terms), len(self.terms) - 1)
        hit = np.flatnonzero(self.terms[at] == terms)
        at, tf, of = at[hit], tfs[hit], np.repeat(np.arange(len(m)), sizes)[hit]
        part = 1_000_000_000 * tf // (1000 * tf + 8 * m[of])
        counts = self.starts[at + 1] - self.starts[at]
        upto = np.cumsum(counts)
        begin = 0
        while begin < len(at):  # some CELLS additions at a time
            end = max(begin + 1, int(np.searchsorted(upto, (upto[begin - 1] if begin else 0) + CELLS)))
            n = counts[begin:end]
            post = np.arange(n.sum()) + np.repeat(self.starts[at[begin:end]] - (np.cumsum(n) - n), n)
            np.add.at(out, self.item[post] * len(m) + np.repeat(of[begin:end], n), self.weight[post] * np.repeat(part[begin:end], n))
            begin = end
        return out.reshape(len(self.ids), -1)


class Best:
    """The best k classes of each item so far: by score, then by the first doc_id."""

    def __init__(self, items: int, k: int):
        self.k = k
        self.least = np.ones(items, np.int64)
        self.item, self.score, self.first = (np.empty(0, np.int64) for _ in range(3))
        self.docs = np.empty(0, object)

    def add(self, scores: np.ndarray, docs: pa.ListArray) -> None:
        if scores.shape[1] > self.k:
            self.least = np.maximum(self.least, np.partition(scores, -self.k, axis=1)[:, -self.k])
        item, at = np.nonzero(scores >= self.least[:, None])
        if not len(item):
            return
        used, at = np.unique(at, return_inverse=True)
        lists = docs.take(pa.array(used)).to_pylist()
        held = np.empty(len(lists), object)
        held[:] = lists
        # The largest long stands for a NULL doc_id, which no smaller one follows in its class.
        first = np.array([2**63 - 1 if d[0] is None else d[0] for d in lists], np.int64)
        item, score = np.append(self.item, item), np.append(self.score, scores[item, used[at]])
        first, held = np.append(self.first, first[at]), np.append(self.docs, held[at])
        order = np.lexsort((first, -score, item))
        item = item[order]
        place = np.arange(len(item)) - np.searchsorted(item, item)
        keep = order[place < self.k]
        full = order[place == self.k - 1]
        self.item, self.score, self.first, self.docs = np.sort(item[place < self.k]), score[keep], first[keep], held[keep]
        np.maximum.at(self.least, item[place == self.k - 1], score[full])


def best_classes(of: DataFrame, items: list, k: int) -> DataFrame:
    """(item_id, score, doc_ids) of the best ``k`` classes of each item in each task."""
    shared = of.sparkSession.sparkContext.broadcast(Items(items))  # ITEM_BLOCK items or so

    def run(batches):
        held = shared.value
        best = Best(len(held.ids), k)
        step = max(1, CELLS // max(len(held.ids), 1))
        for whole in batches:
            for i in range(0, whole.num_rows, step):
                b = whole.slice(i, step)
                terms, tfs = b.column("terms"), b.column("tfs")
                sizes = np.diff(terms.offsets.to_numpy())
                best.add(held.scores(b.column("m").to_numpy(), sizes, terms.flatten().to_numpy(), tfs.flatten().to_numpy()),
                         b.column("doc_ids"))
        yield pa.RecordBatch.from_arrays(
            [pa.array([held.ids[i] for i in best.item], pa.int64()), pa.array(best.score), pa.array(list(best.docs), pa.list_(pa.int64()))],
            names=["item_id", "score", "doc_ids"])
    return of.mapInArrow(released(run), "item_id long, score long, doc_ids array<long>")


def search(docs: DataFrame, items: DataFrame, k: int = TOP, lookup_terms: int | None = None, item_block: int = ITEM_BLOCK) -> DataFrame:
    """(item_id, rank, doc_id, score) of the ``k`` best documents (doc_id, text) of each
    item (item_id, text): score above 0, highest first, equal ones by doc_id."""
    spark = docs.sparkSession
    wanted = stored(spark, item_terms(items.select(F.col("item_id").cast("long").alias("item_id"), "text")), "search_items")
    vocabulary = stored(spark, wanted.select("term").distinct().withColumn("term_id", F.monotonically_increasing_id()), "search_vocabulary")
    held = stored(spark, bags(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), vocabulary, lookup_terms), "search_bags")
    total = held.agg(F.count("*").alias("docs"), F.coalesce(F.sum("n"), F.lit(0)).alias("terms")).first()
    # 38 digits: 90 * n * N passes 64 bits for a document of 10^8 terms among 10^9.
    m = F.expr(f"{100 - LENGTH_SHARE} + cast({LENGTH_SHARE} * n as decimal(19,0)) * cast({total['docs']} as decimal(19,0)) "
               f"div cast({max(total['terms'], 1)} as decimal(19,0))")
    found = stored(spark, classes(held.select("doc_id", m.cast("long").alias("m"), "terms", "tfs"), k), "search_classes")
    holding = held.select(F.explode("terms").alias("term_id")).groupBy("term_id").agg(F.count("*").alias("df"))
    weight = F.floor(1000 * F.log((2 * F.lit(total["docs"]) + 2) / (2 * F.col("df") + 1)))
    weighted = stored(spark, wanted.join(vocabulary, "term").join(holding, "term_id").groupBy("item_id").agg(
        F.collect_list("term_id").alias("terms"), F.collect_list(weight).alias("weights")), "search_weights")
    blocks = max(1, -(-weighted.count() // item_block))
    in_block = F.pmod(F.xxhash64("item_id"), F.lit(blocks))
    parts = [best_classes(found, weighted.filter(in_block == b).collect(), k) for b in range(blocks)]
    ranked = reduce(DataFrame.unionByName, parts).select("item_id", "score", F.explode("doc_ids").alias("doc_id"))
    order = Window.partitionBy("item_id").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    return (ranked.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
            .select("item_id", "rank", "doc_id", "score"))


def op13_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


# The terms' pattern and the letters lowered are fixed values of the contract.
ORACLE_SQL = """
WITH lowered AS (
  SELECT doc_id, translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents),
words AS (
  SELECT row_number() OVER () AS r, doc_id,
         regexp_extract_all(text, '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS w
  FROM lowered WHERE text IS NOT NULL),
docs AS (SELECT r, doc_id, w, len(w)::BIGINT AS n FROM words WHERE len(w) > 0),
total AS (SELECT count(*)::BIGINT AS nn, sum(n)::BIGINT AS l FROM docs),
items AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(
           translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term
  FROM benchmark WHERE text IS NOT NULL),
tf AS (
  SELECT r, term, count(*)::BIGINT AS tf FROM (SELECT r, unnest(w) AS term FROM docs)
  WHERE term IN (SELECT term FROM items) GROUP BY r, term),
weights AS (
  SELECT term, floor(1000 * ln((2 * nn + 2) / (2 * count(*) + 1)::DOUBLE))::BIGINT AS weight
  FROM tf, total GROUP BY term, nn),
scored AS (
  SELECT i.item_id, d.r, d.doc_id,
         sum(weight * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * nn) // l))))::BIGINT AS score
  FROM tf JOIN items i USING (term) JOIN weights USING (term) JOIN docs d USING (r), total
  GROUP BY i.item_id, d.r, d.doc_id),
ranked AS (
  SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id ASC NULLS LAST) AS rank, doc_id, score
  FROM scored WHERE score > 0)
SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM ranked WHERE rank <= 10
"""
