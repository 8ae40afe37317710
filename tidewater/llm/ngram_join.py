"""N-gram Jaccard self-join by grouped prefixes.

A document's set holds its distinct k-word shingles. Sets are ordered by how
full their cell of a corpus-wide count table is, then by hash, so shingles of
common passages come last; two sets of similarity t share a shingle among the
first n - ceil(t n) + 1. Equal sets form a class; classes of equal size with
equal prefixes form a group, and only groups are listed under their prefix
shingles. Pairs out of the lists pass a size test and a bitmap bound of the
overlap, then exact verification on the whole sets.

Only connectivity is asked for, so pairs are drawn in steps: each list's
members against one pivot (twice, with another pivot), then all pairs of
members that are still in different components. A large group of near copies
thus costs about one pair a member, and no link between components is missed.

Edge cases: NULL or wordless texts have the empty set and link with nothing;
fewer than k words make one shingle; copies share a class; a NULL doc_id takes
part and never names a component unless all its documents are NULL; repeated
rows stay; an empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidewater.llm.common import finished, mix, released, shingle_hashes, stored, table, text_batches, texts
from tidewater.llm.components import labels
from tidewater.llm.sketch import corpus_bits, corpus_counts, in_bits

SHINGLE = 4
PERCENT = 85
#: Cells of the count table that orders shingles.
CELLS = 1 << 18
#: Bits of a set's bitmap, kept as longs.
BITS = 512
LONGS = BITS // 64
#: Cells of the histogram that bounds the overlap of two sets, and its largest count.
HISTOGRAM, MOST = 1024, 15
#: Bits of the filters over wanted documents and shared prefix shingles.
FILTER_BITS = 1 << 23
TOKEN_BITS = 1 << 25
PIVOT_ROUNDS = 2
#: Tokens before one in a class's lists that a pair is looked up in.
EARLIER = 4
_W = [f"w{i}" for i in range(LONGS)]


def shingle_set(text: bytes, k: int) -> np.ndarray:
    return np.unique(shingle_hashes(text.lower().split(), k))


def class_id(hashes: np.ndarray) -> int:
    """A 64-bit name of a set, from all its members."""
    return int((mix(hashes, 11).sum(dtype=np.uint64) ^ np.uint64(len(hashes))).astype(np.int64))


def bitmap(hashes: np.ndarray) -> np.ndarray:
    """Parity of the members per bit: two bitmaps differ in at most as many bits
    as the sets differ in members."""
    parity = np.bincount((mix(hashes, 5) & np.uint64(BITS - 1)).astype(np.int64), minlength=BITS) & 1
    return np.packbits(parity.astype(np.uint8)).view(np.int64)


def histogram(hashes: np.ndarray) -> bytes:
    """Members per cell, packed: the overlap of two sets is at most the sum of
    the lesser counts, so half of what their sizes exceed the differences by."""
    counts = np.bincount((mix(hashes, 7) & np.uint64(HISTOGRAM - 1)).astype(np.int64), minlength=HISTOGRAM)
    return zlib.compress(np.minimum(counts, MOST).astype(np.uint8).tobytes(), 1)


def crowding(counts: np.ndarray) -> np.ndarray:
    """Order class of each cell: 0 up to about the mean, then two for each doubling."""
    mean = max(1.0, counts.mean())
    return np.clip(2 * np.log2(np.maximum(counts, 1) / mean), 0, 126).astype(np.uint8)


def prefix(hashes: np.ndarray, order: np.ndarray, percent: int) -> np.ndarray:
    """The first shingles in order: class of the cell on top, hash below it."""
    n = len(hashes)
    size = n - -(-percent * n // 100) + 1
    keys = (order[cell(hashes)].astype(np.uint64) << np.uint64(56)) | (hashes >> np.uint64(8))
    keys = np.partition(keys, size - 1)[:size] if size < n else keys
    return np.sort(keys).astype(np.int64)


def cell(hashes: np.ndarray) -> np.ndarray:
    return (hashes & np.uint64(CELLS - 1)).astype(np.int64)


def shingle_order(docs: DataFrame, k: int) -> np.ndarray:
    def cells(batch: pa.RecordBatch) -> Iterator[np.ndarray]:
        for t in texts(batch):
            h = shingle_hashes(t.lower().split(), k)
            if len(h):
                pending.append(cell(h))
            if sum(map(len, pending)) > 500_000:
                yield np.concatenate(pending)
                pending.clear()
        if pending:
            yield np.concatenate(pending)
            pending.clear()
    pending: list[np.ndarray] = []
    return crowding(corpus_counts(docs.select("text"), cells, CELLS))


def set_table(docs: DataFrame, k: int, percent: int) -> DataFrame:
    """doc_id, class, n, bitmap and prefix of every document, written once."""
    order = shingle_order(docs, k)

    def run(batches):
        for b in text_batches(batches):
            out = []
            for t in texts(b):
                h = shingle_set(t, k)
                out.append((class_id(h), len(h), bitmap(h), prefix(h, order, percent) if len(h) else h.astype(np.int64), histogram(h)))
            bits = np.stack([x[2] for x in out], 1)
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), b.column("row"), pa.array([x[0] for x in out], pa.int64()), pa.array([x[1] for x in out], pa.int64()),
                 *map(pa.array, bits), pa.array([x[3] for x in out], pa.list_(pa.int64())), pa.array([x[4] for x in out], pa.binary())],
                names=["doc_id", "row", "class", "n", *_W, "prefix", "cells"])
    ddl = f"doc_id long, row long, class long, n long, {', '.join(w + ' long' for w in _W)}, prefix array<long>, cells binary"
    rows = docs.select("doc_id", "text", F.xxhash64("doc_id", "text").alias("row")).mapInArrow(released(run), ddl)
    return stored(docs.sparkSession, rows.withColumn("grp", F.xxhash64("n", "prefix")), "ngram-sets")


def _differ(x: str, y: str) -> Column:
    """Bits in which two bitmaps differ."""
    return reduce(Column.__add__, [F.bit_count(F.col(f"{x}.{w}").bitwiseXOR(F.col(f"{y}.{w}"))) for w in _W])


def _may_link(x: str, y: str, percent: int) -> Column:
    """Size test and bitmap bound; never false for a linked pair."""
    n = F.col(f"{x}.n") + F.col(f"{y}.n")
    return ((F.least(f"{x}.n", f"{y}.n") * 100 >= F.greatest(f"{x}.n", f"{y}.n") * percent)
            & (_differ(x, y) * (100 + percent) <= n * (100 - percent)))


def wanted_texts(docs: DataFrame, wanted: DataFrame, k: int, name: str) -> DataFrame:
    """(class, packed), written: the compressed text of one document of each class in
    ``wanted`` (class, doc_id). A bitmap of fixed size over the wanted doc_ids
    thins the scan before the shuffle; the join then decides exactly."""
    shared = docs.sparkSession.sparkContext.broadcast(corpus_bits(wanted.select(F.xxhash64("doc_id")), FILTER_BITS))

    def run(batches):
        for b in batches:
            take = np.flatnonzero(in_bits(b.column("key").to_numpy().view(np.uint64), shared.value))
            for part in text_batches(iter([b.take(pa.array(take))])) if len(take) else ():
                held = texts(part)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array([class_id(shingle_set(t, k)) for t in held], pa.int64()),
                     pa.array([zlib.compress(t, 1) for t in held], pa.binary())], names=["d", "class", "packed"])
    found = docs.select("doc_id", "text", F.xxhash64("doc_id").alias("key")).mapInArrow(released(run), "d long, class long, packed binary")
    out = found.join(wanted, (found["class"] == wanted["class"]) & F.col("d").eqNullSafe(F.col("doc_id"))) \
        .select(found["class"], "packed").dropDuplicates(["class"])
    out = stored(docs.sparkSession, out, name)
    shared.destroy()
    return out


def _bounded(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) that the bound by histograms lets pass."""
    def run(batches):
        for b in batches:
            one, two = (np.frombuffer(b"".join(zlib.decompress(c.as_py()) for c in b.column(n)), np.uint8)
                        .reshape(-1, HISTOGRAM).astype(np.int16) for n in ("one", "two"))
            n = b.column("n").to_numpy()
            differ = np.abs(one - two).sum(1, dtype=np.int64)
            keep = pa.array(np.flatnonzero(differ * (100 + percent) <= n * (100 - percent)))
            yield pa.RecordBatch.from_arrays([b.column("a").take(keep), b.column("b").take(keep)], names=["a", "b"])
    x = classes.select(F.col("class").alias("a"), F.col("n").alias("n1"), F.col("cells").alias("one"))
    y = classes.select(F.col("class").alias("b"), F.col("n").alias("n2"), F.col("cells").alias("two"))
    return pairs.join(x, "a").join(y, "b").select("a", "b", "one", "two", (F.col("n1") + F.col("n2")).alias("n")) \
        .mapInArrow(released(run), "a long, b long")


def _verified(docs: DataFrame, likely: DataFrame, classes: DataFrame, k: int, percent: int, name: str) -> DataFrame | None:
    """The pairs (a, b) of classes whose whole sets are similar enough; each text
    moves compressed, the pairs of an ``a`` side by side."""
    spark = docs.sparkSession
    likely = stored(spark, _bounded(likely, classes, percent), f"{name}-likely")
    if likely.isEmpty():
        return None
    ends = likely.select(F.col("a").alias("class")).union(likely.select(F.col("b").alias("class"))).distinct()
    wanted = stored(spark, classes.join(ends, "class", "left_semi").select("class", "doc_id"), f"{name}-wanted")
    packed = wanted_texts(docs, wanted, k, f"{name}-texts")

    def run(batches):
        last, members = None, None
        for b in batches:
            keep = []
            for i in range(b.num_rows):
                if last != (now := b.column("a")[i].as_py()):
                    last, members = now, shingle_set(zlib.decompress(b.column("one")[i].as_py()), k)
                other = shingle_set(zlib.decompress(b.column("two")[i].as_py()), k)
                both = len(np.intersect1d(members, other, assume_unique=True))
                if 100 * both >= percent * (len(members) + len(other) - both):
                    keep.append(i)
            yield pa.RecordBatch.from_arrays([b.column("a").take(pa.array(keep, pa.int64())), b.column("b").take(pa.array(keep, pa.int64()))],
                                             names=["a", "b"])
    two = packed.select(F.col("class").alias("b"), F.col("packed").alias("two"))
    one = packed.select(F.col("class").alias("a"), F.col("packed").alias("one"))
    return stored(spark, likely.join(two, "b").join(one, "a").select("a", "b", "one", "two").mapInArrow(released(run), "a long, b long"), f"{name}-links")


def shared_prefixes(some: DataFrame) -> DataFrame:
    """(token, grp, class) of the prefix shingles that more than one group has.
    Those of more than one row are found by a count; a bitmap of fixed size over
    them thins the rows before the joins that decide exactly."""
    spark = some.sparkSession
    tokens = stored(spark, some.select(F.explode("prefix").alias("token")).groupBy("token")
                    .agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("token"), "ngram-tokens")
    shared = spark.sparkContext.broadcast(corpus_bits(tokens, TOKEN_BITS))

    def run(batches):
        for b in batches:
            lists = b.column("prefix")
            at = np.repeat(np.arange(b.num_rows), lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64))
            values = lists.flatten().to_numpy(zero_copy_only=False)
            hit = np.flatnonzero(in_bits(values.view(np.uint64), shared.value))
            rows = pa.array(at[hit])
            yield pa.RecordBatch.from_arrays([pa.array(values[hit]), b.column("grp").take(rows), b.column("class").take(rows)],
                                             names=["token", "grp", "class"])
    rows = some.select("prefix", "grp", "class").mapInArrow(released(run), "token long, grp long, class long")
    rows = stored(spark, rows.distinct(), "ngram-entries")
    shared.destroy()
    several = rows.groupBy("token").agg(F.min("grp").alias("low"), F.max("grp").alias("high")).filter("low < high").select("token")
    return stored(spark, rows.join(several, "token"), "ngram-lists")


def linked_components(docs: DataFrame, k: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles, row, class and component_id of every row of ``docs``
    (doc_id, text): the smallest doc_id reachable by links of ``percent``
    similarity. ``row`` is a hash of doc_id and text, ``label`` a name of the component."""
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    rows = set_table(docs, k, percent)
    some = rows.filter("n > 0")
    shared = shared_prefixes(some)
    # Classes of one group are a list of their own.
    inside = some.select("grp", "class").join(some.groupBy("grp").agg(F.min("class").alias("low"), F.max("class").alias("high"))
                                              .filter("low < high"), "grp") \
        .select(F.col("grp").alias("token"), F.col("class").alias("lead")).distinct()
    inside = stored(spark, inside, "ngram-inside")
    finished(spark)
    listed = shared.select("class").union(inside.select(F.col("lead").alias("class"))).distinct()
    classes = stored(spark, some.join(listed, "class", "left_semi").groupBy("class").agg(
        F.min("doc_id").alias("doc_id"), *[F.first(c).alias(c) for c in ("n", "cells", *_W)]), "ngram-classes")
    # Groups stand for their classes in the lists.
    lists = shared.groupBy("token", "grp").agg(F.min("class").alias("lead")).select("token", "lead").union(inside)
    label = None
    for r in range(PIVOT_ROUNDS):
        now = _labelled(lists, label)
        pick = F.struct(F.xxhash64("lead", F.lit(r)), "lead", "label")
        pivots = now.groupBy("token").agg(F.min(pick).alias("p"), F.min("label").alias("l"), F.max("label").alias("h")) \
            .filter("l != h").select("token", "p.lead", "p.label").toDF("token", "a", "pivot_label")
        pairs = now.join(pivots, "token").filter("label != pivot_label").select("a", F.col("lead").alias("b")).distinct()
        # Each class is verified with the most alike of its pivots.
        likely = pairs.join(_side(classes, "x"), F.col("a") == F.col("x.class")).join(_side(classes, "y"), F.col("b") == F.col("y.class")) \
            .filter(_may_link("x", "y", percent)).groupBy("b").agg(F.min(F.struct(_differ("x", "y").alias("d"), F.col("a"))).alias("best")) \
            .select("best.a", "b")
        new = _verified(docs, likely, classes, k, percent, f"ngram-{r}")
        label = _merged(spark, label, new, f"ngram-{r}")
        finished(spark)
    rest = _labelled(shared.select("token", F.col("class").alias("lead")).union(inside), label)
    mixed = rest.groupBy("token").agg(F.min("label").alias("l"), F.max("label").alias("h")).filter("l != h").select("token")
    # A pair is drawn at the first token that both have: where none of the few
    # before it is common to both. (At the first, none at all is.)
    before = Window.partitionBy("lead").orderBy("token")
    rest = rest.join(mixed, "token").withColumn("before", F.array_compact(F.array(*[F.lag("token", i).over(before) for i in range(1, EARLIER + 1)])))
    full = stored(spark, rest.join(classes.select(F.col("class").alias("lead"), "n", *_W), "lead"), "ngram-rest")
    pairs = full.alias("x").join(full.alias("y"), (F.col("x.token") == F.col("y.token")) & (F.col("x.lead") < F.col("y.lead"))
                                 & (F.col("x.label") != F.col("y.label")) & ~F.arrays_overlap("x.before", "y.before")
                                 & _may_link("x", "y", percent)) \
        .select(F.col("x.lead").alias("a"), F.col("y.lead").alias("b")).distinct()
    finished(spark)
    label = _merged(spark, label, _verified(docs, pairs, classes, k, percent, "ngram-rest"), "ngram-all")
    finished(spark)
    least = some.groupBy("class").agg(F.min("doc_id").alias("least"))
    if label is None:
        named = least.select("class", F.col("class").alias("label"), F.col("least").alias("component_id"))
    else:
        known = least.join(label.withColumnRenamed("node", "class"), "class", "left").withColumn("label", F.coalesce("label", "class"))
        named = known.select("class", "label").join(known.groupBy("label").agg(F.min("least").alias("component_id")), "label")
    out = ["doc_id", F.col("n").alias("n_shingles"), "row", "class", "label", "component_id"]
    return some.select("doc_id", "n", "row", "class").join(named, "class").select(*out).union(
        rows.filter("n = 0").select("doc_id", "n", "row", "class", F.col("row").alias("label"), F.col("doc_id").alias("component_id"))
        .select(*out))


def _side(classes: DataFrame, name: str) -> DataFrame:
    return classes.select("class", "n", *_W).alias(name)


def _labelled(lists: DataFrame, label: DataFrame | None) -> DataFrame:
    if label is None:
        return lists.withColumn("label", F.col("lead"))
    return lists.join(label.withColumnRenamed("node", "lead"), "lead", "left") \
        .select("token", "lead", F.coalesce("label", "lead").alias("label"))


def _merged(spark: SparkSession, label: DataFrame | None, new: DataFrame | None, name: str) -> DataFrame | None:
    """Labels after the links ``new`` (a, b)."""
    if new is None:
        return label
    old = [] if label is None else [label.filter("node != label").select(F.col("label").alias("a"), F.col("node").alias("b"))]
    edges = new
    for e in old:
        edges = edges.union(e)
    return stored(spark, labels(edges, name), f"{name}-labels")


def one_per_component(docs: DataFrame, k: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """``docs``, all columns, with one document of each component: that with the
    smallest doc_id (NULL last). Repeated rows are one document; wordless ones
    stay. Rows that go, or repeat, are found by a bitmap of fixed size and only
    the rows it names are shuffled to decide exactly; the others pass as they are."""
    spark = docs.sparkSession
    linked = stored(spark, linked_components(docs, k, percent).select("doc_id", "row", "label"), "ngram-linked")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row"))
    kept = stored(spark, linked.groupBy("label").agg(first.alias("f")).select(F.col("f.row").alias("_row"), F.col("f.doc_id").alias("_id"))
                  .distinct(), "ngram-kept")
    same = (F.col("row") == F.col("_row")) & F.col("doc_id").eqNullSafe(F.col("_id"))
    doubtful = linked.groupBy("row", "doc_id").agg(F.count(F.lit(1)).alias("n")).join(kept, same, "left") \
        .filter("n > 1 OR _row IS NULL").select("row")
    shared = spark.sparkContext.broadcast(corpus_bits(doubtful, FILTER_BITS))

    @F.arrow_udf("boolean")
    def listed(key: pa.Array) -> pa.Array:
        return pa.array(in_bits(key.to_numpy(zero_copy_only=False).view(np.uint64), shared.value))
    key = F.xxhash64(F.col("doc_id").cast("long"), F.col("text"))
    some = docs.filter(listed(key)).withColumn("_key", key)
    some = some.join(kept, (F.col("_key") == F.col("_row")) & F.col("doc_id").eqNullSafe(F.col("_id")), "left_semi") \
        .dropDuplicates(["_key", "doc_id"]).select(*docs.columns)
    return docs.filter(~listed(key)).unionByName(some)


def op9_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """4-word shingles, Jaccard 0.85, over all documents."""
    return linked_components(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")
