"""Phrase collocations per language by best-first branch and bound.

A phrase of two or three words scores a*a / (l*r) of its counts: a of the
phrase, l and r of the two parts of its lowest-scoring cut. Growing a phrase
to the right, its prefix bounds every extension: one that begins with the word
x and has the prefix p scores at most f(p) / f(x), since a <= f(p) and a <= r.

Counting is level by level, each level one scan whose tasks add up their own
phrases before the shuffle. Words come first, then pairs of words that occur
``least`` times. Pairs are candidates themselves and the prefixes of triples.
Best first, only the frontier is expanded: a language's threshold starts at the
score of its ``FRONTIER * top``-th pair, and triples are counted whose prefix
bound reaches it, or that hold a pair which reaches it (to know whether that
pair falls to a longer phrase). Then every phrase of the threshold's score or
more is settled, as each of them and each longer one round it was counted. Where
fewer than ``top`` of those survive, the language goes on with a lower threshold
(GROWTH times as many pairs, in the end all); languages that are settled rest.

Bitmaps say in a task which words and pairs matter. Their size follows the
number of those, up to MAP_BITS; they only save work: counts are of whole
phrases, and scores and decisions come from exact joins. Joins on a word or pair
that starts many phrases are spread over SALTS parts of that key; the
first ``top`` of a language come out of many parts of it.

Edge cases: NULL text is empty, NULL lang is ``und``; repeated documents count
each time; empty tables give no rows; further columns are ignored; ties at the
last rank are broken by count and phrase, so the result is one and the same.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidewater.llm.common import mix, released, stored, table

LEAST, TOP, MAX_WORDS = 10, 2000, 3
#: A phrase falls to a longer one with at least this share, in percent, of its occurrences.
DROP_PERCENT = 50
#: Pairs, as a multiple of ``top``, that set a language's first threshold; factor of each further one.
FRONTIER, GROWTH = 2, 8
#: Bytes of text that a task adds up at a time.
BUFFER = 6 << 20
#: Bits of a bitmap for each key in it, and of the largest bitmap.
BITS_PER_KEY, MAP_BITS = 16, 1 << 27
SALTS, PARTS = 16, 64
PIECE = 1 << 16
_U = np.uint64
# A-Z are lowered, a tab is a space, and these end a piece.
_ENDS = b".,;:!?\x0a\x0b\x0c\x0d"
_TABLE = bytes(10 if c in _ENDS else 32 if c == 9 else c + 32 if 65 <= c <= 90 else c for c in range(256))
_END = b"."  # no word: it ends pieces


def word_hash(lang: str, word: bytes) -> int:
    return xxhash.xxh3_64_intdigest(word, xxhash.xxh32_intdigest(lang.encode()))


def pair_hash(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    return mix(first * _U(0x9E3779B97F4A7C15) + second)


def _buffers(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, list[bytes]]]:
    """(lang, words in order with ``_END`` between pieces) of about BUFFER bytes of one language."""
    held: dict[str, list[bytes]] = defaultdict(list)
    size = 0

    def flush():
        for lang, some in held.items():
            yield lang, b"\n".join(some).replace(b"\n", b" . ").split()
        held.clear()
    for b in batches:
        for lang, text in zip(b.column("lang").to_pylist(), b.column("text").cast(pa.binary())):
            text = (text.as_py() or b"").translate(_TABLE)
            held[lang].append(text)
            size += len(text)
            if size >= BUFFER:
                yield from flush()
                size = 0
    yield from flush()


class Words:
    """A buffer's words as numbers of its distinct ones."""

    def __init__(self, lang: str, words: list[bytes]):
        self.lang = lang
        coded = pa.array(words, pa.binary()).dictionary_encode()
        self.ids, self.distinct = coded.indices.to_numpy().astype(np.int64), coded.dictionary
        end = pc.index(self.distinct, _END).as_py()
        self.real = np.arange(len(self.distinct)) != end

    def hashes(self) -> np.ndarray:
        return np.array([word_hash(self.lang, w) for w in self.distinct.to_pylist()], _U)

    def rows(self, ids: list[np.ndarray], counts: np.ndarray) -> Iterator[pa.RecordBatch]:
        """(lang, phrase, a) of the phrases whose words are numbered by ``ids``."""
        for i in range(0, len(counts), PIECE):
            parts = [self.distinct.take(pa.array(x[i:i + PIECE])) for x in ids]
            phrase = parts[0] if len(parts) == 1 else pc.binary_join_element_wise(*parts, b" ")
            yield pa.RecordBatch.from_arrays([pa.array([self.lang] * len(phrase), pa.string()), phrase.cast(pa.binary()), pa.array(counts[i:i + PIECE])],
                                             names=["lang", "phrase", "a"])


class Bitmap:
    """Keys' bits in a map whose size follows their number."""

    def __init__(self, packed: np.ndarray):
        self.packed = packed

    def has(self, hashes: np.ndarray) -> np.ndarray:
        at = (hashes & _U(len(self.packed) * 8 - 1)).astype(np.int64)
        return (self.packed[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1


def _phrase_hashes(langs: list[str], phrases: list[str]) -> np.ndarray:
    parts = [p.encode().split(b" ") for p in phrases]
    words = [np.array([word_hash(l, p[i]) for l, p in zip(langs, parts)], _U) for i in range(len(parts[0]) if parts else 1)]
    return words[0] if len(words) == 1 else pair_hash(*words)


def bitmap(phrases: DataFrame) -> Bitmap:
    """Of the phrases (lang, phrase), all words or all pairs. A task sends the map's
    pieces that it has bits in; pieces are merged in tasks of their own."""
    wanted = max(phrases.count() * BITS_PER_KEY, 1 << 16)
    bits = min(1 << (wanted - 1).bit_length(), MAP_BITS)
    piece = min(bits // 8, PIECE)

    def send(found: dict[int, np.ndarray]):
        return pa.RecordBatch.from_arrays([pa.array(list(found), pa.int32()), pa.array([x.tobytes() for x in found.values()], pa.binary())],
                                          names=["piece", "bits"])

    def local(batches):
        packed = np.zeros(bits // 8, np.uint8)
        for b in batches:
            at = (_phrase_hashes(b.column(0).to_pylist(), b.column(1).to_pylist()) & _U(bits - 1)).astype(np.int64)
            np.bitwise_or.at(packed, at >> 3, np.left_shift(1, at & 7).astype(np.uint8))
        for i in range(0, len(packed), piece):
            if packed[i:i + piece].any():
                yield send({i // piece: packed[i:i + piece]})

    def merged(batches):
        found: dict[int, np.ndarray] = {}
        for b in batches:
            for i, data in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                part = np.frombuffer(data, np.uint8)
                found[i] = found[i] | part if i in found else part
        if found:
            yield send(found)
    ddl = "piece int, bits binary"
    packed = np.zeros(bits // 8, np.uint8)
    for r in phrases.select("lang", "phrase").mapInArrow(released(local), ddl).repartition(F.col("piece")) \
            .mapInArrow(released(merged), ddl).collect():  # MAP_BITS bits at most
        packed[r["piece"] * piece:(r["piece"] + 1) * piece] = np.frombuffer(r["bits"], np.uint8)
    return Bitmap(packed)


def _counted(docs: DataFrame, grams, least: int = 1) -> DataFrame:
    """(lang, phrase, a) over all documents; ``grams`` yields a buffer's own counts."""
    def run(batches):
        for lang, words in _buffers(batches):
            w = Words(lang, words)
            del words
            if len(w.ids):
                yield from grams(w)
    out = (docs.mapInArrow(released(run), "lang string, phrase binary, a long").withColumn("phrase", F.col("phrase").cast("string"))
           .groupBy("lang", "phrase").agg(F.sum("a").alias("a")))
    return out.filter(F.col("a") >= least) if least > 1 else out


def _distinct(ids: np.ndarray, others: np.ndarray, base: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct pairs of numbers and how often each occurs."""
    keys, counts = np.unique(ids * base + others, return_counts=True)
    return keys // base, keys % base, counts


def word_counts(docs: DataFrame) -> DataFrame:
    def grams(w: Words):
        counts = np.bincount(w.ids, minlength=len(w.distinct))
        at = np.flatnonzero(w.real)
        yield from w.rows([at], counts[at])
    return _counted(docs, grams)


def pair_counts(docs: DataFrame, frequent: DataFrame, least: int) -> DataFrame:
    """Pairs that occur ``least`` times; both words do, so other words are passed over."""
    shared = docs.sparkSession.sparkContext.broadcast(bitmap(frequent))  # MAP_BITS bits at most

    def grams(w: Words):
        use = w.real & shared.value.has(w.hashes())
        at = np.flatnonzero(use[w.ids[:-1]] & use[w.ids[1:]])
        first, second, counts = _distinct(w.ids[at], w.ids[at + 1], len(w.distinct))
        yield from w.rows([first, second], counts)
    return _counted(docs, grams, least)


def triple_counts(docs: DataFrame, pairs: DataFrame, grow: DataFrame, settle: DataFrame, least: int) -> DataFrame:
    """Triples of ``pairs`` that begin with one in ``grow`` or end with one in ``settle``."""
    context = docs.sparkSession.sparkContext
    known, prefixes, suffixes = (context.broadcast(bitmap(x)) for x in (pairs, grow, settle))

    def grams(w: Words):
        hashes = w.hashes()
        joined = w.real[w.ids[:-1]] & w.real[w.ids[1:]]
        base = len(w.distinct)
        keys, of = np.unique(np.where(joined, w.ids[:-1] * base + w.ids[1:], -1), return_inverse=True)
        h = pair_hash(hashes[keys // base], hashes[keys % base])
        frequent = known.value.has(h) & (keys >= 0)
        begins, ends = frequent & prefixes.value.has(h), frequent & suffixes.value.has(h)
        at = np.flatnonzero(frequent[of[:-1]] & frequent[of[1:]] & (begins[of[:-1]] | ends[of[1:]]))
        pair, third, counts = _distinct(of[at], w.ids[at + 2], base)
        yield from w.rows([keys[pair] // base, keys[pair] % base, third], counts)
    return _counted(docs, grams, least)


def _with_count(rows: DataFrame, counts: DataFrame, part: Column, name: str) -> DataFrame:
    """``rows`` with the count of ``part`` of their phrase as ``name``. One part may
    start or end very many phrases, so each key is spread over SALTS."""
    salted = counts.select(F.col("lang").alias("_lang"), F.col("phrase").alias("_part"), F.col("a").alias(name),
                           F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("_salt"))
    keyed = rows.withColumn("_of", part).withColumn("_spread", F.pmod(F.hash("phrase"), F.lit(SALTS)))
    return keyed.join(salted, (F.col("lang") == F.col("_lang")) & (F.col("_of") == F.col("_part")) & (F.col("_spread") == F.col("_salt"))) \
        .drop("_of", "_spread", "_lang", "_part", "_salt")


def ratio(a: str, over: str, under: str = "1") -> Column:
    """floor(1000000 * a * a / (over * under)) in 38 digits, as products pass 64 bits."""
    wide = "cast({} as decimal(15,0))".format
    return F.expr(f"cast(1000000 * ({wide(a)} * {wide(a)}) div ({wide(over)} * {wide(under)}) as bigint)")


def _first(n: int) -> Column:
    return F.substring_index("phrase", " ", n)


def _last(n: int) -> Column:
    return F.substring_index("phrase", " ", -n)


def _best(rows: DataFrame, n: int, order: list[Column]) -> DataFrame:
    """Each language's first ``n`` rows with their ``rank``: first of many parts of a
    language, then of these."""
    spread = rows.withColumn("_part", F.pmod(F.hash("phrase"), F.lit(PARTS)))
    some = spread.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "_part").orderBy(*order))).filter(F.col("rank") <= n)
    return some.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).filter(F.col("rank") <= n).drop("_part")


def scored_pairs(pairs: DataFrame, words: DataFrame) -> DataFrame:
    found = _with_count(_with_count(pairs, words, _first(1), "l"), words, _last(1), "r")
    return found.withColumn("score", ratio("a", "l", "r")).withColumn("bound", F.expr("cast(1000000 * cast(a as decimal(15,0)) div l as bigint)"))


def scored_triples(triples: DataFrame, pairs: DataFrame, words: DataFrame) -> DataFrame:
    found = triples
    for counts, part, name in ((words, _first(1), "l1"), (pairs, _last(2), "r1"), (pairs, _first(2), "l2"), (words, _last(1), "r2")):
        found = _with_count(found, counts, part, name)
    late = F.col("s2") < F.col("s1")
    return (found.withColumn("s1", ratio("a", "l1", "r1")).withColumn("s2", ratio("a", "l2", "r2"))
            .select("lang", "phrase", "a", F.when(late, F.col("l2")).otherwise(F.col("l1")).alias("l"),
                    F.when(late, F.col("r2")).otherwise(F.col("r1")).alias("r"), F.least("s1", "s2").alias("score")))


def surviving_pairs(pairs: DataFrame, triples: DataFrame, drop_percent: int) -> DataFrame:
    """Pairs that lie in no triple with ``drop_percent`` of their occurrences."""
    within = F.explode(F.array(_first(2), _last(2))).alias("phrase")
    most = triples.select("lang", within, F.col("a").alias("longer")).groupBy("lang", "phrase").agg(F.max("longer").alias("longer"))
    return (pairs.join(most, ["lang", "phrase"], "left")
            .filter(F.col("longer").isNull() | (100 * F.col("longer") < drop_percent * F.col("a"))).drop("longer"))


def collocations(docs: DataFrame, top: int = TOP, least: int = LEAST, max_words: int = MAX_WORDS,
                 drop_percent: int = DROP_PERCENT, frontier: int = FRONTIER) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score) of each language's first ``top`` phrases."""
    if max_words not in (2, 3):
        raise ValueError("phrases have two or three words")
    spark = docs.sparkSession
    docs = docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), "text")
    counts = stored(spark, word_counts(docs), "phrase_words")
    totals = counts.groupBy("lang").agg(F.sum("a").alias("n"))
    words = stored(spark, counts.filter(F.col("a") >= least), "phrase_frequent")
    pairs = stored(spark, scored_pairs(pair_counts(docs, words, least), words), "phrase_pairs")
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase")]
    columns = ["lang", "phrase", "a", "l", "r", "score"]
    done, open_langs, n = [], totals.select("lang"), frontier * top
    while True:
        # The n-th best pair's score; 0, so every pair, where there are fewer.
        limits = _best(pairs.join(open_langs, "lang"), n, order).groupBy("lang").agg(
            F.max("rank").alias("pairs"), F.min("score").alias("lowest"))
        limits = stored(spark, limits.select("lang", F.when(F.col("pairs") < n, 0).otherwise(F.col("lowest")).alias("limit")), "phrase_limits")
        here = pairs.join(limits, "lang")
        if max_words == 2:
            triples = None
            found = here.filter(F.col("score") >= F.col("limit"))
        else:
            grow, settle = here.filter(F.col("bound") >= F.col("limit")), here.filter(F.col("score") >= F.col("limit"))
            triples = stored(spark, scored_triples(triple_counts(docs, here, grow, settle, least), pairs, words), "phrase_triples")
            found = surviving_pairs(settle, triples, drop_percent).select(*columns, "limit").unionByName(
                triples.join(limits, "lang").filter(F.col("score") >= F.col("limit")).select(*columns, "limit"))
        found = stored(spark, _best(found.select(*columns, "limit"), top, order), "phrase_best")
        settled = limits.join(found.groupBy("lang").count(), "lang", "left").filter((F.col("limit") == 0) | (F.col("count") >= top)).select("lang")
        settled = stored(spark, settled, "phrase_settled")
        done.append(found.join(settled, "lang"))
        open_langs = limits.select("lang").join(settled, "lang", "left_anti")
        if open_langs.isEmpty():
            break
        n *= GROWTH
    return reduce(DataFrame.unionByName, done).join(totals, "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


def op11_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents"))


ORACLE_SQL = """
WITH pieces AS (
  SELECT row_number() OVER () AS p, lang, piece FROM (
    SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
             translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\x0A-\\x0D]')) AS piece
    FROM documents)),
lists AS (SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS w FROM pieces),
grams AS (
  SELECT lang, w[i] AS w1, w[i + 1] AS w2, w[i + 2] AS w3 FROM (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM lists)),
f1 AS (SELECT lang, w1, count(*)::BIGINT AS f FROM grams GROUP BY ALL),
f2 AS (SELECT lang, w1, w2, count(*)::BIGINT AS f FROM grams WHERE w2 IS NOT NULL GROUP BY ALL),
f3 AS (SELECT lang, w1, w2, w3, count(*)::BIGINT AS f FROM grams WHERE w3 IS NOT NULL GROUP BY ALL HAVING count(*) >= 10),
totals AS (SELECT lang, sum(f)::BIGINT AS n FROM f1 GROUP BY lang),
dropped AS (
  SELECT lang, w1, w2, max(f) AS longer FROM (
    SELECT lang, w1, w2, f FROM f3 UNION ALL SELECT lang, w2, w3, f FROM f3) GROUP BY ALL),
two AS (
  SELECT p.lang, p.w1 || ' ' || p.w2 AS phrase, p.f AS a, x.f AS l, y.f AS r
  FROM f2 p JOIN f1 x ON x.lang = p.lang AND x.w1 = p.w1 JOIN f1 y ON y.lang = p.lang AND y.w1 = p.w2
  LEFT JOIN dropped d ON d.lang = p.lang AND d.w1 = p.w1 AND d.w2 = p.w2
  WHERE p.f >= 10 AND (d.longer IS NULL OR 100 * d.longer < 50 * p.f)),
cuts AS (
  SELECT t.lang, t.w1 || ' ' || t.w2 || ' ' || t.w3 AS phrase, t.f AS a, x.f AS l1, yz.f AS r1, xy.f AS l2, z.f AS r2
  FROM f3 t JOIN f1 x ON x.lang = t.lang AND x.w1 = t.w1 JOIN f1 z ON z.lang = t.lang AND z.w1 = t.w3
  JOIN f2 xy ON xy.lang = t.lang AND xy.w1 = t.w1 AND xy.w2 = t.w2 JOIN f2 yz ON yz.lang = t.lang AND yz.w1 = t.w2 AND yz.w2 = t.w3),
both_cuts AS (
  SELECT *, 1000000::HUGEINT * a * a // (l1::HUGEINT * r1) AS s1, 1000000::HUGEINT * a * a // (l2::HUGEINT * r2) AS s2 FROM cuts),
scored AS (
  SELECT lang, phrase, a, l, r, (1000000::HUGEINT * a * a // (l::HUGEINT * r))::BIGINT AS score FROM two
  UNION ALL
  SELECT lang, phrase, a, CASE WHEN s2 < s1 THEN l2 ELSE l1 END, CASE WHEN s2 < s1 THEN r2 ELSE r1 END, least(s1, s2)::BIGINT FROM both_cuts),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM scored)
SELECT lang, rank::BIGINT AS rank, phrase, a, l, r, n, score FROM ranked JOIN totals USING (lang) WHERE rank <= 2000
"""
