"""Quality classifier: a factorisation machine over hashed words, structure
statistics and metadata.

Score of a document with features x: sigmoid of
    w0 + sum_i w_i x_i + 1/2 sum_f ((sum_i v_if x_i)^2 - sum_i v_if^2 x_i^2),
the pairwise part in linear time by the sum-of-squares identity. The model is
fitted by AdaGrad on a bounded sample of labelled rows (SAMPLE_ROWS, half for
each label where there are enough, weighted back to the labels' true shares);
scoring reads every text whole, without a shuffle. Labels, lang, source and
doc_id are not features; doc_id only picks and splits the labelled rows.

Edge cases: NULL or empty texts score by their statistics; a NULL doc_id is not
held out; without labels of both kinds every row scores the share of label 1,
or 0.5 without any; rows labelled twice count twice in the sample; an empty
table gives no rows; further columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.llm.common import release_memory, released, table, text_batches, texts, word_hashes

#: Labelled rows that the model is fitted on, at most.
SAMPLE_ROWS = 6000
WORD_FEATURES = 1 << 16
STEPS = 12
FACTORS = 8
EPOCHS = 6
BATCH = 64
RATE, RATE_V, DECAY = 0.1, 0.05, 1e-4
SEED = 20
#: Weight of the words beside the statistics, of length 1 each.
WORD_SCALE = 1.0
# Byte classes of the statistics.
_UPPER, _LOWER, _DIGIT, _SPACE, _LINE, _STOP, _OTHER, _HIGH = range(8)
_CLASS = np.full(256, _OTHER)
_CLASS[65:91], _CLASS[97:123], _CLASS[48:58], _CLASS[128:] = _UPPER, _LOWER, _DIGIT, _HIGH
_CLASS[[32, 9]], _CLASS[[10, 13]], _CLASS[[33, 44, 46, 63]] = _SPACE, _LINE, _STOP
STATISTICS = 14
FEATURES = WORD_FEATURES + STATISTICS * STEPS


def statistics(text: bytes, words: list[bytes], n_chars: int | None) -> np.ndarray:
    """Structure statistics and metadata, each from 0 to 1."""
    data = np.bincount(np.frombuffer(text, np.uint8), minlength=256)
    c = np.bincount(_CLASS, weights=data, minlength=8)
    size, n = max(1.0, c.sum()), max(1, len(words))
    lines = text.split(b"\n")
    chars = len(text) - int(data[128:192].sum())
    frequent = data[33:127].copy()
    frequent[[c - 33 for c in (*range(48, 58), *range(65, 91), *range(97, 123))]] = 0
    letters = max(1.0, c[_UPPER] + c[_LOWER])
    return np.minimum(1.0, np.array([
        np.log2(1 + n) / 16, min(1.0, (size / n) / 16), c[_UPPER] / letters, c[_DIGIT] / size, c[_STOP] / n,
        4 * c[_OTHER] / size, 4 * frequent.max() / size, c[_HIGH] / size, len(set(words)) / n, len(lines) / n,
        len(set(lines)) / len(lines), float(np.count_nonzero(np.fromiter(map(len, words), np.int64, len(words)) <= 3)) / n,
        np.log2(1 + (chars if n_chars is None else max(0, n_chars))) / 24, float(n_chars is None or n_chars == chars)]))


def features(text: bytes, n_chars: int | None) -> tuple[np.ndarray, np.ndarray]:
    """(feature numbers, values): words by log count, scaled to length 1, and one
    feature for the step that each statistic falls in."""
    words = text.split()
    hashed = word_hashes(text.lower().split())
    ids, counts = np.unique((hashed % np.uint64(WORD_FEATURES)).astype(np.int32), return_counts=True)
    values = np.log1p(counts)
    values *= WORD_SCALE / max(1e-9, float(np.sqrt((values ** 2).sum())))
    step = np.minimum(STEPS - 1, (statistics(text, words, n_chars) * STEPS)).astype(np.int32)
    extra = WORD_FEATURES + np.arange(STATISTICS, dtype=np.int32) * STEPS + step
    return np.concatenate([ids, extra]), np.concatenate([values, np.full(STATISTICS, STATISTICS ** -0.5)])


@dataclass
class Model:
    bias: float
    linear: np.ndarray
    factors: np.ndarray

    def raw(self, ids: np.ndarray, values: np.ndarray) -> float:
        v = self.factors[ids] * values[:, None]
        return float(self.bias + self.linear[ids] @ values + 0.5 * ((v.sum(0) ** 2).sum() - (v ** 2).sum()))

    def score(self, text: bytes, n_chars: int | None) -> float:
        return float(1 / (1 + np.exp(-np.clip(self.raw(*features(text, n_chars)), -30, 30))))


def fit(rows: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, weights: np.ndarray) -> Model:
    """AdaGrad over the rows in seeded order."""
    rnd = np.random.default_rng(SEED)
    share = float((labels * weights).sum() / weights.sum()) if len(rows) else 0.5
    bias = float(np.log((share + 1e-6) / (1 - share + 1e-6)))
    m = Model(bias, np.zeros(FEATURES), np.zeros((FEATURES, FACTORS)))
    if len(set(labels.tolist())) < 2:
        return m
    m.factors = rnd.normal(0, 0.02, (FEATURES, FACTORS))
    seen_b, seen_w, seen_v = 1e-8, np.full(FEATURES, 1e-8), np.full((FEATURES, FACTORS), 1e-8)
    for _ in range(EPOCHS):
        order = rnd.permutation(len(rows))
        for i in range(0, len(rows), BATCH):
            take = order[i:i + BATCH]
            sizes = [len(rows[j][0]) for j in take]
            ids, x = (np.concatenate([rows[j][k] for j in take]) for k in (0, 1))
            starts = np.cumsum(sizes) - sizes
            vx = m.factors[ids] * x[:, None]
            sums = np.add.reduceat(vx, starts)
            raw = m.bias + np.add.reduceat(m.linear[ids] * x, starts) \
                + 0.5 * ((sums ** 2).sum(1) - np.add.reduceat((vx ** 2).sum(1), starts))
            gap = (1 / (1 + np.exp(-np.clip(raw, -30, 30))) - labels[take]) * weights[take]
            each = np.repeat(gap, sizes) * x
            used, back = np.unique(ids, return_inverse=True)
            gw = np.bincount(back, each) + DECAY * m.linear[used]
            gv = np.zeros((len(used), FACTORS))
            np.add.at(gv, back, each[:, None] * (np.repeat(sums, sizes, 0) - vx))
            gv += DECAY * m.factors[used]
            seen_b += float(gap.sum()) ** 2
            seen_w[used] += gw ** 2
            seen_v[used] += gv ** 2
            m.bias -= RATE * float(gap.sum()) / seen_b ** 0.5
            m.linear[used] -= RATE * gw / np.sqrt(seen_w[used])
            m.factors[used] -= RATE_V * gv / np.sqrt(seen_v[used])
    return m


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def _plain(docs: DataFrame) -> DataFrame:
    n = F.col("n_chars").cast("long") if "n_chars" in docs.columns else F.lit(None).cast("long")
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", n.alias("n_chars"))


def train(docs: DataFrame, labels: DataFrame) -> Model:
    """Fits a model on a sample of the labelled rows that are not held out."""
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("quality")) \
        .filter(F.col("quality").isin(0, 1) & ~held_out(F.col("doc_id")))
    totals = {r["quality"]: r["count"] for r in known.groupBy("quality").count().collect()}
    half = SAMPLE_ROWS // 2
    picks = [known.filter(F.col("quality") == q).orderBy(F.xxhash64("doc_id"), "doc_id")
             .limit(max(half, SAMPLE_ROWS - totals.get(1 - q, 0))) for q in (0, 1)]
    sample = picks[0].union(picks[1])  # SAMPLE_ROWS at most

    def run(batches):
        for b in batches:
            for part in text_batches(iter([b])):
                rows = [features(t, n) for t, n in zip(texts(part), part.column("n_chars").to_pylist())]
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("quality"), pa.array([i.astype(np.int32).tobytes() for i, _ in rows], pa.binary()),
                     pa.array([v.astype(np.float32).tobytes() for _, v in rows], pa.binary())], names=["doc_id", "quality", "ids", "vals"])
    found = _plain(docs).join(F.broadcast(sample), "doc_id").select("doc_id", "quality", "text", "n_chars") \
        .mapInArrow(released(run), "doc_id long, quality int, ids binary, vals binary").orderBy("doc_id", "quality", "ids", "vals") \
        .limit(SAMPLE_ROWS).collect()  # documents may repeat a doc_id; SAMPLE_ROWS are read all the same
    rows = [(np.frombuffer(r["ids"], np.int32), np.frombuffer(r["vals"], np.float32)) for r in found]
    y = np.array([r["quality"] for r in found], np.float64)
    weights = np.ones(len(y))
    for q in (0, 1):
        if (y == q).any():
            weights[y == q] = totals[q] / (y == q).sum()
    return fit(rows, y, weights / weights.mean() if len(y) else weights)


def scores(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id and score of every row, without the text."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        m = shared.value
        for b in text_batches(batches):
            s = [m.score(t, n) for t, n in zip(texts(b), b.column("n_chars").to_pylist())]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(s, pa.float64())], names=["doc_id", "score"])
    return _plain(docs).mapInArrow(released(run), "doc_id long, score double")


def accepted(docs: DataFrame, model: Model, least: float) -> DataFrame:
    """``docs``, all columns, of the rows that score ``least`` or more; map-only."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("double")
    def score(text: pa.Array, n_chars: pa.Array) -> pa.Array:
        m = shared.value
        out = pa.array([m.score(t or b"", n) for t, n in zip(text.cast(pa.binary()).to_pylist(), n_chars.to_pylist())], pa.float64())
        release_memory()
        return out
    n = F.col("n_chars").cast("long") if "n_chars" in docs.columns else F.lit(None).cast("long")
    return docs.filter(score(F.col("text"), n) >= least)


def op6_fm_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of all documents by a model fitted on labels outside the held-out third."""
    docs = table(spark, sf_dir, "documents")
    model = train(docs, table(spark, sf_dir, "labels"))
    return scores(docs, model).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                                      (F.col("score") >= 0.5).cast("int").alias("predicted"))
