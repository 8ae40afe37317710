import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidewater.llm import collocations as C

DDL = "lang STRING, text STRING, phrase STRING, a INT, rank STRING, doc_id LONG"


def frame(spark, docs):
    return spark.createDataFrame([(l, t, "x", 1, "r", 1) for l, t in docs], DDL)


def brute(docs, top, least=10, max_words=3, drop=50):
    counts = defaultdict(Counter)
    for lang, text in docs:
        text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", text):
            words = re.findall("[^ \t]+", piece)
            for k in (1, 2, 3):
                for i in range(len(words) - k + 1):
                    counts["und" if lang is None else lang][tuple(words[i:i + k])] += 1
    out = []
    for lang, f in counts.items():
        n = sum(c for p, c in f.items() if len(p) == 1)
        cand = {p: c for p, c in f.items() if 2 <= len(p) <= max_words and c >= least}
        rows = []
        for p, a in cand.items():
            if any(len(q) > len(p) and p in (q[:2], q[1:]) and 100 * c >= drop * a for q, c in cand.items()):
                continue
            cuts = [(10**6 * a * a // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p))]
            s, k = min(cuts)
            rows.append((-s, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        out += [(lang, i, p.decode(), -a, l, r, n, -s) for i, (s, a, p, l, r) in enumerate(sorted(rows)[:top], 1)]
    return Counter(out)


def corpus(seed=3, docs=120):
    rnd = random.Random(seed)
    vocab = [f"{'wWéß'[i % 4]}{i}" for i in range(40)]
    fixed = ["red hot iron", "New York city", "x y z", "one\ttwo  three", "alpha beta", "ça va bien"]
    out = []
    for i in range(docs):
        words = []
        for _ in range(rnd.randrange(5, 90)):
            words.append(rnd.choice(fixed) if rnd.random() < 0.25 else vocab[int(rnd.random() ** 2 * 40)])
            if rnd.random() < 0.15:
                words[-1] += rnd.choice(".,;:!?\n\r\x0b")
        out.append((rnd.choice(["en", "en", "en", "de", None, "und", ""]), " ".join(words)))
    return out + [("en", None), ("fr", ""), ("fr", " . "), ("en", "a " * 40_000), ("en", "a b\x1cc \x00d " * 12)] + [("it", "uno due tre. quattro cinque")] * 11


def got(spark, docs, **kw):
    return Counter(tuple(r) for r in C.collocations(frame(spark, docs).repartition(5), **kw).collect())


def test_equals_brute_force(spark):
    assert got(spark, corpus()) == brute(corpus(), 2000)


def test_thresholds_are_lowered_until_settled(spark, monkeypatch):
    """The best pairs fall to triples that score far lower, so the first threshold settles nothing in en."""
    rounds = []
    real = C.triple_counts
    monkeypatch.setattr(C, "triple_counts", lambda *a: rounds.append(1) or real(*a))
    docs = [("en", f"p{i} q{i} {z}") for i in range(30) for z in ("r", "s") for _ in range(10)]
    docs += [("en", f"m{i} n{i}. n{i}. m{i}") for i in range(40) for _ in range(10 + i)] + [("de", f"p{i} q{i}") for i in range(20) for _ in range(10)]
    assert got(spark, docs, top=15, frontier=1) == brute(docs, 15)
    assert len(rounds) > 1


def test_two_words_and_other_bounds(spark):
    docs = corpus(5)
    assert got(spark, docs, max_words=2, top=30) == brute(docs, 30, max_words=2)
    assert got(spark, docs, least=3, drop_percent=90, top=60) == brute(docs, 60, least=3, drop=90)
    with pytest.raises(ValueError):
        C.collocations(frame(spark, docs), max_words=4)


def test_many_ties_at_the_last_rank(spark):
    docs = [("en", f"p{i} q{i} r{i}. s{i} t{i}") for i in range(60) for _ in range(10)]
    assert got(spark, docs, top=25, frontier=1) == brute(docs, 25)


def test_full_bitmaps_change_nothing(spark, monkeypatch):
    monkeypatch.setattr(C, "MAP_BITS", 64)
    monkeypatch.setattr(C, "BUFFER", 500)
    docs = corpus(6, 60)
    assert got(spark, docs, top=40) == brute(docs, 40)


def test_bitmap_holds_its_keys(spark):
    words = spark.createDataFrame([("en", f"w{i}") for i in range(5000)], "lang STRING, phrase STRING")
    b = C.bitmap(words)
    assert b.has(np.array([C.word_hash("en", f"w{i}".encode()) for i in range(5000)], np.uint64)).all()
    assert b.has(np.array([C.word_hash("de", f"w{i}".encode()) for i in range(5000)], np.uint64)).mean() < 0.1


def test_products_past_64_bits(spark):
    rows = [(3 * 10**13, 5 * 10**13, 4 * 10**13), (10, 10, 10), (10**12 + 7, 10**12 + 9, 10**13 + 11)]
    df = spark.createDataFrame(rows, "a LONG, l LONG, r LONG").select("a", "l", "r", C.ratio("a", "l", "r").alias("s"))
    assert all(s == 10**6 * a * a // (l * r) for a, l, r, s in df.collect())


def test_empty_tables(spark):
    assert got(spark, []) == Counter()
    assert got(spark, [("en", None), (None, "")]) == Counter()
    assert C.collocations(frame(spark, []).limit(0)).columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
