import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa

from tidewater.llm import ranked_search as R

DOCS = "text STRING, doc_id LONG, rank INT, terms STRING, score DOUBLE"
PATTERN = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")


def plain_terms(text):
    return PATTERN.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items, k=10):
    bags = [(d, Counter(plain_terms(t))) for d, t in docs]
    bags = [(d, c, sum(c.values())) for d, c in bags if c]
    n_docs, length = len(bags), sum(n for _, _, n in bags)
    df = Counter(t for _, c, _ in bags for t in c)
    wanted = defaultdict(set)
    for i, t in items:
        wanted[i] |= set(plain_terms(t))
    out = []
    for i, terms in wanted.items():
        scored = []
        for d, c, n in bags:
            m = 10 + (90 * n * n_docs) // length
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 8 * m))
                    for t in terms if t in c)
            if s > 0:
                scored.append((-s, d is None, d or 0, d))
        out += [(i, r, d, -s) for r, (s, _, _, d) in enumerate(sorted(scored, key=lambda x: x[:3])[:k], 1)]
    return Counter(out)


def frames(spark, docs, items):
    d = spark.createDataFrame([(t, d, 1, "x", 0.5) for d, t in docs], DOCS)
    i = spark.createDataFrame([(i, t, "x", 7) for i, t in items], "item_id LONG, text STRING, terms STRING, doc_id INT")
    return d, i


def case():
    rnd = random.Random(5)
    vocab = [f"{'WwÉé'[i % 4]}ord{i}" for i in range(120)]
    docs = [(rnd.randrange(10**6), " ".join(rnd.choice(vocab[:rnd.randrange(3, 120)]) for _ in range(rnd.randrange(0, 40)))) for _ in range(300)]
    docs += [(1000 + i, "word0 same bag, word5") for i in range(60)]          # one class of many members
    docs += [(2000 + i, "word5-same_word0 bag") for i in range(5)]            # the same bag in another order
    docs += [(7, "word1 tie"), (7, "word1 tie"), (7, "tie word2"), (None, "word1 null id"), (8, None), (9, ""), (10, " .;\n"), (11, "x " * 50_000 + "word3")]
    items = [(i, " ".join(rnd.choice(vocab) for _ in range(8))) for i in range(12)]
    items += [(50, None), (51, ""), (52, "nowhere"), (53, "word0"), (53, "Word5 same"), (53, "Word5 same"), (None, "word1"), (54, "WORD0 bag same word5")]
    return docs, items


def test_equals_brute_force(spark):
    docs, items = case()
    d, i = frames(spark, docs, items)
    assert Counter(tuple(r) for r in R.search(d.repartition(7), i).collect()) == brute(docs, items)


def test_large_vocabulary_and_item_blocks(spark):
    docs, items = case()
    d, i = frames(spark, docs, items)
    got = R.search(d.repartition(3), i, lookup_terms=5, item_block=4).collect()
    assert Counter(tuple(r) for r in got) == brute(docs, items)


def test_other_k(spark):
    docs, items = case()
    d, i = frames(spark, docs, items)
    assert Counter(tuple(r) for r in R.search(d, i, k=3).collect()) == brute(docs, items, 3)


def test_empty_tables(spark):
    d, i = frames(spark, [], [(1, "word")])
    assert R.search(d, i).collect() == []
    d, i = frames(spark, [(1, "word")], [])
    assert R.search(d, i).collect() == []
    assert R.search(d, i.limit(0)).columns == ["item_id", "rank", "doc_id", "score"]


def test_best_keeps_ties_by_first_doc():
    best = R.Best(1, 2)
    best.add(np.array([[5, 5, 5, 4]]), pa.array([[9], [3, 4], [None], [1]], pa.list_(pa.int64())))
    best.add(np.array([[5, 6]]), pa.array([[1], [8]], pa.list_(pa.int64())))
    assert list(best.score) == [6, 5] and [list(d) for d in best.docs] == [[8], [1]]


def test_many_postings_in_pieces(monkeypatch):
    monkeypatch.setattr(R, "CELLS", 3)
    rows = [{"item_id": i, "terms": [1, 2, 5], "weights": [10, 20, 30]} for i in range(4)]
    got = R.Items(rows).scores(np.array([100, 50]), np.array([2, 1]), np.array([1, 3, 5]), np.array([2, 9, 1]))
    assert got.tolist() == [[10 * (2 * 10**9 // 2800), 30 * (10**9 // 1400)]] * 4
