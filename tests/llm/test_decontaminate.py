import random
import string
from collections import Counter

import numpy as np
import pytest

from tidewater.llm import decontaminate as D

TABLE = str.maketrans("", "", string.punctuation)


def shingles(t):
    w = (t or "").lower().translate(TABLE).split()
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)}


def brute(docs, items):
    out = Counter()
    sets = [(i, shingles(t)) for i, t in items]
    for d, t in docs:
        s = shingles(t)
        for i, q in sets:
            if q and len(q & s) / len(q) >= 0.8:
                out[(d, i, len(q & s) / len(q))] += 1
    return out


@pytest.fixture(scope="module")
def planted():
    rnd = random.Random(8)
    say = lambda n: [f"w{rnd.randrange(4000)}" for _ in range(n)]
    items = [(i, say(rnd.choice((5, 6, 9, 20, 45, 59, 130)))) for i in range(60)]
    docs = []
    for i in range(160):
        w = say(rnd.randrange(0, 900))
        for _ in range(rnd.randrange(0, 3)):
            p = list(rnd.choice(items)[1])
            for _ in range(rnd.randrange(0, 3)):
                p[rnd.randrange(len(p))] = "changed"
            p = p[:len(p) - rnd.randrange(0, max(1, len(p) // 5))]
            at = rnd.randrange(len(w) + 1)
            w[at:at] = p
        docs.append((i, " ".join(x.upper() + "," if rnd.random() < .2 else x for x in w)))
    items = [(i, " ".join(w)) for i, w in items]
    items += [(100, None), (101, ""), (102, "just four words here"), (103, items[0][1]), (None, items[1][1])]
    docs += [(500, None), (501, ""), (502, items[2][1]), (503, "x " * 30_000 + items[5][1]), (None, items[6][1]), (4, docs[3][1]), (502, items[2][1])]
    return docs, items


@pytest.mark.parametrize("block", [5000, 7])
def test_leaks_equal_brute_force(spark, planted, block):
    docs, items = planted
    d = spark.createDataFrame([(a, b, "x") for a, b in docs], "doc_id LONG, text STRING, item_id STRING")
    q = spark.createDataFrame([(a, b, 1) for a, b in items], "item_id LONG, text STRING, doc_id INT")
    got = Counter(tuple(r) for r in D.leaks(d, q, block=block).collect())
    assert got == brute(docs, items) and len(got) > 60
    kept = Counter((r["doc_id"], r["text"]) for r in D.without_leaks(d, q, block=block).collect())
    bad = {t for _, t in docs if any(brute([(0, t)], items))}
    assert kept == Counter((a, b) for a, b in docs if b not in bad)


def test_empty_tables(spark, tmp_path):
    d = spark.createDataFrame([(1, "a b c d e f")], "doc_id LONG, text STRING")
    none = spark.createDataFrame([], "item_id LONG, text STRING")
    assert D.leaks(d, none).count() == 0 and D.without_leaks(d, none).count() == 1
    item = spark.createDataFrame([(1, "a b c d e f")], "item_id LONG, text STRING")
    assert D.leaks(spark.createDataFrame([], "doc_id LONG, text STRING"), item).count() == 0


def test_window_minima_are_minima_over_windows():
    rnd = np.random.default_rng(3)
    m = rnd.integers(0, 1000, (2, 23)).astype(np.uint64)
    for limit in (8, 16, 64):
        got = D.window_minima(m, limit)
        span, stride = 2 * limit // D.BLOCK, max(1, limit // 2 // D.BLOCK)
        want = [[min(row[i:i + span]) for i in range(0, 23, stride)] for row in m]
        assert (got == np.array(want)).all()


@pytest.mark.parametrize("contained", [0.8, 0.5])
def test_items_of_few_shingles_are_never_missed(contained):
    rnd = random.Random(5)
    say = lambda n: [f"v{rnd.randrange(10**6)}" for _ in range(n)]
    items = [say(5 + i % 8) for i in range(1200)]
    tables = D.Items([" ".join(w).encode() for w in items], contained)
    for i, w in enumerate(items):
        n = len(w) - 4
        held = w[:4 + next(k for k in range(1, n + 1) if k / n >= contained)]  # just enough of it
        assert [j for j, _ in tables.matches(" ".join(say(i % 20) + held + say(40)).encode())] == [i]


def test_query_over_the_given_table(spark):
    d = "/root/testdata/sf0.01"
    docs = [tuple(r) for r in spark.read.parquet(f"{d}/documents.parquet").select("doc_id", "text").collect()]
    items = [tuple(r) for r in spark.read.parquet(f"{d}/benchmark.parquet").select("item_id", "text").collect()]
    assert Counter(tuple(r) for r in D.op3_benchmark_decontamination(spark, d).collect()) == brute(docs, items)
