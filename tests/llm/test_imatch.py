import hashlib
import random
from collections import Counter
from statistics import mean

import numpy as np

from tidewater.llm import imatch as M


def write(spark, path, rows):
    spark.createDataFrame([(d, t, 1) for d, t in rows], "doc_id LONG, text STRING, range INT").write.parquet(f"{path}/documents.parquet")
    return str(path)


def brute(rows, band):
    """Results by a plain sort; the band comes from a plain count."""
    order = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), r[1] or ""))
    out = []
    for (d, t), (_, nxt) in zip(order, order[1:] + order[:1]):
        t, nxt = t or "", nxt or ""
        e = t[:len(t) - len(t) // 2] + nxt[:len(t) // 2]
        a, b, c = (M.fingerprint(x.encode(), band) for x in (t, e, nxt))
        out.append((d, len(t), hashlib.sha256(e.encode()).hexdigest(), "".join(a), "".join(b), M.likeness(a, b), M.likeness(a, c)))
    return Counter(out)


def plain_band(rows):
    counts = np.zeros(M.CELLS, int)
    for _, t in rows:
        for c in {int(x) % M.CELLS for x in M.term_set((t or "").encode())}:
            counts[c] += 1
    n = len(rows)
    return (counts >= max(2, 0.001 * n)) & (counts <= max(2, 0.05 * n))


def test_neighbours_over_many_ranges_with_ties(spark, tmp_path):
    rnd = random.Random(2)
    vocab = [f"w{i}" for i in range(800)]
    rows = [(rnd.randrange(10**6), " ".join(rnd.choice(vocab) for _ in range(rnd.randrange(0, 60))) + "é" * (i % 3)) for i in range(300)]
    rows += [(1, "tied one"), (1, "tied two"), (1, "tied one"), (10**9, "top"), (10**9, "top b"), (-5, ""), (-6, " \n"), (None, "null id"),
             (None, ""), (2, "x " * 30_000)]
    got = Counter(tuple(r) for r in M.op5_imatch(spark, write(spark, tmp_path, rows)).collect())
    assert got == brute(rows, plain_band(rows))


def test_single_row_and_empty_table(spark, tmp_path):
    one = M.op5_imatch(spark, write(spark, tmp_path / "a", [(5, "a b c d")])).collect()
    assert len(one) == 1 and one[0]["near_next"] == 1.0 and one[0]["n_chars"] == 7
    assert M.op5_imatch(spark, write(spark, tmp_path / "b", [])).count() == 0


def test_terms_ignore_case_order_and_punctuation():
    band = np.zeros(M.CELLS, bool)
    assert M.fingerprint(b"The cat, sat. cat", band) == M.fingerprint(b"sat CAT (the)", band) != M.fingerprint(b"the cat", band)
    assert M.likeness(M.fingerprint(b"", band), M.fingerprint(b"--", band)) == 1.0
    assert M.likeness(M.fingerprint(b"", band), M.fingerprint(b"a", band)) == 0.0


def test_query_over_the_given_table_tells_edits_from_strangers(spark):
    d = "/root/testdata/sf0.01"
    rows = [tuple(r) for r in spark.read.parquet(f"{d}/documents.parquet").select("doc_id", "text").collect()]
    got = [tuple(r) for r in M.op5_imatch(spark, d).collect()]
    assert Counter(got) == brute(rows, plain_band(rows))
    near, strange = mean(r[5] for r in got), mean(r[6] for r in got)
    print("near_edited", near, "near_next", strange, sum(r[5] > r[6] for r in got) / len(got))
    assert near > 4 * strange
