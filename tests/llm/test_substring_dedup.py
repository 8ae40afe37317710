import hashlib
import random
import re
from collections import Counter

import numpy as np

from tidewater.llm import substring_dedup as S

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(rows, m=50):
    words = [WORD.findall(t or "") for _, t in rows]
    least = {}
    for (d, _), w in zip(rows, words):
        for i in range(len(w) - m + 1):
            k = tuple(w[i:i + m])
            if d is not None and d < least.get(k, d + 1):
                least[k] = d
    out, texts = [], []
    for (d, _), w in zip(rows, words):
        gone = set()
        for i in range(len(w) - m + 1):
            if d is not None and least[tuple(w[i:i + m])] < d:
                gone.update(range(i, i + m))
        kept = " ".join(x for i, x in enumerate(w) if i not in gone)
        out.append((d, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
        texts.append((d, kept))
    return Counter(out), Counter(texts)


def write(spark, path, rows):
    spark.createDataFrame([(d, t, "x") for d, t in rows], "doc_id LONG, text STRING, windows STRING").write.parquet(f"{path}/documents.parquet")
    return str(path)


def sample():
    rnd = random.Random(3)
    vocab = [f"w{i}" for i in range(500)]
    say = lambda n: [rnd.choice(vocab) for _ in range(n)]
    passages = [say(n) for n in (49, 50, 51, 80, 200)]
    rows = []
    for i in range(120):
        w = say(rnd.randrange(0, 90))
        for p in rnd.sample(passages, rnd.randrange(0, 3)):
            at = rnd.randrange(len(w) + 1)
            w[at:at] = p
        rows.append((i * 7 % 121, "  ".join(w) if i % 2 else "\n".join(w)))
    rows += [(200 + i, rows[4][1]) for i in range(20)]
    rows += [(300, None), (301, ""), (302, "same " * 3000), (303, "same " * 60), (303, "same " * 60), (None, rows[8][1]),
             (304, "Same " * 60), (7, rows[9][1]), (305, " ".join(say(20_000) + passages[4]))]
    return rows


def test_query_and_texts_equal_brute_force(spark, tmp_path):
    rows = sample()
    d = write(spark, tmp_path, rows)
    digests, texts = brute(rows)
    assert Counter(tuple(r) for r in S.op8_substring_dedup(spark, d).collect()) == digests
    out = S.dedup_documents(spark.read.parquet(f"{d}/documents.parquet")).collect()
    assert Counter((r["doc_id"], r["text"]) for r in out) == texts
    assert all(a["end"] < b["start"] for r in out for a, b in zip(r["removed"], r["removed"][1:]))


def test_empty_table(spark, tmp_path):
    assert S.op8_substring_dedup(spark, write(spark, tmp_path, [])).count() == 0


def test_rows_of_one_doc_id_list_each_segment_once(spark):
    text = " ".join(f"w{i}" for i in range(300))
    sizes = []
    for k in (1, 40):
        docs = spark.createDataFrame([(1, text)] + [(2, "first " + text)] * k, "doc_id LONG, text STRING")
        lists = {r["doc_id"]: [(s["anchor"], s["seg"]) for s in r["segments"]] for r in S.removal_lists(docs, 50).collect()}
        assert list(lists) == [2] and len(set(lists[2])) == len(lists[2])
        sizes.append(len(lists[2]))
    assert sizes[0] == sizes[1] > 10


def test_rolling_hashes_and_anchors_follow_content():
    words = [b"w%d" % (i % 37) for i in range(400)]
    w = S.Windows(words)
    assert (w.rolling(25)[5:100] == S.Windows(words[5:124]).rolling(25)).all()
    low = [min(w.rolling(25)[i:i + 26]) for i in range(351)]
    assert (w.anchors(50) == np.array(low)).all() and len(w.anchors(50)) == 351


def test_query_over_the_given_table(spark):
    d = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{d}/documents.parquet").select("doc_id", "text").collect()]
    assert Counter(tuple(r) for r in S.op8_substring_dedup(spark, d).collect()) == brute(rows)[0]
