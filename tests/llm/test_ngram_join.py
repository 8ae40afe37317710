import random
import re
from collections import Counter, defaultdict

from tidewater.llm import ngram_join as J

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def lower(t):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")


def brute(rows, k=4, percent=85):
    sets = []
    for _, t in rows:
        w = WORD.findall(lower(t))
        sets.append({tuple(w[i:i + k]) for i in range(max(1, len(w) - k + 1))} if w else set())
    at = list(range(len(rows)))

    def root(i):
        while at[i] != i:
            i = at[i]
        return i
    by = defaultdict(list)
    for i, s in enumerate(sets):
        for x in s:
            by[x].append(i)
    for i, s in enumerate(sets):
        for j, n in Counter(j for x in s for j in by[x] if j < i).items():
            if 100 * n >= percent * (len(s) + len(sets[j]) - n):
                at[root(i)] = root(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[root(i)] = min(d, least.get(root(i), d))
    return Counter((d, len(sets[i]), least.get(root(i)) if sets[i] else d) for i, (d, _) in enumerate(rows))


def run(spark, tmp_path, rows):
    spark.createDataFrame([(d, t, "x", 1) for d, t in rows], "doc_id LONG, text STRING, class STRING, n INT") \
        .write.parquet(f"{tmp_path}/documents.parquet")
    return Counter(tuple(r) for r in J.op9_ngram_jaccard_join(spark, str(tmp_path)).collect())


def edited(words, rnd, n):
    words = list(words)
    for _ in range(n):
        words[rnd.randrange(len(words))] = f"z{rnd.randrange(10**6)}"
    return words


def test_chains_copies_passages_and_edge_rows(spark, tmp_path):
    rnd = random.Random(5)
    vocab = [f"w{i}" for i in range(3000)]
    rows, common = [], [rnd.choice(vocab) for _ in range(40)]
    for i in range(150):
        rows.append((i * 10, " ".join(common + [rnd.choice(vocab) for _ in range(rnd.randrange(5, 120))])))
    base = [rnd.choice(vocab) for _ in range(200)]
    for i in range(120):  # one large group around the threshold, with chains
        base = edited(base, rnd, 1) if i % 4 == 0 else base
        rows.append((5000 + i, " ".join(edited(base, rnd, rnd.randrange(0, 9)))))
    rows += [(7000 + i, rows[3][1].upper()) for i in range(30)]
    rows += [(8000, None), (8001, ""), (8002, " \n"), (8003, "a b"), (8004, "A  B"), (8005, "é b"), (None, rows[5][1]),
             (None, "only null here at all"), (8006, "É b"), (8007, "x " * 5000), (8008, "X " * 6000), (50, "two rows one id"), (50, "two rows one id")]
    assert run(spark, tmp_path, rows) == brute(rows)


def test_empty_table_and_no_links(spark, tmp_path):
    assert run(spark, tmp_path / "a", []) == Counter()
    rows = [(1, "a b c d e"), (2, "f g h i j")]
    assert run(spark, tmp_path / "b", rows) == brute(rows)


def test_query_over_the_given_table(spark):
    d = "/root/testdata/sf0.01"
    rows = [tuple(r) for r in spark.read.parquet(f"{d}/documents.parquet").select("doc_id", "text").collect()]
    assert Counter(tuple(r) for r in J.op9_ngram_jaccard_join(spark, d).collect()) == brute(rows)
