import hashlib
import random
import re
from collections import Counter

from tidewater.llm import secrets as S

ASSIGN = re.compile(r"""((?:[pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY]))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
SIMPLE = {"access": (re.compile(r"AKIA[A-Z0-9]+"), 20), "hex": (re.compile(r"[0-9a-f]+"), 24)}


def brute(t):
    """All spans (start, kind, end) of a text, by plain loops over pairs."""
    t = t or ""
    out = [(m.start(), S.ASSIGN, m.end()) for m in ASSIGN.finditer(t) if len(m[2]) >= 6]
    for k, name in ((S.ACCESS, "access"), (S.HEX, "hex")):
        p, least = SIMPLE[name]
        out += [(m.start(), k, m.end()) for m in p.finditer(t) if m.end() - m.start() >= least]
    weak = [(m.start(), k, m.end()) for k in (S.KEY, S.USER, S.ENDPOINT) for m in re.finditer(S.PATTERNS[k], t)]
    every = out + weak
    kept = []
    for s, k, e in weak:
        near = {k2 for s2, k2, e2 in every if k2 != k and s2 < e + S.SCOPE and e2 > s - S.SCOPE}
        ident, secret = near & {S.ACCESS, S.USER}, near & {S.ASSIGN, S.KEY}
        ok = {S.KEY: ident, S.USER: secret and S.ENDPOINT in near, S.ENDPOINT: ident and secret}[k]
        if ok and not any(k2 <= S.HEX and s2 < e and e2 > s for s2, k2, e2 in out):
            kept.append((s, k, e))
    return sorted(out + kept)


def told(spans):
    return ",".join(f"{S.KINDS[k]}:{s}:{e}" for s, k, e in spans)


def want(rows):
    out = Counter()
    for d, t in rows:
        sp = brute(t)
        n = Counter(k for _, k, _ in sp)
        base = told([x for x in sp if x[1] <= S.HEX])
        out[(d, n[0], n[1], n[2], hashlib.sha256(base.encode()).hexdigest(), told(sp))] += 1
    return out


def sample():
    rnd = random.Random(4)
    bits = ["password=hunter22", "Secret : 'abc'", "token=\"" + "0a1b2c3d" * 5 + "\"", "API_KEY:x+/=_.-y", "apikey=short", "secret=token : abcdefgh",
            "AKIA" + "Q7" * 8, "AKIAAKIA12", "AKIA" + "Z" * 40, "deadbeef" * 3, "deadbeef" * 2, "Ab1+" * 10, "xAb1+" * 8 + "=", "user: bob.smith",
            "login=al", "https://db.example.com:5432/x?y=1", "http://h/", "é日🙂", "\n", "\n\n", "PASSWORD = 'é", "token==abcdef", "tokentoken=abcdef"]
    rows = []
    for i in range(250):
        fill = [" ".join("w" * rnd.randrange(1, 9) for _ in range(rnd.randrange(0, 60))) for _ in range(8)]
        rows.append((i, " ".join(x for f in fill for x in (rnd.choice(bits), f))))
    rows += [(1000, None), (1001, ""), (1002, "password=" + "x" * 100_000), (1003, "token=abcdefg " * 20_000), (None, bits[0]), (5, rows[5][1]),
             (5, rows[5][1]), (6, "AKIA" + "Q7" * 8 + " " + "Ab1+" * 10 + " https://a.b/c")]
    return rows


def test_spans_equal_brute_force(spark, tmp_path):
    rows = sample()
    spark.createDataFrame([(d, t, "x") for d, t in rows], "doc_id LONG, text STRING, spans STRING").write.parquet(f"{tmp_path}/documents.parquet")
    got = Counter(tuple(r) for r in S.op4_secret_scan(spark, str(tmp_path)).collect())
    assert got == want(rows)
    assert all(any(f"{k}:" in r[5] for r in got) for k in S.KINDS)


def test_masked_keeps_rows_and_columns(spark):
    rows = [r for r in sample() if r[0] != 1003]
    df = spark.createDataFrame([(d, t, "x", 3) for d, t in rows], "doc_id LONG, text STRING, raw STRING, rid INT")
    out = S.masked(df)
    assert out.columns == df.columns

    def plain(t):
        at, res = 0, ""
        for s, _, e in brute(t):
            if s >= at:
                res += t[at:s] + S.MASK
            at = max(at, e)
        return None if t is None else res + t[at:]
    assert Counter((r["doc_id"], r["text"]) for r in out.collect()) == Counter((d, plain(t)) for d, t in rows)


def test_empty_table_and_no_python_in_the_plan(spark, tmp_path):
    spark.createDataFrame([], "doc_id LONG, text STRING").write.parquet(f"{tmp_path}/documents.parquet")
    df = S.op4_secret_scan(spark, str(tmp_path))
    assert df.count() == 0 and "Python" not in df._jdf.queryExecution().toString()


def test_query_over_the_given_table(spark):
    d = "/root/testdata/sf0.01"
    rows = [tuple(r) for r in spark.read.parquet(f"{d}/documents.parquet").select("doc_id", "text").collect()]
    assert Counter(tuple(r) for r in S.op4_secret_scan(spark, d).collect()) == want(rows)
