import base64
import hashlib
from collections import Counter

import corpus_pipeline as C
import numpy as np
import public_tokenizers as P
import tiktoken
from tests.llm import test_decontaminate as D
from tests.llm import test_ngram_join as J
from tests.llm import test_secrets as S

from tidewater.llm import quality_fm as Q

PATH = P.path("byte_bpe_multi_50k.tiktoken")


def brute(rows, scores):
    """The pipeline's rows by plain loops, given the quality scores."""
    rows = [r for r in rows if scores[r[0]] >= C.LEAST_QUALITY]
    items = rows_of.items
    firsts = {k[2] for k in J.brute(rows, C.SHINGLE, C.PERCENT)}
    rows = [r for r in rows if r[0] in firsts]
    leaked = {d for d, _, _ in D.brute(rows, items)}
    rows = [r for r in rows if r[0] not in leaked]
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(PATH, "rb"))}
    enc = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    out = Counter()
    for d, t in rows:
        at, res = 0, ""
        for s, _, e in S.brute(t):
            if s >= at:
                res += (t or "")[at:s] + "[SECRET]"
            at = max(at, e)
        res += (t or "")[at:]
        ids = enc.encode_ordinary(res)
        out[(d, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(res.encode()).hexdigest())] += 1
    return out


class rows_of:
    items = []


def check(spark, d):
    docs = spark.read.parquet(f"{d}/documents.parquet")
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    rows_of.items = [tuple(r) for r in spark.read.parquet(f"{d}/benchmark.parquet").select("item_id", "text").collect()]
    scores = {r["doc_id"]: r["score"] for r in Q.scores(docs, Q.train(docs, spark.read.parquet(f"{d}/labels.parquet"))).collect()}
    got = Counter(tuple(r)[:4] for r in C.run(spark, d).collect())
    assert got == brute(rows, scores)
    return rows, got


def test_run_equals_brute_force_over_the_given_tables(spark):
    rows, got = check(spark, "/root/testdata/sf0.001")
    assert 0 < len(got) < len(rows)


def test_stages_keep_the_columns_of_documents(spark):
    d = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{d}/documents.parquet").limit(40).cache()
    try:
        for _, stage in C.STAGES[:-1]:
            out = stage(spark, docs, d)
            assert out.columns == docs.columns and [f.dataType for f in out.schema] == [f.dataType for f in docs.schema]
    finally:
        docs.unpersist()


def test_edge_rows_and_empty_tables(spark, tmp_path):
    text = "one two three four five six seven eight nine ten. " * 3
    rows = [(1, text), (2, text), (2, text), (3, None), (4, ""), (None, text + "x"), (5, "password=hunter22 and more words")]
    spark.createDataFrame([(d, t, "en", "s", None) for d, t in rows], "doc_id LONG, text STRING, lang STRING, source STRING, n_chars LONG") \
        .write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id LONG, quality INT, toxic INT").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([], "item_id LONG, text STRING").write.parquet(f"{tmp_path}/benchmark.parquet")
    got = sorted(r["doc_id"] for r in C.run(spark, str(tmp_path)).collect())
    assert got == [1, 3, 4, 5]
    spark.createDataFrame([], "doc_id LONG, text STRING, lang STRING, source STRING, n_chars LONG").write.parquet(f"{tmp_path}/e/documents.parquet")
    for name, ddl in (("labels", "doc_id LONG, quality INT"), ("benchmark", "item_id LONG, text STRING")):
        spark.createDataFrame([], ddl).write.parquet(f"{tmp_path}/e/{name}.parquet")
    assert C.run(spark, f"{tmp_path}/e").count() == 0
