import zlib

import numpy as np

from tidewater.llm import quality_fm as Q


def test_scores_equal_the_plain_double_sum():
    rnd = np.random.default_rng(1)
    m = Q.Model(0.3, rnd.normal(size=Q.FEATURES), rnd.normal(size=(Q.FEATURES, Q.FACTORS)))
    for text in (b"", b"a b a", b"One two,\nthree! | $$$ 12", "é ".encode() * 50):
        ids, x = Q.features(text, None)
        plain = m.bias + sum(m.linear[i] * v for i, v in zip(ids, x))
        plain += sum(m.factors[ids[i]] @ m.factors[ids[j]] * x[i] * x[j] for i in range(len(ids)) for j in range(i))
        assert abs(m.raw(ids, x) - plain) < 1e-8


def test_learns_interactions_and_constant_labels():
    docs = [a + b" " + b for a in (b"p", b"q") for b in (b"r", b"s")] * 100
    y = np.array([float((t[:1] == b"p") == (t[2:] == b"r")) for t in docs])
    rows = [Q.features(t, None) for t in docs]
    many = rows * 20
    m = Q.fit(many, np.tile(y, 20), np.ones(len(many)))
    assert all((m.score(t, None) >= 0.5) == (v == 1) for t, v in zip(docs[:4], y[:4]))
    assert Q.fit([], np.array([]), np.array([])).score(b"x", None) == 0.5
    assert Q.fit(rows, np.ones(len(rows)), np.ones(len(rows))).score(b"x", 3) > 0.9


def test_held_out_accuracy_and_columns(spark):
    d = "/root/testdata/sf0.1"
    got = {r["doc_id"]: r for r in Q.op6_fm_quality(spark, d).collect()}
    labels = spark.read.parquet(f"{d}/labels.parquet").collect()
    assert len(got) == spark.read.parquet(f"{d}/documents.parquet").count()
    assert all(r["held_out"] == (zlib.crc32(str(i).encode()) % 3 == 1) and 0 <= r["score"] <= 1
               and r["predicted"] == int(r["score"] >= 0.5) for i, r in got.items())
    for q in (0, 1):
        part = [got[r["doc_id"]]["predicted"] == q for r in labels
                if r["quality"] == q and r["doc_id"] in got and got[r["doc_id"]]["held_out"]]
        print("label", q, len(part), sum(part) / len(part))
        assert sum(part) / len(part) > 0.95


def test_fits_on_six_thousand_labelled_rows(spark, monkeypatch):
    docs = spark.range(12_000).selectExpr("id AS doc_id", "concat('word ', id) AS text")
    seen = []
    monkeypatch.setattr(Q, "fit", lambda rows, y, weights: seen.append(len(rows)))
    Q.train(docs, docs.selectExpr("doc_id", "CAST(doc_id % 2 AS INT) AS quality"))
    assert seen == [6000]


def test_edge_rows_missing_columns_and_empty_tables(spark, tmp_path):
    rows = [(i, "good plain words here. " * 9 if i % 2 else "$$$ ### !!! " * 9, "x") for i in range(60)]
    rows += [(None, None, None), (100, "", "x"), (101, "w " * 40_000, "x"), (3, rows[3][1], "x")]
    spark.createDataFrame(rows, "doc_id LONG, text STRING, score STRING").write.parquet(f"{tmp_path}/documents.parquet")
    labels = [(i, i % 2, 0) for i in range(60)] + [(None, 1, None), (5, None, 1), (999, 1, 0)]
    spark.createDataFrame(labels, "doc_id LONG, quality INT, toxic INT").write.parquet(f"{tmp_path}/labels.parquet")
    got = Q.op6_fm_quality(spark, str(tmp_path)).collect()
    assert len(got) == 64 and all(r["predicted"] == r["doc_id"] % 2 for r in got if r["doc_id"] is not None and r["doc_id"] < 60)
    for name, ddl in (("documents", "doc_id LONG, text STRING"), ("labels", "doc_id LONG, quality INT")):
        spark.createDataFrame([], ddl).write.parquet(f"{tmp_path}/e/{name}.parquet")
    assert Q.op6_fm_quality(spark, f"{tmp_path}/e").count() == 0
