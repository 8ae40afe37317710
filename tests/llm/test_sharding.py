import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from tidewater.llm import sharding as S

DDL = "doc_id LONG, text STRING, source STRING, shard STRING"


def docs(spark, tmp_path, rows):
    spark.createDataFrame(rows, DDL).write.parquet(f"{tmp_path}/documents.parquet")
    return str(tmp_path)


def check(rows, source):
    places = defaultdict(list)
    for r in rows:
        places[r["shard"]].append(r["slot"])
        assert 0 <= r["shard"] < 8 and r["law"] == "key" and r["grown_shard"] in (r["shard"], 8)
    assert all(sorted(p) == list(range(len(p))) for p in places.values())
    want = Counter((d, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for d, t, *_ in source)
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in rows) == want


def test_rows_nulls_copies_and_clashing_columns(spark, tmp_path):
    rows = [(i, f"téxt {i % 7}", "s", "x") for i in range(300)]
    rows += [(None, None, None, None), (None, "a", None, None), (5, "", "s", "x")] + [(7, "same", "s", "x")] * 50
    got = S.op1_virtual_slot_sharding(spark, docs(spark, tmp_path, rows)).collect()
    check(got, rows)
    by_key = defaultdict(set)
    for r in got:
        by_key[r["doc_id"]].add(r["shard"])
    assert all(len(s) == 1 for s in by_key.values())


def test_empty_table(spark, tmp_path):
    assert S.op1_virtual_slot_sharding(spark, docs(spark, tmp_path, [])).count() == 0


def test_growth_equals_the_larger_initial_map_and_spreads(spark):
    grown = {tuple(r) for r in S.grow(S.initial_map(spark, 8), 8).collect()}
    assert grown == {tuple(r) for r in S.initial_map(spark, 9).collect()}
    n = Counter(s for _, s in grown)
    assert set(n) == set(range(9)) and max(n.values()) < 1.3 * 4096 / 9


def test_rebalance_moves_little_and_evens_bytes(spark):
    m = S.initial_map(spark, 8).withColumn("bytes", F.when(F.col("shard") == 3, 900).otherwise(F.lit(100)))
    out = S.rebalance(m, 8)
    load = {r["shard"]: r["b"] for r in out.groupBy("shard").agg(F.sum("bytes").alias("b")).collect()}
    mean = sum(load.values()) / 8
    assert out.count() == 4096 and max(load.values()) < 1.02 * mean
    kept = out.alias("a").join(m.alias("b"), "virtual_slot").filter("a.shard = b.shard").count()
    assert kept > 4096 * 0.75


def test_slot_map_is_one_file_whatever_the_partitions(spark):
    rows = spark.range(500).select((F.col("id") % 40).cast("int").alias("virtual_slot"), F.col("id").alias("size"), F.lit(2).cast("long").alias("n"))
    conf = {"spark.sql.shuffle.partitions": "32", "spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {k: spark.conf.get(k) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        versions = S.stored(spark, S.sized_versions(rows.repartition(32), 8), "slot-map-test")
        got = versions.collect()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert len(versions.inputFiles()) == 1
    want = {r["virtual_slot"]: r["shard"] for r in S.initial_map(spark, 8).collect()}
    assert {r["virtual_slot"]: r["shard"] for r in got if r["version"] == 1} == want
    want = {r["virtual_slot"]: r["shard"] for r in S.initial_map(spark, 9).collect()}
    assert {r["virtual_slot"]: r["shard"] for r in got if r["version"] == 2} == want
    size = {s: (26 if s < 20 else 24, sum(2 * i for i in range(s, 500, 40))) for s in range(40)}
    assert len(got) == 2 * S.SLOTS and all((r["n_rows"], r["bytes"]) == size.get(r["virtual_slot"], (0, 0)) for r in got)


def test_assign_keeps_columns_without_a_shuffle(spark):
    df = spark.createDataFrame([(1, "a", "s")], "doc_id LONG, text STRING, source STRING")
    out = S.assign(df, S.initial_map(spark, 8))
    assert set(df.columns) < set(out.columns) and out.count() == 1


@pytest.mark.parametrize("sf", ["sf0.001"])
def test_query_over_the_given_table(spark, sf):
    d = f"/root/testdata/{sf}"
    rows = spark.read.parquet(f"{d}/documents.parquet").select("doc_id", "text").collect()
    check(S.op1_virtual_slot_sharding(spark, d).collect(), [tuple(r) for r in rows])
