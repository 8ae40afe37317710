import json
import time

import pytest
from pyspark.sql import functions as F

from helpers import as_set, state
from tidewater.operators.changes import latest_per_key
from tidewater.session import scratch_path
from tidewater.sources import folders, fs, tables


def rows(spark, *r):
    return state(spark, list(r))


def test_versions_merge_delete_and_feed(spark):
    path = scratch_path(spark, "t")
    assert not tables.table_exists(spark, path)
    assert tables.table_schema(spark, path).fields == []
    tables.merge(spark, path, rows(spark, ("A", "INSERT", "100", "1"), ("B", "INSERT", "100", None)), ["RRN"])
    tables.merge(spark, path, rows(spark, ("A", "UPDATE", "101", "2"), ("C", "INSERT", "101", "3")), ["RRN"])
    assert tables.latest_version(spark, path) == 1
    assert as_set(tables.read_table(spark, path), "RRN", "AMOUNT") == {("A", "2"), ("B", None), ("C", "3")}
    # NULL predicate keeps the row
    tables.delete_where(spark, path, F.col("AMOUNT") == "2")
    assert as_set(tables.read_table(spark, path), "RRN") == {("B",), ("C",)}
    assert tables.delete_where(spark, path, F.col("AMOUNT") == "nope") == 2     # nothing matched: no new version
    feed = tables.read_change_feed(spark, path, 1)
    assert as_set(feed, "RRN", "_change_type", "_commit_version") == {
        ("A", "update_preimage", 1), ("A", "update_postimage", 1), ("C", "insert", 1), ("A", "delete", 2)}
    assert feed.filter(F.col("_commit_timestamp").isNull()).count() == 0
    tables.merge(spark, path, rows(spark, ("A", "INSERT", "103", "9"), (None, "INSERT", "103", "n")), ["RRN"])
    assert as_set(tables.read_table(spark, path), "RRN", "AMOUNT") == {("A", "9"), ("B", None), ("C", "3"), (None, "n")}


def test_uncommitted_data_are_invisible(spark):
    path = scratch_path(spark, "t")
    tables.overwrite(spark, path, rows(spark, ("A", "INSERT", "100", "1")), ["RRN"])
    rows(spark, ("Z", "INSERT", "200", "9")).withColumn("_row_kind", F.lit("C")).withColumn("_bucket", F.lit("16-1")) \
        .write.partitionBy("_bucket", "_row_kind").parquet(f"{path}/_dir=00000000000000000001-failed")
    assert as_set(tables.read_table(spark, path), "RRN") == {("A",)}
    tables.merge(spark, path, rows(spark, ("B", "INSERT", "101", "2")), ["RRN"])
    assert as_set(tables.read_table(spark, path), "RRN") == {("A",), ("B",)}
    assert tables.merge(spark, path, rows(spark), ["RRN"]) is None


def test_merge_rewrites_only_touched_buckets(spark):
    path = scratch_path(spark, "t")
    tables.merge(spark, path, rows(spark, *[(f"K{i}", "INSERT", "100", str(i)) for i in range(200)]), ["RRN"], buckets=16)
    before = tables._latest(spark, path)["buckets"]
    tables.merge(spark, path, rows(spark, ("K7", "UPDATE", "101", "x"), ("NEW", "INSERT", "101", "n")), ["RRN"])
    after = tables._latest(spark, path)["buckets"]
    assert sum(after[b] != e for b, e in before.items()) <= 2
    cur = tables.read_table(spark, path)
    assert cur.count() == 201
    assert as_set(cur.filter(F.col("RRN").isin("K7", "NEW", "K8")), "RRN", "AMOUNT") == {("K7", "x"), ("NEW", "n"), ("K8", "8")}


def test_more_touched_buckets_than_any_limit_and_growth(spark):
    path = scratch_path(spark, "t")
    tables.merge(spark, path, rows(spark, *[(f"K{i}", "INSERT", "100", "a") for i in range(10)]), ["RRN"], buckets=1, bucket_bytes=2000)
    for step in range(1, 5):
        tables.merge(spark, path, rows(spark, *[(f"K{i}", "UPDATE", f"10{step}", f"{step}-{i}") for i in range(600 * step)]), ["RRN"],
                     bucket_bytes=2000)
    meta = tables._latest(spark, path)
    assert len(meta["buckets"]) > 8 and meta["modulus"] > 8
    got = as_set(tables.read_table(spark, path), "RRN", "AMOUNT")
    assert got == {(f"K{i}", f"4-{i}") for i in range(2400)}
    tables.merge(spark, path, rows(spark, ("K3", "UPDATE", "999", "one")), ["RRN"], bucket_bytes=2000)
    assert as_set(tables.read_table(spark, path), "RRN", "AMOUNT") == (got - {("K3", "4-3")}) | {("K3", "one")}


def test_many_bucket_folders_plan_fast(spark):
    path = scratch_path(spark, "t")
    tables.merge(spark, path, rows(spark, *[(f"K{i}", "INSERT", "100", "a") for i in range(3000)]), ["RRN"], buckets=1024)
    for i in range(0, 60, 3):
        tables.merge(spark, path, rows(spark, (f"K{i}", "UPDATE", "101", "b")), ["RRN"])
    t0 = time.time()
    plan = tables.read_table(spark, path)
    plan._jdbc_plan = plan._jdf.queryExecution().executedPlan().toString()
    assert time.time() - t0 < 30 and plan.count() == 3000      # one folder a bucket, no chain of conditions


def test_data_column_named_like_layout_columns(spark):
    path = scratch_path(spark, "t")
    df = spark.createDataFrame([("A", "100", 1, 2)], "RRN STRING, _changeSequence STRING, V BIGINT, BUCKET BIGINT")
    tables.merge(spark, path, df, ["RRN"], buckets=4)
    tables.merge(spark, path, spark.createDataFrame([("A", "101", 3, 4)], df.schema), ["RRN"])
    assert as_set(tables.read_table(spark, path), "RRN", "V", "BUCKET") == {("A", 3, 4)}


def test_a_version_is_committed_once_and_whole(spark):
    path = scratch_path(spark, "t")
    tables.overwrite(spark, path, rows(spark, ("A", "INSERT", "100", "1")), ["RRN"])
    prev = tables._latest(spark, path)
    name = tables._commit_path(path, 1)
    assert fs.create_new(spark, name, json.dumps(dict(prev, version=1)))
    assert not fs.create_new(spark, name, "{}")
    assert json.loads(fs.read_text(spark, name))["version"] == 1
    assert not [n for n in fs.list_names(spark, f"{path}/_commits") if n.endswith(".tmp")]
    with pytest.raises(tables.ConcurrentWriteError):
        tables._commit(spark, path, rows(spark, ("B", "INSERT", "1", "1")).withColumn("_row_kind", F.lit("C")), "merge", ["RRN"], prev, [], 16)


def test_merge_leaves_no_cached_frames(spark):
    def cached():
        return {i.id() for i in spark.sparkContext._jsc.sc().getRDDStorageInfo() if i.numCachedPartitions()}
    path, before = scratch_path(spark, "t"), cached()
    tables.merge(spark, path, rows(spark, ("A", "INSERT", "100", "1")), ["RRN"])
    tables.merge(spark, path, rows(spark, ("A", "UPDATE", "101", "2")), ["RRN"])
    assert cached() <= before


def test_a_large_bucket_splits_alone(spark):
    path = scratch_path(spark, "t")
    tables.merge(spark, path, rows(spark, *[(f"K{i}", "INSERT", "100", "a") for i in range(40)]), ["RRN"], buckets=4)
    name = spark.createDataFrame([(f"L{i}",) for i in range(4000)], "RRN STRING").withColumn("b", tables.bucket_of(["RRN"], 4))
    big = [r["RRN"] for r in name.filter("b = '4-1'").collect()]
    tables.merge(spark, path, rows(spark, *[(k, "INSERT", "100", f"value of {k}" * 5) for k in big]), ["RRN"], bucket_bytes=1 << 30)
    sizes = {b: s for b, (_, s) in tables._latest(spark, path)["buckets"].items()}
    assert sizes["4-1"] > 3 * max(s for b, s in sizes.items() if b != "4-1")
    limit = sizes["4-1"] // 3
    tables.merge(spark, path, rows(spark, *[(f"K{i}", "UPDATE", "101", "b") for i in range(40)]), ["RRN"], bucket_bytes=limit)
    now = set(tables._latest(spark, path)["buckets"])
    assert {b for b in now if b.startswith("4-")} == {"4-0", "4-2", "4-3"} and {b.split("-")[0] for b in now} == {"4", "16"}
    got = {r["RRN"]: r["AMOUNT"] for r in tables.read_table(spark, path).collect()}
    assert got == {**{f"K{i}": "b" for i in range(40)}, **{k: f"value of {k}" * 5 for k in big}}
    # new keys of a slot without a bucket of its own, and of each level
    more = [(f"N{i}", "INSERT", "100", "n") for i in range(200)]
    tables.merge(spark, path, rows(spark, *more), ["RRN"])
    assert tables.read_table(spark, path).count() == 40 + len(big) + 200


def test_a_bucket_of_few_rows_does_not_split_for_what_its_files_take(spark):
    path = scratch_path(spark, "t")
    tables.merge(spark, path, rows(spark, *[(f"K{i}", "INSERT", "100", "a") for i in range(20)]), ["RRN"], buckets=1, bucket_bytes=4000)
    for step in range(1, 5):
        changed = [(f"K{i}", "UPDATE", f"10{step}", f"v{step}") for i in range(10)] + [(f"N{step}", "INSERT", "100", "n")]
        tables.merge(spark, path, rows(spark, *changed), ["RRN"], bucket_bytes=4000)
    meta = tables._latest(spark, path)
    assert len(meta["buckets"]) == 1 and meta["buckets"]["1-0"][1] > 4000   # all its files, pre images too
    assert tables.read_table(spark, path).count() == 24


def test_many_small_buckets_are_written_by_several_tasks(spark):
    path = scratch_path(spark, "t")
    all_rows = [(f"K{i}", "INSERT", "100", "a") for i in range(400)]
    tables.merge(spark, path, rows(spark, *all_rows), ["RRN"], buckets=64)
    tables.merge(spark, path, rows(spark, *[(k, "UPDATE", "101", "b") for k, _, _, _ in all_rows]), ["RRN"])
    token = tables._latest(spark, path)["dir"]
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(f"{path}/_dir={token}")
    writers = files.select(F.regexp_extract("path", "part-([0-9]+)-", 1).alias("w")).distinct().count()
    assert writers > 1
    assert as_set(tables.read_table(spark, path), "RRN", "AMOUNT") == {(f"K{i}", "b") for i in range(400)}


def test_a_merge_caches_its_updates_in_as_few_partitions_as_they_need(spark, monkeypatch):
    path, setting, seen = scratch_path(spark, "t"), "spark.sql.optimizer.canChangeCachedPlanOutputPartitioning", []
    before, real = spark.conf.get(setting, None), tables.merge_upsert

    def upsert(existing, updates, *rest):
        seen.append(updates.rdd.getNumPartitions())
        return real(existing, updates, *rest)
    monkeypatch.setattr(tables, "merge_upsert", upsert)
    tables.merge(spark, path, rows(spark, *[(f"K{i}", "INSERT", "100", "a") for i in range(40)]), ["RRN"])
    changed = rows(spark, *[(f"K{i}", "UPDATE", f"10{s}", f"v{s}") for i in range(0, 40, 2) for s in (1, 2)])
    tables.merge(spark, path, latest_per_key(changed, ["RRN"]), ["RRN"])
    assert seen == [1] and int(spark.conf.get("spark.sql.shuffle.partitions")) > 1
    assert as_set(tables.read_table(spark, path), "RRN", "AMOUNT") == {(f"K{i}", "a" if i % 2 else "v2") for i in range(40)}
    assert spark.conf.get(setting, None) == before


def test_bucket_sizes_are_those_of_the_files(spark):
    path = scratch_path(spark, "t")
    tables.merge(spark, path, rows(spark, *[(f"K{i}", "INSERT", "100", "a") for i in range(300)]), ["RRN"], buckets=8)
    tables.merge(spark, path, rows(spark, *[(f"K{i}", "UPDATE", "101", "b") for i in range(0, 300, 3)]), ["RRN"])
    meta = tables._latest(spark, path)
    assert len(meta["buckets"]) == 8
    for bucket, (token, size) in meta["buckets"].items():
        folder = f"{path}/_dir={token}/_bucket={bucket}"
        parquet = sum(e["length"] for e in spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder).select("length").collect())
        assert size == parquet > 0


def test_a_broken_record_stops_the_publish_stream(spark):
    from tidewater.streaming import streams
    path, ck = scratch_path(spark, "t"), scratch_path(spark, "ck")
    tables.merge(spark, path, rows(spark, ("A", "INSERT", "100", "1")), ["RRN"])
    tables.merge(spark, path, rows(spark, ("B", "INSERT", "101", "2")), ["RRN"])
    whole = fs.read_text(spark, tables._commit_path(path, 1))
    fs.delete_tree(spark, tables._commit_path(path, 1))
    seen = []
    handle = lambda df, _: seen.extend(r["RRN"] for r in df.collect())
    streams.finish(streams.start_publish(spark, path, 0, ck, handle))
    assert seen == ["A"]
    # The record is not there yet (it appears by a rename): nothing is passed over.
    streams.finish(streams.start_publish(spark, path, 0, ck, handle))
    assert seen == ["A"]
    assert fs.create_new(spark, tables._commit_path(path, 1), whole)
    streams.finish(streams.start_publish(spark, path, 0, ck, handle))
    assert seen == ["A", "B"]
    assert fs.create_new(spark, tables._commit_path(path, 2), '{"version": ')
    with pytest.raises(Exception):
        streams.finish(streams.start_publish(spark, path, 0, ck, handle))


def test_batch_folders_replace_themselves_and_compact(spark):
    path = scratch_path(spark, "f")
    assert not folders.exists(spark, path)
    a = spark.createDataFrame([(1, "x")], "n INT, s STRING")
    folders.write_batch(a, path, "run/1", 0)
    folders.write_batch(a, path, "run/1", 0)
    folders.write_batch(a.withColumn("more", F.lit(5)), path, "run/2", 0)     # a reset checkpoint is another run
    got = folders.read(spark, path)
    assert as_set(got, "n", "s", "more") == {(1, "x", None), (1, "x", 5)} and got.count() == 2
    assert folders.compact(spark, path, f"{path}-few") == 1
    assert spark.read.parquet(f"{path}-few").count() == 2


def test_empty_frame(spark):
    df = tables.empty_frame(spark, state(spark, []).schema)
    assert df.count() == 0 and df.columns == ["RRN", "_operation", "_changeSequence", "AMOUNT"]
