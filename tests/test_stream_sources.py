"""Streams with offsets of this library's own: events by sequence, change files by size; and the life of queries."""

import json
import threading

import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidewater.plans.runlog import RunLog
from tidewater.session import scratch_path
from tidewater.sources import folders, offsets, tables
from tidewater.streaming import lifecycle, streams


@given(st.dictionaries(st.sampled_from("abcdef"), st.integers(0, 1000)), st.integers(1, 800))
def test_a_trigger_shares_its_events_out(left, limit):
    out = offsets.shared_out(left, limit)
    assert sum(out.values()) == min(limit, sum(left.values())) and all(0 <= out[p] <= left[p] for p in left)


def append_events(spark, path, partition, first, n, files=1):
    df = spark.range(first, first + n).select(F.lit(partition).alias("partition"), F.col("id").alias("sequence"),
                                              F.concat(F.lit(f"{partition}:"), "id").cast("binary").alias("body"),
                                              F.timestamp_seconds(F.col("id")).alias("enqueuedTime"))
    df.repartitionByRange(files, "sequence").write.mode("append").partitionBy("partition").parquet(path)


def run(spark, path, out, ck, **kw):
    q = offsets.read_event_log(spark, path, ck, **kw).writeStream.format("parquet").option("checkpointLocation", ck) \
        .trigger(processingTime="0 seconds").start(out)
    streams.finish(q)
    return q


def batches(q):
    return [p.numInputRows for p in q.recentProgress if p.numInputRows]


def test_event_log_by_sequence_over_restarts(spark):
    path, out, ck = (scratch_path(spark, n) for n in ("log", "out", "ck"))
    append_events(spark, path, "0", 0, 100, 3)
    append_events(spark, path, "1", 0, 10)
    q = run(spark, path, out, ck, events_per_trigger=30)
    assert batches(q) == [30, 30, 30, 20]
    append_events(spark, path, "1", 10, 40, 2)
    append_events(spark, path, "2", 0, 5)                      # a partition that came later
    q = run(spark, path, out, ck, events_per_trigger=30)       # another query goes on where the first stopped
    assert batches(q) == [30, 15]
    assert run(spark, path, out, ck).recentProgress == [] or not batches(q)[2:]
    got = spark.read.parquet(out)
    assert got.count() == got.distinct().count() == 155
    assert {(r["partition"], r["n"], r["low"], r["high"]) for r in got.groupBy("partition").agg(
        F.count("*").alias("n"), F.min("sequence").alias("low"), F.max("sequence").alias("high")).collect()} \
        == {("0", 100, 0, 99), ("1", 50, 0, 49), ("2", 5, 0, 4)}
    assert got.filter(F.col("body").cast("string") != F.concat_ws(":", "partition", "sequence")).isEmpty()


def test_event_log_starts_at_a_sequence_and_notices_lost_events(spark):
    path, out, ck = (scratch_path(spark, n) for n in ("log", "out", "ck"))
    append_events(spark, path, "0", 20, 30)                    # sequences 0 to 19 are gone already
    run(spark, path, out, ck, starting_sequence=25)
    assert sorted(r["sequence"] for r in spark.read.parquet(out).collect()) == list(range(25, 50))
    with pytest.raises(Exception, match="no longer has sequences"):
        run(spark, path, scratch_path(spark, "out"), scratch_path(spark, "ck"), starting_sequence=0, events_per_trigger=10)


def test_a_planned_batch_is_read_again_after_a_failure(spark):
    path, ck = scratch_path(spark, "log"), scratch_path(spark, "ck")
    append_events(spark, path, "0", 0, 50)
    seen, fail = [], [True]

    def each(batch, batch_id):
        rows = sorted(r["sequence"] for r in batch.collect())
        if batch_id == 1 and fail.pop() if fail else False:
            raise RuntimeError("lost")
        seen.append((batch_id, rows))

    def go():
        streams.finish(offsets.read_event_log(spark, path, ck, events_per_trigger=20).writeStream.foreachBatch(each)
                       .option("checkpointLocation", ck).trigger(processingTime="0 seconds").start())
    with pytest.raises(Exception):
        fail[:] = [True]
        go()
    fail.clear()
    go()
    assert [b for b, _ in seen][-2:] == [1, 2] and sorted(x for b, r in dict(seen).items() for x in r) == list(range(50))


def change_rows_table(spark):
    path = scratch_path(spark, "t")
    ddl = "RRN STRING, _operation STRING, _changeSequence STRING, AMOUNT STRING"
    for v in range(3):
        rows = [(f"K{i}", "UPDATE" if v else "INSERT", f"10{v}", f"{v}") for i in range(v, 200)]
        tables.merge(spark, path, spark.createDataFrame(rows, ddl), ["RRN"], buckets=8)
    return path


def test_change_feed_is_admitted_by_bytes_within_a_version(spark):
    path, ck = change_rows_table(spark), scratch_path(spark, "ck")
    whole = tables.read_change_feed(spark, path)
    version = tables.commits(spark, path).agg(F.min("change_bytes")).first()[0]
    seen, sizes = [], []

    def each(batch, batch_id):
        files = batch.collect()
        sizes.append((sum(f["bytes"] for f in files), len(files), {f["version"] for f in files}))
        seen.extend(tuple(r) for r in tables.read_change_rows(spark, path, files).collect())

    def go(limit):
        files = offsets.read_change_files(spark, path, ck, ["I", "U", "P", "D"], 0, limit)
        streams.finish(files.writeStream.foreachBatch(each).option("checkpointLocation", ck).trigger(processingTime="0 seconds").start())
    go(version // 3)
    assert len(sizes) > 6 and all(size <= version // 3 or n == 1 for size, n, _ in sizes)
    assert sorted(map(str, seen)) == sorted(str(tuple(r)) for r in whole.collect())
    order = [v for _, _, vs in sizes for v in sorted(vs)]
    assert order == sorted(order)
    done = len(seen)
    tables.merge(spark, path, spark.createDataFrame([("K1", "UPDATE", "900", "z")], "RRN STRING, _operation STRING, _changeSequence STRING, AMOUNT STRING"), ["RRN"])
    go(10**9)                                                  # restarted: only the new version
    assert len(seen) == done + 2 and sizes[-1][2] == {3}
    late = scratch_path(spark, "ck")
    got = []
    streams.finish(streams.start_publish(spark, path, 2, late, lambda df, _: got.extend(df.collect())))
    assert {r["_commit_version"] for r in got} == {2, 3} and {r["_change_type"] for r in got} <= {"insert", "update_postimage"}


def test_life_of_a_query(spark):
    src, out, ck, logs = (scratch_path(spark, n) for n in ("src", "out", "ck", "log"))
    spark.range(30).repartition(3).write.parquet(src)
    w, log = lifecycle.watch(spark), RunLog(logs, "DEBUG")
    assert lifecycle.watch(spark) is w
    w.log_to("tw_life", log)
    found = []
    waiter = threading.Thread(target=lambda: found.append(lifecycle.find_query(spark, "tw_life", wait_s=60)))
    waiter.start()                                              # waits before the query is there
    q = (streams.read_event_stream(spark, src, spark.read.parquet(src).schema, max_files=1).writeStream.format("parquet").queryName("tw_life")
         .option("checkpointLocation", ck).trigger(processingTime="200 milliseconds").start(out))
    waiter.join(60)
    assert found[0].id == q.id
    assert lifecycle.stop_when_idle(spark, q, timeout_s=90) and not q.isActive
    state = w.runs[str(q.runId)]
    assert w.wait(lambda: state.ended, 30)
    assert (state.batches, state.rows, state.error) == (3, 30, None)
    log.flush(spark, "life")
    kinds = [(r["level"], r["message"]) for r in folders.read(spark, logs).orderBy("logTime").collect()]
    assert ("INFO", "query started") == kinds[0] and ("INFO", "query ended") == kinds[-1] and ("DEBUG", "query idle") in kinds
    assert sum(m.startswith("batch") for _, m in kinds) == 3


def test_a_failed_query_is_an_error_in_the_log(spark):
    src, logs = scratch_path(spark, "src"), scratch_path(spark, "log")
    spark.range(3).write.parquet(src)
    w, log = lifecycle.watch(spark), RunLog(logs, "ERROR")
    w.log_to("tw_fails", log)

    def each(batch, batch_id):
        raise RuntimeError("broken sink")
    q = spark.readStream.schema("id LONG").parquet(src).writeStream.queryName("tw_fails").foreachBatch(each) \
        .option("checkpointLocation", scratch_path(spark, "ck")).start()
    with pytest.raises(Exception, match="broken sink"):
        streams.finish(q)
    assert w.wait(lambda: w.runs[str(q.runId)].ended, 30) and "broken sink" in w.runs[str(q.runId)].error
    log.flush(spark, "fails")
    assert [r["level"] for r in folders.read(spark, logs).collect()] == ["ERROR"]


def test_offsets_are_json_and_progress_lies_in_the_checkpoint(spark, tmp_path):
    reader = offsets.EventLogReader({"path": str(tmp_path / "none"), "progress": f"file://{tmp_path}/ck/progress/x.json"}, None)
    assert reader.position() == {} == reader.latestOffset()
    reader.note({"0": 7})
    assert reader.position() == {"0": 7} and json.loads((tmp_path / "ck/progress/x.json").read_text()) == {"0": 7}
