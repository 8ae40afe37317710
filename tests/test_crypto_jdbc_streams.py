import time

from pyspark.sql import functions as F
from pyspark.sql import types as T

from helpers import as_set
from tidewater.functions import crypto
from tidewater.plans.registry import read_registry
from tidewater.plans.structured import run_parallel
from tidewater.session import scratch_path
from tidewater.sources import jdbc
from tidewater.streaming import streams

KEY = "0123456789abcdef0123456789abcdef"


def test_encrypt_decrypt_roundtrip_and_null(spark):
    df = spark.createDataFrame([(1, "alice"), (2, None), (3, "bob")], "id INT, name STRING")
    enc = crypto.encrypt_columns(df, ["NAME"], KEY, "k1")
    assert enc.schema["name"].dataType.simpleString() == "struct<version:int,keyId:string,cipherText:string,iv:string>"
    cells = {r["id"]: r["name"] for r in enc.collect()}
    assert cells[2] is None and cells[1]["keyId"] == "k1" and cells[1]["cipherText"] != "alice"
    assert as_set(crypto.decrypt_columns(enc, ["name"], KEY)) == {(1, "alice"), (2, None), (3, "bob")}


def test_sql_registered_decrypt(spark):
    df = spark.createDataFrame([(1, "x")], "id INT, v STRING")
    crypto.encrypt_columns(df, ["v"], KEY, "k1").createOrReplaceTempView("t_enc")
    crypto.register_sql_functions(spark)
    assert spark.sql("SELECT decrypt_target_cell(v, :k) AS v FROM t_enc", args={"k": KEY}).collect()[0]["v"] == "x"
    src = spark.sql(f"SELECT base64(aes_encrypt('y', '{KEY}', 'GCM')) AS s")
    src.createOrReplaceTempView("t_src")
    assert spark.sql("SELECT decrypt_source_value(s, :k) AS v FROM t_src", args={"k": KEY}).collect()[0]["v"] == "y"


def test_merge_sql_guards_on_sequence():
    s = jdbc.merge_sql("APP.T", "STAGE.T", ["RRN", "_changeSequence", "AMOUNT"], ["RRN"])
    assert 'MERGE INTO "APP"."T" t USING "STAGE"."T" s' in s
    assert '(t."RRN" = s."RRN" OR (t."RRN" IS NULL AND s."RRN" IS NULL))' in s
    assert 'WHEN MATCHED AND s."_changeSequence" > t."_changeSequence" THEN UPDATE SET ' \
           '"_changeSequence" = s."_changeSequence", "AMOUNT" = s."AMOUNT"' in s
    assert s.endswith('INSERT ("RRN", "_changeSequence", "AMOUNT") VALUES (s."RRN", s."_changeSequence", s."AMOUNT");')


def test_ddl_from_schema(spark):
    schema = T.StructType([T.StructField("RRN", T.LongType()), T.StructField("AMOUNT", T.DecimalType(12, 2)),
                           T.StructField('NO"TE', T.StringType()), T.StructField("B", T.BinaryType()), T.StructField("F", T.FloatType())])
    assert jdbc.create_table_sql("APP.T", schema) == \
        'CREATE TABLE "APP"."T" ("RRN" BIGINT, "AMOUNT" DECIMAL(12,2), "NO""TE" NVARCHAR(MAX), "B" VARBINARY(MAX), "F" REAL)'
    assert jdbc.add_columns_sql("APP.T", ["rrn", "AMOUNT", "b", "f"], schema) == ['ALTER TABLE "APP"."T" ADD "NO""TE" NVARCHAR(MAX)']
    nested = spark.sql("SELECT 1 AS a, named_struct('x', 2) AS s")
    assert jdbc.flat(nested).collect()[0]["s"] == '{"x":2}'


def test_run_parallel_uses_one_pool_per_task_and_raises_after_all(spark):
    seen, done = [], []

    def task(i):
        def run():
            seen.append(spark.sparkContext.getLocalProperty("spark.scheduler.pool"))
            time.sleep(0.05)
            done.append(i)
            if i == 1:
                raise RuntimeError("boom")
            return i
        return run

    try:
        run_parallel(spark, [task(i) for i in range(3)], 3, "p")
        raise AssertionError("expected failure")
    except RuntimeError as exc:
        assert str(exc) == "boom"
    assert sorted(seen) == ["p_0", "p_1", "p_2"] and sorted(done) == [0, 1, 2]


def test_stream_drain_and_graceful_stop(spark):
    src, out, ck = scratch_path(spark, "src"), scratch_path(spark, "out"), scratch_path(spark, "ck")
    spark.range(100).withColumn("v", F.col("id") * 2).repartition(4).write.parquet(src)
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("v", T.LongType())])
    q = (streams.read_event_stream(spark, src, schema, max_files=1).writeStream.format("parquet")
         .option("checkpointLocation", ck).trigger(processingTime="1 second").start(out))
    assert streams.stop_when_idle(spark, q, timeout_s=60)
    assert not q.isActive
    assert spark.read.parquet(out).count() == 100
    # a second run over the same checkpoint finds nothing new
    q2 = (streams.read_event_stream(spark, src, schema).writeStream.format("parquet")
          .option("checkpointLocation", ck).trigger(availableNow=True).start(out))
    streams.drain(q2)
    assert spark.read.parquet(out).count() == 100


def test_forced_stop_after_timeout(spark):
    ck = scratch_path(spark, "ck")

    def slow(batch, batch_id):
        time.sleep(8)

    q = (spark.readStream.format("rate").option("rowsPerSecond", 50).load()
         .writeStream.foreachBatch(slow).option("checkpointLocation", ck).trigger(processingTime="100 milliseconds")
         .start())
    time.sleep(1.5)
    assert streams.stop_when_idle(spark, q, timeout_s=1) is False
    assert not q.isActive


def test_metadata_leg_streams_are_restartable(spark):
    from tests_conf import smoke_dir
    from tidewater import catalog as C
    from tidewater.functions.codec import ENVELOPE_SCHEMA
    from tidewater.sources import feed, tables
    log_path, raw_meta, reg = scratch_path(spark, "metalog"), scratch_path(spark, "rawmeta"), scratch_path(spark, "reg")
    ck1, ck2 = scratch_path(spark, "ck"), scratch_path(spark, "ck")
    meta = feed.metadata_envelopes(C.events(spark, smoke_dir()))
    meta.filter(F.col("body.messageSchemaId") == "S1").write.parquet(f"{log_path}/part1")
    schema = T.StructType([T.StructField("body", ENVELOPE_SCHEMA), T.StructField("enqueuedTime", T.TimestampType())])

    def run():
        # SNK-2: metadata leg appends without a processing-time column, default trigger
        q = streams.start_raw(streams.read_event_stream(spark, f"{log_path}/*", schema), raw_meta, ck1,
                              available_now=True, stamp=False, processing_time=None)
        streams.drain(q)
        streams.drain(streams.start_registry(spark.readStream.schema(schema).parquet(raw_meta), reg, ck2,
                                             available_now=True))

    run()
    assert {r[0] for r in read_registry(spark, reg).select("messageSchemaId").collect()} == {"S1"}
    run()                                    # restart with nothing new: no change
    assert read_registry(spark, reg).count() == 1
    meta.write.parquet(f"{log_path}/part2")  # S1 repeated and S2 new
    run()
    assert sorted(r[0] for r in read_registry(spark, reg).select("messageSchemaId").collect()) == ["S1", "S2"]


def test_find_query_by_name(spark):
    ck = scratch_path(spark, "ck")
    q = (spark.readStream.format("rate").option("rowsPerSecond", 5).load().writeStream.format("noop")
         .queryName("tw_find_me").option("checkpointLocation", ck).start())
    try:
        assert streams.find_query(spark, "tw_find_me", wait_s=5).id == q.id
        assert streams.find_query(spark, "tw_absent", wait_s=0.2) is None
    finally:
        q.stop()


def test_kafka_source_needs_its_package(spark):
    import pytest
    from tidewater.functions.codec import ENVELOPE_SCHEMA
    with pytest.raises(RuntimeError, match="spark-sql-kafka"):
        streams.read_kafka_stream(spark, "localhost:1", "t", ENVELOPE_SCHEMA)


def test_decode_modes(spark):
    import pytest
    from tidewater.functions.codec import decode
    df = spark.createDataFrame([('{"a": 1}',), ('{"a": "x"}',), ("not json",)], "s STRING") \
        .select(F.col("s").cast("binary").alias("b"))
    out = df.select(decode(F.col("b"), "a INT", mode="PERMISSIVE").alias("c")).select("c.a").collect()
    assert [r[0] for r in out] == [1, None, None]
    with pytest.raises(Exception):
        df.select(decode(F.col("b"), "a INT", mode="FAILFAST").alias("c")).collect()
    with pytest.raises(ValueError):
        decode(F.col("b"), "a INT", mode="DROPMALFORMED")


def test_raw_stream_enqueue_gate_is_strict(spark):
    import datetime as dt
    from tidewater.functions.codec import RAW_SCHEMA
    src, out, ck = scratch_path(spark, "raw"), scratch_path(spark, "out"), scratch_path(spark, "ck")
    t0 = dt.datetime(2024, 1, 10)
    rows = [((None, "data", {}, "S1", None, b"{}"), t0 + dt.timedelta(seconds=s), None) for s in (-1, 0, 1)]
    spark.createDataFrame(rows, RAW_SCHEMA).write.parquet(src)
    stream = streams.read_raw_stream(spark, src, RAW_SCHEMA, max_bytes=0, start="2024-01-10 00:00:00")
    q = stream.writeStream.format("parquet").option("checkpointLocation", ck).trigger(availableNow=True).start(out)
    streams.drain(q)
    got = [r[0] for r in spark.read.parquet(out).select("enqueuedTime").collect()]
    assert got == [t0 + dt.timedelta(seconds=1)]
