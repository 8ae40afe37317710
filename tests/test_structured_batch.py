"""The micro-batch upsert (STR-1) with counts and run log, and its replay."""

from pyspark.sql import functions as F

from helpers import as_set
from tests_conf import smoke_dir
from tidewater import catalog as C
from tidewater.config import RunOptions, TableConfig
from tidewater.plans import held, structured as ST
from tidewater.session import scratch_path
from tidewater.plans import registry as REG
from tidewater.sources import feed, folders, tables


def test_batch_replay_changes_nothing_and_counts_once(spark):
    d = smoke_dir()
    raw = C.raw_table(spark, d, 3)
    reg_path = C.registry_table(spark, d, 3)
    registry = REG.read_registry(spark, reg_path)
    configs = [TableConfig("SRC", f"EVENTS_{p}") for p in range(3)]
    root, counts, logs = scratch_path(spark, "st"), scratch_path(spark, "counts"), scratch_path(spark, "log")
    opts = RunOptions(tables_in_parallel=3, stream_id="ck-1", log_path=logs)
    first = ST.process_batch(spark, raw, 7, registry, configs, root, opts, counts)
    assert sorted(first) == ["SRC.EVENTS_0", "SRC.EVENTS_1", "SRC.EVENTS_2"]
    state = {t: as_set(tables.read_table(spark, ST.table_path(root, "SRC", t)).drop("_structuredLayerProcessingTime"))
             for t in ("EVENTS_0", "EVENTS_1", "EVENTS_2")}
    det = folders.read(spark, counts)
    n_counts = det.count()
    assert det.columns[12:] == sorted(det.columns[12:]) and n_counts > 0
    n_logs = folders.read(spark, logs).count()
    ST.process_batch(spark, raw, 7, registry, configs, root, opts, counts)   # replay
    for t, rows in state.items():
        again = tables.read_table(spark, ST.table_path(root, "SRC", t)).drop("_structuredLayerProcessingTime")
        assert as_set(again) == rows
    assert folders.read(spark, counts).count() == n_counts
    assert abs(folders.read(spark, logs).count() - n_logs) <= 6     # replaced, not added to
    msgs = {r["message"] for r in folders.read(spark, logs).collect()}
    assert "batch 7 started" in msgs and any(m.startswith("merged as version") for m in msgs)
    # the same batch id of another stream run counts by itself
    ST.process_batch(spark, raw, 7, registry, configs, root, RunOptions(stream_id="ck-2"), counts)
    assert folders.read(spark, counts).count() == 2 * n_counts


def test_unlisted_tables_are_skipped(spark):
    d = smoke_dir()
    raw = C.raw_table(spark, d, 3)
    registry = REG.read_registry(spark, C.registry_table(spark, d, 3))
    root = scratch_path(spark, "st")
    out = ST.process_batch(spark, raw, 0, registry, [TableConfig("src", "events_1")], root, RunOptions())
    assert list(out) == ["SRC.EVENTS_1"]
    assert not tables.table_exists(spark, ST.table_path(root, "SRC", "EVENTS_0"))


def test_dry_run_returns_update_set(spark):
    d = smoke_dir()
    e = C.entries()[1]
    out = ST.process_schema(spark, C.raw_table(spark, d), 0, e, TableConfig("SRC", "EVENTS"),
                            scratch_path(spark, "st"), RunOptions(), dry_run=True)
    assert "NOTE" in out.columns and out.count() > 0


def test_pii_columns_are_encrypted_at_rest(spark):
    import dataclasses
    from tidewater.config import RegistryEntry
    d = smoke_dir()
    cols = tuple(dataclasses.replace(c, is_pii=True) if c.name == "NOTE" else c for c in feed.COLUMNS["S2"])
    e = RegistryEntry("S2", "SRC", "EVENTS", "t", cols, feed.data_schema("S2"))
    key = "0123456789abcdef0123456789abcdef"
    raw = C.raw_table(spark, d)
    # the source sends the PII column encrypted: base64(iv || cipher || tag)
    content = F.from_json(F.col("body.message").cast("string"), feed.data_schema("S2"))
    enc = F.base64(F.aes_encrypt(F.col("c.data.NOTE"), F.lit(key), F.lit("GCM")))
    raw = raw.withColumn("c", content).withColumn(
        "c", F.col("c").withField("data.NOTE", enc).withField(
            "beforeData", F.when(F.col("c.beforeData").isNull(), None).otherwise(
                F.col("c.beforeData").withField("NOTE", F.base64(F.aes_encrypt(F.col("c.beforeData.NOTE"), F.lit(key),
                                                                               F.lit("GCM")))))))
    raw = raw.withColumn("body", F.col("body").withField("message", F.to_json("c").cast("binary"))).drop("c")
    opts = RunOptions(pii_types={"SRC.EVENTS": {"NOTE": "STRING"}}, encryption_key=key, encryption_key_id="k9")
    root = scratch_path(spark, "st")
    ST.process_schema(spark, raw, 0, e, TableConfig("SRC", "EVENTS"), root, opts)
    t = tables.read_table(spark, ST.table_path(root, "SRC", "EVENTS"))
    assert t.schema["NOTE"].dataType.simpleString().startswith("struct<version")
    from tidewater.functions.crypto import decrypt_columns
    plain = {r["NOTE"] for r in decrypt_columns(t, ["NOTE"], key).collect()}
    assert plain <= {"click", "view", "purchase", "signup", "error"} and plain


def test_publish_tables_skips_tables_below_their_start_version(spark):
    from tidewater.plans.publish import publish_tables, stage_for_db
    d = smoke_dir()
    raw = C.raw_table(spark, d, 3)
    registry = REG.read_registry(spark, C.registry_table(spark, d, 3))
    root, target, ck = scratch_path(spark, "st"), scratch_path(spark, "db"), scratch_path(spark, "ck")
    configs = [TableConfig("SRC", "EVENTS_0", start_version=0), TableConfig("SRC", "EVENTS_1", start_version=5),
               TableConfig("SRC", "EVENTS_2", start_version=1)]
    for i, week in enumerate(C.week_batches(raw)[:2]):        # two batches: two versions of each table
        ST.process_batch(spark, week, i, registry, configs, root, RunOptions(tables_in_parallel=3))

    def handler_for(cfg):
        def handle(b, batch_id):
            tables.merge(spark, ST.table_path(target, cfg.schema, cfg.table), stage_for_db(b), ["RRN"])
        return handle

    done = publish_tables(spark, root, configs, ck, handler_for, workers=2)
    assert sorted(done) == ["SRC.EVENTS_0", "SRC.EVENTS_2"]
    # EVENTS_2 started at version 1: only changes committed from version 1 on were published
    v1_keys = {r["RRN"] for r in tables.read_change_feed(spark, ST.table_path(root, "SRC", "EVENTS_2"), 1)
               .filter("_change_type != 'update_preimage'").collect()}
    assert {r["RRN"] for r in tables.read_table(spark, ST.table_path(target, "SRC", "EVENTS_2")).collect()} == v1_keys


def test_run_log_levels_and_unknown_schema_warning(spark):
    from tidewater.plans.runlog import RunLog
    log = RunLog(scratch_path(spark, "log"), "WARN")
    log.event("A", "B", "S", "t", "debug detail", "DEBUG")
    log.event("A", "B", "S", "t", "problem", "WARN")
    log.flush(spark)
    assert [r["message"] for r in folders.read(spark, log.path).collect()] == ["problem"]
    assert RunLog(None).flush(spark) is None

    d = smoke_dir()
    raw = C.raw_table(spark, d, 3)
    reg_path = scratch_path(spark, "reg")
    from tidewater.plans import registry as R
    R.ingest_registry(spark, feed.metadata_envelopes(C.events(spark, d), 3)
                      .filter(F.col("body.messageSchemaId") == "S1_0"), reg_path)
    logs = scratch_path(spark, "log")
    opts = RunOptions(log_path=logs, log_level="WARN")
    ST.process_batch(spark, raw, 0, R.RegistryCache(spark, reg_path), [TableConfig("SRC", "EVENTS_0")],
                     scratch_path(spark, "st"), opts)
    msgs = [r["message"] for r in folders.read(spark, logs).collect()]
    assert len(msgs) == 1 and "S2_0" in msgs[0] and "S1_0" not in msgs[0]


def test_rows_of_unknown_ids_are_held_until_registered_and_survive_a_replay(spark):
    d = smoke_dir()
    raw = C.raw_table(spark, d)
    meta = feed.metadata_envelopes(C.events(spark, d))
    reg, root, counts = scratch_path(spark, "reg"), scratch_path(spark, "st"), scratch_path(spark, "counts")
    cfg = [TableConfig("SRC", "EVENTS")]
    opts = RunOptions(stream_id="s")
    REG.ingest_registry(spark, meta.filter(F.col("body.messageSchemaId") == "S1"), reg)
    for _ in range(2):                                     # run, then replayed
        ST.process_batch(spark, raw, 0, REG.RegistryCache(spark, reg), cfg, root, opts, counts)
    path = ST.table_path(root, "SRC", "EVENTS")
    assert as_set(tables.read_table(spark, path), "_messageSchemaId") == {("S1",)}
    assert held.held_ids(spark, root, "s") == ["S2"]
    REG.ingest_registry(spark, meta, reg)
    for _ in range(2):
        ST.process_batch(spark, raw.limit(0), 1, REG.RegistryCache(spark, reg), cfg, root, opts, counts)
        assert ("S2",) in as_set(tables.read_table(spark, path), "_messageSchemaId")
    detail = folders.read(spark, counts).filter("messageSchemaId = 'S2'")
    counted = detail.agg(F.sum(F.coalesce("INSERT", F.lit(0)) + F.coalesce("UPDATE", F.lit(0)) + F.coalesce("DELETE", F.lit(0)))).first()[0]
    assert counted == raw.filter("body.messageSchemaId = 'S2'").count()        # held once, though batch 0 ran twice
    ST.process_batch(spark, raw.limit(0), 2, REG.RegistryCache(spark, reg), cfg, root, opts, counts)
    assert held.held_ids(spark, root, "s") == []
    assert folders.read(spark, counts).filter("messageSchemaId = 'S2'").count() == detail.count()


def test_streams_over_one_root_hold_and_release_their_own_rows(spark):
    d = smoke_dir()
    raw = C.raw_table(spark, d, 3)
    meta = feed.metadata_envelopes(C.events(spark, d), 3)
    reg, root, alone = scratch_path(spark, "reg"), scratch_path(spark, "st"), scratch_path(spark, "st")
    groups = {"a": [TableConfig("SRC", "EVENTS_0")], "b": [TableConfig("SRC", f"EVENTS_{p}") for p in (1, 2)]}
    REG.ingest_registry(spark, meta.filter(F.col("body.messageSchemaId").startswith("S1")), reg)

    def run(stream, batch, batch_id):
        ST.process_batch(spark, batch, batch_id, REG.RegistryCache(spark, reg), groups[stream], root, RunOptions(stream_id=stream))
    weeks = C.week_batches(raw)
    for i in range(3):
        run("b", weeks[i], i)
    for i in range(2):
        run("a", weeks[i], i)
    REG.ingest_registry(spark, meta, reg)
    run("a", weeks[2], 2)                  # a's batch 2 before b's batch 3
    run("b", weeks[3], 3)
    run("a", weeks[3], 3)
    ST.process_batch(spark, raw, 0, REG.read_registry(spark, reg), groups["a"] + groups["b"], alone, RunOptions())
    for t in ("EVENTS_0", "EVENTS_1", "EVENTS_2"):
        got, want = (as_set(tables.read_table(spark, ST.table_path(r, "SRC", t)).drop("_structuredLayerProcessingTime")) for r in (root, alone))
        assert got == want and ("S2_" in str(want))


def test_rows_without_schema_id_are_kept_once(spark):
    d = smoke_dir()
    raw = C.raw_table(spark, d).limit(20)
    nulls = raw.withColumn("body", F.col("body").withField("messageSchemaId", F.lit(None).cast("string"))).limit(7)
    odd = raw.withColumn("body", F.col("body").withField("messageSchemaId", F.lit("a/b=ü*"))).limit(3)
    reg, root = C.registry_table(spark, d, 1), scratch_path(spark, "st")
    opts = RunOptions(stream_id="s", log_path=scratch_path(spark, "log"))
    for _ in range(2):
        ST.process_batch(spark, raw.unionByName(nulls).unionByName(odd), 0, REG.RegistryCache(spark, reg), [TableConfig("SRC", "EVENTS")], root, opts)
    ST.process_batch(spark, raw.limit(0), 1, REG.RegistryCache(spark, reg), [TableConfig("SRC", "EVENTS")], root, opts)
    assert folders.read(spark, f"{root}/{held.DEAD}").count() == 7
    assert held.held_ids(spark, root, "s") == ["a/b=ü*"] and held.held_ids(spark, root, "other") == []
    assert any("without a schema id" in r["message"] for r in folders.read(spark, opts.log_path).collect())


def test_versions_in_one_merge_are_as_merges_one_after_another(spark):
    """Also with a personal column and where the newer version lacks a column of the older."""
    import dataclasses
    d = smoke_dir()
    raw = C.raw_table(spark, d)
    s1, s2 = C.entries()
    less = dataclasses.replace(s2, columns=tuple(c for c in s2.columns if c.name != "KVAL"))
    cfg = TableConfig("SRC", "EVENTS")
    for pair in ([s1, s2], [s2, s1], [s1, less]):
        one, other = scratch_path(spark, "st"), scratch_path(spark, "st")
        for i, batch in enumerate([raw.filter("enqueuedTime >= '2024-01-10'"), raw.filter("enqueuedTime < '2024-01-20'"), raw]):
            ST.process_table(spark, batch, i, pair, cfg, one, RunOptions())
            for e in pair:
                ST.process_schema(spark, batch, i, e, cfg, other, RunOptions())
        got, want = (tables.read_table(spark, ST.table_path(r, "SRC", "EVENTS")).drop("_structuredLayerProcessingTime") for r in (one, other))
        assert got.columns == want.columns and got.schema == want.schema
        assert as_set(got) == as_set(want)


def test_jobs_do_not_grow_with_schema_ids(spark):
    import dataclasses
    d = smoke_dir()
    raw = C.raw_table(spark, d)
    tracker = spark.sparkContext.statusTracker()

    def jobs(versions):
        part = F.pmod(F.xxhash64("body.message"), F.lit(versions))
        ids = F.concat(F.col("body.messageSchemaId"), F.lit("-"), part)
        batch = raw.withColumn("body", F.col("body").withField("messageSchemaId", ids))
        entries = [dataclasses.replace(e, message_schema_id=f"{e.message_schema_id}-{v}") for e in C.entries() for v in range(versions)]

        class Registry(REG.RegistryCache):
            def __init__(self):
                super().__init__(spark, "")
                self.by_id = {e.message_schema_id: e for e in entries}
        group = f"ids-{versions}"
        spark.sparkContext.setJobGroup(group, "")
        try:
            out = ST.process_batch(spark, batch, 0, Registry(), [TableConfig("SRC", "EVENTS")], scratch_path(spark, "st"), RunOptions(tables_in_parallel=1))
            assert len(out["SRC.EVENTS"]) == 2 * versions
        finally:
            spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        return len(tracker.getJobIdsForGroup(group))
    assert 0 < jobs(5) <= jobs(1) + 1


def test_datetime_starts_are_read_in_the_session_zone(spark):
    import datetime as dt
    import os
    import time
    from tidewater.operators.changes import start_gate
    df = spark.createDataFrame([("2024-01-10 00:30:00",), ("2024-01-10 06:00:00",), ("2024-01-09 23:00:00",)], "t STRING")
    old = os.environ.get("TZ")
    try:
        os.environ["TZ"] = "America/New_York"
        time.tzset()
        assert start_gate(df, F.col("t"), dt.datetime(2024, 1, 10)).count() == 2 == start_gate(df, F.col("t"), "2024-01-10 00:00:00").count()
    finally:
        os.environ.pop("TZ") if old is None else os.environ.__setitem__("TZ", old)
        time.tzset()


def test_keys_do_not_show_in_plans(spark):
    from tidewater.functions.crypto import encrypt_columns, protect_key
    key = "plan-secret-key-of-32-bytes-long"
    before = spark.conf.get("spark.sql.redaction.string.regex", None)
    protect_key(spark, key)
    try:
        plan = encrypt_columns(spark.createDataFrame([("x",)], "v STRING"), ["v"], key, "k")._jdf.queryExecution().toString()
        assert key not in plan and key.encode().hex().upper() not in plan
    finally:
        spark.conf.unset("spark.sql.redaction.string.regex") if before is None else spark.conf.set("spark.sql.redaction.string.regex", before)


def test_a_batch_is_rebalanced_before_it_is_parsed(spark, monkeypatch):
    from tidewater import catalog as C
    from tidewater.plans import registry as REG
    from tidewater.plans import structured as ST
    from tidewater.sources import feed
    reg = scratch_path(spark, "reg")
    events = C.events(spark, "/root/testdata/sf0.001")
    REG.ingest_registry(spark, feed.metadata_envelopes(events), reg)
    seen = []
    monkeypatch.setattr(ST, "process_table", lambda spark, batch, *a, **k: seen.append(batch._jdf.queryExecution().analyzed().toString()) or [])
    cfg = [C.TableConfig(feed.SOURCE_SCHEMA, feed.SINGLE_TABLE)]
    ST.process_batch(spark, feed.data_envelopes(events).coalesce(1), 0, REG.read_registry(spark, reg), cfg, scratch_path(spark, "root"), C.OPTS)
    assert len(seen) == 1 and "RebalancePartitions" in seen[0]


def test_raw_appends_of_several_files_are_one_batch_each(spark):
    from tidewater import catalog as C
    from tidewater.functions.codec import RAW_SCHEMA
    from tidewater.streaming import streams
    rows = C.raw(spark, "/root/testdata/sf0.1")
    path, out, ck = (scratch_path(spark, n) for n in ("raw", "out", "ck"))
    files = C._raw_appends(spark, rows, path, 6, file_bytes=100_000)
    names = spark.read.parquet(path).inputFiles()
    assert files > 1 and len(names) == 6 * files
    batches = []
    q = streams.read_raw_stream(spark, path, RAW_SCHEMA, max_bytes=1, max_files=files).writeStream.foreachBatch(
        lambda b, i: batches.append(b.select(F.pmod(F.xxhash64("body.message"), F.lit(6)).alias("a")).groupBy("a").count().collect())) \
        .option("checkpointLocation", ck).trigger(availableNow=True).start()
    streams.drain(q)
    assert [len(b) for b in batches] == [1] * 6 and sum(b[0]["count"] for b in batches) == rows.count()
    small = scratch_path(spark, "raw")
    assert C._raw_appends(spark, C.raw(spark, "/root/testdata/sf0.001"), small, 6) == 1
    assert len(spark.read.parquet(small).inputFiles()) == 6
