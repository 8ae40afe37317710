"""Registered queries: each takes ``(spark, sf_dir)``, reads the given tables
(the ``events`` table drives the change feed, ``documents`` the text trims)
and returns a DataFrame. Output columns are presented for comparison:
timestamps as text with microseconds, dates as text, decimals as doubles,
and wall-clock columns dropped.
"""

from __future__ import annotations

from dataclasses import replace
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewater.config import RegistryEntry, RunOptions, TableConfig, parse_table_config
from tidewater.functions.codec import RAW_SCHEMA, decode
from tidewater.functions.columns import default_columns, framework_columns, trim_strings
from tidewater.functions.crypto import decrypt_columns, encrypt_columns, protect_key, register_sql_functions
from tidewater.functions.structs import struct_to_kv
from tidewater.functions.types import apply_types, resolve_types
from tidewater.operators import changes as CH
from tidewater.operators.counts import count_input, count_rollup, max_value
from tidewater.operators.merge import CHANGE_KINDS, merge_upsert, snapshot_rows
from tidewater.plans import counts as CNT
from tidewater.plans import registry as REG
from tidewater.plans import structured as ST
from tidewater.plans.publish import post_images, stage_for_db
from tidewater.plans.runlog import RunLog
from tidewater.session import scratch_path
from tidewater.sources import feed, folders, fs, tables
from tidewater.sources.offsets import PARTITION, SEQUENCE, read_change_files, read_event_log
from tidewater.streaming import streams
from tidewater.streaming.lifecycle import watch

# Fixed values of the registered queries.
GATE_START = "2024-01-10 00:00:00"
DEMO_KEY = "tidewater-demo-key-32-bytes-long"
DEMO_KEY_ID = "demo"
LISTED_TABLES = ["src.events_0", "SRC.EVENTS_2"]
WEEK_CUTS = ["2024-01-09 00:00:00", "2024-01-17 00:00:00", "2024-01-25 00:00:00"]
WALL_CLOCK = {"_structuredLayerProcessingTime", "_dbProcessingTimestamp", "logTimeStamp", "_logTimeStamp",
              "_commit_timestamp"}
#: Bytes of one file where the raw table comes in appends.
APPEND_FILE_BYTES = 8_388_608
OPTS = RunOptions()


def present(df: DataFrame) -> DataFrame:
    cols = []
    for f in df.schema.fields:
        if f.name in WALL_CLOCK:
            continue
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType)):
            c = F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS")
        elif isinstance(f.dataType, T.DateType):
            c = F.date_format(c, "yyyy-MM-dd")
        elif isinstance(f.dataType, T.DecimalType):
            c = c.cast("double")
        cols.append(c.alias(f.name))
    return df.select(*cols)


# ---------------------------------------------------------------- inputs

def events(spark: SparkSession, d: str) -> DataFrame:
    return spark.read.parquet(f"{d}/events.parquet")


def entries(n_tables: int = 1) -> list[RegistryEntry]:
    """Registry entries of the derived feed, as the metadata leg registers them."""
    out = []
    for sid in ("S1", "S2"):
        for p in range(n_tables):
            mid = sid if n_tables == 1 else f"{sid}_{p}"
            table = feed.SINGLE_TABLE if n_tables == 1 else f"{feed.SINGLE_TABLE}_{p}"
            out.append(RegistryEntry(mid, feed.SOURCE_SCHEMA, table, feed.SCHEMA_START[sid],
                                     feed.COLUMNS[sid], feed.data_schema(sid)))
    return out


def raw(spark: SparkSession, d: str, n_tables: int = 1) -> DataFrame:
    return feed.data_envelopes(events(spark, d), n_tables)


def raw_table(spark: SparkSession, d: str, n_tables: int = 1) -> DataFrame:
    """The raw table as the ingest leg leaves it: envelopes written once."""
    path = scratch_path(spark, "raw")
    raw(spark, d, n_tables).write.parquet(path)
    return spark.read.schema(RAW_SCHEMA).parquet(path)


def decoded(spark: SparkSession, d: str, entry: RegistryEntry) -> DataFrame:
    return ST.decode_rows(raw(spark, d), entry, OPTS)


def framed(spark: SparkSession, d: str, entry: RegistryEntry) -> DataFrame:
    return framework_columns(decoded(spark, d, entry), entry.message_schema_id)


def split_rows(spark: SparkSession, d: str, entry: RegistryEntry) -> DataFrame:
    return ST.change_rows_of(decoded(spark, d, entry), entry, None)


def all_split_rows(spark: SparkSession, d: str) -> DataFrame:
    parts = [split_rows(spark, d, e) for e in entries()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def update_set(spark: SparkSession, d: str, entry: RegistryEntry,
               existing: T.StructType = T.StructType()) -> tuple[DataFrame, list[str]]:
    return ST.build_update_set(split_rows(spark, d, entry), entry, existing, OPTS)


def all_update_sets(spark: SparkSession, d: str) -> DataFrame:
    """The update sets of both schema versions."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), [update_set(spark, d, e)[0] for e in entries()])


def flagship_table(spark: SparkSession, d: str, counts_path: str | None = None) -> str:
    """Process S1 then S2 of the whole feed into a fresh table; return its path."""
    root = scratch_path(spark, "structured")
    batch = raw_table(spark, d)
    cfg = TableConfig(feed.SOURCE_SCHEMA, feed.SINGLE_TABLE)
    for e in entries():
        ST.process_schema(spark, batch, 0, e, cfg, root, OPTS, counts_path)
    return ST.table_path(root, feed.SOURCE_SCHEMA, feed.SINGLE_TABLE)


def registry_table(spark: SparkSession, d: str, n_tables: int, before: str | None = None) -> str:
    """Run the registry ingest over the metadata log derived from events."""
    path = scratch_path(spark, "registry")
    meta = feed.metadata_envelopes(events(spark, d), n_tables)
    if before is not None:
        meta = meta.filter(F.col("enqueuedTime") < F.lit(before).cast("timestamp"))
    REG.ingest_registry(spark, meta, path)
    return path


def detail_counts(spark: SparkSession, d: str) -> DataFrame:
    return CNT.count_detail(CNT.batch_counts(raw(spark, d), entries(), OPTS), 0, OPTS.source_name, entries())


# ---------------------------------------------------------------- queries

def q_flagship(spark, d):
    """Minimum slice: feed -> split -> latest -> v0 (S1) -> merge (S2) -> live rows."""
    return present(CH.live_rows(tables.read_table(spark, flagship_table(spark, d))))


def q_nested_project(spark, d):
    r = raw(spark, d)
    return present(r.select(F.col("body.messageSchemaId").alias("messageSchemaId"),
                            F.col("body.type").alias("type"),
                            F.col("body.headers")["table"].alias("table"),
                            F.col("enqueuedTime").alias("enqueuedTime")))


def _decoded_columns(decoded_by_id) -> DataFrame:
    parts = []
    for e, x in decoded_by_id:
        parts.append(x.select(
            F.lit(e.message_schema_id).alias("messageSchemaId"),
            F.col("content.headers.operation").alias("operation"),
            F.col("content.headers.changeSequence").alias("changeSequence"),
            F.col("content.headers.timestamp").alias("captured"),
            F.col("content.data.RRN").alias("RRN"),
            F.col("content.data.AMOUNT").cast("double").alias("AMOUNT"),
            F.col("content.data.KVAL").alias("KVAL"),
            (F.col("content.data.NOTE") if e.message_schema_id == "S2" else F.lit(None).cast("string")).alias("NOTE"),
            F.col("content.beforeData.RRN").alias("BEFORE_RRN"),
        ))
    return reduce(lambda a, b: a.unionByName(b), parts)


def q_decode_payload(spark, d):
    return _decoded_columns((e, decoded(spark, d, e)) for e in entries())


def q_decode_avro(spark, d):
    """The event log with Avro bodies: envelopes, then payloads by the schema of their id."""
    log = feed.avro_log(events(spark, d)).withColumn("rawLayerProcessingTime", F.current_timestamp())
    envelopes = log.withColumn("body", decode(F.col("body"), feed.AVRO_ENVELOPE, "avro"))
    opts = RunOptions(codec="avro")
    avro = [replace(e, data_schema=feed.avro_schema(e.message_schema_id)) for e in entries()]
    return _decoded_columns((e, ST.decode_rows(envelopes, e, opts)) for e in avro)


def q_flatten_image(spark, d):
    parts = [ST.change_rows_of(decoded(spark, d, e), e, None) for e in entries()]
    flat = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    return present(flat.select("_changeSequence", "_operation", "RRN", F.col("AMOUNT").cast("double").alias("AMOUNT"),
                               "KVAL", "NOTE"))


def q_framework_columns(spark, d):
    parts = [framed(spark, d, e).drop("data", "beforeData") for e in entries()]
    return present(reduce(lambda a, b: a.unionByName(b), parts))


def q_struct_to_kv(spark, d):
    meta = feed.metadata_envelopes(events(spark, d))
    parts = []
    for sid in ("S1", "S2"):
        one = meta.filter(F.col("body.messageSchemaId") == sid).withColumn(
            "message", F.from_json(F.col("body.message").cast("string"), feed.metadata_schema(sid)))
        kv = struct_to_kv(one, "message.tableStructure.tableColumns")
        parts.append(kv.select(
            F.col("body.messageSchemaId").alias("messageSchemaId"),
            F.col("enqueuedTime"),
            F.col("message.lineage.table").alias("table"),
            F.explode("message.tableStructure.tableColumns").alias("kv"),
        ).select("messageSchemaId", "enqueuedTime", "table", F.col("kv.key").alias("column_name"),
                 F.col("kv.value.ordinal").alias("ordinal"), F.col("kv.value.type").alias("type"),
                 F.col("kv.value.isKey").alias("isKey")))
    return present(reduce(lambda a, b: a.unionByName(b), parts))


def q_route_schema(spark, d):
    r = CH.route_schema(raw(spark, d), "S2")
    return present(r.select(F.col("body.messageSchemaId").alias("messageSchemaId"), "enqueuedTime",
                            "rawLayerProcessingTime"))


def q_start_gate(spark, d):
    start = parse_table_config({"P1": {f"{feed.SOURCE_SCHEMA}.{feed.SINGLE_TABLE}": GATE_START}}, "P1")[0].start
    parts = []
    for e in entries():
        g = CH.start_gate(decoded(spark, d, e), F.col("content.headers.timestamp"), start)
        parts.append(g.select(F.col("content.headers.changeSequence").alias("changeSequence"),
                              F.col("content.headers.timestamp").alias("captured")))
    return reduce(lambda a, b: a.unionByName(b), parts)


def q_pk_changed(spark, d):
    parts = []
    for e in entries():
        f = framed(spark, d, e)
        parts.append(f.filter(CH.key_changed(f, e.key_columns)).select(
            "_changeSequence", "_operation", F.col("data.RRN").alias("RRN"),
            F.col("beforeData.RRN").alias("BEFORE_RRN")))
    return reduce(lambda a, b: a.unionByName(b), parts)


def q_sample_schema(spark, d):
    e = entries()[1]
    return present(CH.sample_rows(framed(spark, d, e).drop("data", "beforeData"), 10, ["_changeSequence"]))


def q_except_rows(spark, d):
    parts = []
    for e in entries():
        f = framed(spark, d, e).select("_changeSequence", "_operation", F.col("data.RRN").alias("RRN"),
                                       F.col("beforeData.RRN").alias("BEFORE_RRN"), "data", "beforeData")
        changed = f.filter(CH.key_changed(f, e.key_columns))
        parts.append(CH.except_rows(f.drop("data", "beforeData"), changed.drop("data", "beforeData")))
    return reduce(lambda a, b: a.unionByName(b), parts)


def q_union_legs(spark, d):
    legs = []
    for e in entries():
        f = framed(spark, d, e)
        changed = CH.key_changed(f, e.key_columns)
        base = f.select("_changeSequence", "_operation", F.col("data.RRN").alias("RRN"), changed.alias("chg"))
        ins = f.filter(changed).select("_changeSequence", F.lit("INSERT").alias("_operation"),
                                       F.col("data.RRN").alias("RRN"))
        dele = f.filter(changed).select("_changeSequence", F.lit("DELETE").alias("_operation"),
                                        F.col("beforeData.RRN").alias("RRN"))
        legs += [base.filter(~F.col("chg")).drop("chg"), ins, dele]
    return CH.union_legs(*legs)


def q_pk_split(spark, d):
    rows = all_split_rows(spark, d).withColumn("AMOUNT", F.col("AMOUNT").cast("double"))
    return present(rows.drop("_structuredLayerProcessingTime"))


def q_latest_per_key(spark, d):
    rows = trim_strings(apply_types(all_split_rows(spark, d), [("AMOUNT", T.DecimalType(12, 2))]))
    return present(CH.latest_per_key(rows, ["RRN"]))


def q_update_set(spark, d):
    return present(all_update_sets(spark, d))


def q_column_order(spark, d):
    """Each row's values in the order of its columns, as one text."""
    parts = []
    for e in entries():
        shown = present(update_set(spark, d, e)[0].withColumn("AMOUNT", F.col("AMOUNT").cast("string")))
        parts.append(shown.select(F.concat_ws("|", *[F.col(c).cast("string") for c in shown.columns]).alias("row_text")))
    return reduce(lambda a, b: a.unionByName(b), parts)


def q_typed_rows(spark, d):
    parts = []
    for e in entries():
        resolved = resolve_types(list(e.columns), T.StructType(), e.table)
        parts.append(apply_types(split_rows(spark, d, e), resolved))
    both = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    return present(both.select("_changeSequence", "_operation", "RRN", "AMOUNT", "KVAL", "NOTE"))


def q_default_columns(spark, d):
    parts = [default_columns(split_rows(spark, d, e))[0] for e in entries()]
    both = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    return present(both.select("_changeSequence", "RRN", "DATAPARTITIONNUM", "DATAPARTITIONNAME"))


def q_merge_init(spark, d):
    """First load of a table: the latest change per key over the whole feed."""
    path = scratch_path(spark, "init")
    typed = trim_strings(apply_types(all_split_rows(spark, d), [("AMOUNT", T.DecimalType(12, 2))]))
    tables.overwrite(spark, path, default_columns(CH.latest_per_key(typed, ["RRN"]))[0], ["RRN"])
    return present(tables.read_table(spark, path))


def q_merge_upsert(spark, d):
    s1, _ = update_set(spark, d, entries()[0])
    s2, cols = update_set(spark, d, entries()[1], s1.schema)
    return present(snapshot_rows(merge_upsert(s1, s2, ["RRN"], update_cols=cols)))


def q_schema_evolve(spark, d):
    return present(tables.read_table(spark, flagship_table(spark, d)))


def q_live_rows(spark, d):
    """Live rows straight from the feed, without a table between."""
    typed = trim_strings(apply_types(all_split_rows(spark, d), [("AMOUNT", T.DecimalType(12, 2))]))
    return present(CH.live_rows(CH.latest_per_key(typed, ["RRN"])))


def q_scan_table(spark, d):
    return present(tables.read_table(spark, flagship_table(spark, d)))


def q_merge_partial(spark, d):
    """Existing rows carry NOTE; the newer update set does not send it."""
    full = trim_strings(apply_types(all_split_rows(spark, d), [("AMOUNT", T.DecimalType(12, 2))]))
    full = full.withColumn("NOTE", F.lower(F.col("_operation")))
    old = CH.latest_per_key(full.filter(F.col("_messageSchemaId") == "S1"), ["RRN"])
    new = CH.latest_per_key(full.filter(F.col("_messageSchemaId") == "S2").drop("NOTE"), ["RRN"])
    return present(snapshot_rows(merge_upsert(old, new, ["RRN"])))


def week_batches(r: DataFrame) -> list[DataFrame]:
    """The raw feed cut into four batches by enqueue time (pushed to the scan)."""
    t = F.col("enqueuedTime")
    cuts = [F.lit(x).cast("timestamp") for x in WEEK_CUTS]
    return [r.filter(t < cuts[0]), r.filter((t >= cuts[0]) & (t < cuts[1])),
            r.filter((t >= cuts[1]) & (t < cuts[2])), r.filter(t >= cuts[2])]


def _feed_batches(spark, d, order: list[int]) -> DataFrame:
    """Split the raw feed into four batches by capture week and apply them in ``order``."""
    root = scratch_path(spark, "batches")
    weeks = week_batches(raw_table(spark, d))
    cfg = TableConfig(feed.SOURCE_SCHEMA, feed.SINGLE_TABLE)
    for wk in order:
        batch = weeks[wk]
        for e in entries():
            ST.process_schema(spark, batch, wk, e, cfg, root, OPTS)
    return tables.read_table(spark, ST.table_path(root, feed.SOURCE_SCHEMA, feed.SINGLE_TABLE))


def q_late_arrival(spark, d):
    """Batches applied newest first: late changes never overwrite newer ones."""
    return present(_feed_batches(spark, d, [3, 1, 2, 0]))


def q_merge_replay(spark, d):
    """Every batch applied twice: a replay changes nothing."""
    return present(_feed_batches(spark, d, [0, 0, 1, 2, 1, 3, 3]))


def q_change_feed(spark, d):
    return present(tables.read_change_feed(spark, flagship_table(spark, d), 0))


def q_change_feed_post(spark, d):
    return present(post_images(tables.read_change_feed(spark, flagship_table(spark, d), 0)))


def q_latest_per_rrn(spark, d):
    fd = post_images(tables.read_change_feed(spark, flagship_table(spark, d), 0))
    return present(stage_for_db(fd))


def q_delete_where(spark, d):
    path = flagship_table(spark, d)
    tables.delete_where(spark, path, F.col("NOTE") == "view")
    return present(tables.read_table(spark, path))


def q_compact(spark, d):
    """Many small files of a folder rewritten into few."""
    path, few = scratch_path(spark, "small-files"), scratch_path(spark, "compacted")
    tables.read_table(spark, flagship_table(spark, d)).repartition(32).write.parquet(path)
    folders.compact(spark, path, few)
    return present(spark.read.parquet(few))


def q_distinct_ids(spark, d):
    return CH.distinct_values(raw(spark, d, 3), "body.messageSchemaId", "messageSchemaId")


def q_dedup_key(spark, d):
    meta = feed.metadata_envelopes(events(spark, d), 3)
    first = CH.first_per_key(meta, F.col("body.messageSchemaId"), "messageSchemaId", ["enqueuedTime"])
    return present(first.select("messageSchemaId", "enqueuedTime"))


def q_anti_new_ids(spark, d):
    reg = REG.read_registry(spark, registry_table(spark, d, 3, before=feed.SCHEMA_SPLIT))
    meta = feed.metadata_envelopes(events(spark, d), 3)
    return present(REG.new_schema_ids(meta, reg).select(F.col("_messageSchemaId").alias("messageSchemaId"),
                                                        "enqueuedTime"))


def q_registry_ingest(spark, d):
    reg = REG.read_registry(spark, registry_table(spark, d, 3))
    return reg.select("messageSchemaId", "schema", "table", "timestamp", "dataSchema",
                      F.explode("tableColumns").alias("kv")).select(
        "messageSchemaId", "schema", "table", "timestamp", "dataSchema",
        F.col("kv.key").alias("column_name"), F.col("kv.value.type").alias("type"),
        F.col("kv.value.precision").alias("precision"), F.col("kv.value.scale").alias("scale"),
        F.col("kv.value.isKey").alias("isKey"), F.col("kv.value.isPii").alias("isPii"))


def q_registry_order(spark, d):
    """Registry entries as the structured leg applies them: oldest schema first in each table."""
    ordered = REG.apply_order(REG.read_registry(spark, registry_table(spark, d, 3)))
    return ordered.select("schema", "table", "messageSchemaId", "timestamp", "apply_order")


def q_route_tables(spark, d):
    reg = REG.read_registry(spark, registry_table(spark, d, 3))
    routed = REG.route_tables(raw(spark, d, 3), reg, LISTED_TABLES)
    return present(routed.select(F.col("body.messageSchemaId").alias("messageSchemaId"), "schema", "table",
                                 "enqueuedTime"))


def q_pivot_counts(spark, d):
    return present(detail_counts(spark, d))


def q_count_rollup(spark, d):
    return present(count_rollup(detail_counts(spark, d)))


def q_max_date(spark, d):
    return present(max_value(detail_counts(spark, d), "rawLayerDate", "maxRawLayerDate"))


def q_count_rollup_incr(spark, d):
    """Detail appended in four weekly batches, incremental roll-up after each."""
    detail_path, agg_path = scratch_path(spark, "detail"), scratch_path(spark, "agg")
    for wk, batch in enumerate(week_batches(raw_table(spark, d))):
        detail = CNT.count_detail(CNT.batch_counts(batch, entries(), OPTS), wk, OPTS.source_name, entries())
        CNT.append_counts(detail_path, detail, "weeks", wk)
        CNT.rollup_incremental(spark, detail_path, agg_path, OPTS.source_name)
    return present(CNT.read_rollup(spark, agg_path))


def q_fn_concat(spark, d):
    parts = [framed(spark, d, e).select(F.col("_changeSequence")) for e in entries()]
    return reduce(lambda a, b: a.unionByName(b), parts)


def q_fn_timestamp(spark, d):
    parts = [framed(spark, d, e).select("_changeSequence", "_qlikCapturedTime") for e in entries()]
    return present(reduce(lambda a, b: a.unionByName(b), parts))


def q_fn_date(spark, d):
    parts = [count_input(decoded(spark, d, e)) for e in entries()]
    return present(reduce(lambda a, b: a.unionByName(b), parts))


def q_trim_strings(spark, d):
    docs = spark.read.parquet(f"{d}/documents.parquet")
    padded = docs.select("doc_id", F.concat(F.lit("  "), F.col("text"), F.lit(" ")).alias("text"),
                         F.concat(F.lit("\t"), F.col("lang"), F.lit(" ")).alias("lang"),
                         F.concat(F.lit(" "), F.col("source")).alias("source"), "n_chars")
    return trim_strings(padded)


def q_encrypt_roundtrip(spark, d):
    rows = all_update_sets(spark, d)
    enc = encrypt_columns(rows.select("RRN", "_changeSequence", "NOTE", "KVAL"), ["NOTE", "KVAL"], DEMO_KEY, DEMO_KEY_ID)
    dec = decrypt_columns(enc, ["NOTE", "KVAL"], DEMO_KEY)
    return dec.withColumn("KVAL", F.col("KVAL").cast("bigint"))


def q_decrypt_cell(spark, d):
    enc = encrypt_columns(all_update_sets(spark, d).select("RRN", "NOTE"), ["NOTE"], DEMO_KEY, DEMO_KEY_ID)
    register_sql_functions(spark)
    enc.createOrReplaceTempView("tw_encrypted_notes")
    return spark.sql("SELECT RRN, decrypt_target_cell(NOTE, :key) AS NOTE FROM tw_encrypted_notes",
                     args={"key": DEMO_KEY})


def q_src_event_stream(spark, d):
    out, ck = scratch_path(spark, "events-copy"), scratch_path(spark, "ck")
    schema = events(spark, d).schema
    stream = streams.read_event_stream(spark, d, schema, max_files=1, glob="events.parquet")
    q = stream.writeStream.format("parquet").option("checkpointLocation", ck).trigger(availableNow=True).start(out)
    streams.drain(q)
    return present(spark.read.schema(schema).parquet(out))


def _write_event_log(spark, d, n_tables: int) -> str:
    """The event log the raw leg reads: envelope files derived from events."""
    log_path = scratch_path(spark, "eventlog")
    feed.data_envelopes(events(spark, d), n_tables).drop("rawLayerProcessingTime").write.parquet(log_path)
    return log_path


def q_raw_ingest(spark, d):
    log_path = _write_event_log(spark, d, 1)
    raw_path, ck = scratch_path(spark, "raw"), scratch_path(spark, "ck")
    schema = T.StructType([f for f in RAW_SCHEMA.fields if f.name != "rawLayerProcessingTime"])
    q = streams.start_raw(streams.read_event_stream(spark, log_path, schema, max_files=4), raw_path, ck,
                          available_now=True)
    streams.drain(q)
    r = spark.read.schema(RAW_SCHEMA).parquet(raw_path)
    return present(r.select(F.col("body.messageSchemaId").alias("messageSchemaId"), "enqueuedTime",
                            F.col("rawLayerProcessingTime").isNotNull().alias("stamped")))


def _raw_appends(spark, rows: DataFrame, path: str, appends: int, file_bytes: int = APPEND_FILE_BYTES) -> int:
    """A raw table that came in ``appends`` appends, of as many files each; how many.
    The changes are dealt out in one pass; an append of up to ``file_bytes`` is one file."""
    staged = scratch_path(spark, "appends")
    dealt = rows.withColumn("_append", F.pmod(F.xxhash64("body.message"), F.lit(appends)))
    dealt.write.partitionBy("_append").parquet(staged)
    dealt_out = spark.read.schema(dealt.schema).parquet(staged)
    least = dealt_out.groupBy("_append").count().agg(F.count("*"), F.min("count")).first()
    # Every file must get rows, so that each append has the same number of files.
    files = min(-(-fs.total_size(spark, staged) // (appends * file_bytes)), least[1] // 1000) if least[0] == appends else 1
    files = max(1, files)
    for i in range(appends):
        part = dealt_out.filter(F.col("_append") == i).drop("_append")
        (part.coalesce(1) if files == 1 else part.repartition(files)).write.mode("append").parquet(path)
    return files


def _structured_run(spark, d, n_tables: int, workers: int, opts: RunOptions | None = None, name: str | None = None) -> tuple[str, list[RegistryEntry]]:
    """The structured stream over a raw table that came in six appends, in as many
    micro-batches: a limit of one byte admits one file at a time, or where an append
    is several files, a limit of as many."""
    raw_path = scratch_path(spark, "raw")
    files = _raw_appends(spark, raw(spark, d, n_tables), raw_path, 6)
    reg_path = registry_table(spark, d, n_tables)
    ents = entries(n_tables)
    configs = [TableConfig(e.schema, e.table) for e in ents if e.message_schema_id.startswith("S1")]
    root, ck = scratch_path(spark, "structured"), scratch_path(spark, "ck")
    opts = opts or RunOptions(tables_in_parallel=workers)
    stream = streams.read_raw_stream(spark, raw_path, RAW_SCHEMA, max_bytes=1, max_files=files if files > 1 else None)
    q = streams.start_structured(stream, reg_path, configs, root, ck, opts, available_now=True, name=name)
    streams.drain(q)
    return root, ents


def q_structured_stream(spark, d):
    root, _ = _structured_run(spark, d, 1, 1)
    return present(tables.read_table(spark, ST.table_path(root, feed.SOURCE_SCHEMA, feed.SINGLE_TABLE)))


def q_fanout_tables(spark, d):
    root, ents = _structured_run(spark, d, 3, 3)
    names = sorted({e.table for e in ents})
    parts = [tables.read_table(spark, ST.table_path(root, feed.SOURCE_SCHEMA, t)).withColumn("table", F.lit(t))
             for t in names]
    return present(reduce(lambda a, b: a.unionByName(b), parts))


def q_publish_drain(spark, d):
    """Database leg without the database: drain the change feed with an
    AvailableNow stream of commits, stage each batch (latest per RRN, column
    order) and apply it with the same sequence-guarded merge the database
    MERGE performs, into a table read back here."""
    source = flagship_table(spark, d)
    target, ck = scratch_path(spark, "db"), scratch_path(spark, "ck")

    def handle(batch: DataFrame, batch_id: int) -> None:
        tables.merge(spark, target, stage_for_db(batch), ["RRN"])

    streams.finish(streams.start_publish(spark, source, 0, ck, handle, max_bytes=1))
    return present(tables.read_table(spark, target))


def q_change_feed_stream(spark, d):
    """The whole change feed, pre images too, through a stream that admits files up to a
    limit below the size of one version; every batch is written as it comes."""
    source, out, ck = flagship_table(spark, d), scratch_path(spark, "feed"), scratch_path(spark, "ck")
    size = tables.commits(spark, source).agg(F.min("change_bytes")).first()[0]
    files = read_change_files(spark, source, ck, list(CHANGE_KINDS), bytes_per_trigger=size // 2)

    def each(batch: DataFrame, batch_id: int) -> None:
        rows = tables.read_change_rows(spark, source, batch.collect()).withColumn("_stream_batch", F.lit(batch_id))
        folders.write_batch(rows, out, "feed", batch_id)
    streams.finish(files.writeStream.foreachBatch(each).option("checkpointLocation", ck).trigger(processingTime="0 seconds").start())
    got = folders.read(spark, out)
    if got.select("_stream_batch").distinct().count() < 3:
        raise RuntimeError("the feed came in fewer batches than its limit asks for")
    return present(got.drop("_stream_batch"))


def q_event_log_stream(spark, d):
    """The event log by sequence: four partitions, a limit of a seventh of the events a
    trigger, read by two queries over one checkpoint."""
    log_path, out, ck = scratch_path(spark, "eventlog"), scratch_path(spark, "events-copy"), scratch_path(spark, "ck")
    rows = feed.change_events(events(spark, d)).select(
        F.pmod("event_id", F.lit(4)).cast("string").alias(PARTITION), F.to_json(F.struct("event_id", "operation", "change_seq", "rrn")).cast("binary").alias("body"),
        F.col("ts").cast("timestamp").alias("enqueuedTime"), "event_id")
    numbered = rows.withColumn(SEQUENCE, F.row_number().over(Window.partitionBy(PARTITION).orderBy("event_id")).cast("long") - 1).drop("event_id")
    numbered.repartitionByRange(12, PARTITION, SEQUENCE).write.partitionBy(PARTITION).parquet(log_path)
    limit = events(spark, d).count() // 7

    def run():
        stream = read_event_log(spark, log_path, ck, events_per_trigger=limit)
        return stream.writeStream.format("parquet").option("checkpointLocation", ck).trigger(processingTime="0 seconds").start(out)
    first = run()
    watch(spark).wait(lambda: first.lastProgress is not None, 60)
    first.stop()
    streams.finish(run())
    got = spark.read.schema(f"{PARTITION} STRING, {SEQUENCE} LONG, body BINARY, enqueuedTime TIMESTAMP").parquet(out)
    body = F.from_json(F.col("body").cast("string"), "event_id LONG, operation STRING, change_seq STRING, rrn LONG")
    return present(got.withColumn("b", body).select(F.col(PARTITION).alias("log_partition"), F.col(SEQUENCE).alias("log_sequence"), "b.*", "enqueuedTime"))


def q_run_log(spark, d):
    """Log rows of the structured stream by stage, level and kind of message, from the
    stages themselves and from Spark's events of the query."""
    log_path, name = scratch_path(spark, "log"), f"run-log-{scratch_path(spark, 'n')[-12:]}"
    life = RunLog(log_path)
    watch(spark).log_to(name, life)
    _structured_run(spark, d, 3, 3, RunOptions(tables_in_parallel=3, log_path=log_path), name)
    runs = watch(spark).runs
    watch(spark).wait(lambda: any(s.name == name and s.ended for s in runs.values()), 60)
    life.flush(spark, "life")
    rows = folders.read(spark, log_path)
    kind = F.regexp_replace("message", "[0-9]+", "#")
    read = F.regexp_extract("message", "read ([0-9]+) rows", 1).try_cast("long")
    return rows.groupBy("target", "tableName", "level", kind.alias("kind")).agg(F.count("*").alias("entries"), F.coalesce(F.sum(read), F.lit(0)).alias("rows_read"))


def q_publish_tables(spark, d):
    """All tables of the fan-out published in parallel: version-gated table
    choice, one drain and checkpoint per table, sequence-guarded apply."""
    from tidewater.plans.publish import publish_tables
    batch = raw_table(spark, d, 3)
    registry = REG.read_registry(spark, registry_table(spark, d, 3))
    configs = [TableConfig(feed.SOURCE_SCHEMA, f"{feed.SINGLE_TABLE}_{p}", start_version=0) for p in range(3)]
    root, target_root, ck = scratch_path(spark, "st"), scratch_path(spark, "db"), scratch_path(spark, "ck")
    ST.process_batch(spark, batch, 0, registry, configs, root, RunOptions(tables_in_parallel=3))

    def handler_for(cfg):
        def handle(b: DataFrame, batch_id: int) -> None:
            tables.merge(spark, ST.table_path(target_root, cfg.schema, cfg.table), stage_for_db(b), ["RRN"])
        return handle

    done = publish_tables(spark, root, configs, ck, handler_for, workers=3)
    parts = [tables.read_table(spark, ST.table_path(target_root, feed.SOURCE_SCHEMA, q.split(".")[1]))
             .withColumn("table", F.lit(q.split(".")[1])) for q in sorted(done)]
    return present(reduce(lambda a, b: a.unionByName(b), parts))


def q_merge_growth(spark, d):
    """The feed in 24 batches into a table that starts as one bucket and splits as it grows."""
    path = scratch_path(spark, "growth")
    rows = trim_strings(apply_types(all_split_rows(spark, d), [("AMOUNT", T.DecimalType(12, 2))]))
    staged = scratch_path(spark, "growth-rows")
    rows.withColumn("part", F.pmod(F.xxhash64("_changeSequence"), F.lit(24))).write.partitionBy("part").parquet(staged)
    for i in range(24):
        part = spark.read.schema(rows.schema).parquet(f"{staged}/part={i}")
        tables.merge(spark, path, CH.latest_per_key(part, ["RRN"]), ["RRN"], buckets=1, bucket_bytes=16_384)
    return present(default_columns(tables.read_table(spark, path))[0])


def q_late_registry(spark, d):
    """Schema S2 is registered after all its data came: its rows are held, then applied."""
    reg, root = scratch_path(spark, "registry"), scratch_path(spark, "late")
    meta = feed.metadata_envelopes(events(spark, d))
    cfg = [TableConfig(feed.SOURCE_SCHEMA, feed.SINGLE_TABLE)]
    REG.ingest_registry(spark, meta.filter(F.col("body.messageSchemaId") == "S1"), reg)
    weeks = week_batches(raw_table(spark, d))
    for i, batch in enumerate(weeks):
        ST.process_batch(spark, batch, i, REG.RegistryCache(spark, reg), cfg, root, OPTS)
    REG.ingest_registry(spark, meta, reg)
    ST.process_batch(spark, weeks[0].limit(0), len(weeks), REG.RegistryCache(spark, reg), cfg, root, OPTS)
    return present(tables.read_table(spark, ST.table_path(root, feed.SOURCE_SCHEMA, feed.SINGLE_TABLE)))


def q_late_registry_groups(spark, d):
    """Two priority groups as streams of their own over one root. The later schema of all
    tables is registered after most of its data came, and the streams run unevenly."""
    raw_path, reg, root, ck = (scratch_path(spark, n) for n in ("raw", "registry", "groups", "ck"))
    meta = feed.metadata_envelopes(events(spark, d), 3)
    REG.ingest_registry(spark, meta.filter(F.col("body.messageSchemaId").startswith("S1")), reg)
    names = [f"{feed.SOURCE_SCHEMA}.{feed.SINGLE_TABLE}_{p}" for p in range(3)]
    start = "2023-01-01 00:00:00"
    groups = {"P1": {names[0]: start}, "P2": {n: start for n in names[1:]}}

    def run(group):
        stream = streams.read_raw_stream(spark, raw_path, RAW_SCHEMA)
        streams.drain(streams.start_structured(stream, reg, parse_table_config(groups, group), root, f"{ck}/{group}", OPTS,
                                               available_now=True))
    for i, week in enumerate(week_batches(raw(spark, d, 3))):
        week.write.mode("append").parquet(raw_path)
        if i == 2:
            REG.ingest_registry(spark, meta, reg)
        for group in {0: ["P2"], 1: ["P1", "P2"], 2: ["P1"], 3: ["P2", "P1"]}[i]:
            run(group)
    parts = [tables.read_table(spark, ST.table_path(root, *n.split("."))).withColumn("table", F.lit(n.split(".")[1])) for n in names]
    return present(reduce(lambda a, b: a.unionByName(b), parts))


def q_pii_pipeline(spark, d):
    """A PII column from the source's cipher text to the table's cells to the
    staged plain text; its type is configured per table."""
    key = DEMO_KEY
    protect_key(spark, key)
    root = scratch_path(spark, "pii")
    cfg = TableConfig(feed.SOURCE_SCHEMA, feed.SINGLE_TABLE)
    opts = RunOptions(pii_types={cfg.qualified: {"NOTE": "STRING"}}, encryption_key=key, encryption_key_id=DEMO_KEY_ID)
    seal = lambda c: F.base64(F.aes_encrypt(c, F.lit(key), F.lit("GCM")))
    for e in entries():
        batch = raw(spark, d).filter(F.col("body.messageSchemaId") == e.message_schema_id)
        if e.message_schema_id == "S2":
            e = replace(e, columns=tuple(replace(c, is_pii=True) if c.name == "NOTE" else c for c in e.columns))
            content = F.from_json(F.col("body.message").cast("string"), e.data_schema)
            batch = batch.withColumn("c", content).withColumn("c", F.col("c").withField(
                "data", F.when(F.col("c.data").isNotNull(), F.col("c.data").withField("NOTE", seal(F.col("c.data.NOTE"))))).withField(
                "beforeData", F.when(F.col("c.beforeData").isNotNull(), F.col("c.beforeData").withField("NOTE", seal(F.col("c.beforeData.NOTE"))))))
            batch = batch.withColumn("body", F.col("body").withField("message", F.to_json("c").cast("binary"))).drop("c")
        ST.process_schema(spark, batch, 0, e, cfg, root, opts)
    table = tables.read_table(spark, ST.table_path(root, cfg.schema, cfg.table))
    return present(stage_for_db(table, pii=["NOTE"], key=key))


QUERIES = {
    "flagship": q_flagship,
    "nested_project": q_nested_project,
    "flatten_image": q_flatten_image,
    "framework_columns": q_framework_columns,
    "column_order": q_column_order,
    "struct_to_kv": q_struct_to_kv,
    "route_schema": q_route_schema,
    "start_gate": q_start_gate,
    "pk_changed": q_pk_changed,
    "sample_schema": q_sample_schema,
    "change_feed_post": q_change_feed_post,
    "anti_new_ids": q_anti_new_ids,
    "merge_upsert": q_merge_upsert,
    "route_tables": q_route_tables,
    "distinct_ids": q_distinct_ids,
    "dedup_key": q_dedup_key,
    "pivot_counts": q_pivot_counts,
    "count_rollup": q_count_rollup,
    "max_date": q_max_date,
    "latest_per_key": q_latest_per_key,
    "latest_per_rrn": q_latest_per_rrn,
    "registry_order": q_registry_order,
    "except_rows": q_except_rows,
    "union_legs": q_union_legs,
    "fn_concat": q_fn_concat,
    "fn_timestamp": q_fn_timestamp,
    "fn_date": q_fn_date,
    "trim_strings": q_trim_strings,
    "default_columns": q_default_columns,
    "decode_payload": q_decode_payload,
    "decode_avro": q_decode_avro,
    "late_arrival": q_late_arrival,
    "merge_replay": q_merge_replay,
    "fanout_tables": q_fanout_tables,
    "encrypt_roundtrip": q_encrypt_roundtrip,
    "decrypt_cell": q_decrypt_cell,
    "registry_ingest": q_registry_ingest,
    "typed_rows": q_typed_rows,
    "pk_split": q_pk_split,
    "merge_partial": q_merge_partial,
    "schema_evolve": q_schema_evolve,
    "update_set": q_update_set,
    "count_rollup_incr": q_count_rollup_incr,
    "change_feed": q_change_feed,
    "live_rows": q_live_rows,
    "merge_init": q_merge_init,
    "scan_table": q_scan_table,
    "delete_where": q_delete_where,
    "compact": q_compact,
    "structured_stream": q_structured_stream,
    "raw_ingest": q_raw_ingest,
    "src_event_stream": q_src_event_stream,
    "publish_drain": q_publish_drain,
    "change_feed_stream": q_change_feed_stream,
    "event_log_stream": q_event_log_stream,
    "run_log": q_run_log,
    "publish_tables": q_publish_tables,
    "merge_growth": q_merge_growth,
    "late_registry": q_late_registry,
    "late_registry_groups": q_late_registry_groups,
    "pii_pipeline": q_pii_pipeline,
}
