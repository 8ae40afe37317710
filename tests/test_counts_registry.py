import datetime as dt

from pyspark.sql import functions as F

from helpers import as_set
from tidewater import catalog as C
from tidewater.config import ColumnMeta, RegistryEntry, RunOptions, TableConfig
from tidewater.functions.columns import trim_strings
from tidewater.functions.structs import struct_to_kv
from tidewater.operators.counts import count_rollup, pivot_counts
from tidewater.plans import counts as CNT
from tidewater.plans import registry as REG
from tidewater.plans import structured as ST
from tidewater.session import scratch_path
from tidewater.sources import feed, folders

D = dt.date


def detail(spark, rows):
    return spark.createDataFrame(rows, "sourceName STRING, layer STRING, sourceSchema STRING, tableName STRING, "
                                       "rawLayerDate DATE, INSERT BIGINT, UPDATE BIGINT, DELETE BIGINT")


def test_null_operation_pivots_to_null_column(spark):
    df = spark.createDataFrame([(D(2024, 1, 1), D(2024, 1, 1), D(2024, 1, 1), None),
                                (D(2024, 1, 1), D(2024, 1, 1), D(2024, 1, 1), "INSERT")],
                               "qlikCapturedDate DATE, ehEnqueuedDate DATE, rawLayerDate DATE, soruceOperation STRING")
    out = pivot_counts(df)
    assert set(out.columns) >= {"null", "INSERT"}


def test_rollup_missing_operation_column_counts_zero(spark):
    # H8
    df = spark.createDataFrame([("A", "l", "s", "t", D(2024, 1, 1), 2)],
                               "sourceName STRING, layer STRING, sourceSchema STRING, tableName STRING, "
                               "rawLayerDate DATE, INSERT BIGINT")
    assert as_set(count_rollup(df), "INSERT", "UPDATE", "DELETE") == {(2, 0, 0)}


def test_incremental_rollup_two_sources_and_empty_aggregate(spark):
    det, agg = scratch_path(spark, "detail"), scratch_path(spark, "agg")
    folders.write_batch(detail(spark, [("A", "l", "s", "t", D(2024, 1, 1), 1, None, 2),
                                       ("B", "l", "s", "t", D(2024, 1, 1), 5, 5, 5)]), det, "r", 0)
    CNT.rollup_incremental(spark, det, agg, "A")          # H7: no aggregate yet -> full aggregation
    folders.write_batch(detail(spark, [("A", "l", "s", "t", D(2024, 1, 1), 1, 1, None),
                                       ("A", "l", "s", "t", D(2024, 1, 2), 3, None, None)]), det, "r", 1)
    CNT.rollup_incremental(spark, det, agg, "A")
    got = as_set(CNT.read_rollup(spark, agg), "sourceName", "rawLayerDate", "INSERT", "UPDATE", "DELETE")
    # H6: source B never leaks into A's rows, and the last day is rebuilt, not doubled
    assert got == {("A", D(2024, 1, 1), 2, 1, 2), ("A", D(2024, 1, 2), 3, 0, 0)}


def test_detail_retention_deletes_old_rows_of_the_source(spark):
    det, agg = scratch_path(spark, "detail"), scratch_path(spark, "agg")
    folders.write_batch(detail(spark, [("A", "l", "s", "t", D(2022, 1, 1), 1, 0, 0),
                                       ("B", "l", "s", "t", D(2022, 1, 1), 1, 0, 0),
                                       ("A", "l", "s", "t", D(2024, 1, 1), 1, 0, 0)]), det, "r", 0)
    CNT.rollup_incremental(spark, det, agg, "A")
    assert as_set(folders.read(spark, det), "sourceName", "rawLayerDate") == {
        ("B", D(2022, 1, 1)), ("A", D(2024, 1, 1))}


def test_all_rows_before_start_append_no_counts(spark):
    from tests_conf import smoke_dir
    batch = C.raw_table(spark, smoke_dir())
    root, counts = scratch_path(spark, "st"), scratch_path(spark, "counts")
    e = C.entries()[0]
    cfg = TableConfig("SRC", "EVENTS", dt.datetime(2030, 1, 1))
    assert ST.process_schema(spark, batch, 0, e, cfg, root, RunOptions(), counts) is None
    assert not folders.exists(spark, counts)


def test_registry_drops_null_ids_and_skips_known_ones(spark):
    from tests_conf import smoke_dir
    meta = feed.metadata_envelopes(C.events(spark, smoke_dir()))
    nulls = meta.limit(3).withColumn("body", F.col("body").withField("messageSchemaId", F.lit(None).cast("string")))
    path = scratch_path(spark, "reg")
    REG.ingest_registry(spark, meta.filter(F.col("body.messageSchemaId") == "S1").unionByName(nulls), path)
    assert as_set(REG.read_registry(spark, path), "messageSchemaId") == {("S1",)}
    REG.ingest_registry(spark, meta, path)
    reg = REG.read_registry(spark, path)
    assert reg.count() == 2
    ents = REG.registry_entries(reg)
    assert [e.message_schema_id for e in ents] == ["S1", "S2"]
    assert ents[1].columns == feed.COLUMNS["S2"] and ents[1].data_schema == feed.data_schema("S2")


def test_apply_order_is_the_order_of_the_entries(spark):
    rows = [("S3", "a", "t", "2024-01-02"), ("S1", "A", "T", "2024-01-02"), ("S2", "a", "t", "2024-01-01"), ("S4", "a", "u", "2024-01-03")]
    reg = spark.createDataFrame([(*r, [], None) for r in rows], REG.REGISTRY_DDL)
    got = {r["messageSchemaId"]: r["apply_order"] for r in REG.apply_order(reg).collect()}
    assert got == {"S2": 1, "S1": 2, "S3": 3, "S4": 1}
    assert [e.message_schema_id for e in REG.registry_entries(reg)] == ["S2", "S1", "S3", "S4"]


def test_struct_to_kv_keeps_other_fields(spark):
    df = spark.sql("SELECT named_struct('a', 1, 'b', named_struct('x', named_struct('p', 1, 'q', 2), 'y', 'k')) AS m")
    out = struct_to_kv(df, "m.b.x").collect()[0]["m"]
    assert out["a"] == 1 and out["b"]["y"] == "k"
    assert [(kv["key"], kv["value"]) for kv in out["b"]["x"]] == [("p", 1), ("q", 2)]


def test_trim_strips_spaces_only(spark):
    df = spark.createDataFrame([("\ta ", 1)], "s STRING, n INT")
    assert trim_strings(df).collect()[0]["s"] == "\ta"


def test_registry_entry_keys():
    e = RegistryEntry("S", "A", "B", "t", (ColumnMeta("rrn", "LONG", is_key=True), ColumnMeta("X", "LONG")), "")
    assert e.key_columns == ["RRN"] and e.qualified == "A.B"


def test_count_detail_counts_null_operations(spark):
    df = spark.createDataFrame([(D(2024, 1, 1), D(2024, 1, 1), D(2024, 1, 1), None),
                                (D(2024, 1, 1), D(2024, 1, 1), D(2024, 1, 1), "INSERT"),
                                (D(2024, 1, 1), D(2024, 1, 1), D(2024, 1, 1), "INSERT")],
                               "qlikCapturedDate DATE, ehEnqueuedDate DATE, rawLayerDate DATE, soruceOperation STRING")
    entry = RegistryEntry("S1", "S", "T", "t", (), "")
    det = CNT.count_detail(df.withColumn("messageSchemaId", F.lit("S1")), 1, "SRC", [entry])
    row = det.collect()[0]
    assert row["INSERT"] == 2 and row["null"] == 1
    assert det.columns[:12] == CNT.DETAIL_LEADING and det.columns[12:] == ["INSERT", "null"]
    assert as_set(count_rollup(det), "INSERT", "UPDATE", "DELETE") == {(2, 0, 0)}


def test_registry_cache_asks_only_for_unknown_ids(spark):
    from tests_conf import smoke_dir
    meta = feed.metadata_envelopes(C.events(spark, smoke_dir()))
    path = scratch_path(spark, "reg")
    REG.ingest_registry(spark, meta.filter(F.col("body.messageSchemaId") == "S1"), path)
    cache = REG.RegistryCache(spark, path)
    assert [e.message_schema_id for e in cache.entries(["S2", "S1"])] == ["S1"]
    REG.ingest_registry(spark, meta, path)
    assert [e.message_schema_id for e in cache.entries(["S2", "S1", "X"])] == ["S1", "S2"]
    cache.path = "/nowhere"
    assert [e.message_schema_id for e in cache.entries(["S1", "S2"])] == ["S1", "S2"]       # no read at all
