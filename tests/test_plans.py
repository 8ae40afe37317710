"""Plan-shape guards for the scale properties the design relies on."""

import contextlib
import io
import re


from helpers import state
from tests_conf import smoke_dir
from tidewater import catalog as C
from tidewater.operators.merge import merge_upsert
from tidewater.plans import structured as ST
from tidewater.session import scratch_path
from tidewater.sources import tables


def exchanges(plan: str) -> int:
    return len(re.findall(r"^\(\d+\) Exchange", plan, re.M))


def physical(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def test_update_set_shuffles_once_and_pushes_the_schema_filter(spark):
    e = C.entries()[1]
    raw = C.raw_table(spark, smoke_dir())
    upd, _ = ST.build_update_set(ST.change_rows_of(ST.decode_rows(raw, e, C.OPTS), e, None), e,
                                 tables.T.StructType(), C.OPTS)
    plan = physical(upd)
    assert exchanges(plan) == 1                       # latest per key only; the split is a Generate
    assert "Generate" in plan and "partial_max_by" in plan   # map-side partial aggregate before the shuffle
    assert "EqualTo(body.messageSchemaId,S2)" in plan        # nested filter pushed to the parquet scan


def test_merge_joins_on_the_keys_and_rebalances_the_write(spark):
    from pyspark.sql import functions as F
    from tidewater.sources.tables import BUCKET, bucket_of
    cur = state(spark, [(f"K{i}", "INSERT", "100", str(i)) for i in range(50)])
    merged = merge_upsert(cur, state(spark, [("K1", "UPDATE", "101", "x")]), ["RRN"])
    plan = physical(merged)
    assert exchanges(plan) == 2 and "FullOuter" in plan       # each side is shuffled once
    assert "REBALANCE_PARTITIONS_BY_COL" in physical(merged.withColumn(BUCKET, bucket_of(["RRN"], 8)).hint("rebalance", F.col(BUCKET)))


def test_table_read_prunes_partitions_and_columns(spark):
    path = scratch_path(spark, "t")
    tables.merge(spark, path, state(spark, [("A", "INSERT", "100", "1")]), ["RRN"], buckets=4)
    plan = physical(tables.read_table(spark, path).select("RRN"))
    assert "PartitionFilters" in plan and "_row_kind" in plan
    assert "ReadSchema: struct<RRN:string>" in plan


def test_latest_per_key_never_uses_a_window(spark):
    df = state(spark, [("K", "UPDATE", "100", "a"), ("K", "UPDATE", "101", "b")])
    from tidewater.operators.changes import latest_per_key
    plan = physical(latest_per_key(df, ["RRN"]))
    assert "Window" not in plan and "partial_max_by" in plan


def test_hot_key_holding_a_third_of_rows(spark):
    from tidewater.operators.changes import latest_per_key
    rows = [("HOT", "UPDATE", f"1{i:05d}", str(i)) for i in range(300)] + \
           [(f"K{i}", "UPDATE", f"1{i:05d}", str(i)) for i in range(600)]
    out = latest_per_key(state(spark, rows).repartition(8), ["RRN"])
    got = {r["RRN"]: r["AMOUNT"] for r in out.collect()}
    assert len(got) == 601 and got["HOT"] == "299"
