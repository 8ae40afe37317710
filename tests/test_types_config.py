import datetime as dt

import pytest
from pyspark.sql import types as T

from tidewater.config import ColumnMeta, RegistryEntry, TableConfig, is_framework, parse_table_config, select_tables
from tidewater.functions.types import UnresolvedTypeError, apply_types, resolve_types, source_type


def test_source_types():
    assert source_type("NUMERIC", 12, 2) == T.DecimalType(12, 2)
    assert source_type("decimal(5,1)") == T.DecimalType(5, 1)
    assert source_type("LONG") == T.LongType()
    with pytest.raises(UnresolvedTypeError):
        source_type("GEOMETRY")


def test_precedence_pii_then_new_then_existing():
    cols = [ColumnMeta("RRN", "LONG", is_key=True), ColumnMeta("amount", "NUMERIC", precision=12, scale=2),
            ColumnMeta("SSN", "STRING", is_pii=True), ColumnMeta("NOTE", "STRING")]
    table = T.StructType([T.StructField("RRN", T.LongType()), T.StructField("AMOUNT", T.DecimalType(18, 4))])
    got = resolve_types(cols, table, "T", {"ssn": "STRING"})
    assert got == [("RRN", T.LongType()), ("AMOUNT", T.DecimalType(18, 4)), ("SSN", T.StringType()),
                   ("NOTE", T.StringType())]


def test_unsupported_existing_type_names_column_and_table():
    cols = [ColumnMeta("AMOUNT", "NUMERIC", precision=12, scale=2)]
    table = T.StructType([T.StructField("AMOUNT", T.DoubleType())])
    with pytest.raises(UnresolvedTypeError, match="AMOUNT.*T1"):
        resolve_types(cols, table, "T1")


def test_every_unresolved_column_is_listed():
    cols = [ColumnMeta("A", "BLOB"), ColumnMeta("B", "XML")]
    with pytest.raises(UnresolvedTypeError, match="BLOB.*XML"):
        resolve_types(cols, T.StructType(), "T")


def test_apply_types_permissive_gives_null(spark):
    df = spark.createDataFrame([("1.5",), ("x",)], "AMOUNT STRING")
    out = apply_types(df, [("AMOUNT", T.DecimalType(5, 2))], "PERMISSIVE")
    assert sorted((r[0] is None, str(r[0])) for r in out.collect()) == [(False, "1.50"), (True, "None")]
    assert out.schema["AMOUNT"].dataType == T.DecimalType(5, 2)
    assert out.filter("AMOUNT IS NULL").count() == 1


def test_merge_eligibility():
    ok = RegistryEntry("S", "A", "B", "t", (ColumnMeta("RRN", "LONG", is_key=True),), "")
    ok.check_mergeable()
    with pytest.raises(ValueError):
        RegistryEntry("S", "A", "B", "t", (ColumnMeta("RRN", "LONG"),), "").check_mergeable()
    with pytest.raises(ValueError):
        RegistryEntry("S", "A", "B", "t", (ColumnMeta("RRN", "LONG", is_key=True, is_pii=True),), "").check_mergeable()


def test_table_config_parsing_and_selection():
    cfg = parse_table_config({"P1": {"src.t1": "2024-01-01 00:00:00", "SRC.T2": 3}}, "P1")
    assert cfg[0] == TableConfig("SRC", "T1", dt.datetime(2024, 1, 1), None, "P1")
    assert cfg[1].start_version == 3
    with pytest.raises(ValueError):
        parse_table_config({"P1": {}}, "P2")
    with pytest.raises(ValueError):
        parse_table_config({"P1": {"A.B": "yesterday"}}, "P1")
    assert [c.table for c in select_tables(cfg, {"SRC.T1": 0, "SRC.T2": 2})] == ["T1"]


def test_framework_names_case_insensitive():
    assert is_framework("_OPERATION") and not is_framework("RRN")


def test_apply_types_failfast_raises_on_bad_value(spark):
    df = spark.createDataFrame([("x",)], "AMOUNT STRING")
    with pytest.raises(Exception):
        apply_types(df, [("AMOUNT", T.DecimalType(5, 2))], "FAILFAST").collect()


def test_column_orders(spark):
    from tidewater.functions.columns import column_order, db_column_order, sorted_after
    df = spark.createDataFrame([(1, "a", 2, 3, "s", "1001", "p")],
                               "AMOUNT INT, NOTE STRING, RRN BIGINT, DATAPARTITIONNUM BIGINT, "
                               "_operation STRING, _changeSequence STRING, DATAPARTITIONNAME STRING")
    assert column_order(df, ["RRN", "AMOUNT", "NOTE"]).columns == [
        "RRN", "DATAPARTITIONNUM", "DATAPARTITIONNAME", "_operation", "_changeSequence", "AMOUNT", "NOTE"]
    low = df.withColumnRenamed("RRN", "rrn")
    assert db_column_order(low).columns[:2] == ["rrn", "DATAPARTITIONNUM"]
    assert sorted_after(df, ["RRN"]).columns == ["RRN"] + sorted(c for c in df.columns if c != "RRN")


def test_stage_for_db_keeps_latest_per_rrn_in_db_order(spark):
    from tidewater.plans.publish import stage_for_db
    feed = spark.createDataFrame([(1, "UPDATE", "1001", "a", "insert", 0), (1, "UPDATE", "1002", "b", "update_postimage", 1),
                                  (2, "INSERT", "1001", "c", "insert", 0)],
                                 "RRN BIGINT, _operation STRING, _changeSequence STRING, NOTE STRING, "
                                 "_change_type STRING, _commit_version BIGINT")
    out = stage_for_db(feed)
    assert out.columns == ["RRN", "_operation", "_changeSequence", "_dbProcessingTimestamp", "NOTE"]
    assert {(r["RRN"], r["NOTE"]) for r in out.collect()} == {(1, "b"), (2, "c")}
