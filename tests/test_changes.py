from pyspark.sql import functions as F

from helpers import as_set, framed, state
from tidewater.operators import changes as CH
from tidewater.operators.merge import merge_upsert, snapshot_rows


def split(spark, rows):
    return CH.pk_split(framed(spark, rows), ["RRN"])


def test_key_change_becomes_insert_and_delete(spark):
    out = split(spark, [("UPDATE", "1001", ("B", "5"), ("A", "4"))])
    assert as_set(out, "_operation", "_changeSequence", "RRN", "AMOUNT") == {
        ("INSERT", "1001", "B", "5"), ("DELETE", "1001", "A", "4")}


def test_plain_update_passes(spark):
    out = split(spark, [("UPDATE", "1001", ("A", "5"), ("A", "4"))])
    assert as_set(out, "_operation", "RRN") == {("UPDATE", "A")}


def test_trailing_space_is_not_a_key_change(spark):
    # H2: "A " -> "A" is a plain update, no split
    out = split(spark, [("UPDATE", "1001", ("A", "5"), ("A ", "4"))])
    assert as_set(out, "_operation", "RRN") == {("UPDATE", "A")}


def test_update_with_null_before_image_does_not_split(spark):
    out = split(spark, [("UPDATE", "1001", ("B", "5"), None)])
    assert as_set(out, "_operation", "RRN") == {("UPDATE", "B")}


def test_null_operation_does_not_split(spark):
    out = split(spark, [(None, "1001", ("B", "5"), ("A", "4"))])
    assert as_set(out, "_operation", "RRN") == {(None, "B")}


def test_delete_with_null_data_takes_key_from_old_image(spark):
    # H13
    out = split(spark, [("DELETE", "1001", None, ("A", "4"))])
    assert as_set(out, "_operation", "RRN", "AMOUNT") == {("DELETE", "A", "4")}


def test_null_key_in_both_images_is_no_change(spark):
    out = split(spark, [("UPDATE", "1001", (None, "5"), (None, "4"))])
    assert as_set(out, "_operation", "RRN") == {("UPDATE", None)}


def test_key_chain_tombstones_old_keys(spark):
    # A -> B -> C through two updates: A and B deleted, C live
    rows = [("INSERT", "1001", ("A", "1"), None),
            ("UPDATE", "1002", ("B", "2"), ("A", "1")),
            ("UPDATE", "1003", ("C", "3"), ("B", "2"))]
    latest = CH.latest_per_key(split(spark, rows), ["RRN"])
    assert as_set(latest, "RRN", "_operation") == {("A", "DELETE"), ("B", "DELETE"), ("C", "INSERT")}
    assert as_set(CH.live_rows(latest), "RRN") == {("C",)}


def test_latest_per_key_text_order_and_null_sequence_last(spark):
    df = state(spark, [("K", "UPDATE", "109", "a"), ("K", "UPDATE", "1010", "b"),
                       ("N", "UPDATE", None, "x"), ("N", "UPDATE", "100", "y")])
    got = as_set(CH.latest_per_key(df, ["RRN"]), "RRN", "AMOUNT")
    # H1: sequences compare as text, so "109" > "1010"; NULL sorts last
    assert got == {("K", "a"), ("N", "y")}


def test_latest_per_key_tie_prefers_insert(spark):
    df = state(spark, [("K", "DELETE", "100", "a"), ("K", "INSERT", "100", "b")])
    assert as_set(CH.latest_per_key(df, ["RRN"]), "_operation") == {("INSERT",)}


def test_latest_per_key_null_key_is_one_key(spark):
    df = state(spark, [(None, "UPDATE", "100", "a"), (None, "UPDATE", "101", "b")])
    assert as_set(CH.latest_per_key(df, ["RRN"]), "RRN", "AMOUNT") == {(None, "b")}


def test_start_gate_is_strict_and_drops_bad_times(spark):
    df = spark.createDataFrame([("2024-01-10 00:00:00",), ("2024-01-10 00:00:01",), ("bad",), (None,)], "t STRING")
    out = CH.start_gate(df, F.col("t"), "2024-01-10 00:00:00")
    assert as_set(out) == {("2024-01-10 00:00:01",)}


def test_except_and_union_forms_agree_with_split(spark):
    rows = [("UPDATE", "1001", ("B", "5"), ("A", "4")), ("UPDATE", "1002", ("C", "1"), ("C", "1")),
            ("INSERT", "1003", ("D", "2"), None)]
    f = framed(spark, rows)
    changed = f.filter(CH.key_changed(f, ["RRN"]))
    rest = CH.except_rows(f, changed)
    ins = changed.withColumn("_operation", F.lit("INSERT")).select("_operation", F.col("data.RRN").alias("RRN"))
    dele = changed.withColumn("_operation", F.lit("DELETE")).select("_operation", F.col("beforeData.RRN").alias("RRN"))
    legs = CH.union_legs(rest.select("_operation", F.col("data.RRN").alias("RRN")), ins, dele)
    assert as_set(legs) == as_set(CH.pk_split(f, ["RRN"]), "_operation", "RRN")


def test_sample_is_deterministic(spark):
    df = state(spark, [(str(i), "UPDATE", f"{100 + i}", "a") for i in range(20)])
    a = [r["RRN"] for r in CH.sample_rows(df, 5, ["_changeSequence"]).collect()]
    assert a == ["0", "1", "2", "3", "4"]


def test_merge_after_split_reinsert_after_delete(spark):
    existing = state(spark, [("K", "DELETE", "10a", "1")])
    upd = state(spark, [("K", "INSERT", "10b", "2")])
    out = snapshot_rows(merge_upsert(existing, upd, ["RRN"]))
    assert as_set(CH.live_rows(out), "RRN", "AMOUNT") == {("K", "2")}
