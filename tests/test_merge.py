from pyspark.sql import functions as F

from helpers import as_set, state
from tidewater.operators.merge import change_rows, merge_upsert, snapshot_rows


def merged(spark, existing, updates, **kw):
    return snapshot_rows(merge_upsert(existing, updates, ["RRN"], **kw))


def test_late_change_is_ignored(spark):
    e = state(spark, [("K", "UPDATE", "10b", "new")])
    u = state(spark, [("K", "UPDATE", "10a", "old")])
    assert as_set(merged(spark, e, u), "AMOUNT") == {("new",)}


def test_replay_changes_nothing(spark):
    e = state(spark, [("K", "UPDATE", "10a", "v")])
    u = state(spark, [("K", "UPDATE", "10a", "w")])
    out = merge_upsert(e, u, ["RRN"])
    assert as_set(snapshot_rows(out), "AMOUNT") == {("v",)}
    assert change_rows(out).count() == 0


def test_null_key_matches_null_key(spark):
    e = state(spark, [(None, "UPDATE", "100", "a")])
    u = state(spark, [(None, "UPDATE", "101", "b")])
    out = merged(spark, e, u)
    assert out.count() == 1 and as_set(out, "RRN", "AMOUNT") == {(None, "b")}


def test_null_existing_sequence_never_updates(spark):
    e = state(spark, [("K", "UPDATE", None, "a")])
    u = state(spark, [("K", "UPDATE", "10a", "b")])
    assert as_set(merged(spark, e, u), "AMOUNT") == {("a",)}


def test_unequal_width_sequences_compare_as_text(spark):
    e = state(spark, [("K", "UPDATE", "1010", "a")])
    u = state(spark, [("K", "UPDATE", "109", "b")])
    assert as_set(merged(spark, e, u), "AMOUNT") == {("b",)}


def test_delete_of_unknown_key_inserts_tombstone(spark):
    e = state(spark, [("A", "INSERT", "100", "a")])
    u = state(spark, [("Z", "DELETE", "101", "z")])
    assert as_set(merged(spark, e, u), "RRN", "_operation") == {("A", "INSERT"), ("Z", "DELETE")}


def test_new_column_is_null_for_untouched_keys(spark):
    e = state(spark, [("A", "INSERT", "100", "a"), ("B", "INSERT", "100", "b")])
    u = spark.createDataFrame([("A", "UPDATE", "101", "a2", "n")], "RRN STRING, _operation STRING, "
                              "_changeSequence STRING, AMOUNT STRING, NOTE STRING")
    out = merged(spark, e, u)
    assert out.columns[-1] == "NOTE"
    assert as_set(out, "RRN", "NOTE") == {("A", "n"), ("B", None)}


def test_absent_column_keeps_old_value_on_update_and_null_on_insert(spark):
    e = spark.createDataFrame([("A", "INSERT", "100", "a", "keep")],
                              "RRN STRING, _operation STRING, _changeSequence STRING, AMOUNT STRING, NOTE STRING")
    u = state(spark, [("A", "UPDATE", "101", "a2"), ("B", "INSERT", "101", "b")])
    assert as_set(merged(spark, e, u), "RRN", "AMOUNT", "NOTE") == {("A", "a2", "keep"), ("B", "b", None)}


def test_partition_columns_not_sent_are_kept_on_update(spark):
    e = spark.createDataFrame([("A", 7, "x", "UPDATE", "100")],
                              "RRN STRING, DATAPARTITIONNUM BIGINT, DATAPARTITIONNAME STRING, _operation STRING, "
                              "_changeSequence STRING")
    u = spark.createDataFrame([("A", -1, "", "UPDATE", "101"), ("B", -1, "", "INSERT", "101")],
                              "RRN STRING, DATAPARTITIONNUM BIGINT, DATAPARTITIONNAME STRING, _operation STRING, "
                              "_changeSequence STRING")
    out = merged(spark, e, u, update_cols=["RRN", "_operation", "_changeSequence"])
    assert as_set(out, "RRN", "DATAPARTITIONNUM", "DATAPARTITIONNAME", "_changeSequence") == {
        ("A", 7, "x", "101"), ("B", -1, "", "101")}


def test_column_name_case_is_ignored(spark):
    e = state(spark, [("A", "INSERT", "100", "a")])
    u = spark.createDataFrame([("A", "UPDATE", "101", "b")], "rrn STRING, _operation STRING, "
                              "_changeSequence STRING, amount STRING")
    out = merged(spark, e, u)
    assert out.columns == ["RRN", "_operation", "_changeSequence", "AMOUNT"]
    assert as_set(out, "AMOUNT") == {("b",)}


def test_change_rows_kinds(spark):
    e = state(spark, [("A", "INSERT", "100", "a"), ("B", "INSERT", "100", "b")])
    u = state(spark, [("A", "UPDATE", "101", "a2"), ("C", "INSERT", "101", "c")])
    ch = change_rows(merge_upsert(e, u, ["RRN"]))
    assert as_set(ch, "RRN", "AMOUNT", "_change_type") == {
        ("A", "a2", "update_postimage"), ("A", "a", "update_preimage"), ("C", "c", "insert")}


def test_stream_laws_batches_in_any_order(spark):
    rows = [("K", "UPDATE", f"1{i:03d}", str(i)) for i in range(9)] + [("J", "INSERT", "1005", "j")]
    full = merged(spark, state(spark, [], ), state(spark, rows).filter(F.col("_changeSequence") == "1008")
                  .unionByName(state(spark, [("J", "INSERT", "1005", "j")])))
    from tidewater.operators.changes import latest_per_key
    cur = state(spark, [])
    for chunk in (rows[6:], rows[:3], rows[3:6], rows[:3]):
        cur = snapshot_rows(merge_upsert(cur, latest_per_key(state(spark, chunk), ["RRN"]), ["RRN"]))
    assert as_set(cur) == as_set(full)
