"""DuckDB SQL equivalents of the registered queries, over the same tables.

Written independently of the Spark plans: plain SQL over ``events`` (and
``documents``), so a match means the Spark operators compute the intended
semantics.
"""

from __future__ import annotations

from tidewater.sources import feed

FMT = "'%Y-%m-%d %H:%M:%S.%f'"
DFMT = "'%Y-%m-%d'"


def ts(x: str) -> str:
    return f"strftime({x}, {FMT})"


def dt(x: str) -> str:
    return f"strftime(CAST({x} AS DATE), {DFMT})"


FEED = """feed AS (
  SELECT event_id, ts, user_id, event_type,
    CASE event_type WHEN 'signup' THEN 'INSERT' WHEN 'error' THEN 'DELETE' ELSE 'UPDATE' END AS op,
    concat('10', strftime(ts, '%Y%m%d%H%M%S'), lpad(CAST(event_id AS VARCHAR), 21, '0')) AS seq,
    CASE WHEN ts < TIMESTAMP '2024-01-16 00:00:00' THEN 'S1' ELSE 'S2' END AS sid,
    CASE WHEN event_type = 'purchase' AND event_id % 10 = 0 THEN user_id + 100000 ELSE user_id END AS rrn,
    CASE WHEN event_type IN ('signup', 'error') THEN NULL ELSE user_id END AS before_rrn,
    value AS amount,
    CAST(json_extract_string(props, '$.k') AS BIGINT) AS kval,
    concat('  ', event_type, ' ') AS note,
    ts + INTERVAL 5 SECOND AS enq,
    ts + INTERVAL 65 SECOND AS rawt,
    user_id % 3 AS part
  FROM events)"""

CHG = """chg AS (
  SELECT *, COALESCE(op = 'UPDATE' AND before_rrn IS NOT NULL AND rrn IS DISTINCT FROM before_rrn, false) AS changed
  FROM feed)"""

SPLIT = """split AS (
  SELECT *, op AS sop, rrn AS key FROM chg WHERE NOT changed
  UNION ALL SELECT *, 'INSERT' AS sop, rrn AS key FROM chg WHERE changed
  UNION ALL SELECT *, 'DELETE' AS sop, before_rrn AS key FROM chg WHERE changed)"""

LATEST = """lat AS (
  SELECT * FROM split QUALIFY row_number() OVER (PARTITION BY key ORDER BY seq DESC) = 1)"""

LATEST_BY_SCHEMA = """lats AS (
  SELECT * FROM split QUALIFY row_number() OVER (PARTITION BY sid, key ORDER BY seq DESC) = 1)"""

BASE = f"WITH {FEED},\n{CHG},\n{SPLIT}"


def frame_cols(a: str = "") -> str:
    """Framework columns (no processing time)."""
    p = f"{a}." if a else ""
    return (f"{p}sop AS _operation, {p}seq AS _changeSequence, {p}sid AS _messageSchemaId, "
            f"{ts(p + 'ts')} AS _qlikCapturedTime, {ts(p + 'enq')} AS _ehEnqueuedTime, "
            f"{ts(p + 'rawt')} AS _rawLayerProcessingTime")


def amount(a: str = "") -> str:
    p = f"{a}." if a else ""
    return f"CAST(CAST({p}amount AS DECIMAL(12,2)) AS DOUBLE) AS AMOUNT"


def note_trimmed(a: str = "") -> str:
    p = f"{a}." if a else ""
    return f"CASE WHEN {p}sid = 'S2' THEN trim({p}note, ' ') END AS NOTE"


def row_cols(a: str = "", partitions: bool = True, note: str | None = None) -> str:
    p = f"{a}." if a else ""
    parts = "CAST(-1 AS BIGINT) AS DATAPARTITIONNUM, '' AS DATAPARTITIONNAME, " if partitions else ""
    return (f"{p}key AS RRN, {parts}{frame_cols(a)}, {amount(a)}, {p}kval AS KVAL, "
            f"{note if note is not None else note_trimmed(a)}")


MERGED = f"{BASE},\n{LATEST}\nSELECT {row_cols()} FROM lat"
LIVE = f"{BASE},\n{LATEST}\nSELECT {row_cols()} FROM lat WHERE sop <> 'DELETE'"


def _change_feed(post_only: bool) -> str:
    s1 = "(SELECT * FROM lats WHERE sid = 'S1')"
    s2 = "(SELECT * FROM lats WHERE sid = 'S2')"
    legs = [
        f"SELECT {row_cols('a', note='CAST(NULL AS VARCHAR) AS NOTE')}, 'insert' AS _change_type, "
        f"CAST(0 AS BIGINT) AS _commit_version FROM {s1} a",
        f"SELECT {row_cols('b')}, 'insert', CAST(1 AS BIGINT) FROM {s2} b "
        f"WHERE b.key NOT IN (SELECT key FROM {s1} x)",
        f"SELECT {row_cols('b')}, 'update_postimage', CAST(1 AS BIGINT) FROM {s2} b "
        f"WHERE b.key IN (SELECT key FROM {s1} x)",
    ]
    if not post_only:
        legs.append(
            f"SELECT {row_cols('a', note='CAST(NULL AS VARCHAR) AS NOTE')}, 'update_preimage', "
            f"CAST(1 AS BIGINT) FROM {s1} a WHERE a.key IN (SELECT key FROM {s2} x)")
    return f"{BASE},\n{LATEST_BY_SCHEMA}\n" + "\nUNION ALL ".join(legs)


def _columns_values() -> str:
    rows = []
    for sid, cols in feed.COLUMNS.items():
        for i, c in enumerate(cols):
            prec = "NULL" if c.precision is None else str(c.precision)
            scale = "NULL" if c.scale is None else str(c.scale)
            rows.append(f"('{sid}', '{c.name}', {i + 1}, '{c.type}', {prec}, {scale}, "
                        f"{'true' if c.is_key else 'false'}, {'true' if c.is_pii else 'false'}, "
                        f"'{feed.data_schema(sid)}', '{feed.SCHEMA_START[sid]}')")
    return ("cols(sid, column_name, ordinal, type, precision, scale, isKey, isPii, dataSchema, start) AS "
            "(SELECT sid, column_name, CAST(ordinal AS INTEGER) AS ordinal, type, CAST(precision AS INTEGER) "
            "AS precision, CAST(scale AS INTEGER) AS scale, isKey, isPii, dataSchema, start FROM (VALUES "
            + ", ".join(rows) + ") v(sid, column_name, ordinal, type, precision, scale, isKey, isPii, "
            "dataSchema, start))")


def _detail() -> str:
    return (f"{BASE}\nSELECT 'SOURCE' AS sourceName, 'raw-cdc-data' AS layer, 'SRC' AS sourceSchema, "
            "'EVENTS' AS tableName, sid AS messageSchemaId, CAST(-1 AS BIGINT) AS jobId, "
            "CAST(-1 AS BIGINT) AS runId, CAST(0 AS BIGINT) AS batchId, "
            f"{dt('ts')} AS qlikCapturedDate, {dt('enq')} AS ehEnqueuedDate, {dt('rawt')} AS rawLayerDate, "
            "CAST(NULLIF(count(*) FILTER (WHERE op = 'DELETE'), 0) AS BIGINT) AS \"DELETE\", "
            "CAST(NULLIF(count(*) FILTER (WHERE op = 'INSERT'), 0) AS BIGINT) AS \"INSERT\", "
            "CAST(NULLIF(count(*) FILTER (WHERE op = 'UPDATE'), 0) AS BIGINT) AS \"UPDATE\" "
            "FROM feed GROUP BY ALL")


def _rollup() -> str:
    return (f"{BASE}\nSELECT 'SOURCE' AS sourceName, 'raw-cdc-data' AS layer, 'SRC' AS sourceSchema, "
            f"'EVENTS' AS tableName, {dt('rawt')} AS rawLayerDate, "
            "CAST(count(*) FILTER (WHERE op = 'INSERT') AS BIGINT) AS \"INSERT\", "
            "CAST(count(*) FILTER (WHERE op = 'UPDATE') AS BIGINT) AS \"UPDATE\", "
            "CAST(count(*) FILTER (WHERE op = 'DELETE') AS BIGINT) AS \"DELETE\" "
            "FROM feed GROUP BY ALL")


def _merge_partial() -> str:
    o = "(SELECT * FROM lats WHERE sid = 'S1')"
    n = "(SELECT * FROM lats WHERE sid = 'S2')"

    def pick(c: str) -> str:
        return f"CASE WHEN n.key IS NOT NULL THEN n.{c} ELSE o.{c} END"
    return (f"{BASE},\n{LATEST_BY_SCHEMA}\nSELECT COALESCE(n.key, o.key) AS RRN, {pick('sop')} AS _operation, "
            f"{pick('seq')} AS _changeSequence, {pick('sid')} AS _messageSchemaId, "
            f"{ts(pick('ts'))} AS _qlikCapturedTime, {ts(pick('enq'))} AS _ehEnqueuedTime, "
            f"{ts(pick('rawt'))} AS _rawLayerProcessingTime, "
            f"CAST(CAST({pick('amount')} AS DECIMAL(12,2)) AS DOUBLE) AS AMOUNT, {pick('kval')} AS KVAL, "
            f"CASE WHEN o.key IS NOT NULL THEN lower(o.sop) END AS NOTE "
            f"FROM {o} o FULL OUTER JOIN {n} n ON o.key = n.key")


def _fanout() -> str:
    return (f"{BASE},\nlatp AS (SELECT * FROM split QUALIFY row_number() OVER "
            "(PARTITION BY part, key ORDER BY seq DESC) = 1)\n"
            f"SELECT key AS RRN, CAST(-1 AS BIGINT) AS DATAPARTITIONNUM, '' AS DATAPARTITIONNAME, "
            f"sop AS _operation, seq AS _changeSequence, concat(sid, '_', CAST(part AS VARCHAR)) AS _messageSchemaId, "
            f"{ts('ts')} AS _qlikCapturedTime, {ts('enq')} AS _ehEnqueuedTime, {ts('rawt')} AS _rawLayerProcessingTime, "
            f"{amount()}, kval AS KVAL, {note_trimmed()}, concat('EVENTS_', CAST(part AS VARCHAR)) AS \"table\" "
            "FROM latp")


def _registry(select: str) -> str:
    return (f"{BASE},\n{_columns_values()},\n"
            "ids AS (SELECT DISTINCT sid, part FROM feed)\n" + select)


SQL = {
    "flagship": LIVE,
    "live_rows": f"{BASE},\n{LATEST}\nSELECT {row_cols(partitions=False)} FROM lat WHERE sop <> 'DELETE'",
    "schema_evolve": MERGED,
    "merge_upsert": MERGED,
    "structured_stream": MERGED,
    "late_arrival": MERGED,
    "merge_replay": MERGED,
    "compact": MERGED,
    "latest_per_rrn": MERGED,
    "publish_drain": MERGED,
    "delete_where": f"{BASE},\n{LATEST}\nSELECT {row_cols()} FROM lat WHERE NOT COALESCE(sid = 'S2' AND trim(note, ' ') = 'view', false)",
    "update_set": f"{BASE},\n{LATEST_BY_SCHEMA}\nSELECT {row_cols()} FROM lats",
    "column_order": (f"{BASE},\n{LATEST_BY_SCHEMA}\nSELECT concat_ws('|', key, -1, '', sop, seq, sid, {ts('ts')}, {ts('enq')}, {ts('rawt')}, "
                     "CAST(amount AS DECIMAL(12,2)), kval, CASE WHEN sid = 'S2' THEN trim(note, ' ') END) AS row_text FROM lats"),
    "merge_init": MERGED,
    "scan_table": MERGED,
    "merge_growth": MERGED,
    "late_registry": MERGED,
    "pii_pipeline": MERGED,
    "change_feed": _change_feed(False),
    "change_feed_post": _change_feed(True),
    "nested_project": f"{BASE}\nSELECT sid AS messageSchemaId, 'data' AS type, 'EVENTS' AS \"table\", {ts('enq')} AS enqueuedTime FROM feed",
    "decode_payload": (f"{BASE}\nSELECT sid AS messageSchemaId, op AS operation, substr(seq, 3) AS changeSequence, "
                       f"{ts('ts')} AS captured, rrn AS RRN, amount AS AMOUNT, kval AS KVAL, "
                       "CASE WHEN sid = 'S2' THEN note END AS NOTE, before_rrn AS BEFORE_RRN FROM feed"),
    "flatten_image": (f"{BASE}\nSELECT seq AS _changeSequence, sop AS _operation, key AS RRN, amount AS AMOUNT, "
                      "kval AS KVAL, CASE WHEN sid = 'S2' THEN note END AS NOTE FROM split"),
    "framework_columns": (f"{BASE}\nSELECT seq AS _changeSequence, {ts('enq')} AS _ehEnqueuedTime, sid AS _messageSchemaId, "
                          f"op AS _operation, {ts('ts')} AS _qlikCapturedTime, {ts('rawt')} AS _rawLayerProcessingTime FROM feed"),
    "struct_to_kv": (f"{BASE},\n{_columns_values()}\nSELECT f.sid AS messageSchemaId, {ts('f.enq')} AS enqueuedTime, "
                     "'EVENTS' AS \"table\", c.column_name, c.ordinal, c.type, c.isKey FROM feed f JOIN cols c ON f.sid = c.sid"),
    "route_schema": (f"{BASE}\nSELECT sid AS messageSchemaId, {ts('enq')} AS enqueuedTime, "
                     f"{ts('rawt')} AS rawLayerProcessingTime FROM feed WHERE sid = 'S2'"),
    "start_gate": (f"{BASE}\nSELECT substr(seq, 3) AS changeSequence, {ts('ts')} AS captured FROM feed "
                   "WHERE ts > TIMESTAMP '2024-01-10 00:00:00'"),
    "pk_changed": f"{BASE}\nSELECT seq AS _changeSequence, op AS _operation, rrn AS RRN, before_rrn AS BEFORE_RRN FROM chg WHERE changed",
    "sample_schema": (f"{BASE}\nSELECT seq AS _changeSequence, {ts('enq')} AS _ehEnqueuedTime, sid AS _messageSchemaId, "
                      f"op AS _operation, {ts('ts')} AS _qlikCapturedTime, {ts('rawt')} AS _rawLayerProcessingTime "
                      "FROM feed WHERE sid = 'S2' ORDER BY seq LIMIT 10"),
    "except_rows": f"{BASE}\nSELECT DISTINCT seq AS _changeSequence, op AS _operation, rrn AS RRN, before_rrn AS BEFORE_RRN FROM chg WHERE NOT changed",
    "union_legs": f"{BASE}\nSELECT seq AS _changeSequence, sop AS _operation, key AS RRN FROM split",
    "pk_split": (f"{BASE}\nSELECT {frame_cols()}, key AS RRN, amount AS AMOUNT, kval AS KVAL, "
                 "CASE WHEN sid = 'S2' THEN note END AS NOTE FROM split"),
    "latest_per_key": f"{BASE},\n{LATEST}\nSELECT {row_cols(partitions=False)} FROM lat",
    "typed_rows": (f"{BASE}\nSELECT seq AS _changeSequence, sop AS _operation, key AS RRN, {amount()}, kval AS KVAL, "
                   "CASE WHEN sid = 'S2' THEN note END AS NOTE FROM split"),
    "default_columns": (f"{BASE}\nSELECT seq AS _changeSequence, key AS RRN, CAST(-1 AS BIGINT) AS DATAPARTITIONNUM, "
                        "'' AS DATAPARTITIONNAME FROM split"),
    "merge_partial": _merge_partial(),
    "distinct_ids": f"{BASE}\nSELECT DISTINCT concat(sid, '_', CAST(part AS VARCHAR)) AS messageSchemaId FROM feed",
    "dedup_key": (f"{BASE}\nSELECT concat(sid, '_', CAST(part AS VARCHAR)) AS messageSchemaId, {ts('min(enq)')} AS enqueuedTime "
                  "FROM feed GROUP BY 1"),
    "anti_new_ids": (f"{BASE}\nSELECT concat(sid, '_', CAST(part AS VARCHAR)) AS messageSchemaId, {ts('min(enq)')} AS enqueuedTime "
                     "FROM feed WHERE sid = 'S2' GROUP BY 1"),
    "registry_ingest": _registry(
        "SELECT concat(i.sid, '_', CAST(i.part AS VARCHAR)) AS messageSchemaId, 'SRC' AS schema, "
        "concat('EVENTS_', CAST(i.part AS VARCHAR)) AS \"table\", c.start AS timestamp, c.dataSchema, "
        "c.column_name, c.type, c.precision, c.scale, c.isKey, c.isPii FROM ids i JOIN cols c ON i.sid = c.sid"),
    "registry_order": _registry(
        "SELECT 'SRC' AS schema, concat('EVENTS_', CAST(part AS VARCHAR)) AS \"table\", "
        "concat(sid, '_', CAST(part AS VARCHAR)) AS messageSchemaId, "
        "CASE sid WHEN 'S1' THEN '2024-01-01 00:00:00' ELSE '2024-01-16 00:00:00' END AS timestamp, "
        "CAST(CASE sid WHEN 'S1' THEN 1 ELSE 2 END AS BIGINT) AS apply_order FROM ids"),
    "route_tables": (f"{BASE}\nSELECT concat(sid, '_', CAST(part AS VARCHAR)) AS messageSchemaId, 'SRC' AS schema, "
                     f"concat('EVENTS_', CAST(part AS VARCHAR)) AS \"table\", {ts('enq')} AS enqueuedTime "
                     "FROM feed WHERE part IN (0, 2)"),
    "pivot_counts": _detail(),
    "count_rollup": _rollup(),
    "count_rollup_incr": _rollup(),
    "max_date": f"{BASE}\nSELECT max({dt('rawt')}) AS maxRawLayerDate FROM feed",
    "fn_concat": f"{BASE}\nSELECT seq AS _changeSequence FROM feed",
    "fn_timestamp": f"{BASE}\nSELECT seq AS _changeSequence, {ts('ts')} AS _qlikCapturedTime FROM feed",
    "fn_date": (f"{BASE}\nSELECT {dt('ts')} AS qlikCapturedDate, {dt('enq')} AS ehEnqueuedDate, "
                f"{dt('rawt')} AS rawLayerDate, op AS soruceOperation FROM feed"),
    "trim_strings": ("SELECT doc_id, trim(concat('  ', text, ' '), ' ') AS text, "
                     "trim(concat(chr(9), lang, ' '), ' ') AS lang, trim(concat(' ', source), ' ') AS source, "
                     "n_chars FROM documents"),
    "encrypt_roundtrip": (f"{BASE},\n{LATEST_BY_SCHEMA}\nSELECT key AS RRN, seq AS _changeSequence, "
                          f"{note_trimmed()}, kval AS KVAL FROM lats"),
    "decrypt_cell": f"{BASE},\n{LATEST_BY_SCHEMA}\nSELECT key AS RRN, {note_trimmed()} FROM lats",
    "fanout_tables": _fanout(),
    "publish_tables": _fanout(),
    "src_event_stream": f"SELECT event_id, {ts('ts')} AS ts, user_id, event_type, value, props FROM events",
    "raw_ingest": f"{BASE}\nSELECT sid AS messageSchemaId, {ts('enq')} AS enqueuedTime, true AS stamped FROM feed",
}
SQL["decode_avro"] = SQL["decode_payload"]
SQL["late_registry_groups"] = _fanout()
SQL["change_feed_stream"] = SQL["change_feed"]
SQL["event_log_stream"] = (
    f"{BASE}\nSELECT CAST(event_id % 4 AS VARCHAR) AS log_partition, "
    "row_number() OVER (PARTITION BY event_id % 4 ORDER BY event_id) - 1 AS log_sequence, event_id, op AS operation, seq AS change_seq, "
    f"rrn, {ts('ts')} AS enqueuedTime FROM feed")
SQL["run_log"] = f"""{BASE}
SELECT 'stream' AS target, '' AS "tableName", 'INFO' AS level, 'batch # read # rows' AS kind, CAST(6 AS BIGINT) AS entries, CAST(count(*) AS BIGINT) AS rows_read FROM feed
UNION ALL SELECT 'stream', '', 'INFO', k, 1, 0 FROM (VALUES ('query started'), ('query ended')) v(k)
UNION ALL SELECT 'structured', '', 'INFO', k, 6, 0 FROM (VALUES ('batch # started'), ('batch # ended')) v(k)
UNION ALL SELECT 'structured', concat('EVENTS_', CAST(part AS VARCHAR)), 'INFO', k, 6, 0
  FROM (SELECT DISTINCT part FROM feed), (VALUES ('schema ids started'), ('merged as version #')) v(k)"""
