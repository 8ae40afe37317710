"""Hand-written change rows for unit tests."""

from __future__ import annotations

from pyspark.sql import functions as F

IMG = "STRUCT<RRN: STRING, AMOUNT: STRING>"
ROW_DDL = (f"_operation STRING, _changeSequence STRING, data {IMG}, beforeData {IMG}")


def framed(spark, rows):
    """rows: (op, seq, (rrn, amount) | None, (rrn, amount) | None)"""
    df = spark.createDataFrame(rows, ROW_DDL)
    return df.withColumns({
        "_messageSchemaId": F.lit("S"),
        "_qlikCapturedTime": F.lit(None).cast("timestamp"),
        "_ehEnqueuedTime": F.lit(None).cast("timestamp"),
        "_rawLayerProcessingTime": F.lit(None).cast("timestamp"),
        "_structuredLayerProcessingTime": F.lit(None).cast("timestamp"),
    })


STATE_DDL = "RRN STRING, _operation STRING, _changeSequence STRING, AMOUNT STRING"


def state(spark, rows, ddl=STATE_DDL):
    return spark.createDataFrame(rows, ddl)


def as_set(df, *cols):
    cols = cols or df.columns
    return {tuple(r[c] for c in cols) for r in df.collect()}
