"""Projection helpers over structured rows (PRJ-2..6, FUN-1..3, FUN-7, FUN-11)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewater.config import (
    DB_LEADING_COLUMNS,
    FRAMEWORK_COLUMNS,
    KEY_COLUMN,
    LEADING_COLUMNS,
    PARTITION_COLUMNS,
    PARTITION_DEFAULTS,
    SEQUENCE_PREFIX,
)


def framework_columns(decoded: DataFrame, message_schema_id: str, content: str = "content") -> DataFrame:
    """PRJ-3: the two row images plus the framework columns, in one projection.

    ``decoded`` carries ``content{headers, data, beforeData}``,
    ``_ehEnqueuedTime`` and ``_rawLayerProcessingTime``.
    """
    h = f"{content}.headers"
    cols = {
        "_changeSequence": F.concat(F.lit(SEQUENCE_PREFIX), F.col(f"{h}.changeSequence")),
        "_ehEnqueuedTime": F.col("_ehEnqueuedTime"),
        "_messageSchemaId": F.lit(message_schema_id),
        "_operation": F.col(f"{h}.operation"),
        "_qlikCapturedTime": F.try_to_timestamp(F.col(f"{h}.timestamp")),
        "_rawLayerProcessingTime": F.col("_rawLayerProcessingTime"),
        "_structuredLayerProcessingTime": F.current_timestamp(),
    }
    return decoded.select(
        F.col(f"{content}.beforeData").alias("beforeData"),
        F.col(f"{content}.data").alias("data"),
        *[cols[name].alias(name) for name in sorted(cols)],
    )


def trim_strings(df: DataFrame) -> DataFrame:
    """FUN-7: trim every top-level string column (spaces only) in one select."""
    return df.select(*[
        F.trim(F.col(f.name)).alias(f.name) if isinstance(f.dataType, T.StringType) else F.col(f.name)
        for f in df.schema.fields
    ])


def default_columns(df: DataFrame) -> tuple[DataFrame, list[str]]:
    """FUN-11 / SEM-7: add partition columns the source did not send.

    Returns the frame and the list of defaulted names, which the merge must
    leave out of its update set.
    """
    present = {c.upper() for c in df.columns}
    missing = [c for c in PARTITION_COLUMNS if c not in present]
    typed = {
        "DATAPARTITIONNUM": F.lit(PARTITION_DEFAULTS["DATAPARTITIONNUM"]).cast("bigint"),
        "DATAPARTITIONNAME": F.lit(PARTITION_DEFAULTS["DATAPARTITIONNAME"]).cast("string"),
    }
    if missing:
        df = df.withColumns({c: typed[c] for c in missing})
    return df, missing


def column_order(df: DataFrame, data_columns: list[str]) -> DataFrame:
    """PRJ-4 (structured): fixed leading columns, then data columns in source order."""
    skip = {c.upper() for c in PARTITION_COLUMNS} | {KEY_COLUMN}
    rest = [c for c in data_columns if c.upper() not in skip]
    lead = [c for c in LEADING_COLUMNS if c in df.columns]
    return df.select(*lead, *rest)


def db_column_order(df: DataFrame) -> DataFrame:
    """PRJ-4 (database): leading columns that exist, case-insensitive, then the rest."""
    upper = {c.upper(): c for c in df.columns}
    lead = [upper[c.upper()] for c in DB_LEADING_COLUMNS if c.upper() in upper]
    lead_set = {c.upper() for c in DB_LEADING_COLUMNS}
    return df.select(*lead, *[c for c in df.columns if c.upper() not in lead_set])


def sorted_after(df: DataFrame, leading: list[str]) -> DataFrame:
    """PRJ-4 (counts): fixed leading columns, then the others sorted by name."""
    rest = sorted(c for c in df.columns if c not in leading)
    return df.select(*leading, *rest)


def data_columns(df: DataFrame) -> list[str]:
    """Columns that are neither framework nor partition columns."""
    skip = {c.upper() for c in FRAMEWORK_COLUMNS}
    return [c for c in df.columns if c.upper() not in skip]


def normalized(c: Column, dtype: T.DataType) -> Column:
    """Key value as compared by the key-change test: strings are trimmed (H2)."""
    return F.trim(c) if isinstance(dtype, T.StringType) else c
