"""Reconciliation counts (AGG-3, AGG-4, AGG-5, SEM-12)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.config import OPERATIONS

# Column names of the count tables, kept as the source system
# names them (the operation column's spelling included).
COUNT_DATES = ("qlikCapturedDate", "ehEnqueuedDate", "rawLayerDate")
COUNT_OPERATION = "soruceOperation"
ROLLUP_KEYS = ("sourceName", "layer", "sourceSchema", "tableName", "rawLayerDate")


def count_input(decoded: DataFrame, content: str = "content", keep: tuple[str, ...] = ()) -> DataFrame:
    """Dates and operation of every decoded change, before any start gate."""
    return decoded.select(
        *keep,
        F.to_date(F.try_to_timestamp(F.col(f"{content}.headers.timestamp"))).alias("qlikCapturedDate"),
        F.to_date(F.col("_ehEnqueuedTime")).alias("ehEnqueuedDate"),
        F.to_date(F.col("_rawLayerProcessingTime")).alias("rawLayerDate"),
        F.col(f"{content}.headers.operation").alias(COUNT_OPERATION),
    )


def pivot_counts(counts_in: DataFrame, values: list[str | None] | None = None, op: str = COUNT_OPERATION,
                 keys: tuple[str, ...] = COUNT_DATES) -> DataFrame:
    """AGG-3: count per ``keys`` (the 3 dates) pivoted on the operation.

    With ``values`` the pivot needs no extra pass to discover them. Without,
    Spark discovers them. A NULL operation becomes the column ``null``.
    """
    grouped = counts_in.groupBy(*keys)
    if values is None:
        return grouped.pivot(op).agg(F.count(F.lit(1)))
    counted = [F.count(F.when(F.col(op).eqNullSafe(F.lit(v)), 1)) for v in values]
    return grouped.agg(*[F.when(c > 0, c).alias("null" if v is None else v) for v, c in zip(values, counted)])


def count_rollup(detail: DataFrame, operations: tuple[str, ...] = OPERATIONS) -> DataFrame:
    """AGG-4: per source/layer/schema/table/day, NULL-as-zero sums per operation.

    Operation columns missing from the detail count as zero (H8).
    """
    present = set(detail.columns)
    sums = [
        F.sum(F.coalesce(F.col(o), F.lit(0)) if o in present else F.lit(0)).cast("bigint").alias(o)
        for o in sorted(operations, key=lambda x: ("INSERT", "UPDATE", "DELETE").index(x))
    ]
    return detail.groupBy(*ROLLUP_KEYS).agg(*sums)


def max_value(df: DataFrame, c: str, alias: str) -> DataFrame:
    """AGG-5: global max (one NULL row when empty)."""
    return df.agg(F.max(c).alias(alias))
