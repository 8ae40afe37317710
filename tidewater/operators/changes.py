"""Change-row operators: routing, start gate, key-change split, latest per key.

All are narrow (no shuffle) except :func:`latest_per_key`, which is one
aggregation with a map-side partial step, so a hot key is reduced to one row
per input partition before anything is shuffled. (Its buffers hold whole rows,
so Spark sorts to aggregate.)
"""

from __future__ import annotations

import datetime as _dt
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


from tidewater.functions.columns import normalized

# Tie-break rank of an operation at equal sequence (H2, H3).
OPERATION_RANK = {"INSERT": 3, "UPDATE": 2, "DELETE": 1}


def route_schema(df: DataFrame, message_schema_id: str, id_col: str = "body.messageSchemaId") -> DataFrame:
    """FLT-1: rows of one message schema id."""
    return df.filter(F.col(id_col) == F.lit(message_schema_id))


def start_gate(df: DataFrame, ts: Column, start: _dt.datetime | str | None) -> DataFrame:
    """FLT-2 / FLT-3: keep rows strictly after ``start``.

    Unparseable or NULL times drop the row. With no start, everything passes.
    A ``datetime`` is read as wall-clock time of the session zone, like the text
    form, whatever zone the driver runs in.
    """
    if start is None:
        return df
    if isinstance(start, _dt.datetime):
        start = start.strftime("%Y-%m-%d %H:%M:%S.%f")
    return df.filter(F.try_to_timestamp(ts.cast("string")) > F.lit(start).cast("timestamp"))


def key_changed(df: DataFrame, keys: list[str], op: str = "_operation",
                data: str = "data", before: str = "beforeData") -> Column:
    """FLT-5: an UPDATE whose key differs between the two row images.

    String keys are compared trimmed, so a change of padding alone is not a
    key change (H2).
    """
    dtype = df.schema[data].dataType
    fields = {f.name.upper(): f for f in dtype.fields}
    diffs = []
    for k in keys:
        f = fields[k.upper()]
        a = normalized(F.col(f"{data}.{f.name}"), f.dataType)
        b = normalized(F.col(f"{before}.{f.name}"), f.dataType)
        diffs.append(~a.eqNullSafe(b))
    return (
        (F.col(op) == "UPDATE")
        & F.col(before).isNotNull()
        & F.col(data).isNotNull()
        & reduce(lambda x, y: x | y, diffs)
    )


def pk_split(df: DataFrame, keys: list[str], op: str = "_operation") -> DataFrame:
    """SEM-4: an UPDATE whose key changed becomes an INSERT of the new image
    and a DELETE of the old one, both with the same sequence; other rows pass.

    One ``explode`` over a conditional array: no shuffle, no EXCEPT. The
    output flattens the row image to top level (PRJ-2). A DELETE whose new
    image is NULL takes its values from the old image (H13).
    """
    changed = key_changed(df, keys, op)
    image = F.when((F.col(op) == "DELETE") & F.col("data").isNull(), F.col("beforeData")).otherwise(F.col("data"))
    legs = F.when(
        changed,
        F.array(
            F.struct(F.lit("INSERT").alias("op"), F.col("data").alias("img")),
            F.struct(F.lit("DELETE").alias("op"), F.col("beforeData").alias("img")),
        ),
    ).otherwise(F.array(F.struct(F.col(op).alias("op"), image.alias("img"))))
    others = [c for c in df.columns if c not in ("data", "beforeData", op)]
    fields = df.schema["data"].dataType.fieldNames()
    exploded = df.select(*others, F.explode(legs).alias("_leg"))
    return exploded.select(
        F.col("_leg.op").alias(op),
        *others,
        *[F.col(f"_leg.img.{f}").alias(f.upper()) for f in fields],
    ).select(op, *sorted(others), *[f.upper() for f in fields])


def except_rows(df: DataFrame, changed: DataFrame) -> DataFrame:
    """SET-1: EXCEPT DISTINCT on whole rows (standalone form of the split)."""
    return df.subtract(changed)


def union_legs(*legs: DataFrame) -> DataFrame:
    """SET-2: UNION ALL of the legs, matched by name."""
    return reduce(lambda a, b: a.unionByName(b), legs)


def operation_rank(op: Column) -> Column:
    expr = F.lit(0)
    for name, rank in OPERATION_RANK.items():
        expr = F.when(op == name, F.lit(rank)).otherwise(expr)
    return expr


def _hashable(dtype: T.DataType) -> bool:
    if isinstance(dtype, T.MapType):
        return False
    if isinstance(dtype, T.StructType):
        return all(_hashable(f.dataType) for f in dtype.fields)
    if isinstance(dtype, T.ArrayType):
        return _hashable(dtype.elementType)
    return True


def row_hash(df: DataFrame) -> Column:
    """A deterministic hash of every hashable column (the last tie-break)."""
    cols = [F.col(f"`{f.name}`") for f in df.schema.fields if _hashable(f.dataType)]
    return F.xxhash64(*cols) if cols else F.lit(0).cast("bigint")


def change_order(df: DataFrame, seq: str = "_changeSequence", op: str | None = "_operation") -> Column:
    """What decides between changes of one key: sequence (NULL last), operation rank,
    then a hash of the whole row, so ties have one deterministic winner (H3)."""
    return F.struct(
        F.col(seq).alias("seq"),
        (operation_rank(F.col(op)) if op else F.lit(0)).alias("rank"),
        row_hash(df).alias("tie"),
    )


def latest_per_key(df: DataFrame, keys: list[str], seq: str = "_changeSequence",
                   op: str | None = "_operation") -> DataFrame:
    """WIN-1 / WIN-2: the latest change per key.

    By ``change_order``, descending. A NULL key is one key. Expressed as ``max_by(row, order)`` per key: a partial
    aggregate runs before the shuffle, so a hot key costs one row per input
    partition, not one task holding all its rows.
    """
    key_set = {k.upper() for k in keys}
    key_cols = [c for c in df.columns if c.upper() in key_set]
    if len(key_cols) != len(key_set):
        raise ValueError(f"keys {keys} not all in {df.columns}")
    rest = [c for c in df.columns if c.upper() not in key_set]
    best = df.groupBy(*key_cols).agg(F.max_by(F.struct(*[F.col(f"`{c}`") for c in rest]), change_order(df, seq, op)).alias("__best"))
    return best.select(*[F.col(c) if c in key_cols else F.col(f"__best.`{c}`").alias(c) for c in df.columns])


def live_rows(df: DataFrame, op: str = "_operation") -> DataFrame:
    """SEM-17: current rows without tombstones (a NULL operation is live)."""
    return df.filter(~F.coalesce(F.col(op) == "DELETE", F.lit(False)))


def sample_rows(df: DataFrame, n: int, order: list[str]) -> DataFrame:
    """FLT-8: a deterministic sample: the first ``n`` rows in a total order."""
    return df.orderBy(*order).limit(n)


def distinct_values(df: DataFrame, c: str, alias: str) -> DataFrame:
    """AGG-1: distinct values of a (nested) field."""
    return df.select(F.col(c).alias(alias)).distinct()


def first_per_key(df: DataFrame, key: Column, alias: str, order: list[str]) -> DataFrame:
    """AGG-2: one row per key (NULL is one key); the survivor is the first
    row in ``order`` (hash tie-break), chosen by a partial-then-final aggregate."""
    rest = list(df.columns)
    ordering = F.struct(*[F.col(c) for c in order], row_hash(df).alias("__tie"))
    best = df.withColumn(alias, key).groupBy(alias).agg(
        F.min_by(F.struct(*[F.col(f"`{c}`") for c in rest]), ordering).alias("__first"))
    return best.select(alias, *[F.col(f"__first.`{c}`").alias(c) for c in rest])
