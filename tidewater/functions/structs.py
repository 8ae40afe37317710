"""Struct reshaping (PRJ-7)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _field_type(schema: T.StructType, path: list[str]) -> T.DataType:
    dtype: T.DataType = schema
    for name in path:
        if not isinstance(dtype, T.StructType):
            raise ValueError(f"{'.'.join(path)} does not lead through structs")
        dtype = dtype[name].dataType
    return dtype


def struct_to_kv(df: DataFrame, path: str) -> DataFrame:
    """Replace the struct at a dotted path by ``array<struct<key, value>>``.

    Parents are rebuilt with ``withField`` so every other field stays as it
    is. All member values must share one type, as an array requires.
    """
    parts = path.strip(".").split(".")
    dtype = _field_type(df.schema, parts)
    if not isinstance(dtype, T.StructType):
        raise ValueError(f"{path} is not a struct")
    kv = F.array(*[
        F.struct(F.lit(f.name).alias("key"), F.col(path).getField(f.name).alias("value"))
        for f in dtype.fields
    ])
    if len(parts) == 1:
        return df.withColumn(parts[0], kv)
    return df.withColumn(parts[0], F.col(parts[0]).withField(".".join(parts[1:]), kv))
