"""Append-only Parquet folders: registry, counts, run log (SNK-6..8).

A micro-batch owns one partition folder, named by its stream run and batch id,
and overwrites it; a replayed batch therefore leaves its rows once, also after
a checkpoint was reset under another run id. Everything is Spark's Parquet
source and sink.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewater.sources import fs

RUN, BATCH = "_run", "_batch"
# Fixed: characters that a partition folder's name may hold as they are.
_PLAIN = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789-."


def folder_name(text: str) -> str:
    """A partition value for any text: other characters become ``_`` and their code."""
    return "".join(c if c in _PLAIN else f"_{ord(c):x}" for c in text) or "none"


def write_batch(df: DataFrame, path: str, run: str, batch_id: int) -> None:
    """Writes a batch's rows into its own folder, replacing what is there."""
    df.write.mode("overwrite").parquet(f"{path}/{RUN}={folder_name(run)}/{BATCH}={int(batch_id)}")


def exists(spark: SparkSession, path: str) -> bool:
    return bool(fs.list_names(spark, path))


def read(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """All rows, columns of all batches; without the columns of the folder names."""
    reader = spark.read.option("basePath", path)
    df = (reader.schema(schema) if schema else reader.option("mergeSchema", "true")).parquet(path)
    return df.drop(RUN, BATCH)


def overwrite_parts(df: DataFrame, path: str, parts: list[str]) -> None:
    """Replaces the partitions that ``df`` has rows of; the others stay."""
    (df.repartition(*[F.col(p) for p in parts]).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(*parts).parquet(path))


def compact(spark: SparkSession, path: str, target: str, file_bytes: int = 134_217_728) -> int:
    """SNK-11 as a Spark job: the rows of a folder of many small files, written
    to ``target`` in files of about ``file_bytes``; returns how many it aimed at."""
    files = max(1, -(-fs.total_size(spark, path) // file_bytes))
    read(spark, path).repartition(files).write.mode("overwrite").parquet(target)
    return files
