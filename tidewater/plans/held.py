"""Rows of schema ids that the registry does not know yet (STR-1, JON-4, SNK-4).

Each stream keeps its own, as Parquet partitions
``<root>/_held/_stream=<stream>/_id=<schema id>/_batch=<batch>``: two streams
over one root never see each other's rows. A batch asks the registry for all
held ids in one semi-join; rows of those that it knows by now are read out of
their partitions, by earlier batches only, and join the batch. Nothing is
moved: a mark beside the rows says which batch took them, so a replay of that
batch takes them again, and a later one removes them, as they are merged by
then. Rows without a schema id can never be decoded; they are kept once, under
``<root>/_dead``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewater.sources import folders, fs

HELD, DEAD = "_held", "_dead"
STREAM, ID, BATCH = "_stream", "_id", "_batch"
MARK = "_taken-"


def _folder(root: str, run: str) -> str:
    return f"{root}/{HELD}/{STREAM}={folders.folder_name(run)}"


def _name(schema_id: str) -> str:
    """A folder name for any schema id."""
    return "x" + schema_id.encode().hex()


def hold(rows: DataFrame, root: str, run: str, batch_id: int) -> None:
    """Keeps the rows of all unknown schema ids of a batch in one write; written again,
    they replace themselves."""
    named = rows.withColumn(ID, F.concat(F.lit("x"), F.lower(F.hex(F.col("body.messageSchemaId"))))).withColumn(BATCH, F.lit(int(batch_id)))
    named.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(ID, BATCH).parquet(_folder(root, run))


def bury(rows: DataFrame, root: str, run: str, batch_id: int) -> None:
    """Keeps rows without a schema id, once."""
    folders.write_batch(rows, f"{root}/{DEAD}", run, batch_id)


def held_ids(spark: SparkSession, root: str, run: str) -> list[str]:
    """Schema ids that the stream holds rows of (one folder listing)."""
    names = [n.split("=", 1)[1] for n in fs.list_names(spark, _folder(root, run)) if n.startswith(f"{ID}=x")]
    return sorted(bytes.fromhex(n[1:]).decode() for n in names)


def released(spark: SparkSession, schema: T.StructType, root: str, run: str, batch_id: int, known) -> DataFrame | None:
    """The stream's held rows whose schema id is known by now; None without any.
    ``known`` gives those of a list of ids that the registry has."""
    ids = held_ids(spark, root, run)
    take = []
    for i in known(ids) if ids else ():
        folder = f"{_folder(root, run)}/{ID}={_name(i)}"
        taken = [int(n[len(MARK):]) for n in fs.list_names(spark, folder) if n.startswith(MARK)]
        if not taken:
            fs.create_new(spark, f"{folder}/{MARK}{int(batch_id)}", "")
            take.append(i)
        elif batch_id in taken:
            take.append(i)
        elif max(taken) < batch_id:
            fs.delete_tree(spark, folder)
    if not take:
        return None
    full = T.StructType([*schema.fields, T.StructField(ID, T.StringType()), T.StructField(BATCH, T.IntegerType())])
    rows = spark.read.schema(full).parquet(_folder(root, run))
    return rows.filter(F.col(ID).isin([_name(i) for i in take]) & (F.col(BATCH) < int(batch_id))).select(*schema.fieldNames())
