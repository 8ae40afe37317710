"""Schema registry: ingest (SEM-1), lookup (JON-4, SRT-1)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidewater.config import ColumnMeta, RegistryEntry
from tidewater.functions.codec import decode
from tidewater.functions.structs import struct_to_kv
from tidewater.operators.changes import first_per_key
from tidewater.sources import folders

# Shape of one column description in a metadata message.
COLUMN_DDL = ("STRUCT<ordinal: INT, type: STRING, length: INT, precision: INT, scale: INT, "
              "nullable: BOOLEAN, isKey: BOOLEAN, isPii: BOOLEAN>")
METADATA_DDL = ("lineage STRUCT<schema: STRING, table: STRING, timestamp: STRING>, "
                f"tableStructure STRUCT<tableColumns: MAP<STRING, {COLUMN_DDL}>>, dataSchema STRING")
REGISTRY_COLUMNS = ("messageSchemaId", "schema", "table", "timestamp", "tableColumns", "dataSchema")
REGISTRY_DDL = ("messageSchemaId STRING, schema STRING, table STRING, timestamp STRING, "
                f"tableColumns ARRAY<STRUCT<key: STRING, value: {COLUMN_DDL}>>, dataSchema STRING")
#: Rows up to which the registry is broadcast; a larger one is joined by shuffle.
BROADCAST_ROWS = 10_000


def new_schema_ids(batch: DataFrame, registry: DataFrame | None) -> DataFrame:
    """AGG-2 + JON-1: one message per schema id (earliest enqueued survives),
    minus ids already in the registry. NULL ids are dropped explicitly."""
    batch = batch.filter(F.col("body.messageSchemaId").isNotNull())
    dedup = first_per_key(batch, F.col("body.messageSchemaId"), "_messageSchemaId", ["enqueuedTime"])
    if registry is None:
        return dedup
    known = registry.select(F.col("messageSchemaId").alias("_messageSchemaId")).distinct()
    return dedup.join(F.broadcast(known) if registry_is_small(registry) else known,
                      "_messageSchemaId", "left_anti")


def registry_is_small(registry: DataFrame) -> bool:
    return registry.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS


def _registry_columns(df: DataFrame, message: str = "message") -> DataFrame:
    return df.select(
        F.col("_messageSchemaId").alias("messageSchemaId"),
        F.col(f"{message}.lineage.schema").alias("schema"),
        F.col(f"{message}.lineage.table").alias("table"),
        F.col(f"{message}.lineage.timestamp").alias("timestamp"),
        F.col(f"{message}.tableStructure.tableColumns").alias("tableColumns"),
        F.col(f"{message}.dataSchema").alias("dataSchema"),
    )


def decode_metadata(new: DataFrame, codec: str = "json", mode: str = "FAILFAST") -> DataFrame | None:
    """Decode metadata messages and turn their column map into a key/value array.

    JSON: one pass for all schema ids, reading the column object as a map and
    ordering its entries by ordinal. Avro needs each message's own writer
    schema: one decode per distinct schema (bounded), then ``struct_to_kv``
    (PRJ-7), then a union.
    """
    if codec == "json":
        decoded = new.withColumn("message", decode(F.col("body.message"), METADATA_DDL, codec, mode))
        entries = F.transform(
            F.sort_array(F.transform(F.map_entries(F.col("message.tableStructure.tableColumns")),
                                     lambda e: F.struct(e["value"]["ordinal"].alias("o"), e["key"].alias("key"),
                                                        e["value"].alias("value")))),
            lambda e: F.struct(e["key"].alias("key"), e["value"].alias("value")))
        return _registry_columns(decoded.withColumn("message", F.col("message").withField(
            "tableStructure.tableColumns", entries)))
    schemas = [r[0] for r in new.select("body.messageSchema").distinct().collect()]  # of new schema ids only
    parts = []
    for ddl in schemas:
        one = new.filter(F.col("body.messageSchema") == ddl).withColumn(
            "message", decode(F.col("body.message"), ddl, codec, mode))
        parts.append(_registry_columns(struct_to_kv(one, "message.tableStructure.tableColumns")))
    return reduce(lambda a, b: a.unionByName(b), parts) if parts else None


def read_registry(spark: SparkSession, path: str) -> DataFrame:
    """The registry table; empty before the first ingest."""
    if not folders.exists(spark, path):
        return spark.createDataFrame([], REGISTRY_DDL)
    return spark.read.schema(REGISTRY_DDL).parquet(path)


def ingest_registry(spark: SparkSession, batch: DataFrame, registry_path: str,
                    codec: str = "json", mode: str = "FAILFAST") -> int:
    """SEM-1: append the registry rows of schema ids not seen before; how many."""
    registry = read_registry(spark, registry_path) if folders.exists(spark, registry_path) else None
    rows = decode_metadata(new_schema_ids(batch, registry), codec, mode)
    if rows is None:
        return 0
    rows = rows.persist()  # a handful of rows: one per new schema id
    try:
        n = rows.count()
        if n:
            rows.coalesce(1).write.mode("append").parquet(registry_path)
        return n
    finally:
        rows.unpersist()


def _column(kv) -> ColumnMeta:
    v = kv["value"]
    return ColumnMeta(kv["key"], v["type"], v["length"], v["precision"], v["scale"],
                      bool(v["nullable"]) if v["nullable"] is not None else True,
                      bool(v["isKey"]), bool(v["isPii"]))


def apply_order(registry: DataFrame) -> DataFrame:
    """SRT-1: registry rows with their place among the schemas of their table, oldest first."""
    oldest = Window.partitionBy(F.upper("schema"), F.upper("table")).orderBy("timestamp", "messageSchemaId")
    return registry.withColumn("apply_order", F.row_number().over(oldest).cast("long"))


def registry_entries(registry: DataFrame, ids: list[str] | None = None) -> list[RegistryEntry]:
    """Registry rows as driver-side entries, oldest schema first (SRT-1).

    Only the ids of one batch are fetched; that list is bounded by the
    number of table versions, not by data volume.
    """
    if ids is not None:
        registry = registry.filter(F.col("messageSchemaId").isin(*ids))
    rows = apply_order(registry).orderBy("timestamp", "apply_order", "messageSchemaId").collect()
    return [
        RegistryEntry(r["messageSchemaId"], r["schema"], r["table"], r["timestamp"],
                      tuple(_column(kv) for kv in r["tableColumns"]),
                      r["dataSchema"])
        for r in rows
    ]


def known_ids(registry: DataFrame, ids: list[str]) -> list[str]:
    """Those of ``ids`` (a batch's or a stream's held ones) that the registry has, by one semi-join."""
    asked = registry.sparkSession.createDataFrame([(i,) for i in ids], "messageSchemaId STRING")
    return sorted(r[0] for r in asked.join(registry, "messageSchemaId", "left_semi").collect())


def route_tables(raw: DataFrame, registry: DataFrame, listed: list[str]) -> DataFrame:
    """JON-4: attach schema/table to each raw row by schema id; keep listed
    tables only, compared case-insensitively. The registry side is a small
    catalogue (checked) and is broadcast."""
    wanted = {t.upper() for t in listed}
    reg = (registry.select("messageSchemaId", "schema", "table")
           .filter(F.upper(F.concat_ws(".", "schema", "table")).isin(*wanted)))
    reg = F.broadcast(reg) if registry_is_small(registry) else reg
    return raw.join(reg, raw["body.messageSchemaId"] == reg["messageSchemaId"], "inner").drop("messageSchemaId")


class RegistryCache:
    """Registry entries held on the driver between micro-batches. An entry never
    changes, so a batch asks the registry only for schema ids not met before."""

    def __init__(self, spark, path: str):
        self.spark, self.path = spark, path
        self.by_id: dict[str, RegistryEntry] = {}

    def known(self, ids: list[str]) -> list[str]:
        """Those of ``ids`` that are registered."""
        missing = [i for i in ids if i not in self.by_id]
        found = known_ids(read_registry(self.spark, self.path), missing) if missing else []
        return sorted({i for i in ids if i in self.by_id} | set(found))

    def entries(self, ids: list[str]) -> list[RegistryEntry]:
        missing = [i for i in ids if i not in self.by_id]
        if missing:
            found = registry_entries(read_registry(self.spark, self.path), missing)
            self.by_id.update((e.message_schema_id, e) for e in found)
        known = [self.by_id[i] for i in ids if i in self.by_id]
        return sorted(known, key=lambda e: (e.timestamp, e.message_schema_id))
