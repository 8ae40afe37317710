"""Sharding by fixed virtual slots.

A row's virtual slot is a hash of its key; a small stored table maps the slots
to shards and carries rows and bytes per slot. Changing the layout edits that
table only and appends a new version of it: ``grow`` hands some slots of every
shard to one new shard, ``rebalance`` moves a few slots from heavy shards to
light ones. Everything here is DataFrame and SQL functions.

Edge cases: a NULL key has a slot of its own; a NULL text counts as empty
(size 1); equal rows share slot and shard and get different places; an empty
table gives a map without bytes and no rows; further columns are kept.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidewater.llm.common import stored, table

#: Virtual slots; fixed for the life of a data set.
SLOTS = 4096
SHARDS = 8


def virtual_slot(key: str, slots: int = SLOTS) -> Column:
    return F.pmod(F.xxhash64(F.col(key)), F.lit(slots)).cast("int")


def _pull(slot: Column, shard: Column) -> Column:
    return F.xxhash64(slot.cast("int"), shard.cast("int"), F.lit("slot"))


def initial_map(spark: SparkSession, shards: int, slots: int = SLOTS) -> DataFrame:
    """(virtual_slot, shard): each slot goes to the shard that pulls most, so
    the map for n + 1 shards is that for n with some slots handed to shard n."""
    slot = F.col("id").cast("int")
    best = F.array_max(F.transform(F.sequence(F.lit(0), F.lit(shards - 1)),
                                   lambda s: F.struct(_pull(slot, s).alias("pull"), s.alias("shard"))))
    return spark.range(slots).select(slot.alias("virtual_slot"), best["shard"].alias("shard"))


def grow(slot_map: DataFrame, shards: int) -> DataFrame:
    """Edits a map of ``shards`` shards to one more: slots only move into it."""
    new = F.lit(shards)
    moves = _pull(F.col("virtual_slot"), new) > _pull(F.col("virtual_slot"), F.col("shard"))
    return slot_map.withColumn("shard", F.when(moves, new).otherwise(F.col("shard")))


def slot_sizes(rows: DataFrame) -> DataFrame:
    """(virtual_slot, n_rows, bytes) of rows with virtual_slot, size and n."""
    return rows.groupBy("virtual_slot").agg(F.sum("n").alias("n_rows"), F.sum(F.col("n") * F.col("size")).alias("bytes"))


def rebalance(sized_map: DataFrame, shards: int) -> DataFrame:
    """Edits a map (virtual_slot, shard, bytes) towards equal bytes: each shard
    above the mean gives its smallest slots up to its excess; given slots, laid
    end to end, go to the shards whose shortfalls cover their middle. Windows
    here run over at most SLOTS rows."""
    total = Window.partitionBy(F.lit(0))
    loads = (initial_shards(sized_map, shards).groupBy("shard").agg(F.sum("bytes").alias("load"))
             .withColumn("gap", F.sum("load").over(total) / F.lit(float(shards)) - F.col("load")))
    need = loads.filter("gap > 0").select(
        F.col("shard").alias("to"), F.sum("gap").over(Window.orderBy("shard")).alias("upto"),
        (F.sum("gap").over(Window.orderBy("shard")) - F.col("gap")).alias("from"))
    order = Window.partitionBy("shard").orderBy("bytes", "virtual_slot")
    given = (sized_map.join(F.broadcast(loads.filter("gap < 0")), "shard")
             .withColumn("given", F.sum("bytes").over(order)).filter("given <= -gap AND bytes > 0")
             .withColumn("mid", F.sum("bytes").over(Window.orderBy("virtual_slot")) - F.col("bytes") / 2)
             .select("virtual_slot", "mid"))
    moved = given.join(F.broadcast(need), (F.col("mid") >= F.col("from")) & (F.col("mid") < F.col("upto")))
    return (sized_map.join(F.broadcast(moved.select("virtual_slot", "to")), "virtual_slot", "left")
            .withColumn("shard", F.coalesce("to", "shard")).drop("to"))


def initial_shards(sized_map: DataFrame, shards: int) -> DataFrame:
    """The map's rows and one empty row per shard, so that empty shards count."""
    empty = sized_map.sparkSession.range(shards).select(F.col("id").cast("int").alias("shard"),
                                                        F.lit(0).cast("long").alias("bytes"))
    return sized_map.select("shard", F.col("bytes").cast("long").alias("bytes")).unionByName(empty)


def assign(df: DataFrame, slot_map: DataFrame, key: str = "doc_id", slots: int = SLOTS) -> DataFrame:
    """``df`` with virtual_slot and shard; no shuffle (the map has ``slots`` rows)."""
    return (df.withColumn("virtual_slot", virtual_slot(key, slots))
            .join(F.broadcast(slot_map.select("virtual_slot", "shard")), "virtual_slot"))


def sized_versions(rows: DataFrame, shards: int) -> DataFrame:
    """Versions 1 and 2 (grown by one shard) of the map with rows and bytes per
    slot. Sizes and map have SLOTS rows at most, so the sizes are broadcast and
    one task makes one file of both versions, however many partitions ``rows`` has."""
    spark = rows.sparkSession
    first = (initial_map(spark, shards).join(F.broadcast(slot_sizes(rows)), "virtual_slot", "left")
             .fillna(0, ["n_rows", "bytes"]))
    return (first.withColumn("version", F.lit(1))
            .unionByName(grow(first, shards).withColumn("version", F.lit(2))).coalesce(1))


def op1_virtual_slot_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 8 shards by the law ``key``. ``slot`` is the row's place
    in its shard, without gaps: the places of a virtual slot follow those of the
    slots before it. Equal rows are counted before they are shuffled and get
    their places by expansion, so no key gathers rows in one task."""
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = (table(spark, sf_dir, "documents")
            .select("doc_id", (F.octet_length(text).cast("long") + 1).alias("size"),
                    F.crc32(text.cast("binary")).alias("text_crc32"))
            .withColumn("virtual_slot", virtual_slot("doc_id"))
            .groupBy("virtual_slot", "doc_id", "size", "text_crc32").agg(F.count(F.lit(1)).alias("n")))
    versions = stored(spark, sized_versions(rows, SHARDS), "slot-map")
    before = Window.partitionBy("shard").orderBy("virtual_slot").rowsBetween(Window.unboundedPreceding, -1)
    layout = (versions.filter("version = 1").withColumn("start", F.coalesce(F.sum("n_rows").over(before), F.lit(0)))
              .join(F.broadcast(versions.filter("version = 2").select("virtual_slot", F.col("shard").alias("grown_shard"))),
                    "virtual_slot")
              .select("virtual_slot", "shard", "start", "grown_shard", F.col("bytes").alias("slot_bytes")))
    within = Window.partitionBy("virtual_slot").orderBy("doc_id", "size", "text_crc32")
    return (rows.withColumn("end", F.sum("n").over(within)).join(F.broadcast(layout), "virtual_slot")
            .withColumn("nth", F.explode(F.sequence(F.lit(1), F.col("n"))))
            .select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard",
                    (F.col("start") + F.col("end") - F.col("nth")).alias("slot"), "grown_shard",
                    "virtual_slot", "slot_bytes", F.lit(1).alias("map_version")))
