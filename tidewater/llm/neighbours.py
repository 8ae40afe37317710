"""Rows in global order, each beside the one after it, without one task seeing all."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Ranges per shuffle partition, so that a hash deals them evenly.
RANGES_PER_PARTITION = 4


def _count_from(limits: list[int], value: Column) -> Column:
    """How many of the sorted limits are at least ``value``: by the last ones of
    stretches of limits, then within one stretch."""
    if not limits:
        return F.lit(0)
    step = max(1, int(len(limits) ** 0.5))
    cut = [limits[i:i + step] for i in range(0, len(limits), step)]
    long = lambda xs: F.array(*[F.lit(x).cast("long") for x in xs])
    whole = F.size(F.filter(long([c[-1] for c in cut]), lambda x: x < value))
    part = F.size(F.filter(F.get(F.array(*map(long, cut)), whole), lambda x: x < value))
    return F.when(whole == len(cut), F.lit(0)).otherwise(len(limits) - whole * step - part)


def with_following_head(rows: DataFrame, key: str, tie: str) -> DataFrame:
    """``rows`` in ranges of descending ``key`` (NULL last; ``tie`` among equals),
    each range in order in one partition and followed by a copy (``is_copy``) of
    the row that comes next in the whole table; after the last comes the first.

    Only range limits and heads, one per range, pass through the driver; rows
    are shuffled once. Equal keys share a range."""
    spark = rows.sparkSession
    ranges = int(spark.conf.get("spark.sql.shuffle.partitions")) * RANGES_PER_PARTITION
    shares = F.array(*[F.lit(i / ranges) for i in range(1, ranges)])
    limits = rows.agg(F.percentile_approx(key, shares, 10 * ranges)).first()[0]
    own = F.when(F.col(key).isNull(), F.lit(ranges)).otherwise(_count_from(sorted(set(limits or [])), F.col(key)))
    ranged = rows.withColumn("range", own)
    heads = ranged.select("range", key).groupBy("range").agg(F.max(key).alias("head")).orderBy("range").collect()
    copies = [(h["head"], heads[i - 1]["range"]) for i, h in enumerate(heads)]
    to = F.broadcast(spark.createDataFrame(copies, "head long, copy_to int"))  # one row per range
    return (ranged.join(to, F.col(key).eqNullSafe(F.col("head")), "left")
            .withColumn("at", F.explode(F.array_compact(F.array(
                F.struct(F.col("range").alias("range"), F.lit(False).alias("is_copy")),
                F.when(F.col("copy_to").isNotNull(), F.struct(F.col("copy_to").alias("range"), F.lit(True).alias("is_copy")))))))
            .select(*rows.columns, "at.range", "at.is_copy").repartition(F.col("range"))
            .sortWithinPartitions("range", "is_copy", F.col(key).desc_nulls_last(), tie))
