"""Structured change feed to a database (SEM-15, SEM-16, FLT-4, WIN-2)."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.config import KEY_COLUMN
from tidewater.functions.columns import db_column_order
from tidewater.functions.crypto import decrypt_columns
from tidewater.operators.changes import latest_per_key

FEED_COLUMNS = ("_change_type", "_commit_version", "_commit_timestamp")


def post_images(feed: DataFrame) -> DataFrame:
    """FLT-4: keep inserts and update post-images; drop pre-images and physical deletes."""
    return feed.filter(~F.col("_change_type").isin("update_preimage", "delete"))


def stage_for_db(feed_batch: DataFrame, keys: list[str] = (KEY_COLUMN,), pii: list[str] = (),
                 key: str | None = None) -> DataFrame:
    """SEM-15 data side: decrypt, latest per key, processing time, column order."""
    df = feed_batch.drop(*[c for c in FEED_COLUMNS if c in feed_batch.columns])
    if pii:
        df = decrypt_columns(df, list(pii), key)
    df = latest_per_key(df, list(keys))
    return db_column_order(df.withColumn("_dbProcessingTimestamp", F.current_timestamp()))


#: Change bytes of one micro-batch.
MAX_BYTES = 1_073_741_824


def publish_tables(spark, root: str, configs, checkpoint_root: str, handler_for, workers: int = 4,
                   max_bytes: int = MAX_BYTES, log_path: str | None = None) -> list[str]:
    """SEM-16 for all tables: keep tables whose current version reached their
    configured start version (SRC-11), then drain each table's change feed in
    its own query and checkpoint, ``workers`` tables at a time on
    separate scheduler pools (``workers=1`` is the sequential form).

    ``handler_for(config)`` returns the ``(batch_df, batch_id)`` function of
    one table, e.g. staging plus ``publish_jdbc``. Start and end of each table go
    to the run log. Returns the tables drained.
    """
    from tidewater.config import select_tables
    from tidewater.plans.runlog import RunLog
    from tidewater.plans.structured import run_parallel, table_path
    from tidewater.sources import tables
    from tidewater.streaming import streams

    current = {}
    for c in configs:
        v = tables.latest_version(spark, table_path(root, c.schema, c.table))
        if v is not None:
            current[c.qualified] = v
    chosen = select_tables(configs, current)

    def task(c):
        def run():
            checkpoint = f"{checkpoint_root}/{c.schema}/{c.table}"
            log.event(c.schema, c.table, "", "publish", "drain started")
            q = streams.start_publish(spark, table_path(root, c.schema, c.table), c.start_version or 0, checkpoint,
                                      handler_for(c), max_bytes, name=f"publish {c.qualified}")
            streams.finish(q)
            log.event(c.schema, c.table, "", "publish", "drain ended")
            return c.qualified
        return run

    log = RunLog(log_path)
    try:
        return run_parallel(spark, [task(c) for c in chosen], workers, "tidewater_publish")
    finally:
        log.flush(spark, f"publish-{uuid.uuid4().hex[:12]}")
