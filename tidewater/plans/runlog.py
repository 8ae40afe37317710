"""Run log (SNK-16): stage events of a micro-batch, appended once per batch.

Events are buffered on the driver (a handful per schema id) and written in
one append, so logging costs one small job per batch instead of one per stage.
"""

from __future__ import annotations

import datetime as _dt
import threading
from dataclasses import dataclass, field

from pyspark.sql import SparkSession
from pyspark.sql import types as T

from tidewater.sources import folders

# Log levels in increasing severity.
LEVELS = {"DEBUG": 10, "INFO": 20, "WARN": 30, "ERROR": 40}
LOG_SCHEMA = T.StructType([
    T.StructField("tableSchema", T.StringType()),
    T.StructField("tableName", T.StringType()),
    T.StructField("messageSchemaId", T.StringType()),
    T.StructField("target", T.StringType()),
    T.StructField("logTime", T.TimestampType()),
    T.StructField("message", T.StringType()),
    T.StructField("level", T.StringType()),
])


@dataclass
class RunLog:
    path: str | None
    min_level: str = "INFO"
    rows: list = field(default_factory=list)
    _guard: threading.Lock = field(default_factory=threading.Lock)

    def event(self, schema: str, table: str, schema_id: str, target: str, message: str,
              level: str = "INFO") -> None:
        if self.path is None or LEVELS[level] < LEVELS[self.min_level]:
            return
        row = (schema, table, schema_id, target, _dt.datetime.now(_dt.timezone.utc),
               message, level)
        with self._guard:
            self.rows.append(row)

    def flush(self, spark: SparkSession, run: str = "", batch_id: int = 0) -> None:
        """Writes the events as those of one batch; written again, they replace themselves."""
        with self._guard:
            rows, self.rows = self.rows, []
        if self.path is None or not rows:
            return
        folders.write_batch(spark.createDataFrame(rows, LOG_SCHEMA).coalesce(1), self.path, run, batch_id)
