"""Stream sources whose offsets this library sets, so that Spark bounds each micro-batch.

* ``event_log`` (SRC-1, STR-3): an event log of partitions with consecutive
  sequence numbers, kept as Parquet files ``<path>/partition=<p>/*.parquet``
  with a column ``sequence``. An offset is the next sequence of each
  partition; a trigger admits ``eventsPerTrigger`` events, shared out by what each
  partition has. Tasks read the files that hold their sequences.
* ``change_files`` (SRC-5): the change files of a table in commit order. An offset
  is (version, place in it); a trigger admits files up to ``bytesPerTrigger``,
  at least one, so a version larger than the limit takes several batches. The
  rows are the files' names, one a file; Spark's Parquet source reads them.

Spark asks a source for its newest offset without saying where the stream
stands. Each source therefore notes the end of every batch that Spark plans
in ``progress``, a file inside the query's checkpoint folder; a batch that is planned
again after a failure sets it anew. Files are reached by Arrow's file systems
(local, S3, GCS, HDFS).
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
from pyarrow import fs as afs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition
from pyspark.sql.pandas.types import to_arrow_schema

SEQUENCE, PARTITION = "sequence", "partition"
EVENTS_PER_TRIGGER = 50_000
BYTES_PER_TRIGGER = 1_073_741_824
#: Events that one task reads at most.
SLICE = 50_000
FILES_DDL = "version LONG, timestamp STRING, kind STRING, file STRING, bytes LONG"


def _reach(path: str) -> tuple[afs.FileSystem, str]:
    return afs.FileSystem.from_uri(path if "://" in path else re.sub("^file:/*", "/", path))


def _files(store: afs.FileSystem, folder: str, recursive: bool = False) -> list[afs.FileInfo]:
    """Files below a folder by name, without hidden ones."""
    found = store.get_file_info(afs.FileSelector(folder, recursive=recursive, allow_not_found=True))
    return sorted((f for f in found if f.type == afs.FileType.File and not re.search(r"/[._][^/=]*(/|$)", f.path[len(folder):])), key=lambda f: f.path)


class _Noted(DataSourceStreamReader):
    """A reader that knows where its stream stands."""

    def __init__(self, options: dict):
        self.options = options
        self.store, self.path = _reach(options["path"])
        self.notes, self.progress = _reach(options["progress"])

    def position(self) -> dict:
        if self.notes.get_file_info(self.progress).type == afs.FileType.NotFound:
            return self.initialOffset()
        with self.notes.open_input_stream(self.progress) as f:
            return json.loads(f.read())

    def note(self, end: dict) -> None:
        folder = self.progress.rpartition("/")[0]
        self.notes.create_dir(folder, recursive=True)
        new = f"{folder}/.{self.progress.rpartition('/')[2]}.new"
        with self.notes.open_output_stream(new) as f:
            f.write(json.dumps(end).encode())
        self.notes.move(new, self.progress)


# ---------------------------------------------------------------- events by sequence

@dataclass
class Slice(InputPartition):
    """Sequences [first, end) of one partition and the files that hold them."""

    partition: str
    first: int
    end: int
    files: list[str] = field(default_factory=list)


def shared_out(left: dict[str, int], limit: int) -> dict[str, int]:
    """How many of the events ``left`` in each partition a trigger of ``limit`` takes:
    in proportion, at least one of some partition."""
    total = sum(left.values())
    if total <= limit:
        return dict(left)
    out = {p: n * limit // total for p, n in left.items()}
    for p in sorted(left, key=lambda p: (out[p] - left[p] * limit / total, p))[:limit - sum(out.values())]:
        out[p] += 1
    return out


class EventLogReader(_Noted):
    def __init__(self, options: dict, schema: T.StructType):
        super().__init__(options)
        self.schema = schema
        self.limit = int(options.get("eventspertrigger", EVENTS_PER_TRIGGER))
        self.first = int(options.get("startingsequence", 0))
        self.ranges: dict[str, tuple[int, int]] = {}  # first and last sequence of each file met; files never change

    def initialOffset(self) -> dict:
        return {}

    def _log(self) -> dict[str, list[tuple[str, int, int]]]:
        """(file, first, last sequence) of each partition, in order."""
        out = {}
        for folder in self.store.get_file_info(afs.FileSelector(self.path, allow_not_found=True)):
            if folder.type == afs.FileType.Directory and folder.base_name.startswith(f"{PARTITION}="):
                found = []
                for f in _files(self.store, folder.path):
                    if f.path not in self.ranges:
                        self.ranges[f.path] = self._range(f.path)
                    found.append((f.path, *self.ranges[f.path]))
                out[folder.base_name.split("=", 1)[1]] = sorted((x for x in found if x[1] <= x[2]), key=lambda x: x[1])
        return out

    def _range(self, path: str) -> tuple[int, int]:
        meta = pq.read_metadata(path, filesystem=self.store)
        at = meta.schema.names.index(SEQUENCE)
        stats = [meta.row_group(i).column(at).statistics for i in range(meta.num_row_groups)]
        return min((s.min for s in stats), default=0), max((s.max for s in stats), default=-1)

    def latestOffset(self) -> dict:
        start = self.position()
        left = {p: max(0, files[-1][2] + 1 - start.get(p, self.first)) for p, files in self._log().items() if files}
        take = shared_out(left, self.limit)
        return {**start, **{p: start.get(p, self.first) + n for p, n in take.items() if n}}

    def partitions(self, start: dict, end: dict) -> list[Slice]:
        self.note(end)
        log, out = self._log(), []
        for p, upto in sorted(end.items()):
            for first in range(start.get(p, self.first), upto, SLICE):
                stop = min(first + SLICE, upto)
                files = [f for f, a, b in log.get(p, ()) if a < stop and b >= first]
                if not files:
                    raise ValueError(f"partition {p} of the event log no longer has sequences {first} to {stop - 1}")
                out.append(Slice(p, first, stop, files))
        return out

    def read(self, partition: Slice) -> Iterator[pa.RecordBatch]:
        target = to_arrow_schema(self.schema)
        columns = [c for c in target.names if c != PARTITION]
        for path in partition.files:
            found = pq.read_table(path, filesystem=self.store, columns=sorted({*columns, SEQUENCE}),
                                  filters=(pc.field(SEQUENCE) >= partition.first) & (pc.field(SEQUENCE) < partition.end))
            if PARTITION in target.names:
                found = found.append_column(PARTITION, pa.array([partition.partition] * len(found), pa.string()))
            yield from found.select(target.names).cast(target).to_batches()


class EventLog(DataSource):
    @classmethod
    def name(cls) -> str:
        return "event_log"

    def schema(self) -> str:
        return f"{PARTITION} STRING, {SEQUENCE} LONG, body BINARY, enqueuedTime TIMESTAMP"

    def streamReader(self, schema: T.StructType) -> EventLogReader:
        return EventLogReader({k.lower(): v for k, v in self.options.items()}, schema)


def read_event_log(spark: SparkSession, path: str, checkpoint: str, schema: T.StructType | str | None = None,
                   events_per_trigger: int = EVENTS_PER_TRIGGER, starting_sequence: int = 0) -> DataFrame:
    """SRC-1 / STR-3: the event log as a stream from ``starting_sequence`` on, at most
    ``events_per_trigger`` events a micro-batch. ``checkpoint`` is that of the query to come."""
    spark.dataSource.register(EventLog)
    r = spark.readStream.format("event_log").option("path", path).option("progress", f"{checkpoint}/progress/event_log.json") \
        .option("eventsPerTrigger", events_per_trigger).option("startingSequence", starting_sequence)
    return (r.schema(schema) if schema else r).load()


# ---------------------------------------------------------------- change files by size

class ChangeFilesReader(_Noted):
    def __init__(self, options: dict):
        super().__init__(options)
        self.limit = int(options.get("bytespertrigger", BYTES_PER_TRIGGER))
        self.kinds = options["kinds"].split(",")
        self.versions: dict[int, list[tuple]] = {}

    def initialOffset(self) -> dict:
        return {"version": int(self.options.get("startingversion", 0)), "place": 0}

    def _version(self, v: int) -> list[tuple] | None:
        """The change files of a version in order, None before it is committed."""
        if v not in self.versions:
            record = f"{self.path}/_commits/{v:020d}.json"
            if self.store.get_file_info(record).type == afs.FileType.NotFound:
                return None
            with self.store.open_input_stream(record) as f:
                commit = json.loads(f.read())
            found = _files(self.store, f"{self.path}/_dir={commit['dir']}", recursive=True)
            kinds = [(f, re.search(r"/_row_kind=([^/]+)/", f.path)) for f in found]
            self.versions = {k: x for k, x in self.versions.items() if k >= v - 1}  # earlier ones are done with
            self.versions[v] = [(v, commit["timestamp"], k.group(1), f.path[len(self.path) + 1:], f.size)
                                for f, k in kinds if k and k.group(1) in self.kinds]
        return self.versions[v]

    def _rows(self, start: dict, end: dict | None) -> tuple[list[tuple], dict]:
        """The files from ``start`` up to ``end``, or up to the limit; and where they end."""
        v, place, size, out = start["version"], start["place"], 0, []
        while (files := self._version(v)) is not None:
            while place < len(files):
                if end is not None and (v, place) >= (end["version"], end["place"]) or end is None and out and size + files[place][4] > self.limit:
                    return out, {"version": v, "place": place}
                out.append(files[place])
                size += files[place][4]
                place += 1
            if end is not None and v >= end["version"]:
                break
            v, place = v + 1, 0
        return out, {"version": v, "place": place}

    def latestOffset(self) -> dict:
        return self._rows(self.position(), None)[1]

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        self.note(end)
        return [InputPartition(self._rows(start, end)[0])]

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        yield from partition.value


class ChangeFiles(DataSource):
    @classmethod
    def name(cls) -> str:
        return "change_files"

    def schema(self) -> str:
        return FILES_DDL

    def streamReader(self, schema: T.StructType) -> ChangeFilesReader:
        return ChangeFilesReader({k.lower(): v for k, v in self.options.items()})


def read_change_files(spark: SparkSession, path: str, checkpoint: str, kinds: list[str], start_version: int = 0,
                      bytes_per_trigger: int = BYTES_PER_TRIGGER) -> DataFrame:
    """SRC-5: the change files of a table as a stream from ``start_version`` on, about
    ``bytes_per_trigger`` bytes of them a micro-batch. ``checkpoint`` is that of the query to come."""
    spark.dataSource.register(ChangeFiles)
    return spark.readStream.format("change_files").option("path", path).option("progress", f"{checkpoint}/progress/change_files.json") \
        .option("kinds", ",".join(kinds)).option("startingVersion", start_version).option("bytesPerTrigger", bytes_per_trigger).load()
