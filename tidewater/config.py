"""Driver-side configuration objects (SRC-10, SRC-11, SEM-9, FLT-6, FUN-13)."""

from __future__ import annotations

import datetime as _dt
from dataclasses import dataclass, field

# Fixed values shared with the source system: framework columns on every
# structured row, the partition columns a source may omit and their defaults.
FRAMEWORK_COLUMNS = (
    "_operation",
    "_changeSequence",
    "_messageSchemaId",
    "_qlikCapturedTime",
    "_ehEnqueuedTime",
    "_rawLayerProcessingTime",
    "_structuredLayerProcessingTime",
)
KEY_COLUMN = "RRN"
PARTITION_COLUMNS = ("DATAPARTITIONNUM", "DATAPARTITIONNAME")
PARTITION_DEFAULTS = {"DATAPARTITIONNUM": -1, "DATAPARTITIONNAME": ""}
LEADING_COLUMNS = (KEY_COLUMN,) + PARTITION_COLUMNS + FRAMEWORK_COLUMNS
DB_LEADING_COLUMNS = LEADING_COLUMNS + ("_dbProcessingTimestamp",)
SEQUENCE_PREFIX = "10"
OPERATIONS = ("DELETE", "INSERT", "UPDATE")
CHANGE_TYPES = ("insert", "update_preimage", "update_postimage", "delete")
TIMESTAMP_FORMAT = "%Y-%m-%d %H:%M:%S"


def is_framework(name: str) -> bool:
    """FLT-6: whether ``name`` is a framework column, compared case-insensitively."""
    return name.upper() in {c.upper() for c in FRAMEWORK_COLUMNS}


@dataclass(frozen=True)
class ColumnMeta:
    """One source column as described by a metadata message."""

    name: str
    type: str
    length: int | None = None
    precision: int | None = None
    scale: int | None = None
    nullable: bool = True
    is_key: bool = False
    is_pii: bool = False

    @property
    def upper(self) -> str:
        return self.name.upper()


@dataclass(frozen=True)
class RegistryEntry:
    """One row of the schema registry: a message schema id and its table."""

    message_schema_id: str
    schema: str
    table: str
    timestamp: str
    columns: tuple[ColumnMeta, ...]
    data_schema: str

    @property
    def qualified(self) -> str:
        return f"{self.schema}.{self.table}".upper()

    @property
    def key_columns(self) -> list[str]:
        return [c.upper for c in self.columns if c.is_key]

    @property
    def merging_all_columns(self) -> bool:
        return not any(c.is_key for c in self.columns)

    def check_mergeable(self) -> None:
        """SEM-9: reject a merge on all columns and a key holding PII."""
        if self.merging_all_columns or any(c.is_key and c.is_pii for c in self.columns):
            raise ValueError(
                f"{self.schema}.{self.table} cannot be merged under schema {self.message_schema_id}: "
                f"it needs key columns, none of them PII"
            )


@dataclass(frozen=True)
class TableConfig:
    """A table to process and the captured time after which changes count."""

    schema: str
    table: str
    start: _dt.datetime | None = None
    start_version: int | None = None
    priority: str = "P1"

    @property
    def qualified(self) -> str:
        return f"{self.schema}.{self.table}".upper()


@dataclass
class RunOptions:
    """Knobs of the structured leg; defaults follow the reference deployment."""

    max_bytes_per_trigger: int = 268_435_456
    trigger_minutes: int = 5
    tables_in_parallel: int = 4
    decode_mode: str = "FAILFAST"
    source_name: str = "SOURCE"
    job_id: int = -1
    run_id: int = -1
    codec: str = "json"          # of the payload: json or avro
    pii_types: dict = field(default_factory=dict)  # "SCHEMA.TABLE" -> {column: type}
    encryption_key: str | None = None
    encryption_key_id: str = "k1"
    stream_id: str = ""          # names the stream run in the folders of counts and log
    table_buckets: int = 16      # buckets of a new table; they split as it grows
    log_path: str | None = None  # run-log table; None disables logging
    log_level: str = "INFO"


def parse_table_config(groups: dict, priority: str | list[str]) -> list[TableConfig]:
    """SRC-10: ``{priority: {"SCHEMA.TABLE": "yyyy-MM-dd HH:mm:ss" | int}}``, for
    one priority group or several, in the order given.

    Unknown priority groups and unparseable start times fail fast.
    """
    if not isinstance(priority, str):
        return [c for p in priority for c in parse_table_config(groups, p)]
    if priority not in groups:
        raise ValueError(f"unknown table group {priority!r}; known: {sorted(groups)}")
    out = []
    for name, start in groups[priority].items():
        if "." not in name:
            raise ValueError(f"table {name!r} must be written SCHEMA.TABLE")
        schema, table = name.split(".", 1)
        if isinstance(start, int):
            out.append(TableConfig(schema.upper(), table.upper(), None, start, priority))
        else:
            try:
                ts = _dt.datetime.strptime(start, TIMESTAMP_FORMAT)
            except (TypeError, ValueError) as exc:
                raise ValueError(f"bad start time {start!r} for {name}") from exc
            out.append(TableConfig(schema.upper(), table.upper(), ts, None, priority))
    return out


def select_tables(configs: list[TableConfig], current_versions: dict[str, int]) -> list[TableConfig]:
    """SRC-11: keep tables whose current version reached the configured start."""
    return [
        c for c in configs
        if c.qualified in current_versions and current_versions[c.qualified] >= (c.start_version or 0)
    ]
