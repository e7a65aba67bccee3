"""Table specification: everything the pipeline needs to know about one silver table.

A spec replaces per-table subclasses: key, partition and layout columns are declared here,
table-specific steps go in ``post`` (applied with ``DataFrame.transform``).
"""

from __future__ import annotations

from dataclasses import dataclass, field
from typing import Callable, Optional

from pyspark.sql import DataFrame

# Fixed values that must equal the source system's conventions.
# Operation codes of the change envelope.
OP_INSERT = "I"
OP_UPDATE = "U"
OP_DELETE = "D"
OP_SNAPSHOT = "R"
OPS = (OP_INSERT, OP_UPDATE, OP_DELETE, OP_SNAPSHOT)
UPSERT_OPS = (OP_INSERT, OP_UPDATE, OP_SNAPSHOT)
# File name prefixes of snapshot and change files.
SNAPSHOT_PREFIX = "INIT."
CHANGE_PREFIX = "BACK."
# Snapshot rows are ordered before every change: 2026-01-01 07:00:00 UTC in epoch micros.
SNAPSHOT_FLOOR_US = 1767250800000000
# Local zone of the source system and the hour shift applied to its date/time columns.
LOCAL_ZONE = "Asia/Ho_Chi_Minh"
SHIFT_HOURS = 7
# Lowest timestamp kept in silver tables.
CLAMP_LOW = "0001-01-01 00:00:00"
# Largest target file size (bytes).
MAX_FILE_BYTES = 60 * 1024 * 1024
# Files below this size count as small (bytes).
SMALL_FILE_BYTES = 50 * 1024 * 1024
# Rows per commit when exporting to a relational database.
EXPORT_BATCH_ROWS = 5000

# Merge modes (how one batch decides per key) and late-data policies (batch vs stored rows).
EVENT_ORDER = "event_order"
UPSERT_THEN_DELETE = "upsert_then_delete"
EVENT_TIME = "event_time"
ARRIVAL = "arrival"


@dataclass(frozen=True)
class TableSpec:
    """Declaration of one keyed silver table."""

    name: str
    keys: tuple[str, ...]
    ordering: tuple[str, ...] = ("current_ts", "op_ts")
    partition: Optional[str] = None
    partition_source: Optional[str] = None  # column the partition day is derived from
    required: tuple[str, ...] = ()  # upsert rows with a null here are rejected
    sort_cols: tuple[str, ...] = ()
    cluster_cols: tuple[str, ...] = ()  # win over sort_cols for the file layout
    shift_hours: int = SHIFT_HOURS
    keep_dates: bool = False
    clamp_low: str = CLAMP_LOW
    clamp_ntz: bool = False
    snapshot_floor_us: int = SNAPSHOT_FLOOR_US
    merge_mode: str = EVENT_ORDER
    late_policy: str = EVENT_TIME
    keep_tombstones: bool = False
    partial_after: bool = False
    split_key_change: bool = False  # an update that changes the key deletes the old key
    lookup_key: Optional[str] = None  # new values of this column go to the run's key lookup
    format: str = "parquet"
    post: Optional[Callable[[DataFrame], DataFrame]] = None
    file_bytes: int = MAX_FILE_BYTES
    writer_options: dict = field(default_factory=dict)
    aliases: tuple[str, ...] = ()

    def __post_init__(self):
        if not self.keys:
            raise ValueError(f"{self.name}: at least one key column is required")
        if self.merge_mode not in (EVENT_ORDER, UPSERT_THEN_DELETE):
            raise ValueError(f"{self.name}: unknown merge_mode {self.merge_mode!r}")
        if self.late_policy not in (EVENT_TIME, ARRIVAL):
            raise ValueError(f"{self.name}: unknown late_policy {self.late_policy!r}")

    @property
    def layout_cols(self) -> tuple[str, ...]:
        return self.cluster_cols or self.sort_cols

    def names(self) -> set[str]:
        """Lower-case names a user may give to select this table (with or without ``_etl``)."""
        base = {self.name.lower(), *(a.lower() for a in self.aliases)}
        return base | {f"{n}_etl" for n in base}


def name_list(names: str | None) -> list[str]:
    """Names of a list separated by ``,`` or ``;``, blanks around them dropped."""
    return [n for part in str(names or "").split(";") for n in map(str.strip, part.split(",")) if n]


_REGISTRY: dict[str, TableSpec] = {}


def register(spec: TableSpec) -> TableSpec:
    _REGISTRY[spec.name] = spec
    return spec


def registry() -> dict[str, TableSpec]:
    return dict(_REGISTRY)


def resolve_tables(names: str | None, specs: dict[str, TableSpec] | None = None) -> list[TableSpec]:
    """Table names separated by ``,`` or ``;``, case-insensitive, optional ``_etl`` suffix.

    Unknown names are ignored; each table is returned once, in registry order.
    """
    specs = _REGISTRY if specs is None else specs
    wanted = {n.lower() for n in name_list(names)}
    return [s for s in specs.values() if s.names() & wanted]
