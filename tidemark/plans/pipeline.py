"""Runs: one table (files -> batches -> merge), many tables with run state, forced resync.

Per batch one lazy plan leads from the files to the staged changes, one per key, and a second one
from there to the new folders of the table; the change counts come from ``Observation`` on the first.
A backlog can be merged many batches at a time. The driver handles file names of the current batches,
the table's partitions and one result row per table. Times have a zone from end to end, so the zone of
the process does not matter.

Run state is one stored table in the database ``state``: ``run_state`` has a row per table (does it wait
for files since ``failed_from``?) and one, ``*``, with the common time. Each run merges the rows of its own
tables, so what other tables wait for stays. The common time moves on only when every table of the state
took part. A run that finds the state changed since it read it is refused (``ConcurrentWrite``): its
merges are idempotent, its window comes again. ``run_metrics`` collects one row per table and run.
"""

from __future__ import annotations

import hashlib
import time
import uuid
from dataclasses import asdict, dataclass, field
from datetime import datetime, timezone
from functools import reduce
from typing import Callable, Iterable, Mapping, NamedTuple, Optional

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.changes import prepare_changes
from tidemark.operators.envelope import observe_ops
from tidemark.operators.keymaps import register_unknown
from tidemark.sinks import catalog as C
from tidemark.sinks.export import export_once
from tidemark.sinks.tables import append, merge_into
from tidemark.sources import files as FS
from tidemark.sources.readers import read_envelope, read_lookup
from tidemark.session import apply_engine_conf
from tidemark.spec import ARRIVAL, LOCAL_ZONE, OP_DELETE, OP_UPDATE, TableSpec, resolve_tables

BATCH = "_batch"
METRICS_SCHEMA = (
    "run_id string, table_name string, started_at timestamp, seconds double, batches bigint, rows_in bigint, "
    "inserts bigint, updates bigint, deletes bigint, snapshots bigint, rejected bigint, ok boolean, error string"
)
RUN_STATE = TableSpec(name="run_state", keys=("table_name",), ordering=("updated_at",), late_policy=ARRIVAL)
RUN_STATE_SCHEMA = "table_name string, failed boolean, failed_from timestamp, common_last timestamp, run_id string, updated_at timestamp, op_type string"
COMMON = "*"  # the row of the common time


def _now() -> datetime:
    return datetime.now(timezone.utc)


@dataclass
class RunResult:
    run_id: str
    table_name: str
    started_at: datetime
    seconds: float = 0.0
    batches: int = 0
    rows_in: int = 0
    inserts: int = 0
    updates: int = 0
    deletes: int = 0
    snapshots: int = 0
    rejected: int = 0
    ok: bool = True
    error: Optional[str] = None


@dataclass
class Source:
    """Where a table's change files live and how they are read."""

    root: str
    fmt: str = "parquet"
    batch_size: int = 100
    isolated_files: tuple[str, ...] = ()
    slack_days: int = 0
    zone: str = LOCAL_ZONE  # whose days name the folders
    options: dict = field(default_factory=dict)
    lookup: Optional["KeyLookup"] = None
    batches_per_merge: int = 1  # of a backlog


@dataclass
class KeyLookup:
    """The stored map that ``TableSpec.lookup_key`` is checked against: new keys of a batch are added.

    ``client``, if given, makes a client that also gets them, each key once (``export``)."""

    table: str
    salt: str
    client: Optional[Callable[[], object]] = None


def register_keys(spark: SparkSession, changes: DataFrame, spec: TableSpec, lookup: KeyLookup, export_id: str) -> None:
    """Add keys of the upserts that the map lacks. Surrogates follow from the key, so a repeated batch adds none."""
    batch = changes.filter(F.col("op_type") != OP_DELETE)
    if C.exists(spark, lookup.table):
        known = read_lookup(spark, [spec.lookup_key], table=lookup.table)
    else:
        known = spark.createDataFrame([], batch.select(spec.lookup_key).schema)
    new = register_unknown(batch, known, spec.lookup_key, lookup.salt).checkpoint(eager=True)
    if new.isEmpty():
        return
    if lookup.client is not None:
        export_once(new, lookup.client, export_id)
    append(spark, new, lookup.table)


def plan_batches(files: DataFrame, source: Source) -> DataFrame:
    """``path, kind, batch_id`` for the classified files of a window."""
    classified = FS.classify(files)
    if source.isolated_files:
        return FS.batch_files_isolated(classified, source.batch_size, FS.special_files(source.isolated_files))
    return FS.batch_files(classified, source.batch_size)


def run_table(
    spark: SparkSession,
    spec: TableSpec,
    source: Source,
    target: str,
    from_time: Optional[datetime] = None,
    to_time: Optional[datetime] = None,
    full_refresh: bool = False,
    run_id: Optional[str] = None,
    result: Optional[RunResult] = None,
) -> RunResult:
    """Process the files of one table that arrived in ``[from_time, to_time]`` (both included).

    ``result``, if given, is filled as the run goes on, so that a run that fails shows how far it came.
    """
    apply_engine_conf(spark)
    res = result if result is not None else RunResult(run_id or uuid.uuid4().hex, spec.name, _now())
    run_id, t0 = res.run_id, time.time()
    try:
        _run_files(spark, spec, source, target, from_time, to_time, full_refresh, res)
    finally:
        res.seconds = time.time() - t0
    return res


def _run_files(spark, spec, source, target, from_time, to_time, full_refresh, res: RunResult) -> None:
    """Merge the files of a window batch by batch; ``res`` counts what has been merged so far."""
    run_id = res.run_id
    listed = FS.list_files(spark, source.root, from_time, to_time, source.slack_days, source.zone)
    files = FS.select_window(listed, from_time, to_time, source.slack_days, source.zone)
    plan = plan_batches(files, source).select("path", "kind", "batch_id").checkpoint(eager=True)
    last = plan.agg(F.max("batch_id")).collect()[0][0]
    n, size, first = 0 if last is None else last + 1, max(1, source.batches_per_merge), True
    for start in range(0, n, size):
        ids = range(start, min(n, start + size))
        # Only the names of these batches (at most ``batch_size`` files each) reach the driver.
        rows = plan.filter(F.col("batch_id").between(ids[0], ids[-1])).select("batch_id", "path", "kind").collect()
        frames, counts = [], []
        for batch_id in ids:
            mine = [r for r in rows if r["batch_id"] == batch_id]
            snaps, changes = (sorted(r["path"] for r in mine if r["kind"] == k) for k in (FS.SNAPSHOT, FS.CHANGE))
            env = read_envelope(spark, snaps, changes, source.fmt, strict=False, options=source.options)
            if env is None:
                continue
            if spec.lookup_key and source.lookup is not None:
                # Named after the files, so a run that is started again exports nothing twice.
                files_id = hashlib.sha1("\n".join(snaps + changes).encode()).hexdigest()[:16]
                register_keys(spark, prepare_changes(env, spec), spec, source.lookup, f"{spec.name}-{files_id}")
            env, ops = observe_ops(env, f"ops_{run_id}_{spec.name}_{batch_id}")
            accepted = Observation(f"ok_{run_id}_{spec.name}_{batch_id}")
            prepared = prepare_changes(env, spec).observe(accepted, F.count(F.lit(1)).alias("accepted"))
            frames.append(prepared.withColumn(BATCH, F.lit(batch_id).cast("bigint")) if size > 1 else prepared)
            counts.append((ops, accepted))
        if not frames:
            continue
        merged = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
        merge_into(spark, merged, spec, target, full_refresh=full_refresh and first, batch=BATCH if size > 1 else None)
        first = False
        for ops, accepted in counts:
            m = ops.get
            res.batches += 1
            res.rows_in += m["rows"]
            res.inserts += m["inserts"]
            res.updates += m["updates"]
            res.deletes += m["deletes"]
            res.snapshots += m["snapshots"]
            res.rejected += m["rows"] - accepted.get["accepted"]


class RunState(NamedTuple):
    """Common time, where the failed tables start, all tables that the state knows, and how often it was written."""

    common: Optional[datetime]
    failed: dict[str, Optional[datetime]]
    known: frozenset[str]
    writes: int


def load_state(spark: SparkSession, state: str) -> RunState:
    table = f"{state}.run_state"
    writes = C.merges(spark, table)
    rows = C.rows(spark, table).collect() if writes >= 0 else []  # one row per table
    common = next((_aware(r["common_last"]) for r in rows if r["table_name"] == COMMON), None)
    failed = {r["table_name"]: _aware(r["failed_from"]) for r in rows if r["failed"]}
    return RunState(common, failed, frozenset(r["table_name"] for r in rows) - {COMMON}, writes)


def save_state(
    spark: SparkSession,
    state: str,
    run_id: str,
    before: RunState,
    common_last: Optional[datetime],
    failed: Mapping[str, Optional[datetime]],
    results: Iterable[RunResult],
) -> None:
    """Metrics first: the run counts from the moment its state rows are there."""
    results, now = list(results), _now()
    if results:
        append(spark, results_frame(spark, results), f"{state}.run_metrics")
    rows = [(r.table_name, r.table_name in failed, failed.get(r.table_name), None, run_id, now, OP_UPDATE) for r in results]
    rows.append((COMMON, False, None, common_last, run_id, now, OP_UPDATE))
    merge_into(spark, spark.createDataFrame(rows, RUN_STATE_SCHEMA), RUN_STATE, f"{state}.run_state", started=before.writes)


def results_frame(spark: SparkSession, results: Iterable[RunResult]) -> DataFrame:
    return spark.createDataFrame([tuple(asdict(r).values()) for r in results], METRICS_SCHEMA)


def _aware(t: Optional[datetime]) -> Optional[datetime]:
    """Collected timestamps come without a zone, in that of the process."""
    return None if t is None else t.astimezone(timezone.utc)


def _isolated(spark, spec, source, target, start, end, full, run_id) -> RunResult:
    """One table's run; a failure becomes part of its result."""
    res = RunResult(run_id, spec.name, _now())
    try:
        run_table(spark, spec, source, target, start, end, full, run_id, res)
    except Exception as e:  # noqa: BLE001 - isolation: report and go on with the next table
        res.ok, res.error = False, f"{type(e).__name__}: {e}"
    return res


def run_tables(
    spark: SparkSession,
    specs: Iterable[TableSpec],
    sources: Mapping[str, Source],
    targets: Mapping[str, str],
    state: str,
    to_time: Optional[datetime] = None,
    run_id: Optional[str] = None,
) -> DataFrame:
    """Hourly run over many tables: each from the common time (or its own retry floor) to ``to_time``.

    A failing table is reported and does not stop the others; it keeps its start time for the next
    run. A table that the state does not know starts from the beginning and is rewritten. ``state`` is
    the database of the state's tables.
    """
    run_id = run_id or uuid.uuid4().hex
    to_time = FS.as_utc(to_time) if to_time is not None else _now()
    before = load_state(spark, state)
    if before.common is not None and to_time < before.common:
        raise ValueError(f"end time {to_time} is before the last common time {before.common}")
    results, failed = [], dict(before.failed)
    for spec in specs:
        start = failed[spec.name] if spec.name in failed else before.common if spec.name in before.known else None
        res = _isolated(spark, spec, sources[spec.name], targets[spec.name], start, to_time, start is None, run_id)
        if res.ok:
            failed.pop(spec.name, None)
        else:
            failed[spec.name] = start
        results.append(res)
    all_here = before.known <= {r.table_name for r in results}
    save_state(spark, state, run_id, before, to_time if all_here else before.common, failed, results)
    return results_frame(spark, results)


def force_tables(
    spark: SparkSession,
    names: str,
    specs: Mapping[str, TableSpec],
    sources: Mapping[str, Source],
    targets: Mapping[str, str],
    state: str,
    from_time: Optional[datetime] = None,
    run_id: Optional[str] = None,
) -> DataFrame:
    """Resync named tables from ``from_time`` (append) or from the beginning (rewrite) up to the
    common time. Success clears a table's failure entry, failure makes one; the common time does not
    change."""
    run_id = run_id or uuid.uuid4().hex
    from_time = None if from_time is None else FS.as_utc(from_time)
    before = load_state(spark, state)
    common, failed = before.common, dict(before.failed)
    chosen = resolve_tables(names, dict(specs))
    results = []
    for spec in chosen:
        res = _isolated(spark, spec, sources[spec.name], targets[spec.name], from_time, common, from_time is None, run_id)
        if res.ok:
            failed.pop(spec.name, None)
        elif spec.name not in failed or failed[spec.name] is not None:
            # The next run takes the table up again from the earlier of the two starts.
            earlier = failed.get(spec.name)
            failed[spec.name] = from_time if from_time is None or earlier is None else min(from_time, earlier)
        results.append(res)
    save_state(spark, state, run_id, before, common, failed, results)
    return results_frame(spark, results)
