"""The incremental run as Structured Streaming jobs, one query per table.

A file stream over the change folders feeds ``foreachBatch``, which prepares each micro-batch and merges
it into the table exactly like a batch run, new keys of the batch's lookup included. The stream's
checkpoint remembers which files were processed, so each table keeps its own progress (the retry-floor
property comes for free) and a restarted query resumes where it stopped. Because the merge is idempotent,
a micro-batch that is replayed after a failure gives the same table.

Operation counts are observed on the stream itself. ``StreamMetrics`` listens to all queries and keeps one
row per micro-batch; ``stream_tables`` runs many tables side by side and restarts those that fail.
"""

from __future__ import annotations

import threading
import time
from datetime import datetime, timezone
from typing import Callable, Iterable, Mapping, Optional

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener
from pyspark.sql.types import StructType

from tidemark.operators.changes import prepare_changes
from tidemark.operators.envelope import op_counts
from tidemark.session import apply_engine_conf, scratch_path, remove
from tidemark.sinks.tables import append, merge_into
from tidemark.sources.readers import snapshot_to_micros
from tidemark.spec import TableSpec

STREAM_METRICS_SCHEMA = (
    "table_name string, query_id string, batch_id bigint, started_at timestamp, seconds double, rows_in bigint, inserts bigint, updates bigint, "
    "deletes bigint, snapshots bigint, rejected_op bigint, ok boolean, error string"
)
#: The name under which a stream's counts are observed, before the table's name.
COUNTS = "tidemark_counts_"


def change_stream(
    spark: SparkSession,
    path: str,
    schema: StructType,
    fmt: str = "parquet",
    max_files_per_trigger: Optional[int] = None,
    snapshot: bool = False,
) -> DataFrame:
    """Streaming envelope rows from files under ``path`` (a folder or a glob), oldest files first."""
    r = spark.readStream.format(fmt).schema(schema)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    df = r.load(path)
    return snapshot_to_micros(df) if snapshot else df


def stream_table(
    spark: SparkSession,
    spec: TableSpec,
    stream: DataFrame,
    target: str,
    checkpoint_location: str,
    available_now: bool = True,
    processing_time: Optional[str] = None,
    lookup=None,
) -> StreamingQuery:
    """Start a query that merges every micro-batch of ``stream`` into the table ``target``; new values of
    ``spec.lookup_key`` go to ``lookup`` (a ``KeyLookup``) first."""
    from tidemark.plans.pipeline import register_keys

    apply_engine_conf(spark)

    def merge_batch(batch: DataFrame, epoch_id: int) -> None:
        session = batch.sparkSession
        if lookup is None or not spec.lookup_key:
            merge_into(session, prepare_changes(batch, spec), spec, target)
            return
        # Two uses of the micro-batch: it is staged, so that its source is read, and counted, once.
        staged = scratch_path(session, f"stream-{spec.name}")
        batch.write.parquet(staged)
        try:
            changes = prepare_changes(session.read.schema(batch.schema).parquet(staged), spec)
            register_keys(session, changes, spec, lookup, f"{spec.name}-{epoch_id}")
            merge_into(session, changes, spec, target)
        finally:
            remove(session, [staged])

    counted = stream.observe(f"{COUNTS}{spec.name}", *op_counts())
    w = counted.writeStream.foreachBatch(merge_batch).option("checkpointLocation", checkpoint_location)
    if available_now:
        w = w.trigger(availableNow=True)
    elif processing_time:
        w = w.trigger(processingTime=processing_time)
    return w.start()


class StreamMetrics(StreamingQueryListener):
    """One row per micro-batch of the queries that ``stream_table`` starts, and one per failed query.

    Rows wait in the driver until ``flush`` appends them to a table: at most one per micro-batch since."""

    def __init__(self):
        self._rows: list[tuple] = []
        self._lock = threading.Lock()
        self._tables: dict[str, str] = {}
        self.last_batch: dict[str, int] = {}

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        for name, row in p.observedMetrics.items():
            if name.startswith(COUNTS) and p.numInputRows > 0:
                table, c = name[len(COUNTS) :], row.asDict()
                at = datetime.fromisoformat(p.timestamp.replace("Z", "+00:00"))
                seconds = p.durationMs.get("triggerExecution", 0) / 1000
                counts = [c[k] for k in ("rows", "inserts", "updates", "deletes", "snapshots", "rejected_op")]
                with self._lock:
                    self._tables[str(p.id)] = table
                    self._rows.append((table, str(p.id), p.batchId, at, seconds, *counts, True, None))

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass

    def failed(self, table: str, query_id: str, error: str) -> None:
        with self._lock:
            self._rows.append((table, query_id, None, datetime.now(timezone.utc), 0.0, 0, 0, 0, 0, 0, 0, False, error))

    def rows(self) -> list[tuple]:
        with self._lock:
            return list(self._rows)

    def flush(self, spark: SparkSession, table: str) -> int:
        """Append the waiting rows to a stored table; their number."""
        with self._lock:
            rows, self._rows = self._rows, []
        if rows:
            append(spark, spark.createDataFrame(rows, STREAM_METRICS_SCHEMA), table)
        return len(rows)


def stream_tables(
    start: Mapping[str, Callable[[], StreamingQuery]],
    metrics: Optional[StreamMetrics] = None,
    restarts: int = 2,
    pause: float = 1.0,
    poll: float = 0.2,
    stop: Optional[threading.Event] = None,
) -> dict[str, Optional[str]]:
    """Run one streaming query per table until all have ended or ``stop`` is set; the last error by table.

    ``start`` gives a function by table that starts its query (again, from its checkpoint). A failing
    query is reported and restarted alone, at most ``restarts`` times in a row without progress; the
    others go on."""
    errors: dict[str, Optional[str]] = {}
    tries = dict.fromkeys(start, 0)
    due = {name: 0.0 for name in start}
    running: dict[str, StreamingQuery] = {}
    while (running or due) and not (stop is not None and stop.is_set()):
        for name in [n for n, at in due.items() if at <= time.monotonic()]:
            del due[name]
            try:
                running[name] = start[name]()
            except Exception as e:  # noqa: BLE001 - isolation: a table that cannot start does not stop the others
                _fail(name, e, None, errors, tries, due, metrics, restarts, pause)
        for name, query in list(running.items()):
            if query.isActive:
                continue
            del running[name]
            error = query.exception()
            if error is None:
                errors[name] = None
            else:
                progress = query.lastProgress
                if progress is not None and progress["numInputRows"] and progress["batchId"] > 0:
                    tries[name] = 0
                _fail(name, error, str(query.id), errors, tries, due, metrics, restarts, pause)
        time.sleep(poll)
    for query in running.values():
        query.stop()
    return errors


def _fail(name, error, query_id, errors, tries, due, metrics, restarts, pause) -> None:
    errors[name] = f"{type(error).__name__}: {error}"
    if metrics is not None:
        metrics.failed(name, query_id or "", errors[name])
    tries[name] += 1
    if tries[name] <= restarts:
        due[name] = time.monotonic() + pause * 2 ** (tries[name] - 1)
