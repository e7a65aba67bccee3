import time
from dataclasses import replace

from pyspark.sql import functions as F

from tidemark.fixtures import files as FF
from tidemark.operators.merge import live_rows
from tidemark.plans import queries as Q
from tidemark.plans.pipeline import KeyLookup
from tidemark.sinks.catalog import scratch_table
from tidemark.sources.readers import read_table
from tidemark.spec import TableSpec
from tidemark.streaming import StreamMetrics, change_stream, stream_table, stream_tables
from tidemark.tables import CASH_TRANSACTIONS

from conftest import SF001


def _run_stream(spark, root, target, ckpt, per_trigger):
    schema = spark.read.parquet(f"{root}/*/BACK.0001").schema
    stream = change_stream(spark, f"{root}/*/BACK.*", schema, max_files_per_trigger=per_trigger)
    stream_table(spark, CASH_TRANSACTIONS, stream, target, ckpt).awaitTermination()
    return sorted(tuple(r) for r in read_table(spark, target).select("PK_CASH_TRANSACTION", "C_STATUS", "current_ts").collect())


def test_stream_equals_batch_merge(spark, tmp_dir):
    root = f"{tmp_dir}/landing"
    FF.land_two_batches(spark, SF001, root, snapshot_file=False)
    target = scratch_table(spark, "t1")
    one = _run_stream(spark, root, target, f"{tmp_dir}/c1", 1)
    batch = sorted(
        tuple(r)
        for r in Q.merge_late_event_time(spark, SF001).select("PK_CASH_TRANSACTION", "C_STATUS", "current_ts").collect()
    )
    assert one == batch
    # a restarted query with the same checkpoint finds nothing new and leaves the table as it is
    again = _run_stream(spark, root, target, f"{tmp_dir}/c1", 1)
    assert again == one


def test_any_trigger_size_gives_same_table_with_tombstones(spark, tmp_dir):
    spec = replace(CASH_TRANSACTIONS, keep_tombstones=True)
    root = f"{tmp_dir}/landing"
    FF.land_two_batches(spark, SF001, root, snapshot_file=False)
    schema = spark.read.parquet(f"{root}/*/BACK.0001").schema
    out = []
    for n in (1, 3):
        stream = change_stream(spark, f"{root}/*/BACK.*", schema, max_files_per_trigger=n)
        target = scratch_table(spark, f"t{n}")
        stream_table(spark, spec, stream, target, f"{tmp_dir}/c{n}").awaitTermination()
        live = live_rows(read_table(spark, target))
        out.append(sorted(tuple(r) for r in live.select("PK_CASH_TRANSACTION", "C_STATUS", "current_ts").collect()))
    assert out[0] == out[1]
    single = sorted(
        tuple(r)
        for r in Q.merge_late_event_time_tombstones(spark, SF001).select("PK_CASH_TRANSACTION", "C_STATUS", "current_ts").collect()
    )
    assert out[0] == single


ENV = "op_type string, op_ts bigint, current_ts bigint, before struct<k:bigint,v:string>, after struct<k:bigint,v:string>"


def _land(spark, folder, n, rows):
    spark.createDataFrame(rows, ENV).coalesce(1).write.mode("append").parquet(folder)
    time.sleep(1.1)


def test_one_failing_table_is_restarted_alone(spark, tmp_dir):
    """Two tables; one breaks on its first start and catches up on its second, one breaks for good."""
    from pyspark.sql.types import StructType

    names, tries = ("fine", "once", "never"), {"once": 0, "never": 0}
    targets = {n: scratch_table(spark, n) for n in names}
    for n in names:
        for k in (1, 2):
            _land(spark, f"{tmp_dir}/{n}", k, [("I", k, k, None, (k, "a"))])
    metrics = StreamMetrics()
    spark.streams.addListener(metrics)

    def starter(name):
        def start():
            if name in tries:
                tries[name] += 1
            broken = name == "never" or name == "once" and tries["once"] == 1

            def step(df):
                if broken:
                    raise RuntimeError("broken table step")
                return df

            stream = change_stream(spark, f"{tmp_dir}/{name}", StructType.fromDDL(ENV), max_files_per_trigger=1)
            return stream_table(spark, TableSpec(name=name, keys=("k",), post=step), stream, targets[name], f"{tmp_dir}/ckpt_{name}")

        return start

    try:
        errors = stream_tables({n: starter(n) for n in names}, metrics, restarts=2, pause=0.1)
        limit = time.monotonic() + 30
        while sum(r[-2] for r in metrics.rows()) < 4 and time.monotonic() < limit:
            time.sleep(0.1)
    finally:
        spark.streams.removeListener(metrics)
    assert errors["fine"] is None and errors["once"] is None and "broken table step" in errors["never"]
    assert tries == {"once": 2, "never": 3}
    for n in ("fine", "once"):
        assert sorted(r.k for r in read_table(spark, targets[n]).collect()) == [1, 2]
    kept = scratch_table(spark, "metrics")
    assert metrics.flush(spark, kept) == 8
    rows = read_table(spark, kept).collect()
    good = sorted((r.table_name, r.batch_id, r.rows_in, r.inserts) for r in rows if r.ok)
    assert good == [("fine", 0, 1, 1), ("fine", 1, 1, 1), ("once", 0, 1, 1), ("once", 1, 1, 1)]
    assert sorted(r.table_name for r in rows if not r.ok) == ["never", "never", "never", "once"]


def test_stream_registers_new_keys(spark, tmp_dir):
    env = spark.createDataFrame([("I", k, k, None, (k, f"c{k % 3}")) for k in range(6)], ENV)
    env.coalesce(1).write.parquet(f"{tmp_dir}/in")
    spec, target, known = TableSpec(name="s", keys=("k",), lookup_key="v"), scratch_table(spark, "s"), scratch_table(spark, "known")
    for _ in range(2):
        stream = change_stream(spark, f"{tmp_dir}/in", env.schema)
        stream_table(spark, spec, stream, target, f"{tmp_dir}/ckpt", lookup=KeyLookup(known, "salt")).awaitTermination()
    assert sorted(r.v for r in read_table(spark, known).collect()) == ["c0", "c1", "c2"]
    assert read_table(spark, target).count() == 6
    assert read_table(spark, known).filter(F.col("v_MAP").isNull()).count() == 0


def test_the_stream_query_merges_once_for_each_data_set(spark, tmp_dir, monkeypatch):
    """Data sets of several files: every merge rewrites what it touches, so files one by one would rewrite it as often."""
    from tidemark.streaming import stream as ST

    spark.read.parquet(f"{SF001}/orders.parquet").repartition(3).write.parquet(f"{tmp_dir}/orders.parquet")
    merges, merge_into = [], ST.merge_into
    monkeypatch.setattr(ST, "merge_into", lambda *a, **k: merges.append(merge_into(*a, **k)))
    got = Q.stream_merge(spark, tmp_dir)
    assert len(merges) == 2
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, Q.stream_merge(spark, SF001).collect()))
