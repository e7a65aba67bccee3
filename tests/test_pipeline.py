import os
import time
import uuid
import subprocess
import sys
from datetime import datetime, timedelta, timezone
from zoneinfo import ZoneInfo

import pytest

from pyspark.sql import functions as F

from tidemark.plans import pipeline
from tidemark.plans.pipeline import Source, force_tables, load_state, run_tables
from tidemark.sinks.catalog import ConcurrentWrite, scratch_table
from tidemark.sources.readers import read_table
from tidemark.spec import LOCAL_ZONE, TableSpec

ENV = "op_type string, op_ts bigint, current_ts bigint, before struct<k:bigint,v:string>, after struct<k:bigint,v:string>"


def _land(spark, root, name, rows):
    day = datetime.now(ZoneInfo(LOCAL_ZONE)).date().isoformat()
    spark.createDataFrame(rows, ENV).write.parquet(f"{root}/{day}/{name}")


def _state(spark, tmp_dir):
    """A database for run state, and a name for a table in it."""
    name = f"state_{uuid.uuid4().hex[:8]}"
    spark.sql(f"CREATE DATABASE {name} LOCATION '{tmp_dir}/{name}'")
    return name


def _boom(df):
    raise RuntimeError("broken table step")


def test_run_tables_isolates_failures_and_keeps_retry_floor(spark, tmp_dir):
    good = TableSpec(name="good", keys=("k",), required=("k",))
    bad = TableSpec(name="bad", keys=("k",), post=_boom)
    specs = {"good": good, "bad": bad}
    sources = {n: Source(root=f"{tmp_dir}/src_{n}") for n in specs}
    targets = {n: scratch_table(spark, n) for n in specs}
    state = _state(spark, tmp_dir)
    for n in specs:
        _land(spark, sources[n].root, "BACK.1", [("I", 1, 1, None, (1, "a")), ("I", 2, 2, None, (2, "b")), ("Q", 3, 3, None, (3, "?"))])
    time.sleep(1.1)
    t1 = datetime.now(timezone.utc)
    res = {r.table_name: r for r in run_tables(spark, specs.values(), sources, targets, state, to_time=t1).collect()}
    assert res["good"].ok and res["good"].rows_in == 3 and res["good"].rejected == 1
    assert not res["bad"].ok and "broken" in res["bad"].error
    assert load_state(spark, state).failed == {"bad": None}  # failed from the beginning: null start kept
    assert sorted(r.k for r in read_table(spark, targets["good"]).collect()) == [1, 2]

    # next hour: good moves on from the common time, bad retries from its own floor
    time.sleep(1.1)
    _land(spark, sources["good"].root, "BACK.2", [("U", 5, 5, (1, "a"), (1, "a2")), ("D", 6, 6, (2, "b"), None)])
    t2 = datetime.now(timezone.utc) + timedelta(seconds=1)
    specs["bad"] = TableSpec(name="bad", keys=("k",))
    res2 = {r.table_name: r for r in run_tables(spark, specs.values(), sources, targets, state, to_time=t2).collect()}
    assert res2["good"].rows_in == 2 and res2["bad"].ok and res2["bad"].rows_in == 3
    assert [(r.k, r.v) for r in read_table(spark, targets["good"]).collect()] == [(1, "a2")]
    assert load_state(spark, state).failed == {}
    metrics = read_table(spark, f"{state}.run_metrics")
    assert metrics.count() == 4


def test_force_tables_by_name(spark, tmp_dir):
    spec = TableSpec(name="cash_x", keys=("k",))
    sources = {"cash_x": Source(root=f"{tmp_dir}/src")}
    targets = {"cash_x": scratch_table(spark, "cash_x")}
    state = _state(spark, tmp_dir)
    _land(spark, sources["cash_x"].root, "BACK.1", [("I", 1, 1, None, (1, "a"))])
    time.sleep(1.1)
    run_tables(spark, [spec], sources, targets, state, to_time=datetime.now(timezone.utc))
    out = force_tables(spark, "CASH_X_etl; unknown", {"cash_x": spec}, sources, targets, state).collect()
    assert [(r.table_name, r.ok, r.rows_in) for r in out] == [("cash_x", True, 1)]
    assert [r.k for r in read_table(spark, targets["cash_x"]).collect()] == [1]


def test_state_counts_from_its_last_write(spark, tmp_dir, monkeypatch):
    """If the failures cannot be saved, the run has not happened: its window comes again."""
    spec = TableSpec(name="bad", keys=("k",), post=_boom)
    state = _state(spark, tmp_dir)
    args = ([spec], {"bad": Source(root=f"{tmp_dir}/src")}, {"bad": scratch_table(spark, "bad")}, state)
    _land(spark, f"{tmp_dir}/src", "BACK.1", [("I", 1, 1, None, (1, "a"))])
    with monkeypatch.context() as m:
        m.setattr(pipeline, "RUN_STATE_SCHEMA", "nonsense")
        with pytest.raises(Exception):
            run_tables(spark, *args, to_time=datetime.now(timezone.utc) + timedelta(seconds=1))
    assert load_state(spark, state)[:2] == (None, {})


def _hour(spark, specs, sources, targets, state):
    time.sleep(1.1)
    return {r.table_name: r for r in run_tables(spark, specs, sources, targets, state).collect()}


def test_a_run_over_some_tables_keeps_what_the_others_wait_for(spark, tmp_dir):
    specs = {n: TableSpec(name=n, keys=("k",)) for n in ("a", "b")}
    sources, targets, state = {n: Source(root=f"{tmp_dir}/{n}") for n in specs}, {n: scratch_table(spark, n) for n in specs}, _state(spark, tmp_dir)
    for n in specs:
        _land(spark, sources[n].root, "BACK.1", [("I", 1, 1, None, (1, "x"))])
    assert not _hour(spark, [specs["a"], TableSpec(name="b", keys=("k",), post=_boom)], sources, targets, state)["b"].ok
    first = load_state(spark, state)
    assert first.failed == {"b": None} and first.known == {"a", "b"}
    _land(spark, sources["a"].root, "BACK.2", [("I", 2, 2, None, (2, "y"))])
    _hour(spark, [specs["a"]], sources, targets, state)
    second = load_state(spark, state)
    assert second.failed == {"b": None} and second.common == first.common  # b did not take part
    done = _hour(spark, specs.values(), sources, targets, state)
    assert done["b"].rows_in == 1 and done["a"].rows_in == 1  # a's window came again and changed nothing
    third = load_state(spark, state)
    assert third.failed == {} and third.common > first.common
    assert sorted(r.k for r in read_table(spark, targets["a"]).collect()) == [1, 2]
    # A table that the state has not seen starts from the beginning.
    specs["c"], sources["c"], targets["c"] = TableSpec(name="c", keys=("k",)), Source(root=sources["a"].root), scratch_table(spark, "c")
    assert _hour(spark, specs.values(), sources, targets, state)["c"].rows_in == 2


def test_of_two_runs_the_second_is_refused(spark, tmp_dir, monkeypatch):
    spec, state = TableSpec(name="t", keys=("k",)), _state(spark, tmp_dir)
    args = ([spec], {"t": Source(root=f"{tmp_dir}/src")}, {"t": scratch_table(spark, "t")}, state)
    _land(spark, f"{tmp_dir}/src", "BACK.1", [("I", 1, 1, None, (1, "a"))])
    time.sleep(1.1)
    run_tables(spark, *args)
    began = load_state(spark, state)
    run_tables(spark, *args)
    kept = load_state(spark, state)
    with monkeypatch.context() as m:
        m.setattr(pipeline, "load_state", lambda *_: began)
        with pytest.raises(ConcurrentWrite):
            run_tables(spark, *args)
    assert load_state(spark, state) == kept


def test_a_backlog_as_one_merge_gives_what_its_batches_give(spark, tmp_dir):
    spec, out = TableSpec(name="t", keys=("k",)), []
    for n in range(7):
        _land(spark, f"{tmp_dir}/src", f"BACK.{n}", [("I" if n % 2 else "D", 5 - n % 3, n, (k, "o") if n % 2 == 0 else None, (k, f"v{n}") if n % 2 else None) for k in range(n % 4, 6)])
    for size in (1, 3, 100):
        target = scratch_table(spark, "t")
        res = pipeline.run_table(spark, spec, Source(root=f"{tmp_dir}/src", batch_size=1, batches_per_merge=size), target)
        out.append((res.batches, res.rows_in, res.inserts, res.deletes, sorted((r.k, r.v, r.current_ts) for r in read_table(spark, target).collect())))
    assert out[0] == out[1] == out[2] and out[0][0] >= 7


def test_failed_forced_rewrite_is_taken_up_again(spark, tmp_dir):
    spec = TableSpec(name="t", keys=("k",))
    sources, targets, state = {"t": Source(root=f"{tmp_dir}/src")}, {"t": scratch_table(spark, "t")}, _state(spark, tmp_dir)
    _land(spark, f"{tmp_dir}/src", "BACK.1", [("I", 1, 1, None, (1, "a"))])
    time.sleep(1.1)
    run_tables(spark, [spec], sources, targets, state)
    out = force_tables(spark, "t", {"t": TableSpec(name="t", keys=("k",), post=_boom)}, sources, targets, state).collect()
    assert not out[0].ok and "broken" in out[0].error and out[0].seconds > 0
    assert load_state(spark, state).failed == {"t": None}
    assert [r.rows_in for r in run_tables(spark, [spec], sources, targets, state).collect()] == [1]
    assert load_state(spark, state).failed == {}


ZONED = """
import sys, time
from datetime import datetime, timedelta, timezone
sys.path[:0] = [sys.argv[1], sys.argv[1] + "/tests"]
from tidemark.session import local_session
spark = local_session(cores=2, shuffle_partitions=2)
from test_pipeline import _land
from tidemark.plans.pipeline import Source, run_tables
from tidemark.spec import TableSpec
spec, root = TableSpec(name="t", keys=("k",)), sys.argv[2]
spark.sql(f"CREATE DATABASE zoned LOCATION '{root}/zoned'")
seen = []
for n in (1, 2):
    _land(spark, root + "/src", f"BACK.{n}", [("I", n, n, None, (n, "a"))])
    time.sleep(1.1)
    seen += [r.rows_in for r in run_tables(spark, [spec], {"t": Source(root=root + "/src")}, {"t": "zoned.t"}, "zoned").collect()]
print("SEEN", seen)
"""


def test_windows_do_not_depend_on_the_zone_of_the_process(tmp_dir):
    repo = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    for zone in ("Asia/Ho_Chi_Minh", "America/New_York"):
        out = subprocess.run([sys.executable, "-c", ZONED, repo, f"{tmp_dir}/{zone}"], env=os.environ | {"TZ": zone}, capture_output=True, text=True, timeout=300)
        assert "SEEN [1, 1]" in out.stdout, out.stdout + out.stderr[-2000:]


def test_days_do_not_depend_on_the_zone_of_the_session(spark, tmp_dir):
    from tidemark.plans.pipeline import run_table

    env = "op_type string, op_ts bigint, current_ts bigint, before struct<k:bigint,ts:timestamp>, after struct<k:bigint,ts:timestamp>"
    at = datetime(2024, 1, 1, 20, 0, tzinfo=timezone.utc)
    day = datetime.now(ZoneInfo(LOCAL_ZONE)).date().isoformat()
    spark.createDataFrame([("I", 1, 1, None, (1, at))], env).write.parquet(f"{tmp_dir}/src/{day}/BACK.1")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    run_table(spark, TableSpec(name="z", keys=("k",), partition="day", partition_source="ts"), Source(root=f"{tmp_dir}/src"), target := scratch_table(spark, "z"))
    assert [str(r.day) for r in read_table(spark, target).collect()] == ["2024-01-02"]


def test_files_with_different_columns_are_read_whole(spark, tmp_dir):
    from tidemark.sources.readers import read_changes

    spark.createDataFrame([(1,)], "id bigint").write.parquet(f"{tmp_dir}/a")
    spark.createDataFrame([(2, "x")], "id bigint, more string").write.parquet(f"{tmp_dir}/b")
    assert sorted(map(tuple, read_changes(spark, [f"{tmp_dir}/a", f"{tmp_dir}/b"]).collect())) == [(1, None), (2, "x")]
