import glob
from datetime import datetime, timedelta

import pytest

from pyspark.sql import functions as F

from tidemark.operators.merge import live_rows
from clients import StagingClient
from tidemark.sinks import catalog as C
from tidemark.sinks import tables as T
from tidemark.sinks.export import export_once
from tidemark.sinks.tables import append, file_rows, merge_into
from tidemark.sources.readers import read_table, table_if_exists
from tidemark.spec import ARRIVAL, TableSpec

SPEC = TableSpec(name="t", keys=("k",), partition="day", partition_source="ts", sort_cols=("v",))
S = "k bigint, v string, ts timestamp, op_type string, current_ts bigint, op_ts bigint"


def _batch(spark, rows):
    return spark.createDataFrame(rows, S).withColumn("day", F.to_date("ts"))


def files(spark, table, pattern="*/*"):
    return glob.glob(f"{C.home(spark, table).removeprefix('file:')}/{pattern}")


def days(spark, table):
    return {r[0].split("=", 1)[1] for r in spark.sql(f"SHOW PARTITIONS {table}").collect()}


def test_merge_into_moves_rows_between_partitions_and_drops_empty(spark, tmp_dir):
    path = C.scratch_table(spark, "t")
    d1, d2 = datetime(2024, 1, 1, 10), datetime(2024, 1, 2, 10)
    merge_into(spark, _batch(spark, [(1, "a", d1, "I", 1, 1), (2, "b", d1, "I", 1, 1), (3, "c", d2, "I", 1, 1)]), SPEC, path)
    # key 1 moves to day 2, key 2 is deleted: day 1 becomes empty and must disappear
    r = merge_into(spark, _batch(spark, [(1, "a2", d2, "U", 2, 2), (2, None, d1, "D", 2, 2)]), SPEC, path)
    assert r.touched_partitions == 2
    got = sorted((x.k, x.v, str(x.day)) for x in read_table(spark, path).collect())
    assert got == [(1, "a2", "2024-01-02"), (3, "c", "2024-01-02")]
    assert days(spark, path) == {"2024-01-02"}
    # replay of the same batch changes nothing
    merge_into(spark, _batch(spark, [(1, "a2", d2, "U", 2, 2), (2, None, d1, "D", 2, 2)]), SPEC, path)
    assert sorted((x.k, x.v) for x in read_table(spark, path).collect()) == [(1, "a2"), (3, "c")]


def test_full_refresh_ignores_stored_rows(spark, tmp_dir):
    path = C.scratch_table(spark, "t")
    d = datetime(2024, 1, 1)
    merge_into(spark, _batch(spark, [(1, "a", d, "I", 1, 1)]), SPEC, path)
    merge_into(spark, _batch(spark, [(2, "b", d, "I", 1, 1)]), SPEC, path, full_refresh=True)
    assert [x.k for x in read_table(spark, path).collect()] == [2]


def test_table_if_exists_only_for_missing(spark, tmp_dir):
    assert table_if_exists(spark, f"{tmp_dir}/nothing") is None and table_if_exists(spark, "nothing_there") is None


def test_a_table_is_read_by_its_name(spark):
    path = C.scratch_table(spark, "t")
    merge_into(spark, _batch(spark, [(1, "a", datetime(2024, 1, 1), "I", 1, 1), (2, "b", datetime(2024, 1, 2), "I", 1, 1)]), SPEC, path)
    assert spark.table(path).count() == 2
    assert spark.sql(f"SELECT count(*) FROM {path} WHERE day = DATE'2024-01-02'").collect()[0][0] == 1


def test_export_sends_each_key_once(spark, tmp_dir):
    df = spark.range(0, 12001).select(F.col("id").cast("string").alias("k")).repartition(3)
    export_once(df, lambda: StagingClient(tmp_dir), "first", batch_rows=500)
    sent = StagingClient.published(tmp_dir)
    assert len(sent) == 12001 == len(set(sent))
    export_once(df, lambda: StagingClient(tmp_dir), "first", batch_rows=500)  # the same export again
    assert sorted(StagingClient.published(tmp_dir)) == sorted(sent) and not StagingClient.waiting(tmp_dir)


def test_export_that_fails_publishes_nothing(spark, tmp_dir):
    df = spark.range(0, 100).select(F.col("id").cast("string").alias("k")).repartition(3)
    with pytest.raises(Exception):
        export_once(df, lambda: StagingClient(tmp_dir, fail_always=True), "second", batch_rows=10)
    assert StagingClient.published(tmp_dir) == [] and not StagingClient.waiting(tmp_dir)


def test_a_failed_attempt_of_a_task_is_discarded(tmp_dir):
    """The task's code as Spark runs it twice: the first attempt breaks after it has staged rows."""
    import os
    import subprocess
    import sys

    code = """
import sys
sys.path[:0] = [sys.argv[1], sys.argv[1] + "/tests"]
from pyspark.sql import SparkSession
from clients import StagingClient
from tidemark.sinks.export import export_once
spark = SparkSession.builder.master("local[2, 4]").config("spark.ui.enabled", "false").getOrCreate()
folder = sys.argv[2]
export_once(spark.range(1000).repartition(2), lambda: StagingClient(folder, fail_once=True), "retry", batch_rows=100)
print("SENT", len(StagingClient.published(folder)), len(set(StagingClient.published(folder))), StagingClient.waiting(folder), StagingClient.failures(folder))
"""
    repo = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    out = subprocess.run([sys.executable, "-c", code, repo, tmp_dir], capture_output=True, text=True, timeout=240)
    assert "SENT 1000 1000 [] 1" in out.stdout, out.stdout + out.stderr[-2000:]


def test_null_partition_rows_survive_unrelated_batches(spark, tmp_dir):
    path = C.scratch_table(spark, "t")
    d = datetime(2024, 1, 1, 10)
    merge_into(spark, _batch(spark, [(1, "a", None, "I", 1, 1), (2, "b", d, "I", 1, 1)]), SPEC, path)
    merge_into(spark, _batch(spark, [(3, "c", None, "I", 2, 2)]), SPEC, path)
    merge_into(spark, _batch(spark, [(2, "b2", d, "U", 3, 3)]), SPEC, path)
    assert sorted((x.k, x.v) for x in read_table(spark, path).collect()) == [(1, "a"), (2, "b2"), (3, "c")]


def test_empty_batch_writes_nothing(spark, tmp_dir):
    path = C.scratch_table(spark, "t")
    d = datetime(2024, 1, 1)
    merge_into(spark, _batch(spark, [(1, "a", d, "I", 1, 1)]), SPEC, path)
    before = sorted(files(spark, path, "**/*.parquet"))
    r = merge_into(spark, _batch(spark, [(None, "x", d, "I", 2, 2)]), SPEC, path)
    assert r.batch_keys == 0 and r.rows_written == 0
    assert sorted(files(spark, path, "**/*.parquet")) == before


def test_new_columns_of_a_stored_table_stay(spark, tmp_dir):
    """A column that one batch brings is there for all later batches, in touched and untouched partitions."""
    path = C.scratch_table(spark, "t")
    d1, d2 = datetime(2024, 1, 1), datetime(2024, 1, 2)
    merge_into(spark, _batch(spark, [(1, "a", d1, "I", 1, 1), (2, "b", d2, "I", 1, 1)]), SPEC, path)
    merge_into(spark, _batch(spark, [(3, "c", d1, "I", 2, 2)]).withColumn("channel", F.lit("web")), SPEC, path)
    merge_into(spark, _batch(spark, [(4, "d", d1, "I", 3, 3)]), SPEC, path)
    got = sorted((r.k, r.channel) for r in read_table(spark, path).collect())
    assert got == [(1, None), (2, None), (3, "web"), (4, None)]
    assert sorted((r.k, r.channel) for r in spark.table(path).collect()) == got


def test_table_without_rows_takes_batches(spark, tmp_dir):
    d = datetime(2024, 1, 1)
    for name, first in (("deletes_only", "D"), ("all_deleted", "I")):
        path = C.scratch_table(spark, name)
        merge_into(spark, _batch(spark, [(1, "a", d, first, 1, 1)]), SPEC, path)
        merge_into(spark, _batch(spark, [(1, "a", d, "D", 2, 2)]), SPEC, path)
        assert read_table(spark, path).count() == 0 and table_if_exists(spark, path) is None
        merge_into(spark, _batch(spark, [(2, "b", d, "I", 3, 3)]), SPEC, path)
        assert [r.k for r in read_table(spark, path).collect()] == [2]


def test_partition_values_keep_their_text(spark, tmp_dir):
    path, spec = C.scratch_table(spark, "t"), TableSpec(name="t", keys=("k",), partition="p")
    rows = [(1, "01"), (2, "a:b/c=d%20 'q'"), (3, None), (4, ""), (5, "null"), (6, "__empty__"), (7, "long " * 60)]
    frame = lambda some, op, ts: spark.createDataFrame([(k, p, op, ts, ts) for k, p in some], "k bigint, p string, op_type string, current_ts bigint, op_ts bigint")
    merge_into(spark, frame(rows, "I", 1), spec, path)
    merge_into(spark, frame(rows[:2], "U", 2), spec, path)
    assert sorted(((r.k, r.p) for r in read_table(spark, path).collect())) == rows
    merge_into(spark, frame(rows[1:2], "D", 3), spec, path)
    assert sorted(r.k for r in read_table(spark, path).collect()) == [1, 3, 4, 5, 6, 7]


def test_a_run_that_dies_before_its_switch_leaves_the_table(spark, monkeypatch):
    path = C.scratch_table(spark, "t")
    d1, d2 = datetime(2024, 1, 1), datetime(2024, 1, 2)
    merge_into(spark, _batch(spark, [(1, "a", d1, "I", 1, 1), (2, "b", d2, "I", 1, 1)]), SPEC, path)

    def dies(*_):
        raise OSError("gone")

    move = _batch(spark, [(1, "a2", d2, "U", 2, 2)])
    with monkeypatch.context() as m:
        m.setattr(C, "switch", dies)
        for full in (False, True):
            with pytest.raises(OSError):
                merge_into(spark, move, SPEC, path, full_refresh=full)
            assert sorted((r.k, r.v, str(r.day)) for r in read_table(spark, path).collect()) == [(1, "a", "2024-01-01"), (2, "b", "2024-01-02")]
    assert len(files(spark, path, "w-*")) == 1  # what the runs had written is gone
    merge_into(spark, move, SPEC, path)
    assert sorted((r.k, r.v, str(r.day)) for r in read_table(spark, path).collect()) == [(1, "a2", "2024-01-02"), (2, "b", "2024-01-02")]


def test_a_run_that_dies_between_two_partitions_is_completed_by_its_batch(spark, monkeypatch):
    path = C.scratch_table(spark, "t")
    d1, d2, d3 = datetime(2024, 1, 1), datetime(2024, 1, 2), datetime(2024, 1, 3)
    merge_into(spark, _batch(spark, [(1, "a", d1, "I", 1, 1), (2, "b", d2, "I", 1, 1), (3, "c", d1, "I", 1, 1)]), SPEC, path)
    batch = _batch(spark, [(1, "a2", d2, "U", 2, 2), (2, "b2", d3, "U", 2, 2), (3, None, d1, "D", 2, 2)])
    whole = C._each

    def dies(spark, start, *more):
        if "DROP" in start:
            raise OSError("gone")
        whole(spark, start, *more)

    with monkeypatch.context() as m:
        m.setattr(C, "_each", dies)
        with pytest.raises(OSError):
            merge_into(spark, batch, SPEC, path)
    assert {r.k for r in read_table(spark, path).collect()} >= {1, 2}
    merge_into(spark, batch, SPEC, path)
    assert sorted((r.k, r.v, str(r.day)) for r in read_table(spark, path).collect()) == [(1, "a2", "2024-01-02"), (2, "b2", "2024-01-03")]
    assert C.remove_unused(spark, path) >= 0
    assert sorted(r.k for r in read_table(spark, path).collect()) == [1, 2]


def test_of_two_writers_the_second_is_refused(spark):
    path = C.scratch_table(spark, "t")
    d = datetime(2024, 1, 1)
    merge_into(spark, _batch(spark, [(1, "a", d, "I", 1, 1)]), SPEC, path)
    began = C.merges(spark, path)
    merge_into(spark, _batch(spark, [(2, "b", d, "I", 2, 2)]), SPEC, path)
    with pytest.raises(C.ConcurrentWrite):
        merge_into(spark, _batch(spark, [(3, "c", d, "I", 3, 3)]), SPEC, path, started=began)
    assert sorted(r.k for r in read_table(spark, path).collect()) == [1, 2]
    new = C.scratch_table(spark, "n")
    merge_into(spark, _batch(spark, [(1, "a", d, "I", 1, 1)]), SPEC, new, started=-1)
    with pytest.raises(C.ConcurrentWrite):
        merge_into(spark, _batch(spark, [(2, "b", d, "I", 1, 1)]), SPEC, new, started=-1)


def test_no_success_marker_is_needed(spark):
    path = C.scratch_table(spark, "t")
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    conf.set("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false")
    try:
        for k in (1, 2):
            merge_into(spark, _batch(spark, [(k, "a", datetime(2024, 1, 1), "I", 1, 1)]), SPEC, path)
    finally:
        conf.unset("mapreduce.fileoutputcommitter.marksuccessfuljobs")
    assert sorted(r.k for r in read_table(spark, path).collect()) == [1, 2]


def test_folders_do_not_pile_up(spark):
    path, d = C.scratch_table(spark, "t"), datetime(2024, 1, 1)
    counts = []
    for n in range(1, 11):
        merge_into(spark, _batch(spark, [(1, str(n), d, "U", n, n), (n, "x", d + timedelta(days=1), "I", n, n)]), SPEC, path)
        counts.append(len(files(spark, path, "w-*")))
    assert counts == [1] * 10 and len(files(spark, path, "w-*/_p=*")) == 2


def test_folders_that_dead_runs_left_are_removed(spark):
    path, d = C.scratch_table(spark, "t"), datetime(2024, 1, 1)
    merge_into(spark, _batch(spark, [(1, "a", d, "I", 1, 1)]), SPEC, path)
    C.write_folder(_batch(spark, [(5, "dead", d, "I", 1, 1)]), C.home(spark, path), "day", [d.date()])
    assert C.remove_unused(spark, path) == 1 and [r.k for r in read_table(spark, path).collect()] == [1]


def test_a_batch_reads_and_writes_its_own_days(spark):
    path, d = C.scratch_table(spark, "t"), datetime(2024, 1, 1)
    merge_into(spark, _batch(spark, [(k, "a", d + timedelta(days=k % 30), "I", 1, 1) for k in range(300)]), SPEC, path)
    before = set(files(spark, path, "w-*/_p=*"))
    merge_into(spark, _batch(spark, [(1000, "new", d, "I", 2, 2)]), SPEC, path)
    after = set(files(spark, path, "w-*/_p=*"))
    assert {f.rsplit("=", 1)[1] for f in before ^ after} == {"2024-01-01"}
    scope = read_table(spark, path).filter(F.col("day").isin([d.date()]))
    assert "PartitionFilters: [" in scope._jdf.queryExecution().executedPlan().toString()
    assert len(scope.inputFiles()) == len(glob.glob(next(iter(after - before)) + "/*.parquet"))


def test_late_changes_touch_no_partition(spark):
    path, d = C.scratch_table(spark, "t"), datetime(2024, 1, 1)
    merge_into(spark, _batch(spark, [(1, "a", d, "I", 9, 9)]), SPEC, path)
    before = files(spark, path, "w-*")
    r = merge_into(spark, _batch(spark, [(1, "late", d + timedelta(days=1), "U", 2, 2)]), SPEC, path)
    assert r.rows_written == 0 and files(spark, path, "w-*") == before


def scanned(df):
    """Rows that the scans of an executed frame gave out."""
    leaves = df._jdf.queryExecution().executedPlan().collectLeaves()
    return sum(leaves.apply(i).metrics().get("numOutputRows").get().value() for i in range(leaves.size()))


def test_keys_of_one_file_read_few_row_groups(spark):
    """100 partitions of 1,000 spread keys: Bloom filters leave the partition that holds the batch's keys."""
    spec, path = TableSpec(name="t", keys=("k",), partition="p"), C.scratch_table(spark, "t")
    rows = spark.range(100_000).select(
        F.md5(F.col("id").cast("string")).alias("k"), (F.col("id") % 100).cast("int").alias("p"), F.lit("I").alias("op_type"),
        F.lit(1).cast("bigint").alias("current_ts"), F.lit(1).cast("bigint").alias("op_ts"),
    )
    merge_into(spark, rows, spec, path)
    batch = rows.filter("p = 37").limit(20).withColumn("current_ts", F.lit(2).cast("bigint"))
    found = T.holding(C.rows(spark, path), batch, 20, ["k"]).select("k", "p")
    assert found.count() == 20  # a plan of its own below, whose metrics are read
    found = found.select("k")
    found.collect()
    assert scanned(found) <= 5_000
    r = merge_into(spark, batch, spec, path)
    assert r.touched_partitions == 1 and read_table(spark, path).count() == 100_000


def test_one_account_on_one_day_is_split_by_key(spark, tmp_dir):
    """A third of all rows share day and layout column, and still no file has more than its share."""
    path = C.scratch_table(spark, "t")
    rows = spark.range(30_000).select(
        F.col("id").alias("k"), F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("v"),
        F.lit(datetime(2024, 1, 1)).alias("ts"), F.lit("I").alias("op_type"), F.lit(1).cast("bigint").alias("current_ts"), F.lit(1).cast("bigint").alias("op_ts"),
    ).withColumn("day", F.to_date("ts"))
    from tidemark.sinks.tables import layout

    sizes = layout(rows, SPEC).groupBy(F.spark_partition_id()).count().collect()
    assert layout(rows.repartition(8), SPEC).rdd.getNumPartitions() >= 1 and sum(r["count"] for r in sizes) == 30_000
    merge_into(spark, rows, SPEC, path)
    assert file_rows(120 * 1024 * 1024, 1000, 60 * 1024 * 1024) == 500
    assert read_table(spark, path).count() == 30_000


def test_files_stay_below_the_target(spark, tmp_dir, monkeypatch):
    from tidemark.sinks import tables

    monkeypatch.setattr(tables, "file_rows", lambda size, rows, target: file_rows(size, rows, size // 8))
    path = C.scratch_table(spark, "t")
    merge_into(spark, _batch(spark, [(k, f"{k * 7919 % 10007}", datetime(2024, 1, 1), "I", 1, 1) for k in range(8000)]), SPEC, path)
    per_file = [r["count"] for r in read_table(spark, path).groupBy(F.input_file_name()).count().collect()]
    assert max(per_file) <= 1100 and len(per_file) >= 8


def test_other_formats_are_merged_by_their_own_operation(spark):
    """No catalog with row-level operations is installed: the statement is built and Spark refuses the table."""
    spec, path = TableSpec(name="t", keys=("k",), format="delta"), C.scratch_table(spark, "t")
    merge_into(spark, _batch(spark, [(1, "a", datetime(2024, 1, 1), "I", 1, 1)]), TableSpec(name="t", keys=("k",)), path)
    with pytest.raises(Exception, match="(?i)merge|row-level|unsupported"):
        merge_into(spark, _batch(spark, [(1, "b", datetime(2024, 1, 1), "U", 2, 2)]), spec, path)
    with pytest.raises(ValueError):
        merge_into(spark, _batch(spark, [(1, "b", datetime(2024, 1, 1), "U", 2, 2)]).withColumn("b", F.lit(1)), spec, path, batch="b")


def test_many_small_appends_leave_few_files(spark):
    path = C.scratch_table(spark, "m")
    for k in range(24):
        append(spark, spark.range(k * 10, k * 10 + 10).repartition(4), path)
    assert sorted(r.id for r in read_table(spark, path).collect()) == list(range(240))
    assert len(files(spark, path, "w-*")) == 1 and len(files(spark, path, "w-*/*.parquet")) <= T.SMALL_FILES + 1


def test_nested_columns_grow(spark):
    path, spec = C.scratch_table(spark, "n"), TableSpec(name="n", keys=("k",), partition="p")
    S1 = "k bigint, p string, s struct<a:int,i:struct<x:int>>, m map<string,struct<x:int>>, d decimal(10,2), op_type string, current_ts bigint, op_ts bigint"
    S2 = "k bigint, p string, s struct<i:struct<y:string,x:int>,a:smallint>, m map<string,struct<x:int,z:int>>, d decimal(8,1), op_type string, current_ts bigint, op_ts bigint"
    one, two = [(1, "a", (1, (2,)), {"q": (3,)}, None, "I", 1, 1)], [(2, "a", (("y", 5), 4), {"r": (6, 7)}, None, "I", 1, 1)]
    for rows, schema in ((one, S1), (two, S2), ([(3, "b", (8, None), None, None, "I", 2, 2)], S1)):
        merge_into(spark, spark.createDataFrame(rows, schema), spec, path)
    got = {r.k: (r.s, r.m) for r in read_table(spark, path).collect()}
    assert spark.table(path).schema["s"].dataType.simpleString() == "struct<a:int,i:struct<x:int,y:string>>"
    assert got[1][0] == (1, (2, None)) and got[2][0] == (4, (5, "y")) and got[3][0] == (8, None)
    assert got[1][1] == {"q": (3, None)} and got[2][1] == {"r": (6, 7)}
    for bad in (S1.replace("a:int", "a:string"), S1.replace("decimal(10,2)", "decimal(12,2)")):
        with pytest.raises(ValueError):
            merge_into(spark, spark.createDataFrame([], bad).union(spark.createDataFrame([(1, "a", None, None, None, "U", 9, 9)], bad)), spec, path)


def test_rows_appended_to_an_unpartitioned_table(spark, tmp_dir):
    path, spec = C.scratch_table(spark, "m"), TableSpec(name="m", keys=("k",))
    rows = lambda *ks: spark.createDataFrame([(k, "I", 1, 1) for k in ks], "k bigint, op_type string, current_ts bigint, op_ts bigint")
    for some in ((1, 2), (3,), (4, 5)):
        append(spark, rows(*some), path)
    assert sorted(r.k for r in read_table(spark, path).collect()) == [1, 2, 3, 4, 5]
    merge_into(spark, rows(3).withColumn("op_type", F.lit("D")).withColumn("current_ts", F.lit(2).cast("bigint")), spec, path)
    assert sorted(r.k for r in read_table(spark, path).collect()) == [1, 2, 4, 5]


def test_a_batch_of_many_keys_in_small_files_is_not_broadcast(spark, monkeypatch):
    """Files of a few bytes a key would let millions of keys into a broadcast; neither the merge nor the planner does that."""
    spec, path = TableSpec(name="t", keys=("k",), partition="p"), C.scratch_table(spark, "t")
    one = lambda n: F.lit(n).cast("bigint")
    rows = lambda op, ts: spark.range(300_000).select(F.col("id").alias("k"), F.lit("a").alias("p"), F.lit(op).alias("op_type"), one(ts).alias("current_ts"), one(ts).alias("op_ts"))
    merge_into(spark, rows("I", 1), spec, path)
    plans, matched = [], T.M.matched

    def seen(stored, latest, *more):
        plans.append(matched(stored, latest, *more)._jdf.queryExecution().sparkPlan().toString())
        return matched(stored, latest, *more)

    monkeypatch.setattr(T.M, "matched", seen)
    merge_into(spark, rows("D", 2), spec, path)
    merge_into(spark, rows("I", 3).filter("k < 100000"), spec, path)
    assert "BroadcastHashJoin" not in plans[0] and "SortMergeJoin" in plans[0]
    assert "BroadcastHashJoin" in plans[1]
    assert read_table(spark, path).agg(F.count("k"), F.max("k")).first() == (100_000, 99_999)
