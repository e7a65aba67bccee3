import itertools
import random
import re

import pytest

from tidemark.operators.merge import apply_changes, common_type, merge_backlog
from tidemark.sinks import catalog as C
from tidemark.sinks.tables import merge_into
from tidemark.spec import ARRIVAL, EVENT_ORDER, EVENT_TIME, UPSERT_THEN_DELETE, TableSpec
from pyspark.sql.types import StructType

S = "k int, op_type string, current_ts bigint, op_ts bigint, v int, b bigint"


@pytest.mark.parametrize("mode,policy,tombstones", itertools.product((EVENT_ORDER, UPSERT_THEN_DELETE), (EVENT_TIME, ARRIVAL), (False, True)))
def test_one_merge_of_a_backlog_equals_its_batches_in_turn(spark, mode, policy, tombstones):
    rng = random.Random(f"{mode}{policy}{tombstones}")
    rows = [(k, rng.choice("IUUD"), rng.randint(0, 6), rng.randint(0, 2), n, rng.randint(1, 4)) for n, k in enumerate(rng.choices(range(60), k=400))]
    rows = list({(r[0], r[5], r[1], r[2], r[3]): r for r in rows}.values())  # ties would fall to a hash of the row
    batches = {b: spark.createDataFrame([r for r in rows if r[5] == b], S).drop("b") for b in (1, 2, 3, 4)}
    first = spark.createDataFrame([(k, "I", rng.randint(0, 6), 1, -k, 0) for k in range(0, 60, 2)], S).drop("b")
    start = apply_changes(None, first, ["k"], merge_mode=mode, late_policy=policy, keep_tombstones=tombstones).checkpoint()
    want = start
    for b in sorted(batches):
        want = apply_changes(want, batches[b], ["k"], merge_mode=mode, late_policy=policy, keep_tombstones=tombstones).checkpoint()
    got = merge_backlog(start, spark.createDataFrame(rows, S), ["k"], "b", merge_mode=mode, late_policy=policy, keep_tombstones=tombstones)
    cols = sorted(want.columns)
    assert sorted(map(str, got.select(cols).collect())) == sorted(map(str, want.select(cols).collect()))


def test_lists_of_a_backlog_are_not_shuffled(spark):
    """A key's changes and its stored row meet in one shuffle of plain rows, and the list is made behind it."""
    rows = spark.createDataFrame([(k, "U", b, b, k, b) for k in range(20) for b in (1, 2)], S)
    start = apply_changes(None, rows.filter("b = 1").drop("b"), ["k"]).checkpoint()
    plan = merge_backlog(start, rows, ["k"], "b")._jdf.queryExecution().executedPlan().toString()
    assert "partial_collect_list" in plan and not re.search(r"Exchange[^\n]*\n[^\n]*partial_collect_list", plan), plan


@pytest.mark.parametrize("broadcast_bytes", (0, 1 << 25))
def test_a_stored_backlog_moves_keys_between_partitions(spark, broadcast_bytes):
    """Small batches are broadcast, others not: the same table, and what a key leaves behind goes."""
    spec, table = TableSpec(name="t", keys=("k",), partition="p"), C.scratch_table(spark, "t")
    ddl = "k int, p string, op_type string, current_ts bigint, op_ts bigint, b bigint"
    merge_into(spark, spark.createDataFrame([(k, "a", "I", 1, 1, 0) for k in range(6)], ddl).drop("b"), spec, table)
    rows = [(0, "b", "U", 2, 2, 1), (1, "a", "D", 2, 2, 1), (1, None, "I", 3, 3, 2), (2, "c", "U", 0, 0, 1), (3, "b", "U", 5, 5, 1), (3, "c", "U", 4, 4, 2), (9, "d", "D", 2, 2, 1)]
    done = merge_into(spark, spark.createDataFrame(rows, ddl), spec, table, broadcast_bytes=broadcast_bytes, batch="b")
    assert done.batch_keys == 5 and done.touched_partitions == 3
    assert {(r.k, r.p) for r in C.rows(spark, table).collect()} == {(0, "b"), (1, None), (2, "a"), (3, "b"), (4, "a"), (5, "a")}


def test_common_types():
    t = lambda ddl: StructType.fromDDL(f"x {ddl}")["x"].dataType
    for stored, incoming, want in (
        ("bigint", "int", "bigint"), ("decimal(10,2)", "decimal(8,1)", "decimal(10,2)"), ("decimal(22,2)", "bigint", "decimal(22,2)"),
        ("struct<a:int>", "struct<b:int,a:smallint>", "struct<a:int,b:int>"), ("array<struct<a:int,b:int>>", "array<struct<b:int>>", "array<struct<a:int,b:int>>"),
        ("map<string,struct<a:int>>", "map<string,struct<c:date>>", "map<string,struct<a:int,c:date>>"),
    ):
        assert common_type(t(stored), t(incoming), "x").simpleString() == want
    for stored, incoming in (("int", "bigint"), ("decimal(10,2)", "decimal(10,3)"), ("decimal(10,2)", "bigint"), ("struct<a:int>", "int"), ("struct<a:int>", "struct<a:string>")):
        with pytest.raises(ValueError, match="x"):
            common_type(t(stored), t(incoming), "x")
