from datetime import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tidemark.operators.envelope import (
    align_union,
    business_fields,
    flatten,
    floor_snapshot,
    observe_ops,
    split_ops,
)

SCHEMA = (
    "op_type string, op_ts bigint, current_ts bigint, pos string, "
    "before struct<id:bigint, name:string, old_only:string>, "
    "after struct<id:bigint, name:string, amount:decimal(12,2), tags:array<string>>"
)


def rows():
    return [
        ("I", 1, 1, "p1", None, (1, "a", Decimal("1.50"), ["x"])),
        ("U", 2, 2, "p2", (1, "a", "o"), (1, "b", Decimal("2.00"), ["x", "y"])),
        ("D", 3, 3, "p3", (1, "b", "o"), None),
        ("R", 0, 0, "p4", None, (2, "s", None, [])),
        ("X", 4, 4, "p5", None, (3, "bad", None, None)),
        (None, 5, 5, "p6", None, (4, "null-op", None, None)),
    ]


def test_business_fields_union_sorted(spark):
    df = spark.createDataFrame(rows(), SCHEMA)
    assert business_fields(df.schema) == ["amount", "id", "name", "old_only", "tags"]
    only_after = df.drop("before")
    assert business_fields(only_after.schema) == ["amount", "id", "name", "tags"]


def test_split_drops_unknown_and_null_ops(spark):
    df = spark.createDataFrame(rows(), SCHEMA)
    assert sorted(r.op_type for r in split_ops(df).collect()) == ["D", "I", "R", "U"]


def test_flatten_picks_image_by_op_and_fills_missing(spark):
    df = split_ops(spark.createDataFrame(rows(), SCHEMA))
    out = {r.pos: r for r in flatten(df).collect()}
    assert out["p1"].name == "a" and out["p1"].old_only is None
    assert out["p2"].name == "b" and out["p2"].tags == ["x", "y"]
    # delete reads before; a field that only after has is null
    assert out["p3"].name == "b" and out["p3"].old_only == "o" and out["p3"].amount is None
    assert out["p4"].id == 2
    # pass-through: decimal and array keep their types, other top-level columns stay
    types = dict(flatten(df).dtypes)
    assert types["amount"] == "decimal(12,2)" and types["tags"] == "array<string>" and "pos" in types
    assert "before" not in types and "after" not in types


def test_flatten_partial_after_keeps_before_values(spark):
    df = spark.createDataFrame(
        [("U", 1, 1, (1, "old"), (1, None))], "op_type string, op_ts bigint, current_ts bigint, before struct<id:bigint,name:string>, after struct<id:bigint,name:string>"
    )
    assert flatten(df).collect()[0].name is None
    assert flatten(df, partial_after=True).collect()[0].name == "old"


def test_flatten_rejects_field_named_like_envelope_column(spark):
    df = spark.createDataFrame([("I", 1, 1, None, (1, 5))], "op_type string, op_ts bigint, current_ts bigint, before struct<id:bigint,op_ts:bigint>, after struct<id:bigint,op_ts:bigint>")
    with pytest.raises(ValueError, match="collide"):
        flatten(df)


def test_floor_snapshot_only_touches_snapshot_rows(spark):
    df = spark.createDataFrame([("R", 5), ("I", 6)], "op_type string, current_ts bigint")
    out = dict((r.op_type, r.current_ts) for r in floor_snapshot(df, 100).collect())
    assert out == {"R": 100, "I": 6}


def test_observe_counts_without_extra_job(spark):
    df, obs = observe_ops(spark.createDataFrame(rows(), SCHEMA))
    split_ops(df).write.format("noop").mode("overwrite").save()
    m = obs.get
    assert (m["rows"], m["inserts"], m["updates"], m["deletes"], m["snapshots"], m["rejected_op"]) == (6, 1, 1, 1, 1, 2)


def test_union_by_name_strict_and_null_fill(spark):
    a = spark.createDataFrame([(1, "x")], "id bigint, name string")
    b = spark.createDataFrame([("y", 2)], "name string, id bigint")
    assert sorted(r.id for r in align_union([a, b]).collect()) == [1, 2]
    c = spark.createDataFrame([(3,)], "id bigint")
    with pytest.raises(Exception):
        align_union([a, c]).collect()
    filled = align_union([a, c], strict=False).collect()
    assert {(r.id, r.name) for r in filled} == {(1, "x"), (3, None)}
