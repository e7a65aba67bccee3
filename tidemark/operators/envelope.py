"""Change envelope: operation split, single-pass flattening, snapshot floor, unions.

An envelope row carries ``op_type``, ``op_ts``, ``current_ts``, the ``before`` and ``after``
images (structs) and any other top-level columns, which pass through. Flattening picks the
``before`` image for deletes and the ``after`` image otherwise, in one projection, so the
input is scanned once no matter how many operation kinds it holds.
"""

from __future__ import annotations

from functools import reduce
from typing import Iterable, Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StructType

from tidemark.spec import OP_DELETE, OP_SNAPSHOT, OP_UPDATE, OPS, UPSERT_OPS

IMAGES = ("before", "after")
ENVELOPE_COLS = ("op_type", "op_ts", "current_ts")


def image_fields(schema: StructType, image: str) -> dict[str, DataType]:
    if image not in schema.fieldNames():
        return {}
    dtype = schema[image].dataType
    if not isinstance(dtype, StructType):
        raise ValueError(f"envelope column {image!r} must be a struct, found {dtype.simpleString()}")
    return {f.name: f.dataType for f in dtype.fields}


def business_fields(schema: StructType) -> list[str]:
    """Sorted union of the field names of ``before`` and ``after``; a missing image is allowed."""
    return sorted(set(image_fields(schema, "before")) | set(image_fields(schema, "after")))


def business_types(schema: StructType) -> dict[str, DataType]:
    before, after = image_fields(schema, "before"), image_fields(schema, "after")
    out: dict[str, DataType] = {}
    for name in sorted(set(before) | set(after)):
        tb, ta = before.get(name), after.get(name)
        if tb is not None and ta is not None and tb != ta:
            raise ValueError(
                f"field {name!r} has type {tb.simpleString()} in before and {ta.simpleString()} in after"
            )
        out[name] = ta if ta is not None else tb
    return out


def op_counts() -> list[Column]:
    """Rows by operation, as aggregates to observe."""
    op = F.col("op_type")
    return [
        F.count(F.lit(1)).alias("rows"),
        F.count_if(op == "I").alias("inserts"),
        F.count_if(op == "U").alias("updates"),
        F.count_if(op == "D").alias("deletes"),
        F.count_if(op == "R").alias("snapshots"),
        F.count_if(op.isNull() | ~op.isin(*OPS)).alias("rejected_op"),
    ]


def observe_ops(df: DataFrame, name: str = "ops") -> tuple[DataFrame, Observation]:
    """Attach per-operation counters; they are filled by the first action on the result."""
    obs = Observation(name)
    observed = df.observe(obs, *op_counts())
    return observed, obs


def split_ops(df: DataFrame, ops: Sequence[str] = OPS) -> DataFrame:
    """Keep rows whose operation code is known; other (or null) codes are dropped.

    One filter instead of one per code: the predicate reaches the scan as ``In(op_type, ...)``.
    """
    return df.filter(F.col("op_type").isin(*ops))


def _image_value(name: str, dtype: DataType, present: dict[str, DataType], image: str) -> Column:
    if name in present:
        return F.col(image).getField(name)
    return F.lit(None).cast(dtype)


def flatten(df: DataFrame, partial_after: bool = False) -> DataFrame:
    """Project each business field from the image that belongs to the row's operation.

    ``D`` rows read ``before``; ``I``, ``U`` and ``R`` rows read ``after``. A field missing from one
    image is null there. With ``partial_after``, an update whose ``after`` lacks a value keeps the
    ``before`` value (images that only carry changed columns).
    """
    schema = df.schema
    types = business_types(schema)
    before, after = image_fields(schema, "before"), image_fields(schema, "after")
    others = [c for c in df.columns if c not in IMAGES]
    clash = sorted(set(types) & set(others))
    if clash:
        raise ValueError(f"business fields {clash} collide with envelope columns of the same name")
    is_delete = F.col("op_type") == OP_DELETE
    exprs = []
    for name, dtype in types.items():
        b = _image_value(name, dtype, before, "before")
        a = _image_value(name, dtype, after, "after")
        if partial_after:
            a = F.when(F.col("op_type") == OP_UPDATE, F.coalesce(a, b)).otherwise(a)
        exprs.append(F.when(is_delete, b).otherwise(a).alias(name))
    return df.select(*exprs, *[F.col(f"`{c}`") for c in others])


def floor_snapshot(df: DataFrame, floor_us: int) -> DataFrame:
    """Snapshot rows (``R``) take the floor as ordering value so any later change wins."""
    ts = F.col("current_ts")
    return df.withColumn(
        "current_ts", F.when(F.col("op_type") == OP_SNAPSHOT, F.lit(floor_us).cast("bigint")).otherwise(ts)
    )


def upserts(df: DataFrame) -> DataFrame:
    return df.filter(F.col("op_type").isin(*UPSERT_OPS))


def align_union(dfs: Iterable[DataFrame], strict: bool = True) -> DataFrame:
    """Union by column name. ``strict=False`` fills columns missing on one side with null."""
    frames = [d for d in dfs if d is not None]
    if not frames:
        raise ValueError("align_union needs at least one frame")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=not strict), frames)


def split_key_changes(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """An update whose ``before`` key differs from its ``after`` key also deletes the old key.

    Narrow: each such row becomes two rows (a ``D`` carrying the before image, then the update)
    through ``explode``; no shuffle.
    """
    before, after = image_fields(df.schema, "before"), image_fields(df.schema, "after")
    if not before or not all(k in before and k in after for k in keys):
        return df
    changed = F.lit(False)
    for k in keys:
        changed = changed | ~F.col("before").getField(k).eqNullSafe(F.col("after").getField(k))
    cond = (F.col("op_type") == OP_UPDATE) & F.col("before").isNotNull() & changed
    cols = df.columns
    original = F.struct(*[F.col(f"`{c}`") for c in cols])
    extra = F.struct(
        *[
            F.lit(OP_DELETE).alias(c) if c == "op_type"
            else F.lit(None).cast(df.schema["after"].dataType).alias(c) if c == "after"
            else F.col(f"`{c}`")
            for c in cols
        ]
    )
    return df.select(F.explode(F.array(original, F.when(cond, extra))).alias("_e")).filter(
        F.col("_e").isNotNull()
    ).select("_e.*")
