"""Running aggregates over a global order without moving all rows into one task.

A window with ``orderBy`` and no ``partitionBy`` sends every row to a single partition. Here the
rows are range-partitioned on the ordering columns instead (the ordering must be unique, e.g.
``(mtime, path)``), each partition computes its own running values, and the per-partition totals
- one row per partition, a bounded frame - are turned into offsets that are broadcast back.
The range-partitioned frame is checkpointed first so that a recomputation after a lost executor
sees the same partition boundaries.
"""

from __future__ import annotations

from typing import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.session import checkpoint_root

PID = "_pid"


def in_order(df: DataFrame, order: Sequence[str], partitions: int | None = None) -> DataFrame:
    """The rows range-partitioned by ``order`` and checkpointed, with the number of their range as ``PID``.

    Several calls of ``running_in`` can follow on the one staged order.
    """
    checkpoint_root(df.sparkSession)
    n = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartitionByRange(n, *[F.col(c) for c in order]).withColumn(PID, F.spark_partition_id()).checkpoint(eager=True)


def running(
    df: DataFrame,
    order: Sequence[str],
    sums: Mapping[str, Column] | None = None,
    maxes: Mapping[str, Column] | None = None,
    ordinal: str | None = "ordinal",
    partitions: int | None = None,
) -> DataFrame:
    """Add running (inclusive) sums/maxes and a 0-based ``ordinal`` in the order of ``order``.

    ``sums``/``maxes`` map output name -> numeric column. Maxes of an empty prefix are null.
    """
    sums, maxes = dict(sums or {}), dict(maxes or {})
    values = {**{f"_v_s_{k}": v for k, v in sums.items()}, **{f"_v_m_{k}": v for k, v in maxes.items()}}
    staged = in_order(df.select("*", *[v.alias(k) for k, v in values.items()]), order, partitions)
    out = running_in(staged, order, {k: F.col(f"_v_s_{k}") for k in sums}, {k: F.col(f"_v_m_{k}") for k in maxes}, ordinal)
    return out.drop(PID, *values)


def running_in(
    staged: DataFrame,
    order: Sequence[str],
    sums: Mapping[str, Column] | None = None,
    maxes: Mapping[str, Column] | None = None,
    ordinal: str | None = "ordinal",
) -> DataFrame:
    """``running`` over what ``in_order`` staged by ``order``, or over an earlier result of this function; ``PID`` stays."""
    sums = dict(sums or {})
    maxes = dict(maxes or {})
    if ordinal:
        sums[ordinal] = F.lit(1)
    columns = staged.columns
    values = {**{f"_s_{k}": v for k, v in sums.items()}, **{f"_m_{k}": v for k, v in maxes.items()}}
    staged = staged.select("*", *[v.alias(k) for k, v in values.items()])
    w = Window.partitionBy(PID).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = staged.select(
        "*",
        *[F.sum(f"_s_{k}").over(w).alias(f"_ls_{k}") for k in sums],
        *[F.max(f"_m_{k}").over(w).alias(f"_lm_{k}") for k in maxes],
    )
    # One row per partition: bounded by the partition count, safe to broadcast.
    totals = staged.groupBy(PID).agg(
        *[F.sum(f"_s_{k}").alias(f"_ts_{k}") for k in sums],
        *[F.max(f"_m_{k}").alias(f"_tm_{k}") for k in maxes],
    )
    before = Window.orderBy(PID).rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        PID,
        *[F.coalesce(F.sum(f"_ts_{k}").over(before), F.lit(0)).alias(f"_os_{k}") for k in sums],
        *[F.max(f"_tm_{k}").over(before).alias(f"_om_{k}") for k in maxes],
    )
    joined = local.join(F.broadcast(offsets), PID, "inner")
    out = [F.col(f"`{c}`") for c in columns]
    for k in sums:
        e = F.col(f"_ls_{k}") + F.col(f"_os_{k}")
        out.append((e - 1).alias(k) if k == ordinal else e.alias(k))
    for k in maxes:
        out.append(
            F.when(F.col(f"_om_{k}").isNull(), F.col(f"_lm_{k}"))
            .when(F.col(f"_lm_{k}").isNull(), F.col(f"_om_{k}"))
            .otherwise(F.greatest(F.col(f"_lm_{k}"), F.col(f"_om_{k}")))
            .alias(k)
        )
    return joined.select(*out)
