"""From envelope rows to merge-ready change rows, as one lazy plan.

``split -> flatten -> snapshot floor -> shift -> clamp -> table steps -> day partition -> required``

Upserts and deletes stay in one frame (told apart by ``op_type``); nothing is counted or
collected here, so the whole chain compiles into the scan's codegen stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from tidemark.operators.envelope import flatten, floor_snapshot, split_key_changes, split_ops
from tidemark.operators.normalize import clamp_times, require, shift_times, with_day
from tidemark.spec import TableSpec


def prepare_changes(envelope: DataFrame, spec: TableSpec) -> DataFrame:
    df = split_ops(envelope)
    if spec.split_key_change:
        df = split_key_changes(df, spec.keys)
    df = flatten(df, partial_after=spec.partial_after)
    df = floor_snapshot(df, spec.snapshot_floor_us)
    df = shift_times(df, spec.shift_hours, spec.keep_dates)
    df = clamp_times(df, spec.clamp_low, include_ntz=spec.clamp_ntz)
    if spec.post is not None:
        df = df.transform(spec.post)
    if spec.partition and spec.partition_source:
        df = with_day(df, spec.partition_source, spec.partition)
    return require(df, spec.required, spec.keys)
