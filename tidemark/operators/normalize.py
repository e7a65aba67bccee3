"""Normalisation of flattened change rows: time shift, low clamp, required columns, day partition.

All steps are single projections/filters built from the schema (no per-column ``withColumn``
loop), so Catalyst sees one ``Project`` and keeps the whole chain in one codegen stage.
"""

from __future__ import annotations

from typing import Iterable, Optional, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampNTZType, TimestampType

from tidemark.functions.time import TIME_TYPES, clamp_low, shift
from tidemark.spec import OP_DELETE


def _time_columns(df: DataFrame, columns: Optional[Iterable[str]] = None) -> dict[str, object]:
    wanted = None if columns is None else set(columns)
    return {
        f.name: f.dataType
        for f in df.schema.fields
        if isinstance(f.dataType, TIME_TYPES) and (wanted is None or f.name in wanted)
    }


def shift_times(df: DataFrame, hours: int, keep_dates: bool = False, columns: Optional[Iterable[str]] = None) -> DataFrame:
    """Add ``hours`` to every date/timestamp/NTZ column; dates become timestamps unless kept."""
    if hours == 0 and keep_dates:
        return df
    times = _time_columns(df, columns)
    if not times:
        return df
    return df.select(
        *[
            shift(F.col(f"`{c}`"), times[c], hours, keep_dates).alias(c) if c in times else F.col(f"`{c}`")
            for c in df.columns
        ]
    )


def clamp_times(df: DataFrame, low: str, include_ntz: bool = False, high: Optional[str] = None) -> DataFrame:
    """Raise timestamp values below ``low`` to ``low`` (null kept); NTZ only with ``include_ntz``.

    ``high`` optionally lowers values above it (use before a shift near the top of the range).
    """
    kinds = (TimestampType, TimestampNTZType) if include_ntz else (TimestampType,)
    targets = {f.name: f.dataType for f in df.schema.fields if isinstance(f.dataType, kinds)}
    if not targets:
        return df

    def clamp(c: str) -> Column:
        e = clamp_low(F.col(f"`{c}`"), targets[c], low)
        if high is not None:
            hi = F.lit(high).cast("timestamp_ntz" if isinstance(targets[c], TimestampNTZType) else "timestamp")
            e = F.when(e > hi, hi).otherwise(e)
        return e.alias(c)

    return df.select(*[clamp(c) if c in targets else F.col(f"`{c}`") for c in df.columns])


def require(df: DataFrame, cols: Sequence[str], keys: Sequence[str] = ()) -> DataFrame:
    """Drop upsert rows with a null in ``cols``; delete rows only need their ``keys``."""
    if not cols and not keys:
        return df
    ok_upsert = F.lit(True)
    for c in list(cols) + [k for k in keys if k not in cols]:
        ok_upsert = ok_upsert & F.col(f"`{c}`").isNotNull()
    ok_delete = F.lit(True)
    for k in keys:
        ok_delete = ok_delete & F.col(f"`{k}`").isNotNull()
    is_delete = F.col("op_type") == OP_DELETE
    return df.filter(F.when(is_delete, ok_delete).otherwise(ok_upsert))


def with_day(df: DataFrame, source: str, out: str) -> DataFrame:
    """Day partition column from an (already shifted) timestamp/date column."""
    return df.withColumn(out, F.to_date(F.col(f"`{source}`")))
