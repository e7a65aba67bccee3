"""Time expressions.

Timestamps without zone (NTZ) cannot go into ``unix_micros`` directly; they are cast to
``timestamp`` first, which is exact when the session zone is UTC.
"""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DateType, TimestampNTZType, TimestampType

TIME_TYPES = (DateType, TimestampType, TimestampNTZType)


def shift(c: Column | str, dtype: DataType, hours: int, keep_dates: bool = False) -> Column:
    """Move a date/time value by ``hours``. Dates become timestamps at that hour unless kept."""
    c = F.col(c) if isinstance(c, str) else c
    delta = F.lit(timedelta(hours=hours))
    if isinstance(dtype, DateType):
        if keep_dates:
            return c
        return F.to_timestamp(c) + delta
    return c + delta


def clamp_low(c: Column | str, dtype: DataType, low: str) -> Column:
    """Raise values below ``low`` to ``low``; null stays null (``greatest`` would skip nulls)."""
    c = F.col(c) if isinstance(c, str) else c
    target = "timestamp_ntz" if isinstance(dtype, TimestampNTZType) else "timestamp"
    lo = F.lit(low).cast(target)
    return F.when(c < lo, lo).otherwise(c)
