"""Which files a run reads: listing, classification, arrival window, batches, retry floor.

File lists are DataFrames (``path, file_name, day, mtime, length``); nothing is listed or sorted
on the driver. ``list_files`` uses the ``binaryFile`` source without touching ``content``, so only
file metadata is read.
"""

from __future__ import annotations

from datetime import date, datetime, timedelta, timezone
from typing import Iterable, Optional
from zoneinfo import ZoneInfo

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from tidemark.operators.ordinal import in_order, running, running_in
from tidemark.spec import CHANGE_PREFIX, LOCAL_ZONE, SNAPSHOT_PREFIX, name_list

SNAPSHOT = "snapshot"
CHANGE = "change"
DAY_PATTERN = r"/(\d{4}-\d{2}-\d{2})/"
ORDER = ("mtime", "path")


def file_name(path: Column) -> Column:
    return F.regexp_extract(path, r"[^/]+$", 0)


def as_utc(v) -> datetime:
    """A time with its zone; text, dates and times without a zone are UTC."""
    if not isinstance(v, datetime):
        v = datetime(v.year, v.month, v.day) if isinstance(v, date) else datetime.fromisoformat(str(v))
    return v.replace(tzinfo=timezone.utc) if v.tzinfo is None else v.astimezone(timezone.utc)


def folder_days(from_time, to_time, slack_days: int = 0, zone: str = LOCAL_ZONE) -> tuple[date, date]:
    """First and last day folder of a window: folders carry the day of the source's own zone."""
    first, last = (as_utc(t).astimezone(ZoneInfo(zone)).date() for t in (from_time, to_time))
    return first - timedelta(days=slack_days), last + timedelta(days=slack_days)


def day_folders(from_time, to_time, slack_days: int = 0, zone: str = LOCAL_ZONE) -> list[str]:
    """Day folder names (``YYYY-MM-DD``) between two times, both ends included."""
    first, last = folder_days(from_time, to_time, slack_days, zone)
    return [(first + timedelta(days=i)).isoformat() for i in range((last - first).days + 1)]


def list_files(
    spark: SparkSession,
    root: str,
    from_time: Optional[datetime] = None,
    to_time: Optional[datetime] = None,
    slack_days: int = 0,
    zone: str = LOCAL_ZONE,
) -> DataFrame:
    """List files below ``root`` (``root/<YYYY-MM-DD>/...``). Only day folders of the window are
    looked into when both bounds are given; content is never read."""
    root = root.rstrip("/")
    if from_time is not None and to_time is not None:
        days = day_folders(from_time, to_time, slack_days, zone)
        target = f"{root}/{{{','.join(days)}}}" if len(days) > 1 else f"{root}/{days[0]}"
    else:
        target = root
    schema = "path string, modificationTime timestamp, length bigint"
    try:
        raw = (
            spark.read.format("binaryFile")
            .option("recursiveFileLookup", "true")
            .load(target)
            .select("path", "modificationTime", "length")
        )
    except AnalysisException as e:
        if "PATH_NOT_FOUND" in str(e) or "Path does not exist" in str(e):
            raw = spark.createDataFrame([], schema)
        else:
            raise
    return raw.select(
        F.col("path"),
        file_name(F.col("path")).alias("file_name"),
        F.to_date(F.nullif(F.regexp_extract("path", DAY_PATTERN, 1), F.lit(""))).alias("day"),
        F.col("modificationTime").alias("mtime"),
        F.col("length"),
    )


def classify(files: DataFrame, snapshot_prefix: str = SNAPSHOT_PREFIX, change_prefix: str = CHANGE_PREFIX) -> DataFrame:
    """Add ``kind``: snapshot / change by base-name prefix (or the prefix of the data-set folder that
    holds a part file); files with any other name are dropped."""
    name = F.col("file_name")
    # A data set written by Spark is a folder of part files: the folder carries the name.
    folder = F.regexp_extract(F.col("path"), r"([^/]+)/part-[^/]+$", 1)
    kind = (
        F.when(name.startswith(snapshot_prefix), F.lit(SNAPSHOT))
        .when(name.startswith(change_prefix), F.lit(CHANGE))
        .when(folder.startswith(snapshot_prefix), F.lit(SNAPSHOT))
        .when(folder.startswith(change_prefix), F.lit(CHANGE))
    )
    return files.withColumn("kind", kind).filter(F.col("kind").isNotNull())


def _ts(v) -> Column:
    return F.lit(as_utc(v)).cast("timestamp")


def select_window(files: DataFrame, from_time=None, to_time=None, slack_days: int = 0, zone: str = LOCAL_ZONE) -> DataFrame:
    """Files with ``from <= mtime <= to`` (both ends included).

    With both bounds only day folders between the two dates (widened by ``slack_days``) count and
    ``to <= from`` selects nothing; a missing bound is not applied.
    """
    cond = F.lit(True)
    if from_time is not None and to_time is not None:
        if as_utc(to_time) <= as_utc(from_time):
            return files.limit(0)
        first, last = folder_days(from_time, to_time, slack_days, zone)
        cond = F.col("day").between(F.lit(first), F.lit(last))
    if from_time is not None:
        cond = cond & (F.col("mtime") >= _ts(from_time))
    if to_time is not None:
        cond = cond & (F.col("mtime") <= _ts(to_time))
    return files.filter(cond)


def order_files(files: DataFrame) -> DataFrame:
    """Files in arrival order; the path breaks ties so the order is total."""
    return files.orderBy(*ORDER)


def batch_files(files: DataFrame, size: int) -> DataFrame:
    """``batch_id`` = position in arrival order // size (consecutive batches of ``size`` files)."""
    if size < 1:
        raise ValueError("batch size must be >= 1")
    with_ord = running(files, ORDER)
    return with_ord.withColumn("batch_id", F.floor(F.col("ordinal") / size).cast("bigint"))


def special_files(names: Iterable[str]) -> Column:
    """Files named in a configuration list (full path or base name; ``,`` or ``;`` separated)."""
    lst = sorted({name for item in names for name in name_list(item)})
    if not lst:
        return F.lit(False)
    return F.col("path").isin(lst) | F.col("file_name").isin(lst)


def batch_files_isolated(files: DataFrame, size: int, special: Column) -> DataFrame:
    """Batches of ``size`` files in arrival order, where every special file is a batch of its own.

    Pending normal files are flushed before a special file, and counting starts again after it.
    """
    if size < 1:
        raise ValueError("batch size must be >= 1")
    # The place of a special file starts a new count after it, so a batch begins where its distance to
    # the last special file says so. Ordinals, last special files and the running count of the batch
    # starts come from one staged order.
    staged = in_order(files.withColumn("_special", special.cast("boolean")), ORDER)
    base = running_in(staged, ORDER)
    marked = running_in(base, ORDER, maxes={"_last_special": F.when(F.col("_special"), F.col("ordinal"))}, ordinal=None)
    last = F.col("_last_special")
    island_start = F.when(last.isNull(), F.lit(0)).otherwise(last + 1)
    pos = F.col("ordinal") - island_start
    start = F.when(F.col("_special"), F.col("ordinal")).otherwise(island_start + F.floor(pos / size) * size)
    starts = marked.withColumn("batch_start", start.cast("bigint"))
    numbered = running_in(starts, ORDER, sums={"_n_batches": (F.col("ordinal") == F.col("batch_start")).cast("bigint")}, ordinal=None)
    return numbered.select(
        *[c for c in files.columns],
        "ordinal",
        F.col("_special").alias("special"),
        (F.col("_n_batches") - 1).alias("batch_id"),
    )


def retry_floor(files: DataFrame, failed: DataFrame, common_from=None, to_time=None) -> DataFrame:
    """Per-table windows: a table listed in ``failed`` (``table_name, failed_from``) starts at its own
    ``failed_from`` (null = from the beginning); other tables start at ``common_from``.

    ``failed`` has one row per table; AQE broadcasts it by its measured size, so the file list is not shuffled.
    """
    f = failed.select("table_name", F.col("failed_from").cast("timestamp").alias("_failed_from"), F.lit(True).alias("_failed"))
    j = files.join(f, "table_name", "left")
    lower = F.when(F.col("_failed").isNotNull(), F.col("_failed_from")).otherwise(
        _ts(common_from) if common_from is not None else F.lit(None).cast("timestamp")
    )
    cond = lower.isNull() | (F.col("mtime") >= lower)
    if to_time is not None:
        cond = cond & (F.col("mtime") <= _ts(to_time))
    return j.filter(cond).drop("_failed_from", "_failed")


def force_select(files: DataFrame, names: str, from_time=None, to_time=None) -> DataFrame:
    """Files of the named tables (``,``/``;`` separated, any case, optional ``_etl`` suffix) from
    ``from_time`` (or the beginning) up to ``to_time``; unknown names match nothing."""
    wanted = sorted({name.lower() for name in name_list(names)})
    base = {w[:-4] if w.endswith("_etl") else w for w in wanted}
    cond = F.lower(F.col("table_name")).isin(sorted(base | set(wanted))) if wanted else F.lit(False)
    if from_time is not None:
        cond = cond & (F.col("mtime") >= _ts(from_time))
    if to_time is not None:
        cond = cond & (F.col("mtime") <= _ts(to_time))
    return files.filter(cond)
