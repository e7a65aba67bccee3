"""Write fixture change/snapshot data sets as files, the way an extractor lands them.

Each data set is a folder named with the file prefix (``INIT.`` / ``BACK.``) below a day folder,
holding the part files Spark writes.
"""

from __future__ import annotations

import time
from datetime import datetime, timezone
from zoneinfo import ZoneInfo

from pyspark.sql import SparkSession

from tidemark.fixtures import frames as FX
from tidemark.spec import LOCAL_ZONE


def today() -> str:
    """The day folder of now, in the zone of the source."""
    return datetime.now(ZoneInfo(LOCAL_ZONE)).date().isoformat()


def write_dataset(spark: SparkSession, sf_dir: str, root: str, name: str, parts: str, snapshot: bool = False) -> str:
    df = FX.snapshot_files_frame(spark, sf_dir, envelope_times=True) if snapshot else FX.change_envelope(spark, sf_dir, parts)
    path = f"{root.rstrip('/')}/{today()}/{name}"
    df.write.mode("errorifexists").parquet(path)
    return path


def land_two_batches(spark: SparkSession, sf_dir: str, root: str, snapshot_file: bool = True) -> datetime:
    """Batch 1 (snapshot + changes a-f, h, i), then - strictly later - batch 2 (g, z).

    Returns a time between the two landings (UTC, aware).
    """
    if snapshot_file:
        write_dataset(spark, sf_dir, root, "INIT.0000", "a", snapshot=True)
        write_dataset(spark, sf_dir, root, "BACK.0001", FX.BATCH_ONE.replace("a", ""))
    else:
        write_dataset(spark, sf_dir, root, "BACK.0001", FX.BATCH_ONE)
    time.sleep(1.1)
    mid = datetime.now(timezone.utc)
    time.sleep(1.1)
    write_dataset(spark, sf_dir, root, "BACK.0002", FX.BATCH_TWO)
    return mid
