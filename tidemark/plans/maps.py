"""Map jobs: read the stored source, probe the target, write it whole once, then only new keys.

An account job reads the customer map, so it runs after the customer job whatever the order given.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Iterable, Optional

from pyspark.sql import SparkSession

from tidemark.operators import keymaps as KM
from tidemark.session import apply_engine_conf, checkpoint_root
from tidemark.sinks.tables import append
from tidemark.sources.readers import read_table, table_if_exists


@dataclass
class MapJob:
    """``source`` is a path or a table, ``target`` a table; ``customer_map`` is the customer map for an account job, else None."""

    name: str
    source: str
    target: str
    key: str
    salt: str
    customer_map: Optional[str] = None
    fmt: str = "parquet"


def run_map(spark: SparkSession, job: MapJob, now: Optional[str] = None) -> int:
    """Add the source's new keys to the map; the number of rows added. No new keys, no write."""
    apply_engine_conf(spark)
    checkpoint_root(spark)
    source, existing = read_table(spark, job.source, job.fmt), table_if_exists(spark, job.target)
    if job.customer_map is None:
        rows = KM.build_map(source, existing, job.key, job.salt, now)
    else:
        rows = KM.build_account_map(source, read_table(spark, job.customer_map), existing, job.salt, now)
    rows = rows.checkpoint(eager=True)
    added = rows.count()
    if added:
        append(spark, rows, job.target)
    return added


def run_maps(spark: SparkSession, jobs: Iterable[MapJob], now: Optional[str] = None) -> dict[str, int]:
    """All jobs, those that read the customer map last; rows added by name."""
    return {job.name: run_map(spark, job, now) for job in sorted(jobs, key=lambda j: j.customer_map is not None)}
