"""Session helpers: a local session for tests/bench and the shared scratch folder.

Scratch data (checkpoints, staged tables) always goes below the folder the cluster names in
``spark.checkpoint.dir``. Only when that setting is absent (unit tests, local runs) do we pick a
folder of our own.
"""

from __future__ import annotations

import tempfile
import uuid

from typing import Iterable

from pyspark.sql import SparkSession

#: Most keys that are pushed down to a scan one by one.
PUSHED_KEYS = 1000


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "tidemark") -> SparkSession:
    """A local session configured the way the engine expects (UTC, AQE, no UI)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        # A task per listed folder costs more than the listing here.
        .config("spark.sql.sources.parallelPartitionDiscovery.parallelism", "16")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    # On a local disk a checksum file beside each file costs as much as the file, in thousands of small ones.
    sc = spark.sparkContext
    sc._jvm.org.apache.hadoop.fs.FileSystem.getLocal(sc._jsc.hadoopConfiguration()).setWriteChecksum(False)
    apply_engine_conf(spark)
    return spark


def apply_engine_conf(spark: SparkSession) -> None:
    """Session settings that change answers: UTC session zone and proleptic calendar on parquet."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    for k in (
        "spark.sql.parquet.datetimeRebaseModeInWrite",
        "spark.sql.parquet.datetimeRebaseModeInRead",
        "spark.sql.parquet.int96RebaseModeInWrite",
        "spark.sql.parquet.int96RebaseModeInRead",
    ):
        spark.conf.set(k, "CORRECTED")
    # Keys of a small batch reach the files' Bloom filters as a list of values.
    spark.conf.set("spark.sql.parquet.pushdown.inFilterThreshold", str(PUSHED_KEYS))


_OWN_ROOT: dict[int, str] = {}


def checkpoint_root(spark: SparkSession) -> str:
    """The shared checkpoint folder; set one of our own only when the session has none."""
    sc = spark.sparkContext
    conf = sc.getConf().get("spark.checkpoint.dir", None)
    if conf:
        if sc.getCheckpointDir() is None:
            sc.setCheckpointDir(conf)
        return conf.rstrip("/")
    key = id(sc)
    if key not in _OWN_ROOT:
        current = sc.getCheckpointDir()
        if current is not None:
            _OWN_ROOT[key] = current.rstrip("/")
        else:
            if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
                raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
            root = tempfile.mkdtemp(prefix="tidemark-ckpt-")
            sc.setCheckpointDir(root)
            _OWN_ROOT[key] = root
    return _OWN_ROOT[key]


def scratch_root(spark: SparkSession) -> str:
    return f"{checkpoint_root(spark)}/tidemark-scratch"


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder for a staged table below the shared checkpoint folder."""
    return f"{scratch_root(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def filesystem(spark: SparkSession, path: str):
    """The Hadoop file system of a path and the path as it wants it."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def remove(spark: SparkSession, paths: Iterable[str]) -> None:
    for path in paths:
        fs, p = filesystem(spark, path)
        fs.delete(p, True)


def size_on_disk(spark: SparkSession, path: str) -> tuple[int, int]:
    """(bytes, files) below a folder."""
    fs, p = filesystem(spark, path)
    found = fs.getContentSummary(p)
    return int(found.getLength()), int(found.getFileCount())
