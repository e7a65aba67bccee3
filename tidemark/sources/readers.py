"""Readers: change files, snapshot files, the envelope of one batch, stored tables, lookups.

The file format is a parameter (``parquet`` here; ``avro``, ``delta``, ... when their packages
are installed). Snapshot files carry ``op_ts``/``current_ts`` as timestamps; they are turned into
epoch micros so both inputs share one schema.
"""

from __future__ import annotations

from typing import Optional, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType, TimestampNTZType, TimestampType

from tidemark.operators.envelope import align_union
from tidemark.session import filesystem
from tidemark.sinks import catalog as C

ORDERING_COLS = ("op_ts", "current_ts")


def _reader(spark: SparkSession, fmt: str, schema: Optional[StructType] = None, options: Optional[dict] = None):
    r = spark.read.format(fmt)
    if schema is not None:
        r = r.schema(schema)
    elif fmt == "parquet":
        # Files may have landed before and after a column was added: take the columns of all of them.
        r = r.option("mergeSchema", "true")
    if options:
        r = r.options(**options)
    return r


def read_changes(spark: SparkSession, paths: Sequence[str], fmt: str = "parquet", schema=None, options=None) -> DataFrame:
    return _reader(spark, fmt, schema, options).load(list(paths))


def snapshot_to_micros(df: DataFrame) -> DataFrame:
    """``op_ts``/``current_ts`` given as TIMESTAMP or TIMESTAMP_NTZ -> epoch micros (BIGINT)."""
    types = {f.name: f.dataType for f in df.schema.fields}
    out = []
    for c in df.columns:
        if c in ORDERING_COLS and isinstance(types[c], (TimestampType, TimestampNTZType)):
            out.append(F.unix_micros(F.col(c).cast("timestamp")).alias(c))
        else:
            out.append(F.col(f"`{c}`"))
    return df.select(*out)


def read_snapshots(spark: SparkSession, paths: Sequence[str], fmt: str = "parquet", schema=None, options=None) -> DataFrame:
    return snapshot_to_micros(_reader(spark, fmt, schema, options).load(list(paths)))


def read_envelope(
    spark: SparkSession,
    snapshot_paths: Sequence[str],
    change_paths: Sequence[str],
    fmt: str = "parquet",
    strict: bool = True,
    options: Optional[dict] = None,
) -> Optional[DataFrame]:
    """Snapshot rows and change rows of one batch as one frame (union by name).

    ``strict=False`` fills a column that only one side has with null. Returns None when there is
    no file at all.
    """
    frames = []
    if snapshot_paths:
        frames.append(read_snapshots(spark, snapshot_paths, fmt, options=options))
    if change_paths:
        frames.append(read_changes(spark, change_paths, fmt, options=options))
    if not frames:
        return None
    return align_union(frames, strict=strict)


def is_name(location: str) -> bool:
    """Whether a location is the name of a stored table rather than a path."""
    return "/" not in location and ":" not in location


def read_table(spark: SparkSession, location: str, fmt: str = "parquet") -> DataFrame:
    """A stored table by its catalog name, or a plain folder of files with the columns of all of them."""
    return C.rows(spark, location) if is_name(location) else _reader(spark, fmt).load(location)


def path_exists(spark: SparkSession, path: str) -> bool:
    """Existence check through the Hadoop FileSystem of the path (works for any store Spark reads)."""
    fs, p = filesystem(spark, path)
    return fs.exists(p)


def table_if_exists(spark: SparkSession, location: str, fmt: str = "parquet") -> Optional[DataFrame]:
    """The stored table, or None when it does not exist or has no rows.

    Only "not found" means "does not exist"; any other read error is raised, so a broken read can
    never be mistaken for an empty target (which would trigger a rebuild).
    """
    if not (C.exists(spark, location) if is_name(location) else path_exists(spark, location)):
        return None
    df = read_table(spark, location, fmt)
    return None if df.isEmpty() else df


def read_lookup(
    spark: SparkSession,
    columns: Sequence[str],
    table: Optional[str] = None,
    url: Optional[str] = None,
    properties: Optional[dict] = None,
    path: Optional[str] = None,
    fmt: str = "parquet",
    partition_column: Optional[str] = None,
    bounds: Optional[tuple[int, int]] = None,
    num_partitions: Optional[int] = None,
) -> DataFrame:
    """Projected lookup table: over JDBC (``url`` + ``table``) or from a stored table (``path``).

    JDBC reads are split by ``partition_column`` between ``bounds`` when given; the projection is
    pushed into the database by column pruning.
    """
    if url is not None:
        if table is None:
            raise ValueError("a JDBC lookup needs a table")
        kwargs = {}
        if partition_column and bounds and num_partitions:
            kwargs = dict(column=partition_column, lowerBound=bounds[0], upperBound=bounds[1], numPartitions=num_partitions)
        df = spark.read.jdbc(url, table, properties=properties or {}, **kwargs)
    elif path is not None:
        df = read_table(spark, path, fmt)
    elif table is not None:
        df = spark.table(table)
    else:
        raise ValueError("read_lookup needs url+table, path or table")
    return df.select(*columns)
