"""Stored tables as catalog tables: the catalog holds schema, partitions and the folder of each.

Rows are written to folders that nobody reads yet; then the catalog is told where the table's partitions
(or the whole table, if it has none) lie now. A reader sees each partition as it was before or as it is
after a write. The folders of a table lie below ``<database location>/<table>``.

``merges`` is a table property that counts writes. A writer reads it before it reads rows and gives it
back when it switches folders; if another writer has come in between, it is refused.

Text in the partition column is kept as it is, but for the empty text, which a catalog cannot tell from
null: it is stored as ``EMPTY``, and a text that begins so gets it once more. ``rows`` undoes that.
"""

from __future__ import annotations

import hashlib
import re
import uuid
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from typing import Any, Iterable, Optional

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

from tidemark.session import filesystem, remove, scratch_root

DIR = "_p"
EMPTY = "__empty__"
MERGES = "tidemark.merges"
SCRATCH_DATABASE = "tidemark_scratch"
#: Partitions named in one statement, and statements sent at a time.
_AT_ONCE, _THREADS = 500, 16


class ConcurrentWrite(RuntimeError):
    """Another writer changed the table since this one read it."""


@dataclass
class Written:
    """A new folder: rows in it, and the value of each partition by the name of its folder."""

    folder: str
    rows: int = 0
    values: dict[str, Any] = field(default_factory=dict)


def scratch_table(spark: SparkSession, name: str) -> str:
    """A name for a table that lies in the shared scratch folder."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {SCRATCH_DATABASE} LOCATION '{scratch_root(spark)}/{SCRATCH_DATABASE}'")
    return f"{SCRATCH_DATABASE}.{''.join(c if c.isalnum() else '_' for c in name)}_{uuid.uuid4().hex[:12]}"


def exists(spark: SparkSession, table: str) -> bool:
    return spark.catalog.tableExists(table)


def home(spark: SparkSession, table: str) -> str:
    """The folder below which a table's folders lie."""
    *database, name = table.split(".")
    where = spark.catalog.getDatabase(database[-1] if database else spark.catalog.currentDatabase()).locationUri
    return f"{where.rstrip('/')}/{name}"


def partition_column(spark: SparkSession, table: str) -> Optional[str]:
    return next((c.name for c in spark.catalog.listColumns(table) if c.isPartition), None)


def merges(spark: SparkSession, table: str) -> int:
    """How often the table has been written; -1 where there is none."""
    if not exists(spark, table):
        return -1
    found = [r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {table}").collect() if r["key"] == MERGES]
    return int(found[0]) if found else 0


def rows(spark: SparkSession, table: str) -> DataFrame:
    """The table's rows, with the partition column's texts as they were given."""
    df, part = spark.table(table), partition_column(spark, table)
    if part is None or not isinstance(df.schema[part].dataType, StringType):
        return df
    c = F.col(f"`{part}`")
    given = F.when(c.startswith(EMPTY), F.substring(c, len(EMPTY) + 1, 1 << 30)).otherwise(c)
    return df.withColumns({part: given})


_PLAIN = "^[0-9A-Za-z-]{1,40}$"


def _folder_name(c: Column) -> Column:
    """A folder name for any partition value, of bounded length."""
    text = c.cast("string")
    return F.when(c.isNull(), F.lit("null")).when(text.rlike(_PLAIN) & (text != "null"), text).otherwise(F.concat(F.lit("x_"), F.sha1(text)))


def _name_of(value: Any) -> str:
    """What ``_folder_name`` gives for a collected value."""
    if value is None:
        return "null"
    text = _text(value)
    return text if re.match(_PLAIN, text) and text != "null" and "\n" not in text else f"x_{hashlib.sha1(text.encode()).hexdigest()}"


def _text(value: Any) -> str:
    return str(value).lower() if isinstance(value, bool) else str(value)


def write_folder(df: DataFrame, root: str, partition: Optional[str] = None, values: Iterable[Any] = (), options: Optional[dict] = None) -> Written:
    """Write rows to a new folder below ``root``, with a folder in it for each of the partition ``values``."""
    spark, new = df.sparkSession, Written(f"{root}/w-{uuid.uuid4().hex}")
    if partition is None:
        df.write.options(**(options or {})).parquet(new.folder)
        new.rows = spark.read.schema(df.schema).parquet(new.folder).count()
        return new
    counted = Observation()
    named = df.withColumn(DIR, _folder_name(F.col(f"`{partition}`"))).drop(partition).observe(counted, F.count(F.lit(1)).alias("rows"))
    # Nobody reads the folder yet, so tasks may move their files in at once.
    writer = named.write.options(**(options or {})).option("mapreduce.fileoutputcommitter.algorithm.version", "2")
    writer.partitionBy(DIR).parquet(new.folder)
    fs, folder = filesystem(spark, new.folder)
    there = {s.getPath().getName() for s in fs.listStatus(folder) if s.isDirectory()}
    new.values = {n: v for v in values if f"{DIR}={(n := _name_of(v))}" in there}
    if len(new.values) != sum(n.startswith(f"{DIR}=") for n in there):
        raise ValueError(f"{new.folder}: rows for partitions that were not announced")
    new.rows = counted.get["rows"] if new.values else 0
    return new


def _literal(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _clause(partition: str, value: Any) -> str:
    if value is None:
        return f"PARTITION (`{partition}`=NULL)"
    text = _text(value)
    return f"PARTITION (`{partition}`={_literal(EMPTY + text if isinstance(value, str) and (not text or text.startswith(EMPTY)) else text)})"


def create(spark: SparkSession, table: str, schema: StructType, partition: Optional[str], location: str) -> None:
    """Make an empty table; fails if another writer has made it."""
    columns = [f for f in schema.fields if f.name != partition] + [f for f in schema.fields if f.name == partition]
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in columns)
    by = f"PARTITIONED BY (`{partition}`) " if partition else ""
    spark.sql(f"CREATE TABLE {table} ({ddl}) USING parquet {by}LOCATION '{location}' TBLPROPERTIES ('{MERGES}'='0')")


def widen(spark: SparkSession, table: str, schema: StructType) -> None:
    """Add the columns, and the fields inside columns, that ``schema`` has and the table lacks."""
    have = {f.name: f.dataType for f in spark.table(table).schema.fields}
    new = [f for f in schema.fields if f.name not in have]
    if new:
        spark.sql(f"ALTER TABLE {table} ADD COLUMNS ({', '.join(f'`{f.name}` {f.dataType.simpleString()}' for f in new)})")
    wider = {f.name: f.dataType for f in schema.fields if f.name in have and f.dataType.simpleString() != have[f.name].simpleString()}
    if wider:  # no SQL statement adds a field to a struct of a parquet table
        part = partition_column(spark, table)
        now = [f for f in spark.table(table).schema.fields if f.name != part]
        fields = spark.createDataFrame([], StructType([type(f)(f.name, wider.get(f.name, f.dataType), True) for f in now]))
        state = spark._jsparkSession.sessionState()
        state.catalog().alterTableDataSchema(state.sqlParser().parseTableIdentifier(table), fields._jdf.schema())
        spark.catalog.refreshTable(table)


def _count_merge(spark: SparkSession, table: str, started: int) -> None:
    now = merges(spark, table)
    if now != started:
        raise ConcurrentWrite(f"{table}: written {now} times, but this writer began at {started}")
    spark.sql(f"ALTER TABLE {table} SET TBLPROPERTIES ('{MERGES}'='{started + 1}')")


def switch(spark: SparkSession, table: str, partition: Optional[str], new: Written, started: int, old: Iterable[tuple[Any, str]]) -> None:
    """Let the table's partitions, or the whole table, lie in a new folder.

    ``old``: (partition value, folder) of what the new rows replace. Partitions without new rows go, and
    the replaced folders are removed."""
    _count_merge(spark, table, started)
    old = list(old)
    if partition is None:
        spark.sql(f"ALTER TABLE {table} SET LOCATION '{new.folder}'")
    else:
        before = {value for value, _ in old}
        at = {value: f"{new.folder}/{DIR}={name}" for name, value in new.values.items()}
        with ThreadPoolExecutor(_THREADS) as pool:
            list(pool.map(lambda v: spark.sql(f"ALTER TABLE {table} {_clause(partition, v)} SET LOCATION '{at[v]}'"), [v for v in at if v in before]))
        _each(spark, f"ALTER TABLE {table} ADD IF NOT EXISTS ", " ", [f"{_clause(partition, v)} LOCATION '{at[v]}'" for v in at if v not in before])
        _each(spark, f"ALTER TABLE {table} DROP IF EXISTS ", ", ", [_clause(partition, v) for v in before if v not in at])
    clear(spark, [folder for _, folder in old])


def _each(spark: SparkSession, start: str, between: str, clauses: list[str]) -> None:
    for k in range(0, len(clauses), _AT_ONCE):
        spark.sql(start + between.join(clauses[k : k + _AT_ONCE]))


def clear(spark: SparkSession, folders: Iterable[str]) -> None:
    """Remove folders; the folder of a write goes as a whole once nothing else is left in it."""
    by_write: dict[str, list[str]] = {}
    for f in set(folders):
        by_write.setdefault(f.rsplit("/", 1)[0] if f"/{DIR}=" in f else f, []).append(f)
    gone: list[str] = []
    for write, mine in by_write.items():
        fs, p = filesystem(spark, write)
        whole = fs.exists(p) and fs.getContentSummary(p).getDirectoryCount() - 1 <= len(mine)
        gone += [write] if whole else mine
    with ThreadPoolExecutor(_THREADS) as pool:
        list(pool.map(lambda f: remove(spark, [f]), gone))


def folders(df: DataFrame, partition: Optional[str]) -> tuple[list[tuple[Any, str]], int]:
    """(partition value, folder) of the files that a read of a stored table meets, and the files' bytes;
    reads no column of them."""
    value = F.col(f"`{partition}`") if partition else F.lit(None).cast("string")
    folder = F.regexp_replace(F.col("_metadata.file_path"), "/[^/]*$", "")
    files = df.select(value.alias("value"), folder.alias("folder"), F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_size").alias("size")).distinct()
    found = files.groupBy("value", "folder").agg(F.sum("size").alias("size")).collect()
    return [(r["value"], r["folder"]) for r in found], sum(r["size"] for r in found)


def remove_unused(spark: SparkSession, table: str) -> int:
    """Remove folders that runs left behind which died before their switch; the number removed. No
    other writer may be at work."""
    part = partition_column(spark, table)
    used = {f for _, f in folders(rows(spark, table), part)[0]} if part else {location(spark, table)}
    path_of = lambda f: f.split(":", 1)[-1].lstrip("/")  # noqa: E731 - schemes are spelled in several ways
    used = {path_of(f) for f in used}
    fs, root = filesystem(spark, home(spark, table))
    gone = []
    for s in fs.listStatus(root) if fs.exists(root) else []:
        name = path_of(s.getPath().toString())
        if s.isDirectory() and "/w-" in name and not any(u == name or u.startswith(name + "/") for u in used):
            gone.append(s.getPath().toString())
    remove(spark, gone)
    return len(gone)


def location(spark: SparkSession, table: str) -> str:
    return next(r["data_type"] for r in spark.sql(f"DESCRIBE TABLE EXTENDED {table}").collect() if r["col_name"] == "Location")
