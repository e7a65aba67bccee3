"""Spark derivations of the fixture inputs from the driver tables.

Every frame is built with one scan of its source table: the parts of a change stream are
generated with ``explode`` over an array of conditional structs (a narrow ``Generate``), not
by unioning one scan per part.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    DoubleType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

from tidemark.spec import SNAPSHOT_FLOOR_US

# Fixed values of the fixture derivation.
BASE_US = 1767312000000000  # 2026-01-02 00:00:00 UTC: change timestamps start here
SALT = "salt"
RUN_TIME = "2026-01-02 00:00:00"  # run clock for map jobs (UTC)

IMAGE = StructType(
    [
        StructField("PK_CASH_TRANSACTION", LongType()),
        StructField("C_ACCOUNT_CODE", StringType()),
        StructField("C_CUSTOMER_CODE", StringType()),
        StructField("C_AMOUNT", DoubleType()),
        StructField("C_STATUS", StringType()),
        StructField("C_TRANSACTION_DATE", TimestampType()),
    ]
)

# (part, op, modulus, delta micros or None for fixed ts, fixed ts, image change)
PARTS = {
    "a": ("R", 2, 0, None),
    "b": ("I", 2, 1, 0),
    "c": ("U", 5, 0, 1000),
    "d": ("U", 10, 0, 2000),
    "e": ("D", 7, 0, 3000),
    "f": ("I", 35, 0, 4000),
    "g": ("U", 22, 0, None),
    "h": ("I", 997, 0, 5000),
    "i": ("I", 991, 0, 6000),
    "z": ("U", 100, 0, 9000),
}
BATCH_ONE = "abcdefhi"
BATCH_TWO = "gz"
ONE_BATCH = "abcdefghi"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def customer_code(custkey: Column) -> Column:
    return F.concat(F.lit("C"), F.lpad(custkey.cast("string"), 6, "0"))


def _image(o_key: Column, cust: Column, amount: Column, status: Column, date: Column) -> Column:
    return F.struct(
        o_key.cast("bigint").alias("PK_CASH_TRANSACTION"),
        F.concat(cust, F.lit("-1")).alias("C_ACCOUNT_CODE"),
        cust.alias("C_CUSTOMER_CODE"),
        amount.cast("double").alias("C_AMOUNT"),
        status.cast("string").alias("C_STATUS"),
        date.cast("timestamp").alias("C_TRANSACTION_DATE"),
    )


def _part(name: str) -> Column:
    k = F.col("o_orderkey")
    cust = customer_code(F.col("o_custkey"))
    amount, status, date = F.col("o_totalprice"), F.col("o_orderstatus"), F.col("o_orderdate")
    src = _image(k, cust, amount, status, date)
    none = F.lit(None).cast(IMAGE)
    op, mod, rem, delta = PARTS[name]
    ts = F.lit(BASE_US).cast("bigint") + k * F.lit(1000000) + F.lit(delta if delta is not None else 0)
    before, after = none, src
    if name == "a":
        ts = F.lit(SNAPSHOT_FLOOR_US).cast("bigint")
    elif name == "c":
        before, after = src, _image(k, cust, amount + F.lit(100), status, date)
    elif name == "d":
        before, after = src, _image(k, cust, amount, F.lit("X"), date)
    elif name == "e":
        before, after = src, none
    elif name == "f":
        after = _image(k, cust, amount, F.lit("N"), date)
    elif name == "g":
        ts = F.lit(SNAPSHOT_FLOOR_US - 1).cast("bigint")
        before, after = src, _image(k, cust, amount, F.lit("L"), date)
    elif name == "h":
        after = _image(F.lit(None).cast("bigint"), cust, amount, status, date)
    elif name == "i":
        after = _image(k + F.lit(1000000), cust, amount, status, F.lit(None))
    elif name == "z":
        before, after = src, _image(k, cust, amount, F.lit("Z"), date)
    row = F.struct(
        F.lit(op).alias("op_type"),
        ts.alias("op_ts"),
        ts.alias("current_ts"),
        before.alias("before"),
        after.alias("after"),
    )
    return F.when(k % mod == rem, row)


def change_envelope(spark: SparkSession, sf_dir: str, parts: str = ONE_BATCH) -> DataFrame:
    """Envelope rows (op_type, op_ts, current_ts, before, after) derived from ``orders``."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderstatus", "o_orderdate")
    return (
        orders.select(F.explode(F.array(*[_part(p) for p in parts])).alias("e"))
        .filter(F.col("e").isNotNull())
        .select("e.*")
    )


def snapshot_files_frame(spark: SparkSession, sf_dir: str, envelope_times: bool = False) -> DataFrame:
    """Part a as a snapshot file holds it: ordering columns as timestamps, not micros.

    ``current_ts`` is a TIMESTAMP and ``op_ts`` a TIMESTAMP_NTZ, in a different column order than in
    change files. By default both hold the order date (an extraction time the floor must replace);
    with ``envelope_times`` they hold the envelope's own values, so reading them back gives part a.
    """
    env = change_envelope(spark, sf_dir, "a")
    if envelope_times:
        cur, op = F.timestamp_micros(F.col("current_ts")), F.timestamp_micros(F.col("op_ts"))
    else:
        cur = op = F.col("after").getField("C_TRANSACTION_DATE")
    return env.select(
        "after",
        "before",
        cur.cast("timestamp").alias("current_ts"),
        op.cast("timestamp_ntz").alias("op_ts"),
        "op_type",
    )


def customer_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer").select("c_custkey")
    return c.select(
        customer_code(F.col("c_custkey")).alias("C_CUSTOMER_CODE"),
        F.lit("I").alias("op_type"),
        (F.lit(BASE_US).cast("bigint") + F.col("c_custkey")).alias("current_ts"),
        F.col("c_custkey"),
    )


def customer_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Relational customer map stand-in: codes with ``c_custkey % 3 <> 0`` are known."""
    from tidemark.functions.surrogate import surrogate

    cs = customer_source(spark, sf_dir).filter(F.col("c_custkey") % 3 != 0)
    return cs.select("C_CUSTOMER_CODE", surrogate("C_CUSTOMER_CODE", SALT).alias("C_CUSTOMER_CODE_MAP"))


def account_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer").select("c_custkey")
    k = F.col("c_custkey")
    code = customer_code(k)
    ts = F.lit(BASE_US).cast("bigint") + k

    def row(cust: Column, acct: Column) -> Column:
        return F.struct(cust.alias("C_CUSTOMER_CODE"), acct.cast("string").alias("C_ACCOUNT_CODE"))

    parts = F.array(
        row(code, F.concat(code, F.lit("-1"))),
        F.when(k % 4 == 0, row(code, F.concat(code, F.lit("-2")))),
        F.when(k % 50 == 0, row(code, F.concat(code, F.lit("-A1")))),
        F.when(k % 300 == 0, row(F.concat(F.lit("Z"), code), F.concat(F.lit("Z"), code, F.lit("-9")))),
        F.when(k % 500 == 0, row(code, F.lit(None))),
    )
    return (
        c.select(k, ts.alias("current_ts"), F.explode(parts).alias("r"))
        .filter(F.col("r").isNotNull())
        .select("r.C_CUSTOMER_CODE", "r.C_ACCOUNT_CODE", F.lit("I").alias("op_type"), "current_ts", "c_custkey")
    )


def complete_customer_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customer map with value ``'M' || code`` for every customer."""
    cs = customer_source(spark, sf_dir)
    return cs.select("C_CUSTOMER_CODE", F.concat(F.lit("M"), F.col("C_CUSTOMER_CODE")).alias("C_CUSTOMER_CODE_MAP"))


def front_user_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per user of ``events`` (latest event time as ordering value)."""
    ev = table(spark, sf_dir, "events").select("user_id", "ts")
    return ev.groupBy("user_id").agg(F.max("ts").alias("ts")).select(
        F.concat(F.lit("U"), F.lpad(F.col("user_id").cast("string"), 6, "0")).alias("C_FRONT_USER_CODE"),
        F.lit("I").alias("op_type"),
        F.unix_micros(F.col("ts").cast("timestamp")).alias("current_ts"),
        F.col("user_id"),
    )


def file_listing(spark: SparkSession, sf_dir: str, per_table: bool = False) -> DataFrame:
    """One file per (day, hour) of ``events`` (per event type when ``per_table``).

    Schema: ``path, file_name, day, mtime, length`` (+ ``table_name``). The first hour of a day is
    a snapshot file (``INIT.``), the others change files (``BACK.``).
    """
    ev = table(spark, sf_dir, "events").select("ts", "event_type")
    hour = F.date_trunc("hour", F.col("ts").cast("timestamp"))
    groups = [hour.alias("h")] + ([F.upper("event_type").alias("table_name")] if per_table else [])
    g = ev.groupBy(*groups).agg(F.max(F.col("ts").cast("timestamp")).alias("mtime"), F.count(F.lit(1)).alias("length"))
    hh = F.hour("h")
    name = F.concat(F.when(hh == 0, F.lit("INIT.")).otherwise(F.lit("BACK.")), F.lpad(hh.cast("string"), 2, "0"), F.lit(".avro"))
    table_dir = F.col("table_name") if per_table else F.lit("T")
    day = F.to_date("h")
    cols = [
        F.concat(F.lit("BACK."), table_dir, F.lit("/"), F.date_format(day, "yyyy-MM-dd"), F.lit("/"), name).alias("path"),
        name.alias("file_name"),
        day.alias("day"),
        F.col("mtime"),
        F.col("length").cast("bigint").alias("length"),
    ]
    if per_table:
        cols.insert(0, F.col("table_name"))
    return g.select(*cols)
