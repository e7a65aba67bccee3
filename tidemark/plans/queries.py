"""Registered queries: each runs an engine operator over fixture data derived from the given tables,
paired with an independent DuckDB formulation of the same result.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, TimestampNTZType, TimestampType

from tidemark.fixtures import frames as FX
from tidemark.fixtures import sql as S
from tidemark.operators.changes import prepare_changes
from tidemark.operators.envelope import flatten, split_ops
from tidemark.operators.merge import apply_changes, latest_per_key
from tidemark.session import apply_engine_conf
from tidemark.spec import EVENT_ORDER, UPSERT_THEN_DELETE
from tidemark.tables import CASH_TRANSACTIONS

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, oracle: str | None):
    def deco(fn):
        QUERIES[name] = fn
        if oracle is not None:
            ORACLE[name] = oracle
        return fn

    return deco


def comparable(df: DataFrame) -> DataFrame:
    """Timestamps -> epoch micros, dates -> text, so both engines hash the same values."""
    out = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (TimestampType, TimestampNTZType)):
            c = F.unix_micros(c.cast("timestamp"))
        elif isinstance(f.dataType, DateType):
            c = c.cast("string")
        out.append(c.alias(f.name))
    return df.select(*out)


CASH_COLS = [
    "PK_CASH_TRANSACTION",
    "C_ACCOUNT_CODE",
    "C_CUSTOMER_CODE",
    "C_AMOUNT",
    "C_STATUS",
    "C_TRANSACTION_DATE",
    "C_TRANSACTION_DATE_PARTITION",
    "op_type",
    "op_ts",
    "current_ts",
]


def _changes(spark: SparkSession, sf_dir: str, parts: str = FX.ONE_BATCH) -> DataFrame:
    apply_engine_conf(spark)
    return prepare_changes(FX.change_envelope(spark, sf_dir, parts), CASH_TRANSACTIONS)


# ---------------------------------------------------------------- envelope


@query(
    "cdc_op_counts",
    S.with_ctes(S.IMG_CTE, S.envelope_cte())
    + "SELECT op_type, count(*) AS n_rows FROM E WHERE op_type IN ('I','U','D','R') GROUP BY op_type",
)
def cdc_op_counts(spark, sf_dir):
    apply_engine_conf(spark)
    env = split_ops(FX.change_envelope(spark, sf_dir))
    return env.groupBy("op_type").agg(F.count(F.lit(1)).alias("n_rows"))


@query(
    "cdc_flatten",
    S.with_ctes(S.IMG_CTE, S.envelope_cte(), S.flat_cte())
    + "SELECT C_ACCOUNT_CODE, C_AMOUNT, C_CUSTOMER_CODE, C_STATUS, epoch_us(C_TRANSACTION_DATE) AS C_TRANSACTION_DATE, "
    "PK_CASH_TRANSACTION, op_type, op_ts, current_ts FROM FL",
)
def cdc_flatten(spark, sf_dir):
    apply_engine_conf(spark)
    return comparable(flatten(split_ops(FX.change_envelope(spark, sf_dir))))


# ---------------------------------------------------------------- latest and merge


@query(
    "latest_per_key",
    S.cash_ctes() + ", " + S.latest_cte() + f" SELECT {S.CASH_OUT} FROM L",
)
def latest_per_key_q(spark, sf_dir):
    ch = _changes(spark, sf_dir)
    return comparable(latest_per_key(ch, CASH_TRANSACTIONS.keys, CASH_TRANSACTIONS.ordering).select(*CASH_COLS))


@query(
    "merge_event_order",
    S.cash_ctes() + ", " + S.latest_cte() + f" SELECT {S.CASH_OUT} FROM L WHERE op_type <> 'D'",
)
def merge_event_order(spark, sf_dir):
    ch = _changes(spark, sf_dir)
    return comparable(apply_changes(None, ch, CASH_TRANSACTIONS.keys, merge_mode=EVENT_ORDER).select(*CASH_COLS))


@query(
    "merge_upsert_then_delete",
    S.cash_ctes() + ", " + S.latest_cte(deletes_win=True) + f" SELECT {S.CASH_OUT} FROM L WHERE op_type <> 'D'",
)
def merge_upsert_then_delete(spark, sf_dir):
    ch = _changes(spark, sf_dir)
    return comparable(apply_changes(None, ch, CASH_TRANSACTIONS.keys, merge_mode=UPSERT_THEN_DELETE).select(*CASH_COLS))


# ---------------------------------------------------------------- snapshot files and unions

from tidemark.operators.envelope import align_union, floor_snapshot, upserts  # noqa: E402
from tidemark.operators.normalize import clamp_times, require, shift_times, with_day  # noqa: E402
from tidemark.sources.readers import snapshot_to_micros  # noqa: E402

FLAT_OUT = (
    "C_ACCOUNT_CODE, C_AMOUNT, C_CUSTOMER_CODE, C_STATUS, epoch_us(C_TRANSACTION_DATE) AS C_TRANSACTION_DATE, "
    "PK_CASH_TRANSACTION, op_type, op_ts, current_ts"
)


@query(
    "snapshot_ts_micros",
    S.with_ctes(S.IMG_CTE, S.envelope_cte("a"))
    + "SELECT after.PK_CASH_TRANSACTION AS PK_CASH_TRANSACTION, epoch_us(after.C_TRANSACTION_DATE) AS op_ts, "
    "epoch_us(after.C_TRANSACTION_DATE) AS current_ts FROM E",
)
def snapshot_ts_micros(spark, sf_dir):
    apply_engine_conf(spark)
    snap = snapshot_to_micros(FX.snapshot_files_frame(spark, sf_dir))
    return snap.select(F.col("after.PK_CASH_TRANSACTION").alias("PK_CASH_TRANSACTION"), "op_ts", "current_ts")


@query(
    "snapshot_cdc_union",
    S.with_ctes(S.IMG_CTE, S.envelope_cte("bcdefghi"), S.envelope_cte("a", "EA"),
                "EU AS (SELECT op_type, epoch_us(after.C_TRANSACTION_DATE) AS op_ts, epoch_us(after.C_TRANSACTION_DATE) AS current_ts, "
                "before, after FROM EA UNION ALL BY NAME SELECT * FROM E)", S.flat_cte("EU"))
    + f"SELECT {FLAT_OUT} FROM FL",
)
def snapshot_cdc_union(spark, sf_dir):
    apply_engine_conf(spark)
    snap = snapshot_to_micros(FX.snapshot_files_frame(spark, sf_dir))
    cdc = FX.change_envelope(spark, sf_dir, "bcdefghi")
    return comparable(flatten(split_ops(align_union([snap, cdc]))))


@query("upsert_union", S.with_ctes(S.IMG_CTE, S.envelope_cte(), S.flat_cte()) + f"SELECT {FLAT_OUT} FROM FL WHERE op_type IN ('I','U','R')")
def upsert_union(spark, sf_dir):
    apply_engine_conf(spark)
    return comparable(upserts(flatten(split_ops(FX.change_envelope(spark, sf_dir)))))


@query(
    "snapshot_floor",
    S.with_ctes(S.IMG_CTE, S.envelope_cte("a"))
    + f"SELECT after.PK_CASH_TRANSACTION AS PK_CASH_TRANSACTION, op_type, epoch_us(after.C_TRANSACTION_DATE) AS op_ts, "
    f"CAST({S.F} AS BIGINT) AS current_ts FROM E",
)
def snapshot_floor(spark, sf_dir):
    apply_engine_conf(spark)
    snap = flatten(snapshot_to_micros(FX.snapshot_files_frame(spark, sf_dir)))
    return floor_snapshot(snap, CASH_TRANSACTIONS.snapshot_floor_us).select("PK_CASH_TRANSACTION", "op_type", "op_ts", "current_ts")


# ---------------------------------------------------------------- normalisation

TIME_CTE = (
    "T AS (SELECT PK_CASH_TRANSACTION, op_type, C_TRANSACTION_DATE AS ts, CAST(C_TRANSACTION_DATE AS DATE) AS d, "
    "C_TRANSACTION_DATE AS n FROM FL)"
)


def _time_frame(spark, sf_dir):
    fl = flatten(split_ops(FX.change_envelope(spark, sf_dir)))
    return fl.select(
        "PK_CASH_TRANSACTION",
        "op_type",
        F.col("C_TRANSACTION_DATE").alias("ts"),
        F.to_date("C_TRANSACTION_DATE").alias("d"),
        F.col("C_TRANSACTION_DATE").cast("timestamp_ntz").alias("n"),
    )


@query(
    "time_shift",
    S.with_ctes(S.IMG_CTE, S.envelope_cte(), S.flat_cte(), TIME_CTE)
    + "SELECT PK_CASH_TRANSACTION, op_type, epoch_us(ts + INTERVAL 7 HOUR) AS ts, "
    "epoch_us(CAST(d AS TIMESTAMP) + INTERVAL 7 HOUR) AS d, epoch_us(n + INTERVAL 7 HOUR) AS n FROM T",
)
def time_shift(spark, sf_dir):
    apply_engine_conf(spark)
    return comparable(shift_times(_time_frame(spark, sf_dir), 7))


CLAMP_LOW_TEST = "1995-01-01 00:00:00"


@query(
    "time_clamp",
    S.with_ctes(S.IMG_CTE, S.envelope_cte(), S.flat_cte(), TIME_CTE)
    + f"SELECT PK_CASH_TRANSACTION, op_type, "
    f"epoch_us(CASE WHEN ts + INTERVAL 7 HOUR < TIMESTAMP '{CLAMP_LOW_TEST}' THEN TIMESTAMP '{CLAMP_LOW_TEST}' ELSE ts + INTERVAL 7 HOUR END) AS ts, "
    f"epoch_us(CASE WHEN CAST(d AS TIMESTAMP) + INTERVAL 7 HOUR < TIMESTAMP '{CLAMP_LOW_TEST}' THEN TIMESTAMP '{CLAMP_LOW_TEST}' "
    f"ELSE CAST(d AS TIMESTAMP) + INTERVAL 7 HOUR END) AS d, epoch_us(n + INTERVAL 7 HOUR) AS n FROM T",
)
def time_clamp(spark, sf_dir):
    apply_engine_conf(spark)
    return comparable(clamp_times(shift_times(_time_frame(spark, sf_dir), 7), CLAMP_LOW_TEST, include_ntz=False))


@query("required_not_null", S.cash_ctes() + "SELECT PK_CASH_TRANSACTION, op_type, current_ts FROM N")
def required_not_null(spark, sf_dir):
    return _changes(spark, sf_dir).select("PK_CASH_TRANSACTION", "op_type", "current_ts")


@query(
    "local_day_partition",
    "SELECT CAST(CAST(ts + INTERVAL 7 HOUR AS DATE) AS VARCHAR) AS day, count(*) AS n_rows FROM events GROUP BY 1",
)
def local_day_partition(spark, sf_dir):
    apply_engine_conf(spark)
    ev = FX.table(spark, sf_dir, "events").select("event_id", "ts")
    shifted = with_day(shift_times(ev, 7), "ts", "day")
    return shifted.groupBy("day").agg(F.count(F.lit(1)).alias("n_rows")).select(F.col("day").cast("string").alias("day"), "n_rows")


# ---------------------------------------------------------------- two-batch merges (T4, T5, K3, K7)

from tidemark.spec import ARRIVAL, EVENT_TIME  # noqa: E402
from tidemark.operators.merge import live_rows  # noqa: E402


def _two_batches(spark, sf_dir, late_policy, tombstones=False):
    b1 = _changes(spark, sf_dir, FX.BATCH_ONE)
    b2 = _changes(spark, sf_dir, FX.BATCH_TWO)
    keys = CASH_TRANSACTIONS.keys
    stored = apply_changes(None, b1, keys, keep_tombstones=tombstones)
    merged = apply_changes(stored, b2, keys, late_policy=late_policy, keep_tombstones=tombstones)
    return comparable(live_rows(merged).select(*CASH_COLS))


@query("merge_late_event_time", S.two_batch_merge(FX.BATCH_ONE, FX.BATCH_TWO))
def merge_late_event_time(spark, sf_dir):
    return _two_batches(spark, sf_dir, EVENT_TIME)


@query(
    "merge_late_event_time_tombstones",
    S.cash_ctes(FX.BATCH_ONE + FX.BATCH_TWO) + ", " + S.latest_cte() + f" SELECT {S.CASH_OUT} FROM L WHERE op_type <> 'D'",
)
def merge_late_event_time_tombstones(spark, sf_dir):
    return _two_batches(spark, sf_dir, EVENT_TIME, tombstones=True)


@query("merge_late_arrival", S.two_batch_merge(FX.BATCH_ONE, FX.BATCH_TWO, arrival=True))
def merge_late_arrival(spark, sf_dir):
    return _two_batches(spark, sf_dir, ARRIVAL)


@query("merge_replay", ORACLE["merge_event_order"])
def merge_replay(spark, sf_dir):
    ch = _changes(spark, sf_dir)
    keys = CASH_TRANSACTIONS.keys
    once = apply_changes(None, ch, keys)
    twice = apply_changes(once, ch, keys)
    return comparable(twice.select(*CASH_COLS))


@query(
    "merge_reconcile_schema",
    S.two_batch_merge(
        FX.BATCH_ONE,
        FX.BATCH_TWO,
        out=S.CASH_OUT + ", C_BRANCH, C_CHANNEL",
        extra1=", 'B' || CAST(PK_CASH_TRANSACTION % 10 AS VARCHAR) AS C_BRANCH",
        extra2=", 'web' AS C_CHANNEL",
    ),
)
def merge_reconcile_schema(spark, sf_dir):
    b1 = _changes(spark, sf_dir, FX.BATCH_ONE).withColumn(
        "C_BRANCH", F.concat(F.lit("B"), (F.col("PK_CASH_TRANSACTION") % 10).cast("string"))
    )
    b2 = _changes(spark, sf_dir, FX.BATCH_TWO).withColumn("C_CHANNEL", F.lit("web"))
    keys = CASH_TRANSACTIONS.keys
    merged = apply_changes(apply_changes(None, b1, keys), b2, keys)
    return comparable(merged.select(*CASH_COLS, "C_BRANCH", "C_CHANNEL"))


@query(
    "full_refresh",
    S.cash_ctes(FX.BATCH_TWO) + ", " + S.latest_cte() + f" SELECT {S.CASH_OUT} FROM L WHERE op_type <> 'D'",
)
def full_refresh(spark, sf_dir):
    from tidemark.sinks.tables import merge_frames

    b1 = _changes(spark, sf_dir, FX.BATCH_ONE)
    b2 = _changes(spark, sf_dir, FX.BATCH_TWO)
    stored = apply_changes(None, b1, CASH_TRANSACTIONS.keys)
    return comparable(merge_frames(stored, b2, CASH_TRANSACTIONS, full_refresh=True).select(*CASH_COLS))


# ---------------------------------------------------------------- keys and maps

from tidemark.operators import keymaps as KM  # noqa: E402

SALT = FX.SALT
NOW = FX.RUN_TIME


@query(
    "known_keys",
    S.with_ctes(S.customer_source_cte())
    + "SELECT C_CUSTOMER_CODE, current_ts FROM CS WHERE c_custkey % 3 <> 0",
)
def known_keys(spark, sf_dir):
    apply_engine_conf(spark)
    cs = FX.customer_source(spark, sf_dir)
    return KM.known_keys(cs, FX.customer_lookup(spark, sf_dir), KM.CUSTOMER_CODE).select("C_CUSTOMER_CODE", "current_ts")


@query(
    "unknown_keys",
    S.with_ctes(S.customer_source_cte())
    + "SELECT C_CUSTOMER_CODE, current_ts FROM CS WHERE c_custkey % 3 = 0",
)
def unknown_keys(spark, sf_dir):
    apply_engine_conf(spark)
    cs = FX.customer_source(spark, sf_dir)
    return KM.unknown_keys(cs, FX.customer_lookup(spark, sf_dir), KM.CUSTOMER_CODE).select("C_CUSTOMER_CODE", "current_ts")


MAP_OUT = "C_CUSTOMER_CODE, op_type, current_ts, {s} AS C_CUSTOMER_CODE_MAP, {w} AS WH_UPDATE_TIME".format(
    s=S.surrogate_sql("C_CUSTOMER_CODE"), w=S.WH_UPDATE_US
)


@query("customer_map_init", S.with_ctes(S.customer_source_cte()) + f"SELECT {MAP_OUT} FROM CS")
def customer_map_init(spark, sf_dir):
    apply_engine_conf(spark)
    cs = FX.customer_source(spark, sf_dir)
    return comparable(KM.build_map(cs, None, KM.CUSTOMER_CODE, SALT, NOW))


@query("customer_map_increment", S.with_ctes(S.customer_source_cte()) + f"SELECT {MAP_OUT} FROM CS WHERE c_custkey % 3 = 0")
def customer_map_increment(spark, sf_dir):
    apply_engine_conf(spark)
    cs = FX.customer_source(spark, sf_dir)
    existing = KM.build_map(cs.filter(F.col("c_custkey") % 3 != 0), None, KM.CUSTOMER_CODE, SALT, NOW)
    return comparable(KM.build_map(cs, existing, KM.CUSTOMER_CODE, SALT, NOW))


@query(
    "front_user_map_increment",
    S.with_ctes(S.front_user_source_cte())
    + f"SELECT C_FRONT_USER_CODE, op_type, current_ts, {S.surrogate_sql('C_FRONT_USER_CODE')} AS C_FRONT_USER_CODE_MAP, "
    f"{S.WH_UPDATE_US} AS WH_UPDATE_TIME FROM FU WHERE user_id % 4 = 0",
)
def front_user_map_increment(spark, sf_dir):
    apply_engine_conf(spark)
    fu = FX.front_user_source(spark, sf_dir)
    existing = KM.build_map(fu.filter(F.col("user_id") % 4 != 0), None, "C_FRONT_USER_CODE", SALT, NOW)
    return comparable(KM.build_map(fu, existing, "C_FRONT_USER_CODE", SALT, NOW))


ACCOUNT_OUT = (
    "A.C_ACCOUNT_CODE, CASE WHEN M.C_CUSTOMER_CODE_MAP IS NOT NULL THEN M.C_CUSTOMER_CODE_MAP || right(A.C_ACCOUNT_CODE, 1) "
    f"ELSE {S.surrogate_sql('A.C_ACCOUNT_CODE')} END AS C_ACCOUNT_CODE_MAP, A.C_CUSTOMER_CODE, M.C_CUSTOMER_CODE_MAP, "
    f"{S.WH_UPDATE_US} AS WH_UPDATE_TIME, A.op_type, A.current_ts"
)
CMAP_CTE = "M AS (SELECT C_CUSTOMER_CODE, 'M' || C_CUSTOMER_CODE AS C_CUSTOMER_CODE_MAP FROM customer_codes)"
CODES_CTE = "customer_codes AS (SELECT 'C' || lpad(CAST(c_custkey AS VARCHAR), 6, '0') AS C_CUSTOMER_CODE FROM customer)"


def _account_map(spark, sf_dir, existing_filter=None):
    apply_engine_conf(spark)
    acs = FX.account_source(spark, sf_dir)
    cmap = FX.complete_customer_map(spark, sf_dir)
    existing = None
    if existing_filter is not None:
        existing = KM.build_account_map(acs.filter(existing_filter), cmap, None, SALT, NOW)
    return KM.build_account_map(acs, cmap, existing, SALT, NOW)


@query(
    "account_map_init",
    S.with_ctes(S.account_source_cte(), CODES_CTE, CMAP_CTE)
    + f"SELECT {ACCOUNT_OUT} FROM ACS A LEFT JOIN M ON A.C_CUSTOMER_CODE = M.C_CUSTOMER_CODE WHERE A.C_ACCOUNT_CODE IS NOT NULL",
)
def account_map_init(spark, sf_dir):
    return comparable(_account_map(spark, sf_dir))


@query(
    "account_map_increment",
    S.with_ctes(S.account_source_cte(), CODES_CTE, CMAP_CTE)
    + f"SELECT {ACCOUNT_OUT} FROM ACS A LEFT JOIN M ON A.C_CUSTOMER_CODE = M.C_CUSTOMER_CODE "
    "WHERE A.C_ACCOUNT_CODE IS NOT NULL AND A.c_custkey % 3 = 0",
)
def account_map_increment(spark, sf_dir):
    return comparable(_account_map(spark, sf_dir, F.col("c_custkey") % 3 != 0))


@query(
    "account_map_clashes",
    S.with_ctes(S.account_source_cte(), CODES_CTE, CMAP_CTE,
                f"AM AS (SELECT {ACCOUNT_OUT} FROM ACS A LEFT JOIN M ON A.C_CUSTOMER_CODE = M.C_CUSTOMER_CODE WHERE A.C_ACCOUNT_CODE IS NOT NULL)")
    + "SELECT C_ACCOUNT_CODE_MAP, count(*) AS n_keys, min(C_ACCOUNT_CODE) AS first_key, max(C_ACCOUNT_CODE) AS last_key "
    "FROM AM GROUP BY C_ACCOUNT_CODE_MAP HAVING count(*) > 1",
)
def account_map_clashes(spark, sf_dir):
    return KM.map_clashes(_account_map(spark, sf_dir), KM.ACCOUNT_MAP, KM.ACCOUNT_CODE)


@query(
    "distinct_map_keys",
    S.with_ctes(S.account_source_cte()) + "SELECT DISTINCT C_CUSTOMER_CODE FROM ACS WHERE C_ACCOUNT_CODE IS NOT NULL",
)
def distinct_map_keys(spark, sf_dir):
    apply_engine_conf(spark)
    acs = FX.account_source(spark, sf_dir).filter(F.col("C_ACCOUNT_CODE").isNotNull())
    return acs.select("C_CUSTOMER_CODE").distinct()


@query(
    "register_unknown_customers",
    S.cash_ctes() + ", " + S.customer_source_cte()
    + f" SELECT DISTINCT C_CUSTOMER_CODE, {S.surrogate_sql('C_CUSTOMER_CODE')} AS C_CUSTOMER_CODE_MAP FROM N "
    "WHERE op_type <> 'D' AND C_CUSTOMER_CODE NOT IN (SELECT C_CUSTOMER_CODE FROM CS WHERE c_custkey % 3 <> 0)",
)
def register_unknown_customers(spark, sf_dir):
    ch = upserts(_changes(spark, sf_dir))
    return KM.register_unknown(ch, FX.customer_lookup(spark, sf_dir), KM.CUSTOMER_CODE, SALT)


# ---------------------------------------------------------------- file selection

from tidemark.sources import files as FS  # noqa: E402

WINDOW = ("2024-01-10 00:00:00", "2024-01-12 12:00:00")


def _files(spark, sf_dir, per_table=False):
    apply_engine_conf(spark)
    return FX.file_listing(spark, sf_dir, per_table=per_table)


@query("file_classify", S.with_ctes(S.file_listing_cte())
       + "SELECT path, CASE WHEN file_name LIKE 'INIT.%' THEN 'snapshot' ELSE 'change' END AS kind FROM FILES "
       "WHERE file_name LIKE 'INIT.%' OR file_name LIKE 'BACK.%'")
def file_classify(spark, sf_dir):
    return FS.classify(_files(spark, sf_dir)).select("path", "kind")


@query("file_window", S.with_ctes(S.file_listing_cte())
       + f"SELECT path, epoch_us(mtime) AS mtime FROM FILES WHERE mtime BETWEEN TIMESTAMP '{WINDOW[0]}' AND TIMESTAMP '{WINDOW[1]}' "
       f"AND day BETWEEN DATE '{WINDOW[0][:10]}' AND DATE '{WINDOW[1][:10]}'")
def file_window(spark, sf_dir):
    return comparable(FS.select_window(_files(spark, sf_dir), *WINDOW, zone="UTC").select("path", "mtime"))


@query("file_batches", S.with_ctes(S.file_listing_cte())
       + "SELECT path, ordinal, CAST(floor(ordinal / 50) AS BIGINT) AS batch_id FROM "
       "(SELECT path, row_number() OVER (ORDER BY mtime, path) - 1 AS ordinal FROM FILES)")
def file_batches(spark, sf_dir):
    return FS.batch_files(_files(spark, sf_dir), 50).select("path", "ordinal", "batch_id")


@query(
    "file_batches_isolated",
    S.with_ctes(
        S.file_listing_cte(),
        "O AS (SELECT path, row_number() OVER (ORDER BY mtime, path) - 1 AS ordinal FROM FILES)",
        "P AS (SELECT *, ordinal % 37 = 36 AS special FROM O)",
        "Q AS (SELECT *, max(CASE WHEN special THEN ordinal END) OVER (ORDER BY ordinal ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS last_sp FROM P)",
        "R AS (SELECT *, CASE WHEN special THEN ordinal ELSE coalesce(last_sp + 1, 0) + "
        "CAST(floor((ordinal - coalesce(last_sp + 1, 0)) / 10) AS BIGINT) * 10 END AS bstart FROM Q)",
    )
    + "SELECT path, ordinal, special, dense_rank() OVER (ORDER BY bstart) - 1 AS batch_id FROM R",
)
def file_batches_isolated(spark, sf_dir):
    from tidemark.operators.ordinal import running

    pre = running(_files(spark, sf_dir), FS.ORDER, ordinal="pos")
    out = FS.batch_files_isolated(pre, 10, F.col("pos") % 37 == 36)
    return out.select("path", "ordinal", "special", "batch_id")


@query(
    "retry_floor",
    S.with_ctes(S.file_listing_cte(per_table=True))
    + "SELECT table_name, path, epoch_us(mtime) AS mtime FROM FILES WHERE mtime <= TIMESTAMP '2024-01-28 00:00:00' AND "
    "((table_name = 'CLICK' AND mtime >= TIMESTAMP '2024-01-20 00:00:00') OR table_name = 'ERROR' OR "
    "(table_name NOT IN ('CLICK', 'ERROR') AND mtime >= TIMESTAMP '2024-01-25 00:00:00'))",
)
def retry_floor(spark, sf_dir):
    from datetime import datetime, timezone

    files = _files(spark, sf_dir, per_table=True)
    failed = spark.createDataFrame(
        [("CLICK", datetime(2024, 1, 20, tzinfo=timezone.utc)), ("ERROR", None)], "table_name string, failed_from timestamp"
    )
    out = FS.retry_floor(files, failed, "2024-01-25 00:00:00", "2024-01-28 00:00:00")
    return comparable(out.select("table_name", "path", "mtime"))


@query(
    "force_select",
    S.with_ctes(S.file_listing_cte(per_table=True))
    + "SELECT table_name, path, epoch_us(mtime) AS mtime FROM FILES WHERE lower(table_name) IN ('click', 'purchase') "
    "AND mtime BETWEEN TIMESTAMP '2024-01-29 00:00:00' AND TIMESTAMP '2024-01-30 12:00:00'",
)
def force_select(spark, sf_dir):
    files = _files(spark, sf_dir, per_table=True)
    out = FS.force_select(files, "click; PURCHASE_etl, nosuch", "2024-01-29 00:00:00", "2024-01-30 12:00:00")
    return comparable(out.select("table_name", "path", "mtime"))


# ---------------------------------------------------------------- pass-through types (decimal, array)


@query(
    "pass_through_types",
    "SELECT vec_id AS ID, label AS LABEL, CAST(CAST(label * 1.25 AS DECIMAL(12,2)) AS VARCHAR) AS AMOUNT, "
    "CAST(len(embedding) AS BIGINT) AS n_dims, CAST(embedding[1] AS DOUBLE) AS first_dim, "
    "CAST(embedding[-1] AS DOUBLE) AS last_dim FROM embeddings WHERE vec_id % 5 <> 0",
)
def pass_through_types(spark, sf_dir):
    from tidemark.spec import TableSpec

    apply_engine_conf(spark)
    emb = FX.table(spark, sf_dir, "embeddings")
    img = F.struct(
        F.col("vec_id").alias("ID"),
        F.col("embedding").alias("VEC"),
        F.col("label").alias("LABEL"),
        (F.col("label") * F.lit(1.25).cast("decimal(3,2)")).cast("decimal(12,2)").alias("AMOUNT"),
    )
    ts = F.lit(FX.BASE_US).cast("bigint") + F.col("vec_id")
    none = F.lit(None).cast(emb.select(img.alias("x")).schema["x"].dataType)
    rows = F.array(
        F.struct(F.lit("I").alias("op_type"), ts.alias("op_ts"), ts.alias("current_ts"), none.alias("before"), img.alias("after")),
        F.when(
            F.col("vec_id") % 5 == 0,
            F.struct(F.lit("D").alias("op_type"), (ts + 1).alias("op_ts"), (ts + 1).alias("current_ts"), img.alias("before"), none.alias("after")),
        ),
    )
    env = emb.select(F.explode(rows).alias("e")).filter(F.col("e").isNotNull()).select("e.*")
    spec = TableSpec(name="vectors", keys=("ID",), required=("ID",))
    merged = apply_changes(None, prepare_changes(env, spec), spec.keys)
    return merged.select(
        "ID",
        "LABEL",
        F.col("AMOUNT").cast("string").alias("AMOUNT"),
        F.size("VEC").cast("bigint").alias("n_dims"),
        F.col("VEC")[0].cast("double").alias("first_dim"),
        F.element_at("VEC", -1).cast("double").alias("last_dim"),
    )


# ---------------------------------------------------------------- runs, sinks, streaming

from tidemark.fixtures import files as FF  # noqa: E402
from tidemark.session import scratch_path  # noqa: E402
from tidemark.sinks.catalog import scratch_table  # noqa: E402


def _pipeline_runs(spark, sf_dir):
    from tidemark.plans.pipeline import Source, run_table

    apply_engine_conf(spark)
    root = scratch_path(spark, "cash-landing")
    target = scratch_table(spark, "cash-table")
    mid = FF.land_two_batches(spark, sf_dir, root)
    src = Source(root=root, batch_size=1000)
    r1 = run_table(spark, CASH_TRANSACTIONS, src, target, None, mid, full_refresh=True)
    r2 = run_table(spark, CASH_TRANSACTIONS, src, target, mid, None)
    return target, [r1, r2]


@query("cash_transactions", S.two_batch_merge(FX.BATCH_ONE, FX.BATCH_TWO))
def cash_transactions(spark, sf_dir):
    from tidemark.sources.readers import read_table

    target, _ = _pipeline_runs(spark, sf_dir)
    return comparable(read_table(spark, target).select(*CASH_COLS))


def _metrics_sql(parts: str, suffix: str, run_no: int) -> str:
    return (
        f"SELECT 'cash_transactions' AS table_name, CAST({run_no} AS BIGINT) AS run_no, count(*) AS rows_in, "
        "count(*) FILTER (WHERE op_type = 'I') AS inserts, count(*) FILTER (WHERE op_type = 'U') AS updates, "
        "count(*) FILTER (WHERE op_type = 'D') AS deletes, count(*) FILTER (WHERE op_type = 'R') AS snapshots, "
        f"count(*) - (SELECT count(*) FROM N{suffix}) AS rejected, true AS ok FROM E{suffix}"
    )


@query(
    "run_metrics",
    S.with_ctes(S.IMG_CTE, *S.batch_ctes(FX.BATCH_ONE, "1"), *S.batch_ctes(FX.BATCH_TWO, "2"))
    + _metrics_sql(FX.BATCH_ONE, "1", 1) + " UNION ALL " + _metrics_sql(FX.BATCH_TWO, "2", 2),
)
def run_metrics(spark, sf_dir):
    from tidemark.plans.pipeline import results_frame

    _, results = _pipeline_runs(spark, sf_dir)
    df = results_frame(spark, results)
    n = F.when(F.col("run_id") == results[0].run_id, F.lit(1)).otherwise(F.lit(2)).cast("bigint")
    return df.select("table_name", n.alias("run_no"), "rows_in", "inserts", "updates", "deletes", "snapshots", "rejected", "ok")


def _stored_cash(spark, sf_dir):
    from tidemark.sinks.tables import merge_into
    from tidemark.sources.readers import read_table

    target = scratch_table(spark, "cash-merged")
    merge_into(spark, _changes(spark, sf_dir), CASH_TRANSACTIONS, target)
    return target, read_table(spark, target)


LATEST_LIVE = S.cash_ctes() + ", " + S.latest_cte() + ", LIVE AS (SELECT * FROM L WHERE op_type <> 'D') "


@query(
    "partitioned_roundtrip",
    LATEST_LIVE + "SELECT CAST(C_TRANSACTION_DATE_PARTITION AS VARCHAR) AS C_TRANSACTION_DATE_PARTITION, count(*) AS n_rows "
    "FROM LIVE GROUP BY 1",
)
def partitioned_roundtrip(spark, sf_dir):
    _, df = _stored_cash(spark, sf_dir)
    part = CASH_TRANSACTIONS.partition
    return df.groupBy(F.col(part).cast("string").alias(part)).agg(F.count(F.lit(1)).alias("n_rows"))


@query("layout_sorted", LATEST_LIVE + "SELECT count(*) AS n_rows, CAST(0 AS BIGINT) AS n_out_of_order FROM LIVE")
def layout_sorted(spark, sf_dir):
    from pyspark.sql import Window

    _, df = _stored_cash(spark, sf_dir)
    meta = df.select(
        "C_ACCOUNT_CODE",
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.row_index").alias("row_index"),
    )
    w = Window.partitionBy("file").orderBy("row_index")  # one group per file: bounded by file size
    prev = F.lag("C_ACCOUNT_CODE").over(w)
    flagged = meta.select((prev.isNotNull() & (prev > F.col("C_ACCOUNT_CODE"))).cast("bigint").alias("bad"))
    return flagged.agg(F.count(F.lit(1)).alias("n_rows"), F.coalesce(F.sum("bad"), F.lit(0)).cast("bigint").alias("n_out_of_order"))


@query(
    "registered_table",
    LATEST_LIVE + "SELECT C_STATUS, count(*) AS n_rows, CAST(round(sum(C_AMOUNT)) AS BIGINT) AS amount FROM LIVE GROUP BY C_STATUS",
)
def registered_table(spark, sf_dir):
    name, _ = _stored_cash(spark, sf_dir)
    return spark.sql(
        f"SELECT C_STATUS, count(*) AS n_rows, CAST(round(sum(C_AMOUNT)) AS BIGINT) AS amount FROM {name} GROUP BY C_STATUS"
    )


@query("stream_merge", S.two_batch_merge(FX.BATCH_ONE, FX.BATCH_TWO))
def stream_merge(spark, sf_dir):
    from tidemark.sources.readers import read_table
    from tidemark.streaming import change_stream, stream_table

    apply_engine_conf(spark)
    root = scratch_path(spark, "cash-stream-landing")
    target = scratch_table(spark, "cash-stream-table")
    FF.land_two_batches(spark, sf_dir, root, snapshot_file=False)
    first = spark.read.parquet(f"{root}/*/BACK.0001")
    # A micro-batch takes a landed data set, however many files it has: each merge rewrites what it touches.
    stream = change_stream(spark, f"{root}/*/BACK.*", first.schema, max_files_per_trigger=len(first.inputFiles()))
    q = stream_table(spark, CASH_TRANSACTIONS, stream, target, scratch_path(spark, "cash-stream-ckpt"))
    q.awaitTermination()
    return comparable(read_table(spark, target).select(*CASH_COLS))


from tidemark.plans import stored_queries  # noqa: E402, F401 - registers its queries here
