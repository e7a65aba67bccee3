"""DuckDB (ANSI SQL) versions of the fixture derivations, used as CTEs by the oracle queries.

These are written independently of the Spark code: window functions and CASE expressions
stand in for the engine's aggregate-based merge.
"""

from __future__ import annotations

from tidemark.fixtures.frames import BASE_US, RUN_TIME, SALT
from tidemark.spec import SNAPSHOT_FLOOR_US

F = SNAPSHOT_FLOOR_US
B = BASE_US

IMAGE_TYPE = (
    "STRUCT(PK_CASH_TRANSACTION BIGINT, C_ACCOUNT_CODE VARCHAR, C_CUSTOMER_CODE VARCHAR, "
    "C_AMOUNT DOUBLE, C_STATUS VARCHAR, C_TRANSACTION_DATE TIMESTAMP)"
)


def _img(key="k", amount="amt", status="st", date="dt") -> str:
    return (
        "{'PK_CASH_TRANSACTION': CAST(" + key + " AS BIGINT), 'C_ACCOUNT_CODE': cust || '-1', "
        "'C_CUSTOMER_CODE': cust, 'C_AMOUNT': CAST(" + amount + " AS DOUBLE), "
        "'C_STATUS': CAST(" + status + " AS VARCHAR), 'C_TRANSACTION_DATE': CAST(" + date + " AS TIMESTAMP)}"
    )


NULL_IMG = f"CAST(NULL AS {IMAGE_TYPE})"


def _ts(delta: int) -> str:
    return f"({B} + k * 1000000 + {delta})"


# part -> (op, where, ts, before, after)
_PARTS = {
    "a": ("R", "k % 2 = 0", str(F), NULL_IMG, _img()),
    "b": ("I", "k % 2 = 1", _ts(0), NULL_IMG, _img()),
    "c": ("U", "k % 5 = 0", _ts(1000), _img(), _img(amount="amt + 100")),
    "d": ("U", "k % 10 = 0", _ts(2000), _img(), _img(status="'X'")),
    "e": ("D", "k % 7 = 0", _ts(3000), _img(), NULL_IMG),
    "f": ("I", "k % 35 = 0", _ts(4000), NULL_IMG, _img(status="'N'")),
    "g": ("U", "k % 22 = 0", str(F - 1), _img(), _img(status="'L'")),
    "h": ("I", "k % 997 = 0", _ts(5000), NULL_IMG, _img(key="NULL")),
    "i": ("I", "k % 991 = 0", _ts(6000), NULL_IMG, _img(key="k + 1000000", date="NULL")),
    "z": ("U", "k % 100 = 0", _ts(9000), _img(), _img(status="'Z'")),
}

IMG_CTE = (
    "img AS (SELECT o_orderkey AS k, 'C' || lpad(CAST(o_custkey AS VARCHAR), 6, '0') AS cust, "
    "o_totalprice AS amt, o_orderstatus AS st, o_orderdate AS dt FROM orders)"
)


def envelope_cte(parts: str = "abcdefghi", name: str = "E") -> str:
    selects = []
    for p in parts:
        op, where, ts, before, after = _PARTS[p]
        selects.append(
            f"SELECT '{op}' AS op_type, CAST({ts} AS BIGINT) AS op_ts, CAST({ts} AS BIGINT) AS current_ts, "
            f"{before} AS before, {after} AS after FROM img WHERE {where}"
        )
    return f"{name} AS (" + " UNION ALL ".join(selects) + ")"


FIELDS = ["C_ACCOUNT_CODE", "C_AMOUNT", "C_CUSTOMER_CODE", "C_STATUS", "C_TRANSACTION_DATE", "PK_CASH_TRANSACTION"]


def flat_cte(src: str = "E", name: str = "FL") -> str:
    cols = ", ".join(f"CASE WHEN op_type = 'D' THEN before.{f} ELSE after.{f} END AS {f}" for f in FIELDS)
    return f"{name} AS (SELECT {cols}, op_type, op_ts, current_ts FROM {src} WHERE op_type IN ('I','U','D','R'))"


def norm_cte(src: str = "FL", name: str = "N", shift_hours: int = 7, low: str = "0001-01-01 00:00:00") -> str:
    """Snapshot floor, +7 h, low clamp, day partition, required columns (cash table rules)."""
    dt = f"(C_TRANSACTION_DATE + INTERVAL {shift_hours} HOUR)"
    clamped = f"CASE WHEN {dt} < TIMESTAMP '{low}' THEN TIMESTAMP '{low}' ELSE {dt} END"
    return (
        f"{name} AS (SELECT C_ACCOUNT_CODE, C_AMOUNT, C_CUSTOMER_CODE, C_STATUS, {clamped} AS C_TRANSACTION_DATE, "
        f"PK_CASH_TRANSACTION, op_type, op_ts, "
        f"CASE WHEN op_type = 'R' THEN CAST({F} AS BIGINT) ELSE current_ts END AS current_ts, "
        f"CAST({clamped} AS DATE) AS C_TRANSACTION_DATE_PARTITION FROM {src} "
        f"WHERE PK_CASH_TRANSACTION IS NOT NULL AND (op_type = 'D' OR C_TRANSACTION_DATE IS NOT NULL))"
    )


RANK = "CASE op_type WHEN 'D' THEN 3 WHEN 'U' THEN 2 WHEN 'I' THEN 1 WHEN 'R' THEN 0 ELSE -1 END"


def latest_cte(src: str = "N", name: str = "L", deletes_win: bool = False, key: str = "PK_CASH_TRANSACTION") -> str:
    first = "CASE WHEN op_type = 'D' THEN 1 ELSE 0 END DESC, " if deletes_win else ""
    return (
        f"{name} AS (SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY {key} "
        f"ORDER BY {first}current_ts DESC, op_ts DESC, {RANK} DESC) AS rn FROM {src}) WHERE rn = 1)"
    )


def with_ctes(*ctes: str) -> str:
    return "WITH " + ", ".join(ctes) + " "


def cash_ctes(parts: str = "abcdefghi") -> str:
    return with_ctes(IMG_CTE, envelope_cte(parts), flat_cte(), norm_cte())


# Output projection shared by merge results: timestamps as epoch micros, day as text.
CASH_OUT = (
    "PK_CASH_TRANSACTION, C_ACCOUNT_CODE, C_CUSTOMER_CODE, C_AMOUNT, C_STATUS, "
    "epoch_us(C_TRANSACTION_DATE) AS C_TRANSACTION_DATE, CAST(C_TRANSACTION_DATE_PARTITION AS VARCHAR) AS "
    "C_TRANSACTION_DATE_PARTITION, op_type, op_ts, current_ts"
)


def customer_source_cte(name: str = "CS") -> str:
    return (
        f"{name} AS (SELECT 'C' || lpad(CAST(c_custkey AS VARCHAR), 6, '0') AS C_CUSTOMER_CODE, 'I' AS op_type, "
        f"CAST({B} + c_custkey AS BIGINT) AS current_ts, c_custkey FROM customer)"
    )


def surrogate_sql(key: str) -> str:
    return f"substr(sha256('{SALT}|' || {key}), 1, 20)"


# WH_UPDATE_TIME = run time in the local zone (UTC + 7 h), as epoch micros.
WH_UPDATE_US = f"epoch_us(TIMESTAMP '{RUN_TIME}' + INTERVAL 7 HOUR)"


def account_source_cte(name: str = "ACS") -> str:
    code = "'C' || lpad(CAST(c_custkey AS VARCHAR), 6, '0')"
    ts = f"CAST({B} + c_custkey AS BIGINT)"
    parts = [
        f"SELECT {code} AS C_CUSTOMER_CODE, {code} || '-1' AS C_ACCOUNT_CODE, 'I' AS op_type, {ts} AS current_ts, c_custkey FROM customer",
        f"SELECT {code}, {code} || '-2', 'I', {ts}, c_custkey FROM customer WHERE c_custkey % 4 = 0",
        f"SELECT {code}, {code} || '-A1', 'I', {ts}, c_custkey FROM customer WHERE c_custkey % 50 = 0",
        f"SELECT 'Z' || {code}, 'Z' || {code} || '-9', 'I', {ts}, c_custkey FROM customer WHERE c_custkey % 300 = 0",
        f"SELECT {code}, CAST(NULL AS VARCHAR), 'I', {ts}, c_custkey FROM customer WHERE c_custkey % 500 = 0",
    ]
    return f"{name} AS (" + " UNION ALL ".join(parts) + ")"


def front_user_source_cte(name: str = "FU") -> str:
    return (
        f"{name} AS (SELECT 'U' || lpad(CAST(user_id AS VARCHAR), 6, '0') AS C_FRONT_USER_CODE, 'I' AS op_type, "
        f"epoch_us(max(ts)) AS current_ts, user_id FROM events GROUP BY user_id)"
    )


def file_listing_cte(name: str = "FILES", per_table: bool = False) -> str:
    tcol = "upper(event_type)" if per_table else "'T'"
    group = "date_trunc('hour', ts)" + (", upper(event_type)" if per_table else "")
    name_expr = (
        "(CASE WHEN hour(h) = 0 THEN 'INIT.' ELSE 'BACK.' END) || lpad(CAST(hour(h) AS VARCHAR), 2, '0') || '.avro'"
    )
    inner = f"SELECT date_trunc('hour', ts) AS h, {tcol} AS table_name, max(ts) AS mtime, count(*) AS length FROM events GROUP BY {group}"
    return (
        f"{name} AS (SELECT table_name, 'BACK.' || table_name || '/' || strftime(CAST(h AS DATE), '%Y-%m-%d') || '/' || {name_expr} AS path, "
        f"{name_expr} AS file_name, CAST(h AS DATE) AS day, mtime, CAST(length AS BIGINT) AS length FROM ({inner}))"
    )


def batch_ctes(parts: str, suffix: str) -> list[str]:
    """Envelope, flattened and normalised CTEs of one batch: E<s>, FL<s>, N<s>."""
    return [
        envelope_cte(parts, f"E{suffix}"),
        flat_cte(f"E{suffix}", f"FL{suffix}"),
        norm_cte(f"FL{suffix}", f"N{suffix}"),
    ]


def newer_or_equal(a: str, b: str) -> str:
    """Lexicographic (current_ts, op_ts, op rank) comparison a >= b."""
    ra = RANK.replace("op_type", f"{a}.op_type")
    rb = RANK.replace("op_type", f"{b}.op_type")
    return (
        f"({a}.current_ts > {b}.current_ts OR ({a}.current_ts = {b}.current_ts AND "
        f"({a}.op_ts > {b}.op_ts OR ({a}.op_ts = {b}.op_ts AND {ra} >= {rb}))))"
    )


def two_batch_merge(parts1: str, parts2: str, arrival: bool = False, out: str = CASH_OUT, extra1: str = "", extra2: str = "") -> str:
    """Stored table after batch 1 (no tombstones), then batch 2 applied with the late policy."""
    n1 = f"N1x AS (SELECT *{extra1} FROM N1)"
    n2 = f"N2x AS (SELECT *{extra2} FROM N2)"
    s1 = latest_cte("N1x", "L1") + ", S1 AS (SELECT * FROM L1 WHERE op_type <> 'D')"
    l2 = latest_cte("N2x", "L2")
    if arrival:
        w = "W AS (SELECT * FROM L2)"
    else:
        w = (
            "W AS (SELECT L2.* FROM L2 LEFT JOIN S1 ON L2.PK_CASH_TRANSACTION = S1.PK_CASH_TRANSACTION "
            f"WHERE S1.PK_CASH_TRANSACTION IS NULL OR {newer_or_equal('L2', 'S1')})"
        )
    r = (
        "R AS (SELECT * FROM S1 WHERE PK_CASH_TRANSACTION NOT IN (SELECT PK_CASH_TRANSACTION FROM W) "
        "UNION ALL BY NAME SELECT * FROM W WHERE op_type <> 'D')"
    )
    return (
        with_ctes(IMG_CTE, *batch_ctes(parts1, "1"), *batch_ctes(parts2, "2"), n1, n2, s1, l2, w, r)
        + f"SELECT {out} FROM R"
    )
