"""Natural key -> surrogate key maps, and known/unknown key checks against a lookup table.

Map builds are incremental: only keys the map does not hold yet get a surrogate (left anti
join), so a rerun after a crash adds nothing twice. Surrogates are deterministic (salted hash),
which also makes the result independent of how often a task is retried.
"""

from __future__ import annotations

from typing import Optional

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.surrogate import account_surrogate, surrogate
from tidemark.operators.merge import latest_per_key
from tidemark.spec import LOCAL_ZONE

CUSTOMER_CODE = "C_CUSTOMER_CODE"
CUSTOMER_MAP = "C_CUSTOMER_CODE_MAP"
ACCOUNT_CODE = "C_ACCOUNT_CODE"
ACCOUNT_MAP = "C_ACCOUNT_CODE_MAP"
UPDATE_TIME = "WH_UPDATE_TIME"


def update_time(now: Optional[str] = None) -> Column:
    """Warehouse update time in the local zone; ``now`` (UTC text) pins the run clock."""
    base = F.current_timestamp() if now is None else F.lit(now).cast("timestamp")
    return F.from_utc_timestamp(base, LOCAL_ZONE)


def new_keys(df: DataFrame, existing: DataFrame, key: str) -> DataFrame:
    """Rows whose key the existing table does not hold (left anti join; no distinct needed)."""
    return df.join(existing.select(key), key, "left_anti")


def known_keys(df: DataFrame, lookup: DataFrame, key: str) -> DataFrame:
    """Rows whose key is in the lookup (semi join: duplicate lookup keys cannot multiply rows)."""
    return df.join(lookup.select(key), key, "left_semi")


def unknown_keys(df: DataFrame, lookup: DataFrame, key: str) -> DataFrame:
    """Rows with a non-null key that the lookup does not hold."""
    return df.filter(F.col(key).isNotNull()).join(lookup.select(key), key, "left_anti")


def _source(source: DataFrame, key: str, keep: list[str]) -> DataFrame:
    src = source.filter(F.col(key).isNotNull()).select(key, *keep)
    ordering = [c for c in ("current_ts",) if c in keep]
    # One row per key (latest by current_ts): the map must never give one key two surrogates.
    return latest_per_key(src, [key], ordering) if ordering else src.dropDuplicates([key])


def build_map(
    source: DataFrame,
    existing: Optional[DataFrame],
    key: str,
    salt: str,
    now: Optional[str] = None,
    map_col: Optional[str] = None,
) -> DataFrame:
    """Rows to add to a key map: every source key on the first build, unknown keys afterwards.

    Output: ``key, op_type, current_ts, <key>_MAP, WH_UPDATE_TIME``.
    """
    map_col = map_col or f"{key}_MAP"
    src = _source(source, key, ["op_type", "current_ts"])
    if existing is not None:
        src = new_keys(src, existing, key)
    return src.select(
        key,
        "op_type",
        "current_ts",
        surrogate(key, salt).alias(map_col),
        update_time(now).alias(UPDATE_TIME),
    )


def with_customer_map(accounts: DataFrame, customer_map: DataFrame) -> DataFrame:
    """Accounts with their customer's surrogate (left join; the map is keyed by customer code)."""
    return accounts.join(customer_map.select(CUSTOMER_CODE, CUSTOMER_MAP), CUSTOMER_CODE, "left")


def build_account_map(
    accounts: DataFrame,
    customer_map: DataFrame,
    existing: Optional[DataFrame],
    salt: str,
    now: Optional[str] = None,
) -> DataFrame:
    """Rows to add to the account map. The account surrogate is the customer surrogate followed by
    the last character of the account code, on the first build and on increments alike; an
    account whose customer has no surrogate gets a hashed one of its own.
    """
    src = accounts.filter(F.col(ACCOUNT_CODE).isNotNull()).select(CUSTOMER_CODE, ACCOUNT_CODE, "op_type", "current_ts")
    src = latest_per_key(src, [ACCOUNT_CODE], ["current_ts"])
    if existing is not None:
        src = new_keys(src, existing, ACCOUNT_CODE)
    joined = with_customer_map(src, customer_map)
    return joined.select(
        ACCOUNT_CODE,
        account_surrogate(CUSTOMER_MAP, ACCOUNT_CODE, salt).alias(ACCOUNT_MAP),
        CUSTOMER_CODE,
        CUSTOMER_MAP,
        update_time(now).alias(UPDATE_TIME),
        "op_type",
        "current_ts",
    )


def map_clashes(mapped: DataFrame, map_col: str, key: str) -> DataFrame:
    """Surrogates given to more than one key, with the number of keys and two example keys.

    An aggregate with map-side combine: a surrogate shared by many keys is counted, not gathered.
    """
    return (
        mapped.filter(F.col(map_col).isNotNull())
        .groupBy(map_col)
        .agg(F.count(F.lit(1)).alias("n_keys"), F.min(key).alias("first_key"), F.max(key).alias("last_key"))
        .filter(F.col("n_keys") > 1)
    )


def register_unknown(batch: DataFrame, lookup: DataFrame, key: str, salt: str, map_col: Optional[str] = None) -> DataFrame:
    """Distinct unknown keys of a batch with their new surrogate, ready for the lookup's sink."""
    map_col = map_col or f"{key}_MAP"
    # Distinct first: the aggregate combines on the map side, so a code that holds a third of the
    # batch reaches the anti join as one row.
    distinct = batch.select(key).distinct()
    return unknown_keys(distinct, lookup, key).select(key, surrogate(key, salt).alias(map_col))
