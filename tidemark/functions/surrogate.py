"""Surrogate keys.

The default surrogate is deterministic: the first ``n`` hex digits of SHA-256 of
``salt || '|' || key``. It is stable across runs, task retries and engines (DuckDB's
``sha256`` gives the same digits), so a replayed map build cannot hand out a second value
for a key. A random variant is available for parity with random ids; callers must persist
its result before using it more than once.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SURROGATE_HEX_DIGITS = 20


def surrogate(key: Column | str, salt: str, n: int = SURROGATE_HEX_DIGITS, random: bool = False) -> Column:
    key = F.col(key) if isinstance(key, str) else key
    if random:
        return F.substring(F.regexp_replace(F.expr("uuid()"), "-", ""), 1, n)
    digest = F.sha2(F.concat(F.lit(salt), F.lit("|"), key.cast("string")), 256)
    return F.when(key.isNotNull(), F.substring(digest, 1, n))


def account_surrogate(customer_map: Column | str, account_code: Column | str, salt: str) -> Column:
    """Account surrogate = customer surrogate followed by the last character of the account code.

    When the customer has no map value the account gets its own hashed surrogate.
    """
    cmap = F.col(customer_map) if isinstance(customer_map, str) else customer_map
    code = F.col(account_code) if isinstance(account_code, str) else account_code
    by_rule = F.concat(cmap, F.substring(code, -1, 1))
    return F.when(cmap.isNotNull(), by_rule).otherwise(surrogate(code, salt))
