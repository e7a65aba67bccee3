import hashlib

from pyspark.sql import functions as F

from tidemark.functions.surrogate import surrogate
from tidemark.operators import keymaps as KM


def test_surrogate_is_salted_sha256_prefix(spark):
    df = spark.createDataFrame([("C000001",), (None,)], "k string")
    got = [r[0] for r in df.select(surrogate("k", "salt")).collect()]
    assert got == [hashlib.sha256(b"salt|C000001").hexdigest()[:20], None]


def test_build_map_init_then_increment(spark):
    src = spark.createDataFrame([("a", "I", 1), ("b", "I", 2), ("a", "U", 3), (None, "I", 4)], "C_CUSTOMER_CODE string, op_type string, current_ts bigint")
    init = KM.build_map(src, None, "C_CUSTOMER_CODE", "s", "2026-01-02 00:00:00")
    rows = {r.C_CUSTOMER_CODE: r for r in init.collect()}
    assert set(rows) == {"a", "b"} and rows["a"].current_ts == 3  # one surrogate per key
    more = spark.createDataFrame([("a", "I", 5), ("c", "I", 6)], "C_CUSTOMER_CODE string, op_type string, current_ts bigint")
    inc = KM.build_map(more, init, "C_CUSTOMER_CODE", "s", "2026-01-02 00:00:00").collect()
    assert [r.C_CUSTOMER_CODE for r in inc] == ["c"]
    assert str(inc[0].WH_UPDATE_TIME) == "2026-01-02 07:00:00"


def test_account_map_rule_orphans_and_clashes(spark):
    accounts = spark.createDataFrame(
        [("C1", "C1-1", "I", 1), ("C1", "C1-A1", "I", 1), ("C2", "C2-2", "I", 1), ("Z9", "Z9-9", "I", 1), ("C2", None, "I", 1)],
        "C_CUSTOMER_CODE string, C_ACCOUNT_CODE string, op_type string, current_ts bigint",
    )
    cmap = spark.createDataFrame([("C1", "m1"), ("C2", "m2")], "C_CUSTOMER_CODE string, C_CUSTOMER_CODE_MAP string")
    out = {r.C_ACCOUNT_CODE: r.C_ACCOUNT_CODE_MAP for r in KM.build_account_map(accounts, cmap, None, "s").collect()}
    assert out["C1-1"] == "m11" and out["C2-2"] == "m22"
    assert out["Z9-9"] == hashlib.sha256(b"s|Z9-9").hexdigest()[:20]
    assert None not in out
    clashes = KM.map_clashes(KM.build_account_map(accounts, cmap, None, "s"), KM.ACCOUNT_MAP, KM.ACCOUNT_CODE).collect()
    assert [(r.C_ACCOUNT_CODE_MAP, r.n_keys) for r in clashes] == [("m11", 2)]


def test_known_unknown_and_register(spark):
    batch = spark.createDataFrame([("a",), ("b",), ("b",), (None,)], "C_CUSTOMER_CODE string")
    lookup = spark.createDataFrame([("a", "x"), ("a", "y")], "C_CUSTOMER_CODE string, C_CUSTOMER_CODE_MAP string")
    assert KM.known_keys(batch, lookup, "C_CUSTOMER_CODE").count() == 1  # no row multiplication
    assert sorted(r[0] for r in KM.unknown_keys(batch, lookup, "C_CUSTOMER_CODE").collect()) == ["b", "b"]
    reg = KM.register_unknown(batch, lookup, "C_CUSTOMER_CODE", "s").collect()
    assert [(r.C_CUSTOMER_CODE, r.C_CUSTOMER_CODE_MAP) for r in reg] == [("b", hashlib.sha256(b"s|b").hexdigest()[:20])]
