from datetime import date, datetime

from pyspark.sql import functions as F

from tidemark.operators.normalize import clamp_times, require, shift_times, with_day


def _micros_str(df, c):
    return [r[0] for r in df.select(F.date_format(F.col(c), "yyyy-MM-dd HH:mm:ss")).collect()]


def test_shift_dates_become_timestamps_and_ntz_stays_ntz(spark):
    df = spark.sql(
        "SELECT DATE'2024-01-02' AS d, TIMESTAMP'2024-01-02 10:00:00' AS t, TIMESTAMP_NTZ'2024-01-02 10:00:00' AS n, 1 AS k"
    )
    out = shift_times(df, 7)
    types = dict(out.dtypes)
    assert types == {"d": "timestamp", "t": "timestamp", "n": "timestamp_ntz", "k": "int"}
    r = out.select(*[F.date_format(c, "yyyy-MM-dd HH:mm:ss").alias(c) for c in ("d", "t", "n")]).collect()[0]
    assert (r.d, r.t, r.n) == ("2024-01-02 07:00:00", "2024-01-02 17:00:00", "2024-01-02 17:00:00")
    assert dict(shift_times(df, 7, keep_dates=True).dtypes)["d"] == "date"


def test_clamp_low_keeps_null_and_skips_ntz(spark):
    df = spark.sql(
        "SELECT * FROM VALUES "
        "(CAST('-0005-01-01 00:00:00' AS TIMESTAMP), CAST('-0005-01-01 00:00:00' AS TIMESTAMP_NTZ)), "
        "(CAST(NULL AS TIMESTAMP), CAST(NULL AS TIMESTAMP_NTZ)), "
        "(TIMESTAMP'2024-01-01 00:00:00', TIMESTAMP_NTZ'2024-01-01 00:00:00') AS v(t, n)"
    )
    out = clamp_times(df, "0001-01-01 00:00:00")
    got = [(r[0], r[1]) for r in out.select(F.unix_micros("t"), F.unix_micros(F.col("n").cast("timestamp"))).collect()]
    lo = spark.sql("SELECT unix_micros(TIMESTAMP'0001-01-01 00:00:00')").collect()[0][0]
    assert got[0][0] == lo and got[0][1] < lo  # NTZ not clamped by default
    assert got[1] == (None, None)
    assert got[2][0] > lo
    both = clamp_times(df, "0001-01-01 00:00:00", include_ntz=True)
    assert both.select(F.unix_micros(F.col("n").cast("timestamp"))).collect()[0][0] == lo


def test_require_applies_to_upserts_and_keys_to_deletes(spark):
    df = spark.createDataFrame(
        [("I", 1, None), ("I", 2, date(2024, 1, 1)), ("D", 3, None), ("D", None, None), ("U", None, date(2024, 1, 1))],
        "op_type string, k bigint, d date",
    )
    out = sorted((r.op_type, r.k) for r in require(df, ["d"], ["k"]).collect())
    assert out == [("D", 3), ("I", 2)]


def test_with_day_uses_shifted_local_day(spark):
    df = spark.sql("SELECT TIMESTAMP'2024-01-01 20:00:00' AS t")
    r = with_day(shift_times(df, 7), "t", "day").collect()[0]
    assert r.day == date(2024, 1, 2)
