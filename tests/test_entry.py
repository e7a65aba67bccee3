import duckdb

import __spark_entry__ as E
from conftest import SF001

FAST = [
    "cdc_op_counts", "cdc_flatten", "merge_event_order", "merge_upsert_then_delete", "merge_late_arrival",
    "time_shift", "customer_map_increment", "account_map_init", "file_batches_isolated", "pass_through_types",
]


def test_entry_runs_on_smallest_scale(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "PK_CASH_TRANSACTION" in df.columns


def test_every_query_has_matching_oracle_names():
    from tidemark.plans import queries as Q

    assert set(Q.QUERIES) == set(Q.ORACLE) <= set(E.queries())
    assert set(E.oracle_sql()) <= set(E.queries())


def _norm(v):
    return repr(round(v, 6)) if isinstance(v, float) else repr(v)


def test_queries_match_oracle_at_sf0001(spark):
    con = duckdb.connect()
    for t in ["orders", "customer", "events", "embeddings"]:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF001}/{t}.parquet')")
    qs, oracle = E.queries(), E.oracle_sql()
    for name in FAST:
        df = qs[name](spark, SF001)
        cols = df.columns
        got = sorted("|".join(_norm(r[c]) for c in sorted(cols)) for r in df.collect())
        res = con.execute(oracle[name])
        ocols = [d[0] for d in res.description]
        assert sorted(ocols) == sorted(cols), name
        idx = {c: i for i, c in enumerate(ocols)}
        want = sorted("|".join(_norm(r[idx[c]]) for c in sorted(ocols)) for r in res.fetchall())
        assert got == want, name
