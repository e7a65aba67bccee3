"""Queries over stored tables: several batches merged into one table, then read back.

The batches are derived from ``orders`` and ``customer``: key, partition value and event time follow
from the order key, so the expected rows are one plain SELECT.
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.fixtures import frames as FX
from tidemark.fixtures import sql as S
from tidemark.operators import keymaps as KM
from tidemark.operators.merge import apply_changes, live_rows
from tidemark.plans.queries import ACCOUNT_OUT, CMAP_CTE, CODES_CTE, MAP_OUT, NOW, ORACLE, SALT, comparable, query
from tidemark.session import apply_engine_conf, scratch_path
from tidemark.sinks.catalog import scratch_table
from tidemark.sinks.tables import append, merge_into
from tidemark.sources.readers import read_changes, read_table
from tidemark.spec import UPSERT_THEN_DELETE, TableSpec
from tidemark.tables import CASH_TRANSACTIONS

SPEC = TableSpec(name="orders_by_status", keys=("k",), partition="p")


def _batch(spark: SparkSession, sf_dir: str, op: str, ts: int, where: str = "true", p: str = "o_orderstatus", **more: Column) -> DataFrame:
    apply_engine_conf(spark)
    rows = FX.table(spark, sf_dir, "orders").filter(where).select(
        F.col("o_orderkey").alias("k"), F.expr(p).alias("p"), F.lit(op).alias("op_type"),
        F.lit(ts).cast("bigint").alias("current_ts"), F.lit(ts).cast("bigint").alias("op_ts"), *[c.alias(n) for n, c in more.items()],
    )
    return rows


def _stored(spark: SparkSession, batches, spec: TableSpec = SPEC) -> DataFrame:
    table = scratch_table(spark, spec.name)
    for batch, own in batches:
        merge_into(spark, batch, own, table)
    return read_table(spark, table)


@query("stored_schema_evolution", "SELECT o_orderkey AS k, o_orderstatus AS p, CASE WHEN o_orderkey % 3 = 1 THEN 'web' END AS channel FROM orders")
def stored_schema_evolution(spark, sf_dir):
    """Three batches, of which only the second has a column more."""
    more = {"channel": F.lit("web")}
    batches = [_batch(spark, sf_dir, "I", n + 1, f"o_orderkey % 3 = {n}", **(more if n == 1 else {})) for n in range(3)]
    return _stored(spark, [(b, SPEC) for b in batches]).select("k", "p", "channel")


@query("stored_delete_all_then_insert", "SELECT o_orderkey AS k, o_orderstatus AS p FROM orders WHERE o_orderkey % 2 = 0")
def stored_delete_all_then_insert(spark, sf_dir):
    batches = [_batch(spark, sf_dir, "D", 1), _batch(spark, sf_dir, "I", 2), _batch(spark, sf_dir, "D", 3), _batch(spark, sf_dir, "I", 4, "o_orderkey % 2 = 0")]
    return _stored(spark, [(b, SPEC) for b in batches]).select("k", "p")


@query(
    "stored_string_partitions",
    "SELECT o_orderkey AS k, CASE WHEN o_orderkey % 5 = 0 THEN o_orderstatus || '=' ELSE '0' || (o_orderkey % 4) || ':a/b c%' END AS p "
    "FROM orders WHERE o_orderkey % 7 <> 0",
)
def stored_string_partitions(spark, sf_dir):
    """Partition values that folders must escape and that look like numbers; keys move and go."""
    odd = "concat('0', cast(o_orderkey % 4 as string), ':a/b c%')"
    batches = [
        _batch(spark, sf_dir, "I", 1, p=odd),
        _batch(spark, sf_dir, "U", 2, "o_orderkey % 5 = 0", p="concat(o_orderstatus, '=')"),
        _batch(spark, sf_dir, "D", 3, "o_orderkey % 7 = 0", p=odd),
    ]
    return _stored(spark, [(b, SPEC) for b in batches]).select("k", "p")


@query("stored_late_update", "SELECT o_orderkey AS k, CASE WHEN o_orderkey % 2 = 0 THEN 'moved' ELSE 'late' END AS p FROM orders")
def stored_late_update(spark, sf_dir):
    """A change older than the one that moved its key arrives after it, for another partition."""
    batches = [_batch(spark, sf_dir, "I", 10), _batch(spark, sf_dir, "U", 30, "o_orderkey % 2 = 0", p="'moved'"), _batch(spark, sf_dir, "U", 20, p="'late'")]
    return _stored(spark, [(b, SPEC) for b in batches]).select("k", "p")


@query("tombstones_switched_on", "SELECT o_orderkey AS k, o_orderstatus AS p FROM orders WHERE o_orderkey % 3 <> 0")
def tombstones_switched_on(spark, sf_dir):
    """Rows from before have no mark and live on; an older insert does not bring a deleted key back."""
    marked = replace(SPEC, keep_tombstones=True)
    gone = "o_orderkey % 3 = 0"
    return live_rows(_stored(spark, [(_batch(spark, sf_dir, "I", 1), SPEC), (_batch(spark, sf_dir, "D", 3, gone), marked), (_batch(spark, sf_dir, "I", 2, gone), marked)])).select("k", "p")


@query("merge_upsert_then_delete_late", "SELECT o_orderkey AS k, o_orderstatus AS p FROM orders WHERE o_orderkey % 4 <> 0")
def merge_upsert_then_delete_late(spark, sf_dir):
    """Stored at 35; the batch deletes at 30 and inserts at 40 (key goes), or deletes at 30 alone (late, key stays)."""
    stored = apply_changes(None, _batch(spark, sf_dir, "I", 35), ["k"])
    batch = _batch(spark, sf_dir, "D", 30, "o_orderkey % 2 = 0").unionByName(_batch(spark, sf_dir, "I", 40, "o_orderkey % 4 = 0"))
    return apply_changes(stored, batch, ["k"], merge_mode=UPSERT_THEN_DELETE).select("k", "p")


@query("read_mixed_schema", "SELECT o_orderkey AS k, CASE WHEN o_orderkey % 2 = 1 THEN o_orderstatus END AS more FROM orders")
def read_mixed_schema(spark, sf_dir):
    """Change files from before and after a column was added."""
    apply_engine_conf(spark)
    orders, paths = FX.table(spark, sf_dir, "orders"), [scratch_path(spark, "mixed") for _ in range(2)]
    orders.filter("o_orderkey % 2 = 0").select(F.col("o_orderkey").alias("k")).write.parquet(paths[0])
    orders.filter("o_orderkey % 2 = 1").select(F.col("o_orderkey").alias("k"), F.col("o_orderstatus").alias("more")).write.parquet(paths[1])
    return read_changes(spark, paths).select("k", "more")


LOCAL_WINDOW = ("2024-01-10 17:00:00", "2024-01-11 16:59:59.999999")


@query(
    "file_window_local_day",
    S.with_ctes(S.file_listing_cte())
    + f"SELECT path, epoch_us(mtime) AS mtime FROM FILES WHERE mtime BETWEEN TIMESTAMP '{LOCAL_WINDOW[0]}' AND TIMESTAMP '{LOCAL_WINDOW[1]}'",
)
def file_window_local_day(spark, sf_dir):
    """One local day: its folder carries the local date, its files arrive from 17:00 UTC the day before."""
    from tidemark.sources import files as FS

    apply_engine_conf(spark)
    files = FX.file_listing(spark, sf_dir).withColumn("day", F.to_date(F.col("mtime") + F.expr("INTERVAL 7 HOURS")))
    return comparable(FS.select_window(files, *LOCAL_WINDOW).select("path", "mtime"))


# ---------------------------------------------------------------- map jobs and the lookup of a run


def _staged(spark: SparkSession, df: DataFrame, name: str) -> str:
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return path


def _job_twice(spark, job, first: DataFrame, whole: DataFrame) -> DataFrame:
    """First build over part of the source, then two increments over all of it; the last adds nothing."""
    from tidemark.plans.maps import run_map

    job.source = _staged(spark, first, job.name)
    run_map(spark, job, NOW)
    job.source = _staged(spark, whole, job.name)
    run_map(spark, job, NOW)
    if run_map(spark, job, NOW):
        raise AssertionError("a second increment over the same source added keys")
    return comparable(read_table(spark, job.target))


@query("customer_map_job", S.with_ctes(S.customer_source_cte()) + f"SELECT {MAP_OUT} FROM CS")
def customer_map_job(spark, sf_dir):
    from tidemark.plans.maps import MapJob

    apply_engine_conf(spark)
    cs = FX.customer_source(spark, sf_dir)
    return _job_twice(spark, MapJob("customer-map", "", scratch_table(spark, "customer-map"), KM.CUSTOMER_CODE, SALT), cs.filter("c_custkey % 3 <> 0"), cs)


@query(
    "front_user_map_init",
    S.with_ctes(S.front_user_source_cte())
    + f"SELECT C_FRONT_USER_CODE, op_type, current_ts, {S.surrogate_sql('C_FRONT_USER_CODE')} AS C_FRONT_USER_CODE_MAP, "
    f"{S.WH_UPDATE_US} AS WH_UPDATE_TIME FROM FU",
)
def front_user_map_init(spark, sf_dir):
    from tidemark.plans.maps import MapJob, run_map

    apply_engine_conf(spark)
    job = MapJob("front-user-map", _staged(spark, FX.front_user_source(spark, sf_dir), "front-users"), scratch_table(spark, "front-user-map"), "C_FRONT_USER_CODE", SALT)
    run_map(spark, job, NOW)
    return comparable(read_table(spark, job.target))


@query(
    "account_map_job",
    S.with_ctes(S.account_source_cte(), CODES_CTE, CMAP_CTE)
    + f"SELECT {ACCOUNT_OUT} FROM ACS A LEFT JOIN M ON A.C_CUSTOMER_CODE = M.C_CUSTOMER_CODE WHERE A.C_ACCOUNT_CODE IS NOT NULL",
)
def account_map_job(spark, sf_dir):
    from tidemark.plans.maps import MapJob

    apply_engine_conf(spark)
    accounts, customers = FX.account_source(spark, sf_dir), _staged(spark, FX.complete_customer_map(spark, sf_dir), "customers")
    job = MapJob("account-map", "", scratch_table(spark, "account-map"), KM.ACCOUNT_CODE, SALT, customers)
    return _job_twice(spark, job, accounts.filter("c_custkey % 3 <> 0"), accounts)


@query("cash_run_registers_customers", ORACLE["register_unknown_customers"])
def cash_run_registers_customers(spark, sf_dir):
    """A table run adds the customers that the map lacks; running its files again adds none."""
    from tidemark.fixtures import files as FF
    from tidemark.plans.pipeline import KeyLookup, Source, run_table

    apply_engine_conf(spark)
    root, target, known_map = scratch_path(spark, "lookup-landing"), scratch_table(spark, "lookup-table"), scratch_table(spark, "lookup-map")
    FF.write_dataset(spark, sf_dir, root, "BACK.0001", FX.ONE_BATCH)
    known = FX.customer_lookup(spark, sf_dir).select(KM.CUSTOMER_CODE, F.lit("known").alias(KM.CUSTOMER_MAP))
    append(spark, known, known_map)
    # The day partitions play no part here.
    spec = replace(CASH_TRANSACTIONS, partition=None, partition_source=None)
    for _ in range(2):
        run_table(spark, spec, Source(root=root, lookup=KeyLookup(known_map, SALT)), target)
    return read_table(spark, known_map).filter(F.col(KM.CUSTOMER_MAP) != "known")


# ---------------------------------------------------------------- schemas, files, registration (K6, K7, K8)


@query(
    "reconcile_nested",
    "SELECT o_orderkey AS k, o_orderstatus AS a, CASE WHEN o_orderkey % 2 = 0 THEN o_orderpriority END AS b, "
    "CAST(CAST(o_orderkey % 1000 AS DECIMAL(12, 2)) AS VARCHAR) AS amount, CASE WHEN o_orderkey % 2 = 0 THEN o_custkey END AS second FROM orders",
)
def reconcile_nested(spark, sf_dir):
    """The second batch has a field more in a struct and in the structs of an array, and narrower decimals; the third lacks them again."""
    status, priority, cust = F.col("o_orderstatus"), F.col("o_orderpriority"), F.col("o_custkey").cast("bigint")
    plain = {"s": F.struct(status.alias("a")), "l": F.array(F.struct(F.lit(1).alias("x"))), "amount": (F.col("o_orderkey") % 1000).cast("decimal(12,2)")}
    more = {"s": F.struct(priority.alias("b"), status.alias("a")), "l": F.array(F.struct(F.lit(1).alias("x"), cust.alias("y"))), "amount": (F.col("o_orderkey") % 1000).cast("decimal(8,1)")}
    batches = [(_batch(spark, sf_dir, "I", n + 1, where, **cols), SPEC) for n, (where, cols) in enumerate((("o_orderkey % 4 = 1", plain), ("o_orderkey % 2 = 0", more), ("o_orderkey % 4 = 3", plain)))]
    got = _stored(spark, batches)
    return got.select("k", "s.a", "s.b", F.col("amount").cast("string").alias("amount"), F.col("l")[0]["y"].alias("second"))


FILE_BYTES = 256 * 1024


@query(
    "file_sizes_bounded",
    "SELECT o_orderstatus AS p, count(*) AS n_rows, CAST(0 AS BIGINT) AS n_over, CAST(0 AS BIGINT) AS n_small_over_two FROM orders GROUP BY 1",
)
def file_sizes_bounded(spark, sf_dir):
    """Two merges into a table of small target files: no file is far above the target, and at most two of a partition are below half of it."""
    spec = replace(SPEC, file_bytes=FILE_BYTES)
    got = _stored(spark, [(_batch(spark, sf_dir, "I", 1), spec), (_batch(spark, sf_dir, "U", 2, "o_orderkey % 3 = 0"), spec)])
    files = got.groupBy("p", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_size").alias("size")).agg(F.count(F.lit(1)).alias("n"))
    small = F.count_if(F.col("size") < FILE_BYTES // 2)
    return files.groupBy("p").agg(
        F.sum("n").alias("n_rows"), F.count_if(F.col("size") > FILE_BYTES * 1.5).alias("n_over"), F.greatest(small - 2, F.lit(0)).cast("bigint").alias("n_small_over_two")
    )


@query("registered_after_append", "SELECT o_orderstatus AS p, count(*) AS n FROM orders GROUP BY 1")
def registered_after_append(spark, sf_dir):
    """Twelve appends to a table, which SQL then reads by its name."""
    table = scratch_table(spark, "appended")
    for n in range(12):
        append(spark, _batch(spark, sf_dir, "I", 1, f"o_orderkey % 12 = {n}").select("k", "p"), table)
    return spark.sql(f"SELECT p, count(*) AS n FROM {table} GROUP BY p")


# ---------------------------------------------------------------- a backlog as one merge

BATCHES = 5
_BACKLOG_SQL = f"""
WITH RECURSIVE c AS (
  SELECT o_orderkey AS k, b, (o_orderkey * 7 + b * b * 5) % 11 AS ts, CASE WHEN (o_orderkey * 3 + b) % 4 = 0 THEN 'D' ELSE 'U' END AS op
  FROM orders, range(1, {BATCHES + 1}) r(b) WHERE (o_orderkey + b) % 3 <> 0),
s AS (
  SELECT policy, o_orderkey AS k, 0 AS step, o_orderkey % 5 <> 0 AS live, o_orderkey % 5 <> 0 AS marked, (o_orderkey % 9) * 10 + 1 AS ord, o_orderkey % 9 AS ts, CAST(0 AS BIGINT) AS v
  FROM orders, (VALUES ('event_time'), ('arrival'), ('tombstones')) p(policy)
  UNION ALL
  SELECT policy, s.k, step + 1, CASE WHEN takes THEN op <> 'D' ELSE live END, CASE WHEN takes THEN policy = 'tombstones' OR op <> 'D' ELSE marked END,
         CASE WHEN takes THEN new_ord ELSE ord END, CASE WHEN takes THEN new_ts ELSE ts END, CASE WHEN takes THEN b ELSE v END
  FROM (
    SELECT s.*, c.b, c.op, c.ts AS new_ts, c.ts * 10 + CASE c.op WHEN 'D' THEN 3 ELSE 2 END AS new_ord,
           c.k IS NOT NULL AND (policy = 'arrival' OR NOT (marked AND ord > c.ts * 10 + CASE c.op WHEN 'D' THEN 3 ELSE 2 END)) AS takes
    FROM s LEFT JOIN c ON c.k = s.k AND c.b = s.step + 1) s
  WHERE step < {BATCHES})
SELECT policy, k, ts, v FROM s WHERE step = {BATCHES} AND live
"""


def _backlog(spark, sf_dir) -> DataFrame:
    """Changes of several batches, out of order, with deletes; not every key in every batch."""
    rows = FX.table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("k"), F.explode(F.sequence(F.lit(1).cast("bigint"), F.lit(BATCHES).cast("bigint"))).alias("b")).filter("(k + b) % 3 <> 0")
    ts = F.expr("(k * 7 + b * b * 5) % 11").cast("bigint")
    return rows.select("k", F.expr("CASE WHEN (k * 3 + b) % 4 = 0 THEN 'D' ELSE 'U' END").alias("op_type"), ts.alias("current_ts"), ts.alias("op_ts"), F.col("b").alias("v"), "b")


@query("backlog_merge", _BACKLOG_SQL)
def backlog_merge(spark, sf_dir):
    """Five batches merged as one leave what the batches in turn leave, under each late policy."""
    apply_engine_conf(spark)
    ts = (F.col("o_orderkey") % 9).cast("bigint")
    first = FX.table(spark, sf_dir, "orders").filter("o_orderkey % 5 <> 0").select(
        F.col("o_orderkey").alias("k"), F.lit("I").alias("op_type"), ts.alias("current_ts"), ts.alias("op_ts"), F.lit(0).cast("bigint").alias("v")
    )
    out = []
    for policy, more in (("event_time", {}), ("arrival", {"late_policy": "arrival"}), ("tombstones", {"keep_tombstones": True})):
        spec, table = TableSpec(name="backlog", keys=("k",), **more), scratch_table(spark, f"backlog-{policy}")
        merge_into(spark, first, spec, table)
        merge_into(spark, _backlog(spark, sf_dir), spec, table, batch="b")
        out.append(live_rows(read_table(spark, table)).select(F.lit(policy).alias("policy"), "k", F.col("current_ts").alias("ts"), "v"))
    return out[0].unionByName(out[1]).unionByName(out[2])


# ---------------------------------------------------------------- run state, streams, hooks, file order


@query(
    "run_state_subset",
    "WITH n AS (SELECT count(*) FILTER (o_orderkey % 2 = 0) AS even, count(*) FILTER (o_orderkey % 2 <> 0) AS odd FROM orders) "
    "SELECT 1 AS run_no, 'even' AS table_name, true AS ok, even AS rows_in, false AS waits FROM n UNION ALL SELECT 1, 'odd', false, 0, true FROM n "
    "UNION ALL SELECT 2, 'even', true, 0, false FROM n UNION ALL SELECT 3, 'even', true, 0, false FROM n UNION ALL SELECT 3, 'odd', true, odd, false FROM n",
)
def run_state_subset(spark, sf_dir):
    """A run over one of two tables leaves what the other, failed one waits for."""
    import time

    from tidemark.fixtures import files as FF
    from tidemark.plans.pipeline import Source, load_state, run_tables
    from tidemark.sinks.catalog import SCRATCH_DATABASE

    apply_engine_conf(spark)
    sources, targets, names = {}, {}, ("even", "odd")
    for n, name in enumerate(names):
        sources[name], targets[name] = Source(root=scratch_path(spark, f"state-{name}")), scratch_table(spark, f"state-{name}")
        rows = FX.table(spark, sf_dir, "orders").filter(f"o_orderkey % 2 = {n}")
        image = F.struct(F.col("o_orderkey").alias("k"), F.col("o_orderstatus").alias("v"))
        one = F.lit(1).cast("bigint")
        rows.select(F.lit("I").alias("op_type"), one.alias("op_ts"), one.alias("current_ts"), F.when(F.lit(False), image).alias("before"), image.alias("after")).write.parquet(
            f"{sources[name].root}/{FF.today()}/BACK.1"
        )
    time.sleep(1.1)
    state = scratch_table(spark, "state").split(".")[1]
    spark.sql(f"CREATE DATABASE {state} LOCATION '{scratch_path(spark, state)}'")

    def broken(df):
        raise RuntimeError("broken table step")

    good = {n: TableSpec(name=n, keys=("k",)) for n in names}
    runs = [[good["even"], replace(good["odd"], post=broken)], [good["even"]], [good["even"], good["odd"]]]
    out = []
    for k, specs in enumerate(runs, start=1):
        done = run_tables(spark, specs, sources, targets, state)
        waiting = list(load_state(spark, state).failed)
        out.append(done.select(F.lit(k).alias("run_no"), "table_name", "ok", "rows_in", F.col("table_name").isin(waiting).alias("waits")))
        time.sleep(1.1)
    return out[0].unionByName(out[1]).unionByName(out[2])


def _stream_metrics_sql(batch: int, suffix: str) -> str:
    return (
        f"SELECT 'cash_transactions' AS table_name, CAST({batch} AS BIGINT) AS batch_id, count(*) AS rows_in, count(*) FILTER (op_type = 'I') AS inserts, "
        f"count(*) FILTER (op_type = 'U') AS updates, count(*) FILTER (op_type = 'D') AS deletes, count(*) FILTER (op_type = 'R') AS snapshots FROM E{suffix}"
    )


@query(
    "stream_run_metrics",
    S.with_ctes(S.IMG_CTE, *S.batch_ctes(FX.BATCH_ONE, "1"), *S.batch_ctes(FX.BATCH_TWO, "2")) + _stream_metrics_sql(0, "1") + " UNION ALL " + _stream_metrics_sql(1, "2"),
)
def stream_run_metrics(spark, sf_dir):
    """One row of counts per micro-batch of a stream, from its listener."""
    import time

    from tidemark.streaming import StreamMetrics, change_stream, stream_table

    apply_engine_conf(spark)
    root, table, kept = scratch_path(spark, "metrics-landing"), scratch_table(spark, "metrics-table"), scratch_table(spark, "stream-metrics")
    for name, parts in (("BACK.0001", FX.BATCH_ONE), ("BACK.0002", FX.BATCH_TWO)):
        FX.change_envelope(spark, sf_dir, parts).coalesce(1).write.parquet(f"{root}/{name}")
        time.sleep(1.1)
    stream = change_stream(spark, f"{root}/BACK.*", spark.read.parquet(f"{root}/BACK.0001").schema, max_files_per_trigger=1)
    metrics = StreamMetrics()
    spark.streams.addListener(metrics)
    try:
        spec = replace(CASH_TRANSACTIONS, partition=None, partition_source=None)
        stream_table(spark, spec, stream, table, scratch_path(spark, "metrics-ckpt")).awaitTermination()
        limit = time.monotonic() + 30
        while len(metrics.rows()) < 2 and time.monotonic() < limit:  # events arrive a moment later
            time.sleep(0.1)
    finally:
        spark.streams.removeListener(metrics)
    metrics.flush(spark, kept)
    return read_table(spark, kept).select("table_name", "batch_id", "rows_in", "inserts", "updates", "deletes", "snapshots")


@query("table_step_hook", S.cash_ctes() + ", " + S.latest_cte() + " SELECT CASE WHEN C_AMOUNT >= 150000 THEN 'large' ELSE 'small' END AS size, count(*) AS n FROM L WHERE op_type <> 'D' GROUP BY 1")
def table_step_hook(spark, sf_dir):
    """A table's own step adds a column to its changes before they are merged."""
    from tidemark.operators.changes import prepare_changes

    apply_engine_conf(spark)
    size = F.when(F.col("C_AMOUNT") >= 150000, "large").otherwise("small")
    spec = replace(CASH_TRANSACTIONS, post=lambda df: df.withColumn("size", size))
    merged = apply_changes(None, prepare_changes(FX.change_envelope(spark, sf_dir), spec), spec.keys, spec.ordering)
    return merged.groupBy("size").agg(F.count(F.lit(1)).alias("n"))


@query("files_in_order", S.with_ctes(S.file_listing_cte()) + "SELECT path, row_number() OVER (ORDER BY mtime, path) - 1 AS place FROM FILES")
def files_in_order(spark, sf_dir):
    """Files by time, then by path."""
    from tidemark.operators.ordinal import running
    from tidemark.sources import files as FS

    apply_engine_conf(spark)
    return running(FS.order_files(FX.file_listing(spark, sf_dir)), ["mtime", "path"], ordinal="place").select("path", "place")
