import re

from pyspark.sql import functions as F

from tidemark.fixtures import frames as FX
from tidemark.operators.changes import prepare_changes
from tidemark.operators.merge import apply_changes, latest_per_key
from tidemark.sources.readers import read_changes
from tidemark.tables import CASH_TRANSACTIONS

from conftest import SF001


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_op_filter_and_pruning_reach_the_scan(spark, tmp_dir):
    path = f"{tmp_dir}/env"
    FX.change_envelope(spark, SF001).write.parquet(path)
    ch = prepare_changes(read_changes(spark, [path]), CASH_TRANSACTIONS)
    p = ch._jdf.queryExecution().sparkPlan().toString()
    assert "PushedFilters: [In(op_type, [D,I,R,U])" in p or "In(op_type" in p


def test_latest_per_key_combines_map_side(spark):
    ch = prepare_changes(FX.change_envelope(spark, SF001), CASH_TRANSACTIONS)
    p = latest_per_key(ch, ["PK_CASH_TRANSACTION"])._jdf.queryExecution().sparkPlan().toString()
    # One aggregate on the map side and one on the key; no window, no join.
    assert re.findall(r"(?:Hash|Sort)Aggregate|Window|Join", p) == ["SortAggregate", "SortAggregate"], p
    assert "partial_max_by" in p


def test_small_batch_is_broadcast_and_stored_side_not_shuffled(spark):
    stored = spark.read.parquet(f"{SF001}/orders.parquet").select(
        F.col("o_orderkey").alias("PK_CASH_TRANSACTION"), F.lit("I").alias("op_type"),
        F.lit(0).cast("bigint").alias("current_ts"), F.lit(0).cast("bigint").alias("op_ts"), F.col("o_orderstatus").alias("C_STATUS"),
    )
    batch = stored.limit(10).withColumn("op_type", F.lit("U")).withColumn("current_ts", F.lit(1).cast("bigint"))
    merged = apply_changes(stored, batch, ["PK_CASH_TRANSACTION"], broadcast_batch=True)
    p = plan(merged)
    assert "BroadcastHashJoin" in p
    assert "SortMergeJoin" not in p
