"""Physical-plan properties that matter at scale, read from the executed plan."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from shardscan import assign_splits, lake_split_plan

SF = "/root/testdata/sf0.001"


@pytest.fixture(autouse=True)
def long_metadata(spark):
    old = spark.conf.get("spark.sql.maxMetadataStringLength")
    spark.conf.set("spark.sql.maxMetadataStringLength", "10000")
    yield
    spark.conf.set("spark.sql.maxMetadataStringLength", old)


def plan_text(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_filter_and_pruning_reach_every_shard(spark):
    df = E.q22_filter_over_view(spark, SF)
    text = plan_text(df)
    assert text.count("Scan JDBCRelation") == 4
    assert text.count("ReadSchema: struct<o_orderkey:bigint>") == 4
    assert text.count("GreaterThan(o_totalprice,250000.0)") == 4
    assert text.count("EqualTo(o_orderstatus,O)") == 4


def test_partial_aggregation_below_the_exchange(spark):
    df = E.q23_group_over_view(spark, SF)
    df.collect()
    text = df._jdf.queryExecution().executedPlan().toString()
    # the tree prints top-down: the final count, then the shuffle, then the partial count below it
    assert "partial_count" in text
    shuffle = text.find("ShuffleQueryStage") if "ShuffleQueryStage" in text else text.find("Exchange")
    assert 0 <= shuffle < text.index("partial_count")


def test_limit_goes_below_the_union(spark):
    df = E.q01_scan_bag(spark, SF).limit(5)
    optimized = df._jdf.queryExecution().optimizedPlan().toString()
    assert optimized.count("LocalLimit") >= 4
    assert df.count() == 5


def test_stats_broadcast_and_codegen_arithmetic(spark):
    ev = spark.read.parquet(f"{SF}/events.parquet")
    text = plan_text(assign_splits(ev, "event_type", "event_id", partition_num=8))
    assert "BroadcastHashJoin" in text and "SortMergeJoin" not in text
    assert " div " in text  # BIGINT split arithmetic per row


def test_stats_join_follows_their_size_in_bytes(spark):
    """One path whatever the number of shards: the planner broadcasts the written statistics by their size."""
    li = spark.read.parquet(f"{SF}/lineitem.parquet")
    assert "BroadcastHashJoin" in plan_text(assign_splits(li, "l_suppkey", "l_orderkey", batch_size=10))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan_text(assign_splits(li, "l_suppkey", "l_orderkey", batch_size=10))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "SortMergeJoin" in text and "Broadcast" not in text


def test_plan_expansion_is_spread(spark):
    orders = spark.read.parquet(f"{SF}/orders.parquet").select(
        (F.col("o_orderkey") % 4).alias("shard"), "o_orderkey")
    text = plan_text(lake_split_plan(orders, "shard", "o_orderkey", batch_size=1))
    assert text.count("Generate") == 2 and "REPARTITION_BY_COL" in text


def test_provenance_filter_prunes_shards(spark):
    df = E.q21_provenance(spark, SF).where(F.col("tbl") == "ORDERS_1")
    optimized = df._jdf.queryExecution().optimizedPlan().toString()
    assert optimized.count("JDBCRelation") == 1
    assert df.count() > 0
