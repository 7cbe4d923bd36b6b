"""shardscan: one logical table over many sharded databases, as a Spark DataFrame.

Public API::

    sharded_scan(spark, schema, options)   # the bag union of every matched shard
    split_plan(spark, schema, options)     # planned splits as a DataFrame
    shard_stats(spark, options)            # key bounds and row counts per shard
    discover_shards(spark, options)        # matched (server, schema, table)
    register_view(spark, name, schema, options)

    lake_shard_stats / lake_split_plan / assign_splits  # the same rule on any DataFrame
    split_row_counts / skew_report / scan_report        # plan quality reports
    split_row_counts_in_db / skew_report_in_db(spark, schema, options)  # the same, counted in the databases

    distributed_split_plan / equal_depth_plan(spark, schema, options)   # split plans as tables, made by tasks
    read_split_plan(spark, plan, schema, options)   # ... and read by tasks (DB-API drivers)
    check_split_plan / prune_split_plan             # each key in exactly one split; splits that meet key ranges
    sharded_aggregate / sharded_top_k               # computed in the shards, merged by Spark
    co_sharded_join                                 # two logical tables cut by one key, split by split, no shuffle
    differing_ranges / except_all                   # two copies compared by checksums, rows only where they differ

The flat DB-API backend registers as the Python data source ``sharded_dbapi``
(:func:`shardscan.sources.dbapi.register`).
"""

from shardscan.operators.compare import differing_ranges, except_all
from shardscan.operators.cosharded import co_sharded_join
from shardscan.operators.coverage import check_split_plan, prune_split_plan
from shardscan.operators.equal_depth import equal_depth_plan
from shardscan.operators.lake import assign_splits, lake_shard_stats, lake_split_plan
from shardscan.operators.report import scan_report, skew_report, split_row_counts
from shardscan.options import ScanOptions
from shardscan.sources.discovery import discover_shards as _discover
from shardscan.sources.jdbc import (
    plan_scan,
    register_view,
    shard_stats,
    sharded_scan,
    skew_report_in_db,
    split_plan,
    split_row_counts_in_db,
)
from shardscan.sources.pushdown import sharded_aggregate, sharded_top_k
from shardscan.sources.stored import distributed_split_plan, read_split_plan, scan_by_stored_plan


def discover_shards(spark, options=None, **kwargs):
    """``url_no, server, schema_name, table_name, table_type`` of every matched table."""
    from shardscan.sources.jdbc import as_options

    return _discover(spark, as_options(options, **kwargs))


__all__ = [
    "ScanOptions",
    "assign_splits",
    "check_split_plan",
    "co_sharded_join",
    "differing_ranges",
    "discover_shards",
    "distributed_split_plan",
    "equal_depth_plan",
    "except_all",
    "lake_shard_stats",
    "lake_split_plan",
    "plan_scan",
    "prune_split_plan",
    "read_split_plan",
    "register_view",
    "scan_by_stored_plan",
    "scan_report",
    "shard_stats",
    "sharded_aggregate",
    "sharded_scan",
    "sharded_top_k",
    "skew_report",
    "skew_report_in_db",
    "split_plan",
    "split_row_counts",
    "split_row_counts_in_db",
]
