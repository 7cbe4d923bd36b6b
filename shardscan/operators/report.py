"""Plan quality reports: scan counters, rows per split, skew per shard."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shardscan.sources.discovery import schemas
from shardscan.operators.lake import _cols, assign_splits


def scan_report(spark: SparkSession, plan, by: str = "server") -> DataFrame:
    """Per server: ``url_no, server, n_schemas, n_tables, n_splits``; with ``by='schema'``
    ``url_no, server, schema_name, n_tables, n_splits``, one row for every matched schema.

    ``plan`` is a :class:`shardscan.sources.jdbc.ScanPlan`; schemas that match
    count with or without a matched table, tables that are matched but empty
    count as tables with no splits, servers without a match as servers with
    no tables.
    """
    if by not in ("server", "schema"):
        raise ValueError("by must be 'server' or 'schema'")
    opts = plan.opts
    rows = [(i, opts.redact(u), None, 0, 0) for i, u in enumerate(opts.urls)]  # a row for every server
    rows += [(s.url_no, opts.redact(s.url), s.schema, 1, len(plan.splits.get(i, ())))
             for i, s in enumerate(plan.shards)]
    per_shard = spark.createDataFrame(
        rows, "url_no int, server string, schema_name string, is_shard int, k bigint")
    if not opts.query or "{table}" in opts.query:  # schemas that match but hold no matched table count
        servers = per_shard.where("is_shard = 0").select("url_no", "server")
        bare = schemas(spark, opts).join(servers, "url_no").select(
            "url_no", "server", "schema_name", F.lit(0).alias("is_shard"), F.lit(0).cast("bigint").alias("k"))
        per_shard = per_shard.unionByName(bare)
    totals = [F.sum("is_shard").cast("bigint").alias("n_tables"), F.sum("k").cast("bigint").alias("n_splits")]
    if by == "schema":  # a server without a matched schema, or a query source, has none to report
        return per_shard.where(F.col("schema_name").isNotNull()).groupBy("url_no", "server", "schema_name").agg(*totals)
    return per_shard.groupBy("url_no", "server").agg(F.countDistinct("schema_name").alias("n_schemas"), *totals)


def split_row_counts(df: DataFrame, shard_cols: str | Sequence[str] | None, key: str, *,
                     batch_size: int | None = None, partition_num: int | None = None,
                     null_key: str = "drop", **kw) -> DataFrame:
    """``shard_cols..., split_no, n_rows`` - rows each planned split would read.

    Only non-empty splits appear.  NULL keys are in no split (``null_key='drop'``)
    or in a ``split_no`` NULL group (``'keep'``).
    """
    cols = _cols(shard_cols)
    slim = df.select(*cols, key)
    a = assign_splits(slim, cols, key, batch_size=batch_size, partition_num=partition_num, **kw)
    if null_key == "drop":
        a = a.where(F.col(key).isNotNull())
    elif null_key != "keep":
        raise ValueError("null_key must be 'drop' or 'keep'")
    return a.groupBy(*cols, "split_no").agg(F.count(F.lit(1)).alias("n_rows"))


def skew_report(df: DataFrame, shard_cols: str | Sequence[str] | None, key: str, *,
                batch_size: int | None = None, partition_num: int | None = None,
                **kw) -> DataFrame:
    """Per shard: ``max_rows`` (largest split), ``total_rows``, ``nonempty_splits``,
    ``avg_rows`` (per non-empty split)."""
    cols = _cols(shard_cols)
    c = split_row_counts(df, cols, key, batch_size=batch_size, partition_num=partition_num, **kw)
    return c.groupBy(*cols).agg(
        F.max("n_rows").alias("max_rows"),
        F.sum("n_rows").cast("bigint").alias("total_rows"),
        F.count(F.lit(1)).alias("nonempty_splits"),
        F.avg("n_rows").alias("avg_rows"),
    )
