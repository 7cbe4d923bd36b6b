"""The range-split rule on any DataFrame with a shard column (lake tables).

* :func:`lake_shard_stats` - ``groupBy(shard).agg(min, max, count)``: partial
  aggregation per task, so a shard holding a third of all rows costs no more
  than any other.
* :func:`lake_split_plan` - the ranges each shard would be cut into.
* :func:`assign_splits` - the split number of every row: the statistics (one row per
  shard, from one pass over the keys) are written once to the session's checkpoint
  folder and joined to the rows, whatever the number of shards.  Their size in bytes is then known
  to the planner: up to ``spark.sql.autoBroadcastJoinThreshold`` they are broadcast, beyond that a
  sort-merge join runs, whose hot shards adaptive execution splits.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shardscan.functions import ranges as R
from shardscan.plans import splits as P
from shardscan.session import checkpoint_dir


def _cols(shard_cols: str | Sequence[str] | None) -> list[str]:
    if shard_cols is None:
        return []
    if isinstance(shard_cols, str):
        return [shard_cols]
    return list(shard_cols)


def lake_shard_stats(df: DataFrame, shard_cols: str | Sequence[str] | None, key: str) -> DataFrame:
    """``shard_cols..., mn, mx, n`` - key bounds and row count (NULL keys counted in ``n``)."""
    cols = _cols(shard_cols)
    P.key_limits(df.schema[key].dataType)
    return df.groupBy(*cols).agg(
        F.min(key).alias("mn"), F.max(key).alias("mx"), F.count(F.lit(1)).alias("n")
    )


def lake_split_plan(df: DataFrame, shard_cols: str | Sequence[str] | None, key: str, *,
                    batch_size: int | None = None, partition_num: int | None = None) -> DataFrame:
    """``shard_cols..., split_no, lo, hi`` for every shard of ``df``."""
    cols = _cols(shard_cols)
    stats = lake_shard_stats(df, cols, key)
    return P.plan_splits(stats, cols, key_type=df.schema[key].dataType,
                         batch_size=batch_size, partition_num=partition_num, spread=True)


def assign_splits(df: DataFrame, shard_cols: str | Sequence[str] | None, key: str, *,
                  batch_size: int | None = None, partition_num: int | None = None,
                  split_col: str = "split_no") -> DataFrame:
    """``df`` plus ``split_col``: the split each row falls in (NULL for a NULL key)."""
    cols = _cols(shard_cols)
    key_type = df.schema[key].dataType
    P.key_limits(key_type)
    stats = P.with_steps(lake_shard_stats(df, cols, key), batch_size=batch_size,
                         partition_num=partition_num)
    k = F.col(key)
    if not cols:
        row = stats.first()  # a global aggregate: exactly one row, or none when all keys are NULL
        if row is None:
            return df.withColumn(split_col, F.lit(None).cast("bigint"))
        mn, mx, step = (F.lit(str(v)).cast(R.DEC) for v in (row.mn, row.mx, row.step))
        idx = R.split_index(k, mn, mx, step)
        return df.withColumn(split_col, idx)

    stats = stats.select(*cols, "mn", "mx", "step")
    path = f"{checkpoint_dir(df.sparkSession).rstrip('/')}/shard-stats-{uuid.uuid4().hex}"
    stats.write.parquet(path)
    return _join_stats(df, df.sparkSession.read.schema(stats.schema).parquet(path), cols, k, split_col)


def _join_stats(df: DataFrame, stats: DataFrame, cols: Sequence[str], k: Column, split_col: str) -> DataFrame:
    # per-shard parts of the split arithmetic are computed on the (small) stats side
    s = stats.select(*[F.col(c).alias(f"_s_{c}") for c in cols],
                     F.col("mn").alias("_s_mn"), F.col("step").alias("_s_step"),
                     R.fast_span(F.col("mn"), F.col("mx")).alias("_s_fast"),
                     R.step_width(F.col("step")).alias("_s_w"))
    on = reduce(lambda a, b: a & b, [df[c].eqNullSafe(s[f"_s_{c}"]) for c in cols])
    j = df.join(s, on, "left")
    idx = R.split_index_prepared(k, F.col("_s_fast"), F.col("_s_mn"), F.col("_s_w"), F.col("_s_step"))
    return j.withColumn(split_col, idx).drop(*[f"_s_{c}" for c in cols], "_s_mn", "_s_step",
                                               "_s_fast", "_s_w")
