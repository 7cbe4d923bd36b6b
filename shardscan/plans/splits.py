"""Split planning: shard statistics -> split plan, all as DataFrames.

``stats`` has one row per shard: the shard's identifying columns plus
``mn``, ``mx`` (key bounds) and, in batch-size mode, ``n`` (row count).
Empty shards (``mn`` or ``mx`` NULL) get no splits.

The plan is produced by a two-level ``explode(sequence(...))`` so no single
row ever holds an array of more than ``chunk`` split numbers, however many
splits one shard has; chunks are hash-spread before the second explode so a
shard with millions of ranges is expanded by many tasks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DecimalType, IntegralType

from shardscan.functions import ranges as R

CHUNK = 65_536


def key_limits(key_type: DataType) -> tuple[int, int]:
    """Smallest and largest value a key of this type can take."""
    if isinstance(key_type, DecimalType):
        if key_type.scale != 0:
            raise ValueError(f"partition column must be integral, got {key_type.simpleString()}")
        top = 10 ** key_type.precision - 1
        return -top, top
    if isinstance(key_type, IntegralType):
        # lo/hi are reported as BIGINT whatever the integral width
        return R.LONG_MIN, R.LONG_MAX
    raise ValueError(
        f"partition column must be an integer type, got {key_type.simpleString()}"
    )


def bound_type(key_type: DataType) -> str:
    return "bigint" if isinstance(key_type, IntegralType) else key_type.simpleString()


def with_steps(stats: DataFrame, *, batch_size: int | None = None,
               partition_num: int | None = None) -> DataFrame:
    """Add ``step`` (DECIMAL(38,0)) and ``n_splits`` (BIGINT); drop empty shards."""
    n = F.col("n") if "n" in stats.columns else None
    step = R.step_expr(F.col("mn"), F.col("mx"), n, batch_size=batch_size,
                       partition_num=partition_num)
    return (
        stats.where(F.col("mn").isNotNull() & F.col("mx").isNotNull())
        .withColumn("step", step)
        .withColumn("n_splits", R.split_count(F.col("mn"), F.col("mx"), F.col("step")))
    )


def explode_splits(stepped: DataFrame, shard_cols: Sequence[str], *, key_type: DataType,
                   spread: bool = True, chunk: int = CHUNK) -> DataFrame:
    """One row per split: ``shard_cols..., split_no, lo, hi`` (+ stepped extras).

    ``stepped`` comes from :func:`with_steps`.
    """
    _, top = key_limits(key_type)
    btype = bound_type(key_type)
    n_chunks = R.long_div(F.col("n_splits") - 1, F.lit(chunk)) + 1
    chunks = stepped.withColumn("_chunk", F.explode(F.sequence(F.lit(0).cast("bigint"), n_chunks - 1)))
    if spread:
        chunks = chunks.repartition(*[F.col(c) for c in shard_cols], F.col("_chunk"))
    first = F.col("_chunk") * chunk
    last = F.least(first + chunk, F.col("n_splits")) - 1
    out = chunks.withColumn("split_no", F.explode(F.sequence(first, last))).drop("_chunk")
    return (
        out.withColumn("lo", R.split_lo(F.col("mn"), F.col("step"), F.col("split_no")).cast(btype))
        .withColumn("hi", R.split_hi(F.col("mn"), F.col("step"), F.col("split_no"), top).cast(btype))
    )


def plan_splits(stats: DataFrame, shard_cols: Sequence[str], *, key_type: DataType,
                batch_size: int | None = None, partition_num: int | None = None,
                spread: bool = True) -> DataFrame:
    """Shard statistics -> ``shard_cols..., split_no, lo, hi``."""
    stepped = with_steps(stats, batch_size=batch_size, partition_num=partition_num)
    out = explode_splits(stepped, shard_cols, key_type=key_type, spread=spread)
    return out.select(*shard_cols, "split_no", "lo", "hi")
