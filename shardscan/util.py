"""Small DataFrame helpers."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable, Sequence
from concurrent.futures import ThreadPoolExecutor
from typing import TypeVar

from pyspark.sql import DataFrame, SparkSession

from shardscan.session import checkpoint_dir

T = TypeVar("T")
R = TypeVar("R")

DRIVER_THREADS = 4


def parallel_map(fn: Callable[[T], R], items: Iterable[T], threads: int = DRIVER_THREADS) -> list[R]:
    """``map`` on a few driver threads, order kept.

    For building DataFrames whose creation waits on a server round trip
    (a JDBC source resolves its schema when created); serial for one item.
    """
    items = list(items)
    if len(items) <= 1:
        return [fn(i) for i in items]
    with ThreadPoolExecutor(min(threads, len(items))) as pool:
        return list(pool.map(fn, items))


def balanced_union(parts: Sequence[DataFrame]) -> DataFrame:
    """``UNION ALL`` of many frames as a balanced tree.

    A left-deep chain re-analyses the growing plan at every step (quadratic
    in the number of parts); a balanced tree keeps analysis near linear.
    Catalyst flattens the result into one ``Union`` node either way.
    """
    if not parts:
        raise ValueError("nothing to union")
    level = list(parts)
    while len(level) > 1:
        nxt = [level[i].union(level[i + 1]) for i in range(0, len(level) - 1, 2)]
        if len(level) % 2:
            nxt.append(level[-1])
        level = nxt
    return level[0]


def work_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared checkpoint folder."""
    return f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a fresh table below the shared checkpoint folder, read back: computed once, whatever reads it,
    and a lost executor takes nothing with it."""
    spark = df.sparkSession
    path = work_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
