"""The range-split rule on Python integers.

Used where no Spark session exists (the planner of the DB-API data source
runs in a Python worker) and as the brute-force oracle in tests.  The Spark
column form lives in :mod:`shardscan.functions.ranges`.
"""

from __future__ import annotations


def step_of(mn: int, mx: int, n: int | None, *, batch_size: int | None = None,
            partition_num: int | None = None) -> int:
    if (batch_size is None) == (partition_num is None):
        raise ValueError("exactly one of batch_size and partition_num must be given")
    span = mx - mn
    if batch_size is not None:
        if batch_size < 1:
            raise ValueError(f"batch_size must be >= 1, got {batch_size}")
        if n is None:
            raise ValueError("batch-size mode needs the row count")
        return span if batch_size > n else span * batch_size // n
    if partition_num < 1:
        raise ValueError(f"partition_num must be >= 1, got {partition_num}")
    return span // partition_num


def split_count(mn: int | None, mx: int | None, n: int | None = None, *,
                batch_size: int | None = None, partition_num: int | None = None) -> int:
    """Number of ranges :func:`split_ranges` would return (without building them)."""
    if mn is None or mx is None:
        return 0
    step = step_of(mn, mx, n, batch_size=batch_size, partition_num=partition_num)
    return (mx - mn) // (step + 1) + 1


def split_ranges(mn: int | None, mx: int | None, n: int | None = None, *,
                 batch_size: int | None = None, partition_num: int | None = None,
                 top: int = 2**63 - 1) -> list[tuple[int, int]]:
    """Inclusive ``(lo, hi)`` ranges covering ``[mn, mx]``; ``[]`` for an empty shard."""
    if mn is None or mx is None:
        return []
    step = step_of(mn, mx, n, batch_size=batch_size, partition_num=partition_num)
    count = (mx - mn) // (step + 1) + 1
    return [(mn + i * (step + 1), min(mn + i * (step + 1) + step, top)) for i in range(count)]
