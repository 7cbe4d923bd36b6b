"""The range-split rule as Spark column expressions.

For one shard with key bounds ``[mn, mx]`` and ``n`` rows:

* batch-size mode ``B``: ``step = mx - mn`` if ``B > n`` else ``(mx - mn) * B div n``
* partition-count mode ``N``: ``step = (mx - mn) div N``
* split ``i`` covers the inclusive range ``[mn + i*(step+1), mn + i*(step+1) + step]``
  for ``i = 0 .. (mx - mn) div (step + 1)``; the last ``hi`` may pass ``mx``
  and is saturated at the key type's maximum.

All bound arithmetic runs in ``DECIMAL(38,0)`` so that a span of the full
BIGINT range (up to 2^64-1) and ``span * B`` never overflow, with or without
ANSI mode.  Integer division of non-negative decimals is done exactly as
``(a - a % b) / b``.  The per-row helper :func:`split_index` keeps a BIGINT
fast path for the (usual) spans below 2^62.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

DEC = DecimalType(38, 0)
LONG_MAX = 2**63 - 1
LONG_MIN = -(2**63)
# spans up to this use BIGINT arithmetic per row; wider spans use decimals
_FAST_SPAN = 2**62


def _dec(c: Column | int) -> Column:
    if isinstance(c, int):
        # via text: a Python int beyond 64 bits cannot travel as a long literal
        return F.lit(str(c)).cast(DEC)
    return c.cast(DEC)


def idiv(a: Column, b: Column) -> Column:
    """Exact truncating division of non-negative decimals -> DECIMAL(38,0)."""
    a, b = _dec(a), _dec(b)
    return ((a - a % b) / b).cast(DEC)


def span(mn: Column, mx: Column) -> Column:
    return (_dec(mx) - _dec(mn)).cast(DEC)


def step_for_batch(mn: Column, mx: Column, n: Column, batch_size: int) -> Column:
    s = span(mn, mx)
    b = F.lit(int(batch_size)).cast(DEC)
    return F.when(b > _dec(n), s).otherwise(idiv(s * b, _dec(n))).cast(DEC)


def step_for_partitions(mn: Column, mx: Column, partition_num: int) -> Column:
    return idiv(span(mn, mx), F.lit(int(partition_num)))


def step_expr(mn: Column, mx: Column, n: Column | None, *, batch_size: int | None = None,
              partition_num: int | None = None) -> Column:
    if (batch_size is None) == (partition_num is None):
        raise ValueError("exactly one of batch_size and partition_num must be given")
    if batch_size is not None:
        if batch_size < 1:
            raise ValueError(f"batch_size must be >= 1, got {batch_size}")
        if n is None:
            raise ValueError("batch-size mode needs the row count")
        return step_for_batch(mn, mx, n, batch_size)
    if partition_num < 1:
        raise ValueError(f"partition_num must be >= 1, got {partition_num}")
    return step_for_partitions(mn, mx, partition_num)


def split_count(mn: Column, mx: Column, step: Column) -> Column:
    """Number of ranges; BIGINT (it is at most span+1 and bounded by the plan guard)."""
    return (idiv(span(mn, mx), _dec(step) + 1) + 1).cast("bigint")


def split_lo(mn: Column, step: Column, i: Column) -> Column:
    """Lower bound of split ``i``; never above ``mx`` so it fits the key type."""
    return (_dec(mn) + _dec(i) * (_dec(step) + 1)).cast(DEC)


def split_hi(mn: Column, step: Column, i: Column, max_value: int = LONG_MAX) -> Column:
    """Upper bound of split ``i``, saturated at ``max_value``."""
    hi = split_lo(mn, step, i) + _dec(step)
    return F.least(hi, _dec(max_value)).cast(DEC)


def long_div(a: Column, b: Column) -> Column:
    """SQL ``a div b``: integral division, stays a BIGINT expression."""
    return F.call_function("div", a.cast("bigint"), b.cast("bigint"))


def fast_span(mn: Column, mx: Column) -> Column:
    """True when a shard's keys and span allow BIGINT arithmetic per row."""
    return (
        (span(mn, mx) < _dec(_FAST_SPAN))
        & (_dec(mn) >= _dec(LONG_MIN))
        & (_dec(mx) <= _dec(LONG_MAX))
    )


def split_index(key: Column, mn: Column, mx: Column, step: Column) -> Column:
    """Split number of a key inside its shard: ``(key - mn) div (step + 1)``.

    BIGINT arithmetic when the shard's span is below 2^62 (the usual case; it
    stays inside whole-stage codegen), exact decimals otherwise.
    """
    return split_index_prepared(key, fast_span(mn, mx), mn, step_width(step), step)


def step_width(step: Column) -> Column:
    """``step + 1`` as BIGINT, NULL when it does not fit (the decimal path is used then)."""
    return F.when(_dec(step) < _dec(_FAST_SPAN), (_dec(step) + 1).cast("bigint"))


def split_index_prepared(key: Column, fast: Column, mn: Column, width: Column, step: Column) -> Column:
    """:func:`split_index` with the per-shard parts (``fast``, ``width``) computed
    once per shard instead of once per row."""
    quick = long_div(key.cast("bigint") - mn.cast("bigint"), width)
    slow = idiv(_dec(key) - _dec(mn), _dec(step) + 1).cast("bigint")
    return F.when(fast, quick).otherwise(slow)
