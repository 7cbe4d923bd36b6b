"""Running sums over an order, without one task that sees a whole group.

The rows are range-partitioned by (group, order) and written with their partition number;
inside a partition a window adds up, and the totals of the partitions before it, one small row per partition and
group, are added on top.  A group of any size is spread over as many tasks as it has partitions.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shardscan.util import written

PART = "_part"


def joined(left: DataFrame, right: DataFrame, cols: Sequence[str], how: str) -> DataFrame:
    """``left`` joined to ``right`` where ``cols`` are equal or both null; ``right``'s copies of them do not come along
    (the two may come from one table, so columns are told apart by name only)."""
    right = right.withColumnsRenamed({c: f"_on_{c}" for c in cols})
    on = reduce(lambda x, y: x & y, [F.col(c).eqNullSafe(F.col(f"_on_{c}")) for c in cols])
    out = left.join(right, on, how)
    return out if how in ("left_semi", "left_anti") else out.drop(*[f"_on_{c}" for c in cols])


def running_sums(df: DataFrame, group: Sequence[str], order: Sequence[str], sums: dict[str, str]) -> DataFrame:
    """``df`` with a column ``out`` for each ``out: value`` of ``sums``: the sum of ``value`` over the group's rows
    up to and including this one (nulls count as zero).  ``order`` must tell the rows of a group apart."""
    group = list(group)
    table = written(df.repartitionByRange(*group, *order).withColumn(PART, F.spark_partition_id()), "ordered")
    inside = Window.partitionBy(PART, *group).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    totals = table.groupBy(PART, *group).agg(*[F.sum(v).alias(out) for out, v in sums.items()])
    earlier = Window.partitionBy(*(group or [F.lit(0)])).orderBy(PART).rowsBetween(Window.unboundedPreceding, -1)
    before = totals.select(PART, *group, *[F.sum(out).over(earlier).alias(f"_before_{out}") for out in sums])
    local = table.select("*", *[F.sum(v).over(inside).alias(f"_in_{out}") for out, v in sums.items()])
    zero = F.lit(0)
    return joined(local, before, [PART, *group], "left").select(*df.columns, *[
        (F.coalesce(f"_before_{out}", zero) + F.coalesce(f"_in_{out}", zero)).alias(out) for out in sums])
