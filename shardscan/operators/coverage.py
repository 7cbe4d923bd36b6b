"""Exactly-once check of a split plan, and pruning a plan by key ranges: both are sweeps over the key axis.

The check lays the starts (+1) and ends (-1) of all splits and the live keys (+0) on one axis per
shard and salt bucket.  The running sum of the steps is the number of splits over each key.  It must be 1
everywhere: 0 is a gap, 2 or more an overlap, and the keys counted in such a stretch are lost or read
more than once.  The running sums are :func:`~shardscan.operators.prefix.running_sums`, so a shard with millions of
splits or most of the keys is still many tasks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shardscan.operators.prefix import joined, running_sums
from shardscan.plans.key_ranges import KeyRanges
from shardscan.util import written

DEC = "decimal(38,0)"
SHARD = ("url_no", "schema_name", "table_name")
FAULTS = ("gap", "overlap", "inverted", "missing_bucket", "unknown_bucket", "null_keys_unread", "null_keys_repeated", "null_keys_unexpected")


def check_split_plan(plan: DataFrame, keys: DataFrame, key: str, *, shard_cols: Sequence[str] = SHARD, salt_buckets: int = 1,
                     salt: str | None = None, null_key: str = "drop") -> DataFrame:
    """The faults of ``plan`` against the live ``keys``; no row when each key is in exactly one split.

    ``plan``: ``shard_cols, lo, hi`` and, when salted, ``bucket``; a split with null ``lo`` and ``hi`` reads the NULL keys.
    ``keys``: ``shard_cols`` and the column ``key`` (and ``salt``, to look only at the bucket a row falls in; without it
    every bucket must cover every key).

    Result: ``shard_cols, bucket, fault, lo, hi, depth, n_keys`` with ``depth`` the number of splits over the stretch
    ``[lo, hi]`` and ``n_keys`` the rows whose key lies in it.  Faults: ``gap`` (also one without a key, between
    two splits: a later row would be lost there; before the first and after the last split only where keys lie), ``overlap``,
    ``inverted`` (lo above hi, or only one of them null), ``missing_bucket``, ``unknown_bucket``, and for NULL keys
    ``null_keys_unread``, ``null_keys_repeated`` and ``null_keys_unexpected``."""
    if null_key not in ("drop", "keep"):
        raise ValueError("null_key must be 'drop' or 'keep'")
    shard = list(shard_cols)
    group = [*shard, "bucket"]
    bucket = F.coalesce(F.col("bucket"), F.lit(0)).cast("int") if "bucket" in plan.columns else F.lit(0)
    splits = written(plan.select(*shard, bucket.alias("bucket"), F.col("lo").cast(DEC).alias("lo"), F.col("hi").cast(DEC).alias("hi")),
                     "checked-plan")
    known = F.col("bucket").between(0, salt_buckets - 1)
    nulls = F.col("lo").isNull() & F.col("hi").isNull()
    ranges = splits.where(known & (F.col("lo") <= F.col("hi")))
    counted = _counted(keys, key, shard, salt_buckets, salt)
    live = counted.where(F.col("pos").isNotNull())

    zero = F.lit(0).cast("bigint")
    one = F.lit(1).cast("bigint")
    events = ranges.select(*group, F.col("lo").alias("pos"), one.alias("step"), zero.alias("n")).unionByName(
        ranges.select(*group, (F.col("hi") + 1).cast(DEC).alias("pos"), (-one).alias("step"), zero.alias("n"))).unionByName(
        live.select(*group, "pos", zero.alias("step"), "n"))
    at = events.groupBy(*group, "pos").agg(F.sum("step").alias("step"), F.sum("n").alias("n")).withColumn(
        "turn", F.when(F.col("step") != 0, 1).otherwise(0).cast("bigint"))
    swept = running_sums(at, group, ["pos"], {"depth": "step", "stretch": "turn"})
    stretches = written(swept.groupBy(*group, "stretch").agg(
        F.max("depth").alias("depth"), F.min("pos").alias("lo"), F.max("pos").alias("last"), F.sum("n").alias("n_keys")), "stretches")
    after = stretches.select(*group, (F.col("stretch") - 1).alias("stretch"), (F.col("lo") - 1).cast(DEC).alias("hi"))
    bad = stretches.where(F.col("depth") != 1)
    ended = joined(bad, after, [*group, "stretch"], "left")
    # before the first and after the last split nothing is amiss where there is no key
    inner = (F.col("stretch") > 0) & F.col("hi").isNotNull()
    gap = (F.col("depth") == 0) & (inner | (F.col("n_keys") > 0))
    found = ended.where(gap | (F.col("depth") > 1)).select(
        *group, F.when(F.col("depth") == 0, "gap").otherwise("overlap").alias("fault"), "lo",
        F.coalesce("hi", "last").alias("hi"), F.col("depth").cast("bigint").alias("depth"), "n_keys")

    def plain(df: DataFrame, fault: str, depth=F.lit(None), n_keys=F.lit(None), lo=F.lit(None), hi=F.lit(None)) -> DataFrame:
        return df.select(*group, F.lit(fault).alias("fault"), lo.cast(DEC).alias("lo"), hi.cast(DEC).alias("hi"),
                         depth.cast("bigint").alias("depth"), n_keys.cast("bigint").alias("n_keys"))

    odd = splits.where(~nulls & ~F.coalesce(F.col("lo") <= F.col("hi"), F.lit(False)))
    found = found.unionByName(plain(odd, "inverted", lo=F.col("lo"), hi=F.col("hi")))
    found = found.unionByName(plain(splits.where(~known), "unknown_bucket", lo=F.col("lo"), hi=F.col("hi")))
    if salt_buckets > 1:
        every = splits.where(~nulls).select(*shard).distinct().withColumn("bucket", F.explode(F.sequence(F.lit(0), F.lit(salt_buckets - 1))))
        have = ranges.select(*group).distinct()
        found = found.unionByName(plain(joined(every, have, group, "left_anti"), "missing_bucket"))
    asked = splits.where(nulls).groupBy(*group).agg(F.count(F.lit(1)).alias("depth"))
    empty = counted.where(F.col("pos").isNull()).select(*group, "n")
    both = asked.withColumn("n", zero).unionByName(empty.withColumn("depth", zero)).groupBy(*group).agg(
        F.sum("depth").alias("depth"), F.sum("n").alias("n"))
    depth, n = F.col("depth"), F.col("n")
    if null_key == "keep":
        found = found.unionByName(plain(both.where((depth == 0) & (n > 0)), "null_keys_unread", depth, n))
        return found.unionByName(plain(both.where(depth > 1), "null_keys_repeated", depth, n))
    return found.unionByName(plain(both.where(depth > 0), "null_keys_unexpected", depth, n))


def _counted(keys: DataFrame, key: str, shard: list[str], buckets: int, salt: str | None) -> DataFrame:
    """``shard, bucket, pos, n``: rows per key (null: the NULL keys), in the bucket(s) that must read them."""
    if buckets == 1:
        bucket = F.lit(0)
    elif salt is None:
        bucket = F.explode(F.sequence(F.lit(0), F.lit(buckets - 1)))
    else:  # bucket 0 also takes whatever no other takes: NULL and negative salts
        rest = F.col(salt) % F.lit(buckets)
        bucket = F.when(rest > 0, rest).otherwise(0).cast("int")
    cols = [*shard, F.col(key).cast(DEC).alias("pos")]
    if buckets > 1 and salt is not None:
        counts = keys.select(*cols, bucket.alias("bucket")).groupBy(*shard, "bucket", "pos").agg(F.count(F.lit(1)).alias("n"))
        return counts
    counts = keys.select(*cols).groupBy(*shard, "pos").agg(F.count(F.lit(1)).alias("n"))
    return counts.withColumn("bucket", bucket)


def prune_split_plan(plan: DataFrame, ranges, split_id: str = "split_id") -> DataFrame:
    """The splits of ``plan`` whose range meets one of ``ranges``: a DataFrame ``lo, hi`` of any size, or pairs and keys as for
    ``scan.key-ranges``.  The split of the NULL keys is dropped.

    No range join: a split ``[a, b]`` meets a range when more ranges start at or below ``b`` than end below ``a``, two
    running counts read off one sweep."""
    spark = plan.sparkSession
    if not isinstance(ranges, DataFrame):
        from decimal import Decimal

        pairs = [(Decimal(a), Decimal(b)) for a, b in KeyRanges.of(ranges).ranges]
        ranges = spark.createDataFrame(pairs, f"lo {DEC}, hi {DEC}")
    plan = written(plan.where(F.col("lo").isNotNull()), "unpruned-plan")
    ranges = written(ranges.select(F.col("lo").cast(DEC).alias("lo"), F.col("hi").cast(DEC).alias("hi")).where("lo <= hi"), "ranges")
    none = F.lit(None).cast(plan.schema[split_id].dataType)

    def events(df: DataFrame, pos, rank: int, started: int, ended: int, split, side: str) -> DataFrame:
        # at one position: ends below it, then lower bounds ask; starts at it, then upper bounds ask
        return df.select(pos.cast(DEC).alias("pos"), F.lit(rank).alias("rank"), F.lit(started).cast("bigint").alias("started"),
                         F.lit(ended).cast("bigint").alias("ended"), split.alias("split"), F.lit(side).alias("side"))

    axis = events(ranges, F.col("hi") + 1, 0, 0, 1, none, "").unionByName(
        events(plan, F.col("lo"), 1, 0, 0, F.col(split_id), "lo")).unionByName(
        events(ranges, F.col("lo"), 2, 1, 0, none, "")).unionByName(
        events(plan, F.col("hi"), 3, 0, 0, F.col(split_id), "hi"))
    # rows of one kind at one position need no order among themselves: counts are added up first
    counts = axis.groupBy("pos", "rank").agg(F.sum("started").alias("started"), F.sum("ended").alias("ended"))
    through = running_sums(counts, (), ["pos", "rank"], {"starts": "started", "ends": "ended"})
    asked = axis.where(F.col("side") != "").select("pos", "rank", "split", "side")
    met = asked.join(through.select("pos", "rank", "starts", "ends"), ["pos", "rank"]).groupBy("split").agg(
        F.max(F.when(F.col("side") == "hi", F.col("starts"))).alias("starts"),
        F.max(F.when(F.col("side") == "lo", F.col("ends"))).alias("ends")).where(F.col("starts") > F.col("ends"))
    return plan.join(met.select(F.col("split").alias(split_id)), split_id, "left_semi")
