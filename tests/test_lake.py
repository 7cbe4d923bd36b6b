"""Lake form of the rule: split numbers per row, row counts and skew, checked
against brute force on small fixtures; both join paths give the same result."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from shardscan import assign_splits, lake_shard_stats, lake_split_plan, skew_report, split_row_counts
from shardscan.plans.rule import split_ranges

SF = "/root/testdata/sf0.001"


def brute_counts(rows, mode, top=2**63 - 1):
    """rows: [(shard, key)] -> Counter{(shard, split_no): n} using the Python rule."""
    by = {}
    for s, k in rows:
        by.setdefault(s, []).append(k)
    out = Counter()
    for s, ks in by.items():
        nn = [k for k in ks if k is not None]
        ranges = split_ranges(min(nn) if nn else None, max(nn) if nn else None, len(ks), top=top, **mode)
        for k in nn:
            idx = [i for i, (lo, hi) in enumerate(ranges) if lo <= k <= hi]
            assert len(idx) == 1  # each key in exactly one split
            out[(s, idx[0])] += 1
    return out


@pytest.mark.parametrize("mode", [{"batch_size": 37}, {"partition_num": 5}, {"batch_size": 10**6}])
def test_row_counts_brute_force(spark, mode):
    ev = spark.read.parquet(f"{SF}/events.parquet")
    got = {(r.event_type, r.split_no): r.n_rows
           for r in split_row_counts(ev, "event_type", "event_id", **mode).collect()}
    rows = [(r.event_type, r.event_id) for r in ev.select("event_type", "event_id").collect()]
    assert got == dict(brute_counts(rows, mode))


def test_merge_join_equals_broadcast(spark):
    li = spark.read.parquet(f"{SF}/lineitem.parquet").select(
        (F.col("l_suppkey") % 7).alias("shard"), "l_orderkey")
    # make shard 0 hold about half of all rows (a hot shard)
    li = li.withColumn("shard", F.when(F.col("l_orderkey") % 2 == 0, F.lit(0)).otherwise(F.col("shard")))
    rows = {}
    for limit in ("10m", "-1"):
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
        try:
            a = assign_splits(li, "shard", "l_orderkey", batch_size=50)
            rows[limit] = Counter((r.shard, r.l_orderkey, r.split_no) for r in a.collect())
        finally:
            spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert rows["10m"] == rows["-1"] and sum(rows["-1"].values()) == li.count()


def test_null_keys_and_null_shards(spark):
    df = spark.createDataFrame(
        [("a", 1), ("a", 5), ("a", None), (None, 3), (None, 4), ("b", None)], "s string, k bigint")
    got = {(r.s, r.split_no): r.n_rows for r in split_row_counts(df, "s", "k", partition_num=2).collect()}
    assert got == {("a", 0): 1, ("a", 1): 1, (None, 0): 1, (None, 1): 1}
    kept = {(r.s, r.split_no): r.n_rows
            for r in split_row_counts(df, "s", "k", partition_num=2, null_key="keep").collect()}
    assert kept[("a", None)] == 1 and kept[("b", None)] == 1
    stats = {r.s: (r.mn, r.mx, r.n) for r in lake_shard_stats(df, "s", "k").collect()}
    assert stats["a"] == (1, 5, 3) and stats["b"] == (None, None, 1)
    plan = lake_split_plan(df, "s", "k", partition_num=2)
    assert sorted((r.s or "", r.split_no, r.lo, r.hi) for r in plan.collect()) == [
        ("", 0, 3, 3), ("", 1, 4, 4), ("a", 0, 1, 3), ("a", 1, 4, 6)]


def test_global_shard_and_skew_report(spark):
    li = spark.read.parquet(f"{SF}/lineitem.parquet")
    rows = [(0, r.l_orderkey) for r in li.select("l_orderkey").collect()]
    want = brute_counts(rows, {"batch_size": 100})
    got = {(0, r.split_no): r.n_rows for r in split_row_counts(li, None, "l_orderkey", batch_size=100).collect()}
    assert got == dict(want)
    rep = skew_report(li, [], "l_orderkey", batch_size=100).first()
    assert rep.max_rows == max(want.values()) and rep.total_rows == len(rows)
    assert rep.nonempty_splits == len(want)


def test_plan_spreads_many_splits(spark):
    df = spark.range(0, 200_000).select(F.lit(1).alias("s"), F.col("id").alias("k"))
    plan = lake_split_plan(df, "s", "k", batch_size=1)
    assert plan.count() == 200_000
    r = plan.agg(F.min("lo"), F.max("hi"), F.countDistinct("split_no")).first()
    assert tuple(r) == (0, 199_999, 200_000)


def test_non_integer_key_rejected(spark):
    df = spark.createDataFrame([("a", 1.5)], "s string, k double")
    with pytest.raises(ValueError):
        lake_split_plan(df, "s", "k", batch_size=1)


def test_decimal_keys_above_bigint(spark):
    """Unsigned-BIGINT-like keys (DECIMAL(20,0) above 2^63): exact, no overflow."""
    from decimal import Decimal

    base = 2**64 - 100
    rows = [("a", Decimal(base + i)) for i in range(0, 100, 7)] + [("b", Decimal(5)), ("b", Decimal(9))]
    df = spark.createDataFrame(rows, "s string, k decimal(20,0)")
    got = {(r.s, r.split_no): r.n_rows for r in split_row_counts(df, "s", "k", partition_num=3).collect()}
    brute = brute_counts([(s, int(k)) for s, k in rows], {"partition_num": 3}, top=10**20 - 1)
    assert got == dict(brute)
    plan = sorted((r.s, r.split_no, int(r.lo), int(r.hi)) for r in lake_split_plan(df, "s", "k", partition_num=3).collect())
    a = [(lo, hi) for s, _, lo, hi in plan if s == "a"]
    assert a == split_ranges(base, base + 98, 15, partition_num=3, top=10**20 - 1)


def test_decimal_keys_one_shard(spark):
    from decimal import Decimal

    base = 2**64 - 1000
    rows = [(Decimal(base + i),) for i in range(0, 1000, 3)]
    df = spark.createDataFrame(rows, "k decimal(20,0)")
    got = {r.split_no: r.n_rows for r in split_row_counts(df, None, "k", batch_size=10).collect()}
    brute = brute_counts([(0, int(k)) for (k,) in rows], {"batch_size": 10}, top=10**20 - 1)
    assert got == {i: n for (_, i), n in brute.items()}


@pytest.mark.parametrize("seed", range(3))
def test_random_assignments(spark, seed):
    """Random shards and keys (NULLs, repeats, negative, wide), both joins."""
    import random

    rnd = random.Random(seed)
    rows = []
    for s in range(rnd.randint(1, 6)):
        base, spread = rnd.randint(-10**15, 10**15), rnd.choice([0, 5, 10**6, 10**14])
        heavy = rnd.random() < 0.3
        for _ in range(rnd.choice([1, 20, 300]) * (5 if heavy else 1)):
            rows.append((None if rnd.random() < 0.1 else f"s{s}",
                         None if rnd.random() < 0.05 else base + rnd.randint(0, spread)))
    df = spark.createDataFrame(rows, "s string, k bigint")
    mode = {"batch_size": rnd.choice([1, 7, 100])} if seed % 2 else {"partition_num": rnd.choice([1, 3, 16])}
    want = brute_counts(rows, mode)
    for limit in ("10m", "-1"):
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
        try:
            got = {(r.s, r.split_no): r.n_rows for r in split_row_counts(df, "s", "k", **mode).collect()}
        finally:
            spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        assert got == dict(want), (seed, mode, limit)
