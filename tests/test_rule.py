"""The split rule: Python integer form and Spark column form agree, and both
give the documented ranges (golden cases and properties)."""

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from shardscan.plans import splits as P
from shardscan.plans.rule import split_ranges

LMAX = 2**63 - 1

# (keys, mode, expected ranges) - rule examples
GOLDEN = [
    ([1, 2, 3], {"batch_size": 2}, [(1, 2), (3, 4)]),
    ([4, 5, 6], {"partition_num": 2}, [(4, 5), (6, 7)]),
    ([1, 2, 3], {"batch_size": 3}, [(1, 3)]),
    ([1, 2, 3], {"batch_size": 100}, [(1, 3)]),
    ([1, 2, 3], {"partition_num": 10}, [(1, 1), (2, 2), (3, 3)]),
    ([5], {"batch_size": 1}, [(5, 5)]),
    (list(range(1, 11)), {"partition_num": 4}, [(1, 3), (4, 6), (7, 9), (10, 12)]),
    (list(range(1, 7)), {"partition_num": 4}, [(1, 2), (3, 4), (5, 6)]),
    ([1, 1000], {"batch_size": 1}, [(1, 500), (501, 1000)]),
    (list(range(-5, 5)), {"batch_size": 3}, [(-5, -3), (-2, 0), (1, 3), (4, 6)]),
]


def _stats(keys):
    ks = [k for k in keys if k is not None]
    return (min(ks) if ks else None, max(ks) if ks else None, len(keys))


@pytest.mark.parametrize("keys,mode,expected", GOLDEN)
def test_python_rule_golden(keys, mode, expected):
    mn, mx, n = _stats(keys)
    assert split_ranges(mn, mx, n, **mode) == expected


def test_python_rule_edges():
    assert split_ranges(None, None, 0, batch_size=5) == []
    top = LMAX
    r = split_ranges(top - 9, top, 10, partition_num=3)
    assert [hi - lo for lo, hi in r[:-1]] == [3, 3]
    assert r[-1][1] == top and r[0][0] == top - 9
    with pytest.raises(ValueError):
        split_ranges(1, 2, 2, batch_size=0)
    with pytest.raises(ValueError):
        split_ranges(1, 2, 2, partition_num=0)
    with pytest.raises(ValueError):
        split_ranges(1, 2, 2)
    with pytest.raises(ValueError):
        split_ranges(1, 2, 2, batch_size=1, partition_num=1)


def _d(v):
    from decimal import Decimal

    return None if v is None else Decimal(v)


def _spark_ranges(spark, cases):
    """cases: list of (case_id, mn, mx, n, batch_size, partition_num) -> {case_id: [(lo, hi)]}"""
    from pyspark.sql.types import LongType

    out = {}
    for mode in ("batch_size", "partition_num"):
        by_val = {}
        for c in cases:
            v = c[4] if mode == "batch_size" else c[5]
            if v is not None:
                by_val.setdefault(v, []).append(c)
        for v, cs in by_val.items():
            df = spark.createDataFrame(
                [(c[0], _d(c[1]), _d(c[2]), c[3]) for c in cs],
                "case_id int, mn decimal(38,0), mx decimal(38,0), n bigint",
            )
            plan = P.plan_splits(df, ["case_id"], key_type=LongType(), **{mode: v}, spread=False)
            for r in plan.collect():
                out.setdefault(r.case_id, []).append((r.split_no, r.lo, r.hi))
    return {k: [(lo, hi) for _, lo, hi in sorted(v)] for k, v in out.items()}


def test_spark_matches_golden(spark):
    cases, expected = [], {}
    for i, (keys, mode, exp) in enumerate(GOLDEN):
        mn, mx, n = _stats(keys)
        cases.append((i, mn, mx, n, mode.get("batch_size"), mode.get("partition_num")))
        expected[i] = exp
    # saturation and full-range spans
    cases.append((100, LMAX - 9, LMAX, 10, None, 3))
    expected[100] = split_ranges(LMAX - 9, LMAX, 10, partition_num=3)
    cases.append((101, -(2**63), LMAX, 2**40, None, 4))
    expected[101] = split_ranges(-(2**63), LMAX, 2**40, partition_num=4)
    cases.append((102, -(2**63), LMAX, 2**40, 2**30, None))
    expected[102] = split_ranges(-(2**63), LMAX, 2**40, batch_size=2**30)
    assert _spark_ranges(spark, cases) == expected


def test_empty_shard_has_no_splits(spark):
    from pyspark.sql.types import LongType

    df = spark.createDataFrame([(0, None, None, 0)], "case_id int, mn decimal(38,0), mx decimal(38,0), n bigint")
    assert P.plan_splits(df, ["case_id"], key_type=LongType(), batch_size=5).count() == 0


keys_st = st.integers(min_value=-(2**40), max_value=2**40)


@settings(max_examples=300, deadline=None)
@given(a=keys_st, width=st.integers(0, 5000), n=st.integers(1, 10_000),
       b=st.one_of(st.none(), st.integers(1, 20_000)), parts=st.integers(1, 64))
def test_properties(a, width, n, b, parts):
    mn, mx = a, a + width
    mode = {"batch_size": b} if b is not None else {"partition_num": parts}
    r = split_ranges(mn, mx, n, **mode)
    assert r[0][0] == mn
    assert r[-1][0] <= mx <= r[-1][1]
    for (lo1, hi1), (lo2, _) in zip(r, r[1:]):
        assert lo1 <= hi1 and hi1 + 1 == lo2  # contiguous, disjoint
    if b is None:
        assert len(r) <= parts  # partition count is an upper bound


def test_spark_matches_python_random(spark):
    import random

    rnd = random.Random(7)
    cases, expected = [], {}
    for i in range(400):
        mn = rnd.randint(-(2**62), 2**62)
        mx = mn + rnd.choice([0, 1, 2, 7, 100, 10_000, 2**33, 2**61])
        n = rnd.randint(1, 10**6)
        if i % 2:
            b, p = rnd.choice([1, 2, 3, 1000, 10**6, 10**7]), None
        else:
            b, p = None, rnd.choice([1, 2, 3, 7, 64, 1000])
        r = split_ranges(mn, mx, n, batch_size=b, partition_num=p)
        if len(r) > 5000:
            continue
        cases.append((i, mn, mx, n, b, p))
        expected[i] = r
    assert _spark_ranges(spark, cases) == expected


def test_lineitem_as_one_shard(spark):
    """lineitem sf0.01 as one shard, B=1000: 60 ranges of width 250, the first [0, 249]."""
    from shardscan import lake_split_plan

    li = spark.read.parquet("/root/testdata/sf0.01/lineitem.parquet")
    plan = sorted((r.split_no, r.lo, r.hi) for r in lake_split_plan(li, None, "l_orderkey", batch_size=1000).collect())
    assert len(plan) == 60 and plan[0] == (0, 0, 249)
    assert all(hi - lo == 249 for _, lo, hi in plan)
