"""Split plans as tables: planning and reading by tasks, pruning, the exactly-once check, equal-depth plans."""

import random
import sqlite3
from collections import Counter
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from shardscan import (
    check_split_plan,
    distributed_split_plan,
    equal_depth_plan,
    prune_split_plan,
    read_split_plan,
    scan_by_stored_plan,
)
from shardscan.operators.prefix import running_sums
from shardscan.options import ScanOptions
from shardscan.plans.key_ranges import KeyRanges
from shardscan.sources import dbapi, stored

SCHEMA = "v STRING, k BIGINT"


@pytest.fixture(scope="module")
def servers(spark, tmp_path_factory):
    """Two files: a dense table, a sparse one with a hot key and NULL keys, an empty one, and one that must not match."""
    rnd = random.Random(1)
    folder = tmp_path_factory.mktemp("stored")
    rows, urls = {}, []
    for i in range(2):
        path = str(folder / f"s{i}.db")
        c = sqlite3.connect(path)
        data = {"T_1": [(k, f"a{i}-{k}", k % 5) for k in range(-20, 200 + 30 * i)],
                "T_2": [(rnd.randrange(10 ** rnd.randrange(1, 13)), f"b{i}-{n}", rnd.randrange(-3, 9)) for n in range(400)]
                + [(777, f"hot{i}-{n}", n) for n in range(300)] + [(None, f"null{i}-{n}", n) for n in range(7 * i)],
                "T_3": [], "U_9": [(1, "no", 0)]}
        for t, r in data.items():
            c.execute(f'CREATE TABLE "{t}" (K INTEGER, V TEXT, S INTEGER)')
            c.executemany(f'INSERT INTO "{t}" VALUES (?, ?, ?)', r)
            rows[i, t] = r
        c.commit()
        c.close()
        urls.append(f"sqlite://{path}")
    return urls, rows


def opts(urls, **kw):
    o = {"url": urls, "schema-name": "main", "table-name": "T_.*", "scan.partition.column": "k"}
    if not {"scan.batch.size", "scan.partition.num"} & set(kw):
        o["scan.batch.size"] = 60
    return o | kw


CASES = [{}, {"scan.partition.num": 4, "scan.null-key": "keep"},
         {"scan.batch.size": 100, "scan.salt.column": "S", "scan.salt.buckets": 3, "scan.null-key": "keep"},
         {"scan.partition.num": 3, "scan.lower-bound": 0, "scan.upper-bound": 100}, {"scan.batch.size": 10, "scan.lower-bound": -5, "scan.upper-bound": 50},
         {"scan.conditions": {"S": 2}}, {"table-name": "T_3|NONE"}]


def tuples(df):
    return Counter(map(tuple, df.collect()))


@pytest.mark.parametrize("kw", CASES, ids=str)
def test_same_splits_and_rows_as_the_planner_of_the_flat_backend(spark, servers, kw):
    urls, _ = servers
    o = opts(urls, **kw)
    schema = stored.as_schema(SCHEMA)
    reader = dbapi.ShardedDbapiReader(schema, ScanOptions.from_map(o))
    want = sorted((s.split_id, s.url_no, s.schema, s.table, s.columns, s.key, s.lo, s.hi, s.bucket, s.salt)
                  for t in reader.partitions() for s in t.splits)
    plan = distributed_split_plan(spark, SCHEMA, o).cache()
    got = sorted((r.split_id, r.url_no, r.schema_name, r.table_name, tuple(r["columns"]), r.key_column, None if r.lo is None else int(r.lo),
                  None if r.hi is None else int(r.hi), r.bucket, r.salt_column) for r in plan.collect())
    assert got == want
    dbapi.register(spark)
    text = {k: ",".join(f"{a}={b}" for a, b in v.items()) if isinstance(v, dict) else ";".join(v) if isinstance(v, list) else str(v) for k, v in o.items()}
    flat = spark.read.format(dbapi.NAME).schema(schema).options(**text).load()
    assert tuples(read_split_plan(spark, plan, SCHEMA, o)) == tuples(flat)


def test_stored_and_packed(spark, servers, tmp_path):
    urls, rows = servers
    want = Counter((v, k) for (_, t), r in rows.items() if t != "U_9" for k, v, _ in r if k is not None)
    df = scan_by_stored_plan(spark, str(tmp_path / "plan"), SCHEMA, opts(urls, **{"scan.splits-per-task": 5}))
    plan = spark.read.parquet(str(tmp_path / "plan"))
    assert tuples(df) == want and df.rdd.getNumPartitions() == -(-plan.count() // 5)
    assert "password" not in " ".join(plan.columns) and plan.schema == spark.createDataFrame([], stored.PLAN).schema
    # a task holds as many splits as the others
    sizes = Counter(r.p for r in df.select(F.spark_partition_id().alias("p")).distinct().collect())
    assert len(sizes) > 1
    half = plan.where("split_id % 2 = 0")
    both = read_split_plan(spark, half, SCHEMA, opts(urls)).unionAll(read_split_plan(spark, plan.where("split_id % 2 = 1"), SCHEMA, opts(urls)))
    assert tuples(both) == want
    twice = read_split_plan(spark, plan.unionAll(plan), SCHEMA, opts(urls))
    assert tuples(twice) == Counter({r: 2 * n for r, n in want.items()})


def test_ten_million_splits_stay_off_the_driver(spark, servers):
    o = opts(servers[0][:1], **{"scan.partition.num": 10_000_000, "scan.lower-bound": 0, "scan.upper-bound": 10 ** 12, "table-name": "T_1"})
    plan = distributed_split_plan(spark, SCHEMA, o)
    got = plan.agg(F.count("*").alias("n"), F.min("lo").alias("lo"), F.max("hi").alias("hi"), F.countDistinct("split_id").alias("ids")).first()
    assert (got.n, int(got.lo), int(got.hi), got.ids) == (9_999_901, 0, 10 ** 12, 9_999_901)
    with pytest.raises(ValueError, match="scan.max-splits=10"):
        distributed_split_plan(spark, SCHEMA, o | {"scan.max-splits": 10})


def test_errors_name_the_shard_and_hold_no_password(spark, servers):
    with pytest.raises(ValueError, match=r"main.T_1 lacks declared column\(s\) \['nope'\]"):
        distributed_split_plan(spark, "nope STRING, k BIGINT", opts(servers[0]))
    with pytest.raises(RuntimeError) as e:
        distributed_split_plan(spark, SCHEMA, opts(["sqlite:///no/such/dir/hidden.db"], password="hidden"))
    assert "hidden" not in str(e.value)


# ------------------------------------------------------------- key ranges
def test_key_ranges_index():
    rnd = random.Random(3)
    for _ in range(300):
        pairs = [(a, a + rnd.randrange(5)) for a in (rnd.randrange(60) for _ in range(rnd.randrange(6)))]
        ranges = KeyRanges.of(pairs)
        wanted = {k for a, b in pairs for k in range(a, b + 1)}
        assert {k for a, b in ranges.ranges for k in range(a, b + 1)} == wanted
        assert all(b + 1 < c for (_, b), (c, _) in zip(ranges.ranges, ranges.ranges[1:]))
        lo = rnd.randrange(60)
        hi = lo + rnd.randrange(20)
        assert {k for a, b in ranges.hits(lo, hi) for k in range(a, b + 1)} == wanted & set(range(lo, hi + 1))
    assert KeyRanges.of("5, 7:9,8:12").ranges == ((5, 5), (7, 12))
    for bad in ("9:1", "a", [(1, 2, 3)]):
        with pytest.raises(ValueError, match="scan.key-ranges"):
            KeyRanges.of(bad)


def test_key_ranges_drop_splits_before_tasks_exist(spark, servers):
    from shard_fixtures import orders_shards, parquet
    from shardscan import plan_scan, sharded_scan, split_row_counts_in_db

    sf = "/root/testdata/sf0.001"
    o = {"url": list(orders_shards(spark, sf)), "table-name": "ORDERS_.*", "schema-name": "APP", "scan.partition.column": "o_orderkey",
         "scan.partition.num": 10}
    every = plan_scan(spark, "o_orderkey BIGINT", o)
    some = plan_scan(spark, "o_orderkey BIGINT", o | {"scan.key-ranges": "40:60,1000"})
    assert 0 < some.n_splits < every.n_splits / 2
    ids = {s[0]: s for m in every.splits.values() for s in m}
    assert all(ids[s[0]] == s for m in some.splits.values() for s in m)  # a kept split is the same split
    df = sharded_scan(spark, "o_orderkey BIGINT", o | {"scan.key-ranges": "40:60,1000"})
    assert df.rdd.getNumPartitions() == some.n_splits
    want = sorted(r[0] for r in parquet(spark, sf, "orders").where("o_orderkey between 40 and 60 or o_orderkey = 1000").select("o_orderkey").collect())
    assert sorted(r[0] for r in df.collect()) == want
    assert sum(r.n_rows for r in split_row_counts_in_db(spark, "o_orderkey BIGINT", o | {"scan.key-ranges": "40:60,1000"}).collect()) == len(want)
    assert sharded_scan(spark, "o_orderkey BIGINT", o | {"scan.key-ranges": [(-9, -1)]}).collect() == []
    with pytest.raises(ValueError, match="NULL key"):
        plan_scan(spark, "o_orderkey BIGINT", o | {"scan.key-ranges": "1", "scan.null-key": "keep"})
    urls, rows = servers
    flat = distributed_split_plan(spark, SCHEMA, opts(urls))
    kept = prune_split_plan(flat, "-3:5,777")
    got = read_split_plan(spark, kept, SCHEMA, opts(urls, **{"scan.key-ranges": "-3:5,777"}))
    assert kept.count() < flat.count()
    assert tuples(got) == Counter((v, k) for (_, t), r in rows.items() if t != "U_9" for k, v, _ in r
                                  if k is not None and (-3 <= k <= 5 or k == 777))


def test_prune_against_brute_force(spark):
    rnd = random.Random(8)
    splits, ranges = [], []
    for i in range(400):
        a = rnd.randrange(3000)
        splits.append((i, a, a + rnd.randrange(30)))
    for _ in range(25):
        a = rnd.randrange(3000)
        ranges.append((a, a + rnd.choice([-1, 0, 0, 3, 40])))
    ranges += ranges[:3]
    plan = spark.createDataFrame([*splits, (400, None, None)], "split_id long, lo long, hi long")
    got = prune_split_plan(plan, spark.createDataFrame(ranges, "lo long, hi long"))
    want = {i for i, a, b in splits if any(a <= d and c <= b and c <= d for c, d in ranges)}
    assert {r.split_id for r in got.collect()} == want
    assert prune_split_plan(plan, spark.createDataFrame([], "lo long, hi long")).collect() == []


# ------------------------------------------------------- running sums, checks
def test_running_sums_in_groups_and_over_all(spark):
    rnd = random.Random(2)
    rows = [(rnd.choice(["hot"] * 8 + ["a", None]), i, rnd.choice([None, 1, 2, -3])) for i in range(2000)]
    df = spark.createDataFrame(rows, "g string, at long, v long").repartition(7)
    want, seen = {}, Counter()
    for g, at, v in rows:
        seen[g] += v or 0
        want[at] = seen[g]
    assert {r["at"]: r.s for r in running_sums(df, ["g"], ["at"], {"s": "v"}).collect()} == want
    total, all_of = 0, {}
    for _, at, v in rows:
        total += v or 0
        all_of[at] = total
    assert {r["at"]: r.s for r in running_sums(df, (), ["at"], {"s": "v"}).collect()} == all_of


def plain_faults(splits, keys, buckets, keep):
    """Brute force: splits (shard, bucket, lo, hi) and rows (shard, key) -> stretches key by key."""
    out = []
    for shard in sorted({s[0] for s in splits} | {k[0] for k in keys}):
        mine = [s for s in splits if s[0] == shard]
        live = Counter(k for s, k in keys if s == shard)
        for b in range(buckets):
            of = [(lo, hi) for _, x, lo, hi in mine if (x or 0) == b and lo is not None and hi is not None and lo <= hi]
            spots = sorted({p for lo, hi in of for p in (lo, hi + 1)} | {k for k in live if k is not None})
            if spots:
                depth = [sum(lo <= p <= hi for lo, hi in of) for p in range(spots[0], spots[-1] + 1)]
                p = 0
                while p < len(depth):
                    q = p
                    while q < len(depth) and depth[q] == depth[p]:
                        q += 1
                    n = sum(live.get(spots[0] + x, 0) for x in range(p, q))
                    last_end = max((hi for _, hi in of), default=None)
                    first = min((lo for lo, _ in of), default=None)
                    lo, hi = spots[0] + p, spots[0] + q - 1
                    inner = first is not None and first <= lo and hi < last_end + 1 and lo <= last_end
                    if depth[p] > 1 or depth[p] == 0 and (inner or n):
                        out.append((shard, b, "overlap" if depth[p] else "gap", lo, hi, depth[p], n))
                    p = q
            if buckets > 1 and any(lo is not None or hi is not None for _, _, lo, hi in mine) and not of:
                out.append((shard, b, "missing_bucket", None, None, None, None))
            asked = sum((x or 0) == b and lo is None and hi is None for _, x, lo, hi in mine)
            if keep and not asked and live.get(None):
                out.append((shard, b, "null_keys_unread", None, None, 0, live[None]))
            if keep and asked > 1:
                out.append((shard, b, "null_keys_repeated", None, None, asked, live.get(None, 0)))
            if not keep and asked:
                out.append((shard, b, "null_keys_unexpected", None, None, asked, live.get(None, 0)))
    for shard, b, lo, hi in splits:
        if not 0 <= (b or 0) < buckets:
            out.append((shard, b, "unknown_bucket", lo, hi, None, None))
        if (lo is None) != (hi is None) or lo is not None and lo > hi:
            out.append((shard, b or 0, "inverted", lo, hi, None, None))
    return Counter(out)


@pytest.mark.parametrize("seed,buckets,keep", [(1, 1, False), (2, 1, True), (3, 3, True), (4, 2, False)])
def test_faults_against_brute_force(spark, seed, buckets, keep):
    rnd = random.Random(seed)
    splits, keys = [], []
    for shard in ("s1", "s2", None, "only keys"):
        for b in range(buckets):
            at = rnd.randrange(5)
            for _ in range(rnd.randrange(25) if shard != "only keys" else 0):
                size = rnd.randrange(1, 9)
                for _ in range(rnd.choice([1] * 8 + [0, 2, 3])):
                    splits.append((shard, b if buckets > 1 else None, at, at + size - 1))
                at += size + rnd.choice([0] * 9 + [-2, 4])
            splits += [(shard, b if buckets > 1 else None, None, None)] * rnd.choice([0, 1, 1, 2])
        keys += [(shard, rnd.choice([None] + list(range(130)))) for _ in range(120)]
    splits += [("s1", 0, 9, 3), ("s2", 0, None, 4), ("s1", buckets, 1, 2)]
    plan = spark.createDataFrame(splits, "shard string, bucket int, lo long, hi long")
    got = check_split_plan(plan, spark.createDataFrame(keys, "shard string, id long"), "id", shard_cols=["shard"], salt_buckets=buckets,
                           null_key="keep" if keep else "drop").collect()
    num = [tuple(int(x) if isinstance(x, Decimal) else x for x in r) for r in got]
    # None sorts nowhere: the plain version names it
    splits, keys = [(s[0] or "null", *s[1:]) for s in splits], [(k[0] or "null", k[1]) for k in keys]
    assert Counter((r[0] or "null", *r[1:]) for r in num) == plain_faults(splits, keys, buckets, keep)


def test_salted_plan_against_the_rows_of_each_bucket(spark, servers):
    urls, rows = servers
    o = opts(urls, **{"scan.salt.column": "S", "scan.salt.buckets": 3, "scan.null-key": "keep"})
    live = [(u, "main", t, k, s) for (u, t), r in rows.items() if t != "U_9" for k, _, s in r]
    keys = spark.createDataFrame(live, "url_no int, schema_name string, table_name string, id long, salt long")
    plan = distributed_split_plan(spark, SCHEMA, o)
    for salt in (None, "salt"):
        assert check_split_plan(plan, keys, "id", salt_buckets=3, salt=salt, null_key="keep").collect() == []
    lost = check_split_plan(plan.where("bucket <> 1"), keys, "id", salt_buckets=3, salt="salt", null_key="keep").collect()
    want = sum(s % 3 == 1 and s > 0 for *_, s in live)
    assert sum(r.n_keys or 0 for r in lost) == want and {r.bucket for r in lost} == {1}


# ------------------------------------------------------------ equal depth
@pytest.mark.parametrize("max_rows,fan_out,kw", [(1, 16, {}), (50, 64, {"scan.null-key": "keep"}), (7, 16, {"scan.conditions": {"S": 2}}),
                                               (15, 8, {"scan.lower-bound": 0, "scan.upper-bound": 10 ** 6})])
def test_equal_depth(spark, servers, max_rows, fan_out, kw):
    urls, rows = servers
    o = opts(urls, **kw)
    plan = equal_depth_plan(spark, SCHEMA, o, max_rows=max_rows, fan_out=fan_out).cache()
    splits = plan.orderBy("split_id").collect()
    assert [r.split_id for r in splits] == list(range(len(splits)))
    low, high = kw.get("scan.lower-bound", -10 ** 18), kw.get("scan.upper-bound", 10 ** 18)
    for (u, t), r in rows.items():
        mine = [s for s in splits if (s.url_no, s.table_name) == (u, t) and s.lo is not None]
        keys = sorted(k for k, _, s in r if k is not None and low <= k <= high and ("scan.conditions" not in kw or s == 2))
        if t == "U_9" or not keys:
            assert not mine
            continue
        assert [s.split_no for s in mine] == list(range(len(mine)))
        assert all(int(a.hi) + 1 == int(b.lo) for a, b in zip(mine, mine[1:]))  # no gap, no overlap
        for s in mine:
            n = sum(s.lo <= k <= s.hi for k in keys)
            assert n == s.n_rows
            assert n < 2 * max_rows or s.lo == s.hi
    assert tuples(read_split_plan(spark, plan, SCHEMA, o)) == tuples(read_split_plan(spark, distributed_split_plan(spark, SCHEMA, o), SCHEMA, o))


def test_equal_depth_refuses(spark, servers):
    for kw in ({"max_rows": 0}, {"max_rows": 5, "fan_out": 1}):
        with pytest.raises(ValueError, match="max_rows"):
            equal_depth_plan(spark, SCHEMA, opts(servers[0]), **kw)
    with pytest.raises(ValueError, match="salt"):
        equal_depth_plan(spark, SCHEMA, opts(servers[0], **{"scan.salt.column": "S", "scan.salt.buckets": 2}))


# ------------------------------------------------------ columns and filters
FILTERS = [[("k", ">=", 100)], [("v", "=", "hot0-3")], [("v", "in", ["a0-5", "a1-7", "no such"]), ("k", "<", 7)], [("v", "<", "a1")], [("k", "<>", 777), ("k", ">", 700)],
           [("v", "is not null"), ("k", "<=", 0)], [("k", "is null")], [("v", "<>", "a0-5"), ("k", "=", 5)]]


@pytest.mark.parametrize("filters", FILTERS, ids=str)
def test_columns_and_filters(spark, servers, filters):
    urls, rows = servers
    plan = distributed_split_plan(spark, SCHEMA, opts(urls, **{"scan.null-key": "keep"})).cache()
    every = [(v, k) for (_, t), r in rows.items() if t != "U_9" for k, v, _ in r]
    fits = {"=": lambda a, b: a == b, "<>": lambda a, b: a != b, "<": lambda a, b: a < b, "<=": lambda a, b: a <= b, ">": lambda a, b: a > b,
            ">=": lambda a, b: a >= b, "in": lambda a, b: a in b}

    def keeps(row):
        for c, op, *v in filters:
            x = row["vk".index(c)]
            if op.startswith("is"):
                if (x is None) != (op == "is null"):
                    return False
            elif x is None or not fits[op](x, v[0]):
                return False
        return True

    df = read_split_plan(spark, plan, SCHEMA, opts(urls), columns=["k"], filters=filters)
    assert df.columns == ["k"] and tuples(df) == Counter((k,) for v, k in every if keeps((v, k)))
    assert df.count() == sum(keeps(r) for r in every)
    assert tuples(read_split_plan(spark, plan, SCHEMA, opts(urls))) == Counter(every)  # the same plan, unfiltered


def test_the_sql_of_a_split_holds_columns_and_filters(spark, servers):
    from shardscan.plans.filters import checked

    schema = stored.as_schema("v STRING, k BIGINT, f DOUBLE, t TIMESTAMP_NTZ")
    reader = dbapi.ShardedDbapiReader(schema, ScanOptions.from_map(opts(servers[0])))
    reader.filters = checked([("k", ">", 3), ("v", "in", ["a", "b"]), ("v", "<", "z"), ("f", "is null"), ("t", "<", "2020-01-01")], schema)
    split = dbapi.Split(0, 0, "main", "T_1", ("V", "K", "F", "T"), "K", 1, 9)
    text, params = reader._statement("sqlite", split)
    assert text.endswith('WHERE "K" BETWEEN 1 AND 9 AND "K" > ? AND "V" IN (?, ?) AND "F" IS NULL') and params == [3, "a", "b"]
    text, params = reader._statement("postgresql", split)
    assert text.endswith('"F" IS NULL AND "T" < %s') and params == [3, "a", "b", "2020-01-01"]
    for bad in ([("zz", "=", 1)], [("k", "like", "x")], [("k", "=")], [("k", "=", None)], [("k", "in", [])], [("k", "is null", 1)]):
        with pytest.raises(ValueError):
            checked(bad, schema)
    with pytest.raises(ValueError, match="not declared"):
        read_split_plan(spark, spark.createDataFrame([], stored.PLAN), SCHEMA, opts(servers[0]), columns=["nope"])
