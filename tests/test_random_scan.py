"""Randomised end-to-end checks: random keys (negative, repeated, sparse,
NULL) in random shard layouts, read back through the sharded scan in both
modes; the result is exactly the rows that were written."""

import random
from collections import Counter

import pytest

from conftest import derby_exec
from shardscan import split_plan, sharded_scan
from shardscan.plans.rule import split_ranges

SCHEMA = "k BIGINT, v STRING"


def _layout(seed):
    rnd = random.Random(seed)
    servers = rnd.randint(1, 3)
    tables = {}
    for srv in range(servers):
        for t in range(rnd.randint(1, 3)):
            n = rnd.choice([0, 1, 5, 40, 200])
            base = rnd.randint(-10**12, 10**12)
            spread = rnd.choice([1, 3, 1000, 10**9])
            rows = []
            for i in range(n):
                k = None if rnd.random() < 0.05 else base + rnd.randint(0, spread)
                rows.append((k, f"s{srv}t{t}r{i}"))
            tables[(srv, f"RND_{t}")] = rows
    return servers, tables


@pytest.mark.parametrize("seed", range(6))
def test_random_layouts(spark, seed):
    servers, tables = _layout(seed)
    urls = [f"jdbc:derby:memory:rnd_{seed}_{i}" for i in range(servers)]
    for i, url in enumerate(urls):
        stmts = []
        for (srv, name), rows in tables.items():
            if srv != i:
                continue
            stmts.append(f"CREATE TABLE APP.{name} (k BIGINT, v VARCHAR(40))")
            for k, v in rows:
                stmts.append(f"INSERT INTO APP.{name} VALUES ({'NULL' if k is None else k}, '{v}')")
        derby_exec(spark, url + ";create=true", *stmts)
    rnd = random.Random(seed + 100)
    for _ in range(3):
        mode = ({"scan.batch.size": rnd.choice([1, 3, 17, 1000])} if rnd.random() < 0.5
                else {"scan.partition.num": rnd.choice([1, 2, 7, 50])})
        keep = rnd.random() < 0.5
        opts = {"url": urls, "table-name": "RND_.*", "schema-name": "APP", "scan.partition.column": "k",
                "scan.null-key": "keep" if keep else "drop", **mode}
        all_keys = sorted(k for rows in tables.values() for k, _ in rows if k is not None)
        bounds = None
        if all_keys and rnd.random() < 0.3:
            lb, ub = sorted(rnd.sample(all_keys, 2)) if len(all_keys) > 1 else (all_keys[0], all_keys[0])
            bounds = (lb, ub)
            opts.update({"scan.lower-bound": lb, "scan.upper-bound": ub})
        salted = rnd.random() < 0.3
        if salted:
            opts.update({"scan.salt.column": "k", "scan.salt.buckets": 3})
        got = Counter((r.k, r.v) for r in sharded_scan(spark, SCHEMA, opts).collect())
        want = Counter(r for rows in tables.values() for r in rows
                       if (r[0] is None and keep)
                       or (r[0] is not None and (bounds is None or bounds[0] <= r[0] <= bounds[1])))
        assert got == want, (seed, mode, keep, bounds, salted)
        if bounds or salted:
            continue
        # every non-null key in exactly one planned range of its shard
        plan = [r for r in split_plan(spark, SCHEMA, opts).collect() if r.lo is not None]
        for (srv, name), rows in tables.items():
            ranges = [(r.lo, r.hi) for r in plan if r.url_no == srv and r.table_name == name]
            keys = [k for k, _ in rows if k is not None]
            b, n = mode.get("scan.batch.size"), mode.get("scan.partition.num")
            expect = split_ranges(min(keys) if keys else None, max(keys) if keys else None, len(rows),
                                  batch_size=b, partition_num=n)
            assert sorted(ranges) == expect
            for k in keys:
                assert sum(lo <= k <= hi for lo, hi in ranges) == 1


@pytest.mark.parametrize("seed", range(4))
def test_random_layouts_dbapi(spark, seed):
    """The same randomised checks through the DB-API backend (SQLite files)."""
    import os
    import sqlite3
    import tempfile

    from shardscan.sources import dbapi

    dbapi.register(spark)
    servers, tables = _layout(seed + 50)
    folder = tempfile.mkdtemp(prefix="shardscan-rnd-")
    urls = []
    for i in range(servers):
        path = os.path.join(folder, f"s{i}.db")
        c = sqlite3.connect(path)
        for (srv, name), rows in tables.items():
            if srv == i:
                c.execute(f'CREATE TABLE "{name}" (k INTEGER, v TEXT)')
                c.executemany(f'INSERT INTO "{name}" VALUES (?, ?)', rows)
        c.commit()
        c.close()
        urls.append(f"sqlite://{path}")
    rnd = random.Random(seed + 200)
    for _ in range(4):
        mode = ({"scan.batch.size": rnd.choice([1, 3, 17, 1000])} if rnd.random() < 0.5
                else {"scan.partition.num": rnd.choice([1, 2, 7, 50])})
        keep = rnd.random() < 0.5
        opts = {"url": ";".join(urls), "table-name": "RND_.*", "schema-name": "main",
                "scan.partition.column": "k", "scan.null-key": "keep" if keep else "drop", **mode,
                "scan.splits-per-task": rnd.choice([1, 4])}
        all_keys = sorted(k for rows in tables.values() for k, _ in rows if k is not None)
        bounds = None
        if all_keys and rnd.random() < 0.3:
            lb, ub = sorted(rnd.sample(all_keys, 2)) if len(all_keys) > 1 else (all_keys[0], all_keys[0])
            bounds = (lb, ub)
            opts.update({"scan.lower-bound": lb, "scan.upper-bound": ub})
        if rnd.random() < 0.3:
            opts.update({"scan.salt.column": "k", "scan.salt.buckets": 3})
        df = spark.read.format(dbapi.NAME).schema(SCHEMA).options(**{k: str(v) for k, v in opts.items()}).load()
        got = Counter((r.k, r.v) for r in df.collect())
        want = Counter(r for rows in tables.values() for r in rows
                       if (r[0] is None and keep)
                       or (r[0] is not None and (bounds is None or bounds[0] <= r[0] <= bounds[1])))
        assert got == want, (seed, opts)
