"""Joins of co-sharded tables and comparison of copies, against Spark's own operators on the same rows."""

import random
import sqlite3
from collections import Counter

import pytest

from shardscan import co_sharded_join, differing_ranges, equal_depth_plan, except_all
from shardscan.sources.dbapi import _row_hash
from shardscan.sources.dialects import MYSQL, POSTGRES

LEFT, RIGHT = "id BIGINT, a STRING", "ref BIGINT, b STRING, c INT"


def database(path, tables):
    c = sqlite3.connect(path)
    for name, (ddl, rows) in tables.items():
        c.execute(f'CREATE TABLE "{name}" ({ddl})')
        if rows:
            c.executemany(f'INSERT INTO "{name}" VALUES ({",".join("?" * len(rows[0]))})', rows)
    c.commit()
    c.close()
    return f"sqlite://{path}"


@pytest.fixture(scope="module")
def sides(tmp_path_factory):
    """Three shards by id % 3; shard 2 has no partner; hot keys, keys on one side only, NULL keys."""
    rnd = random.Random(6)
    f = tmp_path_factory.mktemp("sides")
    left = [(rnd.randrange(60), f"l{i}") for i in range(150)] + [(9, f"hot{i}") for i in range(40)] + [(None, "null")]
    right = [(rnd.randrange(-5, 80), f"r{i}", i) for i in range(200)] + [(9, f"rhot{i}", i) for i in range(30)] + [(None, "null", 0)]

    def shard(rows, n):
        return [r for r in rows if (r[0] or 0) % 3 == n]

    lurls = [database(str(f / "l0.db"), {"L_0": ("ID INTEGER, A TEXT", shard(left, 0)), "L_2": ("ID INTEGER, A TEXT", shard(left, 2))}),
             database(str(f / "l1.db"), {"L_1": ("ID INTEGER, A TEXT", shard(left, 1)), "L_7": ("ID INTEGER, A TEXT", [])})]
    rurls = [database(str(f / "r0.db"), {f"R_{n}": ("REF INTEGER, B TEXT, C INTEGER", shard(right, n)) for n in (0, 1)})]
    right = [r for r in right if (r[0] or 0) % 3 != 2]
    return lurls, rurls, left, right


def lopts(urls, **kw):
    return {"url": urls, "schema-name": "main", "table-name": "L_(.*)", "scan.partition.column": "id", "scan.batch.size": 20} | kw


def ropts(urls, **kw):
    return {"url": urls, "schema-name": "main", "table-name": "R_(.*)", "scan.partition.column": "ref", "scan.partition.num": 1} | kw


@pytest.mark.parametrize("how", ["inner", "left_outer", "left_semi", "left_anti"])
@pytest.mark.parametrize("null_key", ["drop", "keep"])
def test_join(spark, sides, how, null_key):
    lurls, rurls, left, right = sides
    a = spark.createDataFrame([r for r in left if r[0] is not None or null_key == "keep"], LEFT)
    b = spark.createDataFrame(right, RIGHT)
    want = a.join(b, a.id == b.ref, how).drop("ref")
    got = co_sharded_join(spark, LEFT, lopts(lurls, **{"scan.null-key": null_key}), RIGHT, ropts(rurls), how)
    assert got.dtypes == want.dtypes and Counter(map(tuple, got.collect())) == Counter(map(tuple, want.collect()))


def test_join_moves_only_the_plan(spark, sides):
    lurls, rurls, left, right = sides
    got = co_sharded_join(spark, LEFT, lopts(lurls), RIGHT, ropts(rurls))
    plan = got._jdf.queryExecution().executedPlan().toString()
    above, below = plan.split("MapInArrow", 1)
    assert "Exchange" not in above and below.count("Exchange") == 1 and "r_columns" in below  # rows of the plan
    by_depth = equal_depth_plan(spark, LEFT, lopts(lurls), max_rows=10, fan_out=4)
    again = co_sharded_join(spark, LEFT, lopts(lurls), RIGHT, ropts(rurls), plan=by_depth)
    assert Counter(map(tuple, again.collect())) == Counter(map(tuple, got.collect()))


def test_join_of_many_splits_has_few_tasks_and_connections(spark, sides, monkeypatch):
    """Splits beyond ``LEAST_TASKS`` share tasks, and a task's splits share their connections."""
    from shardscan.sources import dbapi, stored

    lurls, rurls, left, right = sides
    monkeypatch.setattr(stored, "LEAST_TASKS", 2)
    monkeypatch.setattr(stored, "TASKS_PER_CORE", 0)
    kw = {"scan.batch.size": 1}
    got = co_sharded_join(spark, LEFT, lopts(lurls, **kw), RIGHT, ropts(rurls))
    a, b = (spark.createDataFrame([r for r in rows if r[0] is not None], ddl) for rows, ddl in ((left, LEFT), (right, RIGHT)))
    assert got.rdd.getNumPartitions() == 2
    assert Counter(map(tuple, got.collect())) == Counter(map(tuple, a.join(b, a.id == b.ref).drop("ref").collect()))
    opened = []
    monkeypatch.setattr(dbapi, "connect", lambda url, *a: opened.append(url) or sqlite3.connect(url[len("sqlite://"):]))
    schema = stored.as_schema(LEFT)
    o = stored.as_options(lopts(lurls))
    reader = dbapi.ShardedDbapiReader(schema, o)
    with stored.Connections(o) as open_to:
        splits = [dbapi.Split(i, 0, "main", "L_0", ("ID", "A"), "ID", k, k) for i, k in enumerate(range(0, 60, 3))]
        n = sum(batch.num_rows for s in splits for batch in reader.read_over(open_to(0), dbapi.Task(0, (s,))))
    assert opened == lurls[:1] and n == sum(k is not None and k % 3 == 0 for k, _ in left)


def test_join_refuses(spark, sides):
    lurls, rurls, *_ = sides
    for args, text in ((( LEFT, lopts(lurls, **{"table-name": "L_.*"}), RIGHT, ropts(rurls)), "captures no group"),
                       ((LEFT, lopts(lurls), "ref BIGINT, a STRING", ropts(rurls)), "both sides declare"),
                       ((LEFT, lopts(lurls), "b STRING", ropts(rurls)), "declare the key"),
                       ((LEFT, lopts(lurls), RIGHT, ropts(rurls * 2)), "have the tag"),
                       ((LEFT, lopts(lurls, **{"scan.salt.column": "id", "scan.salt.buckets": 2}), RIGHT, ropts(rurls)), "salt"),
                       ((LEFT, lopts(lurls), RIGHT, ropts(rurls), "cross"), "how must be")):
        with pytest.raises(ValueError, match=text):
            co_sharded_join(spark, *args)


# ---------------------------------------------------------------- copies
def copies(tmp_path, seed):
    rnd = random.Random(seed)
    rows = [(rnd.choice([None, 7, 7]) if rnd.random() < .05 else rnd.randrange(10 ** rnd.randrange(1, 12)), rnd.choice(["x", "y|1:z", "", None, "é"]),
             rnd.choice([None, 1.5, -2.0])) for _ in range(600)]
    other = [r for r in rows if rnd.random() > .02]
    other = [(k, v, 9.25) if rnd.random() < .01 else (k, v, f) for k, v, f in other] + rnd.sample(rows, 5) + [(10 ** 13, "far", 0.0)]
    ddl = "K INTEGER, V TEXT, F REAL"
    a = [database(str(tmp_path / f"a{i}.db"), {f"T_{j}": (ddl, [r for r in rows if hash((r[0] or 0)) % 4 == 2 * i + j]) for j in range(2)}) for i in range(2)]
    b = [database(str(tmp_path / "b.db"), {"T_0": (ddl, [r for r in other if (r[0] or 0) < 5000]), "T_1": (ddl, [r for r in other if (r[0] or 0) >= 5000]),
                                           "T_2": (ddl, [])})]
    return a, rows, b, other


def opts(urls, **kw):
    return {"url": urls, "schema-name": "main", "table-name": "T_.*", "scan.partition.column": "k", "scan.partition.num": 1} | kw


@pytest.mark.parametrize("seed,leaf,null_key", [(1, 1, "drop"), (2, 20, "keep"), (3, 10_000, "drop")])
def test_except_all(spark, tmp_path, seed, leaf, null_key):
    a, rows, b, other = copies(tmp_path, seed)
    kw = {"scan.null-key": null_key}
    x, y = (Counter(r for r in t if r[0] is not None or null_key == "keep") for t in (rows, other))
    want = Counter({(*r, "left"): n for r, n in (x - y).items()}) + Counter({(*r, "right"): n for r, n in (y - x).items()})
    got = except_all(spark, "k BIGINT, v STRING, f DOUBLE", opts(a, **kw), opts(b, **kw), leaf_rows=leaf, fan_out=8)
    assert Counter(map(tuple, got.collect())) == want and want


def test_ranges_that_differ_are_few_and_small(spark, tmp_path):
    a, rows, _, _ = copies(tmp_path, 4)
    changed = [(k, "changed" if k == 7 else v, f) for k, v, f in rows]
    b = [database(str(tmp_path / "c.db"), {"T_0": ("K INTEGER, V TEXT, F REAL", changed)})]
    ranges = differing_ranges(spark, "k BIGINT, v STRING, f DOUBLE", opts(a), opts(b), leaf_rows=1, fan_out=8).collect()
    assert [(int(r.lo), int(r.hi)) for r in ranges] == [(7, 7)]
    same = [database(str(tmp_path / "d.db"), {"T_0": ("K INTEGER, V TEXT, F REAL", rows)})]
    assert differing_ranges(spark, "k BIGINT, v STRING, f DOUBLE", opts(a), opts(same)).collect() == []
    none = opts(a, **{"table-name": "NONE"})
    assert differing_ranges(spark, "k BIGINT, v STRING, f DOUBLE", none, none).collect() == []
    n = sum(k is not None for k, _, _ in rows)
    assert except_all(spark, "k BIGINT, v STRING, f DOUBLE", none, opts(a), leaf_rows=50).count() == n


def test_copies_that_differ_everywhere_are_summed_once(spark, tmp_path, monkeypatch):
    """Keys that lie evenly: the first cut is fine enough, and no row is hashed again in rounds of smaller ranges."""
    from shardscan.operators import compare

    rows = [(k, f"v{k}", k / 2) for k in range(9000)]
    other = [(k, v, f + 1 if k % 100 == 0 else f) for k, v, f in rows]
    ddl = "K INTEGER, V TEXT, F REAL"
    a, b = ([database(str(tmp_path / f"{n}.db"), {"T_0": (ddl, r[:4000]), "T_1": (ddl, r[4000:])})] for n, r in (("a", rows), ("b", other)))
    rounds, sums = [], compare._sums
    monkeypatch.setattr(compare, "_sums", lambda *args: rounds.append(1) or sums(*args))
    got = except_all(spark, "k BIGINT, v STRING, f DOUBLE", opts(a), opts(b), leaf_rows=1000, fan_out=2).collect()
    x, y = Counter(rows), Counter(other)
    assert Counter(map(tuple, got)) == Counter({(*r, "left"): 1 for r in x - y}) + Counter({(*r, "right"): 1 for r in y - x})
    assert len(got) == 180 and len(rounds) == 1


def test_a_row_many_times_in_excess(spark, tmp_path):
    ddl = "K INTEGER, V TEXT"
    left, right = [(1, "x")] * 9000 + [(2, None)] * 3, [(1, "x")] * 5 + [(2, None)] * 4103 + [(3, "")] * 4096
    a, b = ([database(str(tmp_path / f"{n}.db"), {"T_0": (ddl, r)})] for n, r in (("l", left), ("r", right)))
    got = except_all(spark, "k BIGINT, v STRING", opts(a), opts(b)).groupBy("k", "v", "side").count().collect()
    assert sorted(map(tuple, got)) == [(1, "x", "left", 8995), (2, None, "right", 4100), (3, "", "right", 4096)]


def test_row_hash_tells_rows_apart_and_its_text():
    assert _row_hash("a|1:b", "c") != _row_hash("a", "b|1:c") and _row_hash(None) != _row_hash("-") and _row_hash("a", None) != _row_hash(None, "a")
    assert 0 <= _row_hash("x", 1) < 2 ** 60
    assert MYSQL.row_hash(["`a`"]) == ("CAST(CONV(SUBSTRING(MD5(CONCAT_WS('|', COALESCE(CONCAT(CHAR_LENGTH(CAST(`a` AS CHAR)), ':', CAST(`a` AS CHAR)), '-'))), "
                                       "1, 15), 16, 10) AS UNSIGNED)")
    assert "AS BIT(60)) AS BIGINT)" in POSTGRES.row_hash(['"a"']) and POSTGRES.mod("h", 5) == "MOD(h, 5)"
