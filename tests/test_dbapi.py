"""Flat DB-API backend (one BatchScan for all shards) over SQLite files."""

import os
import sqlite3
import tempfile

import pytest

from shardscan.sources import dbapi


@pytest.fixture(scope="module")
def files(spark):
    dbapi.register(spark)
    folder = tempfile.mkdtemp(prefix="shardscan-dbapi-test-")
    urls = []
    for i, rows in enumerate([[(1, "a"), (2, "b"), (3, "c"), (None, "n")], [(4, "a1"), (5, "b1"), (6, "c1")]]):
        path = os.path.join(folder, f"s{i}.db")
        c = sqlite3.connect(path)
        c.execute('CREATE TABLE "JDBCSOURCE_1" (id INTEGER, context TEXT)')
        c.execute('CREATE TABLE "OTHER_3" (id INTEGER, context_other TEXT)')
        c.executemany('INSERT INTO "JDBCSOURCE_1" VALUES (?, ?)', rows)
        c.execute('INSERT INTO "OTHER_3" VALUES (9, \'x\')')
        c.commit()
        c.close()
        urls.append(f"sqlite://{path}")
    return urls


def read(spark, urls, **kw):
    o = {"url": ";".join(urls), "table-name": "JDBCSOURCE.*", "schema-name": "main",
         "scan.partition.column": "id"}
    o.update({k: str(v) for k, v in kw.items()})
    return spark.read.format(dbapi.NAME).schema("id BIGINT, context STRING").options(**o).load()


def test_rows_and_partitions(spark, files):
    df = read(spark, files, **{"scan.batch.size": 2})
    assert df.rdd.getNumPartitions() == 4
    assert sorted((r.id, r.context) for r in df.collect()) == [
        (1, "a"), (2, "b"), (3, "c"), (4, "a1"), (5, "b1"), (6, "c1")]


def test_null_key_keep(spark, files):
    df = read(spark, files, **{"scan.partition.num": 3, "scan.null-key": "keep"})
    assert sorted(r.context for r in df.where("id IS NULL").collect()) == ["n"]
    assert df.count() == 7


def test_filter_then_count_same_frame(spark, files):
    df = read(spark, files, **{"scan.batch.size": 2})
    assert [(r.id, r.context) for r in df.where("context = 'b1' AND id > 1").collect()] == [(5, "b1")]
    assert df.count() == 6  # the filtered query must not leak into this one


def test_sql_view(spark, files):
    spark.sql(
        "CREATE OR REPLACE TEMPORARY VIEW flat_v (id BIGINT, context STRING) USING sharded_dbapi "
        f"OPTIONS (url '{';'.join(files)}', `table-name` 'JDBCSOURCE.*', `schema-name` 'main', "
        "`scan.partition.column` 'id', `scan.partition.num` '2')")
    assert spark.sql("SELECT COUNT(*) AS n FROM flat_v").first().n == 6


def test_missing_column(spark, files):
    with pytest.raises(Exception, match="lacks declared column"):
        read(spark, files, **{"table-name": "OTHER_3", "scan.batch.size": 2}).collect()


def test_conditions_query_and_bounds(spark, files):
    df = read(spark, files, **{"scan.batch.size": 2, "scan.conditions": "context=b1"})
    assert [(r.id, r.context) for r in df.collect()] == [(5, "b1")]
    q = 'SELECT "id", "context" FROM {table} WHERE "id" > 2'
    df = read(spark, files, **{"scan.partition.num": 2, "scan.query": q})
    assert sorted(r.id for r in df.collect()) == [3, 4, 5, 6]
    per_server = 'SELECT "id", "context" FROM "JDBCSOURCE_1"'
    df = read(spark, files, **{"scan.partition.num": 2, "scan.query": per_server})
    assert sorted(r.id for r in df.collect()) == [1, 2, 3, 4, 5, 6]
    df = read(spark, files, **{"scan.partition.num": 3, "scan.lower-bound": 2, "scan.upper-bound": 4})
    assert sorted(r.id for r in df.collect()) == [2, 3, 4]


def test_types_from_sqlite(spark):
    import datetime
    from decimal import Decimal

    dbapi.register(spark)
    folder = tempfile.mkdtemp(prefix="shardscan-dbapi-types-")
    path = os.path.join(folder, "t.db")
    c = sqlite3.connect(path)
    c.execute('CREATE TABLE "T_1" (k INTEGER, b INTEGER, d REAL, amt TEXT, ts TEXT, dt TEXT, s TEXT)')
    c.execute("INSERT INTO \"T_1\" VALUES (1, 1, 2.5, '12.34', '2024-01-02 03:04:05.678', '2024-01-02', 'x')")
    c.execute('INSERT INTO "T_1" VALUES (2, NULL, NULL, NULL, NULL, NULL, NULL)')
    c.commit()
    c.close()
    df = (spark.read.format(dbapi.NAME)
          .schema("k BIGINT, b BOOLEAN, d DOUBLE, amt DECIMAL(10,2), ts TIMESTAMP_NTZ, dt DATE, s STRING")
          .options(**{"url": f"sqlite://{path}", "table-name": "T_.*", "schema-name": "main",
                      "scan.partition.column": "k", "scan.partition.num": "2"}).load())
    rows = {r.k: r for r in df.collect()}
    r = rows[1]
    assert (r.b, r.d, r.amt, r.ts, r.dt, r.s) == (
        True, 2.5, Decimal("12.34"), datetime.datetime(2024, 1, 2, 3, 4, 5, 678000), datetime.date(2024, 1, 2), "x")
    assert all(v is None for v in list(rows[2])[1:])


def test_splits_per_task(spark, files):
    df = read(spark, files, **{"scan.batch.size": 1, "scan.splits-per-task": 2, "scan.null-key": "keep"})
    # splits in id order: server 0's 3 ranges, server 1's 3 ranges, then server 0's NULL split;
    # consecutive splits of one server pair up, servers never share a task
    assert df.rdd.getNumPartitions() == 5
    assert sorted((r.id is None, r.context) for r in df.collect()) == sorted(
        [(False, c) for c in ["a", "b", "c", "a1", "b1", "c1"]] + [(True, "n")])


def test_splits_per_task_is_flat_only(spark):
    from shardscan import sharded_scan

    with pytest.raises(ValueError, match="splits-per-task"):
        sharded_scan(spark, "id BIGINT", {"url": "jdbc:derby:memory:x", "table-name": "T", "schema-name": "APP",
                                          "scan.partition.column": "id", "scan.batch.size": 1,
                                          "scan.splits-per-task": 4})


def test_salted(spark, files):
    df = read(spark, files, **{"scan.partition.num": 1, "scan.salt.column": "id", "scan.salt.buckets": 3})
    assert df.rdd.getNumPartitions() == 6
    assert sorted(r.id for r in df.collect()) == [1, 2, 3, 4, 5, 6]


def test_keys_beyond_bigint(spark):
    dbapi.register(spark)
    folder = tempfile.mkdtemp(prefix="shardscan-dbapi-big-")
    path = os.path.join(folder, "b.db")
    c = sqlite3.connect(path)
    c.execute('CREATE TABLE "B_1" (k TEXT, v TEXT)')  # SQLite integers stop at 2^63-1: keys as text
    c.commit()
    c.close()
    df = (spark.read.format(dbapi.NAME).schema("k BIGINT, v STRING")
          .options(**{"url": f"sqlite://{path}", "table-name": "B_.*", "schema-name": "main",
                      "scan.partition.column": "k", "scan.partition.num": "2",
                      "scan.lower-bound": "5", "scan.upper-bound": "8"}).load())
    assert df.count() == 0
