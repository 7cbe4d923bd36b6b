"""Golden splits and rows from the two-server fixture (three tables each,
the third must not match), plus error paths and the type round trip."""

import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from conftest import derby_exec
from shardscan import discover_shards, plan_scan, register_view, scan_report, sharded_scan, split_plan

URLS = ["jdbc:derby:memory:golden_test1", "jdbc:derby:memory:golden_test2"]
SCHEMA = "id BIGINT NOT NULL, context VARCHAR(255)"


@pytest.fixture(scope="module")
def servers(spark):
    for url in URLS:
        derby_exec(
            spark, url + ";create=true",
            "CREATE TABLE jdbcSource_1 (id BIGINT NOT NULL, context VARCHAR(255))",
            "CREATE TABLE jdbcSource_2 (id BIGINT NOT NULL, context VARCHAR(255))",
            "CREATE TABLE other_3 (id BIGINT NOT NULL, context_other VARCHAR(255))",
            "INSERT INTO jdbcSource_1 VALUES (1, 'a'), (2, 'b'), (3, 'c')",
            "INSERT INTO jdbcSource_2 VALUES (4, 'a1'), (5, 'b1'), (6, 'c1')",
            "INSERT INTO other_3 VALUES (7, 'a2'), (8, 'b2'), (9, 'c2')",
        )
    return URLS


def _opts(urls, **kw):
    o = {"url": urls, "table-name": "JDBCSOURCE.*", "schema-name": "APP", "scan.partition.column": "id"}
    o.update(kw)
    return o


# The golden fixture's eight ranges (two servers, two matched tables, two ranges each).
GOLDEN_SPLITS = [
    (0, 0, "APP", "JDBCSOURCE_1", 1, 2), (1, 0, "APP", "JDBCSOURCE_1", 3, 4),
    (2, 0, "APP", "JDBCSOURCE_2", 4, 5), (3, 0, "APP", "JDBCSOURCE_2", 6, 7),
    (4, 1, "APP", "JDBCSOURCE_1", 1, 2), (5, 1, "APP", "JDBCSOURCE_1", 3, 4),
    (6, 1, "APP", "JDBCSOURCE_2", 4, 5), (7, 1, "APP", "JDBCSOURCE_2", 6, 7),
]


@pytest.mark.parametrize("mode", [{"scan.batch.size": 2}, {"scan.partition.num": 2}])
def test_golden_splits(spark, servers, mode):
    plan = split_plan(spark, SCHEMA, _opts(servers, **mode))
    got = sorted((r.split_id, r.url_no, r.schema_name, r.table_name, r.lo, r.hi) for r in plan.collect())
    assert got == GOLDEN_SPLITS
    q = plan.where("split_id = 0").first().query
    assert q == 'SELECT "ID", "CONTEXT" FROM "APP"."JDBCSOURCE_1" WHERE "ID" BETWEEN 1 AND 2'


def test_golden_rows_bag_union(spark, servers):
    df = sharded_scan(spark, SCHEMA, _opts(servers, **{"scan.batch.size": 2}))
    assert df.columns == ["id", "context"]
    assert df.rdd.getNumPartitions() == 8
    rows = sorted((r.id, r.context) for r in df.collect())
    expected = sorted([(1, "a"), (2, "b"), (3, "c"), (4, "a1"), (5, "b1"), (6, "c1")] * 2)
    assert rows == expected


def test_discovery_and_report(spark, servers):
    d = discover_shards(spark, _opts(servers, **{"scan.batch.size": 2}))
    assert sorted((r.url_no, r.table_name) for r in d.collect()) == [
        (0, "JDBCSOURCE_1"), (0, "JDBCSOURCE_2"), (1, "JDBCSOURCE_1"), (1, "JDBCSOURCE_2")]
    plan = plan_scan(spark, SCHEMA, _opts(servers, **{"scan.batch.size": 2}))
    rep = {r.url_no: (r.n_schemas, r.n_tables, r.n_splits) for r in scan_report(spark, plan).collect()}
    assert rep == {0: (1, 2, 4), 1: (1, 2, 4)}


def test_lower_case_regex_matches_nothing(spark, servers):
    df = sharded_scan(spark, SCHEMA, _opts(servers, **{"table-name": "jdbcsource.*", "scan.batch.size": 2}))
    assert df.count() == 0
    assert [f.name for f in df.schema.fields] == ["id", "context"]


def test_regex_is_whole_string(spark, servers):
    df = sharded_scan(spark, SCHEMA, _opts(servers, **{"table-name": "JDBCSOURCE", "scan.batch.size": 2}))
    assert df.count() == 0


def test_missing_column_is_a_plan_time_error(spark, servers):
    with pytest.raises(ValueError, match="OTHER_3"):
        plan_scan(spark, SCHEMA, _opts(servers, **{"table-name": ".*_3", "scan.batch.size": 2}))


def test_view_matches_and_sql_surface(spark, servers):
    url = "jdbc:derby:memory:golden_views"
    derby_exec(spark, url + ";create=true",
               "CREATE TABLE JDBCSOURCE_T (id BIGINT, context VARCHAR(20))",
               "INSERT INTO JDBCSOURCE_T VALUES (1, 'x'), (2, 'y'), (NULL, 'n')",
               "CREATE VIEW JDBCSOURCE_V AS SELECT id, context FROM JDBCSOURCE_T WHERE id > 1")
    o = _opts([url], **{"scan.batch.size": 1})
    register_view(spark, "golden_v", SCHEMA, o)
    assert sorted(r.id for r in spark.sql("SELECT id FROM golden_v").collect()) == [1, 2, 2]
    only_tables = sharded_scan(spark, SCHEMA, dict(o, **{"table-types": "TABLE"}))
    assert only_tables.count() == 2  # NULL key dropped, view excluded
    kept = sharded_scan(spark, SCHEMA, dict(o, **{"table-types": "TABLE", "scan.null-key": "keep"}))
    assert sorted((r.id is None, r.context) for r in kept.collect()) == [(False, "x"), (False, "y"), (True, "n")]


def test_password_never_in_plan(spark, servers):
    url = "jdbc:derby:memory:golden_auth"
    derby_exec(spark, url + ";create=true", "CREATE TABLE JDBCSOURCE_A (id BIGINT, context VARCHAR(9))",
               "INSERT INTO JDBCSOURCE_A VALUES (1, 'p')")
    o = _opts([url + ";password=topsecret"], **{"scan.batch.size": 1, "password": "hunter2", "username": "app"})
    plan = split_plan(spark, SCHEMA, o)
    text = " ".join(str(v) for r in plan.collect() for v in r)
    assert "topsecret" not in text and "hunter2" not in text


def test_type_round_trip(spark):
    url = "jdbc:derby:memory:golden_types"
    derby_exec(
        spark, url + ";create=true",
        "CREATE TABLE TYPES_1 (k BIGINT, b BOOLEAN, s SMALLINT, i INTEGER, r REAL, d DOUBLE, "
        "amt DECIMAL(10,2), dt DATE, ts TIMESTAMP, v VARCHAR(20), bin VARCHAR(8) FOR BIT DATA)",
        "INSERT INTO TYPES_1 VALUES (1, TRUE, 7, 70, 1.5, 2.25, 12.34, '2024-01-02', "
        "'2024-01-02 03:04:05.678', 'hello', X'CAFE')",
        "INSERT INTO TYPES_1 VALUES (2, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL)",
    )
    schema = ("k BIGINT, b BOOLEAN, s SMALLINT, i INT, r FLOAT, d DOUBLE, amt DECIMAL(10,2), dt DATE, "
              "ts TIMESTAMP, v STRING, bin BINARY")
    df = sharded_scan(spark, schema, {"url": [url], "table-name": "TYPES_.*", "schema-name": "APP",
                                      "scan.partition.column": "k", "scan.partition.num": 2})
    assert df.schema.simpleString() == (
        "struct<k:bigint,b:boolean,s:smallint,i:int,r:float,d:double,amt:decimal(10,2),dt:date,"
        "ts:timestamp,v:string,bin:binary>")
    rows = {r.k: r for r in df.collect()}
    r = rows[1]
    assert (r.b, r.s, r.i, r.r, r.d, r.amt, r.dt, r.v, bytes(r.bin)) == (
        True, 7, 70, 1.5, 2.25, Decimal("12.34"), datetime.date(2024, 1, 2), "hello", b"\xca\xfe")
    assert r.ts == datetime.datetime(2024, 1, 2, 3, 4, 5, 678000)
    assert all(v is None for v in list(rows[2])[1:])


def test_pushdown_reaches_every_shard(spark, servers):
    df = sharded_scan(spark, SCHEMA, _opts(servers, **{"scan.batch.size": 2}))
    plan = df.where(F.col("context") == "a").select("id")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("PushedFilters: [*IsNotNull(CONTEXT), *EqualTo(CONTEXT,a)]") == 4
    assert plan.count("ReadSchema: struct<ID:bigint>") == 4


def test_documented_example_schema(spark):
    """The documented example: lower-case names matched by lower-case regexes,
    TIMESTAMP(3) columns, a key in batch-size mode; two servers."""
    urls = ["jdbc:derby:memory:golden_doc1", "jdbc:derby:memory:golden_doc2"]
    for i, url in enumerate(urls):
        derby_exec(
            spark, url + ";create=true",
            'CREATE SCHEMA "test_database_a"',
            'CREATE TABLE "test_database_a"."test_table_1" ("id" BIGINT, "dbctime" TIMESTAMP, '
            '"dbutime" TIMESTAMP, "extension" VARCHAR(100))',
            'CREATE TABLE "test_database_a"."other" ("id" BIGINT)',
            f"INSERT INTO \"test_database_a\".\"test_table_1\" VALUES ({10 * i + 1}, "
            "'2021-01-02 03:04:05.123', '2021-01-02 03:04:06.456', 'x')",
        )
    df = sharded_scan(
        spark,
        "`id` BIGINT COMMENT '', `dbctime` TIMESTAMP(3) COMMENT '', `dbutime` TIMESTAMP(3), `extension` STRING",
        {"url": urls, "table-name": "test_table.*", "schema-name": "test_database.*",
         "scan.partition.column": "id", "scan.batch.size": 100000, "username": "u", "password": "p"})
    assert df.schema.simpleString() == "struct<id:bigint,dbctime:timestamp_ntz,dbutime:timestamp_ntz,extension:string>"
    rows = sorted(df.collect())
    assert [r.id for r in rows] == [1, 11]
    assert rows[0].dbctime == datetime.datetime(2021, 1, 2, 3, 4, 5, 123000)
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")  # not the JVM's: zoneless values stay
    try:
        texts = [r[0] for r in df.selectExpr("CAST(dbctime AS STRING)").collect()]
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert texts == ["2021-01-02 03:04:05.123"] * 2


def test_query_source_per_server(spark, servers):
    q = 'SELECT "ID" AS "id", "CONTEXT" AS "context" FROM "APP"."JDBCSOURCE_2"'
    df = sharded_scan(spark, SCHEMA, _opts(servers, **{"scan.query": q, "scan.partition.num": 2}))
    assert sorted((r.id, r.context) for r in df.collect()) == sorted([(4, "a1"), (5, "b1"), (6, "c1")] * 2)
    plan = split_plan(spark, SCHEMA, _opts(servers, **{"scan.query": q, "scan.partition.num": 2}))
    assert sorted((r.url_no, r.lo, r.hi) for r in plan.collect()) == [(0, 4, 5), (0, 6, 7), (1, 4, 5), (1, 6, 7)]


def test_bounds_with_null_keys_kept(spark):
    url = "jdbc:derby:memory:golden_bounds_nulls"
    derby_exec(spark, url + ";create=true",
               "CREATE TABLE JDBCSOURCE_B (id BIGINT, context VARCHAR(9))",
               "INSERT INTO JDBCSOURCE_B VALUES (1, 'a'), (5, 'b'), (9, 'c'), (NULL, 'n')")
    for mode in ({"scan.batch.size": 1}, {"scan.partition.num": 2}):
        o = _opts([url], **mode, **{"scan.lower-bound": 2, "scan.upper-bound": 9, "scan.null-key": "keep"})
        got = sorted((r.id is None, r.context) for r in sharded_scan(spark, SCHEMA, o).collect())
        assert got == [(False, "b"), (False, "c"), (True, "n")], mode


def test_decimal_key(spark):
    url = "jdbc:derby:memory:golden_decimal_key"
    big = 2**64 - 10
    derby_exec(spark, url + ";create=true",
               "CREATE TABLE JDBCSOURCE_D (id DECIMAL(20,0), context VARCHAR(9))",
               *[f"INSERT INTO JDBCSOURCE_D VALUES ({big + i}, 'r{i}')" for i in range(0, 10, 2)])
    schema = "id DECIMAL(20,0), context STRING"
    o = _opts([url], **{"scan.partition.num": 2})
    plan = sorted((int(r.lo), int(r.hi)) for r in split_plan(spark, schema, o).collect())
    assert plan == [(big, big + 4), (big + 5, big + 9)]
    assert sorted(int(r.id) for r in sharded_scan(spark, schema, o).collect()) == [big + i for i in range(0, 10, 2)]


def test_condition_on_undeclared_column(spark, servers):
    o = _opts(servers, **{"scan.batch.size": 2, "scan.conditions": {"context": "b1"}})
    df = sharded_scan(spark, "id BIGINT", o)
    assert sorted(r.id for r in df.collect()) == [5, 5]
    q = split_plan(spark, "id BIGINT", o).where("split_id = 2").first().query
    assert q == 'SELECT "ID" FROM "APP"."JDBCSOURCE_2" WHERE "ID" BETWEEN 4 AND 5 AND "CONTEXT" = \'b1\''


def test_salted_hot_key(spark):
    """One key value holds most rows: salt buckets cut its range into parallel reads."""
    url = "jdbc:derby:memory:golden_salt"
    rows = [(7, i) for i in range(-50, 150)] + [(k, k) for k in range(1, 30)] + [(None, 3), (8, None)]
    derby_exec(spark, url + ";create=true", "CREATE TABLE JDBCSOURCE_S (id BIGINT, seq BIGINT)",
               *[f"INSERT INTO JDBCSOURCE_S VALUES ({'NULL' if a is None else a}, {'NULL' if b is None else b})"
                 for a, b in rows])
    o = _opts([url], **{"scan.batch.size": 100, "scan.null-key": "keep",
                        "scan.salt.column": "seq", "scan.salt.buckets": 4})
    df = sharded_scan(spark, "id BIGINT, seq BIGINT", o)
    plan = split_plan(spark, "id BIGINT, seq BIGINT", o).collect()
    assert df.rdd.getNumPartitions() == len(plan) == 4 * len({(r.split_no, r.lo) for r in plan})
    got = sorted(((r.id, r.seq) for r in df.collect()), key=str)
    assert got == sorted(rows, key=str)


def test_split_row_counts_in_db(spark):
    from collections import Counter

    from shardscan import split_row_counts_in_db
    from shardscan.plans.rule import split_ranges

    url = "jdbc:derby:memory:golden_rows_in_db"
    keys = [3, 3, 3, 4, 10, 11, 12, 40, None, None]
    derby_exec(spark, url + ";create=true", "CREATE TABLE JDBCSOURCE_R (id BIGINT, context VARCHAR(9))",
               *[f"INSERT INTO JDBCSOURCE_R VALUES ({'NULL' if k is None else k}, '{'x' if i % 2 else 'y'}')"
                 for i, k in enumerate(keys)])
    for extra in ({"scan.batch.size": 3}, {"scan.partition.num": 4, "scan.null-key": "keep"},
                  {"scan.batch.size": 2, "scan.conditions": {"context": "x"}}):
        o = _opts([url], **extra)
        got = {r.split_no: r.n_rows for r in split_row_counts_in_db(spark, SCHEMA, o).collect()}
        nn = [k for k in keys if k is not None]
        ranges = split_ranges(min(nn), max(nn), len(keys), batch_size=extra.get("scan.batch.size"),
                              partition_num=extra.get("scan.partition.num"))
        rows = [(k, "x" if i % 2 else "y") for i, k in enumerate(keys)]
        if "scan.conditions" in extra:
            rows = [r for r in rows if r[1] == "x"]
        want = Counter()
        for k, _ in rows:
            if k is None:
                if extra.get("scan.null-key") == "keep":
                    want[None] += 1
                continue
            want[next(i for i, (lo, hi) in enumerate(ranges) if lo <= k <= hi)] += 1
        assert got == dict(want), extra


def test_unreachable_server_error_is_redacted(spark):
    o = {"url": ["jdbc:derby:memory:no_such_db_xyz;password=topsecret"], "table-name": "T",
         "schema-name": "APP", "scan.partition.column": "id", "scan.batch.size": 1, "password": "hunter2"}
    with pytest.raises(RuntimeError) as err:
        sharded_scan(spark, SCHEMA, o)
    text = str(err.value)
    assert "shard discovery failed" in text
    assert "topsecret" not in text and "hunter2" not in text


def test_declared_bounds_are_hard_limits(spark):
    url = "jdbc:derby:memory:golden_bounds_hard"
    derby_exec(spark, url + ";create=true", "CREATE TABLE JDBCSOURCE_H (id BIGINT, context VARCHAR(9))",
               *[f"INSERT INTO JDBCSOURCE_H VALUES ({k}, 'r{k}')" for k in range(1, 21)])
    o = _opts([url], **{"scan.partition.num": 3, "scan.lower-bound": 2, "scan.upper-bound": 9})
    plan = sorted((r.lo, r.hi) for r in split_plan(spark, SCHEMA, o).collect())
    assert plan == [(2, 4), (5, 7), (8, 9)]
    assert sorted(r.id for r in sharded_scan(spark, SCHEMA, o).collect()) == list(range(2, 10))


def test_scan_report_lists_servers_without_matches(spark, servers):
    empty = "jdbc:derby:memory:golden_empty_server"
    derby_exec(spark, empty + ";create=true", "CREATE TABLE OTHER_9 (id BIGINT)")
    plan = plan_scan(spark, SCHEMA, _opts(servers + [empty], **{"scan.batch.size": 2}))
    rep = {r.url_no: (r.n_tables, r.n_splits) for r in scan_report(spark, plan).collect()}
    assert rep == {0: (2, 4), 1: (2, 4), 2: (0, 0)}


def test_max_parallel_reads(spark, servers):
    o = _opts(servers, **{"scan.batch.size": 1, "scan.max-parallel-reads": 3})
    df = sharded_scan(spark, SCHEMA, o)
    assert df.rdd.getNumPartitions() == 3
    rows = sorted((r.id, r.context) for r in df.collect())
    assert rows == sorted([(1, "a"), (2, "b"), (3, "c"), (4, "a1"), (5, "b1"), (6, "c1")] * 2)


def test_discovery_reports_table_kinds(spark):
    url = "jdbc:derby:memory:golden_kinds"
    derby_exec(spark, url + ";create=true", "CREATE TABLE KIND_T (id BIGINT)",
               "CREATE VIEW KIND_V AS SELECT id FROM KIND_T")
    o = {"url": [url], "table-name": "KIND_.*", "schema-name": "APP", "scan.partition.column": "id",
         "scan.batch.size": 1}
    kinds = {r.table_name: r.table_type for r in discover_shards(spark, o).collect()}
    assert kinds == {"KIND_T": "TABLE", "KIND_V": "VIEW"}
    only_views = {r.table_name for r in discover_shards(spark, dict(o, **{"table-types": "VIEW"})).collect()}
    assert only_views == {"KIND_V"}
