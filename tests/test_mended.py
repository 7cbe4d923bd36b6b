"""Cases a scan must not get wrong: wide keys, salts, many splits, empty matches, errors, lossless reads."""

import datetime
import decimal
import os
import sqlite3

import pyarrow as pa
import pytest

from conftest import derby_exec
from shardscan import discover_shards, plan_scan, scan_report, sharded_scan, split_plan, split_row_counts
from shardscan.options import RedactedCause, redacted_errors
from shardscan.sources import dbapi

TOP = 2**63 - 1


def opts(url, **kw):
    return {"url": [url], "table-name": "T_.*", "schema-name": "APP", "scan.partition.column": "K",
            "scan.partition.num": 2} | kw


@pytest.fixture(scope="module")
def wide(spark):
    url = "jdbc:derby:memory:mended_wide"
    derby_exec(spark, url + ";create=true", "CREATE TABLE T_1 (K DECIMAL(20,0), S DECIMAL(5,2), V INTEGER)",
               f"INSERT INTO T_1 VALUES ({2**64 - 10}, 1.5, 1), ({2**64 - 5}, 2.0, 2), ({2**64 - 2}, 3.0, 3)")
    return url


@pytest.mark.parametrize("schema", ["v INT", "v INT, k DECIMAL(10,0)", "v INT, k DECIMAL(20,0)"])
def test_keys_wider_than_declared_lose_no_row(spark, wide, schema):
    df = sharded_scan(spark, schema, opts(wide)).select("v")
    assert sorted(r.v for r in df.collect()) == [1, 2, 3]
    plan = split_plan(spark, schema, opts(wide)).collect()
    assert [int(r.lo) for r in plan][0] == 2**64 - 10 and all(int(r.lo) <= int(r.hi) for r in plan)


def test_fractional_salt_is_refused(spark, wide):
    with pytest.raises(ValueError, match="must be an integer"):
        sharded_scan(spark, "v INT", opts(wide, **{"scan.salt.column": "S", "scan.salt.buckets": 4}))


def test_many_splits_need_no_limit(spark):
    url = "jdbc:derby:memory:mended_many"
    derby_exec(spark, url + ";create=true", "CREATE TABLE T_1 (K BIGINT)", "INSERT INTO T_1 VALUES (0), (10000000)")
    plan = plan_scan(spark, "k BIGINT", opts(url, **{"scan.partition.num": 150_000}))
    assert plan.n_splits > 100_000
    with pytest.raises(ValueError, match="scan.max-splits=10"):
        plan_scan(spark, "k BIGINT", opts(url, **{"scan.partition.num": 150_000, "scan.max-splits": 10}))


def test_no_match_is_empty_in_the_declared_schema_and_discovery_lists_tables(spark, wide):
    df = sharded_scan(spark, "v INT, x STRING", opts(wide, **{"table-name": "NOPE_.*"}))
    assert df.collect() == [] and df.dtypes == [("v", "int"), ("x", "string")]
    found = discover_shards(spark, opts(wide)).select("url_no", "schema_name", "table_name").collect()
    assert [tuple(r) for r in found] == [(0, "APP", "T_1")]


def test_schemas_without_a_matched_table_are_counted(spark, wide):
    derby_exec(spark, wide, "CREATE SCHEMA AP2")
    plan = plan_scan(spark, "v INT", opts(wide, **{"schema-name": "AP.*"}))
    row = scan_report(spark, plan).first()
    assert (row.n_schemas, row.n_tables) == (2, 1)


def test_synonyms_are_discovered_and_a_table_without_the_columns_raises(spark, wide):
    derby_exec(spark, wide, "CREATE SYNONYM SYN_1 FOR T_1", "CREATE TABLE OTHER_1 (Z INTEGER)")
    kinds = {r.table_name: r.table_type for r in discover_shards(spark, opts(wide, **{"table-name": ".*_1"})).collect()}
    assert kinds["SYN_1"] == "SYNONYM" and "OTHER_1" in kinds
    with pytest.raises(ValueError, match="OTHER_1 lacks declared"):
        sharded_scan(spark, "v INT", opts(wide, **{"table-name": "OTHER_.*"}))


def test_causes_are_kept_without_passwords():
    try:
        with redacted_errors("scan", ("s3cret",)):
            try:
                raise OSError("jdbc://u:s3cret@host is down")
            except OSError as e:
                raise KeyError("x" * 5000 + " password=s3cret") from e
    except RuntimeError as e:
        first, second = e.__cause__, e.__cause__.__cause__
        assert isinstance(first, RedactedCause) and str(first).startswith("KeyError: ")
        assert str(second).startswith("OSError: ") and "is down" in str(second)
        assert "s3cret" not in f"{e}{first}{second}" and len(str(e)) > 5000
    else:
        raise AssertionError


def test_two_reads_of_the_input(spark, tmp_path):
    """split_row_counts reads its input twice: statistics, then rows."""
    src = str(tmp_path / "rows")
    spark.range(6000).selectExpr("id % 7 AS shard", "id AS k").write.parquet(src)
    df = spark.read.parquet(src)
    counts = split_row_counts(df, "shard", "k", batch_size=10)  # reads the keys once, for the statistics
    leaves = counts._jdf.queryExecution().optimizedPlan().collectLeaves().mkString("\n")
    assert leaves.count("Relation [") == 2 and leaves.count("mn#") == 1  # the input once more, and the statistics
    assert sum(r.n_rows for r in counts.collect()) == 6000


# ------------------------------------------------------------- flat backend
def lite(tmp_path, ddl, rows):
    path = os.path.join(str(tmp_path), "x.db")
    c = sqlite3.connect(path)
    c.execute(f'CREATE TABLE "T_1" ({ddl})')
    c.executemany(f'INSERT INTO "T_1" VALUES ({", ".join("?" * len(rows[0]))})', rows)
    c.commit()
    c.close()
    return f"sqlite://{path}"


def read(spark, url, schema, **kw):
    dbapi.register(spark)
    o = {"url": url, "table-name": "T_.*", "schema-name": "main", "scan.partition.column": "k", "scan.partition.num": "1"}
    return spark.read.format(dbapi.NAME).schema(schema).options(**o, **kw).load()


def test_zoned_timestamp_from_text_in_the_session_zone(spark, tmp_path):
    url = lite(tmp_path, "k INTEGER, t TEXT", [(1, "2024-01-02 03:04:05.678"), (2, None)])
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        df = read(spark, url, "k BIGINT, t TIMESTAMP")
        got = [r[0] for r in df.orderBy("k").selectExpr("CAST(t AS STRING)").collect()]
        epoch = df.where("k = 1").selectExpr("unix_millis(t)").first()[0]
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
        dbapi.register(spark)
    assert got == ["2024-01-02 03:04:05.678", None]
    assert epoch == int(datetime.datetime(2024, 1, 2, 8, 4, 5, 678000, datetime.timezone.utc).timestamp() * 1000)


def test_conditions_are_bound(spark, tmp_path):
    url = lite(tmp_path, "k INTEGER, s TEXT, b INTEGER", [(1, "it's", 1), (2, "x' OR '1'='1", 0), (3, None, 1)])
    def ids(cond):
        return sorted(r.k for r in read(spark, url, "k BIGINT, s STRING, b BOOLEAN", **{"scan.conditions": cond}).collect())
    assert ids("s=it's") == [1] and ids("s=x' OR '1'='1") == [2] and ids("b=true") == [1, 3] and ids("k=2") == [2]


def test_session_statement_and_refused_options(spark, tmp_path):
    url = lite(tmp_path, "k INTEGER", [(1,)])
    with pytest.raises(Exception, match="no such table: missing"):
        read(spark, url, "k BIGINT", **{"scan.session-init-statement": "SELECT * FROM missing"}).collect()
    with pytest.raises(Exception, match="no counterpart in SQLite"):
        read(spark, url, "k BIGINT", **{"scan.query-timeout": "5"}).collect()
    with pytest.raises(Exception, match="names a JDBC driver"):
        read(spark, url, "k BIGINT", driver="org.x.Driver").collect()
    for bad in (r"\p{Lu}.*", "[a-z&&[^b]]", "(?<n>T).*", r"\QT\E.*"):
        with pytest.raises(Exception, match="syntax Java and Python share"):
            read(spark, url, "k BIGINT", **{"table-name": bad}).collect() if False else dbapi.check_regex("table-name", bad)
    for good in ("T_[0-9]+", "a|b", r"x\d{2,3}", "(?:T).*", "(?i)t.*"):
        dbapi.check_regex("table-name", good)
    assert dbapi.full_match(r"T_\d", "T_1") and not dbapi.full_match(r"T_\d", "T_٣")  # ASCII digits, as in Java


def test_conversions_are_lossless():
    conv = dbapi.to_arrow
    assert conv([1, None, 2], pa.int64()).to_pylist() == [1, None, 2]
    assert conv(["7", None], pa.int64()).to_pylist() == [7, None]
    assert conv([1.0, 2], pa.int32()).to_pylist() == [1, 2]
    assert conv([0, 1, None], pa.bool_()).to_pylist() == [False, True, None]
    assert conv(["false", "true"], pa.bool_()).to_pylist() == [False, True]
    assert conv(["1.50", 2, None], pa.decimal128(5, 2)).to_pylist() == [decimal.Decimal("1.50"), decimal.Decimal(2), None]
    assert conv(["a", 1], pa.string()).to_pylist() == ["a", "1"]
    assert conv(["2024-01-02"], pa.date32()).to_pylist() == [datetime.date(2024, 1, 2)]
    assert conv([None, None], pa.float64()).to_pylist() == [None, None]
    ntz = pa.timestamp("us")
    assert conv(["2024-01-02 03:04:05"], ntz).to_pylist() == [datetime.datetime(2024, 1, 2, 3, 4, 5)]
    for bad, kind in (([1.7], pa.int64()), ([2], pa.bool_()), (["x"], pa.bool_()), (["x"], pa.int64()),
                      ([2**40], pa.int32()), (["1.234"], pa.decimal128(5, 2)), (["x"], pa.date32())):
        with pytest.raises(ValueError):
            conv(bad, kind)


def test_server_side_cursors(monkeypatch):
    """MySQL and PostgreSQL leave the result on the server (the drivers are stood in for)."""
    import sys
    import types

    module = types.ModuleType("pymysql.cursors")
    module.SSCursor = "streaming"
    monkeypatch.setitem(sys.modules, "pymysql", types.ModuleType("pymysql"))
    monkeypatch.setitem(sys.modules, "pymysql.cursors", module)
    asked = []

    class Conn:
        def cursor(self, *a, **k):
            asked.append((a, k))
            return types.SimpleNamespace()

    dbapi.stream_cursor(Conn(), "mysql", 5)
    cur = dbapi.stream_cursor(Conn(), "postgresql", 5)
    assert asked == [(("streaming",), {}), ((), {"name": "shardscan_split"})] and cur.itersize == 5


