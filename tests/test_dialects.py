"""SQL text per dialect (servers that cannot run here: only the text is checked)."""

from shardscan.options import ScanOptions
from shardscan.sources.dialects import dialect_for
from shardscan.sources.discovery import Shard, full_match
from shardscan.sources.probe import key_sql, probe_statement, source_sql


def _opts(url, **kw):
    o = {"url": [url], "table-name": "t.*", "schema-name": "db.*", "scan.partition.column": "id",
         "scan.batch.size": 10}
    o.update(kw)
    return ScanOptions.from_map(o)


def test_dialect_choice():
    assert dialect_for("jdbc:mysql://h/db").name == "mysql"
    maria = dialect_for("jdbc:mariadb://h/db")
    assert maria.name == "mariadb" and maria.driver == "org.mariadb.jdbc.Driver" and maria.scan_fetch_size > 0
    assert maria.quote("a") == "`a`" and maria.backslash_escapes
    assert dialect_for("jdbc:postgresql://h/db").name == "postgresql"
    assert dialect_for("jdbc:derby:memory:x").name == "derby"
    assert dialect_for("jdbc:sqlite:/x.db").name == "sqlite"
    assert dialect_for("jdbc:h2:mem:x").name == "generic"


def test_mysql_probe_and_quoting():
    url = "jdbc:mysql://h/db"
    o = _opts(url, **{"scan.null-key": "keep"})
    s = Shard(0, url, "db_1", "t`x", "TABLE", ("ID",))
    assert key_sql(s, o) == "`ID`"
    assert source_sql(s, o) == "`db_1`.`t``x`"
    sql = probe_statement(3, s, o)
    assert sql == (
        "SELECT 3 AS `shard_no`, (SELECT MIN(`ID`) FROM `db_1`.`t``x`) AS `mn`, "
        "(SELECT MAX(`ID`) FROM `db_1`.`t``x`) AS `mx`, (SELECT COUNT(*) FROM `db_1`.`t``x`) AS `n`, "
        "(SELECT COUNT(*) FROM `db_1`.`t``x` WHERE `ID` IS NULL) AS `n_null`")


def test_postgres_partition_mode_and_bounds():
    url = "jdbc:postgresql://h/db"
    o = _opts(url, **{"scan.batch.size": None, "scan.partition.num": 4,
                      "scan.lower-bound": -5, "scan.upper-bound": 5})
    s = Shard(1, url, "public", "T1", "TABLE", ("id",))
    sql = probe_statement(0, s, o)
    assert '(SELECT MIN("id") FROM "public"."T1" WHERE "id" BETWEEN -5 AND 5)' in sql
    assert 'CAST(NULL AS BIGINT) AS "n"' in sql and "FROM SYSIBM" not in sql


def test_derby_needs_a_dual_table():
    url = "jdbc:derby:memory:x"
    s = Shard(0, url, "APP", "T", "TABLE", ("ID",))
    assert probe_statement(0, s, _opts(url)).endswith(" FROM SYSIBM.SYSDUMMY1")


def test_query_source_wraps_and_substitutes():
    url = "jdbc:mysql://h/db"
    o = _opts(url, **{"scan.query": "SELECT id, v FROM {table} WHERE v > 1"})
    s = Shard(0, url, "db", "t_3", "TABLE")
    assert source_sql(s, o) == "(SELECT id, v FROM `db`.`t_3` WHERE v > 1) q"
    assert key_sql(s, o) == "`id`"


def test_full_match_anchor():
    assert full_match("a|b") == "\\A(?:a|b)\\z"


def test_integer_division_text():
    assert dialect_for("jdbc:mysql://h/db").int_div("k - 3", "10") == "(k - 3) DIV (10)"
    # DECIMAL keys: the quotient is cut to an integer in the database
    assert dialect_for("jdbc:derby:memory:x").int_div("k - 3", "10") == "CAST((k - 3) / (10) AS BIGINT)"
    assert dialect_for("jdbc:postgresql://h/db").int_div("k - 3", "10") == "DIV(CAST(k - 3 AS NUMERIC), CAST(10 AS NUMERIC))"
    assert dialect_for("jdbc:h2:mem:x").int_div("k", "10") == "CAST(FLOOR((k) / (10)) AS BIGINT)"


def test_literals():
    import datetime
    import decimal

    import pytest

    my, pg, dy, lite = (dialect_for(u) for u in ("jdbc:mysql://h/db", "jdbc:postgresql://h/db", "jdbc:derby:memory:x", "sqlite:///x"))
    assert pg.literal("a'b\\") == "'a''b\\'" and my.literal("a'b\\") == "'a''b\\\\'"
    assert my.literal("x\\' OR 1=1 --") == "'x\\\\'' OR 1=1 --'"
    assert [d.literal(True) for d in (my, pg, dy, lite)] == ["TRUE", "TRUE", "TRUE", "1"]
    assert pg.literal(datetime.date(2024, 1, 2)) == "DATE '2024-01-02'"
    assert pg.literal(datetime.datetime(2024, 1, 2, 3, 4, 5)) == "TIMESTAMP '2024-01-02 03:04:05'"
    assert pg.literal(decimal.Decimal("1.50")) == "1.50" and pg.literal(7) == "7"
    assert pg.equals('"c"', None) == '"c" IS NULL' and pg.equals('"c"', 1) == '"c" = 1'
    for bad in (float("nan"), float("inf"), None):
        with pytest.raises(ValueError):
            pg.literal(bad)


def test_catalog_prefilter_is_the_literal_prefix():
    from shardscan.sources.dialects import literal_prefix

    assert [literal_prefix(r) for r in ("ORDERS_.*", "EV_[0-9]+", "T1?", "a|b", "(?i)x", ".*", "abc", "ab+", "ab{2}", r"a\.b")] == [
        "ORDERS_", "EV_", "T", "", "", "", "abc", "a", "a", "a"]
    sql = dialect_for("jdbc:mysql://h/db").catalog("db_.*", "t%.*")
    assert "t.TABLE_SCHEMA LIKE 'db!_%' ESCAPE '!'" in sql and "LEFT JOIN" in sql and "t.TABLE_NAME LIKE 't%' ESCAPE" in sql
    assert dialect_for("sqlite:///x").catalog(".*", "a.*").endswith("AND m.name LIKE 'a%' ESCAPE '!'")


def test_typed_conditions():
    import datetime
    from decimal import Decimal

    import pytest

    from shardscan.sources.jdbc import as_schema, split_predicate, typed_value

    schema = as_schema("id BIGINT, d DATE, b BOOLEAN, m DECIMAL(5,2), s STRING, t TIMESTAMP(3)")
    assert [typed_value(v, schema, c) for v, c in (("5", "id"), ("2024-01-02", "D"), ("true", "b"), ("1.5", "m"), ("5", "s"), ("5", "other"))] == [
        5, datetime.date(2024, 1, 2), True, Decimal("1.5"), "5", "5"]
    with pytest.raises(ValueError, match="not a bigint"):
        typed_value("x", schema, "id")
    url = "jdbc:derby:memory:x"
    o = _opts(url, **{"scan.conditions": {"id": "5", "s": "it's", "d": None}})
    s = Shard(0, url, "APP", "T", "TABLE", ("id", "s", "d"))
    assert split_predicate(s, o, 1, 2, None, schema) == '"id" BETWEEN 1 AND 2 AND "id" = 5 AND "s" = \'it\'\'s\' AND "d" IS NULL'
    assert schema["t"].dataType.simpleString() == "timestamp_ntz"


def test_salt_buckets_leave_no_value_out():
    from shardscan.sources.dialects import salt_predicate

    assert salt_predicate('"c"', 3, 0) == '(MOD("c", 3) NOT IN (1, -2, 2, -1) OR "c" IS NULL)'
    assert salt_predicate('"c"', 3, 2) == 'MOD("c", 3) IN (2, -1)'
    assert salt_predicate('"c"', 1, 0) == '(1 = 1 OR "c" IS NULL)'


def test_split_reads_stream_by_default_where_drivers_buffer():
    o = _opts("jdbc:mysql://h/db")
    my, pg, dy = (dialect_for(u) for u in ("jdbc:mysql://h/db", "jdbc:postgresql://h/db", "jdbc:derby:memory:x"))
    assert o.jdbc_properties(my.driver, my.scan_fetch_size)["fetchsize"] == str(-(2**31))
    assert o.jdbc_properties(pg.driver, pg.scan_fetch_size)["fetchsize"] == "10000"
    assert "fetchsize" not in o.jdbc_properties(dy.driver, dy.scan_fetch_size)
    own = _opts("jdbc:mysql://h/db", **{"scan.fetch-size": 500})
    assert own.jdbc_properties(my.driver, my.scan_fetch_size)["fetchsize"] == "500"
