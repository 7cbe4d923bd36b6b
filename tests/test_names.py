"""Name patterns: the prefix sent to the catalog never cuts off a name the pattern fits; errors hold no password."""

import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from shardscan import discover_shards, scan_report, shard_stats, sharded_scan, skew_report_in_db, split_plan, split_row_counts_in_db
from shardscan.options import ScanOptions, redact
from shardscan.sources import dbapi
from shardscan.sources.dialects import DERBY, SQLITE, literal_prefix
from shardscan.sources.discovery import schemas

from conftest import derby_exec

ATOMS = st.sampled_from(["A", "B", "AB", "_", "$", "^", ".", ".*", "[AB]", "(A|B)", "(AB)", "A?", "B*", "A+", "A{2}", "B{0,1}", r"\$", r"\.", "-", " ",
                         "|", "(?:A)", "[^A]", r"\bA", "1"])


@given(st.lists(ATOMS, min_size=1, max_size=6).map("".join), st.text("AB_$-. 1", max_size=6))
@settings(max_examples=3000, deadline=None)
def test_prefix_is_sound(regex, name):
    try:
        fits = re.fullmatch(regex, name)
    except re.error:
        return
    assert not fits or name.startswith(literal_prefix(regex)), (regex, literal_prefix(regex))


NAMES = ["T_1", "T_2", "T$1", "T_1X", "TT", "U_1", "T_11"]
REGEXES = ["T_1$", "^T_1", "T_1", "T_[12]$", r"T\$1", "T_1.?", "T_1{2}", "T{2}", "T_?1", "(T|U)_1", "T_1|U_1", "T.*", ".*1$", "T_(1|2)$", "T_1$|TT", "$T_1", "T_1X?$"]


@pytest.fixture(scope="module")
def named(spark, tmp_path_factory):
    import sqlite3

    url = "jdbc:derby:memory:names_db"
    derby_exec(spark, url + ";create=true", *[f'CREATE TABLE "{n}" (K BIGINT)' for n in NAMES],
               *[f'INSERT INTO "{n}" VALUES ({i})' for i, n in enumerate(NAMES)])
    path = str(tmp_path_factory.mktemp("names") / "n.db")
    c = sqlite3.connect(path)
    for i, n in enumerate(NAMES):
        c.execute(f'CREATE TABLE "{n}" (K INTEGER)')
        c.execute(f'INSERT INTO "{n}" VALUES ({i})')
    c.commit()
    c.close()
    return url, f"sqlite://{path}"


@pytest.mark.parametrize("regex", REGEXES)
def test_both_backends_find_the_names_that_fit(spark, named, regex):
    derby, sqlite = named
    want = sorted(n for n in NAMES if re.fullmatch(regex, n))
    assert DERBY.catalog("APP$", regex) and SQLITE.catalog("main$", regex)
    found = discover_shards(spark, {"url": [derby], "schema-name": "APP$", "table-name": regex, "scan.partition.column": "K",
                                    "scan.partition.num": 1})
    assert sorted(r.table_name for r in found.collect()) == want
    dbapi.register(spark)
    rows = spark.read.format(dbapi.NAME).schema("K BIGINT").options(**{
        "url": sqlite, "schema-name": "main$", "table-name": regex, "scan.partition.column": "K", "scan.partition.num": "1"}).load()
    assert sorted(NAMES[r.K] for r in rows.collect()) == want


def test_redacted_up_to_the_last_at_sign():
    assert redact("jdbc:postgresql://u:p@ss@host/db") == "jdbc:postgresql://u:***@host/db"
    assert redact("mysql://u:a@b@c@h:3306/d?x=y@z") == "mysql://u:***@h:3306/d?x=y@z"
    assert redact("jdbc:postgresql://host:5432/db?mail=a@b") == "jdbc:postgresql://host:5432/db?mail=a@b"


BAD = "jdbc:derby:memory:names_no_such_db;user=u;password=hidden"
CALLS = {
    "discover_shards": lambda s, o: discover_shards(s, o).collect(),
    "schemas": lambda s, o: schemas(s, ScanOptions.from_map(o)).collect(),
    "shard_stats": lambda s, o: shard_stats(s, o).collect(),
    "sharded_scan": lambda s, o: sharded_scan(s, "k BIGINT", o).collect(),
    "split_plan": lambda s, o: split_plan(s, "k BIGINT", o).collect(),
    "split_row_counts_in_db": lambda s, o: split_row_counts_in_db(s, "k BIGINT", o).collect(),
    "skew_report_in_db": lambda s, o: skew_report_in_db(s, "k BIGINT", o).collect(),
}


@pytest.mark.parametrize("call", sorted(CALLS))
def test_public_calls_redact(spark, call):
    import traceback

    o = {"url": [BAD], "schema-name": ".*", "table-name": ".*", "scan.partition.column": "K", "scan.partition.num": 1, "password": "hidden"}
    with pytest.raises(RuntimeError) as e:
        CALLS[call](spark, o)
    assert "hidden" not in "".join(traceback.format_exception(e.value)).replace("'password': 'hidden'", "").replace("password=hidden\"", "")


def test_scan_report_by(spark, named):
    from shardscan import plan_scan

    plan = plan_scan(spark, "K BIGINT", {"url": [named[0]], "schema-name": "APP", "table-name": "T_.*", "scan.partition.column": "K",
                                         "scan.partition.num": 1})
    assert [tuple(r)[2:] for r in scan_report(spark, plan, by="schema").collect()] == [("APP", 4, 4)]
    with pytest.raises(ValueError, match="by must be"):
        scan_report(spark, plan, by="table")
