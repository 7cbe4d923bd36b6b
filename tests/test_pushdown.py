"""Aggregates and top-k computed in the shards equal the same question over the scan."""

import datetime
import re
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from conftest import derby_exec
from shardscan import sharded_aggregate, sharded_scan, sharded_top_k

SCHEMA = "k BIGINT, i INT, d DECIMAL(9,2), f DOUBLE, t TIMESTAMP_NTZ, s STRING"


@pytest.fixture(scope="module")
def urls(spark):
    out = []
    for n in range(2):
        url = f"jdbc:derby:memory:pushdown_{n}"
        for t in range(3):
            name = f'"T_{t}"'
            values = []
            for r in range(40 if t < 2 else 0):
                key = "NULL" if r % 9 == 0 else str(r * 7 + t)
                i = "NULL" if r % 5 == 0 else str(2**31 - 1 - r)  # a 32-bit sum overflows
                values.append(f"({key}, {i}, {'NULL' if r % 7 == 0 else f'{r}.25'}, {r * 0.5 + n}E0, "
                              f"TIMESTAMP('2020-01-{r % 28 + 1:02d} 00:00:00'), '{'abc'[r % 3]}')")
            derby_exec(spark, url + ";create=true", f'CREATE TABLE {name} ("K" BIGINT, "I" INTEGER, "D" DECIMAL(9,2), "F" DOUBLE, '
                       '"T" TIMESTAMP, "S" VARCHAR(5))', *([f"INSERT INTO {name} VALUES {', '.join(values)}"] if values else []))
        out.append(url)
    return out


def opts(urls, **kw):
    return {"url": urls, "schema-name": "APP", "table-name": "T_.*", "scan.partition.column": "k", "scan.partition.num": 3} | kw


AGGS = {"n": ("count", None), "ni": ("count", "i"), "si": ("sum", "i"), "sd": ("sum", "d"), "sf": ("sum", "f"), "lo": ("min", "t"),
        "hi": ("max", "d"), "ai": ("avg", "i"), "ad": ("avg", "d"), "af": ("avg", "f"), "mk": ("min", "k")}


def over_scan(df, group):
    return df.groupBy(*group).agg(
        F.count("*").alias("n"), F.count("i").alias("ni"), F.sum("i").alias("si"), F.sum("d").alias("sd"), F.sum("f").alias("sf"),
        F.min("t").alias("lo"), F.max("d").alias("hi"), F.avg("i").alias("ai"), F.avg("d").alias("ad"), F.avg("f").alias("af"), F.min("k").alias("mk"))


def rows(df):
    return sorted((tuple(round(v, 6) if isinstance(v, float) else v for v in r) for r in df.collect()), key=str)


@pytest.mark.parametrize("kw", [{}, {"scan.null-key": "keep"}, {"scan.conditions": {"s": "b"}}, {"scan.lower-bound": 20, "scan.upper-bound": 90},
                                {"scan.key-ranges": "3:40,100"}], ids=str)
@pytest.mark.parametrize("group", [(), ("s",)], ids=str)
def test_aggregates(spark, urls, kw, group):
    o = opts(urls, **kw)
    got = sharded_aggregate(spark, SCHEMA, o, AGGS, group)
    want = over_scan(sharded_scan(spark, SCHEMA, o), group)
    assert got.dtypes == want.dtypes and rows(got) == rows(want)


def test_every_shard_aggregates_in_its_database(spark, urls):
    got = sharded_aggregate(spark, SCHEMA, opts(urls), {"n": ("count", None), "sk": ("sum", "k"), "hi": ("max", "i")}, ["s"], "f > 3")
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert len(re.findall(r"Scan JDBC", plan)) == 6 == len(re.findall(r"PushedAggregates: \[COUNT\(\*\), SUM\(K\), MAX\(I\)\]", plan))
    assert len(re.findall(r"PushedGroupByExpressions: \[S\]", plan)) == 6
    assert rows(got) == rows(sharded_scan(spark, SCHEMA, opts(urls)).where("f > 3").groupBy("s").agg(
        F.count("*").alias("n"), F.sum("k").alias("sk"), F.max("i").alias("hi")))


def test_a_condition_the_database_cannot_take(spark, urls):
    where = F.hash("s") % 2 == 0
    got = sharded_aggregate(spark, SCHEMA, opts(urls), {"n": ("count", None)}, ["s"], where)
    assert rows(got) == rows(sharded_scan(spark, SCHEMA, opts(urls)).where(where).groupBy("s").agg(F.count("*").alias("n")))


def test_nothing_matches(spark, urls):
    none = opts(urls, **{"table-name": "NOPE"})
    assert [tuple(r) for r in sharded_aggregate(spark, SCHEMA, none, {"n": ("count", None), "m": ("max", "i"), "a": ("avg", "d")}).collect()] == [
        (0, None, None)]
    assert sharded_aggregate(spark, SCHEMA, none, {"n": ("count", None)}, ["s"]).collect() == []
    assert sharded_top_k(spark, SCHEMA, none, [("k", "asc")], 3).collect() == []


@pytest.mark.parametrize("order", [[("k", "asc"), ("f", "asc")], [("i", "desc"), ("f", "desc"), ("k", "asc")], [("i", "asc"), ("f", "asc"), ("k", "desc")],
                                   [("t", "desc"), ("f", "asc"), ("k", "asc")], [("d", "asc"), ("f", "asc"), ("k", "asc")]], ids=str)
@pytest.mark.parametrize("kw", [{}, {"scan.null-key": "keep"}], ids=str)
def test_top_k(spark, urls, order, kw):
    o = opts(urls, **kw)
    by = [F.col(c).asc() if w == "asc" else F.col(c).desc() for c, w in order]
    for k in (1, 13, 1000):
        got = sharded_top_k(spark, SCHEMA, o, order, k)
        want = sharded_scan(spark, SCHEMA, o).orderBy(*by).limit(k)
        assert [[r[c] for c, _ in order] for r in got.collect()] == [[r[c] for c, _ in order] for r in want.collect()]
        assert got.dtypes == want.dtypes
    assert got._jdf.queryExecution().executedPlan().toString().count("FETCH FIRST 1000 ROWS ONLY") >= 2


def test_refused(spark, urls):
    for aggs in ({"x": ("median", "i")}, {"x": ("sum", None)}, {"x": ("sum", "nope")}, {"x": ("min", "s")}, {"x": ("sum", "s")}, {"x": ("avg", "t")}):
        with pytest.raises(ValueError, match="'x'"):
            sharded_aggregate(spark, SCHEMA, opts(urls), aggs)
    with pytest.raises(ValueError, match="not declared"):
        sharded_aggregate(spark, SCHEMA, opts(urls), {"n": ("count", None)}, ["zz"])
    with pytest.raises(ValueError, match="scan.query"):
        sharded_aggregate(spark, SCHEMA, opts(urls, **{"scan.query": "SELECT 1"}), {"n": ("count", None)})
    for order, k in (([("s", "asc")], 3), ([("k", "up")], 3), ([], 3), ([("k", "asc")], 0)):
        with pytest.raises(ValueError):
            sharded_top_k(spark, SCHEMA, opts(urls), order, k)
    with pytest.raises(ValueError, match="lacks declared"):
        sharded_top_k(spark, "k BIGINT, nope INT", opts(urls), [("k", "asc")], 3)
