"""Aggregates and top-k over the logical table, computed in the shards.

Spark does not push an aggregate or a top-k below a union, so the logical table would send every
row.  Both are split by hand into a partial question per shard and a small merge:

* :func:`sharded_aggregate` reads every shard through Spark's JDBC *catalog* (DataSource V2), whose scans take the whole
  aggregate into their SQL (``PushedAggregates``, ``PushedGroupByExpressions``): a shard sends one row
  per group.  The partial results are merged by a second ``groupBy``.
* :func:`sharded_top_k` sends each shard its own ``ORDER BY ... LIMIT k`` as text, in its dialect; at most ``k`` rows a
  shard reach the final sort.  (The V2 scan is not used for this: it drops the limit on a database whose Spark dialect has no
  limit clause, Derby for one, and then returns every row.)

Both equal the same question over ``sharded_scan``: NULL keys, declared bounds, key ranges and equality conditions count as
there.  Groups are told apart by the databases' own equality; minima, maxima and orders of text follow collations
that differ from Spark's, so those are refused.
"""

from __future__ import annotations

import hashlib
from collections.abc import Mapping, Sequence
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, FractionalType, IntegralType, LongType, StringType, StructType, TimestampNTZType

from shardscan.options import ScanOptions, redacted_errors
from shardscan.sources.discovery import Shard, check_columns, resolve_shards
from shardscan.sources.jdbc import _bq, as_options, as_schema, conditions_sql, typed_value
from shardscan.sources.probe import CHUNK_TABLES_COUNT, key_sql, source_sql, union_all_statements
from shardscan.util import balanced_union, parallel_map

CATALOG = "org.apache.spark.sql.execution.datasources.v2.jdbc.JDBCTableCatalog"
AGGREGATES = ("count", "sum", "min", "max", "avg")


def server_catalog(spark: SparkSession, opts: ScanOptions, url_no: int, driver: str | None, ntz: bool) -> str:
    """The name of the session's JDBC catalog of a server, registered once per server and settings.

    User and password become session settings of that catalog (``spark.sql.catalog.<name>.password``), which Spark
    redacts wherever it lists its settings."""
    props = opts.jdbc_properties(driver)
    if ntz:
        props["preferTimestampNTZ"] = "true"
    props = {"url": opts.urls[url_no], "pushDownAggregate": "true", **props}
    name = "shardscan_" + hashlib.sha256(repr(sorted(props.items())).encode()).hexdigest()[:16]
    root = f"spark.sql.catalog.{name}"
    if spark.conf.get(root, None) is None:
        for k, v in props.items():
            spark.conf.set(f"{root}.{k}", v)
        spark.conf.set(root, CATALOG)
    return name


def _shards(spark: SparkSession, schema: StructType, opts: ScanOptions, call: str) -> list[Shard]:
    if opts.query:
        raise ValueError(f"{call} reads tables; 'scan.query' has no place in it")
    names = [f.name for f in schema.fields] + [opts.partition_column] + [c for c, _ in opts.conditions]
    shards = resolve_shards(spark, opts, names)
    check_columns(shards, names, opts)
    return shards


def _in_scan(key: Column, conditions: Sequence[tuple[Column, Any]], opts: ScanOptions) -> Column:
    """The rows a scan reads: key bounds and ranges, NULL keys, equality conditions."""
    parts = [key.isNotNull()] if opts.null_key != "keep" or opts.key_ranges else []
    if opts.explicit_bounds:
        bound = key.between(opts.lower_bound, opts.upper_bound)
        parts.append(bound | key.isNull() if opts.null_key == "keep" else bound)
    if opts.key_ranges:
        parts.append(reduce(lambda a, b: a | b, [key.between(lo, hi) for lo, hi in opts.key_ranges.ranges]))
    parts += [c.isNull() if v is None else c == F.lit(v) for c, v in conditions]
    return reduce(lambda a, b: a & b, parts) if parts else F.lit(True)


def sharded_aggregate(spark: SparkSession, schema: StructType | str, options: ScanOptions | Mapping[str, Any] | None,
                      aggs: Mapping[str, tuple[str, str | None]], group_by: Sequence[str] = (),
                      where: Column | str | None = None) -> DataFrame:
    """``group_by`` columns and one column per entry ``out: (function, column)`` of ``aggs``, each shard aggregated in its
    database.  Functions: ``count`` (column None: rows), ``sum``, ``min``, ``max``, ``avg``.  ``where`` is a condition on the
    declared columns; what the database cannot take of it Spark applies, then that shard is aggregated in Spark.

    Without ``group_by`` there is one row, also when no table matches."""
    opts = as_options(options)
    schema = as_schema(schema)
    kinds = {f.name: f.dataType for f in schema.fields}
    for out, (fn, column) in aggs.items():
        if fn not in AGGREGATES or (column is None and fn != "count"):
            raise ValueError(f"{out!r}: {fn!r} of {column!r}: one of {AGGREGATES} of a declared column, or count of None")
        if column is not None and column not in kinds:
            raise ValueError(f"{out!r}: {column!r} is not declared")
        if fn in ("min", "max") and isinstance(kinds[column], StringType):
            raise ValueError(f"{out!r}: {fn} of text follows the database's collation; aggregate the scan instead")
        if fn in ("sum", "avg") and not isinstance(kinds[column], (IntegralType, FractionalType)):
            raise ValueError(f"{out!r}: {fn} of a {kinds[column].simpleString()}")
    unknown = [c for c in group_by if c not in kinds]
    if unknown:
        raise ValueError(f"not declared: {unknown}")
    ntz = any(isinstance(f.dataType, TimestampNTZType) for f in schema.fields)
    used = [f for f in schema.fields if f.name in {*group_by, *(c for _, c in aggs.values() if c)} or where is not None]

    summed: set[str] = set()
    parts: dict[str, Column] = {}  # partial column -> expression; avg is a sum and a count
    for out, (fn, column) in aggs.items():
        c = None if column is None else F.col(_bq(column))
        if fn in ("sum", "avg"):
            parts[f"{out}.sum"] = F.sum(c)
            summed.add(column)
        if fn == "avg":
            parts[f"{out}.count"] = F.count(c)
        elif fn == "count":
            parts[f"{out}.count"] = F.count(F.lit(1) if c is None else c)
        elif fn != "sum":
            parts[f"{out}.{fn}"] = getattr(F, fn)(c)

    def partial(shard: Shard) -> DataFrame:
        name = server_catalog(spark, opts, shard.url_no, shard.dialect.driver, ntz)
        path = [p for p in (name, shard.schema, shard.table) if p]
        rel = spark.table(".".join(_bq(p) for p in path))
        actual = {f.name: f.dataType for f in rel.schema.fields}
        key = F.col(_bq(shard.resolve(opts.partition_column)))
        conditions = [(F.col(_bq(shard.resolve(n))), typed_value(v, schema, n)) for n, v in opts.conditions]
        rel = rel.where(_in_scan(key, conditions, opts))
        cols = []
        for f in used:
            c = F.col(_bq(shard.resolve(f.name)))
            same = actual[shard.resolve(f.name)] == f.dataType
            c = c if same else c.cast(f.dataType)
            if f.name in summed and not shard.dialect.wide_sums and isinstance(f.dataType, IntegralType) and not isinstance(f.dataType, LongType):
                c = c.cast("bigint")  # its database would overflow: the cast keeps this sum in Spark
            cols.append(c.alias(f.name))
        rel = rel.select(*cols) if cols else rel
        rel = rel if where is None else rel.where(where)
        got = rel.groupBy(*[F.col(_bq(c)) for c in group_by]).agg(*[e.alias(p) for p, e in parts.items()])
        return got.select(*[F.col(_bq(c)) for c in group_by], *[F.col(_bq(p)).cast(result[p]).alias(p) for p in parts])

    # the types Spark itself gives these aggregates of the declared columns
    empty = spark.createDataFrame([], schema)
    typed = empty.groupBy(*[F.col(_bq(c)) for c in group_by]).agg(*[e.alias(p) for p, e in parts.items()])
    result = {f.name: f.dataType for f in typed.schema.fields}

    shards = _shards(spark, schema, opts, "sharded_aggregate")
    with redacted_errors("shard aggregates", (opts.password,)):
        partials = balanced_union(parallel_map(partial, shards)) if shards else typed
    merge = {"sum": F.sum, "count": F.sum, "min": F.min, "max": F.max}
    merged = partials.groupBy(*[F.col(_bq(c)) for c in group_by]).agg(
        *[merge[p.rsplit(".", 1)[1]](F.col(_bq(p))).alias(p) for p in parts])
    out_cols = []
    for out, (fn, column) in aggs.items():
        total, n = F.col(_bq(f"{out}.sum")), F.coalesce(F.col(_bq(f"{out}.count")), F.lit(0)).cast("bigint")
        if fn == "avg":
            kind = empty.agg(F.avg(F.col(_bq(column))).alias("a")).schema["a"].dataType
            value = F.when(n > 0, total.cast("double" if kind.simpleString() == "double" else total_type(kinds[column])) / n).cast(kind)
        else:
            value = n if fn == "count" else F.col(_bq(f"{out}.{fn}")).cast(result[f"{out}.{fn}"])
        out_cols.append(value.alias(out))
    return merged.select(*[F.col(_bq(c)) for c in group_by], *out_cols)


def total_type(kind: DecimalType) -> str:
    return f"decimal(38,{min(kind.scale + 4, 38)})"


def sharded_top_k(spark: SparkSession, schema: StructType | str, options: ScanOptions | Mapping[str, Any] | None,
                  order_by: Sequence[tuple[str, str]], k: int) -> DataFrame:
    """The first ``k`` rows of the logical table by ``order_by``, ``(column, 'asc' | 'desc')`` pairs, in order; nulls come first
    ascending and last descending, as in Spark.  Each shard sends its own first ``k`` rows at most."""
    opts = as_options(options)
    schema = as_schema(schema)
    kinds = {f.name: f.dataType for f in schema.fields}
    if k < 1:
        raise ValueError(f"k must be >= 1, got {k}")
    for column, way in order_by:
        if column not in kinds or way not in ("asc", "desc"):
            raise ValueError(f"({column!r}, {way!r}): a declared column, and 'asc' or 'desc'")
        if isinstance(kinds[column], StringType):
            raise ValueError(f"{column!r}: the order of text follows the database's collation; sort the scan instead")
    if not order_by:
        raise ValueError("top-k needs an order")
    shards = _shards(spark, schema, opts, "sharded_top_k")
    if not shards:
        return spark.createDataFrame([], schema)

    def statement(i: int) -> str:
        shard = shards[i]
        d = shard.dialect
        key = key_sql(shard, opts)
        where = [] if opts.null_key == "keep" and not opts.key_ranges else [f"{key} IS NOT NULL"]
        if opts.explicit_bounds:
            bound = f"{key} BETWEEN {opts.lower_bound} AND {opts.upper_bound}"
            where.append(f"({bound} OR {key} IS NULL)" if opts.null_key == "keep" else bound)
        if opts.key_ranges:
            where.append(opts.key_ranges.sql(key))
        where += conditions_sql(shard, opts, schema)
        cols = ", ".join(f"{d.quote(shard.resolve(f.name))} AS {d.quote(f.name)}" for f in schema.fields)
        order = ", ".join(d.order_term(d.quote(shard.resolve(c)), way) for c, way in order_by)
        inner = (f"SELECT {cols} FROM {source_sql(shard, opts)}" + (" WHERE " + " AND ".join(where) if where else "")
                 + f" ORDER BY {order} " + d.limit_clause.format(k=k))
        return "SELECT * FROM (" + inner + ") s"

    ntz = any(isinstance(f.dataType, TimestampNTZType) for f in schema.fields)
    with redacted_errors("shard top-k", (opts.password,)):
        rows = union_all_statements(spark, opts, shards, range(len(shards)), statement, CHUNK_TABLES_COUNT,
                                    [f.name for f in schema.fields], [f.dataType for f in schema.fields],
                                    {"preferTimestampNTZ": "true"} if ntz else None)
    order = [F.col(_bq(c)).asc() if way == "asc" else F.col(_bq(c)).desc() for c, way in order_by]
    return rows.orderBy(*order).limit(k)
