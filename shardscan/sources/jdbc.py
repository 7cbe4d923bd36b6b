"""Sharded scan through Spark's JDBC source.

``sharded_scan`` = discovery -> probes -> split plan -> one JDBC relation per
shard with one predicate per split (one predicate = one partition = one
task) -> declared-column projection and casts -> balanced ``UNION ALL``.

Everything after planning is a plain Spark plan: column pruning and filters
reach every shard's ``SELECT`` (``PushedFilters``), a ``LIMIT`` goes below the
union, and aggregates run a partial step per task before any shuffle.  The
driver holds only metadata: matched table names, one statistics row per
shard and the split bounds (the plan's SQL text is built when it is asked for);
rows never pass through it.
"""

from __future__ import annotations

import datetime
import logging
import re
from collections.abc import Mapping
from dataclasses import dataclass, field
from decimal import Decimal
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    BooleanType,
    CharType,
    DataType,
    DateType,
    DecimalType,
    FractionalType,
    IntegerType,
    IntegralType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
    TimestampType,
    VarcharType,
)

from shardscan.options import ScanOptions, redacted_errors
from shardscan.plans import splits as P
from shardscan.plans.rule import split_count, split_ranges, step_of
from shardscan.sources.dialects import salt_predicate
from shardscan.sources.discovery import Shard, check_columns, resolve_shards
from shardscan.sources.probe import CHUNK_TABLES_COUNT, key_sql, probe, source_sql, union_all_statements
from shardscan.util import balanced_union, parallel_map

def as_schema(schema: StructType | str) -> StructType:
    """Declared schema from a ``StructType`` or a DDL string; CHAR/VARCHAR(n)
    are read as STRING, as Spark DataFrames do.  ``TIMESTAMP(p)`` in a DDL string is the
    zoneless SQL timestamp, so it becomes TIMESTAMP_NTZ (microseconds, whatever
    the precision); a bare ``TIMESTAMP`` stays Spark's own, with the session zone."""
    if isinstance(schema, str):
        schema = re.sub(r"(?i)\bTIMESTAMP\s*\(\s*\d+\s*\)", "TIMESTAMP_NTZ", schema)
    parsed = schema if isinstance(schema, StructType) else StructType.fromDDL(schema)
    if not isinstance(parsed, StructType):
        raise ValueError(f"not a row schema: {schema!r}")
    return StructType([
        StructField(f.name, StringType(), f.nullable, f.metadata)
        if isinstance(f.dataType, (CharType, VarcharType)) else f
        for f in parsed.fields
    ])


def as_options(options: ScanOptions | Mapping[str, Any] | None, **kwargs: Any) -> ScanOptions:
    if isinstance(options, ScanOptions):
        if kwargs:
            raise ValueError("pass either a ScanOptions or option keywords, not both")
        return options
    return ScanOptions.from_map(options, **kwargs)


def provenance_fields() -> list[StructField]:
    return [
        StructField("_url_no", IntegerType(), False),
        StructField("_schema", StringType(), True),
        StructField("_table", StringType(), True),
    ]


@dataclass
class ScanPlan:
    """The planned scan: shards, per-shard split lists and the plan as data."""

    spark: SparkSession
    opts: ScanOptions
    schema: StructType
    key_type: DataType
    shards: list[Shard]
    # shard_no -> list of (split_id, split_no, lo, hi, bucket); all None but the first = the IS NULL split
    splits: dict[int, list[tuple]] = field(default_factory=dict)
    # shard_no -> (min key, step) of the range rule, for non-empty shards
    steps: dict[int, tuple[int, int]] = field(default_factory=dict)
    _df: DataFrame | None = None

    @property
    def plan_df(self) -> DataFrame:
        """``split_id, url_no, server, schema_name, table_name, split_no, lo, hi, query, bucket``."""
        if self._df is None:
            rows = []
            for i, mine in self.splits.items():
                s = self.shards[i]
                server = self.opts.redact(self.opts.urls[s.url_no])
                head = f"SELECT {_select_list(s, self.schema)} FROM {source_sql(s, self.opts)} WHERE "
                rows += [(split_id, s.url_no, server, s.schema, s.table, no, lo, hi,
                          head + split_predicate(s, self.opts, lo, hi, b, self.schema), b)
                         for split_id, no, lo, hi, b in mine]
            rows.sort(key=lambda r: r[0])
            b = P.bound_type(self.key_type)
            low, high = (-(2**63), 2**63 - 1) if b == "bigint" else P.key_limits(self.key_type)
            if any(v is not None and not low <= v <= high for r in rows for v in r[6:8]):
                b = "decimal(38,0)"  # the keys are wider than declared
            if b != "bigint":  # DECIMAL(p,0) keys: bounds as Decimal values
                rows = [r[:6] + tuple(None if v is None else Decimal(v) for v in r[6:8]) + r[8:] for r in rows]
            self._df = self.spark.createDataFrame(rows, (
                "split_id bigint, url_no int, server string, schema_name string, "
                f"table_name string, split_no bigint, lo {b}, hi {b}, query string, bucket int"))
        return self._df

    @property
    def n_splits(self) -> int:
        return sum(len(v) for v in self.splits.values())

    def output_schema(self) -> StructType:
        fields = list(self.schema.fields)
        if self.opts.provenance:
            fields += provenance_fields()
        return StructType(fields)


def _key_type(schema: StructType, key: str) -> DataType:
    for f in schema.fields:
        if f.name.lower() == key.lower():
            return f.dataType
    return LongType()


def _select_list(shard: Shard, schema: StructType) -> str:
    d = shard.dialect
    if not shard.columns:
        return ", ".join(d.quote(f.name) for f in schema.fields)
    return ", ".join(d.quote(shard.resolve(f.name) or f.name) for f in schema.fields)


def plan_scan(spark: SparkSession, schema: StructType | str,
              options: ScanOptions | Mapping[str, Any] | None = None, **kwargs: Any) -> ScanPlan:
    opts = as_options(options, **kwargs)
    if opts.splits_per_task != 1:
        raise ValueError("scan.splits-per-task applies to the sharded_dbapi backend; "
                         "a Spark JDBC partition runs exactly one statement")
    schema = as_schema(schema)
    key_type = _key_type(schema, opts.partition_column)
    P.key_limits(key_type)  # integral keys only
    names = [f.name for f in schema.fields]
    if not opts.query:
        names = names + [opts.partition_column] + [c for c, _ in opts.conditions]
        names += [opts.salt_column] if opts.salt_column else []
    shards = resolve_shards(spark, opts, names)
    if opts.query:
        shards = [Shard(s.url_no, s.url, s.schema, s.table, s.table_type) for s in shards]
    else:
        check_columns(shards, names, opts)
    if len(shards) > 1000:
        LOG.warning("%d shards: one JDBC relation each; the sharded_dbapi backend keeps the plan "
                    "at one scan node", len(shards))
    plan = ScanPlan(spark, opts, schema, key_type, shards)
    if not shards:
        return plan

    if opts.explicit_bounds and opts.partition_num is not None:
        # declared bounds, count not needed: no round trip to the servers
        probed = {i: (opts.lower_bound, opts.upper_bound, None, None) for i in range(len(shards))}
    else:
        with redacted_errors("shard probes", (opts.password,)):
            rows = probe(spark, opts, shards).collect()
        probed = {r.shard_no: (r.mn, r.mx, r.n, r.n_null) for r in rows}
    # The rule on one statistics row per shard (already on the driver): plan
    # metadata, like a file listing; the rows themselves are read by tasks.
    mode = {"batch_size": opts.batch_size, "partition_num": opts.partition_num}
    n = 0
    for i in range(len(shards)):
        mn, mx, rows_of, _ = (None if v is None else int(v) for v in probed.get(i, (None,) * 4))
        if mn is None or mx is None:
            continue
        plan.steps[i] = (mn, step_of(mn, mx, rows_of, **mode))
        opts.check_split_count(n + split_count(mn, mx, rows_of, **mode) * opts.salt_buckets)
        # the last range is cut at the key type's maximum: the declared type's, or that of
        # the keys themselves where they are wider than declared
        top = max(P.key_limits(key_type)[1], mx)
        if opts.explicit_bounds:  # it stops at the declared upper bound
            top = min(top, opts.upper_bound)
        mine = plan.splits.setdefault(i, [])
        for j, (lo, hi) in enumerate(split_ranges(mn, mx, rows_of, top=top, **mode)):
            wanted = not opts.key_ranges or opts.key_ranges.hits(lo, hi)
            for b in opts.buckets:
                if wanted:  # a dropped split keeps its id: ids do not depend on the key ranges
                    mine.append((n, j, lo, hi, b))
                n += 1
    if opts.null_key == "keep":
        # one IS NULL split per shard that has (or, unprobed, may have) NULL keys
        for i in range(len(shards)):
            n_null = probed.get(i, (None, None, None, None))[3]
            if n_null is None or n_null > 0:
                for b in opts.buckets:
                    plan.splits.setdefault(i, []).append((n, None, None, None, b))
                    n += 1
    if n > 100_000:
        LOG.warning("%d splits planned", n)
    if LOG.isEnabledFor(logging.INFO):
        for url_no in sorted({s.url_no for s in shards}):
            mine = [i for i, s in enumerate(shards) if s.url_no == url_no]
            LOG.info("server %d (%s): %d schemas, %d tables, %d splits", url_no, opts.redact(opts.urls[url_no]),
                     len({shards[i].schema for i in mine}), len(mine),
                     sum(len(plan.splits.get(i, ())) for i in mine))
    return plan


LOG = logging.getLogger("shardscan")


def read_plan(spark: SparkSession, plan: ScanPlan) -> DataFrame:
    """The bag union of every split of ``plan`` in the declared schema.

    Relations are created by a few driver threads: each one costs a schema
    round trip to its server, and hundreds of shards would otherwise pay
    them one after the other.
    """
    opts = plan.opts
    want_ntz = any(isinstance(f.dataType, TimestampNTZType) for f in plan.schema.fields)

    def relation(shard_no: int) -> DataFrame:
        shard = plan.shards[shard_no]
        preds = [split_predicate(shard, opts, lo, hi, b, plan.schema)
                 for _, _, lo, hi, b in plan.splits[shard_no]]
        props = opts.jdbc_properties(shard.dialect.driver, shard.dialect.scan_fetch_size)
        if want_ntz:
            props["preferTimestampNTZ"] = "true"
        rel = spark.read.jdbc(opts.urls[shard.url_no], source_sql(shard, opts), predicates=preds,
                              properties=props)
        _check_salt(rel, shard, opts)
        return _project(rel, shard, plan)

    todo = [i for i in range(len(plan.shards)) if plan.splits.get(i)]
    if not todo:
        return spark.createDataFrame([], plan.output_schema())
    with redacted_errors("shard relations", (opts.password,)):
        df = balanced_union(parallel_map(relation, todo))
    if opts.max_parallel_reads is not None and plan.n_splits > opts.max_parallel_reads:
        # at most this many split reads at once (and so connections): each task
        # reads several splits one after the other, like a reader pulling splits
        df = df.coalesce(opts.max_parallel_reads)
    return df


def split_predicate(shard: Shard, opts: ScanOptions, lo: Any, hi: Any, bucket: int | None = None,
                    schema: StructType | None = None) -> str:
    """WHERE text of one split: the key range (or ``IS NULL``), the salt
    bucket if any, and the declared equality conditions, in the shard's own
    SQL dialect."""
    k = key_sql(shard, opts)
    parts = [f"{k} IS NULL" if lo is None else f"{k} BETWEEN {lo} AND {hi}"]
    if opts.key_ranges and lo is not None and opts.key_ranges.hits(lo, hi) != [(lo, hi)]:
        parts.append(opts.key_ranges.sql(k, lo, hi))
    if bucket is not None:
        salt = shard.dialect.quote(shard.resolve(opts.salt_column) or opts.salt_column)
        parts.append(salt_predicate(salt, opts.salt_buckets, bucket))
    return " AND ".join(parts + conditions_sql(shard, opts, schema))


def conditions_sql(shard: Shard, opts: ScanOptions, schema: StructType | None) -> list[str]:
    """The equality conditions as SQL text; a text value of a declared column takes its type."""
    return [shard.dialect.equals(shard.dialect.quote(shard.resolve(name) or name),
                                 typed_value(value, schema, name))
            for name, value in opts.conditions]


def typed_value(value: Any, schema: StructType | None, name: str) -> Any:
    """A condition's value in the declared type of its column (``"5"`` for an integer column is 5)."""
    kind = next((f.dataType for f in (schema.fields if schema else ()) if f.name.lower() == name.lower()), None)
    if not isinstance(value, str) or kind is None:
        return value
    try:
        if isinstance(kind, IntegralType):
            return int(value)
        if isinstance(kind, DecimalType):
            return Decimal(value)
        if isinstance(kind, FractionalType):
            return float(value)
        if isinstance(kind, BooleanType):
            return {"true": True, "false": False, "1": True, "0": False}[value.strip().lower()]
        if isinstance(kind, DateType):
            return datetime.date.fromisoformat(value)
        if isinstance(kind, (TimestampType, TimestampNTZType)):
            return datetime.datetime.fromisoformat(value)
    except (ValueError, KeyError, ArithmeticError):
        raise ValueError(f"condition on {name!r}: {value!r} is not a {kind.simpleString()}") from None
    return value


def _check_salt(rel: DataFrame, shard: Shard, opts: ScanOptions) -> None:
    if not opts.salt_column:
        return
    for f in rel.schema.fields:
        if f.name.lower() == opts.salt_column.lower():
            kind = f.dataType
            if not (isinstance(kind, IntegralType) or isinstance(kind, DecimalType) and kind.scale == 0):
                raise ValueError(f"{shard.label(opts)}: salt column {f.name!r} must be an integer, "
                                 f"not {kind.simpleString()}")


def _bq(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _sql_literal(v: Any) -> str:
    if v is None:
        return "NULL"
    if isinstance(v, bool):
        return "TRUE" if v else "FALSE"
    if isinstance(v, int):
        return str(v)
    return "'" + str(v).replace("\\", "\\\\").replace("'", "\\'") + "'"


def _project(rel: DataFrame, shard: Shard, plan: ScanPlan) -> DataFrame:
    """Declared columns, in declared order and types, as one ``selectExpr``.

    A column is cast only when its type differs from the declared one: a
    cast on a column (even to the same logical type) keeps a filter on it
    from being pushed into the shard's SQL.
    """
    actual = {f.name: f.dataType for f in rel.schema.fields}
    lookup = Shard(shard.url_no, shard.url, shard.schema, shard.table, shard.table_type, tuple(actual))
    exprs = []
    for f in plan.schema.fields:
        name = lookup.resolve(f.name)
        if name is None:
            raise ValueError(f"{shard.label(plan.opts)} lacks declared column {f.name!r}")
        if actual[name] == f.dataType:
            exprs.append(f"{_bq(name)} AS {_bq(f.name)}" if name != f.name else _bq(name))
        else:
            exprs.append(f"CAST({_bq(name)} AS {f.dataType.simpleString()}) AS {_bq(f.name)}")
    if plan.opts.provenance:
        exprs += [
            f"CAST({shard.url_no} AS INT) AS _url_no",
            f"CAST({_sql_literal(shard.schema)} AS STRING) AS _schema",
            f"CAST({_sql_literal(shard.table)} AS STRING) AS _table",
        ]
    if exprs == [_bq(c) for c in rel.columns]:
        return rel  # already the declared columns, in order
    return rel.selectExpr(*exprs)


def sharded_scan(spark: SparkSession, schema: StructType | str,
                 options: ScanOptions | Mapping[str, Any] | None = None, **kwargs: Any) -> DataFrame:
    """Read every matched shard of every server as one DataFrame (bag union)."""
    return read_plan(spark, plan_scan(spark, schema, options, **kwargs))


def split_plan(spark: SparkSession, schema: StructType | str,
               options: ScanOptions | Mapping[str, Any] | None = None, **kwargs: Any) -> DataFrame:
    """The planned splits as data: ``split_id, url_no, server, schema_name,
    table_name, split_no, lo, hi, query`` (never credentials)."""
    return plan_scan(spark, schema, options, **kwargs).plan_df


def shard_stats(spark: SparkSession, options: ScanOptions | Mapping[str, Any] | None = None,
                **kwargs: Any) -> DataFrame:
    """Per shard ``url_no, server, schema_name, table_name, min_key, max_key, n``.

    ``n`` (``COUNT(*)``, NULL keys included) is probed in batch-size mode.
    """
    opts = as_options(options, **kwargs)
    if opts.query:
        shards = resolve_shards(spark, opts, [])
        shards = [Shard(s.url_no, s.url, s.schema, s.table, s.table_type) for s in shards]
    else:
        shards = resolve_shards(spark, opts, [opts.partition_column])
        check_columns(shards, [opts.partition_column], opts)
    if not shards:
        return spark.createDataFrame(
            [], "url_no int, server string, schema_name string, table_name string, "
                "min_key decimal(38,0), max_key decimal(38,0), n bigint")
    meta = spark.createDataFrame(
        [(i, s.url_no, opts.redact(s.url), s.schema, s.table) for i, s in enumerate(shards)],
        "shard_no int, url_no int, server string, schema_name string, table_name string",
    )
    with redacted_errors("shard probes", (opts.password,)):
        probed = probe(spark, opts, shards)
    return (
        probed.join(meta, "shard_no")
        .select("url_no", "server", "schema_name", "table_name",
                F.col("mn").alias("min_key"), F.col("mx").alias("max_key"), "n")
    )


def split_row_counts_in_db(spark: SparkSession, schema: StructType | str,
                           options: ScanOptions | Mapping[str, Any] | None = None,
                           **kwargs: Any) -> DataFrame:
    """Rows each planned key range reads, counted inside the databases.

    ``url_no, server, schema_name, table_name, split_no, n_rows``: one
    ``GROUP BY`` per shard returns one row per non-empty range, so
    only counts travel; no key is pulled into Spark.  As in the probes, a few
    shards of a server go out as one ``UNION ALL`` statement and task.  NULL keys form a
    ``split_no`` NULL group when kept.  Salt buckets are not split out.
    """
    plan = plan_scan(spark, schema, options, **kwargs)
    opts = plan.opts
    out_schema = ("url_no int, server string, schema_name string, table_name string, "
                  "split_no bigint, n_rows bigint")
    todo = [i for i in range(len(plan.shards)) if i in plan.steps or
            (opts.null_key == "keep" and plan.splits.get(i))]
    if not todo:
        return spark.createDataFrame([], out_schema)

    def statement(shard_no: int) -> str:
        shard = plan.shards[shard_no]
        d = shard.dialect
        k = key_sql(shard, opts)
        where = [] if opts.null_key == "keep" else [f"{k} IS NOT NULL"]
        if opts.explicit_bounds:
            bound = f"{k} BETWEEN {opts.lower_bound} AND {opts.upper_bound}"
            where.append(f"({bound} OR {k} IS NULL)" if opts.null_key == "keep" else bound)
        if opts.key_ranges:
            where.append(opts.key_ranges.sql(k))
        where += conditions_sql(shard, opts, plan.schema)
        mn, step = plan.steps.get(shard_no, (0, 0))
        idx = d.int_div(f"{k} - {mn}", str(step + 1))
        q = [d.quote(c) for c in ("shard_no", "split_no", "n_rows")]
        return (f"SELECT {shard_no} AS {q[0]}, {q[1]}, COUNT(*) AS {q[2]} "
                f"FROM (SELECT {idx} AS {q[1]} FROM {source_sql(shard, opts)}"
                + (" WHERE " + " AND ".join(where) if where else "") + f") s GROUP BY {q[1]}")

    meta = spark.createDataFrame(
        [(i, s.url_no, opts.redact(s.url), s.schema, s.table) for i, s in enumerate(plan.shards) if i in set(todo)],
        "shard_no int, url_no int, server string, schema_name string, table_name string")
    with redacted_errors("split counts", (opts.password,)):
        counted = union_all_statements(spark, opts, plan.shards, todo, statement, CHUNK_TABLES_COUNT,
                                       ("shard_no", "split_no", "n_rows"))
    return counted.selectExpr(
        "CAST(shard_no AS INT) AS shard_no", "CAST(split_no AS BIGINT) AS split_no", "CAST(n_rows AS BIGINT) AS n_rows"
    ).join(meta, "shard_no").select("url_no", "server", "schema_name", "table_name", "split_no", "n_rows")


def skew_report_in_db(spark: SparkSession, schema: StructType | str,
                      options: ScanOptions | Mapping[str, Any] | None = None,
                      **kwargs: Any) -> DataFrame:
    """Per shard of a database scan: ``max_rows``, ``total_rows``,
    ``nonempty_splits``, ``avg_rows`` of its key ranges, from the in-database
    counts of :func:`split_row_counts_in_db`."""
    counts = split_row_counts_in_db(spark, schema, options, **kwargs)
    return counts.groupBy("url_no", "server", "schema_name", "table_name").agg(
        F.max("n_rows").alias("max_rows"),
        F.sum("n_rows").cast("bigint").alias("total_rows"),
        F.count(F.lit(1)).alias("nonempty_splits"),
        F.avg("n_rows").alias("avg_rows"),
    )


def register_view(spark: SparkSession, name: str, schema: StructType | str,
                  options: ScanOptions | Mapping[str, Any] | None = None, **kwargs: Any) -> DataFrame:
    """Declare the logical table under ``name`` for Spark SQL."""
    df = sharded_scan(spark, schema, options, **kwargs)
    df.createOrReplaceTempView(name)
    return df
