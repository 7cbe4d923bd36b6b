"""Split plans as tables: planned by tasks, stored, and read by tasks.

:func:`distributed_split_plan` is the split plan of a scan with nothing per shard or split on the
driver: one task per server reads its catalog, a few tasks per server probe its shards, and the
range rule and its ``explode`` run as column expressions.  The plan is a DataFrame of plain
values (no credentials), to be written, filtered, joined or checked like any other.

:func:`read_split_plan` reads such a plan: its rows are dealt to tasks, and a task reads its splits one after
the other over one connection per server, as Arrow batches.  A plan stored last week, a part of one, or one that another
rule made (:mod:`shardscan.operators.equal_depth`) is read the same way.

Both use the DB-API drivers of :mod:`shardscan.sources.dbapi` and the same options.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from math import gcd
from typing import Any

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, StructType

from shardscan.operators.prefix import running_sums
from shardscan.options import ScanOptions, redacted_errors
from shardscan.plans import splits as P
from shardscan.plans.filters import checked, column_of
from shardscan.session import cores, ship_package
from shardscan.sources import dbapi
from shardscan.sources.jdbc import as_options, as_schema
from shardscan.util import written

SHARD = ("url_no", "schema_name", "table_name")
_FOUND = ("url_no int, schema_name string, table_name string, columns array<string>, key_column string, "
          "salt_column string, missing array<string>")
_STATS = "mn decimal(38,0), mx decimal(38,0), n bigint, n_null bigint"
PLAN = ("split_id bigint, url_no int, schema_name string, table_name string, columns array<string>, key_column string, "
        "salt_column string, split_no bigint, lo decimal(38,0), hi decimal(38,0), bucket int")
#: More tasks than this a job does not get: a task then reads more splits.
MAX_TASKS = 100_000
#: Nor more than so many for each core, once it has ``LEAST_TASKS``: a task costs more than a small split.
TASKS_PER_CORE, LEAST_TASKS = 32, 500


def _reader(spark: SparkSession, schema: StructType | str, opts: ScanOptions) -> dbapi.ShardedDbapiReader:
    ship_package(spark)
    return dbapi.ShardedDbapiReader(as_schema(schema), opts, spark.conf.get("spark.sql.session.timeZone"))


def find_shards(spark: SparkSession, schema: StructType | str, opts: ScanOptions) -> DataFrame:
    """The matched tables of every server, found by one task per server: ``url_no, schema_name, table_name, columns``
    (actual names in declared order), ``key_column, salt_column``.  A table without a declared column is an error."""
    reader = _reader(spark, schema, opts)
    names = [f.split()[0] for f in _FOUND.split(", ")]

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for url_no in b.column("url_no").to_pylist():
                with redacted_errors(f"shard discovery on server {url_no}", (reader.opts.password,)):
                    rows = [(url_no, *s) for s in reader.shards_of(url_no, reader.opts.urls[url_no])]
                for at in range(0, len(rows), 10_000):
                    part = [list(c) for c in zip(*rows[at:at + 10_000])]
                    kinds = [pa.int32(), pa.string(), pa.string(), pa.list_(pa.string()), pa.string(), pa.string(), pa.list_(pa.string())]
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(part, kinds)], names=names)

    n = len(opts.urls)
    servers = spark.range(n, numPartitions=n).select(F.col("id").cast("int").alias("url_no"))
    with redacted_errors("shard discovery", (opts.password,)):
        found = written(servers.mapInArrow(find, _FOUND), "shards")
        bad = found.where(F.size("missing") > 0).orderBy(*SHARD).first()
    if bad:
        raise ValueError(dbapi.lacks(bad.url_no, bad.schema_name, bad.table_name, bad.missing))
    return found.drop("missing")


def probe_shards(spark: SparkSession, schema: StructType | str, opts: ScanOptions, shards: DataFrame) -> DataFrame:
    """``shards`` with ``mn, mx, n, n_null``, at most ``PROBE_CONNECTIONS`` tasks a server; written once."""
    if opts.explicit_bounds and opts.partition_num is not None:  # declared bounds, no count needed: nothing to ask
        bounds = [F.lit(str(v)).cast("decimal(38,0)") for v in (opts.lower_bound, opts.upper_bound)]
        none = F.lit(None).cast("bigint")
        return written(shards.select("*", bounds[0].alias("mn"), bounds[1].alias("mx"), none.alias("n"), none.alias("n_null")), "stats")
    reader = _reader(spark, schema, opts)
    out = StructType.fromDDL(f"{_FOUND.rsplit(', ', 1)[0]}, {_STATS}")

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from decimal import Decimal

        with Connections(reader.opts) as open_to:
            for b in batches:
                got = []
                for r in b.to_pylist():
                    kind = dbapi._kind(reader.opts.urls[r["url_no"]])
                    with redacted_errors(f"shard probe on server {r['url_no']}", (reader.opts.password,)):
                        mn, mx, n, n_null = reader.probe(open_to(r["url_no"]), kind, r["schema_name"], r["table_name"], r["key_column"])
                    got.append((None if mn is None else Decimal(int(mn)), None if mx is None else Decimal(int(mx)), n, n_null))
                kinds = [pa.decimal128(38, 0)] * 2 + [pa.int64()] * 2
                stats = [pa.array(c, k) for c, k in zip(zip(*got), kinds)] if got else [pa.array([], k) for k in kinds]
                yield pa.RecordBatch.from_arrays([*b.columns, *stats], names=out.names)

    tasks = min(MAX_TASKS, dbapi.PROBE_CONNECTIONS * len(opts.urls))
    lane = F.pmod(F.xxhash64("schema_name", "table_name"), F.lit(dbapi.PROBE_CONNECTIONS))
    dealt = shards.repartition(tasks, "url_no", lane).sortWithinPartitions(*SHARD)
    with redacted_errors("shard probes", (opts.password,)):
        return written(dealt.mapInArrow(probe, out), "stats")


class Connections:
    """One connection at a time, to the server asked for last."""

    def __init__(self, opts: ScanOptions):
        self.opts, self.at, self.conn = opts, None, None

    def __enter__(self):
        return self.to

    def to(self, url_no: int):
        if url_no != self.at:
            self.__exit__()
            self.conn, self.at = dbapi.open_session(self.opts.urls[url_no], self.opts), url_no
        return self.conn

    def __exit__(self, *exc):
        if self.conn is not None:
            self.conn.close()
        self.conn = self.at = None


def distributed_split_plan(spark: SparkSession, schema: StructType | str,
                           options: ScanOptions | Mapping[str, Any] | None = None, **kwargs: Any) -> DataFrame:
    """The split plan of a scan as a DataFrame, with the split ids and ranges of :func:`shardscan.split_plan`:
    ``split_id, url_no, schema_name, table_name, columns, key_column, salt_column, split_no, lo, hi, bucket``.

    ``lo`` and ``hi`` are null in the split of the NULL keys."""
    opts = as_options(options, **kwargs)
    stats = probe_shards(spark, schema, opts, find_shards(spark, schema, opts))
    return splits_of(stats, opts)


def splits_of(stats: DataFrame, opts: ScanOptions) -> DataFrame:
    """The range rule on a table of shard statistics, ids by (server, schema, table), ranges before NULL keys."""
    top = F.greatest(F.lit(str(2**63 - 1)).cast("decimal(38,0)"), F.col("mx"))
    if opts.explicit_bounds:  # hard limits: the last range stops at the upper bound
        top = F.least(top, F.lit(str(opts.upper_bound)).cast("decimal(38,0)"))
    k = opts.salt_buckets
    stepped = P.with_steps(stats.withColumn("top", top), batch_size=opts.batch_size, partition_num=opts.partition_num)
    stepped = stepped.withColumn("size", F.col("n_splits") * F.lit(k))
    stepped = running_sums(stepped, (), SHARD, {"through": "size"})
    n_ranges = stepped.agg(F.sum("size")).first()[0] or 0
    opts.check_split_count(n_ranges)
    exploded = P.explode_splits(stepped, SHARD, key_type=DecimalType(38, 0))
    ranges = _salted(exploded, opts).withColumn("hi", F.least("hi", "top")).withColumn(
        "split_id", F.col("through") - F.col("size") + F.col("split_no") * F.lit(k) + F.coalesce("bucket", F.lit(0)))
    names = [f.split()[0] for f in PLAN.split(", ")]
    plan = ranges.select(*names)
    if opts.null_key == "keep":
        # one IS NULL split per shard that has (or, unprobed, may have) NULL keys
        some = stats.where(F.coalesce("n_null", F.lit(1)) > 0).withColumn("size", F.lit(k).cast("bigint"))
        some = _salted(running_sums(some, (), SHARD, {"through": "size"}), opts)
        split_id = F.lit(n_ranges) + F.col("through") - F.col("size") + F.coalesce("bucket", F.lit(0))
        nulls = some.select("*", split_id.alias("split_id"), F.lit(None).cast("bigint").alias("split_no"),
                            F.lit(None).cast("decimal(38,0)").alias("lo"), F.lit(None).cast("decimal(38,0)").alias("hi"))
        plan = plan.unionByName(nulls.select(*names))
    return plan.select(*[F.col(f.split()[0]).cast(f.split(" ", 1)[1]).alias(f.split()[0]) for f in PLAN.split(", ")])


def _salted(df: DataFrame, opts: ScanOptions) -> DataFrame:
    if not opts.salt_column:
        return df.withColumn("bucket", F.lit(None).cast("int"))
    return df.withColumn("bucket", F.explode(F.sequence(F.lit(0), F.lit(opts.salt_buckets - 1))))


def read_split_plan(spark: SparkSession, plan: DataFrame, schema: StructType | str,
                    options: ScanOptions | Mapping[str, Any] | None = None, columns: Sequence[str] | None = None,
                    filters: Sequence[Sequence[Any]] = (), **kwargs: Any) -> DataFrame:
    """The rows of every split of ``plan`` (columns of :func:`distributed_split_plan`) in the declared schema.

    ``columns`` (of those declared, in this order) and ``filters`` (``(column, operator, value)``, see
    :mod:`shardscan.plans.filters`) go into every split's SQL: a task fetches nothing else.

    ``options`` name the servers and credentials, as when the plan was made; a split is read as often as it is in the plan.
    ``scan.splits-per-task`` splits with neighbouring ids share a task, more where there would be over ``TASKS_PER_CORE``
    tasks for each core (and ``LEAST_TASKS``).  Tasks are dealt so that neighbours in the
    schedule go to different servers' splits, and each holds as many splits as the others."""
    opts = as_options(options, **kwargs)
    schema = as_schema(schema)
    filters = checked(filters, schema)
    at = {f.name: i for i, f in enumerate(schema.fields)}
    wanted = list(columns) if columns is not None else list(at)
    unknown = [c for c in wanted if c not in at]
    if unknown or not wanted:
        raise ValueError(f"not declared: {unknown}" if unknown else "no columns to read")
    read_too = wanted + [c for c in dict.fromkeys(f[0] for f in filters) if c not in wanted]
    places = [at[c] for c in read_too]
    schema = StructType([schema.fields[i] for i in places])
    reader = _reader(spark, schema, opts)
    reader.filters = filters
    n_splits = plan.count()
    if not n_splits:
        return spark.createDataFrame([], schema).select(*[f"`{c}`" for c in wanted])
    opts.check_split_count(n_splits)
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            splits = [dbapi.Split(r["split_id"], r["url_no"], r["schema_name"], r["table_name"], tuple(r["columns"][i] for i in places), r["key_column"],
                                  None if r["lo"] is None else int(r["lo"]), None if r["hi"] is None else int(r["hi"]),
                                  r["bucket"], r["salt_column"]) for r in b.to_pylist()]
            for t in dbapi.pack(splits, len(splits) or 1):
                yield from reader.read(t)

    rows = dealt(plan, n_splits, opts.splits_per_task).mapInArrow(read, schema)
    return (rows.where(column_of(filters)) if filters else rows).select(*[f"`{c}`" for c in wanted])


def dealt(plan: DataFrame, n_splits: int, per_task: int) -> DataFrame:
    """``plan`` with each task's splits in one partition, sorted by server."""
    tasks = min(MAX_TASKS, max(LEAST_TASKS, TASKS_PER_CORE * cores(plan.sparkSession)), -(-n_splits // per_task))
    # groups of neighbouring ids, scattered over the tasks by a multiplier without a common factor
    step = next(s for s in range(int(tasks * 0.618) or 1, 2 * tasks + 2) if gcd(s, tasks) == 1)
    group = F.expr(f"split_id div {-(-n_splits // tasks)}")
    task = F.pmod(F.pmod(group, F.lit(tasks)) * F.lit(step), F.lit(tasks)).cast("int")
    return plan.repartitionById(tasks, task).sortWithinPartitions("url_no", "split_id")


def scan_by_stored_plan(spark: SparkSession, path: str, schema: StructType | str,
                        options: ScanOptions | Mapping[str, Any] | None = None, **kwargs: Any) -> DataFrame:
    """Plan a scan, store the plan at ``path`` (parquet) and read the stored one."""
    opts = as_options(options, **kwargs)
    distributed_split_plan(spark, schema, opts).write.parquet(path)
    return read_split_plan(spark, spark.read.schema(PLAN).parquet(path), schema, opts)
