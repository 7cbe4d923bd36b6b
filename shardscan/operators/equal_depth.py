"""Equal-depth split plans: ranges with about as many rows each, however the keys lie.

Equal-width ranges are badly uneven on sparse keys.  Here each shard starts as one range; ranges
with more than ``max_rows`` rows are cut into ``fan_out`` equal parts and counted by one ``GROUP BY`` in their
database, and again, until every range holds at most ``max_rows`` rows or one key.  Then light neighbours are merged.
Only heavy ranges are asked about again, by tasks that hold one connection; ranges and counts stay
DataFrames, so the driver sees the number of heavy ranges of a round and nothing else.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping
from dataclasses import replace
from typing import Any

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from shardscan.operators.prefix import joined, running_sums
from shardscan.options import ScanOptions, redacted_errors
from shardscan.sources import dbapi
from shardscan.sources import stored as S
from shardscan.sources.jdbc import as_options
from shardscan.util import written

_RANGE = ("url_no int, schema_name string, table_name string, columns array<string>, key_column string, salt_column string, "
          "lo decimal(38,0), hi decimal(38,0), n_rows bigint")


def _count_parts(spark: SparkSession, schema, opts: ScanOptions, heavy: DataFrame, n_heavy: int, fan_out: int) -> DataFrame:
    """Every heavy range cut into ``fan_out`` parts of equal width (fewer when it has fewer keys), with their rows."""
    reader = S._reader(spark, schema, opts)
    out = StructType.fromDDL(_RANGE)

    def statement(conn, r: dict, lo: int, hi: int, width: int) -> tuple[str, list]:
        kind = dbapi._kind(reader.opts.urls[r["url_no"]])
        wide = reader.wide_columns(conn, kind, None if reader.opts.query else r["table_name"])
        split = dbapi.Split(-1, r["url_no"], r["schema_name"], r["table_name"], tuple(r["columns"]), r["key_column"], lo, hi)
        text, params = reader._statement(kind, split, wide)
        part = dbapi.key_part(kind, r["key_column"], lo, hi, width, wide)
        where = text[text.index(" FROM "):]
        return f"SELECT part, COUNT(*) FROM (SELECT {part} AS part{where}) s GROUP BY part", params

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from decimal import Decimal

        with S.Connections(reader.opts) as open_to:
            for b in batches:
                for r in b.to_pylist():
                    lo, hi = int(r["lo"]), int(r["hi"])
                    width = -(-(hi - lo + 1) // fan_out)
                    with redacted_errors(f"counting ranges on server {r['url_no']}", (reader.opts.password,)):
                        conn = open_to(r["url_no"])
                        cur = conn.cursor()
                        text, params = statement(conn, r, lo, hi, width)
                        cur.execute(text, params) if params else cur.execute(text)
                        rows = {int(i): n for i, n in cur.fetchall()}  # at most fan_out
                        cur.close()
                    starts = range(lo, hi + 1, width)
                    n = len(starts)
                    same_for_all = [pa.array([r[c]] * n, b.schema.field(c).type) for c in b.schema.names[:6]]
                    yield pa.RecordBatch.from_arrays([
                        *same_for_all, pa.array([Decimal(a) for a in starts], pa.decimal128(38, 0)),
                        pa.array([Decimal(min(a + width - 1, hi)) for a in starts], pa.decimal128(38, 0)),
                        pa.array([rows.get(i, 0) for i in range(n)], pa.int64())], names=out.names)

    lanes = dbapi.PROBE_CONNECTIONS  # statements a server answers at once
    lane = F.pmod(F.xxhash64(*S.SHARD, "lo"), F.lit(lanes))
    dealt = heavy.select(*out.names).repartition(min(n_heavy, lanes * len(opts.urls)), "url_no", lane).sortWithinPartitions("url_no")
    with redacted_errors("counting ranges", (opts.password,)):
        return written(dealt.mapInArrow(count, out), "counted")


def equal_depth_plan(spark: SparkSession, schema: StructType | str, options: ScanOptions | Mapping[str, Any] | None = None,
                     max_rows: int = 100_000, fan_out: int = 64, **kwargs: Any) -> DataFrame:
    """A split plan (columns of :func:`~shardscan.sources.stored.distributed_split_plan`, and ``n_rows``) whose splits hold
    fewer than ``2 * max_rows`` rows, or are one key alone.  The splits of a shard cover its ``[min, max]`` (or the declared
    bounds) without a gap; a shard without a row that the options let through has none.

    ``scan.batch.size`` and ``scan.partition.num`` of the options play no part; salts are not supported."""
    if max_rows < 1 or fan_out < 2:
        raise ValueError("max_rows must be >= 1 and fan_out >= 2")
    opts = as_options(options, **kwargs)
    if opts.salt_column:
        raise ValueError("an equal-depth plan has no salt buckets: a hot key is a split of its own")
    opts = replace(opts, batch_size=None, partition_num=1)  # bounds only: rows are counted range by range
    stats = S.probe_shards(spark, schema, opts, S.find_shards(spark, schema, opts))
    names = [f.split()[0] for f in _RANGE.split(", ")]
    todo = stats.where("mn IS NOT NULL").withColumnsRenamed({"mn": "lo", "mx": "hi", "n": "n_rows"}).select(*names)
    heavy = (F.col("n_rows") > max_rows) & (F.col("lo") < F.col("hi"))
    light = todo.limit(0)
    while n_todo := todo.count():  # at most log(span) / log(fan_out) rounds
        counted = _count_parts(spark, schema, opts, todo, n_todo, fan_out)
        light, todo = light.unionByName(counted.where(~heavy)), counted.where(heavy)
    return _merged(stats, light, opts, max_rows)


def _merged(stats: DataFrame, ranges: DataFrame, opts: ScanOptions, max_rows: int) -> DataFrame:
    """Neighbouring light ranges joined while the rows before them in the shard are in the same ``max_rows``."""
    ranges = written(ranges, "light-ranges")
    some = ranges.groupBy(*S.SHARD).agg(F.sum("n_rows").alias("n")).where("n > 0")
    ranges = joined(ranges, some, S.SHARD, "left_semi")  # a shard without a row to read gets no split
    alone = F.col("n_rows") > max_rows  # one key
    marked = ranges.withColumn("light", F.when(alone, 0).otherwise(F.col("n_rows")).cast("bigint")).withColumn(
        "hot", alone.cast("int").cast("bigint"))
    swept = running_sums(marked, S.SHARD, ["lo"], {"through": "light", "hots": "hot"})
    carried = ["columns", "key_column", "salt_column"]
    merged = swept.groupBy(*S.SHARD, F.expr("(through - light) div %d" % max_rows).alias("step"),
                           (F.col("hots") * 2 - F.col("hot")).alias("turn")).agg(
        F.min("lo").alias("lo"), F.max("hi").alias("hi"), F.sum("n_rows").alias("n_rows"), *[F.first(c).alias(c) for c in carried])
    numbered = running_sums(merged.withColumn("one", F.lit(1).cast("bigint")), (), [*S.SHARD, "lo"], {"number": "one"})
    numbered = written(numbered.withColumn("split_id", F.col("number") - 1), "equal-depth")
    first = numbered.groupBy(*S.SHARD).agg(F.min("split_id").alias("first"))
    plan = joined(numbered, first, S.SHARD, "inner").select(
        "split_id", *S.SHARD, *carried, "lo", "hi", "n_rows",
        (F.col("split_id") - F.col("first")).alias("split_no"), F.lit(None).cast("int").alias("bucket"))
    names = [f.split()[0] for f in S.PLAN.split(", ")]
    if opts.null_key == "keep":
        n_ranges = numbered.count()
        some = stats.where(F.coalesce("n_null", F.lit(1)) > 0).withColumn("one", F.lit(1).cast("bigint"))
        some = running_sums(some, (), S.SHARD, {"number": "one"})
        plan = plan.unionByName(some.select(
            (F.lit(n_ranges) + F.col("number") - 1).alias("split_id"), *S.SHARD, *carried, F.lit(None).cast("bigint").alias("split_no"),
            F.lit(None).cast("decimal(38,0)").alias("lo"), F.lit(None).cast("decimal(38,0)").alias("hi"),
            F.lit(None).cast("int").alias("bucket"), F.col("n_null").alias("n_rows")))
    return plan.select(*[F.col(f.split()[0]).cast(f.split(" ", 1)[1]).alias(f.split()[0]) for f in S.PLAN.split(", ")], "n_rows")
