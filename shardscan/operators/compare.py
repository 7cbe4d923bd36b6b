"""Set operations between two sharded copies: checksums first, rows only where they differ.

The key axis is cut into ranges, by the row counts so many that most hold about ``leaf_rows`` rows; for each, every shard of
both sides returns a row count and a sum of row hashes, computed in its database by one ``GROUP BY``.  Sums add up over shards,
so the two sides may be sharded differently.  Ranges with equal counts and sums are done; of the others, those with more rows (keys lie
unevenly) are cut again, down to ranges of at most ``leaf_rows`` rows or one key.  The rows of those alone travel, and
``EXCEPT ALL`` runs on them.  Copies that agree cost one scan inside the databases and no row; so do the sums of copies
that differ everywhere, where keys lie evenly.

A row's hash is 60 bits of an md5 of its declared columns' text; ranges that differ pass as equal with a
probability of about 2^-60 each.  Different engines may spell one value differently: such ranges are fetched and
compared by value, so the result is the same, only dearer.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping
from dataclasses import replace
from decimal import Decimal
from typing import Any

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from shardscan.functions import ranges as R
from shardscan.options import ScanOptions, redacted_errors
from shardscan.sources import dbapi
from shardscan.sources import stored as S
from shardscan.sources.jdbc import as_options, as_schema
from shardscan.util import written

HALF = 2 ** 30
EXCESS, BLOCK = "__excess", 4096
CELLS = 1024
#: Differing ranges are small: a task reads this many, over one connection.
LEAVES_PER_TASK = 64
#: The first cut makes no ranges for fewer rows than this, however small the leaves may be.
FIRST_ROWS = 1000
_SUMS = "side int, lo decimal(38,0), hi decimal(38,0), n bigint, h1 decimal(38,0), h2 decimal(38,0)"


def _bounds(stats: DataFrame) -> tuple[int, int] | None:
    r = stats.agg(F.min("mn").alias("mn"), F.max("mx").alias("mx")).first()
    return None if r.mn is None else (int(r.mn), int(r.mx))


def overlapping(shards: DataFrame, ranges: DataFrame, whole: tuple[int, int]) -> DataFrame:
    """Every shard with every range that its keys ``[mn, mx]`` meet.  An equi-join: both are spread over the cells of a grid that
    they touch, and a pair counts in the first cell they share."""
    low, width = whole[0], (whole[1] - whole[0]) // CELLS + 1

    def cell(c: str):
        inside = F.greatest(F.least(F.col(c).cast("decimal(38,0)"), F.lit(str(whole[1])).cast("decimal(38,0)")), F.lit(str(low)).cast("decimal(38,0)"))
        return R.idiv(inside - F.lit(str(low)).cast("decimal(38,0)"), F.lit(str(width)).cast("decimal(38,0)")).cast("int")

    def spread(df: DataFrame, lo: str, hi: str, first: str) -> DataFrame:
        return df.withColumn(first, cell(lo)).withColumn("cell", F.explode(F.sequence(F.col(first), cell(hi))))

    a = spread(shards.where("mn IS NOT NULL"), "mn", "mx", "first_a")
    b = spread(ranges.select("lo", "hi"), "lo", "hi", "first_b")
    meet = (F.col("cell") == F.greatest("first_a", "first_b")) & (F.col("mn") <= F.col("hi")) & (F.col("lo") <= F.col("mx"))
    return a.join(b, "cell").where(meet).drop("cell", "first_a", "first_b")


def _sums(spark: SparkSession, schema: StructType, sides: list[tuple[ScanOptions, DataFrame]], ranges: DataFrame, whole: tuple[int, int],
          fan_out: int) -> DataFrame:
    """Counts and hash sums of both sides for every part of every range (equal width, at most ``fan_out`` parts)."""
    found = []
    for side, (opts, shards) in enumerate(sides):
        reader = S._reader(spark, schema, opts)

        def add(batches: Iterator[pa.RecordBatch], reader=reader, side=side) -> Iterator[pa.RecordBatch]:
            with S.Connections(reader.opts) as open_to:
                for b in batches:
                    out: list[tuple] = []
                    for r in b.to_pylist():
                        lo, hi = int(r["lo"]), int(r["hi"])
                        width = -(-(hi - lo + 1) // fan_out)
                        kind = dbapi._kind(reader.opts.urls[r["url_no"]])
                        d = dbapi._DIALECTS[kind]
                        split = dbapi.Split(-1, r["url_no"], r["schema_name"], r["table_name"], tuple(r["columns"]), r["key_column"], lo, hi)
                        with redacted_errors(f"checksums on server {r['url_no']}", (reader.opts.password,)):
                            conn = open_to(r["url_no"])
                            dbapi.prepare_hash(conn, kind)
                            wide = reader.wide_columns(conn, kind, None if reader.opts.query else split.table)
                            text, params = reader._statement(kind, split, wide)
                            h = d.row_hash([d.quote(c) for c in split.columns])
                            part = dbapi.key_part(kind, split.key, lo, hi, width, wide)
                            sql = (f"SELECT part, COUNT(*), SUM({d.mod('h', HALF)}), SUM({d.int_div('h', str(HALF))}) FROM "
                                   f"(SELECT {part} AS part, {h} AS h{text[text.index(' FROM '):]}) s GROUP BY part")
                            cur = conn.cursor()
                            cur.execute(sql, params) if params else cur.execute(sql)
                            out += [(side, Decimal(lo + int(i) * width), Decimal(min(hi, lo + int(i) * width + width - 1)), n,
                                     Decimal(int(a)), Decimal(int(c))) for i, n, a, c in cur.fetchall()]  # at most fan_out
                            cur.close()
                    kinds = [pa.int32(), pa.decimal128(38, 0), pa.decimal128(38, 0), pa.int64(), pa.decimal128(38, 0), pa.decimal128(38, 0)]
                    cols = list(zip(*out)) if out else [[]] * 6
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)],
                                                     names=[f.split()[0] for f in _SUMS.split(", ")])

        asked = overlapping(shards, ranges, whole)
        lanes = dbapi.PROBE_CONNECTIONS
        lane = F.pmod(F.xxhash64(*S.SHARD, "lo"), F.lit(lanes))
        n_tasks = min(S.MAX_TASKS, lanes * len(opts.urls))
        task = F.pmod(F.col("url_no") * lanes + lane.cast("int"), F.lit(n_tasks))
        dealt = asked.repartitionById(n_tasks, task).sortWithinPartitions("url_no", *S.SHARD[1:], "lo")  # neighbours in turn
        found.append(dealt.mapInArrow(add, _SUMS))
    return written(found[0].unionByName(found[1]).groupBy("lo", "hi").agg(*[
        F.sum(F.when(F.col("side") == side, F.col(c)).otherwise(0)).alias(f"{c}_{side}") for c in ("n", "h1", "h2") for side in (0, 1)]), "sums")


def _equal_ranges(spark: SparkSession, whole: tuple[int, int], n_rows: int, rows: int) -> DataFrame:
    """``whole`` in ranges of equal width, for about three quarters of ``rows`` rows each where keys lie evenly."""
    lo, hi = whole
    width = max(1, -(-(hi - lo + 1) // max(1, -(-4 * n_rows // (3 * rows)))))
    n = -(-(hi - lo + 1) // width)

    def big(v: int):
        return F.lit(str(v)).cast("decimal(38,0)")

    start = big(lo) + F.col("id").cast("decimal(20,0)") * big(width)
    return spark.range(n).select(start.cast("decimal(38,0)").alias("lo"), F.least(start + big(width - 1), big(hi)).cast("decimal(38,0)").alias("hi"))


def differing_ranges(spark: SparkSession, schema: StructType | str, left: ScanOptions | Mapping[str, Any],
                     right: ScanOptions | Mapping[str, Any], leaf_rows: int = 10_000, fan_out: int = 64) -> DataFrame:
    """``lo, hi, n_left, n_right``: disjoint key ranges whose rows differ between the two logical tables, each with at most
    ``leaf_rows`` rows on either side, or one key.  NULL keys are not looked at."""
    schema = as_schema(schema)
    sides = []
    for o in (left, right):
        # a batch size, so that rows are counted
        opts = replace(as_options(o), batch_size=FIRST_ROWS, partition_num=None, salt_column=None, salt_buckets=1, null_key="drop")
        if opts.explicit_bounds:
            raise ValueError("compare by 'scan.key-ranges' or conditions, not by declared bounds")
        sides.append((opts, S.probe_shards(spark, schema, opts, S.find_shards(spark, schema, opts))))
    ends = [b for b in (_bounds(s) for _, s in sides) if b]
    out = spark.createDataFrame([], "lo decimal(38,0), hi decimal(38,0), n_left bigint, n_right bigint")
    if not ends:
        return out
    whole = min(a for a, _ in ends), max(b for _, b in ends)
    n_rows = max(s.agg(F.sum("n")).first()[0] or 0 for _, s in sides)
    ranges = _equal_ranges(spark, whole, n_rows, max(leaf_rows, FIRST_ROWS) * fan_out)
    differ = (F.col("n_0") != F.col("n_1")) | (F.col("h1_0") != F.col("h1_1")) | (F.col("h2_0") != F.col("h2_1"))
    large = (F.greatest("n_0", "n_1") > leaf_rows) & (F.col("lo") < F.col("hi"))
    while not ranges.isEmpty():  # at most log(span) / log(fan_out) rounds
        bad = _sums(spark, schema, sides, ranges, whole, fan_out).where(differ)
        out = out.unionByName(bad.where(~large).select("lo", "hi", F.col("n_0").alias("n_left"), F.col("n_1").alias("n_right")))
        ranges = bad.where(large)
    return out


def except_all(spark: SparkSession, schema: StructType | str, left: ScanOptions | Mapping[str, Any],
               right: ScanOptions | Mapping[str, Any], leaf_rows: int = 10_000, fan_out: int = 64) -> DataFrame:
    """The rows of ``left`` that ``right`` has not, and the other way round, each as often as it is in excess: the declared columns and
    ``side`` (``left`` or ``right``).  Rows with a NULL key are compared when the options of both keep them."""
    schema = as_schema(schema)
    ranges = written(differing_ranges(spark, schema, left, right, leaf_rows, fan_out), "differing")
    sides = [as_options(left), as_options(right)]
    if sides[0].null_key != sides[1].null_key:
        raise ValueError("'scan.null-key' differs between the two sides")
    rows = []
    for opts in sides:
        opts = replace(opts, batch_size=None, partition_num=1, salt_column=None, salt_buckets=1)
        stats = S.probe_shards(spark, schema, opts, S.find_shards(spark, schema, opts))
        ends = _bounds(stats) or (0, 0)
        plan = overlapping(stats, ranges, ends).select(*S.SHARD, "columns", "key_column", "salt_column", "lo", "hi")
        if opts.null_key == "keep":
            none = F.lit(None).cast("decimal(38,0)")
            plan = plan.unionByName(stats.where(F.coalesce("n_null", F.lit(1)) > 0).select(
                *S.SHARD, "columns", "key_column", "salt_column", none.alias("lo"), none.alias("hi")))
        plan = plan.withColumn("split_id", F.monotonically_increasing_id()).withColumn("bucket", F.lit(None).cast("int"))
        rows.append(S.read_split_plan(spark, written(plan, "differing-splits"), schema, replace(
            opts, null_key="drop", splits_per_task=max(opts.splits_per_task, LEAVES_PER_TASK))))
    signed = [r.withColumn(EXCESS, F.lit(sign).cast("bigint")) for r, sign in zip(rows, (1, -1))]
    names = [f"`{f.name}`" for f in schema.fields]
    excess = signed[0].unionByName(signed[1]).groupBy(*names).agg(F.sum(EXCESS).alias(EXCESS)).where(f"{EXCESS} <> 0")
    # each row as often as it is in excess, without an array as long as that
    times = F.abs(F.col(EXCESS))
    blocks = excess.withColumn("__block", F.explode(F.sequence(F.lit(0), R.long_div(times - 1, F.lit(BLOCK)))))
    left_over = F.least(F.lit(BLOCK), times - F.col("__block") * BLOCK).cast("int")
    each = blocks.withColumn("__copy", F.explode(F.array_repeat(F.lit(1), left_over)))
    return written(each.select(*names, F.when(F.col(EXCESS) > 0, "left").otherwise("right").alias("side")), "differences")
