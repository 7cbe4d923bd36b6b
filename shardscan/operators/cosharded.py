"""Join of two logical tables that are sharded by the same key: split by split, without a shuffle of either.

Shards pair up by name: each side's ``table-name`` pattern captures a tag in its group 1 (``ORDERS_(.*)`` and
``LINEITEM_(.*)``), and shards with one tag hold the same keys.  The left side's split plan carries its partner's
name along; a task reads a key range from both partners and joins the two in memory, so a task holds one split of each
side.  What crosses the network between tasks is the plan, one small row per split.

Cut the splits with the larger side in mind (``scan.batch.size`` counts rows of the left side), or pass an
:func:`~shardscan.operators.equal_depth.equal_depth_plan` of either.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Mapping
from dataclasses import replace
from typing import Any

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from shardscan.operators.prefix import joined
from shardscan.options import ScanOptions, redacted_errors
from shardscan.sources import dbapi
from shardscan.sources import stored as S
from shardscan.sources.discovery import full_match
from shardscan.sources.jdbc import as_options, as_schema
from shardscan.util import written

MATCH = "__right_key"


def _tagged(df: DataFrame, opts: ScanOptions) -> DataFrame:
    if re.compile(opts.table_name).groups < 1:
        raise ValueError(f"'table-name' {opts.table_name!r} captures no group to pair shards by")
    return df.withColumn("tag", F.regexp_extract("table_name", full_match(opts.table_name), 1))


def co_sharded_join(spark: SparkSession, left: StructType | str, left_options: ScanOptions | Mapping[str, Any],
                    right: StructType | str, right_options: ScanOptions | Mapping[str, Any], how: str = "inner",
                    plan: DataFrame | None = None) -> DataFrame:
    """Rows of ``left`` joined to the rows of ``right`` with the same key (each side's ``scan.partition.column``, which
    both schemas must declare); ``how`` is ``inner``, ``left_outer``, ``left_semi`` or ``left_anti``.

    Columns: ``left``'s, then (not for semi and anti) ``right``'s without its key; names must differ.  NULL keys meet nothing; the
    left options say whether they are read at all.  A left shard without a partner joins nothing; two partners for one tag are
    an error, as the keys would not be told apart.  ``plan`` replaces the split plan of the left side."""
    kinds = {"inner": "inner", "left_outer": "left outer", "left_semi": "left semi", "left_anti": "left anti"}
    if how not in kinds:
        raise ValueError(f"how must be one of {sorted(kinds)}")
    lopts, ropts = as_options(left_options), as_options(right_options)
    # partners are read by the left side's ranges: the right side's own cut plays no part
    ropts = replace(ropts, batch_size=None, partition_num=1, salt_column=None, salt_buckets=1, null_key="drop")
    if lopts.salt_column:
        raise ValueError("a salted split holds part of a key's rows: join without scan.salt.*")
    lschema, rschema = as_schema(left), as_schema(right)
    lkey, rkey = _declared(lschema, lopts), _declared(rschema, ropts)
    more = [] if how in ("left_semi", "left_anti") else [f for f in rschema.fields if f.name != rkey]
    clash = {f.name for f in more} & {f.name for f in lschema.fields}
    if clash:
        raise ValueError(f"both sides declare {sorted(clash)}: rename on one side")
    out = StructType([*lschema.fields, *[StructField(f.name, f.dataType, True) for f in more]])

    splits = plan if plan is not None else S.distributed_split_plan(spark, lschema, lopts)
    partners = _tagged(S.find_shards(spark, rschema, ropts), ropts)
    twice = partners.groupBy("tag").count().where("count > 1").orderBy("tag").first()
    if twice:
        raise ValueError(f"{twice['count']} shards of the right side have the tag {twice.tag!r}")
    renamed = {c: f"r_{c}" for c in ("url_no", "schema_name", "table_name", "columns", "key_column", "salt_column")}
    tasks_of = written(joined(_tagged(splits, lopts), partners.withColumnsRenamed(renamed), ["tag"], "left"), "co-sharded")
    n = tasks_of.count()
    if not n:
        return spark.createDataFrame([], out)
    a, b = S._reader(spark, lschema, lopts), S._reader(spark, rschema, ropts)

    def rows_of(reader, open_to, split: dbapi.Split) -> pa.Table:
        with redacted_errors(f"reading server {split.url_no}", (reader.opts.password,)):
            conn = open_to(split.url_no)
        return pa.Table.from_batches(list(reader.read_over(conn, dbapi.Task(split.url_no, (split,)))), schema=_arrow(reader.schema))

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with S.Connections(a.opts) as to_left, S.Connections(b.opts) as to_right:  # neighbouring splits share servers
            yield from join_over(batches, to_left, to_right)

    def join_over(batches: Iterator[pa.RecordBatch], to_left, to_right) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                lo, hi = (None if r[c] is None else int(r[c]) for c in ("lo", "hi"))
                mine = rows_of(a, to_left, dbapi.Split(r["split_id"], r["url_no"], r["schema_name"], r["table_name"],
                                                       tuple(r["columns"]), r["key_column"], lo, hi))
                if r["r_url_no"] is None or lo is None:  # no partner, or the NULL keys: nothing to meet
                    other = pa.Table.from_batches([], schema=_arrow(rschema))
                else:
                    other = rows_of(b, to_right, dbapi.Split(r["split_id"], r["r_url_no"], r["r_schema_name"], r["r_table_name"],
                                                             tuple(r["r_columns"]), r["r_key_column"], lo, hi))
                at = other.schema.get_field_index(rkey)
                other = other.set_column(at, MATCH, other[rkey].cast(mine.schema.field(lkey).type))
                got = mine.join(other, keys=lkey, right_keys=MATCH, join_type=kinds[how], use_threads=False)
                yield from got.select(out.names).cast(_arrow(out)).to_batches(max_chunksize=10_000)

    return S.dealt(tasks_of, n, lopts.splits_per_task).mapInArrow(join, out)


def _arrow(schema: StructType) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(schema)


def _declared(schema: StructType, opts: ScanOptions) -> str:
    hits = [f.name for f in schema.fields if f.name.lower() == opts.partition_column.lower()]
    if len(hits) != 1:
        raise ValueError(f"declare the key {opts.partition_column!r} on both sides")
    return hits[0]
