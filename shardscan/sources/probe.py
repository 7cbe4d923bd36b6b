"""Key-bounds and row-count probes of remote shards.

Per server, the probes of up to ``CHUNK_TABLES`` tables (``CHUNK_TABLES_COUNT``
when row counts are needed, so that a server counts several tables at once)
go out as one ``UNION ALL`` statement, read by one Spark task; all servers'
statements are unioned into one Spark job.  The database does the work (``MIN``/``MAX`` of
an indexed key is an index lookup); Spark receives one row per shard.

``COUNT(*)`` is only asked for in batch-size mode, and the NULL-key count
only when NULL keys are kept: a row count scans the table (or an index) on
most engines.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DecimalType

from shardscan.options import ScanOptions
from shardscan.sources.discovery import Shard
from shardscan.util import balanced_union, parallel_map

CHUNK_TABLES = 200  # MIN/MAX probes: index lookups, many per statement
CHUNK_TABLES_COUNT = 16  # with COUNT(*) (a scan each): fewer per statement, more statements in parallel
PROBE_COLUMNS = ("shard_no", "mn", "mx", "n", "n_null")


def source_sql(shard: Shard, opts: ScanOptions) -> str:
    """FROM-clause text of a shard: a qualified table or a parenthesised query."""
    d = shard.dialect
    if shard.table is None:
        return f"({opts.query}) q"
    if opts.query:
        return "(" + opts.query.replace("{table}", d.qualified(shard.schema, shard.table)) + ") q"
    return d.qualified(shard.schema, shard.table)


def key_sql(shard: Shard, opts: ScanOptions) -> str:
    """The key column as SQL text of the shard's server."""
    if shard.table is None or opts.query:
        # a query's output column, exactly as the user named it
        return shard.dialect.quote(opts.partition_column)
    actual = shard.resolve(opts.partition_column)
    if actual is None:
        raise ValueError(
            f"{shard.label(opts)} has no partition column {opts.partition_column!r}"
        )
    return shard.dialect.quote(actual)


def probe_statement(shard_no: int, shard: Shard, opts: ScanOptions) -> str:
    """One row of statistics for one shard.

    Each aggregate is its own scalar subquery: a lone ``MIN``/``MAX`` over an
    indexed key is answered from the index on every engine, while some
    engines scan the table when ``MIN`` and ``MAX`` share one ``SELECT``.
    """
    d = shard.dialect
    k = key_sql(shard, opts)
    src = source_sql(shard, opts)
    cond = f"{k} BETWEEN {opts.lower_bound} AND {opts.upper_bound}" if opts.explicit_bounds else ""

    def sub(expr: str, where: str = cond) -> str:
        return f"(SELECT {expr} FROM {src}" + (f" WHERE {where}" if where else "") + ")"

    n = sub("COUNT(*)") if opts.batch_size is not None else d.null_bigint
    # NULL keys lie outside any declared bounds: counted without them
    n_null = sub("COUNT(*)", f"{k} IS NULL") if opts.null_key == "keep" else d.null_bigint
    q = [d.quote(c) for c in PROBE_COLUMNS]
    return (
        f"SELECT {shard_no} AS {q[0]}, {sub(f'MIN({k})')} AS {q[1]}, {sub(f'MAX({k})')} AS {q[2]}, "
        f"{n} AS {q[3]}, {n_null} AS {q[4]}{d.dual}"
    )


def probe(spark: SparkSession, opts: ScanOptions, shards: Sequence[Shard]) -> DataFrame:
    """``shard_no, mn, mx, n, n_null`` (bounds as DECIMAL(38,0)) for ``shards``.

    ``shard_no`` is the position in ``shards``.
    """
    size = CHUNK_TABLES_COUNT if (opts.batch_size is not None or opts.null_key == "keep") else CHUNK_TABLES
    df = union_all_statements(spark, opts, shards, range(len(shards)),
                              lambda i: probe_statement(i, shards[i], opts), size, PROBE_COLUMNS)
    return df.select(
        F.col("shard_no").cast("int").alias("shard_no"),
        F.col("mn").cast("decimal(38,0)").alias("mn"),
        F.col("mx").cast("decimal(38,0)").alias("mx"),
        F.col("n").cast("bigint").alias("n"),
        F.col("n_null").cast("bigint").alias("n_null"),
    )


def union_all_statements(spark: SparkSession, opts: ScanOptions, shards: Sequence[Shard], members: Iterable[int],
                         statement: Callable[[int], str], chunk: int, columns: Sequence[str],
                         types: Sequence[DataType] | None = None, properties: dict[str, str] | None = None) -> DataFrame:
    """The rows of ``statement(shard_no)`` of all ``members``: per server, ``chunk`` statements joined by
    ``UNION ALL`` are one relation and one task.  Columns are cast to ``types`` (default: all DECIMAL(38,0))."""
    by_url: dict[int, list[int]] = {}
    for i in members:
        by_url.setdefault(shards[i].url_no, []).append(i)
    chunks = [(url_no, idx[c:c + chunk]) for url_no, idx in by_url.items() for c in range(0, len(idx), chunk)]

    def one(part: tuple[int, list[int]]) -> DataFrame:
        url_no, mine = part
        reader = spark.read.format("jdbc").option("url", opts.urls[url_no]).option(
            "query", " UNION ALL ".join(statement(i) for i in mine))
        for k, v in {**opts.jdbc_properties(shards[mine[0]].dialect.driver), **(properties or {})}.items():
            reader = reader.option(k, v)
        df = reader.load().toDF(*columns)
        # databases type the same expression differently
        wanted = types or [DecimalType(38, 0)] * len(columns)
        return df.select(*[df[f"`{c}`"].cast(t).alias(c) for c, t in zip(columns, wanted)])

    return balanced_union(parallel_map(one, chunks))
