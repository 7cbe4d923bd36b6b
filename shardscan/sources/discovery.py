"""Shard discovery: servers x schemas x tables whose names fully match two regexes.

One catalog query per server, read through Spark's JDBC source; the catalog
DataFrames of all servers are unioned, so every server is queried by its own
task in a single Spark job.  Names are matched with Spark's ``rlike`` (Java
regex) anchored as ``\\A(?:re)\\z``: whole-string and case-sensitive.  The literal
prefix of each regex already cuts the catalog down on the server.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shardscan.options import ScanOptions, redacted_errors
from shardscan.sources.dialects import CATALOG_COLUMNS, Dialect, dialect_for
from shardscan.util import balanced_union, parallel_map


@dataclass(frozen=True)
class Shard:
    """One physical table (or one query) on one server."""

    url_no: int
    url: str
    schema: str | None
    table: str | None
    table_type: str
    columns: tuple[str, ...] = ()

    @property
    def dialect(self) -> Dialect:
        return dialect_for(self.url)

    @property
    def sort_key(self) -> tuple:
        return (self.url_no, self.schema or "", self.table or "")

    def label(self, opts: ScanOptions | None = None) -> str:
        where = f"{self.schema}.{self.table}" if self.table else "query"
        server = opts.redact(self.url) if opts else f"#{self.url_no}"
        return f"server {self.url_no} ({server}) {where}"

    def resolve(self, name: str) -> str | None:
        """Actual column name for a declared one: exact, else case-insensitive."""
        if name in self.columns:
            return name
        hits = [c for c in self.columns if c.lower() == name.lower()]
        if len(hits) == 1:
            return hits[0]
        if len(hits) > 1:
            raise ValueError(f"column {name!r} is ambiguous in {self.label()}: {hits}")
        return None


def full_match(regex: str) -> str:
    return "\\A(?:" + regex + ")\\z"


def catalog(spark: SparkSession, opts: ScanOptions) -> DataFrame:
    """``url_no, schema_name, table_name, table_type, column_name, ordinal`` of every server."""
    def one(url_no: int) -> DataFrame:
        url = opts.urls[url_no]
        d = dialect_for(url)
        reader = spark.read.format("jdbc").option("url", url).option(
            "query", d.catalog(opts.schema_name, opts.table_name))
        for k, v in opts.jdbc_properties(d.driver).items():
            reader = reader.option(k, v)
        df = reader.load().toDF(*CATALOG_COLUMNS)
        return df.select(
            F.lit(url_no).cast("int").alias("url_no"),
            F.col("schema_name").cast("string").alias("schema_name"),
            F.col("table_name").cast("string").alias("table_name"),
            F.upper(F.trim(F.col("table_type").cast("string"))).alias("table_type"),
            F.col("column_name").cast("string").alias("column_name"),
            F.col("ordinal").cast("int").alias("ordinal"),
        )

    # each load() resolves its schema with a round trip to its server: a few driver threads
    return balanced_union(parallel_map(one, range(len(opts.urls))))


def schemas(spark: SparkSession, opts: ScanOptions) -> DataFrame:
    """``url_no, schema_name`` of every server's schemas whose name matches, with or without tables."""
    def one(url_no: int) -> DataFrame:
        url = opts.urls[url_no]
        d = dialect_for(url)
        reader = spark.read.format("jdbc").option("url", url).option("query", d.schema_query)
        for k, v in opts.jdbc_properties(d.driver).items():
            reader = reader.option(k, v)
        return reader.load().toDF("schema_name").select(
            F.lit(url_no).cast("int").alias("url_no"), F.col("schema_name").cast("string").alias("schema_name"))

    with redacted_errors("schema discovery", (opts.password,)):
        found = balanced_union(parallel_map(one, range(len(opts.urls))))
    return found.where(F.col("schema_name").rlike(full_match(opts.schema_name)))


def matching(cat: DataFrame, opts: ScanOptions) -> DataFrame:
    cond = F.col("schema_name").rlike(full_match(opts.schema_name)) & F.col("table_name").rlike(
        full_match(opts.table_name)
    )
    if opts.table_types:
        cond = cond & F.col("table_type").isin(*opts.table_types)
    return cat.where(cond)


def discover_shards(spark: SparkSession, opts: ScanOptions) -> DataFrame:
    """Public view of discovery: ``url_no, server, schema_name, table_name, table_type``.

    ``server`` is the URL with any password removed.
    """
    servers = spark.createDataFrame(
        [(i, opts.redact(u)) for i, u in enumerate(opts.urls)], "url_no int, server string"
    )
    with redacted_errors("shard discovery", (opts.password,)):
        cat = catalog(spark, opts)
    found = matching(cat, opts).select("url_no", "schema_name", "table_name", "table_type").distinct()
    return found.join(F.broadcast(servers), "url_no").select(
        "url_no", "server", "schema_name", "table_name", "table_type"
    )


def resolve_shards(spark: SparkSession, opts: ScanOptions,
                   wanted: Sequence[str] | None = None) -> list[Shard]:
    """Matched shards with their column lists, sorted (url_no, schema, table).

    Only one row per matched table reaches the driver; with ``wanted``
    (declared columns and key) it holds only those columns, matched
    case-insensitively, not every column of the table.
    """
    if opts.query and "{table}" not in opts.query:
        return [Shard(i, u, None, None, "QUERY") for i, u in enumerate(opts.urls)]
    with redacted_errors("shard discovery", (opts.password,)):
        m = matching(catalog(spark, opts), opts)
    # one row per matched table, whatever its columns: one that lacks all the wanted columns
    # shows up with none of them and fails the column check
    known = F.col("column_name").isNotNull()
    if wanted is not None:
        known = known & F.lower(F.col("column_name")).isin(sorted({w.lower() for w in wanted}))
    tables = m.groupBy("url_no", "schema_name", "table_name", "table_type").agg(
        F.collect_list(F.when(known, F.struct("ordinal", "column_name"))).alias("columns"))
    with redacted_errors("shard discovery", (opts.password,)):
        rows = tables.collect()
    shards = [
        Shard(r.url_no, opts.urls[r.url_no], r.schema_name, r.table_name, r.table_type,
              tuple(c.column_name for c in sorted(r["columns"], key=lambda c: (c.ordinal, c.column_name))))
        for r in rows
    ]
    return sorted(shards, key=lambda s: s.sort_key)


def check_columns(shards: Sequence[Shard], names: Sequence[str], opts: ScanOptions) -> None:
    """Every shard must have every declared column (and the key)."""
    for s in shards:
        if s.table is None:  # a query source: its columns are checked when read
            continue
        missing = [n for n in names if s.resolve(n) is None]
        if missing:
            raise ValueError(f"{s.label(opts)} lacks declared column(s) {missing}")
