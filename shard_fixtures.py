"""Lay the given parquet tables out as database shards, for tests and the bench.

Shards go into embedded Derby databases (bundled with Spark, no server, no
port).  In local mode they are in memory, and each shard is written by Spark's
JDBC writer from a filter of the source DataFrame.  An in-memory database lives
inside the JVM that made it, so on a cluster each server's database is built on
disk by one task, which packs it into a read-only archive in the shared folder
(``_load_archives``); driver and executors all read that through the same JDBC
driver.  Loads are remembered per application so a session pays once.
The DB-API backend's fixtures are SQLite files, written in pieces by many tasks
(``load_sqlite``), in ``spark.shardscan.fixtureDir``, below the checkpoint
folder of a cluster, or in a fresh local folder.
"""

from __future__ import annotations

import contextlib
import functools
import os
import re
import threading
import uuid
import zlib
from collections.abc import Sequence
from dataclasses import dataclass
from urllib.parse import unquote, urlparse

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, StringType, StructField

from shardscan.session import app_key, is_local, ship_package
from shardscan.sources.dialects import WIDE, WIDE_SHIFT

DERBY_DRIVER = "org.apache.derby.jdbc.EmbeddedDriver"
_LOADED: dict[tuple[str, str], tuple[str, ...]] = {}
_LOCK = threading.RLock()  # one loader at a time, so concurrent callers never load twice


def _serialized(fn):
    @functools.wraps(fn)
    def wrapper(*args, **kwargs):
        with _LOCK:
            return fn(*args, **kwargs)
    return wrapper


@dataclass(frozen=True)
class ShardSpec:
    server: int
    schema: str
    table: str
    rows: Column  # which rows of the source go to this shard


def derby_url(db: str, create: bool = False) -> str:
    return f"jdbc:derby:memory:{db}" + (";create=true" if create else "")


def sf_tag(sf_dir: str) -> str:
    """The folder's last name and a checksum of its whole path: folders of one name keep fixtures of their own."""
    path = sf_dir.rstrip("/")
    return re.sub(r"[^A-Za-z0-9]", "_", path.split("/")[-1]) + f"_{zlib.crc32(path.encode()):08x}"


@_serialized
def load_derby(spark: SparkSession, name: str, df: DataFrame, shards: Sequence[ShardSpec],
               n_servers: int | None = None, columns: Sequence[str] | None = None,
               varchar: int = 1024, index_on: str | None = None) -> tuple[str, ...]:
    """Write ``df`` (its ``columns``) into Derby shards; returns one URL per server.

    ``index_on`` names the shard key: it gets an index, as the key of a real
    sharded table does (an auto-increment primary key), so that ``MIN``/``MAX``
    probes and per-split range reads are index lookups, not table scans.
    """
    key = (app_key(spark), name)
    if key in _LOADED:
        return _LOADED[key]
    n_servers = n_servers or (max(s.server for s in shards) + 1)
    columns = list(columns or df.columns)
    if not is_local(spark):
        _LOADED[key] = _load_archives(spark, name, df, shards, n_servers, columns, varchar, index_on)
        return _LOADED[key]
    urls = tuple(derby_url(f"{name}_{i}") for i in range(n_servers))
    col_types = ", ".join(
        f"{f.name} VARCHAR({varchar})" for f in df.schema.fields
        if isinstance(f.dataType, StringType) and f.name in columns
    )
    for i in range(n_servers):  # create every server, even one without shards
        spark.read.format("jdbc").option("url", derby_url(f"{name}_{i}", create=True)).option(
            "driver", DERBY_DRIVER).option("query", "SELECT 1 AS x FROM SYSIBM.SYSDUMMY1").load().collect()
    for s in shards:
        w = df.where(s.rows).select(*columns).write.mode("overwrite").option("batchsize", 10000)
        if col_types:
            w = w.option("createTableColumnTypes", col_types)
        w.jdbc(derby_url(f"{name}_{s.server}", create=True), f"{s.schema}.{s.table}",
               properties={"driver": DERBY_DRIVER})
        if index_on:
            _try_index(spark, derby_url(f"{name}_{s.server}"), s.schema, s.table, index_on)
    _LOADED[key] = urls
    return urls


def _try_index(spark: SparkSession, url: str, schema: str, table: str, column: str) -> None:
    try:
        derby_ddl(spark, url, f'CREATE INDEX "{schema}"."IX_{table}" ON "{schema}"."{table}" ("{column}")')
    except Exception:  # no JVM gateway (Spark Connect): the fixture stays unindexed
        pass


# the column types that Spark's JDBC writer gives a Derby table
_DERBY_TYPES = {"bigint": "BIGINT", "int": "INTEGER", "smallint": "SMALLINT", "tinyint": "SMALLINT",
                "boolean": "BOOLEAN", "double": "DOUBLE PRECISION", "float": "REAL", "date": "DATE",
                "timestamp": "TIMESTAMP", "timestamp_ntz": "TIMESTAMP"}


def _derby_type(field: StructField, varchar: int) -> str:
    if isinstance(field.dataType, StringType):
        kind = f"VARCHAR({varchar})"
    elif isinstance(field.dataType, DecimalType):
        kind = field.dataType.simpleString().upper()
    else:
        kind = _DERBY_TYPES[field.dataType.simpleString()]
    return kind if field.nullable else f"{kind} NOT NULL"


def archive_url(path: str) -> str:
    return f"jdbc:derby:jar:({path})db"


def _load_archives(spark: SparkSession, name: str, df: DataFrame, shards: Sequence[ShardSpec], n_servers: int,
                   columns: Sequence[str], varchar: int, index_on: str | None) -> tuple[str, ...]:
    """The databases of ``load_derby`` as read-only archives that every JVM of a cluster can open.

    Rows are hash-partitioned by server, so each database has exactly one writer
    task.  The task writes a CSV file per table, Derby imports them in a process
    of its own, and the closed database is packed and renamed into place.
    """
    ship_package(spark)  # this module imports it
    spark.sparkContext.addPyFile(os.path.abspath(__file__))
    folder = os.path.join(fixture_root(spark), name)
    os.makedirs(folder, exist_ok=True)
    # JDBC reads a TIMESTAMP in the JVM's zone
    zone = spark.sparkContext._jvm.java.util.TimeZone.getDefault().getID()

    def text(c: str) -> Column:
        value = F.col(f"`{c}`")
        if df.schema[c].dataType.simpleString() == "timestamp":
            value = F.convert_timezone(None, F.lit(zone), value.cast("timestamp_ntz"))
        return value.cast("string").alias(c)

    to = F.array_compact(F.array(*[
        F.when(s.rows, F.struct(F.lit(s.server).alias("server"), F.lit(no).alias("shard")))
        for no, s in enumerate(shards)]))
    rows = df.select(F.explode(to).alias("_to"), *map(text, columns)).select("_to.server", "_to.shard", *columns)
    every = spark.range(n_servers).select(  # a server without rows is made, too
        F.col("id").cast("int").alias("server"), F.lit(-1).alias("shard"),
        *[F.lit(None).cast("string").alias(c) for c in columns])
    ddl = ", ".join(f'"{c}" {_derby_type(df.schema[c], varchar)}' for c in columns)
    tables = [(s.server, s.schema, s.table) for s in shards]
    columns = list(columns)

    def write(batches):
        import tempfile

        import pyarrow as pa
        import pyarrow.compute as pc
        from pyarrow import csv

        made, files = set(), {}
        local = os.environ.get("SPARK_LOCAL_DIRS", "").split(",")[0] or None
        with tempfile.TemporaryDirectory(prefix="shardscan-derby-", dir=local) as scratch:
            for b in batches:
                made.update(b.column("server").unique().to_pylist())
                for no in b.column("shard").unique().to_pylist():
                    if no < 0:
                        continue
                    t = pa.Table.from_batches([b]).filter(pc.equal(b.column("shard"), no)).select(columns)
                    if no not in files:  # values in quotes, NULL as nothing
                        path = os.path.join(scratch, f"{no}.csv")
                        files[no] = path, csv.CSVWriter(path, t.schema, write_options=csv.WriteOptions(
                            include_header=False, quoting_style="all_valid"))
                    files[no][1].write_table(t)
            for _, w in files.values():
                w.close()
            for i in sorted(made):
                mine = [(schema, table, files[no][0] if no in files else None)
                        for no, (server, schema, table) in enumerate(tables) if server == i]
                _build_archive(os.path.join(scratch, f"server_{i}"), mine, ddl, index_on,
                               os.path.join(folder, f"part_{i}.jar"))
        yield pa.RecordBatch.from_pydict({"server": sorted(made)}, schema=pa.schema([("server", pa.int64())]))

    (rows.unionByName(every).repartition(n_servers, F.col("server"))
         .mapInArrow(write, "server bigint").collect())  # one small row per server
    return tuple(archive_url(os.path.join(folder, f"part_{i}.jar")) for i in range(n_servers))


def _build_archive(home: str, tables: Sequence[tuple[str, str, str | None]], ddl: str, index_on: str | None,
                   target: str) -> None:
    """One Derby database of ``(schema, table, CSV file or None)``, made below ``home`` by Derby's own
    command line tool, as an archive ``target``; entries are stored, so that a page is read by its offset."""
    import shutil
    import subprocess
    import zipfile

    from pyspark.find_spark_home import _find_spark_home

    os.makedirs(home)
    script = [f"CONNECT 'jdbc:derby:{home}/db;create=true'"]
    for schema, table, path in tables:
        script.append(f'CREATE TABLE "{schema}"."{table}" ({ddl})')
        if path:
            script.append(f"CALL SYSCS_UTIL.SYSCS_IMPORT_TABLE('{schema}', '{table}', '{path}', null, null, 'UTF-8', 1)")
        if index_on:
            script.append(f'CREATE INDEX "{schema}"."IX_{table}" ON "{schema}"."{table}" ("{index_on}")')
    script += ["DISCONNECT", f"CONNECT 'jdbc:derby:{home}/db;shutdown=true'", "EXIT"]
    with open(os.path.join(home, "load.sql"), "w") as f:
        f.write(";\n".join(script) + ";\n")
    java = os.path.join(os.environ["JAVA_HOME"], "bin", "java") if os.environ.get("JAVA_HOME") else "java"
    done = subprocess.run(
        [java, "-Xmx192m", "-XX:+UseSerialGC", f"-Dderby.system.home={home}", "-cp",
         os.path.join(_find_spark_home(), "jars", "*"), "org.apache.derby.tools.ij", os.path.join(home, "load.sql")],
        capture_output=True, text=True)
    # 08006 reports the shutdown asked for
    errors = [line for line in done.stdout.splitlines() if line.startswith("ERROR ") and "08006" not in line]
    if done.returncode or errors or os.path.exists(os.path.join(home, "db", "db.lck")):
        raise RuntimeError(f"Derby did not build {target}: {errors or (done.stdout + done.stderr)[-2000:]}")
    for _, _, path in tables:
        if path:
            os.remove(path)
    tmp = f"{target}.{uuid.uuid4().hex}.tmp"
    with zipfile.ZipFile(tmp, "w", zipfile.ZIP_STORED) as z:
        for at, _, names in os.walk(os.path.join(home, "db")):
            for n in names:
                z.write(os.path.join(at, n), os.path.relpath(os.path.join(at, n), home))
    shutil.rmtree(home)  # the next server of this task needs the room
    os.replace(tmp, target)


def parquet(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{table}.parquet")


# ----------------------------------------------------------------- layouts
def orders_shards(spark: SparkSession, sf_dir: str, variant: str = "plain") -> tuple[str, ...]:
    """orders: server ``o_orderkey % 2``, table ``APP.ORDERS_{o_orderkey % 4}``.

    Variants: ``empty`` adds an empty ``ORDERS_4`` on server 0; ``nulls`` sets
    every 10th key to NULL (rows stay in the shard of their original key).
    """
    src = parquet(spark, sf_dir, "orders")
    cols = list(src.columns)
    k = F.col("o_orderkey")
    src = src.withColumn("_shard", k % 4)
    if variant == "nulls":
        src = src.withColumn("o_orderkey", F.when(k % 10 == 0, F.lit(None).cast("bigint")).otherwise(k))
    elif variant not in ("plain", "empty"):
        raise ValueError(f"unknown orders variant {variant!r}")
    shards = [ShardSpec(i % 2, "APP", f"ORDERS_{i}", F.col("_shard") == i) for i in range(4)]
    if variant == "empty":
        shards.append(ShardSpec(0, "APP", "ORDERS_4", F.lit(False)))
    return load_derby(spark, f"ss_{sf_tag(sf_dir)}_orders_{variant}", src, shards, columns=cols,
                      index_on="o_orderkey")


def orders_hot_key(spark: SparkSession, sf_dir: str) -> tuple[str, ...]:
    """orders sharded as usual plus ``hot_key = o_orderkey % 3``: a shard key
    whose every value holds a third of the rows."""
    src = parquet(spark, sf_dir, "orders")
    k = F.col("o_orderkey")
    src = src.withColumn("hot_key", k % 3)
    shards = [ShardSpec(i % 2, "APP", f"ORDERS_{i}", k % 4 == i) for i in range(4)]
    return load_derby(spark, f"ss_{sf_tag(sf_dir)}_orders_hot", src, shards, index_on="hot_key")


def orders_wide_key(spark: SparkSession, sf_dir: str) -> tuple[str, ...]:
    """orders sharded as usual plus ``wide_key``, a DECIMAL(20,0) above 2^63."""
    src = parquet(spark, sf_dir, "orders")
    k = F.col("o_orderkey")
    wide = (F.lit(str(2**63 + 10)).cast("decimal(20,0)") + k.cast("decimal(19,0)")).cast("decimal(20,0)")
    shards = [ShardSpec(i % 2, "APP", f"ORDERS_{i}", k % 4 == i) for i in range(4)]
    return load_derby(spark, f"ss_{sf_tag(sf_dir)}_orders_wide", src.withColumn("wide_key", wide), shards,
                      index_on="wide_key")


def part_quoted(spark: SparkSession, sf_dir: str) -> tuple[str, ...]:
    """part in one table with a text column ``note`` that holds a quote and a backslash on even keys."""
    src = parquet(spark, sf_dir, "part")
    note = F.when(F.col("p_partkey") % 2 == 0, F.lit("it's a \\ sign")).otherwise(F.lit("plain"))
    return load_derby(spark, f"ss_{sf_tag(sf_dir)}_part", src.withColumn("note", note),
                      [ShardSpec(0, "APP", "PART", F.lit(True))], index_on="p_partkey")


def nation_copies(spark: SparkSession, sf_dir: str) -> tuple[str, ...]:
    """nation: every row in ``APP.NATION_0`` on both servers."""
    src = parquet(spark, sf_dir, "nation")
    shards = [ShardSpec(i, "APP", "NATION_0", F.lit(True)) for i in range(2)]
    return load_derby(spark, f"ss_{sf_tag(sf_dir)}_nation", src, shards, index_on="n_nationkey")


def supplier_schemas(spark: SparkSession, sf_dir: str) -> tuple[str, ...]:
    """supplier on one server, schema by ``s_suppkey % 3``: EU_0, EU_1, XX_0."""
    src = parquet(spark, sf_dir, "supplier")
    k = F.col("s_suppkey") % 3
    shards = [ShardSpec(0, name, "SUPPLIER", k == i) for i, name in enumerate(["EU_0", "EU_1", "XX_0"])]
    return load_derby(spark, f"ss_{sf_tag(sf_dir)}_supplier", src, shards, index_on="s_suppkey")


def lineitem_shards(spark: SparkSession, sf_dir: str) -> tuple[str, ...]:
    """lineitem: server ``l_orderkey % 2``, table ``APP.LINEITEM_{l_orderkey % 4}``."""
    src = parquet(spark, sf_dir, "lineitem")
    k = F.col("l_orderkey") % 4
    shards = [ShardSpec(i % 2, "APP", f"LINEITEM_{i}", k == i) for i in range(4)]
    return load_derby(spark, f"ss_{sf_tag(sf_dir)}_lineitem", src, shards, index_on="l_orderkey")


# ------------------------------------------------------------ sqlite files
_SQLITE_TYPES = {"bigint": "INTEGER", "int": "INTEGER", "smallint": "INTEGER", "tinyint": "INTEGER",
                 "boolean": "INTEGER", "double": "REAL", "float": "REAL"}


@_serialized
def fixture_root(spark: SparkSession) -> str:
    """Folder for file fixtures: ``spark.shardscan.fixtureDir``; on a cluster a
    folder below the shared checkpoint folder, if that is mounted as files; in
    local mode a fresh temporary folder per application."""
    import tempfile

    from shardscan.session import checkpoint_dir

    conf = spark.conf.get("spark.shardscan.fixtureDir", None)
    if conf:
        return conf
    if not is_local(spark):
        shared = urlparse(checkpoint_dir(spark))
        if shared.scheme not in ("", "file"):
            raise RuntimeError("SQLite opens mounted files only: set spark.shardscan.fixtureDir to a folder that "
                               f"driver and executors mount (spark.checkpoint.dir is on {shared.scheme}:)")
        return os.path.join(unquote(shared.path), "shardscan-fixtures")
    key = (app_key(spark), "__root__")
    if key not in _LOADED:
        _LOADED[key] = (tempfile.mkdtemp(prefix="shardscan-fixtures-"),)
    return _LOADED[key][0]


#: Rows that one task sorts and writes for a SQLite file.
PIECE_ROWS = 500_000


@_serialized
def load_sqlite(spark: SparkSession, name: str, df: DataFrame, file_of: Column,
                table_of: Column | str, n_files: int, index_on: str | None = None) -> tuple[str, ...]:
    """Write ``df`` into ``n_files`` SQLite files (file number = ``file_of``,
    table name = ``table_of``, a column or one fixed name), the shard key ``index_on``
    indexed and the rows in its order; returns ``sqlite:`` URLs.

    Tasks write pieces of the tables, of about ``PIECE_ROWS`` rows in the key's order, each to a file of its own; one task
    per file then copies its pieces inside SQLite, in order (:func:`_merge_pieces`).  A task writes to a private file and
    renames it at the end, so a retried task never leaves half a file behind.  Rows with another file number, or none, are in no
    shard.  A DECIMAL without a fraction is stored as ``DECIMAL_TEXT``.
    """

    key = (app_key(spark), name)
    if key in _LOADED:
        return _LOADED[key]
    ship_package(spark)  # this module imports it
    spark.sparkContext.addPyFile(os.path.abspath(__file__))
    folder = os.path.join(fixture_root(spark), name)
    os.makedirs(folder, exist_ok=True)
    wide = [f.name for f in df.schema.fields if isinstance(f.dataType, DecimalType) and f.dataType.scale == 0]
    cols = [(f.name, WIDE if f.name in wide else _SQLITE_TYPES.get(f.dataType.simpleString(), "TEXT")) for f in df.schema.fields]
    names = [c for c, _ in cols]
    col_ddl = ", ".join(f'"{c}" {t}' for c, t in cols)
    marks = ", ".join("?" for _ in cols)
    table_col = F.lit(table_of) if isinstance(table_of, str) else table_of
    named = df.withColumn("_file", file_of.cast("bigint")).withColumn("_table", table_col.cast("string"))
    named = named.where(F.col("_file").between(0, n_files - 1) & F.col("_table").isNotNull())
    counts = named.groupBy("_file", "_table").count().collect()  # one small row per table
    tables = sorted((r["_file"], r["_table"]) for r in counts)

    def write(batches):
        import pyarrow as pa
        import pyarrow.compute as pc
        from pyspark import TaskContext

        open_no = conn = tmp = None
        done: list[tuple[int, str]] = []

        def close() -> None:
            conn.execute("COMMIT")
            conn.close()
            os.replace(tmp, tmp.removesuffix(".tmp"))
            done.append((open_no, tmp.removesuffix(".tmp")))

        for b in batches:
            t = pa.Table.from_batches([b])
            for no in pc.unique(t.column("_no")).to_pylist():  # in order: the partition is sorted by it
                if no != open_no:
                    if conn is not None:
                        close()
                    open_no, (conn, tmp) = no, _sqlite_file(folder)
                    conn.execute(f'CREATE TABLE "{tables[no][1]}" ({col_ddl})')
                    conn.execute("BEGIN")
                mine = t.filter(pc.equal(t.column("_no"), no)).select(names).combine_chunks()
                conn.executemany(f'INSERT INTO "{tables[no][1]}" VALUES ({marks})', zip(*[_sqlite_values(c.chunk(0)) for c in mine.columns]))
        if conn is not None:
            close()
        at = TaskContext.get().partitionId()
        yield pa.RecordBatch.from_arrays([pa.array([n for n, _ in done], pa.int64()), pa.array([at] * len(done), pa.int64()),
                                          pa.array([p for _, p in done], pa.string())], names=["no", "piece", "path"])

    pieces: list[tuple[int, int, str]] = []
    if tables:
        n_pieces = max(len(tables), -(-sum(r["count"] for r in counts) // PIECE_ROWS))
        numbers = spark.createDataFrame([(i, t, no) for no, (i, t) in enumerate(tables)], "_file bigint, _table string, _no int")
        sorted_by = ["_no", index_on] if index_on else ["_no"]
        texts = [_wide_text(F.col(c)).alias(c) if c in wide else F.col(c) for c in names]
        dealt = (named.join(F.broadcast(numbers), ["_file", "_table"]).select("_no", *texts)
                 .repartitionByRange(n_pieces, *sorted_by).sortWithinPartitions(*sorted_by))
        pieces = sorted(map(tuple, dealt.mapInArrow(write, "no bigint, piece bigint, path string").collect()))  # one small row per piece
    parts = {i: [(tables[no][1], p) for no, _, p in pieces if tables[no][0] == i] for i in range(n_files)}

    load = uuid.uuid4().hex

    def merge(batches):
        for b in batches:
            for i in b.column("id").to_pylist():
                tmp = os.path.join(folder, f"{load}.{i}.tmp")
                _merge_pieces(tmp, parts[i], col_ddl, index_on)
                os.replace(tmp, os.path.join(folder, f"part_{i}.db"))
            yield b

    if pieces:
        filled = F.col("id").isin([i for i, p in parts.items() if p])
        spark.range(n_files, numPartitions=n_files).where(filled).mapInArrow(merge, "id bigint").collect()
    for i in range(n_files):  # files that got no rows still exist
        path = os.path.join(folder, f"part_{i}.db")
        if not os.path.exists(path):
            import sqlite3

            sqlite3.connect(path).close()
    urls = tuple(f"sqlite://{os.path.join(folder, f'part_{i}.db')}" for i in range(n_files))
    _LOADED[key] = urls
    return urls


def _merge_pieces(target: str, pieces: Sequence[tuple[str, str]], ddl: str, index_on: str | None) -> None:
    """Copy the pieces ``(table, path)`` into the database file ``target``, in order, and remove each once it is in: at no time is
    there room taken for all rows twice.  ``target`` notes what it holds, so that a retried task goes on where the first one stopped."""
    import sqlite3

    with contextlib.closing(sqlite3.connect(target, isolation_level=None, timeout=60)) as c:
        c.execute("PRAGMA synchronous = OFF")  # with its journal, a task that is killed still leaves what it committed
        c.execute("CREATE TABLE IF NOT EXISTS _merged (path TEXT)")
        held = {path for path, in c.execute("SELECT path FROM _merged").fetchall()}
        for table, path in pieces:
            if path not in held:
                c.execute("ATTACH ? AS piece", (path,))
                c.execute("BEGIN")
                c.execute(f'CREATE TABLE IF NOT EXISTS main."{table}" ({ddl})')
                c.execute(f'INSERT INTO main."{table}" SELECT * FROM piece."{table}"')
                c.execute("INSERT INTO _merged VALUES (?)", (path,))
                c.execute("COMMIT")
                c.execute("DETACH piece")
            with contextlib.suppress(FileNotFoundError):
                os.remove(path)
        for table in dict.fromkeys(table for table, _ in pieces):
            if index_on:
                c.execute(f'CREATE INDEX IF NOT EXISTS "IX_{table}" ON "{table}" ("{index_on}")')
        c.execute("DROP TABLE _merged")


def _sqlite_file(folder: str) -> tuple:
    """A private database file that is renamed when it is whole (so it needs no journal), and its name."""
    import sqlite3

    tmp = os.path.join(folder, f"{uuid.uuid4().hex}.tmp")
    conn = sqlite3.connect(tmp, isolation_level=None)
    for pragma in ("journal_mode = OFF", "synchronous = OFF", "locking_mode = EXCLUSIVE"):
        conn.execute(f"PRAGMA {pragma}")
    return conn, tmp


def _sqlite_values(column) -> list:
    """An Arrow column as values that SQLite takes; each value of text or time is converted once a batch."""
    import pyarrow as pa

    kind = column.type
    if pa.types.is_integer(kind) or pa.types.is_floating(kind):
        return column.to_pylist() if column.null_count else column.to_numpy(zero_copy_only=False).tolist()
    if not (pa.types.is_string(kind) or pa.types.is_large_string(kind) or pa.types.is_temporal(kind)):
        return [_sqlite_value(v) for v in column.to_pylist()]
    coded = column.dictionary_encode()
    values = [_sqlite_value(v) for v in coded.dictionary.to_pylist()]
    if coded.null_count:
        return [None if i is None else values[i] for i in coded.indices.to_pylist()]
    return [values[i] for i in coded.indices.to_numpy(zero_copy_only=False).tolist()]


def _wide_text(c: Column) -> Column:
    """An integer of up to 37 digits as ``DECIMAL_TEXT`` (see ``shardscan.sources.dialects``)."""
    shift = F.lit(str(WIDE_SHIFT)).cast("decimal(38,0)")
    number = c.cast("decimal(38,0)")
    text = F.lpad((number + shift).cast("string"), 38, "0")
    return F.when(number >= -shift, text).when(number.isNotNull(), F.raise_error(F.lit("a key of more than 37 digits")))


def _sqlite_value(v):
    import datetime

    if isinstance(v, (datetime.datetime, datetime.date)):
        return v.isoformat(sep=" ") if isinstance(v, datetime.datetime) else v.isoformat()
    return v


def customer_sqlite(spark: SparkSession, sf_dir: str) -> tuple[str, ...]:
    """customer in two SQLite files by ``c_custkey % 2``, table ``CUSTOMER``."""
    src = parquet(spark, sf_dir, "customer")
    return load_sqlite(spark, f"ss_{sf_tag(sf_dir)}_customer_sqlite", src, F.col("c_custkey") % 2,
                       "CUSTOMER", 2, index_on="c_custkey")


def orders_sqlite(spark: SparkSession, sf_dir: str) -> tuple[str, ...]:
    """orders in two SQLite files by ``o_orderkey % 2``, tables ``ORDERS_{o_orderkey % 4}``."""
    src = parquet(spark, sf_dir, "orders")
    k = F.col("o_orderkey")
    return load_sqlite(spark, f"ss_{sf_tag(sf_dir)}_orders_sqlite", src, k % 2,
                       F.concat(F.lit("ORDERS_"), (k % 4).cast("string")), 2, index_on="o_orderkey")


def cube(k: Column) -> Column:
    """``k`` to the power of three, exact: a BIGINT holds it up to 2,097,151 only."""
    k = k.cast("decimal(20,0)")
    return k * k * k


def orders_sparse_sqlite(spark: SparkSession, sf_dir: str) -> tuple[str, ...]:
    """orders as in :func:`orders_sqlite` plus ``sparse_key``, the cube of the key: equal-width ranges of it are very uneven."""
    src = parquet(spark, sf_dir, "orders")
    k = F.col("o_orderkey")
    return load_sqlite(spark, f"ss_{sf_tag(sf_dir)}_orders_sparse", src.withColumn("sparse_key", cube(k)), k % 2,
                       F.concat(F.lit("ORDERS_"), (k % 4).cast("string")), 2, index_on="sparse_key")


def lineitem_tables_sqlite(spark: SparkSession, sf_dir: str) -> tuple[str, ...]:
    """lineitem in three SQLite files, tables ``LINEITEM_{l_orderkey % 4}`` (file: that number modulo 3): cut by the key of
    orders, but on other servers."""
    src = parquet(spark, sf_dir, "lineitem")
    shard = F.col("l_orderkey") % 4
    return load_sqlite(spark, f"ss_{sf_tag(sf_dir)}_lineitem_tables", src, shard % 3,
                       F.concat(F.lit("LINEITEM_"), shard.cast("string")), 3, index_on="l_orderkey")


def orders_changed(df: DataFrame) -> DataFrame:
    """orders with planted differences: every 97th price changed, every 101st order missing, every 103rd there twice."""
    k = F.col("o_orderkey")
    price = F.when(k % 97 == 0, F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice"))
    kept = df.where(k % 101 != 5).withColumn("o_totalprice", price)
    return kept.unionByName(kept.where(k % 103 == 0))


def orders_copy_sqlite(spark: SparkSession, sf_dir: str, changed: bool) -> tuple[str, ...]:
    """A copy of orders sharded in another way: three files, tables ``COPY_{o_orderkey % 5}``; with planted differences or without."""
    src = parquet(spark, sf_dir, "orders")
    shard = F.col("o_orderkey") % 5
    return load_sqlite(spark, f"ss_{sf_tag(sf_dir)}_orders_copy_{int(changed)}", orders_changed(src) if changed else src, shard % 3,
                       F.concat(F.lit("COPY_"), shard.cast("string")), 3, index_on="o_orderkey")


def orders_shard_keys(spark: SparkSession, sf_dir: str, key: Column, name: str = "key") -> DataFrame:
    """The live keys of the SQLite shards of orders, from the parquet file: ``url_no, schema_name, table_name`` and the key."""
    k = F.col("o_orderkey")
    return parquet(spark, sf_dir, "orders").select(
        (k % 2).cast("int").alias("url_no"), F.lit("main").alias("schema_name"),
        F.concat(F.lit("ORDERS_"), (k % 4).cast("string")).alias("table_name"), key.alias(name))


def events_sqlite_many(spark: SparkSession, sf_dir: str, n_tables: int) -> tuple[str, ...]:
    """events in ``n_tables`` SQLite tables ``EV_{event_id % n_tables}`` over 2 files."""
    src = parquet(spark, sf_dir, "events")
    k = F.col("event_id") % n_tables
    return load_sqlite(spark, f"ss_{sf_tag(sf_dir)}_events_sqlite_{n_tables}", src, k % 2,
                       F.concat(F.lit("EV_"), k.cast("string")), 2, index_on="event_id")


def derby_ddl(spark: SparkSession, url: str, *statements: str, ignore_errors: bool = False) -> None:
    """Run statements on an embedded Derby database (fixture setup only;
    goes through the JVM gateway of a classic session)."""
    conn = spark.sparkContext._jvm.java.sql.DriverManager.getConnection(url)
    try:
        st = conn.createStatement()
        for s in statements:
            try:
                st.execute(s)
            except Exception:
                if not ignore_errors:
                    raise
        st.close()
    finally:
        conn.close()


@_serialized
def events_many_shards(spark: SparkSession, sf_dir: str, n_tables: int) -> tuple[str, ...]:
    """events in ``n_tables`` tables ``APP.EV_{event_id % n_tables}`` on 2 servers
    (table k on server k % 2), for plan-size tests.  Rows are copied inside
    Derby from one staging table per server."""
    name = f"ss_{sf_tag(sf_dir)}_events_{n_tables}"
    key = (app_key(spark), name)
    if key in _LOADED:
        return _LOADED[key]
    src = parquet(spark, sf_dir, "events")
    if not is_local(spark):
        return load_derby(spark, name, src, [
            ShardSpec(k % 2, "APP", f"EV_{k}", F.col("event_id") % n_tables == k) for k in range(n_tables)],
            index_on="event_id")
    staged = load_derby(spark, name, src, [ShardSpec(i, "APP", "EV_STAGE", F.col("event_id") % 2 == i)
                                           for i in range(2)])
    for i in range(2):
        # a new application in the same JVM finds the tables of an earlier one
        derby_ddl(spark, derby_url(f"{name}_{i}"),
                  *[f"DROP TABLE APP.EV_{k}" for k in range(i, n_tables, 2)], ignore_errors=True)
        stmts = []
        for k in range(i, n_tables, 2):
            stmts.append(f"CREATE TABLE APP.EV_{k} AS SELECT * FROM APP.EV_STAGE WITH NO DATA")
            stmts.append(f'INSERT INTO APP.EV_{k} SELECT * FROM APP.EV_STAGE WHERE MOD("event_id", {n_tables}) = {k}')
            stmts.append(f'CREATE INDEX APP.IX_EV_{k} ON APP.EV_{k} ("event_id")')
        stmts.append("DROP TABLE APP.EV_STAGE")
        derby_ddl(spark, derby_url(f"{name}_{i}"), *stmts)
    _LOADED[key] = staged
    return staged


def lineitem_sqlite(spark: SparkSession, sf_dir: str) -> tuple[str, ...]:
    """lineitem in four SQLite files by ``l_orderkey % 4``, table ``LINEITEM``."""
    src = parquet(spark, sf_dir, "lineitem")
    return load_sqlite(spark, f"ss_{sf_tag(sf_dir)}_lineitem_sqlite", src, F.col("l_orderkey") % 4,
                       "LINEITEM", 4, index_on="l_orderkey")
