"""Flat backend: the sharded scan as one Python data source, ``sharded_dbapi``.

Where the JDBC backend builds one Spark relation per shard, this backend is
a single ``BatchScan`` however many shards there are: ``partitions()`` does
discovery, probes and the split rule once, on the driver side, and returns
one input partition per split; each task opens its own DB-API connection,
runs one range query over a server-side cursor and streams the rows back as Arrow
record batches.

Use it past a few hundred shards (plan size), or for databases reached
through a Python driver.  ``scan.splits-per-task`` (default 1) lets one task
read several consecutive splits of one server over one connection, the way
a reader pulls split after split; with many tiny shards it saves most of the
per-task cost.  Built in: ``sqlite:`` URLs (``sqlite:///path.db``),
opened read-only; integers beyond 64 bits are columns declared ``DECIMAL_TEXT`` there
(:mod:`shardscan.sources.dialects`; of tables and views, not of ``scan.query``).  ``mysql://`` and ``postgresql://`` URLs need ``pymysql`` /
``psycopg2`` on the executors (imported only when used).

Differences from the JDBC backend: every declared column is fetched and user filters
are applied by Spark after the read, so declare only the columns you need and put
equality filters into ``scan.conditions`` (bound as parameters); with filters or few columns of
many, prefer the JDBC backend.  Names are matched with Python's ``re`` in its
ASCII mode; regex syntax that Java reads differently is refused.  Filter pushdown is
deliberately not implemented: on PySpark 4.1.2 the input partitions planned for a filtered query are used again
by a later query on the same DataFrame, whether the filter is kept in the reader or in the partitions
(a ``count()`` after a filtered ``collect()`` returned 1 row of 3).  :func:`shardscan.sources.stored.read_split_plan`
takes columns and filters of its own.
Options of JDBC drivers (``driver``) are refused; ``scan.session-init-statement`` runs on every
connection, ``scan.query-timeout`` is set on MySQL and PostgreSQL and refused for SQLite.
A declared ``TIMESTAMP`` reads zoneless values in the zone of the session that registered
the source.

SQL::

    CREATE TEMPORARY VIEW customer_v (c_custkey BIGINT, c_name STRING)
    USING sharded_dbapi OPTIONS (url 'sqlite:///a.db;sqlite:///b.db',
      `table-name` 'CUSTOMER.*', `schema-name` 'main',
      `scan.partition.column` 'c_custkey', `scan.batch.size` '1000')
"""

from __future__ import annotations

import contextlib
import re
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from hashlib import md5
from typing import Any
from urllib.parse import unquote, urlparse

from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import StructType

from shardscan.options import ScanOptions, redacted_errors
from shardscan.plans.filters import pushed
from shardscan.plans.rule import split_count, split_ranges
from shardscan.sources.dialects import MYSQL, POSTGRES, SQLITE, WIDE, salt_predicate, wide_number, wide_text

NAME = "sharded_dbapi"
PROBE_CONNECTIONS = 4  # per server, while planning
# syntax that Java's and Python's regular expressions do not share, or read differently
_NOT_SHARED = re.compile(r"\\[pPQEhHRXGzZekNvVcx0]|\(\?<[A-Za-z]|\(\?P|&&|\[[^\]]*\[|\(\?[a-zA-Z-]*[uULdmx]")


def _kind(url: str) -> str:
    u = url.lower()
    if u.startswith("sqlite:"):
        return "sqlite"
    if u.startswith("mysql:") or u.startswith("mariadb:"):
        return "mysql"
    if u.startswith("postgresql:") or u.startswith("postgres:"):
        return "postgresql"
    raise ValueError(f"unsupported DB-API URL scheme: {url.split(':', 1)[0]}:")


_DIALECTS = {"sqlite": SQLITE, "mysql": MYSQL, "postgresql": POSTGRES}


def _quote(kind: str, ident: str) -> str:
    return _DIALECTS[kind].quote(ident)


def full_match(regex: str, name: str) -> bool:
    return re.fullmatch(regex, name, re.ASCII) is not None


def check_regex(option: str, regex: str) -> None:
    m = _NOT_SHARED.search(regex)
    if m:
        raise ValueError(f"'{option}': {m.group()!r} is not in the syntax Java and Python share; "
                         "use the JDBC backend for it")
    re.compile(regex)


def open_session(url: str, o: ScanOptions):
    """A connection with the session options applied."""
    kind = _kind(url)
    conn = connect(url, o.username, o.password)
    statements = []
    if o.query_timeout:
        statements.append(f"SET SESSION MAX_EXECUTION_TIME = {o.query_timeout * 1000}" if kind == "mysql"
                          else f"SET statement_timeout = {o.query_timeout * 1000}")
    if o.session_init_statement:
        statements.append(o.session_init_statement)
    for sql in statements:
        cur = conn.cursor()
        cur.execute(sql)
        cur.close()
    return conn


def prepare_hash(conn, kind: str) -> None:
    """Give a SQLite connection the row hash that the other engines have built in."""
    if kind == "sqlite":
        conn.create_function("shardscan_row_hash", -1, _row_hash, deterministic=True)


def _row_hash(*values) -> int:
    texts = ["-" if v is None else f"{len(t := str(v))}:{t}" for v in values]
    return int.from_bytes(md5("|".join(texts).encode()).digest()[:8], "big") >> 4  # its first 15 hexadecimal digits


def stream_cursor(conn, kind: str, batch: int):
    """A cursor that leaves the result on the server and hands it out by ``batch`` rows."""
    if kind == "mysql":
        from pymysql.cursors import SSCursor  # type: ignore

        return conn.cursor(SSCursor)
    if kind == "postgresql":
        cur = conn.cursor(name="shardscan_split")
        cur.itersize = batch
        return cur
    return conn.cursor()  # sqlite3 steps through the result


def connect(url: str, username: str | None = None, password: str | None = None):
    kind = _kind(url)
    if kind == "sqlite":
        import sqlite3

        path = url[len("sqlite:"):]
        if path.startswith("///"):
            path = path[2:]
        elif path.startswith("//"):
            path = path[2:]
        conn = sqlite3.connect(f"file:{path}?mode=ro", uri=True, check_same_thread=False)
        conn.create_function("shardscan_number", 1, lambda t: None if t is None else str(wide_number(t)), deterministic=True)
        return conn
    p = urlparse(url)
    kw: dict[str, Any] = {"host": p.hostname, "user": username or (unquote(p.username) if p.username else None),
                          "password": password or (unquote(p.password) if p.password else None)}
    if p.port:
        kw["port"] = p.port
    db = p.path.lstrip("/") or None
    if kind == "mysql":
        try:
            import pymysql  # type: ignore
        except ImportError as e:  # pragma: no cover - optional driver
            raise ImportError("mysql:// URLs need the 'pymysql' package on every executor") from e
        return pymysql.connect(database=db, **{k: v for k, v in kw.items() if v is not None})
    try:
        import psycopg2  # type: ignore
    except ImportError as e:  # pragma: no cover - optional driver
        raise ImportError("postgresql:// URLs need the 'psycopg2' package on every executor") from e
    return psycopg2.connect(dbname=db, **{k: v for k, v in kw.items() if v is not None})


@dataclass(frozen=True)
class Split:
    split_id: int
    url_no: int
    schema: str | None
    table: str
    columns: tuple[str, ...]  # actual names, in declared order
    key: str                  # actual key name
    lo: int | None            # None, None = the IS NULL split
    hi: int | None
    bucket: int | None = None  # salt bucket, when salted
    salt: str | None = None    # actual salt column name


@dataclass(frozen=True)
class Task(InputPartition):
    """One Spark task: consecutive splits of one server, read over one connection."""

    url_no: int
    splits: tuple[Split, ...]


class ShardedDbapiReader(DataSourceReader):
    def __init__(self, schema: StructType, options: dict[str, str] | ScanOptions, zone: str = "UTC"):
        self.schema = schema
        self.zone = zone
        self.filters: tuple = ()  # of a stored plan's reader; Spark's own pushdown stays off (see above)
        if isinstance(options, ScanOptions):
            self.opts = options
        else:
            self.opts = ScanOptions.from_map({k: v for k, v in options.items() if k.lower() not in ("path",)})
        if self.opts.provenance:
            raise ValueError("scan.provenance is a JDBC-backend option (sharded_scan)")
        if self.opts.max_parallel_reads is not None:
            raise ValueError("use scan.splits-per-task with sharded_dbapi; "
                             "scan.max-parallel-reads is a JDBC-backend option")
        if self.opts.driver:
            raise ValueError("option 'driver' names a JDBC driver; sharded_dbapi picks its driver by URL")
        if self.opts.query_timeout and any(_kind(u) == "sqlite" for u in self.opts.urls):
            raise ValueError("'scan.query-timeout' has no counterpart in SQLite")
        check_regex("schema-name", self.opts.schema_name)
        check_regex("table-name", self.opts.table_name)

    # ------------------------------------------------------------ planning
    def _discover(self, url_no: int, url: str, conn) -> list[tuple[str | None, str, tuple[str, ...]]]:
        cur = conn.cursor()
        cur.execute(_DIALECTS[_kind(url)].catalog(self.opts.schema_name, self.opts.table_name))
        tables: dict[tuple, list[tuple[int, str]]] = {}
        kinds: dict[tuple, str] = {}
        while rows := cur.fetchmany(10_000):
            for schema_name, table_name, ttype, col, ordinal in rows:
                if not (full_match(self.opts.schema_name, str(schema_name))
                        and full_match(self.opts.table_name, str(table_name))):
                    continue
                cols = tables.setdefault((schema_name, table_name), [])
                if col is not None:
                    cols.append((ordinal, col))
                kinds[(schema_name, table_name)] = str(ttype).strip().upper()
        out = []
        for (s, t), cols in sorted(tables.items()):
            if self.opts.table_types and kinds[(s, t)] not in self.opts.table_types:
                continue
            out.append((s, t, tuple(c for _, c in sorted(cols))))
        return out

    @staticmethod
    def _resolve(cols: Sequence[str], name: str) -> str | None:
        if name in cols:
            return name
        hits = [c for c in cols if c.lower() == name.lower()]
        return hits[0] if len(hits) == 1 else None

    def _source(self, kind: str, schema_name: str | None, table: str | None) -> str:
        q = self.opts.query
        if q and table is None:
            return f"({q}) q"
        if q:
            return "(" + q.replace("{table}", self._from(kind, schema_name, table)) + ") q"
        return self._from(kind, schema_name, table)

    @staticmethod
    def wide_columns(conn, kind: str, table: str | None) -> frozenset[str]:
        """The columns of a SQLite table that hold integers beyond 64 bits, as text."""
        if kind != "sqlite" or table is None:
            return frozenset()
        cur = conn.cursor()
        cur.execute("SELECT name FROM pragma_table_info(?) WHERE type = ?", (table, WIDE))
        return frozenset(name for name, in cur.fetchall())

    def _probe(self, conn, kind: str, src: str, qk: str, wide: bool = False) -> tuple:
        """``MIN``, ``MAX`` (each its own subquery, so an index answers them),
        ``COUNT(*)`` only in batch-size mode, NULL-key count only with keep."""
        o = self.opts
        text = key_literal(wide)
        cond = f"{qk} BETWEEN {text(o.lower_bound)} AND {text(o.upper_bound)}" if o.explicit_bounds else ""

        def sub(expr: str, where: str = cond) -> str:
            return f"(SELECT {expr} FROM {src}" + (f" WHERE {where}" if where else "") + ")"

        n = sub("COUNT(*)") if o.batch_size is not None else "NULL"
        # NULL keys lie outside any declared bounds: counted without them
        nn = sub("COUNT(*)", f"{qk} IS NULL") if o.null_key == "keep" else "NULL"
        cur = conn.cursor()
        cur.execute(f"SELECT {sub(f'MIN({qk})')}, {sub(f'MAX({qk})')}, {n}, {nn}")
        mn, mx, n, nn = cur.fetchone()
        return (wide_number(mn), wide_number(mx), n, nn) if wide else (mn, mx, n, nn)

    def probe(self, conn, kind: str, schema_name: str | None, table: str | None, key: str) -> tuple:
        """``MIN, MAX, COUNT, NULL keys`` of one table, as integers (:meth:`_probe`)."""
        wide = key in self.wide_columns(conn, kind, None if self.opts.query else table)
        return self._probe(conn, kind, self._source(kind, schema_name, table), _quote(kind, key), wide)

    def shards_of(self, url_no: int, url: str) -> list[tuple]:
        """``(schema, table, actual declared columns, key, salt, missing)`` of one server's matched tables."""
        o = self.opts
        with contextlib.closing(open_session(url, o)) as conn:
            if o.query and "{table}" not in o.query:
                shards = [(None, None, tuple(f.name for f in self.schema.fields) + (o.partition_column,))]
            else:
                shards = self._discover(url_no, url, conn)
        found = []
        for schema_name, table, cols in shards:
            wanted = [(f.name, self._resolve(cols, f.name)) for f in self.schema.fields]
            key = o.partition_column if o.query else self._resolve(cols, o.partition_column)
            salt = None
            if o.salt_column:
                salt = o.salt_column if o.query else self._resolve(cols, o.salt_column)
            missing = [n for n, a in [*wanted, (o.partition_column, key)] if a is None]
            if o.salt_column and salt is None:
                missing.append(o.salt_column)
            found.append((schema_name, table, tuple(a for _, a in wanted), key, salt, tuple(missing)))
        return found

    def _plan_server(self, url_no: int, url: str) -> tuple[list[Split], list[Split]]:
        """Range splits and NULL-key splits of one server (ids assigned later)."""
        o = self.opts
        mode = {"batch_size": o.batch_size, "partition_num": o.partition_num}
        kind = _kind(url)
        planned = []
        for schema_name, table, declared, key, salt, missing in self.shards_of(url_no, url):
            if missing:
                raise ValueError(lacks(url_no, schema_name, table, missing))
            planned.append((schema_name, table, declared, key, salt))
        if o.explicit_bounds and o.partition_num is not None:
            stats = [(o.lower_bound, o.upper_bound, None, None)] * len(planned)
        else:
            stats = self._probe_all(url, kind, [(p[0], p[1], p[3]) for p in planned])
        ranges: list[Split] = []
        nulls: list[Split] = []
        for (schema_name, table, declared, key, salt), (mn, mx, n, n_null) in zip(planned, stats):
            mn, mx = (None if v is None else int(v) for v in (mn, mx))
            o.check_split_count(len(ranges) + split_count(mn, mx, n, **mode) * o.salt_buckets)
            # saturate the last range at BIGINT's maximum (or at a wider key's own
            # maximum), and at the declared upper bound when there is one
            top = max(2**63 - 1, mx or 0)
            if o.explicit_bounds:
                top = min(top, o.upper_bound)
            for lo, hi in split_ranges(mn, mx, n, top=top, **mode):
                if o.key_ranges and not o.key_ranges.hits(lo, hi):
                    continue
                for b in o.buckets:
                    ranges.append(Split(-1, url_no, schema_name, table, declared, key, lo, hi, b, salt))
            if o.null_key == "keep" and (n_null is None or n_null > 0):
                for b in o.buckets:
                    nulls.append(Split(-1, url_no, schema_name, table, declared, key, None, None, b, salt))
        return ranges, nulls

    def _probe_all(self, url: str, kind: str, items: list[tuple[str | None, str | None, str]]) -> list[tuple]:
        """Probe many tables of one server over a few connections at once
        (a row count scans its table: several run side by side)."""
        import threading
        from concurrent.futures import ThreadPoolExecutor

        o = self.opts
        local = threading.local()
        opened = []
        lock = threading.Lock()

        def one(item: tuple[str | None, str | None, str]) -> tuple:
            c = getattr(local, "conn", None)
            if c is None:
                c = local.conn = open_session(url, o)
                with lock:
                    opened.append(c)
            return self.probe(c, kind, *item)

        try:
            with ThreadPoolExecutor(max(1, min(PROBE_CONNECTIONS, len(items)))) as pool:
                return list(pool.map(one, items))
        finally:
            for c in opened:
                c.close()

    def partitions(self) -> list[Task]:
        """Discovery and probes of all servers, each in its own thread (DB-API
        drivers wait on I/O outside the GIL); ids follow server order."""
        from concurrent.futures import ThreadPoolExecutor
        from dataclasses import replace

        o = self.opts
        with redacted_errors("shard planning", (o.password,)), \
                ThreadPoolExecutor(max(1, min(8, len(o.urls)))) as pool:
            per_server = list(pool.map(lambda a: self._plan_server(*a), enumerate(o.urls)))
        ordered = [s for ranges, _ in per_server for s in ranges]
        ordered += [s for _, nulls in per_server for s in nulls]
        o.check_split_count(len(ordered))
        splits = [replace(s, split_id=i) for i, s in enumerate(ordered)]
        return pack(splits, o.splits_per_task)

    @staticmethod
    def _from(kind: str, schema_name: str | None, table: str) -> str:
        if kind == "sqlite" or not schema_name:
            return _quote(kind, table)
        return f"{_quote(kind, schema_name)}.{_quote(kind, table)}"

    # ------------------------------------------------------------ reading
    def _statement(self, kind: str, s: Split, wide: frozenset[str] = frozenset()) -> tuple[str, list]:
        """SQL text of a split and the parameters of its equality conditions; ``wide`` columns are ``DECIMAL_TEXT``."""
        from shardscan.sources.jdbc import typed_value

        mark = "?" if kind == "sqlite" else "%s"
        cols = ", ".join(f"shardscan_number({_quote(kind, c)})" if c in wide else _quote(kind, c) for c in s.columns)
        qk = _quote(kind, s.key)
        text_of = key_literal(s.key in wide)

        def param(column: str, v: Any) -> Any:
            if column in wide:
                return wide_text(v)
            return _sqlite_param(v) if kind == "sqlite" else v

        cond = [f"{qk} IS NULL" if s.lo is None else f"{qk} BETWEEN {text_of(s.lo)} AND {text_of(s.hi)}"]
        wanted = self.opts.key_ranges
        if wanted and s.lo is not None and wanted.hits(s.lo, s.hi) != [(s.lo, s.hi)]:
            cond.append(wanted.sql(qk, s.lo, s.hi, text_of))
        if s.bucket is not None:
            cond.append(salt_predicate(_quote(kind, s.salt), self.opts.salt_buckets, s.bucket))
        text = f"SELECT {cols} FROM {self._source(kind, s.schema, s.table)} WHERE " + " AND ".join(cond)
        by_decl = {f.name.lower(): a for f, a in zip(self.schema.fields, s.columns)}
        params = []
        if (self.opts.conditions or self.filters) and mark == "%s":
            text = text.replace("%", "%%")
        for name, value in self.opts.conditions:  # declared equality conditions
            actual = by_decl.get(name.lower(), name)
            column, value = _quote(kind, actual), typed_value(value, self.schema, name)
            if value is None:
                text += f" AND {column} IS NULL"
            else:
                text += f" AND {column} = {mark}"
                params.append(param(actual, value))
        for name, op, value in pushed(self.filters, self.schema, kind):
            column = _quote(kind, by_decl[name.lower()])
            values = list(value) if op == "in" else [] if op.startswith("is") else [value]
            marks = f" ({', '.join([mark] * len(values))})" if op == "in" else f" {mark}" if values else ""
            text += f" AND {column} {op.upper()}{marks}"
            params += [param(by_decl[name.lower()], v) for v in values]
        return text, params

    def read(self, partition: Task) -> Iterator[Any]:
        if partition is None:  # no split at all: Spark runs one task without a partition
            return
        with redacted_errors(f"reading server {partition.url_no}", (self.opts.password,)):
            conn = open_session(self.opts.urls[partition.url_no], self.opts)
        try:
            yield from self.read_over(conn, partition)
        finally:
            conn.close()

    def read_over(self, conn, partition: Task) -> Iterator[Any]:
        """:meth:`read` over an open connection to the server."""
        import pyarrow as pa
        from pyspark.sql.pandas.types import to_arrow_schema

        o = self.opts
        kind = _kind(o.urls[partition.url_no])
        arrow_schema = to_arrow_schema(self.schema)
        batch = o.fetch_size if o.fetch_size and o.fetch_size > 0 else 10_000
        held: list = []  # rows of small splits share a batch
        wide: dict[str | None, frozenset[str]] = {}

        def out():
            with redacted_errors(f"reading server {partition.url_no}", (o.password,)):
                arrays = [to_arrow(list(c), f.type, self.zone) for c, f in zip(zip(*held), arrow_schema)]
            held.clear()
            return pa.RecordBatch.from_arrays(arrays, schema=arrow_schema)

        for split in partition.splits:
            rows = None
            while rows is None or rows:
                with redacted_errors(f"split {split.split_id} of server {partition.url_no}", (o.password,)):
                    if rows is None:
                        if split.table not in wide:
                            wide[split.table] = self.wide_columns(conn, kind, None if o.query else split.table)
                        cur = stream_cursor(conn, kind, batch)
                        text, params = self._statement(kind, split, wide[split.table])
                        cur.execute(text, params) if params else cur.execute(text)
                    rows = cur.fetchmany(batch)
                held += rows
                if len(held) >= batch:
                    yield out()
            cur.close()
        if held:
            yield out()


def key_literal(wide: bool) -> Callable[[int], str]:
    """SQL text of a key value."""
    return (lambda v: f"'{wide_text(v)}'") if wide else str


def key_part(kind: str, key: str, lo: int, hi: int, width: int, wide: frozenset[str]) -> str:
    """SQL text: the number of the part of ``[lo, hi]``, cut into parts of ``width`` keys, that a key lies in."""
    d = _DIALECTS[kind]
    qk = d.quote(key)
    if key not in wide:
        return d.int_div(f"{qk} - {lo}", str(width))
    text = key_literal(True)
    parts = "".join(f" WHEN {qk} < {text(a)} THEN {i}" for i, a in enumerate(range(lo + width, hi + 1, width)))
    last = (hi - lo) // width
    return f"CASE{parts} ELSE {last} END" if parts else "0"


def _sqlite_param(v: Any) -> Any:
    """SQLite stores dates and decimals as text or numbers."""
    import datetime
    import decimal

    if isinstance(v, datetime.datetime):
        return v.isoformat(sep=" ")
    if isinstance(v, datetime.date):
        return v.isoformat()
    return float(v) if isinstance(v, decimal.Decimal) else v


def to_arrow(values: list, typ, zone: str = "UTC"):
    """A driver's column as an Arrow array of the declared type; lossy conversions raise ``ValueError``.

    Values that already have the declared type go straight to Arrow.  Otherwise the
    column is inferred, text is parsed and the rest is cast, each as one Arrow call."""
    import decimal

    import pyarrow as pa
    import pyarrow.compute as pc

    t = pa.types
    try:
        if t.is_timestamp(typ):
            return _timestamps(values, typ, zone)
        if t.is_decimal(typ):
            return pa.array([None if v is None else decimal.Decimal(str(v)) for v in values]).cast(typ)
        if t.is_boolean(typ):
            known = pa.array(values) if values else pa.array([], pa.bool_())
            if t.is_integer(known.type):
                if pc.any(pc.invert(pc.is_in(known, value_set=pa.array([0, 1, None], known.type)))).as_py():
                    raise ValueError("a boolean is neither 0 nor 1")
                return pc.cast(known, pa.bool_())
            return pc.cast(known, typ)  # text: true, false, 1, 0; anything else raises
        if t.is_string(typ) or t.is_large_string(typ):
            try:
                return pa.array(values, type=typ)
            except (pa.ArrowInvalid, pa.ArrowTypeError):  # a dynamically typed store: numbers as text
                return pa.array([None if v is None else str(v) for v in values], type=typ)
        try:
            known = pa.array(values, from_pandas=False)
        except (pa.ArrowInvalid, pa.ArrowTypeError):  # numbers and text mixed
            known = pa.array([None if v is None else str(v) for v in values])
        return known if known.type == typ else pc.cast(known, typ, safe=True)
    except (pa.ArrowInvalid, pa.ArrowTypeError, pa.ArrowNotImplementedError, decimal.InvalidOperation) as e:
        raise ValueError(f"a value does not fit the declared type {typ}: {e}") from None


def _timestamps(values: list, typ, zone: str):
    """Timestamps from datetimes or text.  Zoneless values of a zoned type are read in ``zone``."""
    import pyarrow as pa
    import pyarrow.compute as pc

    if not any(isinstance(v, str) for v in values):
        if typ.tz is None or any(v is not None and v.tzinfo is not None for v in values):
            return pa.array(values, type=typ)
        plain = pa.array(values, type=pa.timestamp("us"))
    else:
        text = pa.array([None if v is None else str(v) for v in values], pa.string())
        zoned = pc.match_substring_regex(text, r"\d(Z|[+-]\d\d:?\d\d)$")
        if pc.any(zoned).as_py():
            if typ.tz is None or not pc.all(zoned).as_py():
                raise ValueError("timestamps with and without a zone")
            return pc.cast(pc.cast(text, pa.timestamp("us", tz="UTC")), typ)
        plain = pc.cast(text, pa.timestamp("us"))
    if typ.tz is None:
        return pc.cast(plain, typ)
    return pc.cast(pc.assume_timezone(plain, zone, ambiguous="earliest", nonexistent="latest"), typ)


def lacks(url_no: int, schema_name: str | None, table: str | None, missing: Sequence[str]) -> str:
    return f"server {url_no} {schema_name}.{table} lacks declared column(s) {list(missing)}"


def pack(splits: list[Split], per_task: int) -> list[Task]:
    """Group consecutive splits of the same server, ``per_task`` to a task
    (the plan's splits are unchanged; only the task they run in)."""
    tasks: list[Task] = []
    cur: list[Split] = []
    for s in splits:
        if cur and (len(cur) == per_task or cur[0].url_no != s.url_no):
            tasks.append(Task(cur[0].url_no, tuple(cur)))
            cur = []
        cur.append(s)
    if cur:
        tasks.append(Task(cur[0].url_no, tuple(cur)))
    return tasks


class ShardedDbapiSource(DataSource):
    """``spark.read.format("sharded_dbapi")`` / ``USING sharded_dbapi``."""

    @classmethod
    def name(cls) -> str:
        return NAME

    def schema(self) -> StructType | str:
        ddl = self.options.get("schema")
        if not ddl:
            raise ValueError("declare the schema: .schema(...), a column list in the DDL, or option 'schema'")
        return ddl

    def reader(self, schema: StructType) -> DataSourceReader:
        return ShardedDbapiReader(schema, dict(self.options), self.zone)

    zone = "UTC"


def register(spark) -> None:
    """Make ``sharded_dbapi`` available to ``spark.read.format`` and SQL ``USING``.

    Zoneless values of TIMESTAMP columns are read in the session's current zone."""
    from shardscan.session import ship_package

    ship_package(spark)
    session_zone = spark.conf.get("spark.sql.session.timeZone")

    class Registered(ShardedDbapiSource):
        zone = session_zone

    spark.dataSource.register(Registered)
