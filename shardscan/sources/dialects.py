"""Per-server SQL dialect: identifier quoting, catalog query, default driver.

The dialect is picked per URL (not once for the whole URL list), so one scan
may span servers of different kinds.  The catalog query takes its list of tables from the
tables catalog and joins the columns from outside, so a table without (visible)
columns is still a row; columns in this fixed order:
``schema_name, table_name, table_type, column_name, ordinal``; table types are
normalised to ``TABLE``, ``VIEW``, ``SYSTEM TABLE``, ``SYNONYM`` or kept as is.
"""

from __future__ import annotations

import datetime
import decimal
import math
import re
from dataclasses import dataclass, replace
from typing import Any

#: Declared type of a SQLite column of integers beyond 64 bits, which that engine has not: 38 digits of text, the number plus
#: ``WIDE_SHIFT``, so that texts sort as the numbers do, negative ones included.
WIDE = "DECIMAL_TEXT"
WIDE_SHIFT = 10 ** 37

CATALOG_COLUMNS = ("schema_name", "table_name", "table_type", "column_name", "ordinal")


@dataclass(frozen=True)
class Dialect:
    name: str
    quote_char: str
    driver: str | None
    catalog_query: str
    # SQL text of a typed NULL bigint in this dialect
    null_bigint: str = "CAST(NULL AS BIGINT)"
    # FROM clause of a one-row SELECT of scalar expressions ("" when none is needed)
    dual: str = ""
    # integer division of integer operands
    div_template: str = "CAST(FLOOR(({a}) / ({b})) AS BIGINT)"
    # SQL text of the schema and table name in ``catalog_query`` (for a prefix filter on the server)
    name_columns: tuple[str, str] = ("t.table_schema", "t.table_name")
    schema_query: str = "SELECT schema_name FROM information_schema.schemata"
    limit_clause: str = "LIMIT {k}"  # after ORDER BY
    # whether NULLS FIRST / LAST can be said; where not, NULLs already sort as the least, as in Spark
    null_order: bool = True
    # 60 bits of an md5 over a list of texts
    hash_template: str = "CAST(CONV(SUBSTRING(MD5(CONCAT_WS('|', {text})), 1, 15), 16, 10) AS UNSIGNED)"
    wide_sums: bool = True  # whether a SUM of 32-bit integers is wider than 32 bits
    backslash_escapes: bool = False  # whether a backslash inside a string literal escapes
    booleans: tuple[str, str] = ("FALSE", "TRUE")
    # fetch size for split reads when none is given: some drivers otherwise
    # buffer a whole result set in executor memory
    scan_fetch_size: int | None = None

    def quote(self, ident: str) -> str:
        q = self.quote_char
        return q + ident.replace(q, q + q) + q

    def int_div(self, a: str, b: str) -> str:
        return self.div_template.format(a=a, b=b)

    def literal(self, v: Any) -> str:
        """SQL text of a value; NULL has none (``col = NULL`` is never true)."""
        if v is None:
            raise ValueError("NULL has no literal in a comparison")
        if isinstance(v, bool):
            return self.booleans[v]
        if isinstance(v, (int, decimal.Decimal)):
            return str(v)
        if isinstance(v, float):
            if not math.isfinite(v):
                raise ValueError(f"no SQL literal for {v!r}")
            return repr(v)
        if isinstance(v, datetime.datetime):
            return f"TIMESTAMP '{v.isoformat(sep=' ')}'"
        if isinstance(v, datetime.date):
            return f"DATE '{v.isoformat()}'"
        text = str(v).replace("'", "''")
        return "'" + (text.replace("\\", "\\\\") if self.backslash_escapes else text) + "'"

    def equals(self, column_sql: str, v: Any) -> str:
        return f"{column_sql} IS NULL" if v is None else f"{column_sql} = {self.literal(v)}"

    def row_hash(self, columns_sql: list[str]) -> str:
        """60 bits of an md5 over the text of columns, NULL told apart from any text."""
        return self.hash_template.format(text=self.text_template(columns_sql))

    def text_template(self, columns_sql: list[str]) -> str:
        if self.name == "sqlite":
            return ", ".join(columns_sql)
        kind = "CHAR" if self.name in ("mysql", "mariadb") else "VARCHAR"
        # with its length before each text, so that no two rows have one spelling
        return ", ".join(f"COALESCE(CONCAT(CHAR_LENGTH(CAST({c} AS {kind})), ':', CAST({c} AS {kind})), '-')" for c in columns_sql)

    def mod(self, a: str, b: int) -> str:
        return f"MOD({a}, {b})" if self.name != "sqlite" else f"{a} % {b}"

    def order_term(self, column_sql: str, way: str) -> str:
        """An ``ORDER BY`` term with Spark's place for NULLs: first ascending, last descending."""
        nulls = (" NULLS FIRST" if way == "asc" else " NULLS LAST") if self.null_order else ""
        return f"{column_sql} {way.upper()}{nulls}"

    def catalog(self, schema_regex: str, table_regex: str) -> str:
        """The catalog query, cut down on the server to names with the regexes' literal prefixes."""
        parts = []
        for column, regex in zip(self.name_columns, (schema_regex, table_regex)):
            prefix = literal_prefix(regex)
            if prefix:
                parts.append(f"{column} LIKE {self.literal(like_escape(prefix) + '%')} ESCAPE '!'")
        if not parts:
            return self.catalog_query
        word = " AND " if " WHERE " in self.catalog_query else " WHERE "
        return self.catalog_query + word + " AND ".join(parts)

    def qualified(self, schema: str | None, table: str) -> str:
        if schema is None or schema == "":
            return self.quote(table)
        return f"{self.quote(schema)}.{self.quote(table)}"


def wide_text(v: int) -> str:
    """A number as ``WIDE`` text; one beyond its range as the end of the range, for comparisons."""
    return f"{min(max(int(v), -WIDE_SHIFT), 9 * WIDE_SHIFT - 1) + WIDE_SHIFT:038d}"


def wide_number(text: str | None) -> int | None:
    return None if text is None else int(text) - WIDE_SHIFT


def literal_prefix(regex: str) -> str:
    """Characters every whole-string match of ``regex`` starts with ("" when none are certain)."""
    if "|" in regex or "(?" in regex:
        return ""
    m = re.match(r"[A-Za-z0-9_ -]*", regex)  # no metacharacter: an anchor ($) is not part of a name
    prefix, rest = m.group(), regex[m.end():]
    # a quantifier belongs to the last character
    return prefix[:-1] if rest[:1] in ("?", "*", "{", "+") else prefix


def like_escape(text: str) -> str:
    return re.sub(r"([!%_])", r"!\1", text)


_ANSI_CATALOG = (
    "SELECT t.table_schema AS schema_name, t.table_name AS table_name, t.table_type AS table_type, "
    "c.column_name AS column_name, c.ordinal_position AS ordinal "
    "FROM information_schema.tables t LEFT JOIN information_schema.columns c "
    "ON c.table_schema = t.table_schema AND c.table_name = t.table_name"
)

DERBY = Dialect(
    name="derby",
    quote_char='"',
    driver="org.apache.derby.jdbc.EmbeddedDriver",
    catalog_query=(
        "SELECT s.SCHEMANAME AS schema_name, t.TABLENAME AS table_name, "
        "CASE t.TABLETYPE WHEN 'T' THEN 'TABLE' WHEN 'V' THEN 'VIEW' "
        "WHEN 'S' THEN 'SYSTEM TABLE' WHEN 'A' THEN 'SYNONYM' ELSE CAST(t.TABLETYPE AS VARCHAR(16)) END AS table_type, "
        "c.COLUMNNAME AS column_name, c.COLUMNNUMBER AS ordinal "
        "FROM SYS.SYSTABLES t JOIN SYS.SYSSCHEMAS s ON t.SCHEMAID = s.SCHEMAID "
        "LEFT JOIN SYS.SYSCOLUMNS c ON c.REFERENCEID = t.TABLEID"
    ),
    name_columns=("s.SCHEMANAME", "t.TABLENAME"),
    schema_query="SELECT SCHEMANAME AS schema_name FROM SYS.SYSSCHEMAS",
    # exact for DECIMAL keys too: the quotient is cut, not rounded
    div_template="CAST(({a}) / ({b}) AS BIGINT)",
    limit_clause="FETCH FIRST {k} ROWS ONLY",
    wide_sums=False,
    dual=" FROM SYSIBM.SYSDUMMY1",
)

MYSQL = Dialect(
    name="mysql",
    quote_char="`",
    driver="com.mysql.cj.jdbc.Driver",
    catalog_query=(
        "SELECT t.TABLE_SCHEMA AS schema_name, t.TABLE_NAME AS table_name, "
        "CASE t.TABLE_TYPE WHEN 'BASE TABLE' THEN 'TABLE' ELSE t.TABLE_TYPE END AS table_type, "
        "c.COLUMN_NAME AS column_name, c.ORDINAL_POSITION AS ordinal "
        "FROM information_schema.TABLES t LEFT JOIN information_schema.COLUMNS c "
        "ON c.TABLE_SCHEMA = t.TABLE_SCHEMA AND c.TABLE_NAME = t.TABLE_NAME"
    ),
    null_bigint="CAST(NULL AS SIGNED)",
    div_template="({a}) DIV ({b})",
    name_columns=("t.TABLE_SCHEMA", "t.TABLE_NAME"),
    schema_query="SELECT SCHEMA_NAME AS schema_name FROM information_schema.SCHEMATA",
    backslash_escapes=True,
    null_order=False,
    scan_fetch_size=-(2**31),  # the driver's row-streaming mode
)

# the same SQL; its own driver, which streams at any positive fetch size
MARIADB = replace(MYSQL, name="mariadb", driver="org.mariadb.jdbc.Driver", scan_fetch_size=10_000)

POSTGRES = Dialect(
    name="postgresql",
    quote_char='"',
    driver="org.postgresql.Driver",
    scan_fetch_size=10_000,  # with Spark's PostgreSQL dialect this turns on a cursor
    # pg_class rather than information_schema: materialized views are tables here too
    catalog_query=(
        "SELECT n.nspname AS schema_name, t.relname AS table_name, "
        "CASE t.relkind WHEN 'v' THEN 'VIEW' WHEN 'm' THEN 'MATERIALIZED VIEW' WHEN 'f' THEN 'FOREIGN TABLE' "
        "ELSE 'TABLE' END AS table_type, "
        "c.attname AS column_name, c.attnum AS ordinal "
        "FROM pg_catalog.pg_class t JOIN pg_catalog.pg_namespace n ON n.oid = t.relnamespace "
        "LEFT JOIN pg_catalog.pg_attribute c ON c.attrelid = t.oid AND c.attnum > 0 AND NOT c.attisdropped "
        "WHERE t.relkind IN ('r', 'p', 'v', 'm', 'f')"
    ),
    name_columns=("n.nspname", "t.relname"),
    schema_query="SELECT nspname AS schema_name FROM pg_catalog.pg_namespace",
    hash_template="CAST(CAST('x' || SUBSTR(MD5(CONCAT_WS('|', {text})), 1, 15) AS BIT(60)) AS BIGINT)",
    div_template="DIV(CAST({a} AS NUMERIC), CAST({b} AS NUMERIC))",
)

SQLITE = Dialect(
    name="sqlite",
    hash_template="shardscan_row_hash({text})",  # a function of the connection
    quote_char='"',
    driver="org.sqlite.JDBC",
    catalog_query=(
        "SELECT 'main' AS schema_name, m.name AS table_name, "
        "CASE m.type WHEN 'table' THEN 'TABLE' ELSE 'VIEW' END AS table_type, "
        "p.name AS column_name, p.cid + 1 AS ordinal FROM sqlite_master m LEFT JOIN pragma_table_info(m.name) p "
        "WHERE m.type IN ('table', 'view')"
    ),
    name_columns=("'main'", "m.name"),
    schema_query="SELECT 'main' AS schema_name",
    div_template="CAST(({a}) / ({b}) AS INTEGER)",
    booleans=("0", "1"),
)

GENERIC = Dialect(name="generic", quote_char='"', driver=None, catalog_query=_ANSI_CATALOG)

_BY_PREFIX = (
    ("jdbc:derby:", DERBY),
    ("jdbc:mysql:", MYSQL),
    ("jdbc:mariadb:", MARIADB),
    ("jdbc:postgresql:", POSTGRES),
    ("jdbc:sqlite:", SQLITE),
    ("sqlite:", SQLITE),
)


def dialect_for(url: str) -> Dialect:
    u = url.strip().lower()
    for prefix, d in _BY_PREFIX:
        if u.startswith(prefix):
            return d
    return GENERIC


def salt_predicate(column_sql: str, buckets: int, bucket: int) -> str:
    """Rows of one salt bucket: ``MOD(col, k)`` is negative for negative values
    on every supported engine, so bucket ``j`` also takes remainder ``j - k``.
    Bucket 0 takes all that no other bucket takes, NULL salts included, so no
    value of any type is left out."""
    if bucket == 0:
        others = ", ".join(str(x) for j in range(1, buckets) for x in (j, j - buckets))
        rest = f"MOD({column_sql}, {buckets}) NOT IN ({others}) OR " if others else "1 = 1 OR "
        return f"({rest}{column_sql} IS NULL)"
    return f"MOD({column_sql}, {buckets}) IN ({bucket}, {bucket - buckets})"
