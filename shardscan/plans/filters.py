"""Filters a task puts into its splits' SQL, and Spark applies once more.

A filter is ``(column, operator, value)`` with ``=, <>, <, <=, >, >=, in, is null, is not null``.  Into the SQL go those that
every database answers with at least the rows Spark would keep: text is compared there only by ``=`` and ``in`` (a
collation may fit more, never less), dates and times not in SQLite, which keeps them as text.  Spark applies all of
them again, so the result never depends on what was pushed.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, FractionalType, IntegralType, StringType, StructType, TimestampNTZType, TimestampType

OPERATORS = ("=", "<>", "<", "<=", ">", ">=", "in", "is null", "is not null")
Filter = tuple[str, str, Any]


def checked(filters: Sequence[Sequence[Any]], schema: StructType) -> tuple[Filter, ...]:
    out = []
    names = {f.name for f in schema.fields}
    for f in filters:
        column, op, *rest = f
        if column not in names or op not in OPERATORS or len(rest) != (0 if op.startswith("is") else 1):
            raise ValueError(f"not a filter on a declared column: {tuple(f)!r}")
        value = rest[0] if rest else None
        values = list(value) if op == "in" else [value]
        if not op.startswith("is") and (not values or any(v is None for v in values)):
            raise ValueError(f"{tuple(f)!r}: NULL and no value at all equal nothing; use 'is null'")
        out.append((column, op, tuple(values) if op == "in" else value))
    return tuple(out)


def column_of(filters: Sequence[Filter]) -> Column:
    """All filters as one Spark condition."""
    def one(column: str, op: str, value: Any) -> Column:
        c = F.col("`" + column.replace("`", "``") + "`")
        if op == "in":
            return c.isin(list(value))
        if op in ("is null", "is not null"):
            return c.isNull() if op == "is null" else c.isNotNull()
        return {"=": c == value, "<>": c != value, "<": c < value, "<=": c <= value, ">": c > value, ">=": c >= value}[op]

    return reduce(lambda a, b: a & b, [one(*f) for f in filters], F.lit(True))


def pushed(filters: Sequence[Filter], schema: StructType, kind: str) -> list[Filter]:
    """Those that a database of this kind may be trusted with."""
    types = {f.name: f.dataType for f in schema.fields}

    def safe(column: str, op: str) -> bool:
        t = types[column]
        if op in ("is null", "is not null") or isinstance(t, IntegralType):
            return True
        if isinstance(t, StringType):
            return op in ("=", "in")
        if isinstance(t, (DateType, TimestampType, TimestampNTZType)):
            return kind != "sqlite" and not isinstance(t, TimestampType)
        return isinstance(t, FractionalType)

    return [f for f in filters if safe(f[0], f[1])]
