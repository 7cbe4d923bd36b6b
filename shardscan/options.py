"""Scan options: one immutable record, validated before any I/O.

Keys follow the connector-style names users already write in DDL
(``url``, ``table-name``, ``schema-name``, ``scan.partition.column`` ...).
Everything is checked here so that a bad option fails on the driver with a
``ValueError`` instead of half-way through a job.
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from contextlib import contextmanager
from dataclasses import dataclass
from typing import Any

from shardscan.plans.key_ranges import KeyRanges

# The JDBC fetch-size sentinel some drivers read as "stream rows".
INT_MIN = -(2**31)

_TRUE = {"true", "1", "yes", "on"}
_FALSE = {"false", "0", "no", "off"}

_SECRET_PATTERNS = (
    re.compile(r"(?i)(password\s*=\s*)[^;&\s]*"),
    re.compile(r"(?i)(passwd\s*=\s*)[^;&\s]*"),
    re.compile(r"(//[^/:@\s]*:)[^/\s]*(@)"),  # up to the last @ of the authority: a password may hold one
)


def redact(text: str, secrets: Sequence[str | None] = ()) -> str:
    """Remove passwords from a URL or message."""
    out = str(text)
    for pat in _SECRET_PATTERNS:
        out = pat.sub(lambda m: m.group(1) + "***" + (m.group(2) if m.lastindex == 2 else ""), out)
    for s in secrets:
        if s:
            out = out.replace(s, "***")
    return out


class RedactedCause(Exception):
    """What failed underneath: the original class name and its message without passwords."""


def _redacted_chain(e: BaseException | None, secrets: Sequence[str | None]) -> RedactedCause | None:
    if e is None:
        return None
    cause = RedactedCause(f"{type(e).__name__}: {redact(str(e), secrets)}")
    cause.__cause__ = _redacted_chain(e.__cause__ or (None if e.__suppress_context__ else e.__context__), secrets)
    return cause


@contextmanager
def redacted_errors(what: str, secrets: Sequence[str | None] = ()):
    """Re-raise any error of the block as ``RuntimeError`` whose text has the
    passwords removed.  The chain of causes is kept as class names and redacted
    messages; the original exceptions are not (they may carry a URL with
    credentials)."""
    try:
        yield
    except (ValueError, KeyboardInterrupt, GeneratorExit):
        raise
    except Exception as e:
        text = redact(f"{type(e).__name__}: {e}", secrets)
        raise RuntimeError(f"{what} failed: {text}") from _redacted_chain(e, secrets)


def _as_int(name: str, value: Any) -> int | None:
    if value is None or value == "":
        return None
    try:
        return int(str(value).strip())
    except ValueError:
        raise ValueError(f"option '{name}' must be an integer, got {value!r}") from None


def _as_bool(name: str, value: Any, default: bool) -> bool:
    if value is None or value == "":
        return default
    if isinstance(value, bool):
        return value
    v = str(value).strip().lower()
    if v in _TRUE:
        return True
    if v in _FALSE:
        return False
    raise ValueError(f"option '{name}' must be a boolean, got {value!r}")


def split_urls(url: str | Sequence[str]) -> tuple[str, ...]:
    """A ``;``-separated string (every ``;`` separates) or a list of URLs.

    Use the list form for URLs that carry ``;`` attributes themselves.
    """
    if isinstance(url, str):
        parts = url.split(";")
    else:
        parts = list(url)
    urls = tuple(p.strip() for p in parts if p and p.strip())
    if not urls:
        raise ValueError("option 'url' is required and must name at least one server")
    return urls


@dataclass(frozen=True)
class ScanOptions:
    """Validated options of one sharded scan."""

    urls: tuple[str, ...]
    table_name: str
    schema_name: str
    partition_column: str
    batch_size: int | None = None
    partition_num: int | None = None
    username: str | None = None
    password: str | None = None
    driver: str | None = None
    fetch_size: int | None = None
    lower_bound: int | None = None
    upper_bound: int | None = None
    query: str | None = None
    conditions: tuple[tuple[str, Any], ...] = ()
    null_key: str = "drop"
    table_types: tuple[str, ...] | None = None
    provenance: bool = False
    max_splits: int | None = None
    session_init_statement: str | None = None
    query_timeout: int | None = None
    splits_per_task: int = 1
    salt_column: str | None = None
    salt_buckets: int = 1
    max_parallel_reads: int | None = None
    key_ranges: KeyRanges = KeyRanges()

    # ------------------------------------------------------------------ build
    @classmethod
    def from_map(cls, options: Mapping[str, Any] | None = None, **kwargs: Any) -> "ScanOptions":
        """Build from connector-style keys; keyword arguments may use
        underscores instead of dots and dashes (``partition_column=``)."""
        m: dict[str, Any] = {}
        for k, v in dict(options or {}).items():
            m[_norm_key(k)] = v
        for k, v in kwargs.items():
            m[_norm_key(k)] = v
        known = {
            "url", "table_name", "schema_name", "username", "password", "driver",
            "scan_partition_column", "scan_batch_size", "scan_partition_num",
            "scan_fetch_size", "scan_lower_bound", "scan_upper_bound", "scan_query",
            "scan_conditions", "scan_null_key", "table_types", "scan_provenance",
            "scan_max_splits", "scan_session_init_statement", "scan_query_timeout",
            "scan_splits_per_task", "scan_salt_column", "scan_salt_buckets",
            "scan_max_parallel_reads", "scan_key_ranges",
            "connector", "schema",
        }
        aliases = {
            "partition_column": "scan_partition_column",
            "batch_size": "scan_batch_size",
            "partition_num": "scan_partition_num",
            "fetch_size": "scan_fetch_size",
            "fetchsize": "scan_fetch_size",
            "lower_bound": "scan_lower_bound",
            "upper_bound": "scan_upper_bound",
            "query": "scan_query",
            "conditions": "scan_conditions",
            "null_key": "scan_null_key",
            "provenance": "scan_provenance",
            "max_splits": "scan_max_splits",
            "key_ranges": "scan_key_ranges",
            "user": "username",
        }
        for a, target in aliases.items():
            if a in m:
                m.setdefault(target, m.pop(a))
        unknown = sorted(set(m) - known)
        if unknown:
            raise ValueError(f"unknown option(s): {', '.join(unknown)}")
        if "url" not in m:
            raise ValueError("option 'url' is required")
        for req in ("table_name", "schema_name"):
            if not m.get(req) and not m.get("scan_query"):
                raise ValueError(f"option '{req.replace('_', '-')}' is required")
        conditions = m.get("scan_conditions") or ()
        if isinstance(conditions, Mapping):
            conditions = tuple(conditions.items())
        elif isinstance(conditions, str):  # "col=value,col2=value2" (SQL OPTIONS form)
            pairs = [c.split("=", 1) for c in conditions.split(",") if c.strip()]
            if any(len(p) != 2 or not p[0].strip() for p in pairs):
                raise ValueError("'scan.conditions' must look like 'col=value,col2=value2'")
            conditions = tuple((k.strip(), v.strip()) for k, v in pairs)
        table_types = m.get("table_types")
        if isinstance(table_types, str):
            table_types = tuple(t.strip().upper() for t in table_types.split(",") if t.strip())
        elif table_types is not None:
            table_types = tuple(str(t).upper() for t in table_types)
        opts = cls(
            urls=split_urls(m["url"]),
            table_name=m.get("table_name") or ".*",
            schema_name=m.get("schema_name") or ".*",
            partition_column=m.get("scan_partition_column") or "",
            batch_size=_as_int("scan.batch.size", m.get("scan_batch_size")),
            partition_num=_as_int("scan.partition.num", m.get("scan_partition_num")),
            username=m.get("username") or None,
            password=m.get("password") or None,
            driver=m.get("driver") or None,
            fetch_size=_as_int("scan.fetch-size", m.get("scan_fetch_size")),
            lower_bound=_as_int("scan.lower-bound", m.get("scan_lower_bound")),
            upper_bound=_as_int("scan.upper-bound", m.get("scan_upper_bound")),
            query=m.get("scan_query") or None,
            conditions=tuple(conditions),
            null_key=str(m.get("scan_null_key") or "drop").lower(),
            table_types=table_types,
            provenance=_as_bool("scan.provenance", m.get("scan_provenance"), False),
            max_splits=_as_int("scan.max-splits", m.get("scan_max_splits")),
            session_init_statement=m.get("scan_session_init_statement") or None,
            query_timeout=_as_int("scan.query-timeout", m.get("scan_query_timeout")),
            splits_per_task=_default(_as_int("scan.splits-per-task", m.get("scan_splits_per_task")), 1),
            salt_column=m.get("scan_salt_column") or None,
            salt_buckets=_default(_as_int("scan.salt.buckets", m.get("scan_salt_buckets")), 1),
            max_parallel_reads=_as_int("scan.max-parallel-reads", m.get("scan_max_parallel_reads")),
            key_ranges=KeyRanges.of(m.get("scan_key_ranges") or ()),
        )
        opts.validate()
        return opts

    # --------------------------------------------------------------- validate
    def validate(self) -> None:
        if not self.urls:
            raise ValueError("option 'url' must name at least one server")
        if not self.partition_column:
            raise ValueError("option 'scan.partition.column' is required")
        has_b, has_n = self.batch_size is not None, self.partition_num is not None
        if has_b == has_n:
            raise ValueError(
                "exactly one of 'scan.batch.size' and 'scan.partition.num' must be set"
            )
        if has_b and self.batch_size < 1:
            raise ValueError(f"'scan.batch.size' must be >= 1, got {self.batch_size}")
        if has_n and self.partition_num < 1:
            raise ValueError(f"'scan.partition.num' must be >= 1, got {self.partition_num}")
        if has_b and self.batch_size > 2**31 - 1:
            raise ValueError("'scan.batch.size' must fit in a 32-bit integer")
        if self.fetch_size is not None and not (self.fetch_size >= 0 or self.fetch_size == INT_MIN):
            raise ValueError("'scan.fetch-size' must be >= 0 (or the streaming sentinel -2147483648)")
        if (self.lower_bound is None) != (self.upper_bound is None):
            raise ValueError("'scan.lower-bound' and 'scan.upper-bound' go together")
        if self.lower_bound is not None and self.lower_bound > self.upper_bound:
            raise ValueError("'scan.lower-bound' must not exceed 'scan.upper-bound'")
        if self.key_ranges and self.null_key == "keep":
            raise ValueError("'scan.key-ranges' holds no NULL key: it does not go with 'scan.null-key' = 'keep'")
        if self.null_key not in ("drop", "keep"):
            raise ValueError("'scan.null-key' must be 'drop' or 'keep'")
        if self.max_splits is not None and self.max_splits < 1:
            raise ValueError("'scan.max-splits' must be >= 1")
        if self.max_parallel_reads is not None and self.max_parallel_reads < 1:
            raise ValueError("'scan.max-parallel-reads' must be >= 1")
        if self.salt_buckets < 1:
            raise ValueError("'scan.salt.buckets' must be >= 1")
        if (self.salt_buckets > 1) != (self.salt_column is not None):
            raise ValueError("'scan.salt.column' and 'scan.salt.buckets' > 1 go together")
        if self.splits_per_task < 1:
            raise ValueError("'scan.splits-per-task' must be >= 1")
        if self.query_timeout is not None and self.query_timeout < 0:
            raise ValueError("'scan.query-timeout' must be >= 0")

    # ---------------------------------------------------------------- helpers
    def check_split_count(self, n: int) -> None:
        """The opt-in guard ``scan.max-splits`` (no limit when it is not set)."""
        if self.max_splits is not None and n > self.max_splits:
            raise ValueError(
                f"the plan has more than scan.max-splits={self.max_splits} splits; "
                "raise scan.batch.size, lower scan.partition.num or raise scan.max-splits"
            )

    @property
    def explicit_bounds(self) -> bool:
        return self.lower_bound is not None

    @property
    def buckets(self) -> list[int | None]:
        """Salt buckets each key range is read in (``[None]`` when not salted)."""
        return list(range(self.salt_buckets)) if self.salt_column else [None]

    def jdbc_properties(self, driver: str | None, default_fetch_size: int | None = None) -> dict[str, str]:
        """Properties for ``spark.read.jdbc``; the password never leaves here
        except into Spark's own (redacted) JDBC options.  ``default_fetch_size``
        (the dialect's streaming setting) applies when no fetch size is set."""
        props: dict[str, str] = {}
        drv = self.driver or driver
        if drv:
            props["driver"] = drv
        if self.username is not None:
            props["user"] = self.username
        if self.password is not None:
            props["password"] = self.password
        fetch = self.fetch_size if self.fetch_size is not None else default_fetch_size
        if fetch is not None:
            props["fetchsize"] = str(fetch)
        if self.session_init_statement:
            props["sessionInitStatement"] = self.session_init_statement
        if self.query_timeout is not None:
            props["queryTimeout"] = str(self.query_timeout)
        return props

    def redact(self, text: str) -> str:
        return redact(text, (self.password,))

    def __repr__(self) -> str:  # never print the password
        return (
            f"ScanOptions(urls={[self.redact(u) for u in self.urls]}, table_name={self.table_name!r}, "
            f"schema_name={self.schema_name!r}, partition_column={self.partition_column!r}, "
            f"batch_size={self.batch_size}, partition_num={self.partition_num}, "
            f"username={self.username!r}, password={'***' if self.password else None})"
        )

    __str__ = __repr__


def _default(v: int | None, d: int) -> int:
    return d if v is None else v


def _norm_key(k: str) -> str:
    return str(k).strip().lower().replace(".", "_").replace("-", "_")
