"""Secret scan: key patterns, and sliding-window entropy per character class.

Base kinds are patterns (assignments, access keys, hex runs).  The entropy scan
adds what they miss: candidate strings are runs of key characters; in every
run the hex and the base64 class slide a window of ``ENTROPY_WINDOW``
characters, its Shannon entropy kept by incremental counts (one character
leaves, one enters).  Windows above the class's threshold join to spans.  A span that
lies inside a base span adds nothing; one that an allow-list pattern matches
(UUIDs, documented example keys, long words, repeated or counting characters) is
suppressed.  'example' or counting characters suppress the part of a run between separators
that holds them; what stands beside it is scanned by itself.  Base spans are never suppressed.

Spans are ``kind:start:end`` in code points, end exclusive, by start and then kind
in the order of ``KINDS``.  Defined results: null and empty texts have no spans
(and the digest of the empty string); repeated rows get equal results; an
empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
import re
from bisect import bisect_right
from collections.abc import Iterator
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shardscan.llm.common import documents, python_tasks

KINDS = ("assign", "access", "hex", "entropy_hex", "entropy_base64")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
                    re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{16,}")  # the maximal runs of at least 16

CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-]{20,}")
HEX_CLASS = re.compile(r"[0-9A-Fa-f]{20,}")
DIGIT = re.compile(r"[0-9]")
ENTROPY_WINDOW = 20
#: Bits a character; a random window of 20 has about 3.4 (hex) and 4.1 (base64).
THRESHOLDS = {"entropy_hex": 3.0, "entropy_base64": 3.75}
ALLOW = (
    re.compile(r"[0-9A-Fa-f]{8}(-[0-9A-Fa-f]{4}){3}-[0-9A-Fa-f]{12}"),  # UUID
    # words, hyphenated words, paths; one way only to read each word, so a long slug that fails costs one pass
    re.compile(r"[A-Z]?[a-z]+(?:[-_/][A-Z]?[a-z]+)*[0-9]{0,4}"),
    re.compile(r"(.{1,4})\1{3,}.{0,4}"),
)

#: Suppresses the part of a run between separators that holds it; a documented key has separators itself.
ALLOW_PART = re.compile(r"(?i)example|0123456789|abcdefghij|1234567890")
PART = re.compile(r"[^/=_+-]+")
DOCUMENTED = re.compile(r"wJalrXUtnFEMI/K7MDENG/bPxRfiCYEXAMPLEKEY")

_TERM = [0.0] + [n * math.log2(n) for n in range(1, ENTROPY_WINDOW + 1)]


def entropies(s: str, window: int = ENTROPY_WINDOW) -> Iterator[float]:
    """Shannon entropy of every window of ``s``, one character in and one out at a time."""
    counts: dict[str, int] = {}
    total = 0.0  # sum of n * log2(n) over the window's characters
    term = _TERM if window == ENTROPY_WINDOW else [0.0] + [n * math.log2(n) for n in range(1, window + 1)]
    full = math.log2(window)
    for i, c in enumerate(s):
        if i >= window:
            old = s[i - window]
            n = counts[old]
            total += term[n - 1] - term[n]
            counts[old] = n - 1
        n = counts.get(c, 0)
        total += term[n + 1] - term[n]
        counts[c] = n + 1
        if i >= window - 1:
            yield full - total / window


def _mixed(s: str) -> bool:
    """Digits and letters of the run: a key, rather than a word or a number."""
    return bool(DIGIT.search(s)) and any(c.isalpha() for c in s)


def _stretches(run: str) -> Iterator[tuple[int, str]]:
    """(place, string) of what is left of a run without its allowed parts; the whole run if it has none."""
    if any(p.fullmatch(run) for p in ALLOW):
        return
    if not ALLOW_PART.search(run):
        yield 0, run
        return
    out = [m.span() for p in (ALLOW[0], DOCUMENTED) for m in p.finditer(run)]
    out += [m.span() for m in PART.finditer(run) if ALLOW_PART.search(m.group())]
    at = 0
    for a, b in [*sorted(out), (len(run) + 1, len(run) + 1)]:
        # without the separators next to an allowed part
        if a - 1 - at >= ENTROPY_WINDOW:
            yield at, run[at:a - 1]
        at = max(at, b + 1)


def _entropy_spans(text: str) -> list[tuple[int, int, str]]:
    out = []
    for at, run in ((m.start() + a, s) for m in CANDIDATE.finditer(text) for a, s in _stretches(m.group())):
        if not _mixed(run) or any(p.fullmatch(run) for p in ALLOW):
            continue
        parts = [("entropy_hex", h.group(), at + h.start()) for h in HEX_CLASS.finditer(run)]
        if not any(len(p) == len(run) for _, p, _ in parts):
            parts.append(("entropy_base64", run, at))
        for kind, s, start in parts:
            spans: list[list[int]] = []
            for i, h in enumerate(entropies(s)):
                if h >= THRESHOLDS[kind]:
                    if spans and i <= spans[-1][1]:
                        spans[-1][1] = i + ENTROPY_WINDOW
                    else:
                        spans.append([i, i + ENTROPY_WINDOW])
            for a, b in spans:
                if _mixed(s[a:b]) and not any(p.fullmatch(s[a:b]) for p in ALLOW):
                    out.append((start + a, start + b, kind))
    return out


def scan(text: str | None) -> tuple[list[tuple[int, int, str]], list[tuple[int, int, str]]]:
    """(base spans, all spans) of one text as (start, end, kind), in order."""
    if not text:
        return [], []
    base = [(m.start(), m.end(), "assign") for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 12]
    base += [(m.start(), m.end(), "access") for m in ACCESS.finditer(text) if m.end() - m.start() >= 18]
    base += [(m.start(), m.end(), "hex") for m in HEX.finditer(text)]
    def order(s):
        return s[0], KINDS.index(s[2]), s[1]
    base.sort(key=order)
    starts, reach = [a for a, _, _ in base], list(accumulate((b for _, b, _ in base), max))
    more = []
    for s in _entropy_spans(text):
        n = bisect_right(starts, s[0])  # the base spans that start no later, and how far they reach
        if not n or reach[n - 1] < s[1]:
            more.append(s)
    return base, sorted(base + more, key=order)


def joined(spans: list[tuple[int, int, str]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for a, b, k in spans)


def find_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: ``doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_entropy``."""
    python_tasks(docs.sparkSession)

    @F.arrow_udf("struct<n_assign:long,n_access:long,n_hex:long,base_sha256:string,spans:string,n_entropy:long>")
    def found(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for arr in batches:
            cols: list[list] = [[] for _ in range(6)]
            for t in arr:
                base, every = scan(t.as_py())
                for i, kind in enumerate(KINDS[:3]):
                    cols[i].append(sum(s[2] == kind for s in base))
                cols[3].append(hashlib.sha256(joined(base).encode()).hexdigest())
                cols[4].append(joined(every))
                cols[5].append(len(every) - len(base))
            kinds = [pa.int64()] * 3 + [pa.string()] * 2 + [pa.int64()]
            yield pa.StructArray.from_arrays(
                [pa.array(c, k) for c, k in zip(cols, kinds)],
                names=["n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_entropy"])

    rows = docs.select(F.col(id_col).alias("doc_id"), found(F.col(text_col).cast("string")).alias("s"))
    return rows.select("doc_id", "s.*")


def op7_entropy_secret_scan(spark, sf_dir: str) -> DataFrame:
    return find_secrets(documents(spark, sf_dir))
