"""Benchmark decontamination with a generalised suffix automaton.

The benchmark items, lower-cased and cut into words, build one suffix automaton
(all items, every state with the items it occurs in).  Documents stream their
words through it: at each word the state and the length of the longest match
that ends there.  A match of at least ``window`` words means that its last
``window`` words are consecutive words of an item, so they are hit; an item of
fewer words is hit where it occurs whole, found on the state's chain of
suffix links.

An automaton takes about a hundred times its items' text in memory, so it never travels.  The items are cut into
blocks of about ``block_bytes`` of text by hash (one item is never cut); a block's text, compressed, goes to the tasks in
their closure, and a Python worker builds the block's automaton when it first needs it and keeps that one only.  One
block, the usual case, is one pass over the documents without a shuffle.  More blocks are one pass each over the documents,
numbered in a written table; a pass leaves only the rows with hits, which are united by row number.

Defined results: null and empty texts have no words and are clean; very long texts are read in pieces, whole; an item
without words matches nothing, equal items count as items of their own; null
item ids count as the empty id; empty tables give empty or clean results;
repeated rows get equal results; other columns pass through, whatever their names.
"""

from __future__ import annotations

import pickle
import re
import zlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shardscan.llm.common import documents, fresh, pieces, python_tasks, table, written

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
GAP = re.compile(r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]")  # no letter of either case: between words
LOWER = {c: c + 32 for c in range(65, 91)}
WINDOW = 13
#: Text of one automaton: about 400 MB of states.
BLOCK_BYTES = 4 << 20


def words(text: str | None) -> list[str]:
    return WORD.findall(text.translate(LOWER)) if text else []


class SuffixAutomaton:
    """Of word sequences: ``next``, ``link``, ``length`` and the items of every state."""

    def __init__(self, items: list[tuple[str, list[str]]], window: int = WINDOW):
        self.window = window
        self.ids = [i for i, _ in items]
        self.vocabulary: dict[str, int] = {}
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length, self.of = [-1], [0], [set()]
        whole: list[tuple[int, int]] = []
        for n, (_, seq) in enumerate(items):
            codes = [self.vocabulary.setdefault(w, len(self.vocabulary)) for w in seq]
            last = 0
            for c in codes:
                last = self._extend(last, c)
            if codes and len(codes) < window:
                whole.append((n, len(codes)))
        # the items of a state: every state on the walk of an item, and its suffixes
        for n, (_, seq) in enumerate(items):
            state = 0
            for w in seq:
                state = self.next[state][self.vocabulary[w]]
                s = state
                while s > 0 and n not in self.of[s]:
                    self.of[s].add(n)
                    s = self.link[s]
        # short items: the state that holds the whole item, per length
        self.short: dict[int, dict[int, set[int]]] = {}
        for n, size in whole:
            state = 0
            for w in items[n][1]:
                state = self.next[state][self.vocabulary[w]]
            self.short.setdefault(state, {}).setdefault(size, set()).add(n)
        self.least = min([window] + [size for _, size in whole])

    def _extend(self, last: int, c: int) -> int:
        if c in self.next[last]:
            q = self.next[last][c]
            return q if self.length[q] == self.length[last] + 1 else self._clone(last, q, c)
        cur = self._state({}, self.length[last] + 1, 0)
        p = last
        while p != -1 and c not in self.next[p]:
            self.next[p][c] = cur
            p = self.link[p]
        if p != -1:
            q = self.next[p][c]
            self.link[cur] = q if self.length[q] == self.length[p] + 1 else self._clone(p, q, c)
        return cur

    def _state(self, following: dict[int, int], length: int, link: int) -> int:
        self.next.append(following)
        self.length.append(length)
        self.link.append(link)
        self.of.append(set())
        return len(self.next) - 1

    def _clone(self, p: int, q: int, c: int) -> int:
        new = self._state(dict(self.next[q]), self.length[p] + 1, self.link[q])
        self.link[q] = new
        while p != -1 and self.next[p].get(c) == q:
            self.next[p][c] = new
            p = self.link[p]
        return new

    def codes(self, text: str | None) -> np.ndarray:
        """Word numbers of a text, -1 for words in no item."""
        get = self.vocabulary.get
        parts = [np.fromiter((get(w, -1) for w in words(p)), np.int32) for p in pieces(text or "", GAP)]
        return np.concatenate(parts) if parts else np.zeros(0, np.int32)

    def hits(self, codes: np.ndarray) -> tuple[list[tuple[int, int]], set[int]]:
        """Word spans [start, end) covered by windows, merged, and the numbers of the items found."""
        known = (codes >= 0).astype(np.int8)
        edge = np.flatnonzero(np.diff(np.concatenate(([0], known, [0]))))
        spans: list[tuple[int, int]] = []
        found: set[int] = set()
        for a, b in zip(edge[::2].tolist(), edge[1::2].tolist()):
            if b - a >= self.least:
                self._run(codes[a:b].tolist(), a, spans, found)
        return spans, found

    def _run(self, codes: list[int], a: int, spans, found) -> None:
        following, link, length, window, short = self.next, self.link, self.length, self.window, self.short
        state = size = 0
        for i, c in enumerate(codes, a):
            while state and c not in following[state]:
                state = link[state]
                size = length[state]
            if c in following[state]:
                state = following[state][c]
                size += 1
            reach = 0
            s = state
            if size >= window:
                reach = window
                while length[link[s]] >= window:
                    s = link[s]
                found |= self.of[s]
            if short and size >= self.least:
                while s > 0:
                    for n, items in short.get(s, {}).items():
                        if n <= size:
                            reach = max(reach, n)
                            found |= items
                    s = link[s]
            if reach:
                start = i + 1 - reach
                while spans and spans[-1][1] >= start:  # ends only grow: merge what this one touches
                    start = min(start, spans.pop()[0])
                spans.append((start, i + 1))


def _blocks(benchmark: DataFrame, block_bytes: int) -> Iterator[bytes]:
    """The items (id, text), compressed, of one block after the other; the driver holds one."""
    items = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("id"),
                             F.col("text").cast("string").alias("text"))
    size = items.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    n = int(size // block_bytes) + 1
    for k in range(n):
        part = items.where(F.pmod(F.xxhash64("id", "text"), F.lit(n)) == k).collect()
        yield zlib.compress(pickle.dumps(sorted((r["id"], r["text"] or "") for r in part)))


_BUILT: dict[tuple, SuffixAutomaton] = {}


def automaton_of(block: bytes, window: int) -> SuffixAutomaton:
    """The automaton of a block in this Python worker: built once, and the one before it dropped."""
    key = (zlib.crc32(block), len(block), window)
    if key not in _BUILT:
        _BUILT.clear()
        _BUILT[key] = SuffixAutomaton([(i, words(t)) for i, t in pickle.loads(zlib.decompress(block))], window)
    return _BUILT[key]


SPANS = pa.list_(pa.struct([("a", pa.int32()), ("b", pa.int32())]))
RESULT = "struct<n_words:long,spans:array<struct<a:int,b:int>>,items:array<string>>"


def matcher(block: bytes, window: int):
    """Arrow UDF text -> (n_words, hit word spans, item ids)."""
    @F.arrow_udf(RESULT)
    def match(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        kind = pa.struct([("n_words", pa.int64()), ("spans", SPANS), ("items", pa.list_(pa.string()))])
        automaton = automaton_of(block, window)
        for arr in batches:
            out = []
            for t in arr:
                codes = automaton.codes(t.as_py())
                spans, found = automaton.hits(codes)
                out.append({"n_words": len(codes), "spans": [{"a": a, "b": b} for a, b in spans],
                            "items": sorted(automaton.ids[n] for n in found)})
            yield pa.array(out, kind)

    return match


def _union(spans: Sequence[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def uniter():
    """Arrow UDF: the spans of all blocks as disjoint ones, in order."""
    @F.arrow_udf("array<struct<a:int,b:int>>")
    def united(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for arr in batches:
            yield pa.array([[{"a": a, "b": b} for a, b in _union([(s["a"], s["b"]) for s in row or ()])] for row in arr.to_pylist()], SPANS)

    return united


def find_overlap(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, out: str = "overlap",
                 block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``docs`` with a struct ``out``: n_words, n_hit, longest (words of the longest hit span),
    spans (word ranges), items (sorted ids of items with an occurring window, one entry an item)."""
    python_tasks(docs.sparkSession)
    text = F.col("text").cast("string")
    blocks = _blocks(benchmark, block_bytes)
    block, more = next(blocks), next(blocks, None)
    match = fresh(docs, "__match")
    if more is None:
        found = docs.withColumn(match, matcher(block, window)(text))
        spans, items = F.col(f"{match}.spans"), F.col(f"{match}.items")
        return found.withColumn(out, _overlap(F.col(f"{match}.n_words"), spans, items)).drop(match)
    row = fresh(docs, "__row")
    numbered = written(docs.withColumn(row, F.monotonically_increasing_id()), "numbered")
    first = written(numbered.select(row, matcher(block, window)(text).alias("m")), "block")
    hits = first.select(row, "m.spans", "m.items")
    while more is not None:
        m = written(numbered.select(row, matcher(more, window)(text).alias("m")).where(F.size("m.spans") > 0), "block")
        hits, more = hits.unionByName(m.select(row, "m.spans", "m.items")), next(blocks, None)
    each = hits.groupBy(F.col(row).alias("__hit_row")).agg(
        F.flatten(F.collect_list("spans")).alias("spans"),
        F.sort_array(F.flatten(F.collect_list("items"))).alias("items"))  # a row has one entry a block
    each = each.withColumn("spans", uniter()("spans")).join(first.select(F.col(row).alias("__hit_row"), "m.n_words"), "__hit_row")
    each = each.select("__hit_row", _overlap(F.col("n_words"), F.col("spans"), F.col("items")).alias(match))
    joined = numbered.join(each, F.col(row) == F.col("__hit_row")).drop("__hit_row", row)
    return joined.withColumn(out, F.col(match)).drop(match)


def _overlap(n_words: Column, spans: Column, items: Column) -> Column:
    length = F.transform(spans, lambda s: s["b"] - s["a"])
    return F.struct(
        n_words.alias("n_words"), F.aggregate(length, F.lit(0).cast("long"), lambda x, y: x + y).alias("n_hit"),
        F.coalesce(F.array_max(length), F.lit(0)).alias("longest"), spans.alias("spans"), items.alias("items"))


def contaminated(overlap: str = "overlap", longest_limit: int | None = None):
    """The coverage limit (a twentieth of the words), or a hit span longer than ``longest_limit`` words."""
    rule = (F.col(f"{overlap}.n_hit") > 0) & (20 * F.col(f"{overlap}.n_hit") >= F.col(f"{overlap}.n_words"))
    return rule if longest_limit is None else rule | (F.col(f"{overlap}.longest") > longest_limit)


def without(text: str | None, spans: Sequence[tuple[int, int]]) -> str | None:
    """``text`` less the words of ``spans`` (disjoint, in order) and what stands between them; words are walked one at a time."""
    if text is None or not spans:
        return text
    out, end, at = [], 0, 0
    lowered = text.translate(LOWER)  # as long as the text, letter by letter
    todo = iter(spans)
    a, b = next(todo)
    for m in WORD.finditer(lowered):
        if at == a:
            out.append(text[end:m.start()])
        at += 1
        if at == b:
            end = m.end()
            a, b = next(todo, (-1, -1))
            if a < 0:
                break
    return "".join(out) + text[end:]


def remove_spans(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, min_words: int = WINDOW,
                 block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``docs`` with ``text`` less the hit spans of at least ``min_words`` words (other rows unchanged).

    Null and empty texts stay as they are; repeated rows are cut alike; a text of nothing but hits becomes empty."""
    @F.arrow_udf("string")
    def cut(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for texts, spans in batches:
            yield pa.array([without(t.as_py(), [(s["a"], s["b"]) for s in (x.as_py() or ()) if s["b"] - s["a"] >= min_words])
                            for t, x in zip(texts, spans)], pa.string())

    found = find_overlap(docs, benchmark, window, overlap := fresh(docs, "__overlap"), block_bytes)
    text = F.col("text").cast("string")
    return found.withColumn("text", F.when(F.col(f"{overlap}.n_hit") > 0, cut(text, F.col(f"{overlap}.spans"))).otherwise(text)).drop(overlap)


def op8_suffix_automaton_decontamination(spark, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    found = find_overlap(docs, table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "overlap.n_words", "overlap.n_hit", F.size("overlap.items").cast("long").alias("n_items"),
        F.sha2(F.array_join("overlap.items", ",").cast("binary"), 256).alias("items_sha256"),
        contaminated().alias("contaminated"))


_UP = "".join(map(chr, LOWER))
_LOW = _UP.lower()
OVERLAP_SQL = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id,
        regexp_extract_all(translate(COALESCE(text, ''), '{_UP}', '{_LOW}'), '{WORD.pattern}') AS w FROM documents),
b AS (SELECT row_number() OVER () AS item, COALESCE(CAST(item_id AS VARCHAR), '') AS id,
        regexp_extract_all(translate(COALESCE(text, ''), '{_UP}', '{_LOW}'), '{WORD.pattern}') AS w FROM benchmark),
s AS (SELECT item, id, w, least(len(w), 13) AS size FROM b WHERE len(w) > 0),
g AS (SELECT DISTINCT item, id, size, array_to_string(w[i:i + size - 1], ' ') AS gram
      FROM (SELECT *, unnest(range(1, len(w) - size + 2)) AS i FROM s)),
p AS (SELECT r, size, i, array_to_string(w[i:i + size - 1], ' ') AS gram
      FROM (SELECT r, w, size, unnest(range(1, len(w) - size + 2)) AS i
            FROM d, (SELECT DISTINCT size FROM g) WHERE len(w) >= size)),
h AS (SELECT p.r, p.i, p.size, g.item, g.id FROM p JOIN g ON p.size = g.size AND p.gram = g.gram),
n AS (SELECT r, COUNT(DISTINCT pos) AS n_hit FROM (SELECT r, unnest(range(i, i + size)) AS pos FROM h) GROUP BY r),
f AS (SELECT r, COUNT(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
      FROM (SELECT DISTINCT r, item, id FROM h) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, COALESCE(n_hit, 0) AS n_hit, COALESCE(n_items, 0) AS n_items,
  sha256(COALESCE(ids, '')) AS items_sha256, COALESCE(n_hit, 0) > 0 AND 20 * COALESCE(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN n USING (r) LEFT JOIN f USING (r)"""
