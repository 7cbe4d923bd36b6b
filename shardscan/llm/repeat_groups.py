"""Maximal repeats with all their occurrences, by a common-prefix interval tree over an enhanced suffix array.

A string of ``length`` bytes or more that stands in several places is a *maximal repeat* if its places do not
all have the same byte before them, nor all the same byte after them (a text's begin and end differ from
every byte).  All of them are found, nested ones too, each with every place, by one path for every size:

1. Equal texts are one class; a class of several documents repeats all its strings.
2. Every ``length``-byte string that shares its anchor (see ``repeats``) with another one is named by 128 bits; names
   are counted with partial aggregation.  Repeated strings at neighbouring places form a *run*: no repeat leaves one.
3. A maximal repeat begins where the string's places differ to the left, so only such places become suffixes, cut
   at the end of their run.  A shared passage has one such place in each text, not one a byte.
4. Equal suffixes are one *kind* (128-bit polynomial hash and length).  One place of each kind brings its bytes, in
   pieces of 4 KB, doubled to 1 MB, only while several kinds agree so far.  The sorted pieces under one name
   are a suffix array; they stream through a stack scan of common prefixes, which holds the open intervals only.
   An interval is kept if the bytes to the left of its places differ.
5. Intervals are joined with their kinds, kinds with their places, classes with their documents, by Spark.

Defined results: null text has no bytes; texts shorter than ``length`` are in no group; rows equal in id and text are
one document; an empty table gives no groups; other columns are ignored.  The result lists every
place of every nested repeat: for text of one period (``aaaa``) that is the square of its length.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shardscan.llm.common import python_tasks, texts, written
from shardscan.llm.repeats import GRAM, LENGTH, ROWS, _strings, anchor_rows, mix_rows

PIECE = 4096
MOST = 1 << 20
BLOCK = 1 << 16
PRIME = (1 << 31) - 1
#: Bases of the polynomial hashes, below PRIME.
BASES = (1_103_515_245, 747_796_405, 1_597_334_677, 1_181_783_497)

STRINGS = "a long, b long, doc long, start long, left_byte int"
SUFFIXES = "a long, b long, doc long, start long, size long, left_byte int, p long, q long"
TREE = "what int, a long, b long, lo long, hi long, size long, kind long"


def _batch(schema: list[tuple[str, pa.DataType]], cols) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(cols, schema)], names=[n for n, _ in schema])


_I64 = pa.int64()
_STRINGS = [("a", _I64), ("b", _I64), ("doc", _I64), ("start", _I64), ("left_byte", pa.int32())]
_SUFFIXES = [("a", _I64), ("b", _I64), ("doc", _I64), ("start", _I64), ("size", _I64), ("left_byte", pa.int32()), ("p", _I64), ("q", _I64)]
_TREE = [("what", pa.int32()), *((c, _I64) for c in ("a", "b", "lo", "hi", "size", "kind"))]


def string_names(batches: Iterator[pa.RecordBatch], length: int = LENGTH) -> Iterator[pa.RecordBatch]:
    """(doc, text, ranges) -> every string of the ranges with its name and the byte before it (-1: none)."""
    head = -(-length // 8) * 8
    for b in batches:
        for doc, text, ranges in zip(b.column("doc").to_pylist(), texts(b.column("text")), b.column("ranges").to_pylist()):
            raw = np.frombuffer(text + bytes(head), np.uint8)
            at = np.array([(r["start"], r["stop"]) for r in ranges], np.int64).reshape(-1, 2)
            at = np.unique(at, axis=0)
            part, place = _strings(at[:, 1] - at[:, 0], length)
            start = np.unique(at[part, 0] + place)
            for i in range(0, len(start), BLOCK):
                s = start[i:i + BLOCK]
                rows = np.lib.stride_tricks.sliding_window_view(raw, head)[s]
                rows[:, length:] = 0
                left = np.where(s > 0, raw[s - 1].astype(np.int32), -1)
                yield _batch(_STRINGS, (mix_rows(rows, 5).view(np.int64), mix_rows(rows, 7).view(np.int64),
                                        np.full(len(s), doc), s, left))


def run_ends(batches: Iterator[pa.RecordBatch], length: int = LENGTH) -> Iterator[pa.RecordBatch]:
    """Repeated strings sorted by (doc, start falling) -> those that may begin a maximal repeat, with the end of their run."""
    last_doc = last_start = stop = None
    for b in batches:
        doc, start = b.column("doc").to_numpy(), b.column("start").to_numpy()
        if not len(doc):
            continue
        new = np.concatenate(([(doc[0], start[0] + 1) != (last_doc, last_start)],
                              (doc[1:] != doc[:-1]) | (start[1:] + 1 != start[:-1])))
        ends = np.concatenate(([0 if stop is None else stop], start[new] + length))[np.cumsum(new)]
        last_doc, last_start, stop = doc[-1], start[-1], ends[-1]
        out = b.append_column("stop", pa.array(ends, pa.int64()))
        yield out.filter(b.column("diverse")).select(["a", "b", "doc", "start", "stop", "left_byte"])


def _powers(base: int, n: int) -> np.ndarray:
    """base ** 0 .. base ** (n - 1) modulo PRIME."""
    out = np.ones(max(n, 1), np.int64)
    done = 1
    while done < n:
        out[done:2 * done] = out[:min(done, n - done)] * pow(base, done, PRIME) % PRIME
        done *= 2
    return out


def suffix_hashes(text: bytes, start: np.ndarray, stop: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two numbers per byte range, of two polynomial hashes each, from one pass over the text."""
    raw = np.frombuffer(text, np.uint8).astype(np.int64) + 1
    out = []
    for base in BASES:
        sums = np.concatenate(([0], np.cumsum(raw * _powers(base, len(raw)) % PRIME)))  # below 2 ** 63 for 4 GB
        back = _powers(pow(base, -1, PRIME), len(raw) + 1)
        out.append((sums[stop] - sums[start]) % PRIME * back[start] % PRIME)
    return (out[0] << 31) | out[1], (out[2] << 31) | out[3]


def suffix_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc, text, begins) -> the suffixes of the text with their sizes and hashes."""
    for b in batches:
        for doc, text, begins in zip(b.column("doc").to_pylist(), texts(b.column("text")), b.column("begins").to_pylist()):
            col = {c: np.array([x[c] for x in begins], np.int64) for c in ("a", "b", "start", "stop", "left_byte")}
            p, q = suffix_hashes(text, col["start"], col["stop"])
            yield _batch(_SUFFIXES, (col["a"], col["b"], np.full(len(p), doc), col["start"], col["stop"] - col["start"],
                                     col["left_byte"].astype(np.int32), p, q))


_PIECES = [("a", _I64), ("b", _I64), ("kind", _I64), ("size", _I64), ("many", pa.bool_()), ("least", pa.int32()), ("most", pa.int32()),
           ("piece", pa.binary())]
PIECES = "a long, b long, kind long, size long, many boolean, least int, most int, piece binary"


def piece_rows(batches: Iterator[pa.RecordBatch], at: int, cut: int) -> Iterator[pa.RecordBatch]:
    """(doc, text, wants) -> bytes at .. at + cut of every wanted suffix."""
    for b in batches:
        for text, wants in zip(texts(b.column("text")), b.column("wants").to_pylist()):
            for i in range(0, len(wants), 256):
                some = wants[i:i + 256]
                piece = [text[w["start"] + at:w["start"] + min(at + cut, w["size"])] for w in some]
                yield _batch(_PIECES, [[w[c] for w in some] for c, _ in _PIECES[:-1]] + [piece])


def common_prefix(x: bytes, y: bytes) -> int:
    n = min(len(x), len(y))
    if x[:n] == y[:n]:
        return n
    lo, hi = 0, n  # the first lo bytes agree, the first hi do not
    while hi - lo > 1:
        mid = (lo + hi) // 2
        lo, hi = (mid, hi) if x[lo:mid] == y[lo:mid] else (lo, mid)
    return lo


class Interval:
    """Places [lo, ..] of the suffix array with a common prefix of ``size``; least and greatest byte to the left."""

    __slots__ = ("size", "lo", "least", "most")

    def __init__(self, size: int, lo: int, least: int, most: int):
        self.size, self.lo, self.least, self.most = size, lo, least, most

    def take(self, x: Interval) -> None:
        self.least, self.most = min(self.least, x.least), max(self.most, x.most)

    def maximal(self) -> bool:
        return self.least < 0 or self.least != self.most


class Scan:
    """The suffix array of one name, place by place.  A place holds one suffix, or several that agree over the whole
    piece and are told apart in the next round."""

    def __init__(self, a: int, b: int, at: int, cut: int, out: list):
        self.a, self.b, self.at, self.cut, self.out = a, b, at, cut, out
        self.stack: list[Interval] = []
        self.n = 0
        self.piece: bytes | None = None
        self.held: list[tuple] = []  # the first suffixes of the current place
        self.last: Interval | None = None  # the current place by itself
        self.tag: tuple[int, int] | None = None

    def add(self, kind: int, size: int, many: bool, least: int, most: int, piece: bytes) -> None:
        if self.piece is not None and piece == self.piece and len(piece) == self.cut:
            if self.tag is None:
                name = hashlib.blake2b(b"%d:%d:" % (self.a, self.b) + piece, digest_size=16).digest()
                self.tag = tuple(np.frombuffer(name, np.int64).tolist())
                self.next(self.held[0])
                self.last.size = -1  # its own interval is found in the next round
            self.last.take(Interval(0, self.n, least, most))
            self.next(kind)
        else:
            shared = None if self.piece is None else common_prefix(self.piece, piece)
            if shared is not None:
                self.close(self.at + shared)
            self.piece, self.tag, self.held = piece, None, [kind]
            # several equal suffixes are an interval as long as they are
            self.last = Interval(size if many else -1, self.n, least, most)
        self.out.append((1, self.a, self.b, self.n, self.n, 0, kind))
        self.n += 1

    def next(self, kind: int) -> None:
        self.out.append((2, *self.tag, 0, 0, 0, kind))

    def close(self, shared: int) -> None:
        """End the intervals deeper than ``shared``, the common prefix with the suffix that comes now (-1: none)."""
        now = self.last
        if now.size >= 0 and now.size != shared:
            self.put(now)
        while self.stack and self.stack[-1].size > shared:
            top = self.stack.pop()
            top.take(now)
            self.put(top)
            now = Interval(-1, top.lo, top.least, top.most)
        if shared >= 0:
            if self.stack and self.stack[-1].size == shared:
                self.stack[-1].take(now)
            else:
                self.stack.append(Interval(shared, now.lo, now.least, now.most))

    def put(self, x: Interval) -> None:
        if x.maximal():
            self.out.append((0, self.a, self.b, x.lo, self.n - 1, x.size, 0))

    def end(self) -> None:
        if self.last is not None:
            self.close(-1)


def tree_rows(batches: Iterator[pa.RecordBatch], at: int, cut: int) -> Iterator[pa.RecordBatch]:
    """Pieces sorted by (name, bytes) -> 0: maximal intervals, 1: the kind at each place, 2: kinds that go on, with
    the name of what they share."""
    scan, out = None, []
    for b in batches:
        for a, name, kind, size, many, least, most, piece in zip(*(b.column(c).to_pylist() for c, _ in _PIECES)):
            if scan is None or (scan.a, scan.b) != (a, name):
                if scan is not None:
                    scan.end()
                scan = Scan(a, name, at, cut, out)
            scan.add(kind, size, many, least, most, piece)
        if out:
            yield _batch(_TREE, list(zip(*out)))
            out.clear()
    if scan is not None:
        scan.end()
    if out:
        yield _batch(_TREE, list(zip(*out)))


def _counted() -> list:
    return [F.count(F.lit(1)).alias("n"), F.max(F.col("doc").bitwiseAND(F.lit(1))).alias("twin")]


def _several():
    """In two places, or in a class of two documents."""
    return (F.col("n") > 1) | (F.col("twin") > 0)


def repeat_groups(docs: DataFrame, length: int = LENGTH, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every maximal repeat of ``length`` bytes or more with all its places: ``group_id, n_bytes, doc_id, start``
    (start in bytes), one row each.  ``length`` is more than 32, the bytes of an anchor."""
    if length <= GRAM:
        raise ValueError(f"length must be above {GRAM}")
    python_tasks(docs.sparkSession)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).where(
        F.octet_length("text") >= length)
    members = written(rows.select("doc_id", F.sha2("text", 256).alias("t")).distinct(), "members")
    sizes = members.groupBy("t").count()
    # a class's number is odd if several documents have its text
    number = (F.monotonically_increasing_id() * 2 + (F.col("count") > 1).cast("long")).alias("doc")
    one = rows.withColumn("t", F.sha2("text", 256)).dropDuplicates(["t"]).join(sizes, "t").select(number, "t", "text")
    text = written(one, "texts")

    def anchors(batches):
        return anchor_rows(batches, length, every=True)

    def names(batches):
        return string_names(batches, length)

    def runs(batches):
        return run_ends(batches, length)

    cuts = written(text.select("doc", "text").mapInArrow(anchors, ROWS).select("h", "doc", "loc"), "cuts")
    shared = cuts.groupBy("h").agg(*_counted()).where(_several()).select("h")
    start = F.shiftright("loc", 16)
    size = F.shiftright("loc", 9).bitwiseAND(F.lit(127)) + length
    wanted = cuts.join(shared, "h").groupBy("doc").agg(
        F.collect_list(F.struct(start.alias("start"), (start + size).alias("stop"))).alias("ranges"))
    strings = written(text.select("doc", "text").join(wanted, "doc").mapInArrow(names, STRINGS), "strings")
    repeated = strings.groupBy("a", "b").agg(
        *_counted(), F.min("left_byte").alias("least"), F.max("left_byte").alias("most")).where(
        _several()).select("a", "b", ((F.col("least") < 0) | (F.col("least") != F.col("most"))).alias("diverse"))
    begins = strings.join(repeated, ["a", "b"]).repartition("doc").sortWithinPartitions(
        "doc", F.desc("start")).mapInArrow(runs, "a long, b long, doc long, start long, stop long, left_byte int")
    begins = begins.groupBy("doc").agg(F.collect_list(F.struct("a", "b", "start", "stop", "left_byte")).alias("begins"))
    suffixes = written(text.select("doc", "text").join(begins, "doc").mapInArrow(suffix_rows, SUFFIXES), "suffixes")
    same = ["a", "b", "size", "p", "q"]
    kinds = written(suffixes.groupBy(*same).agg(
        *_counted(), F.min("left_byte").alias("least"), F.max("left_byte").alias("most"),
        F.min(F.struct("doc", "start")).alias("at")).select(
        *same, _several().alias("many"), "least", "most", "at.doc", "at.start",
        F.monotonically_increasing_id().alias("kind")), "kinds")
    groups = _intervals(text, kinds)
    places = suffixes.join(kinds.select(*same, "kind"), same).select("kind", "doc", "start")
    found = groups.join(places, "kind").join(text.select("doc", "t"), "doc").join(members, "t")
    return found.select("group_id", "n_bytes", "doc_id", "start")


def _intervals(text: DataFrame, kinds: DataFrame) -> DataFrame:
    """``group_id, n_bytes, kind``: the maximal intervals of all suffix arrays, a row for each kind in them."""
    todo = kinds.select("kind", "a", "b")
    trees, at, cut = [], 0, PIECE
    while True:
        def pieces(batches, at=at, cut=cut):
            return piece_rows(batches, at, cut)

        def tree(batches, at=at, cut=cut):
            return tree_rows(batches, at, cut)

        wants = todo.join(kinds.drop("a", "b"), "kind").groupBy("doc").agg(F.collect_list(
            F.struct("a", "b", "kind", "size", "many", "least", "most", "start")).alias("wants"))
        got = written(text.select("doc", "text").join(wants, "doc").mapInArrow(pieces, PIECES).repartition(
            "a", "b").sortWithinPartitions("a", "b", "piece").mapInArrow(tree, TREE), "tree")
        trees.append(got)
        todo = got.where("what = 2").select("kind", "a", "b")
        at, cut = at + cut, min(2 * cut, MOST)
        if todo.isEmpty():
            break
    every = trees[0]
    for t in trees[1:]:
        every = every.unionByName(t)
    step = 4096
    block = F.explode(F.expr(f"sequence(lo, hi, {step}L)")).alias("first")
    inside = every.where("what = 0").select("a", "b", "hi", "size", F.sha2(F.concat_ws(":", "a", "b", "lo", "hi", "size"), 256).alias(
        "group_id"), block).select("a", "b", "group_id", F.col("size").alias("n_bytes"),
                                   F.explode(F.expr(f"sequence(first, least(hi, first + {step - 1}L))")).alias("lo"))
    return inside.join(every.where("what = 1").select("a", "b", "lo", "kind"), ["a", "b", "lo"]).select("group_id", "n_bytes", "kind")
