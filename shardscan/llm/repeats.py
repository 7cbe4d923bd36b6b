"""Repeated passages by a common-prefix interval tree over an enhanced suffix array.

A byte is removed if a ``length``-byte string that covers it also starts earlier.
Suffixes of all texts would be far more than the texts themselves, so they are
first split by content: every ``length``-byte string has one *anchor*, the
``GRAM`` bytes inside it whose hash is least (rightmost on ties).  Equal strings have the same
anchor at the same place, so they meet under their anchor's hash wherever
they stand; the neighbouring strings that share an anchor form one *segment*.

1. Segments (anchor hash, 64-bit hash of all their bytes, id, place) are compared
   within each task first and then across tasks: of equal segments all but
   the earliest are removed.  Rows are streamed in sorted order; nothing is gathered.
2. An anchor with different segments is *contested*: the earliest of each
   kind bring their bytes, and each group of them gets an enhanced suffix
   array: sorted suffixes, common-prefix lengths, and a stack scan that
   yields the interval tree.  An interval of ``length`` or more is a repeat; it is maximal
   if the bytes to the left differ (an interval with one left byte is covered
   by the one that includes it).  Every occurrence but the earliest is
   removed: an occurrence stops being the earliest in exactly one interval, the
   deepest, so the scan emits each at most once, whatever the nesting.
3. A group of more than ``GROUP`` kinds (a passage that a third of all texts share, in as
   many surroundings) would be unbounded in one task.  Its segments are cut into their strings,
   the intervals of depth ``length`` of the tree, which are named by a 128-bit hash; equal names
   are compared the way segments are in step 1: combined in each task, then streamed.
   An anchor with more than ``HOT`` kinds in one task is spread over salts on the way to step 2.

Defined results: null text has no bytes; texts shorter than ``length`` lose nothing; rows that
repeat an id and a text are one document and share its result; different
texts under one id (or without id: last) are ordered by their md5; an empty
table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shardscan.llm.common import documents, python_tasks, utf8_parts, written

LENGTH = 100
GRAM = 32
HOT = 1024
GROUP = 4096
SALTS = 64
CHUNK = 4 << 20
KEEP = 1 << 21
MARK = -(1 << 63)
_M1, _M2, _M3 = np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53), np.uint64(0x9E3779B97F4A7C15)


def mix_rows(rows: np.ndarray, seed: int) -> np.ndarray:
    """64-bit hash of every row of a uint8 matrix whose width is a multiple of 8."""
    words = np.ascontiguousarray(rows).view(np.uint64)
    out = np.full(len(words), np.uint64(seed * int(_M3) % (1 << 64)), np.uint64)
    for j in range(words.shape[1]):
        x = words[:, j] + np.uint64((seed * 1315423911 + j * 2654435761 + 1) * int(_M3) % (1 << 64))
        x ^= x >> np.uint64(32)
        x *= _M1
        x ^= x >> np.uint64(29)
        x *= _M2
        x ^= x >> np.uint64(32)
        out = (out ^ x) * _M3
        out ^= out >> np.uint64(31)
    return out


def _padded(raw: np.ndarray, start: np.ndarray, size: np.ndarray, width: int) -> np.ndarray:
    """Rows raw[start:start + size], padded by zeros to ``width`` (``raw`` has that much after its end)."""
    rows = np.lib.stride_tricks.sliding_window_view(raw, width)[start]
    rows[np.arange(width)[None] >= size[:, None]] = 0
    return rows


def _least(key: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every window of ``width`` values."""
    done = 1
    while done * 2 <= width:
        key = np.minimum(key[:-done], key[done:])
        done *= 2
    return key if done == width else np.minimum(key[:done - width], key[width - done:])


def segments(raw: np.ndarray, begin: np.ndarray, end: np.ndarray, length: int = LENGTH):
    """Segments of the texts [begin, end) of ``raw`` (in order, apart or touching):
    (text, first start, last start, anchor), places in ``raw``."""
    span = length - GRAM + 1
    none = np.zeros(0, np.int64)
    if len(raw) < length:
        return none, none, none, none
    with np.errstate(over="ignore"):
        h = (raw.astype(np.uint32) + np.uint32(1)) * np.uint32(0x9E3779B1)
        step = 1
        while step < GRAM:
            h = (h[:-step] * np.uint32(0x85EBCA6B)) ^ (h[step:] + (h[step:] >> np.uint32(15)) * np.uint32(0xC2B2AE35))
            h ^= h >> np.uint32(13)
            h *= np.uint32(0x27D4EB2F)
            step *= 2
    n = len(h)
    key = (h.astype(np.uint64) << np.uint64(32)) | (np.uint64(0xFFFFFFFF) - np.arange(n, dtype=np.uint64))
    least = _least(key, span)
    starts = np.maximum(end - begin - length + 1, 0)
    text = np.repeat(np.arange(len(begin)), starts)
    if not len(text):
        return none, none, none, none
    s = np.arange(len(text)) - np.repeat(np.cumsum(starts) - starts, starts) + begin[text]
    anchor = (np.uint64(0xFFFFFFFF) - (least[s] & np.uint64(0xFFFFFFFF))).astype(np.int64)
    new = np.flatnonzero((anchor[1:] != anchor[:-1]) | (text[1:] != text[:-1])) + 1
    first = np.concatenate(([0], new))
    last = np.concatenate((new, [len(s)])) - 1
    return text[first], s[first], s[last], anchor[first]


def _merge(doc: np.ndarray, start: np.ndarray, stop: np.ndarray):
    """Union of byte ranges per document."""
    order = np.lexsort((start, doc))
    doc, start, stop = doc[order], start[order], stop[order]
    if not len(doc):
        return doc, start, stop
    # running maximum of stops within a document
    group = np.cumsum(np.concatenate(([0], (doc[1:] != doc[:-1]).astype(np.int64))))
    reach = np.maximum.accumulate(stop + group * (1 << 40)) - group * (1 << 40)
    new = np.concatenate(([True], (doc[1:] != doc[:-1]) | (start[1:] > reach[:-1])))
    first = np.flatnonzero(new)
    return doc[first], start[first], np.maximum.reduceat(stop, first)


def _pack(start, span, off, removed=0, hot=0):
    return (start.astype(np.int64) << 16) | (span.astype(np.int64) << 9) | (off.astype(np.int64) << 2) | (removed << 1) | hot


ROWS = "h long, g long, doc long, loc long"


def _rows(h, g, doc, loc) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(np.asarray(x, np.int64)) for x in (h, g, doc, loc)],
                                      names=["h", "g", "doc", "loc"])


def _removed_rows(doc, start, stop) -> pa.RecordBatch:
    """Byte ranges to remove, as rows that pass the class scan (spread by id)."""
    doc, start, stop = _merge(doc, start, stop)
    zero = np.zeros(len(doc), np.int64)
    with np.errstate(over="ignore"):
        spread = (doc.astype(np.uint64) * _M1).view(np.int64)
    return _rows(spread, stop, doc, _pack(start, zero, zero, removed=1))


def combine(h, g, doc, loc, length: int, hot_kinds: int | None) -> Iterator[pa.RecordBatch]:
    """Equal segments of one task: the earliest goes on, the others are removed here.  Anchors with more
    than ``hot_kinds`` kinds go on as hot, with one marker row."""
    order = np.lexsort((loc, doc, g, h))
    h, g, doc, loc = h[order], g[order], doc[order], loc[order]
    if not len(h):
        return
    kind = np.concatenate(([True], (h[1:] != h[:-1]) | (g[1:] != g[:-1])))
    first = np.flatnonzero(kind)[np.cumsum(kind) - 1]
    late = ~kind & ((doc != doc[first]) | (loc != loc[first]))
    start = loc[late] >> 16
    yield _removed_rows(doc[late], start, start + ((loc[late] >> 9) & 127) + length)
    h, g, doc, loc = h[kind], g[kind], doc[kind], loc[kind]
    if hot_kinds is not None:
        edge = np.concatenate(([True], h[1:] != h[:-1]))
        at = np.flatnonzero(edge)
        size = np.diff(np.concatenate((at, [len(h)])))
        loc = loc | np.repeat((size > hot_kinds).astype(np.int64), size)
        marked = h[at[size > hot_kinds]]
        m = len(marked)
        yield _rows(marked, np.full(m, MARK), np.full(m, -1), np.zeros(m))
    yield _rows(h, g, doc, loc)


def anchor_rows(batches: Iterator[pa.RecordBatch], length: int = LENGTH, every: bool = False) -> Iterator[pa.RecordBatch]:
    """(doc, text) -> segment rows, combined per ``KEEP`` segments (with ``every``: not combined)."""
    width = -(-(2 * length - GRAM + 1) // 8) * 8
    held: list[tuple] = []
    size = 0

    def flush():
        cols = [np.concatenate([x[i] for x in held]) for i in range(4)]
        return [_rows(*cols)] if every else combine(*cols, length, HOT)

    for b in batches:
        raw, off, null = utf8_parts(b.column("text"))
        doc = b.column("doc").to_numpy()
        end_of = np.where(null, off[:-1], off[1:])
        # pieces of at most CHUNK starts; a piece of a long text takes the length - 1 bytes after it along
        pieces: list[tuple[int, int, int]] = []
        for i in np.flatnonzero(end_of - off[:-1] >= length).tolist():
            for a in range(int(off[i]), int(end_of[i]) - length + 1, CHUNK):
                pieces.append((i, a, min(int(end_of[i]), a + CHUNK + length - 1)))
        at = 0
        while at < len(pieces):
            to, total = at, 0
            while to < len(pieces) and (total == 0 or total + pieces[to][2] - pieces[to][1] <= CHUNK):
                total += pieces[to][2] - pieces[to][1]
                to += 1
            part = pieces[at:to]
            at = to
            sizes = np.array([p[2] - p[1] for p in part])
            joined = np.concatenate([raw[p[1]:p[2]] for p in part] + [np.zeros(width, np.uint8)])
            ends = np.cumsum(sizes)
            begins = ends - sizes
            text, first, last, anchor = segments(joined[:-width], begins, ends, length)
            if not len(text):
                continue
            gram = np.lib.stride_tricks.sliding_window_view(joined, GRAM)[anchor]
            h = mix_rows(gram, 1)
            bytes_of = last - first + length
            g = mix_rows(_padded(joined, first, bytes_of, width), 2)
            with np.errstate(over="ignore"):  # length and place of the anchor belong to the kind
                g = (g ^ ((bytes_of.astype(np.uint64) << np.uint64(8)) | (anchor - first).astype(np.uint64))) * _M2
                g ^= g >> np.uint64(33)
            source = np.array([p[0] for p in part])[text]
            base = np.array([p[1] for p in part])[text] - off[source]
            g = g.view(np.int64)
            g[g == MARK] = MARK + 1
            held.append((h.view(np.int64), g, doc[source],
                         _pack(first - begins[text] + base, last - first, anchor - first)))
            size += len(text)
            if size >= KEEP:
                yield from flush()
                held.clear()
                size = 0
    if held:
        yield from flush()


FOUND = "kind int, h long, doc long, start long, stop long"


def _found(kind, h, doc, start, stop) -> pa.RecordBatch:
    n = len(doc)
    return pa.RecordBatch.from_arrays(
        [pa.array(np.full(n, kind, np.int32)), *(pa.array(np.asarray(x, np.int64)) for x in (h, doc, start, stop))],
        names=["kind", "h", "doc", "start", "stop"])


class _Group:
    """The kinds of the anchor being streamed: at most ``GROUP`` of them are held."""

    def __init__(self, h: int = 0):
        self.h, self.hot, self.parts, self.size = h, False, [], 0

    def add(self, doc: np.ndarray, loc: np.ndarray, hot: bool, length: int) -> Iterator[pa.RecordBatch]:
        self.parts.append((doc, loc))
        self.size += len(doc)
        self.hot |= hot or self.size > GROUP
        if self.hot:
            yield from self.out(2, length)

    def out(self, kind: int, length: int) -> Iterator[pa.RecordBatch]:
        doc, loc = (np.concatenate([p[i] for p in self.parts]) if self.parts else np.zeros(0, np.int64) for i in (0, 1))
        real = doc >= 0  # not the marker row
        self.parts = []
        if real.any():
            doc, loc = doc[real], loc[real]
            yield _found(kind, np.full(len(doc), self.h), doc, loc >> 16, (loc >> 16) + ((loc >> 9) & 127) + length)

    def close(self, length: int) -> Iterator[pa.RecordBatch]:
        if not self.hot and self.size > 1:
            yield from self.out(1, length)


def class_scan(batches: Iterator[pa.RecordBatch], length: int = LENGTH, contest: bool = True) -> Iterator[pa.RecordBatch]:
    """Stream rows sorted by (h, g, doc, loc).  Kind 0: byte ranges to remove.  Kind 1: the earliest segment
    of every kind of an anchor that has several.  Kind 2: the same for anchors with too many for one group."""
    head = None  # (h, g, doc, loc) of the current kind's earliest
    group = _Group()
    for b in batches:
        h, g, doc, loc = (b.column(i).to_numpy() for i in range(4))
        done = (loc >> 1) & 1 == 1
        if done.any():
            d, s, e = _merge(doc[done], loc[done] >> 16, g[done])
            yield _found(0, np.zeros(len(d)), d, s, e)
            h, g, doc, loc = h[~done], g[~done], doc[~done], loc[~done]
        if not len(h):
            continue
        new_h = np.concatenate(([head is None or h[0] != head[0]], h[1:] != h[:-1]))
        new = new_h | np.concatenate(([head is None or g[0] != head[1]], g[1:] != g[:-1]))
        at = np.flatnonzero(new)
        place = np.cumsum(new)  # 0: the kind that goes on from the batch before
        fd, fl = (np.concatenate(([0 if head is None else head[i]], x[at])) for i, x in ((2, doc), (3, loc)))
        late = ~new & (doc >= 0) & ((doc != fd[place]) | ((loc | 1) != (fl[place] | 1)))
        s = loc[late] >> 16
        d, s, e = _merge(doc[late], s, s + ((loc[late] >> 9) & 127) + length)
        yield _found(0, np.zeros(len(d)), d, s, e)
        if not len(at):
            continue
        head = (h[at[-1]], g[at[-1]], doc[at[-1]], loc[at[-1]])
        if contest:
            edge = np.flatnonzero(new_h[at])
            bounds = np.concatenate(([0], edge, [len(at)]))
            sizes = np.diff(bounds)
            # anchors that begin and end inside this batch with one kind need nothing; the others one by one
            inner = np.arange(len(sizes))
            busy = (sizes > 1) | (inner == 0) | (inner == len(sizes) - 1) | np.add.reduceat(
                np.concatenate((loc[at] & 1, [0])), np.minimum(bounds[:-1], len(at))).astype(bool)
            for k in np.flatnonzero(busy).tolist():
                if k > 0:
                    yield from group.close(length)
                    group = _Group(int(h[at[bounds[k]]]))
                rows = at[bounds[k]:bounds[k + 1]]
                if len(rows):
                    hot = bool((loc[rows] & 1).any() or ((g[rows] == MARK) & (doc[rows] < 0)).any())
                    yield from group.add(doc[rows], loc[rows], hot, length)
    if contest:
        yield from group.close(length)


def common_prefixes(rows: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Common prefix of each row with the one before it (0 for the first)."""
    out = np.zeros(len(rows), np.int64)
    if len(rows) > 1:
        differ = rows[1:] != rows[:-1]
        at = np.where(differ.any(axis=1), differ.argmax(axis=1), rows.shape[1])
        out[1:] = np.minimum(at, np.minimum(size[1:], size[:-1]))
    return out


def interval_tree(lcp: np.ndarray, left: np.ndarray, rank: np.ndarray, length: int):
    """Stack scan over the common prefixes of sorted suffixes.

    Yields ``(prefix, lo, hi, maximal, earliest, late)`` for every interval [lo, hi] of suffixes with a
    common prefix of at least ``length``, children before parents: ``maximal`` if the bytes to
    the left differ (-1: none, always different), ``earliest`` the suffix of least rank, ``late`` those
    that were the earliest of a part of it and are not of the whole."""
    n = len(lcp)
    # of an open interval: prefix, lo, left byte (None: several), earliest, the late ones
    stack: list[list] = []
    values = lcp.tolist() + [0]
    for i in range(1, n + 1):
        now = values[i] if i < n else 0
        if now < length:
            now = 0
        side = int(left[i - 1])
        piece = [None, i - 1, side if side >= 0 else None, i - 1, []]  # the suffix before place i, by itself
        while stack and stack[-1][0] > now:
            top = stack.pop()
            _absorb(top, piece, rank)
            yield top[0], top[1], i - 1, top[2] is None, top[3], top[4]
            piece = [None, top[1], top[2], top[3], []]
        if now:
            if stack and stack[-1][0] == now:
                _absorb(stack[-1], piece, rank)
            else:
                stack.append([now, piece[1], piece[2], piece[3], []])


def _absorb(into: list, piece: list, rank) -> None:
    if into[2] != piece[2]:
        into[2] = None
    a, b = into[3], piece[3]
    if a != b:
        keep, lose = (a, b) if rank[a] <= rank[b] else (b, a)
        into[3] = keep
        into[4].append(lose)


def maximal_repeats(parts: list[tuple[bytes, int, int, int]], length: int = LENGTH):
    """Maximal repeats among ``parts`` (bytes, left byte or -1, doc, start of the bytes in doc).

    Yields ``(prefix, doc, start, late)``: the repeat's length, the documents and places of all its occurrences
    (views, nothing is copied), and which of them stop being the earliest in this interval: those that lead a
    part of it and not the whole."""
    width = -(-max([len(p[0]) for p in parts] + [8]) // 8) * 8
    sizes = np.array([len(p[0]) for p in parts], np.int64)
    which, at = _strings(sizes, length)
    if not len(which):
        return
    joined = np.frombuffer(b"".join(p[0] for p in parts) + bytes(width), np.uint8)
    base = np.cumsum(sizes) - sizes
    size = sizes[which] - at
    # suffixes whose first ``length`` bytes stand nowhere else are in no interval: out before the sort
    head = -(-length // 8) * 8
    first = _padded(joined, base[which] + at, np.full(len(which), length), head)
    name = mix_rows(first, 3)
    _, back, seen = np.unique(name, return_inverse=True, return_counts=True)
    stay = seen[back.ravel()] > 1
    which, at, size = which[stay], at[stay], size[stay]
    if not len(which):
        return
    rows = _padded(joined, base[which] + at, size, width)
    # the real end sorts before any byte: order by (bytes, size)
    order = np.lexsort(np.vstack([size[None].astype(np.uint64),
                                  np.ascontiguousarray(rows).view(">u8").astype(np.uint64).T[::-1]]))
    which, at, size, rows = which[order], at[order], size[order], rows[order]
    doc = np.array([p[2] for p in parts], np.int64)[which]
    start = np.array([p[3] for p in parts], np.int64)[which] + at
    edge = np.array([p[1] for p in parts], np.int64)[which]
    left = np.where(at > 0, joined[base[which] + at - 1].astype(np.int64), edge)
    rank = np.empty(len(which), np.int64)
    rank[np.lexsort((start, doc))] = np.arange(len(which))
    lcp = common_prefixes(rows, size)
    for prefix, lo, hi, maximal, _, late in interval_tree(lcp, left, rank.tolist(), length):
        if maximal:
            yield prefix, doc[lo:hi + 1], start[lo:hi + 1], [i - lo for i in late]


def removed_in_groups(batches: Iterator[pa.RecordBatch], length: int = LENGTH) -> Iterator[pa.RecordBatch]:
    """Contested segments sorted by anchor -> byte ranges to remove, one suffix array per block of whole groups."""
    def block(parts):
        doc, start, size = [], [], []
        for prefix, d, s, late in maximal_repeats(parts, length):
            doc.append(d[late])
            start.append(s[late])
            size.append(np.full(len(late), prefix))
        d, s, n = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (doc, start, size))
        d, s, e = _merge(d, s, s + n)
        return pa.RecordBatch.from_arrays([pa.array(d), pa.array(s), pa.array(e)], names=["doc", "start", "stop"])

    held, size, last = [], 0, None
    for b in batches:
        cols = [b.column(c).to_pylist() for c in ("h", "doc", "start", "part")]
        for h, doc, start, part in zip(*cols):
            if h != last and size >= 1 << 18:
                yield block(held)
                held, size = [], 0
            last = h
            # its own left byte belongs to another anchor: a segment's first string always counts as maximal
            held.append((part, -1, doc, start))
            size += len(part)
    if held:
        yield block(held)


def _strings(sizes: np.ndarray, length: int):
    """(part, offset) of every string of parts with these sizes."""
    counts = np.maximum(sizes - length + 1, 0)
    part = np.repeat(np.arange(len(sizes)), counts)
    return part, np.arange(len(part)) - np.repeat(np.cumsum(counts) - counts, counts)


def string_rows(batches: Iterator[pa.RecordBatch], length: int = LENGTH) -> Iterator[pa.RecordBatch]:
    """Segments of large groups -> one row per string: its 128-bit name, id and place, combined per task."""
    head = -(-length // 8) * 8
    held, size = [], 0

    def flush():
        cols = [np.concatenate([x[i] for x in held]) for i in range(4)]
        return combine(*cols, length, None)

    for b in batches:
        for at in range(0, b.num_rows, 2000):
            block = b.slice(at, 2000)
            raw, off, _ = utf8_parts(block.column("part"))
            doc, start = (block.column(c).to_numpy() for c in ("doc", "start"))
            part, place = _strings(off[1:] - off[:-1], length)
            if not len(part):
                continue
            joined = np.concatenate((raw[off[0]:off[-1]], np.zeros(head, np.uint8)))
            rows = _padded(joined, off[:-1][part] - off[0] + place, np.full(len(part), length), head)
            zero = np.zeros(len(part), np.int64)
            held.append((mix_rows(rows, 5).view(np.int64), mix_rows(rows, 7).view(np.int64), doc[part],
                         _pack(start[part] + place, zero, zero)))
            size += len(part)
            if size >= KEEP:
                yield from flush()
                held, size = [], 0
    if held:
        yield from flush()


def parts_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents with their contested places -> one row per segment with its bytes."""
    unpack = zstandard.ZstdDecompressor()
    for b in batches:
        out: list[list] = [[], [], [], [], []]
        for doc, z, want in zip(b.column("doc").to_pylist(), b.column("z").to_pylist(), b.column("want").to_pylist()):
            text = unpack.decompress(z) if z else b""
            for w in want:
                for col, v in zip(out, (w["kind"], w["h"], doc, w["start"], text[w["start"]:w["stop"]])):
                    col.append(v)
            if len(out[0]) > 50_000:
                yield _parts(out)
                out = [[], [], [], [], []]
        yield _parts(out)


def _parts(out) -> pa.RecordBatch:
    kinds = (pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary())
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds)],
                                      names=["kind", "h", "doc", "start", "part"])


def packed():
    """Arrow UDF text -> zstd bytes, for the texts' way through a shuffle."""
    @F.arrow_udf("binary")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        press = zstandard.ZstdCompressor(level=1)
        for arr in batches:
            raw, off, null = utf8_parts(arr)
            yield pa.array([b"" if null[i] else press.compress(raw[off[i]:off[i + 1]].tobytes())
                            for i in range(len(arr))], pa.binary())

    return run


def _numbered(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``(doc_id, doc, text)``: ``doc`` orders the documents; it is the id unless ids are missing or shared."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    text = F.md5(F.coalesce("text", F.lit("")).cast("binary"))
    shared = rows.groupBy("doc_id").agg(F.min(F.xxhash64("text")).alias("a"), F.max(F.xxhash64("text")).alias("b"))
    if shared.where("doc_id is null or doc_id < 0 or a <> b").limit(1).count() == 0:
        return rows.select("doc_id", F.col("doc_id").alias("doc"), "text")
    keyed = rows.withColumn("m", text)
    # range-partitioned, numbered within the parts, moved on by the parts before
    order = written(keyed.select("doc_id", "m").distinct().orderBy(F.col("doc_id").asc_nulls_last(), "m").withColumn(
        "at", F.monotonically_increasing_id()), "order")
    part, within = F.shiftright("at", 33), F.col("at").bitwiseAND(F.lit((1 << 33) - 1))
    sizes = order.groupBy(part.alias("part")).count()
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row a part
    moved = sizes.select("part", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("before"))
    number = written(order.select("doc_id", "m", part.alias("part"), within.alias("i")).join(F.broadcast(moved), "part").select(
        "doc_id", "m", (F.col("before") + F.col("i")).alias("doc")), "numbers")
    a, b = keyed.alias("a"), number.alias("b")
    return a.join(b, F.col("a.doc_id").eqNullSafe(F.col("b.doc_id")) & (F.col("a.m") == F.col("b.m"))).select(
        "a.doc_id", "b.doc", "a.text")


def _with_bytes(rows: DataFrame, found: DataFrame) -> DataFrame:
    """The contested segments of ``found`` with their bytes: ``kind, h, doc, start, part``."""
    want = found.where("kind > 0").groupBy("doc").agg(F.collect_list(F.struct("kind", "h", "start", "stop")).alias("want"))
    # one row of each document: a second copy of a segment would count as a later occurrence of its first string
    return rows.select("doc", "z").dropDuplicates(["doc"]).join(want, "doc").select("doc", "z", "want").mapInArrow(
        parts_of, "kind int, h long, doc long, start long, part binary")


def repeated_ranges(rows: DataFrame, length: int = LENGTH) -> DataFrame:
    """``doc, start, stop``: byte ranges (they may overlap) covered by strings that also start earlier.

    ``rows`` has (doc, text, z): order, text, zstd bytes of the text."""
    python_tasks(rows.sparkSession)
    salt = F.when(F.col("loc").bitwiseAND(F.lit(1)) == 1, F.pmod("g", F.lit(SALTS))).otherwise(F.lit(0))

    def anchors(batches):
        return anchor_rows(batches, length)

    def scan(batches):
        return class_scan(batches, length)

    def scan_only(batches):
        return class_scan(batches, length, contest=False)

    def strings(batches):
        return string_rows(batches, length)

    def groups(batches):
        return removed_in_groups(batches, length)

    order = ["h", "g", "doc", "loc"]
    found = written(rows.select("doc", "text").mapInArrow(anchors, ROWS).repartition(F.col("h"), salt)
                    .sortWithinPartitions(*order).mapInArrow(scan, FOUND), "segments")
    parts = written(_with_bytes(rows, found), "contested")
    tree = parts.where("kind = 1").select("h", "doc", "start", "part").repartition("h").sortWithinPartitions("h").mapInArrow(
        groups, "doc long, start long, stop long")
    hot = parts.where("kind = 2").select("doc", "start", "part").mapInArrow(strings, ROWS).repartition(
        "h").sortWithinPartitions(*order).mapInArrow(scan_only, FOUND).select("doc", "start", "stop")
    return found.where("kind = 0").select("doc", "start", "stop").unionByName(tree).unionByName(hot)


RESULT = "struct<n_removed:long,n_spans:long,kept_sha256:string,spans:array<struct<start:long,stop:long>>>"


def _cut():
    @F.arrow_udf(RESULT)
    def run(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        unpack = zstandard.ZstdDecompressor()
        spans = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))
        kind = pa.struct([("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept_sha256", pa.string()), ("spans", spans)])
        for zs, ranges in batches:
            out = []
            for z, r in zip(zs, ranges):
                text = unpack.decompress(z.as_py()) if z.as_py() else b""
                got = r.as_py() or []
                a = np.array([x["start"] for x in got], np.int64)
                b = np.array([x["stop"] for x in got], np.int64)
                _, a, b = _merge(np.zeros(len(a), np.int64), a, b)
                digest, at = hashlib.sha256(), 0
                for s, e in zip(a.tolist(), b.tolist()):
                    digest.update(text[at:s])
                    at = e
                digest.update(text[at:])
                out.append({"n_removed": int((b - a).sum()), "n_spans": len(a), "kept_sha256": digest.hexdigest(),
                            "spans": [{"start": s, "stop": e} for s, e in zip(a.tolist(), b.tolist())]})
            yield pa.array(out, kind)

    return run


def dedup(docs: DataFrame, length: int = LENGTH, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: ``doc_id, n_bytes, n_removed, n_spans, kept_sha256, spans`` (byte ranges removed)."""
    python_tasks(docs.sparkSession)
    rows = _numbered(docs, id_col, text_col).withColumn("z", packed()("text"))
    ranges = repeated_ranges(rows, length).groupBy("doc").agg(
        F.collect_list(F.struct("start", "stop")).alias("ranges"))
    size = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long")
    done = rows.select("doc_id", "doc", size.alias("n_bytes"), "z").join(ranges, "doc", "left")
    return done.select("doc_id", "n_bytes", _cut()("z", "ranges").alias("r")).select("doc_id", "n_bytes", "r.*")


def op5_interval_tree_dedup(spark, sf_dir: str) -> DataFrame:
    return dedup(documents(spark, sf_dir)).drop("spans")


REPEATS_SQL = """
WITH x AS (SELECT doc_id, encode(COALESCE(text, '')) AS b FROM documents),
n AS (SELECT doc_id, b, octet_length(b) AS n_bytes FROM x),
w AS (SELECT doc_id, i, md5(b[i:i + 99]) AS s FROM (SELECT doc_id, b, unnest(range(1, n_bytes - 98)) AS i FROM n WHERE n_bytes >= 100)),
q AS (SELECT doc_id, i, row_number() OVER (PARTITION BY s ORDER BY doc_id, i) AS k FROM w),
l AS (SELECT doc_id, i, CASE WHEN i > lag(i) OVER (PARTITION BY doc_id ORDER BY i) + 100 THEN 1 ELSE 0 END AS gap FROM q WHERE k > 1),
c AS (SELECT doc_id, i, SUM(gap) OVER (PARTITION BY doc_id ORDER BY i) AS run FROM l),
r AS (SELECT doc_id, run, MIN(i) AS a, MAX(i) + 99 AS z FROM c GROUP BY doc_id, run),
e AS (SELECT doc_id, SUM(z - a + 1) AS n_removed, COUNT(*) AS n_spans, list(a ORDER BY a) AS starts, list(z ORDER BY a) AS ends FROM r GROUP BY doc_id)
SELECT n.doc_id, CAST(n_bytes AS BIGINT) AS n_bytes, CAST(COALESCE(n_removed, 0) AS BIGINT) AS n_removed, COALESCE(n_spans, 0) AS n_spans,
  CASE WHEN n_spans IS NULL THEN sha256(b) ELSE sha256(unhex(array_to_string(list_transform(range(0, len(starts) + 1), lambda i:
    hex(b[CASE WHEN i = 0 THEN 1 ELSE ends[i] + 1 END : CASE WHEN i = len(starts) THEN n_bytes ELSE starts[i + 1] - 1 END])), ''))) END AS kept_sha256
FROM n LEFT JOIN e USING (doc_id)"""
