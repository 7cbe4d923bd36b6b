"""The steps of the repeat search as plain functions, many random texts, small limits."""

import random

import numpy as np
import pyarrow as pa
import pytest

from shardscan.llm import repeats as R

L = 40


def batches(cols: dict, size: int):
    t = pa.table(cols)
    return t.to_batches(max_chunksize=size) if t.num_rows else []


def sorted_rows(parts: list[pa.RecordBatch], part_of, n: int, size: int):
    cols = {c: np.concatenate([p.column(i).to_numpy() for p in parts]) if parts else np.zeros(0, np.int64)
            for i, c in enumerate(("h", "g", "doc", "loc"))}
    where = part_of(cols)
    for k in range(n):
        at = np.flatnonzero(where == k)
        at = at[np.lexsort([cols[c][at] for c in ("loc", "doc", "g", "h")])]
        yield batches({c: cols[c][at] for c in cols}, size)


def ranges(docs: list[bytes], tasks: int, size: int):
    """The flow of ``repeated_ranges`` without Spark: map tasks, shuffles, streams of small batches."""
    rows = []
    for k in range(tasks):
        ids = list(range(k, len(docs), tasks))
        got = batches({"doc": pa.array(ids, pa.int64()), "text": pa.array([docs[i] for i in ids], pa.binary())}, size)
        rows += list(R.anchor_rows(iter(got), L))

    def salted(c):
        salt = np.where(c["loc"] & 1 == 1, c["g"] % R.SALTS, 0)
        return (c["h"] + salt * 7) % 3

    found = []
    for stream in sorted_rows(rows, salted, 3, size):
        found += [r for b in R.class_scan(iter(stream), L) for r in b.to_pylist()]
    out = [(r["doc"], r["start"], r["stop"]) for r in found if r["kind"] == 0]
    groups: dict = {}
    hot = []
    for r in found:
        part = (docs[r["doc"]][r["start"]:r["stop"]], r["doc"], r["start"])
        if r["kind"] == 1:
            groups.setdefault(r["h"], []).append(part)
        elif r["kind"] == 2:
            hot.append(part)
    flat = [(h, *p) for h in sorted(groups) for p in groups[h]]
    for b in R.removed_in_groups(iter(batches({
            "h": pa.array([f[0] for f in flat], pa.int64()), "doc": pa.array([f[2] for f in flat], pa.int64()),
            "start": pa.array([f[3] for f in flat], pa.int64()), "part": pa.array([f[1] for f in flat], pa.binary())}, size)), L):
        out += [tuple(r.values()) for r in b.to_pylist()]
    strings = []
    for k in range(tasks):
        mine = hot[k::tasks]
        strings += list(R.string_rows(iter(batches({
            "doc": pa.array([m[1] for m in mine], pa.int64()), "start": pa.array([m[2] for m in mine], pa.int64()),
            "part": pa.array([m[0] for m in mine], pa.binary())}, size)), L))
    for stream in sorted_rows(strings, lambda c: c["h"] % 3, 3, size):
        for b in R.class_scan(iter(stream), L, contest=False):
            out += [(r["doc"], r["start"], r["stop"]) for r in b.to_pylist()]
    return out, len(hot), len(flat)


def brute(docs: list[bytes]):
    seen, out = set(), set()
    for d, b in enumerate(docs):
        for i in range(len(b) - L + 1):
            if b[i:i + L] in seen:
                out.update((d, x) for x in range(i, i + L))
            seen.add(b[i:i + L])
    return out


def some_texts(rnd: random.Random) -> list[bytes]:
    def noise(n):
        return bytes(rnd.choice(b"abcdefgh ") for _ in range(n))

    pool = [noise(rnd.randint(30, 160)) for _ in range(4)] + [b"a" * rnd.randint(35, 90), b"xyz" * rnd.randint(10, 40)]
    docs = []
    for _ in range(rnd.randint(1, 25)):
        kind = rnd.random()
        if docs and kind < 0.2:
            docs.append(rnd.choice(docs))
        elif docs and kind < 0.5 and docs[-1]:
            b = bytearray(rnd.choice(docs))
            for _ in range(rnd.randint(1, 3)):
                if b:
                    b[rnd.randrange(len(b))] = rnd.choice(b"abc")
            docs.append(bytes(b))
        else:
            docs.append(b"".join(rnd.choice([noise(rnd.randint(0, 50)), rnd.choice(pool)]) for _ in range(rnd.randint(0, 5))))
    return docs


@pytest.mark.parametrize("hot,group,chunk,keep,size", [
    (8, 4096, 1 << 22, 1 << 21, 1000), (1, 4, 90, 40, 3), (0, 100, 300, 100, 1), (2, 3, 64, 1 << 21, 7),
    (100, 2, 200, 1 << 21, 5), (100, 4096, 90, 50, 2)])
def test_ranges_equal_brute_force(monkeypatch, hot, group, chunk, keep, size):
    monkeypatch.setattr(R, "HOT", hot)
    monkeypatch.setattr(R, "GROUP", group)
    monkeypatch.setattr(R, "CHUNK", chunk)
    monkeypatch.setattr(R, "KEEP", keep)
    rnd = random.Random(hot * 1000 + size)
    seen_hot = seen_contested = 0
    for _ in range(60):
        docs = some_texts(rnd)
        got, n_hot, n_flat = ranges(docs, rnd.randint(1, 3), size)
        seen_hot += n_hot
        seen_contested += n_flat
        assert {(d, x) for d, a, b in got for x in range(a, b)} == brute(docs), docs
    assert seen_contested + seen_hot > 0
    if hot <= 1 or group <= 4:
        assert seen_hot > 0


def every_repeat(parts, length):
    occ: dict = {}
    for p, left, d, s in parts:
        for i in range(len(p)):
            for j in range(i + length, len(p) + 1):
                occ.setdefault(p[i:j], []).append((d, s + i, p[i - 1] if i else left, p[j] if j < len(p) else None))
    out = {}
    for k, v in occ.items():
        lefts, rights = [x[2] for x in v], [x[3] for x in v]
        if len(v) > 1 and (len(set(lefts)) > 1 or -1 in lefts) and (len(set(rights)) > 1 or None in rights):
            out[k] = sorted((d, s) for d, s, _, _ in v)
    return out


def test_maximal_repeats_with_all_occurrences():
    rnd = random.Random(5)
    for _ in range(600):
        length, m = rnd.randint(1, 4), rnd.random()
        parts = [(bytes(rnd.choice(b"ab") for _ in range(rnd.randint(0, 12))), -1 if m < 0.5 else rnd.choice([-1, 97, 98]), d, 0)
                 for d in range(rnd.randint(1, 5))]
        text = {d: p for p, _, d, _ in parts}
        got, cover = {}, set()
        for prefix, doc, start, late in R.maximal_repeats(parts, length):
            got[text[int(doc[0])][start[0]:start[0] + prefix]] = sorted(zip(doc.tolist(), start.tolist()))
            cover.update((int(doc[i]), x) for i in late for x in range(start[i], start[i] + prefix))
        assert got == every_repeat(parts, length)
        if m < 0.5:
            seen, expect = set(), set()
            for p, _, d, _ in parts:
                for i in range(len(p) - length + 1):
                    if p[i:i + length] in seen:
                        expect.update((d, x) for x in range(i, i + length))
                    seen.add(p[i:i + length])
            assert cover == expect
