"""Plain, slow versions of the operators' results."""

import hashlib
import math
import re
import zlib
from collections import defaultdict

import xxhash


def lower(t):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")


def simhash(text):
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", lower(text)) if w]
    if not words:
        return 0
    sh = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)] if len(words) >= 3 else [" ".join(words)]
    hs = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in sh]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def components(docs):
    """doc rows -> list of (doc_id, fingerprint, component_id)."""
    cache = {}
    fps = [cache.setdefault(t, simhash(t)) for _, t in docs]
    nodes = sorted(set(fps))
    parent = {x: x for x in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, x in enumerate(nodes):
        for y in nodes[i + 1:]:
            if (x ^ y).bit_count() <= 2:
                parent[find(y)] = find(x)
    least = {}
    for (d, _), f in zip(docs, fps):
        r = find(f)
        if d is not None:
            least[r] = min(least.get(r, d), d)
    return [(d, f"{f:016x}", least.get(find(f))) for (d, _), f in zip(docs, fps)]


def repeats(docs, length=100):
    """(doc_id, text) rows -> list of (doc_id, n_bytes, n_removed, n_spans, sha)."""
    def order(r):
        return r[0] is None, r[0] or 0, hashlib.md5((r[1] or "").encode()).hexdigest()

    seen, out = set(), {}
    for row in sorted(set(docs), key=order):
        b = (row[1] or "").encode()
        cover, upto = bytearray(len(b)), 0
        for i in range(len(b) - length + 1):
            w = b[i:i + length]
            if w in seen:
                a = max(i, upto)
                cover[a:i + length] = b"\1" * (i + length - a)
                upto = i + length
            seen.add(w)
        kept = bytes(c for c, x in zip(b, cover) if not x)
        spans = sum(1 for i in range(len(b)) if cover[i] and (i == 0 or not cover[i - 1]))
        out[row] = (row[0], len(b), sum(cover), spans, hashlib.sha256(kept).hexdigest())
    return [out[r] for r in docs]


def repeat_groups(docs, length=100):
    """(doc_id, text) rows -> set of (bytes, frozenset of (doc_id, start)): all maximal repeats, from short to long."""
    texts = [(d, (t or "").encode()) for d, t in set(docs)]
    first, out = defaultdict(list), set()
    for k, (_, b) in enumerate(texts):
        for i in range(len(b) - length + 1):
            first[b[i:i + length]].append((k, i))
    todo = [occ for occ in first.values() if len(occ) > 1]
    while todo:
        occ = todo.pop()
        left = {texts[k][1][i - 1] if i else -1 for k, i in occ}
        if len(left) == 1 and -1 not in left:
            continue  # neither it nor what it begins
        rests = [texts[k][1][i:] for k, i in occ]
        low, high = min(rests), max(rests)
        size = next((j for j, (x, y) in enumerate(zip(low, high)) if x != y), min(len(low), len(high)))
        out.add((low[:size], frozenset((texts[k][0], i) for k, i in occ)))
        after = defaultdict(list)
        for (k, i), rest in zip(occ, rests):
            after[rest[size:size + 1]].append((k, i))
        todo += [x for c, x in after.items() if c and len(x) > 1]
    return out



WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def overlap(docs, bench, window=13):
    grams = defaultdict(set)
    for n, (_, t) in enumerate(bench):
        w = WORD.findall(lower(t))
        for g in [tuple(w[k:k + window]) for k in range(len(w) - window + 1)] if len(w) >= window else [tuple(w)] if w else []:
            grams[g].add(n)
    sizes = {len(g) for g in grams}
    out, cache = [], {}
    for d, t in docs:
        if t not in cache:
            w, hit, items = WORD.findall(lower(t)), set(), set()
            for size in sizes:
                for k in range(len(w) - size + 1):
                    g = tuple(w[k:k + size])
                    if g in grams:
                        hit.update(range(k, k + size))
                        items |= grams[g]
            ids = sorted("" if bench[n][0] is None else str(bench[n][0]) for n in items)
            cache[t] = (len(w), len(hit), len(ids), hashlib.sha256(",".join(ids).encode()).hexdigest(),
                        len(hit) > 0 and 20 * len(hit) >= len(w))
        out.append((d, *cache[t]))
    return out


def base_secrets(text):
    out = []
    key = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
    for m in key.finditer(text or ""):
        if len(m.group(2)) >= 12:
            out.append((m.start(), 0, m.end()))
    for n, p, least in ((1, r"AKIA[A-Z0-9]+", 18), (2, r"[0-9a-f]+", 16)):
        out += [(m.start(), n, m.end()) for m in re.finditer(p, text or "") if len(m.group()) >= least]
    names = ("assign", "access", "hex")
    out.sort()
    digest = hashlib.sha256(",".join(f"{names[k]}:{a}:{b}" for a, k, b in out).encode()).hexdigest()
    return [sum(k == i for _, k, _ in out) for i in range(3)], digest, [f"{names[k]}:{a}:{b}" for a, k, b in out]


def entropy(s):
    return -sum(s.count(c) / len(s) * math.log2(s.count(c) / len(s)) for c in set(s))


def crc(text):
    return zlib.crc32((text or "").encode())
