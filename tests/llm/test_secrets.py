"""The entropy scan against a plain version, and texts that once took it exponential or quadratic time."""

import random
import re
import time

import pytest

import brute
from llm_tables import SF, edge_dir  # noqa: F401
from shardscan.llm import secrets

SEP = "/=_+-"


def words_only(s):
    """Words joined by single - _ / and up to four digits at the end, read part by part."""
    s = re.sub(r"[0-9]{0,4}$", "", s)
    return bool(s) and all(re.fullmatch(r"[A-Z]?[a-z]+", w) for w in re.split(r"[-_/]", s))


def repeated(s):
    return any(len(s) >= 4 * n and s[:4 * n] == s[:n] * 4 and any(
        s[:m * n] == s[:n] * m and len(s) - m * n <= 4 for m in range(4, len(s) // n + 1)) for n in range(1, 5))


def uuid(s):
    return bool(re.fullmatch("-".join("[0-9A-Fa-f]{%d}" % n for n in (8, 4, 4, 4, 12)), s))


def allowed(s):
    return uuid(s) or words_only(s) or repeated(s)


def mixed(s):
    return any(c in "0123456789" for c in s) and any(c.isalpha() for c in s)


def holds_allowed(part):
    low = part.lower()
    return any(x in low for x in ("example", "0123456789", "abcdefghij", "1234567890"))


def stretches(run):
    if allowed(run):
        return []
    if not holds_allowed(run):
        return [(0, run)]
    gone = [False] * len(run)
    for n, fits in ((36, uuid), (40, lambda s: s == "wJalrXUtnFEMI/K7MDENG/bPxRfiCYEXAMPLEKEY")):
        i = 0
        while i + n <= len(run):
            if fits(run[i:i + n]):
                gone[i:i + n] = [True] * n
                i += n
            else:
                i += 1
    for m in re.finditer(r"[^/=_+-]+", run):
        if holds_allowed(m.group()):
            gone[m.start():m.end()] = [True] * len(m.group())
    out, i = [], 0
    while i < len(run):
        if gone[i]:
            i += 1
            continue
        j = i
        while j < len(run) and not gone[j]:
            j += 1
        a, b = i + (i > 0), j - (j < len(run))  # without the character next to an allowed part
        if b - a >= 20:
            out.append((a, run[a:b]))
        i = j
    return out


def plain_scan(text):
    text = text or ""
    names = brute.base_secrets(text)[2]
    base = [(int(a), int(b)) for a, b in (n.split(":")[1:] for n in names)]
    added = []
    for run in re.finditer(r"[A-Za-z0-9+/_=-]{20,}", text):
        for at, s in stretches(run.group()):
            if not mixed(s) or allowed(s):
                continue
            tries = [("entropy_hex", h.group(), h.start()) for h in re.finditer(r"[0-9A-Fa-f]{20,}", s)]
            if not any(len(t) == len(s) for _, t, _ in tries):
                tries.append(("entropy_base64", s, 0))
            for kind, t, a in tries:
                hot = [False] * len(t)
                for i in range(len(t) - 19):
                    if brute.entropy(t[i:i + 20]) >= secrets.THRESHOLDS[kind]:
                        hot[i:i + 20] = [True] * 20
                # windows that touch without sharing a character count as one span, as do overlapping ones
                for m in re.finditer("x+", "".join("x" if h else "-" for h in hot)):
                    if mixed(t[m.start():m.end()]) and not allowed(t[m.start():m.end()]):
                        start = run.start() + at + a + m.start()
                        added.append(f"{kind}:{start}:{start + len(m.group())}")
    inside = [s for s in added if any(a <= int(s.split(":")[1]) and int(s.split(":")[2]) <= b for a, b in base)]
    return names, sorted(set(added) - set(inside))


def check(text):
    base, every = secrets.scan(text)
    names, added = plain_scan(text)
    got = [secrets.joined([s]) for s in every]
    assert sorted(s for s in got if s.startswith("entropy")) == added, text[:300]
    assert [s for s in got if not s.startswith("entropy")] == names


@pytest.mark.parametrize("path", [SF, "edge"])
def test_added_spans_on_tables(spark, edge_dir, path):
    path = edge_dir if path == "edge" else path
    for text in {r.text for r in spark.read.parquet(f"{path}/documents.parquet").select("text").collect()}:
        check(text)


def test_added_spans_on_made_runs():
    rnd = random.Random(11)
    key = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
    part = [lambda: "".join(rnd.choice(key) for _ in range(rnd.randrange(1, 40))), lambda: "".join(rnd.choice("0123456789abcdef") for _ in range(rnd.randrange(8, 40))),
            lambda: "word", lambda: "example", lambda: "0123456789", lambda: "AKIA" + "".join(rnd.choice(key[:26]) for _ in range(16)), lambda: "abab" * 6,
            lambda: "123e4567-e89b-12d3-a456-426614174000", lambda: "token=", lambda: " ", lambda: "wJalrXUtnFEMI/K7MDENG/bPxRfiCYEXAMPLEKEY"]
    for _ in range(1500):
        check("".join(rnd.choice(part)() + rnd.choice(["", "-", "/", "_", " ", "="]) for _ in range(rnd.randrange(1, 8))))


def test_allowed_words_are_the_same_strings_read_in_one_way():
    rnd = random.Random(4)
    for _ in range(20_000):
        s = "".join(rnd.choice("aAb-_/12") for _ in range(rnd.randrange(0, 12)))
        assert bool(secrets.ALLOW[1].fullmatch(s)) == words_only(s), s


def test_long_slugs_and_many_keys_take_linear_time():
    rnd = random.Random(9)
    slug = "-".join(["word"] * 200) + "-20240131"
    keys = " ".join("AKIA" + "".join(rnd.choice("ABCDEFGHJKLMNP23456789") for _ in range(16)) + " Zq3Rt7Lw9Xb2Nc5Vm8Kd1Hs4" for _ in range(50_000))
    for text in (slug, "see " + slug * 1200, "-".join(["word"] * 210_000) + "-20240131", keys):
        t = time.perf_counter()
        secrets.scan(text)
        assert time.perf_counter() - t < (2 if len(text) < 1_500_000 else 8)
