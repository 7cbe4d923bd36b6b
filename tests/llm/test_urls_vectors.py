"""URL filter, whitening and hard negatives against plain versions, on given, awkward and empty tables."""

import re
import time
from collections import Counter, defaultdict
from fractions import Fraction
from math import floor, isfinite

import numpy as np
import pytest

from llm_tables import SF, edge_dir, empty_dir  # noqa: F401
from shardscan.llm import hard_negatives as HN
from shardscan.llm import url_rules as U
from shardscan.llm import whitening as W


# ------------------------------------------------------------------- op11
def plain_split(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest).group()
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host), re.match(r"[^?#]*", rest[len(host):]).group()


def plain_glob(glob):
    """A glob as a regular expression over bytes."""
    out, i = b"", 0
    while i < len(glob):
        if glob[i] == "\\" and i + 1 < len(glob):
            out += re.escape(glob[i + 1].encode())
            i += 2
            continue
        two = glob[i:i + 2] == "**"
        out += b"[\\x00-\\xff]*" if two else {"*": b"[^/]*", "?": b"[^/]"}.get(glob[i]) or re.escape(glob[i].encode())
        i += 2 if two else 1
    return re.compile(out, re.S)


def plain_judge(url, rules=U.RULES, globs=U.BLOCK_GLOBS):
    host, path = plain_split(url)
    fit = [(-len(r.host + r.path), -len(r.host), i, r) for i, r in enumerate(rules)
           if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    blocked = [g for g in globs if plain_glob(g).fullmatch((host + path).encode())]
    rule = min(fit)[3] if fit else None
    return host, path, rule and rule.name, rule.verdict if rule else "block" if blocked else "allow", blocked[0] if blocked else None


URLS = [None, "", "no scheme", "http://", "http://a.com", "HTTP://A.Example.COM/en/x?y#z", "http://www.example.com/en/", "http://www.example.com/EN/",
        "http://xexample.com/en/a", "http://.com/x", "http://com/", "http://com", "http://a.net/es/1", "http://net/fr/", "http://a.net/fr",
        "http://casino.org", "http://my.casino.org/a", "http://org/x.com/y", "http://a.org/x/casino", "http://a.org/p/cgi-bin/q", "x://y://z.com/a",
        "http://é.com/é", "http://u@h.com:80/en/", "http://a.com\n/b", "http://free-bets.x.net/de/", "http://a.org/track", "http://a.org/track/",
        "http://b.org/" + "a" * 100_000 + "/cgi-bin/z", "http://" + "a." * 40_000 + "com/x", "http://xxx.org?/cgi-bin/"]


def test_op11_given(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet").select("page_id", "url").collect()
    got = [tuple(r) for r in U.op11_url_wildcard_filter(spark, "/root/testdata/sf0.01").collect()]
    assert Counter(got) == Counter((p.page_id, *plain_judge(p.url)) for p in pages)


def test_op11_awkward_urls(spark, edge_dir):
    rows = [(i, u, "x", "y") for i, u in enumerate(URLS)] + [(None, "http://a.com/", "x", "y"), (3, "http://a.com/", "x", "y"),
                                                            (3, "http://a.com/", "x", "y")]
    df = spark.createDataFrame(rows, "page_id long, url string, host string, rule string")
    assert Counter(map(tuple, U.judge(df).collect())) == Counter((r[0], *plain_judge(r[1])) for r in rows)
    edge = spark.read.parquet(f"{edge_dir}/pages.parquet").select("page_id", "url").collect()
    got = U.op11_url_wildcard_filter(spark, edge_dir).collect()
    assert Counter(map(tuple, got)) == Counter((p.page_id, *plain_judge(p.url)) for p in edge)


def test_op11_many_rules_over_several_words(spark):
    rnd = np.random.default_rng(5)
    letters = "ab/."
    rules = [U.Rule("block" if i % 2 else "allow", "".join(rnd.choice(list("ab."), 3)), "/" + "".join(rnd.choice(list(letters), 2))) for i in range(60)]
    globs = ["".join(rnd.choice(list("ab/.?*"), rnd.integers(1, 9))) for _ in range(60)] + ["a\\*b**", "\\?*", ""]
    urls = ["x://" + "".join(rnd.choice(list(letters + "*?"), rnd.integers(0, 14))) for _ in range(1500)]
    df = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    got = {r.page_id: tuple(r)[1:] for r in U.judge(df, rules, globs).collect()}
    assert U.ShiftAnd([g for r in rules for g in r.globs()] + globs).n_words > 8
    for i, u in enumerate(urls):
        assert got[i] == plain_judge(u, rules, globs), u
    assert {r.verdict for r in U.judge(df, (), ()).collect()} == {"allow"}


def test_op11_states_are_bounded():
    with pytest.raises(ValueError, match="states"):
        U.ShiftAnd(["a" * (U.MAX_STATES + 1)])


# ------------------------------------------------------------------- op12
def usable(vec):
    return vec is not None and all(c is not None and isfinite(c) for c in vec)


def plain_x(rows):
    dim = max((len(v) for _, v in rows), default=0)
    return [(i, [floor(64 * Fraction(c)) + 1_000_000 for c in v] + [1_000_000] * (dim - len(v))) for i, v in rows]


@pytest.mark.parametrize("path", [SF, "/root/testdata/sf0.01", "edge"])
def test_op12(spark, edge_dir, path):
    path = edge_dir if path == "edge" else path
    rows = [(r.vec_id, list(r.embedding)) for r in spark.read.parquet(f"{path}/embeddings.parquet").collect() if usable(r.embedding)]
    x = plain_x(rows)
    fit = sorted({tuple(v) for _, v in x})
    n, total = len(fit), [sum(c) for c in zip(*fit)]
    far = Counter((i, sum((n * a - s) ** 2 for a, s in zip(v, total))) for i, v in x)
    mean = np.array([float(Fraction(s, n) - 1_000_000) for s in total])
    y = np.array(fit) - 1_000_000 - mean
    cov = y.T @ y / n
    values, vectors = np.linalg.eigh(cov)
    values, vectors = values[::-1], vectors[:, ::-1]
    k = min(16, int((values > 1e-12 * values[0]).sum()))
    got = W.op12_pivoted_cholesky_whitening(spark, path).collect()
    assert len(got) == k * len(rows) and {r.component for r in got} == set(range(1, k + 1))
    assert {r.n for r in got} == {n} and len({r.identity_error for r in got}) == 1 and got[0].identity_error < 1e-9
    assert Counter((r.vec_id, r.deviation) for r in got if r.component == 1) == far
    for r in got:
        assert abs(r.explained / (values[r.component - 1] / values.sum()) - 1) < 1e-9
    want = defaultdict(list)
    for i, v in x:
        want[i].append((np.array(v) - 1_000_000 - mean) @ vectors[:, :k] / np.sqrt(values[:k]))
    gaps = np.diff(values[:k + 1]) if len(values) > k else np.r_[np.diff(values[:k]), -1]
    apart = [c for c in range(k) if min(-gaps[c], -gaps[c - 1] if c else np.inf) > 1e-6 * values[0]]
    sign = {}
    for r in got:
        if r.component - 1 in apart:
            w = [v[r.component - 1] for v in want[r.vec_id]]
            s = sign.setdefault(r.component, next((np.sign(a * r.whitened) for a in w if abs(a) > 1e-6), None))
            assert min(abs((s or 1) * a - r.whitened) for a in w) < 1e-7


def test_op12_extremes_and_few_vectors(spark):
    def run(rows):
        df = spark.createDataFrame(rows, "vec_id string, embedding array<double>, n string, x string, whitened string")
        return W.whiten(df).collect()

    def row(i, v):
        return i, v, "c", "c", "c"

    assert run([row("a", [1.0, 2.0]), row("b", [1.0, 2.0])]) == []  # no direction varies
    assert run([row("a", None), row("b", [None])]) == [] and run([row("a", []), row("b", [])]) == []
    got = run([row(None, [1e300, 0.0]), row("b", [-1e300, 0.0]), row("b", [0.0]), row("c", [])])
    assert {r.component for r in got} == {1} and len(got) == 4 and got[0].n == 3 and got[0].identity_error < 1e-9
    assert got[0].deviation == 2 * 0 + (3 * 2 ** 46 - 0) ** 2


def test_pivoted_cholesky_and_jacobi():
    rnd = np.random.default_rng(2)
    for d, rank in ((1, 1), (5, 5), (8, 3), (33, 33), (12, 1)):
        f = rnd.normal(size=(d, rank)) * 10.0 ** rnd.integers(-3, 4, size=(d, 1))
        a = f @ f.T
        l, order = W.pivoted_cholesky(a)
        assert l.shape[1] == rank and np.allclose(l @ l.T, a[order][:, order], atol=1e-9 * a.max())
        assert (np.triu(l, 1) == 0).all() and (np.diff(np.diagonal(l)) <= 1e-12).all()
        q, norms = W.jacobi_columns(l)
        assert np.allclose(q.T @ q, np.eye(rank), atol=1e-12)
        assert np.allclose(norms ** 2, np.linalg.eigvalsh(a)[::-1][:rank], rtol=1e-6, atol=1e-9 * a.max())


# ------------------------------------------------------------------- op13
def plain_negatives(rows, k=5):
    """(vec_id, vector, label) -> result rows, all pairs by brute force."""
    one = {}
    for i, v, label in rows:
        if i is not None and label is not None and usable(v):
            label = (label + 1) % 10 if i % 7 == 0 else label
            one[i] = min(one.get(i, (label, list(v))), (label, list(v)))
    dim = max((len(v) for _, v in one.values()), default=0)
    q = {i: [floor(256 * Fraction(c)) for c in v] + [0] * (dim - len(v)) for i, (_, v) in one.items()}
    out = []
    for a in [i for i in one if i % 100 == 0]:
        score = {c: sum(x * y for x, y in zip(q[a], q[c])) for c in one if c != a}
        by = sorted(score, key=lambda c: (-score[c], c))
        for p in [c for c in by if one[c][0] == one[a][0]][:k]:
            fit = [c for c in by if one[c][0] != one[a][0] and 80 * score[p] <= 100 * score[c] <= 100 * score[p]][:k]
            out += [(a, p, n, c, score[p], score[c]) for n, c in enumerate(fit, 1)]
    return out


@pytest.mark.parametrize("path", [SF, "edge"])
def test_op13(spark, edge_dir, path):
    path = edge_dir if path == "edge" else path
    rows = [(r.vec_id, r.embedding, r.label) for r in spark.read.parquet(f"{path}/embeddings.parquet").collect()]
    got = Counter(map(tuple, HN.op13_four_russians_hard_negatives(spark, path).collect()))
    assert got == Counter(plain_negatives(rows)) and got


def test_op13_small_tiles_hot_label_and_ties(spark):
    """Many tiles; a label with most rows, a vector with hundreds of copies, extra columns of the names used inside."""
    rnd = np.random.default_rng(7)
    base = rnd.integers(-3, 4, size=(12, 11)).astype(float)
    rows = [(i, [float(c) for c in base[rnd.integers(0, 3) if i % 3 else rnd.integers(0, 12)]], 1 if i % 3 == 0 else int(rnd.integers(0, 9)))
            for i in range(0, 900)]
    df = spark.createDataFrame([(*r, "z", "z", "z") for r in rows],
                               "vec_id long, embedding array<double>, label int, planes string, bucket string, block string")
    got = HN.mine(HN.relabelled(df), HN.F.col("vec_id") % 100 == 0, block_rows=50, chunk_rows=2)
    want = plain_negatives(rows)
    assert Counter(map(tuple, got.collect())) == Counter(want) and len(want) > 50


def test_op13_scores_are_exact():
    rnd = np.random.default_rng(1)
    for dim, low, high in ((1, 0, 0), (3, -1, 0), (8, -5, 9), (13, -300, 17), (64, -2 ** 28, 2 ** 28)):
        a, c = rnd.integers(low, high + 1, size=(5, dim)), rnd.integers(low, high + 1, size=(40, dim))
        c[0], c[1], a[0] = low, high, low
        planes = HN.bit_planes(c, HN.width(low, high))
        want = c.astype(object) @ a.T.astype(object)
        assert (HN.four_russians(planes, a) == want).all()
        if dim * max(-low, high) ** 2 < 2 ** 31:
            assert (HN.four_russians(planes, a, np.int32) == want).all()
    for p in range(0, 200):
        assert HN.least_negative(p) == min(n for n in range(0, 400) if 80 * p <= 100 * n)


def test_op13_extreme_entries_and_nothing_to_mine(spark):
    schema = "vec_id long, embedding array<double>, label int"
    far = [(100, [1e300, -1e300], 0), (1, [1e300, 0.0], 0), (2, [1e300, -1e300], 1), (3, [-1e300], 1), (4, [], 1)]
    got = HN.mine(spark.createDataFrame(far, schema), HN.F.col("vec_id") == 100).collect()
    assert [(r.positive_id, r.negative_id) for r in got] == []  # the only other score, twice the positive's, is no candidate
    assert HN.mine(spark.createDataFrame([(100, [], 0), (1, [], 0), (2, [], 1)], schema), HN.F.col("vec_id") == 100).collect() == [
        (100, 1, 1, 2, 0, 0)]
    assert HN.mine(spark.createDataFrame([(100, [1.0], 0)], schema), HN.F.col("vec_id") == 100).collect() == []


def test_url_batches_are_walked_in_time():
    raw = np.frombuffer(("a.com/" + "x" * 2_000_000).encode(), np.uint8)
    t = time.perf_counter()
    fits = U.ShiftAnd(["*.com/**", "a.com/**", "**b"]).matches(raw, np.array([0]), np.array([len(raw)]))
    assert fits.tolist() == [[True, True, False]] and time.perf_counter() - t < 5
