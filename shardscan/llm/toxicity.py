"""Toxicity by weak supervision.

Voters look at a text and say toxic, clean or nothing: a short public insult
lexicon, words and word beginnings mined from labelled texts, their number,
insult and shouting patterns, and the label itself where one may be used.  A
generative label model (expectation maximisation over the counts of vote patterns
of all documents) estimates every voter's accuracy; voters that stay correlated
within a class are joined and share one table, so their agreement counts once.
A logistic regression on lexicon features is trained on the posterior labels and
gives the scores.

What is bounded, by parameters: the labelled texts mined (``max_labelled`` a class,
by id hash), the features kept (``max_features``, by evidence) and the rows the
regression sees.  The vote patterns are counted over all documents; there are at
most 3 ** voters of them.  Texts are read once for mining and once for features; the
rest works on a table of feature numbers.

Defined results: null and empty texts are scored by the intercept; ids without a label
or with a null one have no label vote, several labels of an id count as the largest; if nothing is
labelled the lexicon and the patterns alone decide; repeated rows get equal
scores; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shardscan.llm.common import documents, pieces, python_tasks, split_crc, table, written

#: Common insults of the four languages.
LEXICON = (
    "asshole bastard bitch clown coward creep crap disgusting dumb fool idiot imbecile jerk loser lunatic moron "
    "pathetic pig scum scumbag stupid trash ugly vermin worthless "
    "abschaum arschloch blödmann depp dreckig dumm dummkopf ekelhaft idiotin schwachkopf trottel versager widerlich wertlos "
    "abruti bouffon connard connasse crétin dégoûtant débile imbécile minable ordure pathétique salaud stupide "
    "asqueroso basura cabrón cobarde escoria estúpido estúpida idiota imbécil inútil patético payaso perdedor tonto").split()
WORD = re.compile(r"[^\W\d_]+")
SPACE = re.compile(r"\s")
YOU = re.compile(r"\b(?:you(?:'re| are)?|du (?:bist)?|tu (?:es|eres)|vous êtes|eres) (?:an?|the|such an?|so|ein|une?|el|la|tan)?\s*(\w+)", re.IGNORECASE)
PREFIXES = (4, 5, 6)
LABEL_ERROR = 1e-4
MAX_LABELLED = 8000
MAX_FEATURES = 3000
SKETCHES = 3
VOTERS = ("lexicon", "mined words", "mined beginnings", "several", "direct insult", "shouting", "nothing found", "label")


def features(text: str) -> set[str]:
    """Distinct words, word beginnings (marked by a caret) and beginnings of several
    different words (marked by a caret and a plus) of a text."""
    out = set(WORD.findall(text.lower()))
    begin = Counter("^" + w[:n] for w in out for n in PREFIXES if len(w) > n)
    return out | set(begin) | {b + "+" for b, n in begin.items() if n > 1}


def g_squared(pos: np.ndarray, neg: np.ndarray, n_pos: int, n_neg: int) -> np.ndarray:
    """Signed log-likelihood ratio of presence against class (positive: more often toxic)."""
    def term(a, b):
        return np.where(a > 0, a * np.log(np.maximum(a, 1e-12) / b), 0.0)

    n, seen = n_pos + n_neg, pos + neg
    g = 2 * (term(pos, seen * n_pos / n) + term(neg, seen * n_neg / n)
             + term(n_pos - pos, np.maximum((n - seen) * n_pos / n, 1e-12))
             + term(n_neg - neg, np.maximum((n - seen) * n_neg / n, 1e-12)))
    return np.where(pos / max(n_pos, 1) >= neg / max(n_neg, 1), g, -g)


def sketches():
    """Arrow UDF text -> ``SKETCHES`` minimum hashes of its word triples."""
    @F.arrow_udf("array<long>")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        odd = np.array([0x9E3779B1, 0x85EBCA6B, 0xC2B2AE35, 0x27D4EB2F][:SKETCHES], np.uint64)[:, None]
        for arr in batches:
            out = []
            for t in arr:
                words = (t.as_py() or "").lower().split()
                h = np.array([zlib.crc32(" ".join(words[i:i + 3]).encode()) for i in range(max(1, len(words) - 2))], np.uint64)
                mixed = (h[None] * odd) & np.uint64(0xFFFFFFFF)
                mixed = ((mixed ^ (mixed >> np.uint64(15))) * np.uint64(0x2C1B3C6D)) & np.uint64(0xFFFFFFFF)
                out.append(mixed.min(axis=1).astype(np.int64).tolist())
            yield pa.array(out, pa.list_(pa.int64()))

    return run


def mine(docs: DataFrame, labels: DataFrame, max_labelled: int, max_features: int) -> list[tuple[str, float]]:
    """Features with significant evidence for toxicity in the labelled sample, strongest first."""
    n = {r["toxic"]: r["count"] for r in labels.groupBy("toxic").count().collect()}
    if not n.get(0) or not n.get(1):
        return []
    share = F.when(F.col("toxic") == 1, min(1.0, max_labelled / n[1])).otherwise(min(1.0, max_labelled / n[0]))
    draw = F.pmod(F.xxhash64("doc_id", F.lit(31)), F.lit(1 << 20)) / float(1 << 20)
    some = labels.where(draw < share)  # about max_labelled of each class
    texts = docs.select("doc_id", F.col("text").cast("string").alias("text")).join(F.broadcast(some), "doc_id")
    # copies are no evidence of their own: one text of each that shares a minimum hash of its word triples
    sketched = texts.withColumn("s", sketches()("text"))
    for i in range(SKETCHES):
        one = sketched.groupBy(F.col("s")[i].alias("m")).agg(
            F.min(F.struct("doc_id", "toxic", "s", "text")).alias("x"))
        sketched = one.select("x.*")
    texts = sketched.select("text", "toxic")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tally: tuple[Counter, Counter] = (Counter(), Counter())
        for b in batches:
            for text, toxic in zip(b.column("text").to_pylist(), b.column("toxic").to_pylist()):
                tally[toxic].update(features(text or ""))
                tally[toxic][""] += 1  # the number of texts
            if len(tally[0]) + len(tally[1]) > 500_000:
                yield flush(tally)
        yield flush(tally)

    def flush(tally) -> pa.RecordBatch:
        names = list(tally[0].keys() | tally[1].keys())
        out = pa.RecordBatch.from_arrays(
            [pa.array(names, pa.string()), pa.array([tally[1][x] for x in names], pa.int64()),
             pa.array([tally[0][x] for x in names], pa.int64())], names=["f", "pos", "neg"])
        tally[0].clear()
        tally[1].clear()
        return out

    counts = written(texts.select("text", F.col("toxic").cast("int").alias("toxic")).mapInArrow(
        count, "f string, pos long, neg long").groupBy("f").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
        .where("pos >= 3 or f = ''"), "features")
    size = counts.where("f = ''").first()
    n_features = max(2, counts.count())
    if size is None or not size["pos"] or not size["neg"]:
        return []
    # only what is at least three times as frequent in toxic texts, strongest first
    found = counts.where("f <> ''").where(
        F.col("pos") / size["pos"] >= 3 * (F.col("neg") + 0.5) / size["neg"]).orderBy(
        (F.col("pos") / size["pos"] - F.col("neg") / size["neg"]).desc(), "f").limit(4 * max_features).collect()
    if not found:
        return []
    g = g_squared(np.array([r["pos"] for r in found], float), np.array([r["neg"] for r in found], float),
                  size["pos"], size["neg"])
    ranked = sorted(((r["f"], float(x)) for r, x in zip(found, g) if x > 2 * np.log(n_features) + 6),
                    key=lambda fx: (-fx[1], fx[0]))
    return ranked[:max_features]


class Lexicon:
    """Feature numbers and the text voters."""

    def __init__(self, mined: list[str]):
        self.names = list(dict.fromkeys(LEXICON + mined))
        self.number = {f: i for i, f in enumerate(self.names)}
        fixed, found = set(LEXICON), set(mined)
        self.known = np.array([f in fixed for f in self.names])
        self.word = np.array([f in found and f[0] != "^" for f in self.names])
        self.begin = np.array([f[-1] == "+" for f in self.names])
        self.stems = {f.rstrip("+") for f in self.names if f[0] == "^"}

    def read(self, text: str | None) -> tuple[list[int], list[int]]:
        """Feature numbers of a text, and the votes (1 toxic, 0 clean, -1 none) of all voters but the label."""
        if not text:
            return [], [-1, -1, -1, -1, -1, -1, -1]
        number, stems = self.number, self.stems
        words: set[str] = set()
        for piece in pieces(text, SPACE):
            words.update(WORD.findall(piece.lower()))
        found = {number[w] for w in words if w in number}
        begin: Counter = Counter()
        for w in words:
            if len(w) > 4:
                mark = "^" + w
                for n in (5, 6, 7):  # the caret and 4, 5 or 6 letters
                    if len(w) >= n and mark[:n] in stems:
                        begin[mark[:n]] += 1
        for f, n in begin.items():
            found |= {number[x] for x in (f, f + "+")[:n] if x in number}
        nums = sorted(found)
        at = np.array(nums, np.int64)
        known, word, several = (int(x[at].sum()) if len(at) else 0 for x in (self.known, self.word, self.begin))
        direct = known and any(m.group(1).lower() in number for m in YOU.finditer(text))
        loud = text.count("!!") >= 5
        vote = lambda yes: 1 if yes else -1
        return nums, [vote(known), vote(word), vote(several), vote(known + word + several >= 3), vote(direct), vote(loud),
                      -1 if nums else 0]


class LabelModel:
    """P(class) and, for every group of correlated voters, P(joint vote | class), by EM on pattern counts."""

    def __init__(self, voters: int):
        self.groups = [[j] for j in range(voters)]
        self.prior = 0.1
        self.tables: list[dict] = []

    @staticmethod
    def _start(patterns: np.ndarray) -> np.ndarray:
        """First posteriors: the label where there is one, else votes for toxic against votes for clean."""
        yes, no = (patterns[:, :-1] == 1).sum(axis=1), (patterns[:, :-1] == 0).sum(axis=1)
        p = 1 / (1 + np.exp(-(1.5 * yes - 3.0 * no - 1.0)))
        return np.where(patterns[:, -1] == 1, 0.98, np.where(patterns[:, -1] == 0, 0.02, p))

    def _fit_tables(self, patterns, counts, post) -> None:
        w1, w0 = counts * post, counts * (1 - post)
        self.prior = float((w1.sum() + 1) / (counts.sum() + 2))
        self.tables = []
        for g in self.groups:
            if g == [patterns.shape[1] - 1]:  # a given label anchors the classes: its error is not up for estimation
                self.tables.append({(-1,): (1.0, 1.0), (1,): (1 - LABEL_ERROR, LABEL_ERROR), (0,): (LABEL_ERROR, 1 - LABEL_ERROR)})
                continue
            keys, inv = np.unique(patterns[:, g], axis=0, return_inverse=True)
            inv = inv.ravel()
            a, b = np.bincount(inv, w1, len(keys)) + 0.5, np.bincount(inv, w0, len(keys)) + 0.5
            self.tables.append({tuple(k): (x, y) for k, x, y in zip(
                keys.tolist(), a / a.sum(), b / b.sum())})

    def posterior(self, patterns: np.ndarray, without: tuple[int, ...] = ()) -> np.ndarray:
        """P(toxic) of every vote pattern, by all groups but those that hold a voter of ``without``."""
        logit = np.full(len(patterns), np.log(self.prior / (1 - self.prior)))
        for g, t in zip(self.groups, self.tables):
            if set(g) & set(without):
                continue
            logit += np.array([np.log(x / y) for x, y in (t.get(tuple(k), (1.0, 1.0)) for k in patterns[:, g].tolist())])
        return 1 / (1 + np.exp(-np.clip(logit, -30, 30)))

    def _correlated(self, patterns, counts, limit: float) -> list[list[int]]:
        """Voters joined where their votes correlate within a class beyond ``limit``; the class is
        judged by the other voters, as two that agree would define it by themselves."""
        m = patterns.shape[1]
        parent = list(range(m))
        for i in range(m - 1):
            for j in range(i):
                post = self.posterior(patterns, without=(i, j))
                for w in (counts * post, counts * (1 - post)):
                    x, y = (patterns[:, c] - np.average(patterns[:, c], weights=w) for c in (i, j))
                    sx, sy = np.sqrt(np.average(x * x, weights=w)), np.sqrt(np.average(y * y, weights=w))
                    if min(sx, sy) > 1e-2 and abs(np.average(x * y, weights=w)) > limit * sx * sy:
                        a, b = parent[i], parent[j]
                        parent = [min(a, b) if p == max(a, b) else p for p in parent]
                        break
        return [[j for j in range(m) if parent[j] == r] for r in sorted(set(parent))]

    def fit(self, patterns: np.ndarray, counts: np.ndarray, rounds: int = 50, limit: float = 0.3) -> None:
        post = self._start(patterns)
        for phase in range(2):
            for _ in range(rounds):
                self._fit_tables(patterns, counts, post)
                new = self.posterior(patterns)
                done = np.abs(new - post).max() < 1e-6
                post = new
                if done:
                    break
            if phase == 0:
                self.groups = self._correlated(patterns, counts, limit)
                post = self._start(patterns)

    def accuracies(self) -> dict[str, tuple[float, float]]:
        """Per voter but the label: P(toxic vote | toxic) and P(toxic vote | clean)."""
        out = {}
        for g, t in list(zip(self.groups, self.tables))[:-1]:
            for at, j in enumerate(g):
                out[VOTERS[j]] = tuple(float(sum(p[c] for k, p in t.items() if k[at] == 1)) for c in (0, 1))
        return out


def fit_linear(rows: list[list[int]], target: np.ndarray, n_features: int, steps: int = 400, l2: float = 3e-4):
    """Logistic regression on presence features with probabilities as targets; classes weighted equally.

    Full-batch gradient steps with momentum on the (bounded) sample."""
    at = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    col = np.fromiter((i for r in rows for i in r), np.int64, len(at))
    share = np.clip(target.mean(), 0.02, 0.98)
    weight = target * 0.5 / share + (1 - target) * 0.5 / (1 - share)
    weight /= weight.sum()
    w, b = np.zeros(n_features), 0.0
    vw, vb = np.zeros(n_features), 0.0
    for _ in range(steps):
        z = np.bincount(at, w[col], len(rows)) + b
        p = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
        d = (p - target) * weight
        gw, gb = np.bincount(col, d[at], n_features) + l2 * w, d.sum()
        vw, vb = 0.9 * vw - 2.0 * gw, 0.9 * vb - 2.0 * gb
        w, b = w + vw, b + vb
    return w, float(b)


def score(docs: DataFrame, labels: DataFrame, max_labelled: int = MAX_LABELLED, max_features: int = MAX_FEATURES,
          max_rows: int = 30_000) -> DataFrame:
    """``doc_id, score, predicted``; ``labels`` (doc_id, toxic) are the only ones learned from."""
    spark = docs.sparkSession
    python_tasks(spark)
    labels = labels.where(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(
        F.max("toxic").cast("int").alias("toxic"))
    lexicon = Lexicon([f for f, _ in mine(docs, labels, max_labelled, max_features)])

    @F.arrow_udf("struct<nums:array<int>,votes:array<int>>")
    def read(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for arr in batches:
            got = [lexicon.read(t.as_py()) for t in arr]
            yield pa.StructArray.from_arrays(
                [pa.array([g[0] for g in got], pa.list_(pa.int32())), pa.array([g[1] for g in got], pa.list_(pa.int32()))],
                names=["nums", "votes"])

    rows = written(docs.select("doc_id", read(F.col("text").cast("string")).alias("r")).select("doc_id", "r.*"), "votes")
    voted = rows.join(labels, "doc_id", "left").select(
        "nums", F.concat("votes", F.array(F.coalesce("toxic", F.lit(-1)))).alias("votes"),
        F.pmod(F.xxhash64("doc_id", F.lit(37)), F.lit(1 << 20)).alias("h"))
    tally = voted.groupBy("votes").count().orderBy("votes").collect()  # at most 3 ** voters rows
    if not tally:
        return spark.createDataFrame([], "doc_id long, score double, predicted int")
    patterns = np.array([list(r["votes"]) for r in tally])
    counts = np.array([r["count"] for r in tally], float)
    model = LabelModel(patterns.shape[1])
    model.fit(patterns, counts)
    # the regression's rows: toxic and clean by their votes, about max_rows / 2 of each
    post = model.posterior(patterns)
    likely = {tuple(p): q for p, q in zip(patterns.tolist(), post.tolist())}
    big = {c: max(1.0, float(counts[(post >= 0.5) == c].sum())) for c in (True, False)}
    toxic = [list(k) for k, q in likely.items() if q >= 0.5]
    is_toxic = F.array_join("votes", ",").isin([",".join(map(str, k)) for k in toxic]) if toxic else F.lit(False)
    share = F.when(is_toxic, min(1.0, max_rows / 2 / big[True])).otherwise(min(1.0, max_rows / 2 / big[False]))
    sample = voted.where(F.col("h") < share * float(1 << 20)).select("nums", "votes").collect()
    sample.sort(key=lambda r: (r["votes"], r["nums"]))
    w, b = fit_linear([list(r["nums"]) for r in sample],
                      np.array([likely[tuple(r["votes"])] for r in sample]), len(lexicon.names))

    @F.arrow_udf("double")
    def linear(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for arr in batches:
            out = [w[np.array(x, np.int64)].sum() + b for x in arr.to_pylist()]
            yield pa.array(1 / (1 + np.exp(-np.clip(np.array(out, float), -30, 30))), pa.float64())

    scored = rows.select("doc_id", linear("nums").alias("score"))
    return scored.select("doc_id", "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def held_out(col):
    return split_crc(col, 5) == 0


def op1_weak_supervision_toxicity(spark, sf_dir: str) -> DataFrame:
    labels = table(spark, sf_dir, "labels").where(~held_out(F.col("doc_id")))
    found = score(documents(spark, sf_dir).select("doc_id", "text"), labels.select("doc_id", "toxic"))
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")
