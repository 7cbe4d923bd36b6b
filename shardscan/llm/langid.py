"""Language identification with a byte convolutional network.

A text is cut into fixed-length byte windows.  Each byte is an embedding;
filters of several widths slide over a window, the largest response of each
filter is kept (max pooling), and a softmax layer gives the languages'
probabilities.  The text's language has the largest sum of log-probabilities
over all windows, weighted by their letters; the score is that language's
weighted mean probability.

Training runs in numpy on the driver on a bounded sample: about ``per_language``
labelled texts of each language (by id hash, known before reading any text), fewer where all languages together
would be more than ``max_sample``, two windows of each at hash-chosen offsets.  Every language that occurs is learned.  The weights have a fixed size and go to the
tasks in their closure.  Scoring reads every byte of every text; because
embedding and first filter layer are both linear, the filters are applied as sums of
two looked-up rows for byte pairs instead of products.

Defined results: a null text, or one without a letter, is ``und`` with score 0;
empty tables give empty results; repeated rows get equal results; null or unlabelled
rows are not learned from; if nothing can be learned every text is ``und``; other columns
pass through.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shardscan.llm.common import documents, python_tasks, split_crc, utf8_parts

WINDOW = 256
WIDTHS = (2, 3, 4)
FILTERS = 12
DIM = 8
PER_LANGUAGE = 1500
MAX_SAMPLE = 300_000
LETTER = regex.compile(r"\p{L}")


def _symbols() -> np.ndarray:
    """Byte -> symbol: letters without case, all other ASCII by kind, every high byte by itself."""
    out = np.zeros(256, np.uint8)
    for b in range(1, 128):
        c = chr(b)
        out[b] = (3 + ord(c.lower()) - 97) if c.isalpha() else 1 if c.isspace() else 2
    out[128:] = 29 + np.arange(128)
    return out


SYMBOLS = _symbols()
N_SYMBOLS = 157
IS_LETTER = (SYMBOLS >= 3).astype(np.float32)


class ByteCnn:
    """Embedding, multi-width filters, max pooling, softmax; trained by Adam."""

    def __init__(self, languages: list[str], seed: int = 7):
        rng = np.random.default_rng(seed)
        self.languages = languages
        self.p = {"E": rng.normal(0, 0.3, (N_SYMBOLS, DIM))}
        for w in WIDTHS:
            self.p[f"W{w}"] = rng.normal(0, 1 / np.sqrt(w * DIM), (w * DIM, FILTERS))
            self.p[f"b{w}"] = np.zeros(FILTERS)
        self.p["D"] = rng.normal(0, 0.1, (len(WIDTHS) * FILTERS, len(languages)))
        self.p["d"] = np.zeros(len(languages))
        self.p = {k: v.astype(np.float32) for k, v in self.p.items()}
        self.tables: tuple | None = None

    def _forward(self, x: np.ndarray):
        emb = self.p["E"][x]
        n, length = x.shape
        parts, kept = [], []
        for w in WIDTHS:
            cols = np.concatenate([emb[:, j:length - WIDTHS[-1] + 1 + j] for j in range(w)], axis=2)
            z = cols @ self.p[f"W{w}"] + self.p[f"b{w}"]
            at = z.argmax(axis=1)
            top = np.take_along_axis(z, at[:, None, :], axis=1)[:, 0]
            parts.append(np.maximum(top, 0))
            kept.append((cols, at, top > 0))
        h = np.concatenate(parts, axis=1)
        z = h @ self.p["D"] + self.p["d"]
        e = np.exp(z - z.max(axis=1, keepdims=True))
        return h, kept, e / e.sum(axis=1, keepdims=True)

    def _gradients(self, x: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
        h, kept, prob = self._forward(x)
        n = len(x)
        dz = prob.copy()
        dz[np.arange(n), y] -= 1
        dz /= n
        g = {"D": h.T @ dz, "d": dz.sum(axis=0), "E": np.zeros_like(self.p["E"])}
        dh = dz @ self.p["D"].T
        rows = np.arange(n)[:, None]
        for i, w in enumerate(WIDTHS):
            cols, at, on = kept[i]
            dt = dh[:, i * FILTERS:(i + 1) * FILTERS] * on
            picked = cols[rows, at]  # (n, filters, w * dim): the input under each filter's maximum
            g[f"W{w}"] = np.einsum("nfc,nf->cf", picked, dt)
            g[f"b{w}"] = dt.sum(axis=0)
            back = dt[:, :, None] * self.p[f"W{w}"].T[None]
            for j in range(w):
                np.add.at(g["E"], x[rows, at + j], back[:, :, j * DIM:(j + 1) * DIM])
        return g

    def fit(self, x: np.ndarray, y: np.ndarray, steps: int = 700, batch: int = 64, rate: float = 0.01) -> None:
        rng = np.random.default_rng(11)
        m = {k: np.zeros_like(v) for k, v in self.p.items()}
        v2 = {k: np.zeros_like(v) for k, v in self.p.items()}
        by_class = [np.flatnonzero(y == c) for c in range(len(self.languages))]
        for t in range(1, steps + 1):
            lang = rng.integers(0, len(by_class), batch)  # languages equally often
            pick = np.array([by_class[c][rng.integers(len(by_class[c]))] for c in lang])
            step = rate * (1 - t / (steps + 1))
            for k, g in self._gradients(x[pick], y[pick]).items():
                m[k] = 0.9 * m[k] + 0.1 * g
                v2[k] = 0.999 * v2[k] + 0.001 * g * g
                self.p[k] = (self.p[k] - step * (m[k] / (1 - 0.9 ** t)) / (
                    np.sqrt(v2[k] / (1 - 0.999 ** t)) + 1e-8)).astype(np.float32)

    def _pair_tables(self):
        """Filter responses as sums of two rows: pair (i, i+1) and pair (i+2, i+3)."""
        e = self.p["E"]
        part = {(w, j): e @ self.p[f"W{w}"][j * DIM:(j + 1) * DIM] for w in WIDTHS for j in range(w)}
        first = np.concatenate([part[w, 0][:, None] + part[w, 1][None] + self.p[f"b{w}"] for w in WIDTHS], axis=2)
        rest = [part[3, 2][:, None] + np.zeros_like(part[4, 3])[None], part[4, 2][:, None] + part[4, 3][None]]
        size = N_SYMBOLS * N_SYMBOLS
        return (np.ascontiguousarray(first.reshape(size, -1), dtype=np.float32),
                np.ascontiguousarray(np.concatenate(rest, axis=2).reshape(size, -1), dtype=np.float32))

    def window_probabilities(self, x: np.ndarray) -> np.ndarray:
        """(windows, languages) for windows of symbols padded by zeros."""
        if self.tables is None:
            self.tables = self._pair_tables()
        first, rest = self.tables
        out = np.empty((len(x), len(self.languages)), np.float32)
        block = 32
        for at in range(0, len(x), block):
            s = x[at:at + block].astype(np.int32)
            pair = s[:, :-1] * N_SYMBOLS + s[:, 1:]
            a = np.take(first, pair[:, :-2], axis=0)
            a[:, :, FILTERS:] += np.take(rest, pair[:, 2:], axis=0)
            h = np.maximum(a.max(axis=1), 0)
            z = h @ self.p["D"] + self.p["d"]
            e = np.exp(z - z.max(axis=1, keepdims=True))
            out[at:at + block] = e / e.sum(axis=1, keepdims=True)
        return out


def _windows(sym: np.ndarray, off: np.ndarray, end: np.ndarray):
    """Windows that cover each text [off, end) of ``sym`` and the text each belongs to."""
    n = np.maximum((end - off + WINDOW - 1) // WINDOW, 0)
    doc = np.repeat(np.arange(len(off)), n)
    first = np.cumsum(n) - n
    start = off[doc] + (np.arange(len(doc)) - first[doc]) * WINDOW
    return doc, start, np.minimum(start + WINDOW, end[doc])


def predict_batch(model: ByteCnn, arr: pa.Array, block: int = 2048) -> tuple[np.ndarray, np.ndarray]:
    """(index of the language or -1, score) of every text of an Arrow string array."""
    raw, off, null = utf8_parts(arr)
    n, k = len(arr), len(model.languages)
    doc, start, stop = _windows(raw, off[:-1], np.where(null, off[:-1], off[1:]))
    logs, probs, weight, plain = np.zeros((n, k)), np.zeros((n, k)), np.zeros(n), np.zeros(n)
    grid = np.arange(WINDOW)
    for at in range(0, len(doc), block):
        s, e, d = start[at:at + block], stop[at:at + block], doc[at:at + block]
        idx = s[:, None] + grid
        inside = idx < e[:, None]
        win = raw[np.where(inside, idx, 0)]
        x = np.where(inside, SYMBOLS[win], 0).astype(np.uint8)
        w = np.where(inside, IS_LETTER[win], 0).sum(axis=1)
        p = model.window_probabilities(x)
        np.add.at(logs, d, np.log(p + 1e-6) * w[:, None])
        np.add.at(probs, d, p * w[:, None])
        np.add.at(weight, d, w)
        np.add.at(plain, d, ((x >= 3) & (x <= 28)).sum(axis=1))
    best = logs.argmax(axis=1)
    score = probs[np.arange(n), best] / np.maximum(weight, 1)
    for i in np.flatnonzero(plain == 0).tolist():  # no ASCII letter: look at the characters themselves
        if weight[i] == 0 or not LETTER.search(arr[i].as_py()):
            best[i], score[i] = -1, 0.0
    return best, np.clip(score, 0, 1)


def train(labelled: DataFrame, per_language: int = PER_LANGUAGE, max_sample: int = MAX_SAMPLE, text_col: str = "text",
          lang_col: str = "lang", id_col: str = "doc_id") -> ByteCnn | None:
    """Fit the network on a bounded sample: about ``per_language`` texts of each language, ``max_sample`` in all, two windows
    of each text.  None when nothing is labelled."""
    python_tasks(labelled.sparkSession)
    rows = labelled.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull()).select(
        F.col(id_col).cast("string").alias("id"), F.col(text_col).cast("string").alias("text"),
        F.col(lang_col).cast("string").alias("lang"))
    counts = {r["lang"]: r["count"] for r in rows.groupBy("lang").count().collect()}  # one row a language
    if len(counts) < 1:
        return None
    each = min(per_language, max(1, max_sample // len(counts)))
    share = F.create_map(*[x for k, c in sorted(counts.items()) for x in (F.lit(k), F.lit(min(1.0, each / c)))])
    draw = F.pmod(F.xxhash64("id", F.lit(17)), F.lit(1 << 20)) / float(1 << 20)
    some = rows.where(draw < F.try_element_at(share, F.col("lang"))).withColumn("h", F.xxhash64("id", F.lit(23)))

    def cut(batches):
        for b in batches:
            raw, off, _ = utf8_parts(b.column("text"))
            out, langs = [], []
            for i, (h, lang) in enumerate(zip(b.column("h").to_pylist(), b.column("lang").to_pylist())):
                size = int(off[i + 1] - off[i])
                for turn in range(2 if size > WINDOW else 1):
                    at = (h >> (20 * turn)) % max(1, size - WINDOW + 1)
                    out.append(raw[off[i] + at:off[i] + min(at + WINDOW, size)].tobytes())
                    langs.append(lang)
            yield pa.RecordBatch.from_arrays([pa.array(langs, pa.string()), pa.array(out, pa.binary())],
                                             names=["lang", "win"])

    got = some.mapInArrow(cut, "lang string, win binary").collect()
    got = sorted((r["lang"], bytes(r["win"])) for r in got if IS_LETTER[np.frombuffer(bytes(r["win"]), np.uint8)].sum() >= 3)
    languages = sorted({lang for lang, _ in got})
    if not languages:
        return None
    x = np.zeros((len(got), WINDOW), np.uint8)
    for i, (_, w) in enumerate(got):
        x[i, :len(w)] = SYMBOLS[np.frombuffer(w, np.uint8)]
    y = np.array([languages.index(lang) for lang, _ in got])
    model = ByteCnn(languages)
    model.fit(x, y)
    return model


def predictor(model: ByteCnn | None):
    """Arrow UDF text -> struct(lang_pred, score)."""
    @F.arrow_udf("struct<lang_pred:string,score:double>")
    def predict(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for arr in batches:
            if model is None:
                best, score = np.full(len(arr), -1), np.zeros(len(arr))
            else:
                best, score = predict_batch(model, arr)
            names = ["und" if b < 0 else model.languages[b] for b in best.tolist()]
            yield pa.StructArray.from_arrays([pa.array(names, pa.string()), pa.array(score, pa.float64())],
                                             names=["lang_pred", "score"])

    return predict


def held_out(col: Column) -> Column:
    return split_crc(col, 4) == 2


def identify(docs: DataFrame, labelled: DataFrame, out: str = "lid") -> DataFrame:
    """``docs`` and a struct ``out`` of (lang_pred, score) from a model learned on ``labelled``."""
    return docs.withColumn(out, predictor(train(labelled))(F.col("text").cast("string")))


def op3_byte_cnn_language_id(spark, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text", "lang")
    found = identify(docs.select("doc_id", "text"), docs.where(~held_out(F.col("doc_id"))))
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lid.lang_pred", "lid.score")
