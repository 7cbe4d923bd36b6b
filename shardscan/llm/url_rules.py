"""URL filters with a bit-parallel wildcard automaton.

All glob rules are packed into one Shift-And automaton.  A pattern of m symbols owns m + 1
neighbouring bits, its states 0 to m, spread over 64-bit words.  Per byte c of a URL, with
``D`` the live states,

    D = ((D << 1) & STEP[c]) | (D & STAY[c])

moves every pattern at once (the shift carries from word to word): ``STEP[c]`` has the states
that a symbol c leads to, ``STAY[c]`` those that a wildcard keeps.  A pattern fits when its last
state is live at the end, so patterns are anchored at both ends.

Globs: ``**`` any bytes, ``*`` any bytes but ``/``, ``?`` one byte but ``/``; ``\\`` takes the next character as
it is; everything else stands for itself.  They run over the canonical URL, host and path: the host is
what follows the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; the path goes from there up to
``?``, ``#`` or the end.

A rule (verdict, host, path) fits its host and all subdomains where the URL's path starts with the
rule's path: two globs, ``host path**`` and ``*.host path**``.  Of the rules that fit, the longest (host and path,
then host, then the earlier one) decides.  Where none fits, the block globs do: one that fits blocks,
otherwise the URL is allowed.

The masks go to the tasks in their closure: 2 x 256 words per 64 states, so their size is that of
the rules, not of the URLs, and more than ``MAX_STATES`` states are refused.  URLs are walked side by side, a batch
at a time, dead ones left out; the last few long ones of a batch go on by themselves, with the
same masks as one wide integer.  One pass, no shuffle.

Defined results: a null URL, or one without ``://``, has an empty host and path, fits no rule and is judged by
the globs alone; URLs of any length are read whole; repeated rows get equal results; ids may be null; an empty
table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shardscan.llm.common import python_tasks, table, utf8_parts

MAX_STATES = 1 << 20
#: Bytes of live states held for one batch of URLs.
BATCH_BYTES = 8 << 20
#: A batch with no more live URLs than this goes on URL by URL.
FEW = 16


@dataclass(frozen=True)
class Rule:
    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path

    def globs(self) -> tuple[str, str]:
        host, path = escape(self.host), escape(self.path)
        return f"{host}{path}**", f"*.{host}{path}**"


#: The rules of the registered query.
RULES = (Rule("allow", "com", "/"), Rule("block", "example.com", "/en/"), Rule("allow", "www.example.com", "/en/"),
         Rule("block", "net", "/es/"), Rule("block", "net", "/fr/"))
#: What no rule judges is blocked when one of these fits: gambling and adult hosts, and session or tracker paths.
BLOCK_GLOBS = ("*casino*/**", "*casino*", "*free-bets*/**", "*free-bets*", "*xxx*/**", "*xxx*", "**/cgi-bin/**", "**/track/**")


def escape(text: str) -> str:
    return "".join("\\" + c if c in "*?\\" else c for c in text)


def symbols(glob: str) -> list[int | str]:
    """Bytes (0-255) and the wildcards ``**``, ``*``, ``?`` of a glob, in order."""
    out: list[int | str] = []
    i = 0
    while i < len(glob):
        c = glob[i]
        if c == "\\" and i + 1 < len(glob):
            out += glob[i + 1].encode()
            i += 2
        elif glob.startswith("**", i):
            out.append("**")
            i += 2
        elif c in "*?":
            out.append(c)
            i += 1
        else:
            out += c.encode()
            i += 1
    return out


class ShiftAnd:
    """The automaton of many globs: masks per byte as wide integers and as 64-bit words."""

    def __init__(self, globs: Sequence[str]):
        step, stay = [0] * 256, [0] * 256
        any_byte, no_slash = range(256), [c for c in range(256) if c != 0x2F]
        self.first, self.last = 0, []
        state = 0
        for glob in globs:
            self.first |= 1 << state
            for s in symbols(glob):
                if s == "**" or s == "*":
                    for c in any_byte if s == "**" else no_slash:
                        stay[c] |= 1 << state
                else:
                    state += 1
                    for c in no_slash if s == "?" else [s]:
                        step[c] |= 1 << state
            self.last.append(state)
            state += 1
            if state > MAX_STATES:
                raise ValueError(f"the globs need more than {MAX_STATES} states")
        self.n_words = max(1, -(-state // 64))
        self.step, self.stay = step, stay
        self.step_words = np.array([self._words(m) for m in step])
        self.stay_words = np.array([self._words(m) for m in stay])
        self.first_words = self._words(self.first)
        self.last_word = np.array([s // 64 for s in self.last], np.int64)
        self.last_bit = np.array([s % 64 for s in self.last], np.uint64)

    def _words(self, mask: int) -> np.ndarray:
        return np.frombuffer(mask.to_bytes(self.n_words * 8, "little"), "<u8").astype(np.uint64)

    def _rest(self, live: np.ndarray, rest: bytes) -> np.ndarray:
        d = int.from_bytes(live.astype("<u8").tobytes(), "little")
        step, stay = self.step, self.stay
        for c in rest:
            d = ((d << 1) & step[c]) | (d & stay[c])
            if not d:
                break
        return self._words(d)

    def run(self, raw: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Live states (rows of words) after each of the strings ``raw[start:end]``."""
        n = len(start)
        live = np.tile(self.first_words, (n, 1))
        todo = np.flatnonzero(end > start)
        at = 0
        while len(todo) > FEW:
            c = raw[start[todo] + at]
            d = live[todo]
            moved = d << np.uint64(1)
            moved[:, 1:] |= d[:, :-1] >> np.uint64(63)
            d = (moved & self.step_words[c]) | (d & self.stay_words[c])
            live[todo] = d
            at += 1
            todo = todo[d.any(axis=1) & (start[todo] + at < end[todo])]
        for i in todo.tolist():
            live[i] = self._rest(live[i], raw[start[i] + at:end[i]].tobytes())
        return live

    def matches(self, raw: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """(strings, globs) booleans: which globs fit which strings, a bounded batch of strings at a time."""
        out = np.zeros((len(start), len(self.last)), bool)
        size = max(64, BATCH_BYTES // (8 * self.n_words))
        for a in range(0, len(start), size):
            live = self.run(raw, start[a:a + size], end[a:a + size])
            out[a:a + size] = (live[:, self.last_word] >> self.last_bit) & np.uint64(1)
        return out


def host_and_path(url: Column) -> tuple[Column, Column]:
    url = url.cast("string")
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    host = F.translate(F.regexp_extract(rest, "^[^/?#]*", 0), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return host, F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)


def matcher(rules: Sequence[Rule], block_globs: Sequence[str]):
    """Arrow UDF canonical URL -> the rule that decides, its verdict, and the first block glob that fits."""
    ranked = sorted(rules, key=lambda r: (-len(r.name), -len(r.host)))  # stable: the earlier one first
    of_rules = [g for r in ranked for g in r.globs()]
    automaton = ShiftAnd([*of_rules, *block_globs])
    cut = len(of_rules)
    names = pa.array([r.name for r in ranked], pa.string())
    verdicts = pa.array([r.verdict for r in ranked], pa.string())
    others = pa.array(list(block_globs), pa.string())

    def first(fits: np.ndarray, globs_each: int) -> pa.Array:
        """Number of the first that fits, else null."""
        if not fits.shape[1]:
            return pa.nulls(len(fits), pa.int64())
        return pa.array(fits.argmax(axis=1) // globs_each, pa.int64(), mask=~fits.any(axis=1))

    @F.arrow_udf("struct<rule:string,verdict:string,glob:string>")
    def decide(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for arr in batches:
            raw, off, null = utf8_parts(arr)
            fits = automaton.matches(raw, off[:-1], np.where(null, off[:-1], off[1:]))
            rule, glob = first(fits[:, :cut], 2), first(fits[:, cut:], 1)
            yield pa.StructArray.from_arrays([names.take(rule), verdicts.take(rule), others.take(glob)],
                                             names=["rule", "verdict", "glob"])

    return decide


def judge(pages: DataFrame, rules: Sequence[Rule] = RULES, block_globs: Sequence[str] = BLOCK_GLOBS,
          id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """``page_id, host, path, rule, verdict, block_glob`` of every row; ``block_glob`` is the first block glob that fits the URL,
    whether it decided or not."""
    python_tasks(pages.sparkSession)
    host, path = host_and_path(F.col(url_col))
    split = pages.select(F.col(id_col).alias("page_id"), host.alias("host"), path.alias("path"))
    judged = split.withColumn("fits", matcher(rules, block_globs)(F.concat("host", "path")))
    default = F.when(F.col("fits.glob").isNotNull(), F.lit("block")).otherwise(F.lit("allow"))
    return judged.select("page_id", "host", "path", "fits.rule", F.coalesce("fits.verdict", default).alias("verdict"),
                         F.col("fits.glob").alias("block_glob"))


def op11_url_wildcard_filter(spark, sf_dir: str) -> DataFrame:
    return judge(table(spark, sf_dir, "pages"))


def _rule_sql(rule: Rule) -> str:
    return (f"((host = '{rule.host}' OR ends_with(host, '.{rule.host}')) AND starts_with(path, '{rule.path}'))")


_BY_LENGTH = sorted(RULES, key=lambda r: -len(r.name))
URL_SQL = f"""
WITH u AS (SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
p AS (SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
        regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM u),
g AS (SELECT *, CASE WHEN regexp_matches(host, 'casino') AND path <> '' THEN '*casino*/**' WHEN regexp_matches(host, 'casino') THEN '*casino*'
        WHEN regexp_matches(host, 'free-bets') AND path <> '' THEN '*free-bets*/**' WHEN regexp_matches(host, 'free-bets') THEN '*free-bets*'
        WHEN regexp_matches(host, 'xxx') AND path <> '' THEN '*xxx*/**' WHEN regexp_matches(host, 'xxx') THEN '*xxx*'
        WHEN contains(path, '/cgi-bin/') THEN '**/cgi-bin/**' WHEN contains(path, '/track/') THEN '**/track/**' END AS block_glob FROM p)
SELECT page_id, host, path, CASE {' '.join(f"WHEN {_rule_sql(r)} THEN '{r.name}'" for r in _BY_LENGTH)} END AS rule,
  CASE {' '.join(f"WHEN {_rule_sql(r)} THEN '{r.verdict}'" for r in _BY_LENGTH)} WHEN block_glob IS NOT NULL THEN 'block' ELSE 'allow' END AS verdict,
  block_glob FROM g"""
