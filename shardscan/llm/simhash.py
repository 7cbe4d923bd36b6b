"""SimHash near-duplicates by covering locality-sensitive hashing.

A 64-bit fingerprint per text (word shingles, XXH64, bitwise majority).
Fingerprints at a Hamming distance of at most ``radius`` are linked; the
candidates come from a *covering* family of bit masks.  Every bit position
gets a label, a non-zero vector of ``radius + 1`` bits; the mask of a
non-zero vector ``v`` keeps the positions whose label has an odd inner product
with ``v``.  At most ``radius`` differing positions span at most ``radius``
dimensions, so some ``v`` is orthogonal to all their labels: the pair agrees
on that whole mask and meets in that table.  2**(radius+1) - 1 tables, no
false negatives.

Groups are handled without all-pairs output: equal texts and equal
fingerprints are one node; a bucket emits a spanning forest of its links; a
bucket with more than ``bucket_rows`` distinct fingerprints is cut again by a
covering family over the bits its mask leaves free, which bounds its size by
the number of values of the bits still free (4,096 at radius 2).

Defined results: null and empty texts have fingerprint zero and link like any
other; fewer words than the shingle are one shingle; rows repeated in the
input are repeated in the result; a null ``doc_id`` keeps its row and never
names a component unless no id is left (then null); an empty table gives an
empty result; other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shardscan.llm.common import fresh, pieces, python_tasks, texts, written

_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
SEED = 42
SPACE = re.compile(rb"[\x20\x09-\x0D]")
BLOCK = 1 << 16


def shingle_hashes(text: bytes, shingle: int) -> Iterator[np.ndarray]:
    """XXH64 of every word shingle, in arrays; fewer words than a shingle are one."""
    digest, held, some = xxhash.xxh64_intdigest, [], False
    for piece in pieces(text.translate(_LOWER), SPACE):
        held += piece.split()
        n = len(held) - shingle + 1
        if n < 1:
            continue
        some = True
        joined = b" ".join(held)
        ends = np.cumsum(np.fromiter(map(len, held), np.int64, len(held)) + 1) - 1
        starts = np.concatenate(([0], ends[:-1] + 1))[:n].tolist()
        yield np.fromiter((digest(joined[a:b], SEED) for a, b in zip(starts, ends[shingle - 1:].tolist())), np.uint64, n)
        held = held[n:]  # the last words begin shingles of the next piece
    if held and not some:
        yield np.array([digest(b" ".join(held), SEED)], np.uint64)


def fingerprint(text: bytes, shingle: int = 3) -> int:
    """The fingerprint of one UTF-8 text as an unsigned integer."""
    n, counts = 0, np.zeros(64, np.int64)
    for hashes in shingle_hashes(text, shingle):
        for at in range(0, len(hashes), BLOCK):
            h = hashes[at:at + BLOCK]
            bits = np.unpackbits(h.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            counts += bits.sum(axis=0, dtype=np.int64)
        n += len(hashes)
    return int(np.packbits((2 * counts > n).astype(np.uint8), bitorder="little").view("<u8")[0])


def with_fingerprint(docs: DataFrame, out: str, text_col: str = "text", shingle: int = 3) -> DataFrame:
    """``docs`` with the signed 64-bit fingerprint of its text in column ``out``."""
    python_tasks(docs.sparkSession)

    @F.arrow_udf("long")
    def prints(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for arr in batches:
            fp = np.fromiter((fingerprint(t, shingle) for t in texts(arr)), np.uint64, len(arr))
            yield pa.array(fp.view(np.int64))

    return docs.withColumn(out, prints(F.col(text_col).cast("string")))


def covering_masks(positions: list[int], radius: int) -> list[int]:
    """One mask per non-zero vector of radius + 1 bits, over the given bit positions."""
    n = (1 << (radius + 1)) - 1
    label = {p: i % n + 1 for i, p in enumerate(positions)}
    return [sum(1 << p for p in positions if (label[p] & v).bit_count() & 1) for v in range(1, n + 1)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


def _masked(fp, masks: list[tuple[int, int]]):
    """Array of (table, key) structs: the fingerprint under each mask."""
    return F.array(*[F.struct(F.lit(t).alias("t"), fp.bitwiseAND(F.lit(_signed(m))).alias("k")) for t, m in masks])


def _forest(fps: np.ndarray, radius: int) -> list[tuple[int, int]]:
    """Links that join every fingerprint to what it reaches within ``fps`` (distinct values)."""
    m, out = len(fps), []
    if m == 2:
        return [(0, 1)] if int(np.bitwise_count(fps[0] ^ fps[1])) <= radius else []
    root = np.arange(m)

    def find(x: int) -> int:
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for i in range(m - 1):
        near = np.flatnonzero(np.bitwise_count(fps[i + 1:] ^ fps[i]) <= radius) + i + 1
        for j in near.tolist():
            a, b = find(i), find(j)
            if a != b:
                root[max(a, b)] = min(a, b)
                out.append((i, j))
    return out


def links(nodes: DataFrame, radius: int = 2, bucket_rows: int = 1024) -> DataFrame:
    """Links ``(a, b)`` between distinct fingerprints (column ``fp``) whose closure is
    the closure of all pairs within ``radius``."""
    python_tasks(nodes.sparkSession)
    masks = covering_masks(list(range(64)), radius)
    keys = nodes.select("fp", F.explode(_masked(F.col("fp"), list(enumerate(masks)))).alias("x")).select(
        "fp", "x.t", "x.k")
    sized = keys.groupBy("t", "k").count().where("count > 1")
    some = sized.where(F.col("count") <= bucket_rows).select("t", "k")
    many = sized.where(F.col("count") > bucket_rows).select("t", "k")
    finer = []
    for t, m in enumerate(masks):
        free = [p for p in range(64) if not m >> p & 1]
        finer += [(t, 64 + t * 64 + j, m | s) for j, s in enumerate(covering_masks(free, radius))]
    hot = keys.join(many, ["t", "k"], "left_semi").select("t", "fp")
    cut = hot.select("fp", F.explode(F.filter(
        F.array(*[F.struct(F.lit(t).alias("of"), F.lit(u).alias("t"),
                           F.col("fp").bitwiseAND(F.lit(_signed(m))).alias("k")) for t, u, m in finer]),
        lambda x: x["of"] == F.col("t"))).alias("x")).select("fp", "x.t", "x.k")
    buckets = keys.join(some, ["t", "k"], "left_semi").select("fp", "t", "k").unionByName(cut)

    def forest(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rest = None
        for pdf in batches:  # sorted by bucket: the last bucket of a batch may go on in the next
            if rest is not None and len(rest):
                pdf = pd.concat([rest, pdf], ignore_index=True)
            t, k = pdf["t"].to_numpy(), pdf["k"].to_numpy()
            new = np.flatnonzero((t[1:] != t[:-1]) | (k[1:] != k[:-1])) + 1
            cutoff = int(new[-1]) if len(new) else 0
            rest = pdf.iloc[cutoff:]
            yield in_buckets(pdf["fp"].to_numpy()[:cutoff], new[:-1] if len(new) else new)
        if rest is not None:
            yield in_buckets(rest["fp"].to_numpy(), np.zeros(0, np.int64))

    def in_buckets(fps: np.ndarray, new: np.ndarray) -> pd.DataFrame:
        edges = np.concatenate(([0], new, [len(fps)])).astype(np.int64)
        a, b = [], []
        for s, e in zip(edges[:-1].tolist(), edges[1:].tolist()):
            if e - s > 1:
                part = fps[s:e].view(np.uint64)
                for i, j in _forest(part, radius):
                    a.append(fps[s + i])
                    b.append(fps[s + j])
        return pd.DataFrame({"a": np.array(a, np.int64), "b": np.array(b, np.int64)})

    return (buckets.repartition("t", "k").sortWithinPartitions("t", "k")
            .mapInPandas(forest, "a long, b long").distinct())


def components(edges: DataFrame, max_rounds: int = 100) -> DataFrame:
    """``(node, root)`` for every node with a link; root is the least node it reaches.

    Alternating large-star / small-star rounds over tables in the shared folder:
    links only, never a component, in one place."""
    cur = written(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
                  .where("u <> v").distinct(), "links")
    seen = None
    for _ in range(max_rounds):
        both = cur.unionByName(cur.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u <> v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        cur = written(small.unionByName(least.select("u", F.col("m").alias("v"))).where("u > v").distinct(), "links")
        now = cur.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == seen:
            break
        seen = now
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    return cur.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        cur.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3,
                    radius: int = 2, bucket_rows: int = 1024) -> DataFrame:
    """One row per document: ``doc_id``, ``fp`` (signed 64-bit fingerprint), ``text_hash``,
    ``root`` (least fingerprint of its component) and ``component_id``."""
    src = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    prints = written(with_fingerprint(src, "fp", "text", shingle).select(
        "doc_id", "fp", F.xxhash64("text").alias("text_hash")), "fingerprints")
    nodes = written(prints.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "nodes")
    comp = components(links(nodes.select("fp"), radius, bucket_rows))
    joined = nodes.join(comp, nodes.fp == comp.node, "left").select(
        "fp", "first_id", F.coalesce("root", "fp").alias("root"))
    named = joined.groupBy("root").agg(F.min("first_id").alias("component_id"))
    labels = joined.select("fp", "root").join(named, "root")
    return prints.join(labels, "fp").select("doc_id", "fp", "text_hash", "root", "component_id")


def op10_simhash_near_dedup(spark, sf_dir: str) -> DataFrame:
    from shardscan.llm.common import documents

    found = near_duplicates(documents(spark, sf_dir))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, shingle: int = 3, radius: int = 2) -> DataFrame:
    """``docs`` with one row of each group of linked texts: that with the smallest id
    (null ids last; of rows that repeat the id and text, one), its columns as they are."""
    no_id, own_id, own_text, number = (fresh(docs, f"__keep_{x}") for x in ("null", "id", "text", "number"))
    comp = near_duplicates(docs, shingle=shingle, radius=radius)
    none, same = F.col("doc_id").isNull(), F.coalesce("doc_id", F.lit(0))
    stay = comp.groupBy("root").agg(F.min(F.struct(none.alias("none"), "doc_id", "text_hash")).alias("x")).select(
        "x.doc_id", "x.text_hash").select(none.alias(no_id), same.alias(own_id), F.col("text_hash").alias(own_text))
    tagged = docs.withColumns({no_id: none, own_id: same, own_text: F.xxhash64(F.col("text").cast("string"))})
    keys = [no_id, own_id, own_text]
    row = F.xxhash64(*[F.col(f"`{c}`").cast("string") for c in docs.columns])
    one = tagged.join(stay, keys).withColumn(number, F.row_number().over(Window.partitionBy(*keys).orderBy(row)))
    return one.where(f"{number} = 1").select(*[F.col(f"`{c}`") for c in docs.columns])
