"""Sharding by vector bin packing: bytes, tokens and rows balanced jointly.

Groups are equal texts.  Their sizes (bytes, tokens, rows) are vectors as a
share of the whole; shards have capacity 1/n in each of the three.  Groups are placed
largest first, each on the shard where the dot product of its vector with the
shard's residual capacity is highest.

At scale the placement list must stay small.  A group above ``1/(n_shards *
fine)`` of the corpus in some measure is placed by itself, and there are at
most ``3 * n_shards * fine`` of those; all other groups are hashed by text into
``n_shards * fine`` bundles.  A group stays whole if it fits a shard; a larger one (a group
that holds a third of all rows fits none) is cut by row hash into pieces of at most an eighth of a shard, a multiple of the shards in number.
Rows that repeat id and text have one hash; where they are many they are numbered (per salt, then
a prefix sum over the salts), and the number deals them to pieces and buckets.
The driver sees the totals of bundles and pieces only, a number that
depends on the parameters, not on the input.  The ``bytes`` law holds: the
bundles go last and even out what the groups left, and swaps between the fullest and
the emptiest shard take off most of the rest, such as do not widen rows or tokens as far as there are any.

Slots: rows of a shard are ordered by (hash bucket, id, checksum); a window
numbers each (shard, bucket) and the bucket's start is a prefix sum over at most
``n_shards * buckets`` counts, so no task sees a whole shard.

Defined results: null text has size 1 (and groups with the empty text); repeated rows
get slots of their own; null ids sort first; an empty table gives an empty
result; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shardscan.llm.common import documents, written

MEASURES = ("bytes", "tokens", "rows")


def pack(sizes: np.ndarray, n_shards: int) -> np.ndarray:
    """Shard of each item; ``sizes`` is (items, measures).  Largest items first; ties to the lower shard."""
    total = sizes.sum(axis=0)
    share = sizes / np.where(total > 0, total, 1)
    left = np.full((n_shards, sizes.shape[1]), 1.0 / n_shards)
    out = np.zeros(len(sizes), np.int32)
    for i in np.lexsort((np.arange(len(sizes)), -share.sum(axis=1))):
        s = int(np.argmax(left @ share[i]))
        out[i] = s
        left[s] -= share[i]
    return out


def even_out(sizes: np.ndarray, rows: np.ndarray, shard: np.ndarray, n_shards: int, rounds: int = 2000,
             loose: float = 0.002, tokens: np.ndarray | None = None, near: int = 16,
             even: float = 0.01) -> np.ndarray:
    """Swap items between the fullest and the emptiest shard (by ``sizes``) while that brings the two
    closer.  Items of equal row counts first, which changes the rows of no shard; then, if the two
    are still apart by more than ``loose`` of a shard, any items, or one item against none: of the ``near``
    best fits of each item those that take no two shards further apart than they are, or than ``even`` of a
    shard, in rows or tokens, and others only where there are none."""
    shard = shard.copy()
    fill = np.bincount(shard, sizes, n_shards)
    others = [rows] if tokens is None else [rows, tokens]

    def best_swap(a: np.ndarray, b: np.ndarray, gap: float, apart=None):
        """(what is left of the gap, item of a, item of b or -1) of the best swap."""
        have = np.where(b >= 0, sizes[b], 0.0)
        order = np.argsort(have, kind="stable")
        b, have = b[order], have[order]
        at = np.searchsorted(have, sizes[a] - gap / 2)
        found = (gap, -1, -1)
        for step in (0, -1) if apart is None else range(-near // 2, near // 2):
            k = np.clip(at + step, 0, len(b) - 1)
            left = np.abs(gap - 2 * (sizes[a] - have[k]))
            for m, d in zip(others, apart or ()):
                moved = m[a] - np.where(b[k] >= 0, m[b[k]], 0.0)
                left[np.abs(d - 2 * moved) > max(abs(d), even * m.sum() / n_shards)] = np.inf
            i = int(left.argmin())
            if left[i] < found[0]:
                found = (float(left[i]), int(a[i]), int(b[k[i]]))
        return found

    for equal_rows, guarded in ((True, False), (False, True), (False, False)):
        for _ in range(rounds):
            hi, lo = int(fill.argmax()), int(fill.argmin())
            gap = fill[hi] - fill[lo]
            if not equal_rows and gap <= loose * fill.mean():
                break
            a, b = np.flatnonzero(shard == hi), np.flatnonzero(shard == lo)
            if equal_rows:
                swaps = [best_swap(a[rows[a] == r], b[rows[b] == r], gap) for r in np.intersect1d(rows[a], rows[b])]
            else:
                apart = [float(m[a].sum() - m[b].sum()) for m in others] if guarded else None
                swaps = [best_swap(a, np.append(b, -1), gap, apart)] if len(a) else []
            _, i, j = min(swaps, default=(gap, -1, -1))
            if i < 0:
                break
            shard[i] = lo
            moved = sizes[i]
            if j >= 0:
                shard[j] = hi
                moved -= sizes[j]
            fill[hi] -= moved
            fill[lo] += moved
    return shard


def _row_hash(*cols: Column) -> Column:
    return F.xxhash64(*cols)


def _numbered(rows: DataFrame, repeated: DataFrame, salts: int = 256) -> DataFrame:
    """``rows`` with ``nth``: from 0 among the rows of a (digest, doc_id) of ``repeated``, 0 elsewhere.  Which of
    equal rows has which number does not matter, so the result does not depend on the partitions."""
    r, p = rows.alias("r"), F.broadcast(repeated).alias("p")
    same = (F.col("r.digest") == F.col("p.digest")) & F.col("r.doc_id").eqNullSafe(F.col("p.doc_id"))
    some = r.join(p, same).select("r.*", "p.twin").withColumn("salt", F.pmod(F.xxhash64("row"), F.lit(salts)))
    start = some.groupBy("twin", "salt").agg(F.count(F.lit(1)).alias("n")).select("twin", "salt", F.coalesce(
        F.sum("n").over(Window.partitionBy("twin").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)),
        F.lit(0)).alias("start"))
    at = F.row_number().over(Window.partitionBy("twin", "salt").orderBy("row"))
    numbered = some.withColumn("at", at).join(start, ["twin", "salt"])
    return numbered.select(*rows.columns, (F.col("start") + F.col("at") - 1).cast("long").alias("nth")).unionByName(
        r.join(p, same, "left_anti").select(*rows.columns, F.lit(0).cast("long").alias("nth")))


def shard(docs: DataFrame, n_shards: int = 16, fine: int = 256, buckets: int = 1024,
          id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: ``doc_id, size, text_crc32, tokens, law, shard, slot, grown_shard``."""
    spark = docs.sparkSession
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(
        F.col(id_col).alias("doc_id"),
        (F.octet_length(text) + F.lit(1)).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.size(F.split(F.trim(text), r"\s+")).cast("long").alias("tokens"),
        F.md5(text.cast("binary")).alias("digest"),
        F.monotonically_increasing_id().alias("row"))
    rows = written(rows, "shard-rows")  # sizes only: the texts are read once
    groups = rows.groupBy("digest").agg(F.sum("size").alias("bytes"), F.sum("tokens").alias("tokens"),
                                        F.count(F.lit(1)).alias("rows"))
    total = groups.agg(*[F.sum(m).alias(m) for m in MEASURES]).first()
    if not total["rows"]:
        return rows.select("doc_id", "size", "text_crc32", "tokens", F.lit("bytes").alias("law"),
                           F.lit(0).alias("shard"), F.lit(0).cast("long").alias("slot"),
                           F.lit(None).cast("int").alias("grown_shard"))
    bundles = n_shards * fine
    of = F.greatest(*[F.col(m) / F.lit(float(max(1, total[m]))) for m in MEASURES])
    large = groups.withColumn("part", of).where(F.col("part") > 1.0 / bundles)
    # at most len(MEASURES) * bundles rows, whatever the input
    cut, many, at = [], [], bundles
    for r in large.select("digest", "part", "rows").orderBy("digest").collect():
        # whole if it fits a shard, else in pieces of at most an eighth of one, as many for each shard
        n = 1 if r["part"] <= 1.0 / n_shards else n_shards * int(np.ceil(8 * r["part"]))
        cut.append((r["digest"], at, n))
        many += [(r["digest"],)] * (r["rows"] > 1)
        at += n
    own = spark.createDataFrame(cut, "digest string, unit int, n int")
    # rows that repeat id and text and are a large part by themselves: as few as the large groups
    pairs = rows.join(F.broadcast(spark.createDataFrame(many, "digest string")), "digest").groupBy("digest", "doc_id").agg(
        F.sum("size").alias("bytes"), F.sum("tokens").alias("tokens"), F.count(F.lit(1)).alias("rows"))
    repeated = pairs.where((F.col("rows") > 1) & (of > 1.0 / bundles)).select("digest", "doc_id")
    twins = [(*r, i) for i, r in enumerate(repeated.collect() if many else [])]
    schema = f"digest string, doc_id {rows.schema['doc_id'].dataType.simpleString()}, twin int"
    rows = _numbered(rows, spark.createDataFrame(twins, schema)) if twins else rows.withColumn("nth", F.lit(0).cast("long"))
    n = F.coalesce("n", F.lit(1))
    piece = F.pmod(F.pmod(_row_hash("doc_id", "size", "text_crc32"), n) + F.col("nth"), n)
    units = (rows.join(F.broadcast(own), "digest", "left").withColumn("unit", F.when(
        F.col("unit").isNotNull(), F.col("unit") + piece.cast("int")).otherwise(
        F.pmod(F.xxhash64("digest"), F.lit(bundles)).cast("int"))))
    sums = units.groupBy("unit").agg(F.sum("size").alias("bytes"), F.sum("tokens").alias("tokens"),
                                     F.count(F.lit(1)).alias("rows")).orderBy("unit").collect()
    sizes = np.array([[float(r[m]) for m in MEASURES] for r in sums])
    to = even_out(sizes[:, 0], sizes[:, 2], pack(sizes, n_shards), n_shards, tokens=sizes[:, 1])
    place = spark.createDataFrame([(r["unit"], int(s)) for r, s in zip(sums, to)], "unit int, shard int")
    hashed = F.when(F.col("nth") > 0, _row_hash("doc_id", "text_crc32", "nth")).otherwise(_row_hash("doc_id", "text_crc32"))
    placed = units.join(F.broadcast(place), "unit").withColumn("bucket", F.pmod(hashed, F.lit(buckets)).cast("int"))
    counts = placed.groupBy("shard", "bucket").agg(F.count(F.lit(1)).alias("n"))
    start = counts.withColumn("start", F.sum("n").over(
        Window.partitionBy("shard").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)))
    order = Window.partitionBy("shard", "bucket").orderBy(
        F.col("doc_id").asc_nulls_first(), "text_crc32", "size", "digest")
    slots = placed.withColumn("at", F.row_number().over(order)).join(
        F.broadcast(start.select("shard", "bucket", "start")), ["shard", "bucket"])
    return slots.select("doc_id", "size", "text_crc32", "tokens", F.lit("bytes").alias("law"), "shard",
                        (F.coalesce("start", F.lit(0)) + F.col("at") - 1).cast("long").alias("slot"),
                        F.lit(None).cast("int").alias("grown_shard"))


def op4_vector_bin_packing(spark, sf_dir: str) -> DataFrame:
    return shard(documents(spark, sf_dir))
