"""Hard-negative mining with Four-Russians scoring.

Vectors become integers, floor(256 x), and a score is an integer inner product, computed without a
multiplication: dimensions are taken in groups of eight, and for every anchor and group a table holds the sums
of all 256 subsets of the anchor's eight integers.  A candidate is kept as bit planes: per group and
bit of its two's complement integers one byte, whose eight bits are that bit of the eight
dimensions.  A plane's byte is an index into the anchor's table, and the score is the shift-add over the planes, the highest (the
sign) subtracted:

    score = -T[sign byte]; then for each lower plane: score = 2 * score + T[its byte]

summed over the groups.  Every score is full and exact.

Anchors (a stated query set) meet all rows in tiles: blocks of ``block_rows`` candidates by chunks of ``chunk_rows``
anchors, one cogrouped pair of groups each, so a task holds one tile and nothing else; there are as many partitions as
tiles, whatever the bytes.  The first pass finds the positives, among rows of the anchor's label bucket (a hot label is only
more blocks); the second pass looks for the negatives of all positives of an anchor at once.  A tile returns its best
``k`` of each question, which a grouped top-k in Spark merges.  Positives are written as a table between the passes.

Defined results: rows without a label, id or vector, or with a null or non-finite component, take no part; of rows that
repeat an id the smallest (label, vector) takes part; a vector shorter than the longest has zeros at its end, also an empty
one; an entry so large that a score could leave 64 bits counts as the largest that cannot (2^28 at 64 dimensions); ties
go to the smaller id; anchors without a positive, or whose positives have no negative in the band, have no rows; an
empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from math import isqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shardscan.llm.common import python_tasks, table, written

SCALE = 256
BLOCK_ROWS = 4096
CHUNK_ROWS = 4096
LABEL_BUCKETS = 256
#: Anchors whose tables are held at once.
TABLES = 128


# ----------------------------------------------------------------- scoring
def width(low: int, high: int) -> int:
    """Bits of a two's complement integer that holds ``low`` and ``high``."""
    return max(int(high).bit_length(), int(-low - 1).bit_length() if low < 0 else 0) + 1


def bit_planes(q: np.ndarray, bits: int) -> np.ndarray:
    """(rows, groups, bits) bytes of integers (rows, dims): bit k of a byte belongs to dimension 8 * group + k."""
    n, dim = q.shape
    groups = -(-dim // 8)
    full = np.zeros((n, groups * 8), np.int64)
    full[:, :dim] = q
    out = np.empty((n, groups, bits), np.uint8)
    for b in range(bits):
        plane = ((full >> b) & 1).astype(np.uint8)
        out[:, :, b] = np.packbits(plane.reshape(n, groups, 8), axis=2, bitorder="little")[:, :, 0]
    return out


def subset_sums(anchors: np.ndarray, kind) -> np.ndarray:
    """(groups, 256, anchors): entry [g, m, a] is the sum of anchor a's integers of group g in the subset m."""
    n, dim = anchors.shape
    groups = -(-dim // 8)
    full = np.zeros((groups * 8, n), kind)
    full[:dim] = anchors.T
    sums = np.zeros((groups, 256, n), kind)
    for k in range(8):
        sums[:, 1 << k:2 << k] = sums[:, :1 << k] + full[k::8][:, None, :]
    return sums


def four_russians(planes: np.ndarray, anchors: np.ndarray, kind=np.int64) -> np.ndarray:
    """(candidates, anchors) exact inner products."""
    n, groups, bits = planes.shape
    sums = subset_sums(anchors, kind)
    score = np.zeros((n, len(anchors)), kind)
    part = np.empty_like(score)
    for b in range(bits - 1, -1, -1):
        np.add(score, score, out=score)
        for g in range(groups):
            np.take(sums[g], planes[:, g, b], axis=0, out=part, mode="clip")  # a byte is always in range
            (np.subtract if b == bits - 1 else np.add)(score, part, out=score)
    return score


def best(scores: np.ndarray, k: int) -> np.ndarray:
    """Places of the ``k`` largest, largest first, ties to the earlier place."""
    if len(scores) > k:
        edge = -np.partition(-scores, k - 1)[k - 1]
        at = np.flatnonzero(scores >= edge)
    else:
        at = np.arange(len(scores))
    return at[np.argsort(-scores[at], kind="stable")[:k]]


def least_negative(positive: int) -> int:
    """The smallest n with 80 * positive <= 100 * n."""
    return positive - positive // 5


# ------------------------------------------------------------------- Spark
def quantised(vec: Column, limit: int) -> Column:
    top = F.lit(float(limit))

    def one(c: Column) -> Column:
        return F.floor(F.greatest(F.least(c * F.lit(float(SCALE)), top), -top)).cast("bigint")

    return F.transform(vec, one)


def usable(vectors: DataFrame, id_col: str, vec_col: str, label_col: str) -> DataFrame:
    """``vec_id, label, vec``: one row for each id that takes part."""
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(label_col).cast("long").alias("label"),
                          F.col(vec_col).cast("array<double>").alias("vec"))
    good = F.forall("vec", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != F.lit(float("inf"))))
    rows = rows.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("vec").isNotNull() & good)
    one = rows.groupBy("vec_id").agg(F.min(F.struct("label", "vec")).alias("r"))
    return one.select("vec_id", "r.label", "r.vec")


def _integers(column: pa.ChunkedArray, dim: int) -> np.ndarray:
    arr = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    if isinstance(arr, pa.ChunkedArray):  # no chunks at all
        return np.zeros((0, dim), np.int64)
    size = np.diff(arr.offsets.to_numpy())
    out = np.zeros((len(arr), dim), np.int64)
    out[np.arange(dim) < size[:, None]] = arr.flatten().to_numpy(zero_copy_only=False)
    return out


def _numbers(column) -> np.ndarray:
    return column.to_numpy().astype(np.int64)


class Miner:
    """What every tile needs to know: dimensions, bits of an entry, and the integer type that holds all scores."""

    def __init__(self, dim: int, low: int, high: int):
        self.dim, self.groups, self.bits = dim, -(-dim // 8), width(low, high)
        self.kind = np.int32 if dim * max(abs(low), abs(high)) ** 2 < 2 ** 31 else np.int64

    def packed(self, rows: DataFrame) -> DataFrame:
        """``rows`` with the integers ``q`` as bit planes (``planes``, binary)."""
        dim, bits = self.dim, self.bits

        def pack(batches):
            for b in batches:
                planes = bit_planes(_integers(b.column("q"), dim), bits).reshape(b.num_rows, -1)
                rows_of = pa.array([p.tobytes() for p in planes], pa.binary())
                yield pa.RecordBatch.from_arrays([b.column("vec_id"), b.column("label"), rows_of],
                                                 names=["vec_id", "label", "planes"])

        return rows.mapInArrow(pack, "vec_id long, label long, planes binary")

    def tile(self, candidates: pa.Table, anchors: pa.Table):
        """Candidates in order of id, and for each anchor its number and the scores of all of them."""
        ids, labels = _numbers(candidates["vec_id"]), _numbers(candidates["label"])
        order = np.argsort(ids, kind="stable")
        raw = np.frombuffer(b"".join(candidates["planes"].to_pylist()), np.uint8)
        planes = raw.reshape(len(ids), self.groups, self.bits)[order]
        q = _integers(anchors["q"], self.dim)

        def scores():
            for a in range(0, len(q), TABLES):
                got = np.ascontiguousarray(four_russians(planes, q[a:a + TABLES], self.kind).T)
                yield from enumerate(got, a)

        return ids[order], labels[order], scores()


def _tiles(candidates: DataFrame, anchors: DataFrame, bucket: Column, block_rows: int, chunk_rows: int, fn, schema: str):
    """``fn(candidates, anchors)`` for every tile of every bucket of rows; a bucket's tiles are blocks by chunks."""
    def counts(rows: DataFrame, size: int) -> dict[int, int]:  # at most LABEL_BUCKETS rows
        got = rows.groupBy(bucket.alias("b")).count().collect()
        return {r["b"]: -(-r["count"] // size) for r in got}

    blocks, chunks = counts(candidates, block_rows), counts(anchors, chunk_rows)
    both = sorted(set(blocks) & set(chunks))
    if not both:
        return candidates.sparkSession.createDataFrame([], schema)
    n_tiles = sum(blocks[b] * chunks[b] for b in both)

    def of(mine: dict[int, int]) -> Column:
        return F.try_element_at(F.create_map(*[F.lit(x) for b in both for x in (b, mine[b])]), F.col("bucket"))

    def dealt(rows: DataFrame, mine: dict[int, int], own: str, other_of: dict[int, int], other: str) -> DataFrame:
        rows = rows.withColumn("bucket", bucket).where(F.col("bucket").isin(both))
        rows = rows.withColumn(own, F.pmod(F.xxhash64("vec_id"), of(mine)))
        rows = rows.withColumn(other, F.explode(F.sequence(F.lit(0).cast("long"), of(other_of).cast("long") - 1)))
        return rows.repartition(min(10_000, 2 * n_tiles), "bucket", "block", "chunk")

    left = dealt(candidates, blocks, "block", chunks, "chunk").groupBy("bucket", "block", "chunk")
    right = dealt(anchors, chunks, "chunk", blocks, "block").groupBy("bucket", "block", "chunk")

    def run(a: pa.Table, b: pa.Table) -> pa.Table:
        if not a.num_rows or not b.num_rows:
            return empty
        return pa.Table.from_arrays([pa.array(c, pa.int64()) for c in fn(a, b)], names=names)

    names = [c.split()[0] for c in schema.split(", ")]
    empty = pa.Table.from_arrays([pa.array([], pa.int64()) for _ in names], names=names)
    return left.cogroup(right).applyInArrow(run, schema)


def _columns(parts: list[tuple], n: int) -> list[np.ndarray]:
    return [np.concatenate([np.asarray(p[i]) for p in parts]) if parts else np.zeros(0, np.int64) for i in range(n)]


def find_positives(miner: Miner, candidates: DataFrame, anchors: DataFrame, k: int, block_rows: int, chunk_rows: int) -> DataFrame:
    """``anchor_id, positive_id, positive_score``: each anchor's ``k`` best other rows of its label."""
    def tile(a: pa.Table, b: pa.Table):
        ids, labels, scores = miner.tile(a, b)
        own, own_label = _numbers(b["vec_id"]), _numbers(b["label"])
        out = []
        for j, s in scores:
            same = np.flatnonzero((labels == own_label[j]) & (ids != own[j]))
            at = same[best(s[same], k)]
            out.append((np.full(len(at), own[j]), ids[at], s[at]))
        return _columns(out, 3)

    bucket = F.pmod(F.xxhash64("label"), F.lit(LABEL_BUCKETS)).cast("int")
    found = _tiles(candidates, anchors, bucket, block_rows, chunk_rows, tile,
                   "anchor_id long, positive_id long, positive_score long")
    order = Window.partitionBy("anchor_id").orderBy(F.desc("positive_score"), "positive_id")
    return found.withColumn("place", F.row_number().over(order)).where(F.col("place") <= k).drop("place")


def find_negatives(miner: Miner, candidates: DataFrame, anchors: DataFrame, positives: DataFrame, k: int, block_rows: int,
                   chunk_rows: int) -> DataFrame:
    """``anchor_id, positive_id, negative_id, positive_score, negative_score, rank`` within every positive's band."""
    def tile(a: pa.Table, b: pa.Table):
        ids, labels, scores = miner.tile(a, b)
        own, own_label = _numbers(b["vec_id"]), _numbers(b["label"])
        asked = b["asked"].to_pylist()
        out = []
        for j, s in scores:
            band = [(p["positive_id"], p["positive_score"]) for p in asked[j]]
            low, high = min(least_negative(p) for _, p in band), max(p for _, p in band)
            other = np.flatnonzero((s >= low) & (s <= high) & (labels != own_label[j]))
            s = s[other]
            for positive_id, p in band:
                at = np.flatnonzero((s >= least_negative(p)) & (s <= p))
                at = at[best(s[at], k)]
                n = len(at)
                out.append((np.full(n, own[j]), np.full(n, positive_id), ids[other[at]], np.full(n, p), s[at]))
        return _columns(out, 5)

    # no score lies between 80 and 100 hundredths of a negative one
    asked = positives.where(F.col("positive_score") >= 0).groupBy(F.col("anchor_id").alias("vec_id")).agg(
        F.collect_list(F.struct("positive_id", "positive_score")).alias("asked"))  # at most k
    found = _tiles(candidates, anchors.join(asked, "vec_id"), F.lit(0), block_rows, chunk_rows, tile,
                   "anchor_id long, positive_id long, negative_id long, positive_score long, negative_score long")
    order = Window.partitionBy("anchor_id", "positive_id").orderBy(F.desc("negative_score"), "negative_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def mine(vectors: DataFrame, is_anchor: Column, k_positives: int = 5, k_negatives: int = 5, id_col: str = "vec_id",
         vec_col: str = "embedding", label_col: str = "label", block_rows: int = BLOCK_ROWS,
         chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``; ``is_anchor`` is a condition on ``vec_id``."""
    spark = vectors.sparkSession
    python_tasks(spark)
    rows = written(usable(vectors, id_col, vec_col, label_col), "vectors")
    dim = rows.agg(F.max(F.size("vec"))).first()[0] or 0
    out = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    if not dim:  # no vector, or only empty ones: nothing to pack, all scores are zero
        dim = 1
    rows = rows.select("vec_id", "label", quantised(F.col("vec"), isqrt(2 ** 62 // dim)).alias("q"))
    # entries that are not there are zero
    ends = rows.agg(F.min(F.array_min("q")).alias("low"), F.max(F.array_max("q")).alias("high")).first()
    miner = Miner(dim, min(0, ends["low"] or 0), max(0, ends["high"] or 0))
    candidates = written(miner.packed(rows), "candidates")
    anchors = written(rows.where(is_anchor), "anchors")
    positives = written(find_positives(miner, candidates, anchors, k_positives, block_rows, chunk_rows), "positives")
    found = find_negatives(miner, candidates, anchors, positives, k_negatives, block_rows, chunk_rows)
    return found.select(*[F.col(c.split()[0]).cast(c.split()[1]) for c in out.split(", ")])


def relabelled(vectors: DataFrame) -> DataFrame:
    """The table of the registered query: where vec_id is divisible by 7 the label moves on by one of ten."""
    label = F.col("label").cast("long")
    return vectors.select("vec_id", "embedding", F.when(F.col("vec_id") % 7 == 0, (label + 1) % 10).otherwise(label).alias("label"))


def op13_four_russians_hard_negatives(spark, sf_dir: str) -> DataFrame:
    return mine(relabelled(table(spark, sf_dir, "embeddings")), F.col("vec_id") % 100 == 0)


NEGATIVES_SQL = """
WITH r AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (CAST(label AS BIGINT) + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS q FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS same, CAST(list_inner_product(a.q, c.q) AS BIGINT) AS score
      FROM r a JOIN r c ON a.vec_id <> c.vec_id WHERE a.vec_id % 100 = 0),
p AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
      QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT anchor_id, positive_id, CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
  vec_id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s USING (anchor_id) WHERE NOT same AND 80 * positive_score <= 100 * score AND score <= positive_score
QUALIFY rank <= 5"""
