"""The packing query against a plain version: units, placement, shards and slots worked out in Python.

Which swaps even out the bytes is taken from ``even_out`` (its own tests hold its laws); all else is
worked out again here, and the greedy placement is replayed step by step.
"""

import hashlib
import math
import re
from collections import Counter, defaultdict

import brute
import corpus_pipeline as P
import numpy as np
import pytest
import xxhash
from llm_tables import SF, edge_dir  # noqa: F401
from pyspark.sql import functions as F

from shardscan.llm import sharding

SHARDS, BUNDLES, BUCKETS = 16, 16 * 256, 1024


def spark_hash(*values) -> int:
    """Spark's ``xxhash64``: each value's XXH64, seeded by the hash so far; nulls are passed over."""
    h = 42
    for v in values:
        if v is not None:
            raw = v.encode() if isinstance(v, str) else v.to_bytes(8, "little", signed=True)
            h = xxhash.xxh64(raw, seed=h).intdigest()
    return h - (1 << 64) if h >> 63 else h


def packed(docs):
    """(doc_id, text) rows -> Counter of (doc_id, size, crc32, shard, slot), and the units' sizes and first shards."""
    rows = []
    for d, t in docs:
        raw = (t or "").encode()
        tokens = len(re.split(r"[ \t\n\x0b\f\r]+", (t or "").strip(" ")))
        rows.append((d, len(raw) + 1, tokens, brute.crc(t), hashlib.md5(raw).hexdigest()))

    def summed(keys):
        out = defaultdict(lambda: [0, 0, 0])
        for key, (_, size, tokens, _, _) in zip(keys, rows):
            for i, v in enumerate((size, tokens, 1)):
                out[key][i] += v
        return out

    total = [sum(r[1] for r in rows), sum(r[2] for r in rows), len(rows)]

    def share(sizes):
        return max(v / max(1, t) for v, t in zip(sizes, total))

    groups, pairs = summed([r[4] for r in rows]), summed([(r[4], r[0]) for r in rows])
    own, at = {}, BUNDLES
    for digest in sorted(g for g in groups if share(groups[g]) > 1 / BUNDLES):
        part = share(groups[digest])
        own[digest] = at, 1 if part <= 1 / SHARDS else SHARDS * math.ceil(8 * part)
        at += own[digest][1]
    seen, units, nths = Counter(), [], []
    for d, size, _, crc, digest in rows:
        pair, nth = pairs[digest, d], 0
        if digest in own and pair[2] > 1 and share(pair) > 1 / BUNDLES:
            nth, seen[digest, d] = seen[digest, d], seen[digest, d] + 1
        nths.append(nth)
        if digest in own:
            first, n = own[digest]
            units.append(first + (spark_hash(d, size, crc) % n + nth) % n)
        else:
            units.append(spark_hash(digest) % BUNDLES)
    sums = sorted(summed(units).items())
    sizes = np.array([v for _, v in sums], float)
    first = sharding.pack(sizes, SHARDS)
    last = sharding.even_out(sizes[:, 0], sizes[:, 2], first, SHARDS, tokens=sizes[:, 1])
    place = {u: int(s) for (u, _), s in zip(sums, last)}
    line = defaultdict(list)
    for (d, size, _, crc, digest), unit, nth in zip(rows, units, nths):
        bucket = spark_hash(d, crc, *[nth] * (nth > 0)) % BUCKETS
        line[place[unit]].append((bucket, d is not None, d or 0, crc, size, digest, d))
    out = Counter((r[6], r[4], r[3], s, i) for s, mine in line.items() for i, r in enumerate(sorted(mine, key=lambda r: r[:6])))
    return out, sizes, first


def replay(sizes, shard):
    """Every item, largest first, went where its vector's dot product with what was left is highest."""
    total = [sum(c) for c in zip(*sizes.tolist())]
    items = [[v / t for v, t in zip(row, total)] for row in sizes.tolist()]
    left = [[1 / SHARDS] * 3 for _ in range(SHARDS)]
    todo = sorted(range(len(items)), key=lambda i: -float(np.sum(sizes[i] / np.array(total))))
    for i in todo:
        fit = [sum(a * b for a, b in zip(room, items[i])) for room in left]
        assert fit[shard[i]] >= max(fit) - 1e-12, i
        left[shard[i]] = [a - b for a, b in zip(left[shard[i]], items[i])]


def hot(spark):
    """A third of all rows is one row; a sixth shares a text under ids of their own; the rest differ in length."""
    i = F.col("id")
    own = F.concat(F.lit("\n text "), F.sha2(i.cast("string"), 256), F.repeat(F.lit(" w"), (i % 40).cast("int")))
    return spark.range(3000).select(
        F.when(i % 3 == 0, F.lit(None)).when(i % 7 == 0, -i).otherwise(i).cast("long").alias("doc_id"),
        F.when(i % 3 == 0, F.lit("the row of a third")).when(i % 6 == 1, F.lit("shared text")).otherwise(own).alias("text"))


@pytest.mark.parametrize("where", ["sf0.001", "sf0.01", "edge", "hot"])
def test_packing_equals_the_plain_version(spark, where, edge_dir):  # noqa: F811
    path = edge_dir if where == "edge" else SF.replace("sf0.001", where)
    docs = hot(spark) if where == "hot" else spark.read.parquet(f"{path}/documents.parquet").select("doc_id", "text")
    want, sizes, first = packed([tuple(r) for r in docs.collect()])
    replay(sizes, first)
    result = sharding.shard(docs) if where == "hot" else sharding.op4_vector_bin_packing(spark, path)
    assert Counter(map(tuple, result.select("doc_id", "size", "text_crc32", "shard", "slot").collect())) == want


def test_sharding_stage_equals_the_plain_version(spark):
    """On what the stage before it hands over: documents that mixing repeated."""
    docs = P.mixture(spark, spark.read.parquet(f"{SF}/documents.parquet"), SF)
    want = packed([(r.doc_id, r.text) for r in docs.collect()])[0]
    out = P.shards(spark, docs, SF).select("doc_id", "size", "text_crc32", "shard", "slot")
    assert Counter(map(tuple, out.collect())) == want
