"""The stages of the pipeline against plain versions, on given, awkward and empty tables."""

from collections import Counter, defaultdict

import pytest

import brute
import corpus_pipeline as P
from llm_tables import SF, edge_dir, empty_dir  # noqa: F401
from pyspark.sql import functions as F

STAGE = dict(P.STAGES)


def key(r):
    return tuple(r)


@pytest.mark.parametrize("where", ["given", "edge", "empty"])
def test_stages(spark, where, edge_dir, empty_dir):
    sf = {"given": SF, "edge": edge_dir, "empty": empty_dir}[where]
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    before = docs.collect()

    langs = STAGE["language ID"](spark, docs, sf)
    assert langs.columns == docs.columns
    kept = langs.collect()
    gone = Counter(map(key, before)) - Counter(map(key, kept))
    assert not Counter(map(key, kept)) - Counter(map(key, before))
    no_letter = Counter(key(r) for r in before if not r.text or not any(c.isalpha() for c in r.text))
    assert not no_letter - gone and (where != "given" or sum((gone - no_letter).values()) <= 2)

    one = STAGE["SimHash near-dedup"](spark, docs, sf)
    assert one.columns == docs.columns
    out = one.collect()
    comp = brute.components([(r.doc_id, r.text) for r in before])
    by_text = {r.text: c for r, c in zip(before, comp)}
    # one of each group: with ids, that with the smallest
    fps = {r.text: int(c[1], 16) for r, c in zip(before, comp)}
    nodes = sorted(set(fps.values()))
    parent = {x: x for x in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, x in enumerate(nodes):
        for y in nodes[i + 1:]:
            if (x ^ y).bit_count() <= 2:
                parent[find(y)] = find(x)
    groups = defaultdict(list)
    for r in before:
        groups[find(fps[r.text])].append(r)
    assert Counter(find(fps[r.text]) for r in out) == Counter(dict.fromkeys(groups, 1))
    for r in out:
        assert r.doc_id == by_text[r.text][2] and key(r) in map(key, before)

    clean = STAGE["benchmark decontamination"](spark, docs, sf)
    assert clean.columns == docs.columns
    bench = [tuple(r) for r in spark.read.parquet(f"{sf}/benchmark.parquet").select("item_id", "text").collect()]
    flags = brute.overlap([(r.doc_id, r.text) for r in before], bench)
    assert Counter(map(key, clean.collect())) == Counter(key(r) for r, f in zip(before, flags) if not f[5])

    mixed = STAGE["mixing sources to target weights"](spark, docs, sf)
    assert mixed.columns == docs.columns
    assert set(map(key, mixed.collect())) <= set(map(key, before))

    shards = STAGE["sharding"](spark, docs, sf)
    assert {"doc_id", "shard", "slot"} <= set(shards.columns) and shards.count() == len(before)


def test_run_is_the_stages_in_order(spark):
    out = P.run(spark, SF)
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for _, stage in P.STAGES:
        docs = stage(spark, docs, SF)
    cols = ["doc_id", "size", "text_crc32", "shard", "slot"]
    assert Counter(map(tuple, out.select(*cols).collect())) == Counter(map(tuple, docs.select(*cols).collect()))
    assert out.agg(F.count(F.lit(1))).first()[0] > 100


def test_stages_pass_columns_of_their_own_names(spark):
    names = ["__lid", "__overlap", "__mix_rate", "__mix_key", "__MIX_ROW", "__keep_id", "__keep_number", "__match", "__row", "__source", "__n"]
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(60)
    docs = docs.select("*", *[F.concat(F.lit(n), F.col("doc_id").cast("string")).alias(n) for n in names]).cache()
    for name, stage in P.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns, name
        assert all(r[n] == f"{n}{r.doc_id}" for r in out.collect() for n in names), name


def test_a_corpus_without_languages_keeps_its_documents(spark):
    docs = spark.createDataFrame([(1, "words here", None), (2, "12 34", None), (3, None, None), (4, "\u4e2d", None), (5, "", None)],
                                 "doc_id long, text string, lang string")
    assert {r.doc_id for r in P.language_id(spark, docs, SF).collect()} == {1, 4}


@pytest.mark.parametrize("where", ["given", "edge"])
def test_mixing_stage_against_a_plain_version(spark, where, edge_dir):
    """Counts by the Poisson distribution function at the md5 number of id and text."""
    import hashlib
    import math

    docs = spark.read.parquet(f"{SF if where == 'given' else edge_dir}/documents.parquet").select("doc_id", "text", "source")
    rows = docs.collect()
    size = Counter()
    for r in rows:
        size[r.source] += len((r.text or "").encode()) + 1
    total, weight = sum(size.values()), sum(math.sqrt(n) for n in size.values())
    want = Counter()
    for r in rows:
        rate = math.sqrt(size[r.source]) / weight * total / size[r.source]
        text = hashlib.md5((r.text or "").encode()).hexdigest()
        parts = max(1, math.ceil(rate / 128))  # a large rate is a sum of draws
        for i in range(1, parts + 1):
            own = f"mix-1|{'' if r.doc_id is None else r.doc_id}|{text}" + (f"|part {i}" if i > 1 else "")
            u = int(hashlib.md5(own.encode()).hexdigest()[:13], 16) / 2 ** 52
            k, p = 0, math.exp(-rate / parts)
            below = p
            while below <= u and k < 1000:
                k += 1
                p *= rate / parts / k
                below += p
            want[tuple(r)] += k
    got = Counter(map(tuple, P.mixture(spark, docs, SF).collect()))
    assert got == +want


def test_sharding_stage_against_the_packed_units(spark):
    """Every row once; slots gapless; sizes and counts even; equal texts in one shard where they fit."""
    import zlib

    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = Counter((r.doc_id, len((r.text or "").encode()) + 1, zlib.crc32((r.text or "").encode())) for r in docs.collect())
    out = P.shards(spark, docs, SF).collect()
    assert Counter((r.doc_id, r["size"], r.text_crc32) for r in out) == rows
    slots, sizes, of = defaultdict(list), Counter(), defaultdict(set)
    for r in out:
        slots[r.shard].append(r.slot)
        sizes[r.shard] += r["size"]
        of[r.text_crc32, r["size"]].add(r.shard)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values()) and set(slots) == set(range(16))
    assert max(sizes.values()) - min(sizes.values()) < 0.02 * sum(sizes.values()) / 16 and max(map(len, of.values())) <= 2
