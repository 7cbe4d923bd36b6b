"""Maximal repeats with all their places against a plain version that grows every repeat."""

import random
from collections import defaultdict

import brute
import pytest
from llm_tables import edge_texts

from pyspark.sql import functions as F

from shardscan.llm import repeat_groups as G
from shardscan.llm import repeats

SF = "/root/testdata/sf0.001"


def found(spark, docs, length=100):
    """The groups as (bytes, places), read from the places themselves."""
    text = {d: (t or "").encode() for d, t in docs}
    assert len(text) == len(set(docs))
    groups = defaultdict(list)
    for r in G.repeat_groups(spark.createDataFrame(docs, "doc_id long, text string"), length).collect():
        groups[r.group_id, r.n_bytes].append((r.doc_id, r.start))
    out = set()
    for (_, size), occ in groups.items():
        d, s = occ[0]
        assert len(occ) == len(set(occ)) > 1 and len({text[d][s:s + size] for d, s in occ}) == 1
        out.add((text[d][s:s + size], frozenset(occ)))
    assert len(out) == len(groups)
    return out


def words(rnd, n):
    return " ".join(f"w{rnd.randrange(10 ** 6)}" for _ in range(n))


def test_awkward_texts(spark):
    docs = {}
    for d, t, _, _ in edge_texts():
        if d is not None and len(t or "") < 20_000:
            docs.setdefault(d, t)
    assert found(spark, list(docs.items())) == brute.repeat_groups(docs.items())


def test_given_documents(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    assert found(spark, docs) == brute.repeat_groups(docs)


@pytest.mark.parametrize("piece", [1, 7, 64])
def test_nested_random_texts(spark, monkeypatch, piece):
    """Many rounds of small pieces: passages that hold, overlap and begin each other, few letters, copies."""
    monkeypatch.setattr(G, "PIECE", piece)
    rnd = random.Random(piece)
    docs, pool = [], []
    for d in range(120):
        if pool and rnd.random() < 0.6:
            p = rnd.choice(pool)
            i = rnd.randrange(len(p))
            pool.append((p[i:] + p[:rnd.randrange(len(p))])[:200])
        else:
            pool.append("".join(rnd.choice("ab ") for _ in range(rnd.randint(20, 120))))
        docs.append((d, rnd.choice(docs)[1] if docs and rnd.random() < 0.15 else "".join(rnd.choice(pool) for _ in range(rnd.randint(0, 4)))))
    assert found(spark, docs, 40) == brute.repeat_groups(docs, 40)


def test_passage_of_5000_documents_is_one_group(spark):
    rnd = random.Random(4)
    passage = "P" + words(rnd, 115)[:798] + "Q"
    docs = [(d, f"{words(rnd, 3)}{chr(97 + d % 20)}{passage}{chr(97 + d % 17)}{words(rnd, 3)}") for d in range(5000)]
    got = found(spark, docs)
    assert (passage.encode(), frozenset((d, t.index(passage)) for d, t in docs)) in got
    # besides it the passage with what happens to stand around it in several documents
    assert all(passage.encode() in b for b, _ in got) and sum(len(occ) == 5000 for _, occ in got) == 1
    assert got == brute.repeat_groups(docs)


def test_long_texts_copies_nulls_and_repeated_rows(spark):
    rnd = random.Random(9)
    long = words(rnd, 60_000)
    rows = [(1, long), (2, long[:-5]), (3, long), (3, long), (None, long), (None, None), (None, ""), (4, None), (5, "x" * 99)]
    got = defaultdict(set)
    out = G.repeat_groups(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    for r in out:
        got[r.n_bytes].add((r.doc_id, r.start))
    assert len(out) == 7 and got == {len(long): {(1, 0), (3, 0), (None, 0)}, len(long) - 5: {(1, 0), (2, 0), (3, 0), (None, 0)}}


def test_empty(spark):
    assert G.repeat_groups(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_numbers_of_documents_without_own_ids(spark):
    """Gapless over many parts: by id, null ids last, then by md5."""
    was = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        docs = spark.range(9000).select(F.when(F.col("id") % 3 > 0, F.col("id") % 50).alias("doc_id"),
                                        F.concat(F.lit("t"), (F.col("id") % 2000).cast("string")).alias("text"))
        rows = repeats._numbered(docs, "doc_id", "text").select("doc_id", "doc", F.md5("text").alias("m")).distinct().collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", was)
    rows.sort(key=lambda r: (r.doc_id is None, r.doc_id or 0, r.m))
    assert [r.doc for r in rows] == list(range(len(rows))) and len(rows) > 2000
