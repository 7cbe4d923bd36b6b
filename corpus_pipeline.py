"""Corpus preparation: five stages that turn ``documents`` into sharded training text.

Each stage is ``(spark, docs, sf_dir) -> DataFrame``; it reads the whole table that
the stage before it wrote.  All but the last return the columns of ``documents``.
Documents that carry no language go, one document of each near-duplicate
group stays, documents contaminated by the benchmark go, sources are mixed
to target weights by repeating documents, and the last stage puts every copy
into a shard.  Tests hold each stage against a plain version of itself.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shardscan.llm import decontaminate, langid, mixing, sharding, simhash
from shardscan.llm.common import fresh, table, work_path

#: A document's language is rejected below this mean probability.
LEAST_SCORE = 0.3


def _columns(df: DataFrame, like: DataFrame) -> DataFrame:
    return df.select(*[F.col(f"`{c}`") for c in like.columns])


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a recognised language: neither ``und`` nor a score below ``LEAST_SCORE``.

    Learns from the rows that have a ``lang``; where no row has one, every document with a letter stays.  Null, empty and
    letterless texts go; very long texts are judged whole; repeated rows are judged alike; an empty table stays empty."""
    model = langid.train(docs)
    if model is None:
        return docs.where(F.col("text").cast("string").rlike(r"\p{L}"))
    lid = fresh(docs, "__lid")
    found = docs.withColumn(lid, langid.predictor(model)(F.col("text").cast("string")))
    return _columns(found.where((F.col(f"{lid}.lang_pred") != "und") & (F.col(f"{lid}.score") >= LEAST_SCORE)), docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group whose fingerprints link: that with the smallest id.

    Null and empty texts and those of white space alone share fingerprint zero, so one of them stays; of rows that repeat id and
    text one stays; rows without an id come last in their group; very long texts are hashed whole; empty stays empty."""
    return simhash.keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which less than a twentieth of the words are benchmark windows.

    Null and empty texts have no words and stay; repeated rows stay or go alike; very long texts are read whole; with an empty
    benchmark all stay."""
    overlap = fresh(docs, "__overlap")
    found = decontaminate.find_overlap(docs, table(spark, sf_dir, "benchmark"), out=overlap)
    return _columns(found.where(~decontaminate.contaminated(overlap)), docs)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated by their Poisson counts, sources at the square root of their bytes; a count of zero drops one.

    A null source is a source; null and empty texts count one byte; null ids draw by text; repeated rows are repeated alike;
    an empty table stays empty."""
    prefix = "__mix_"
    while any(c.lower().startswith(prefix) for c in docs.columns):
        prefix = "_" + prefix
    return _columns(mixing.mix(docs, prefix=prefix), docs)


def shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every row in a shard and slot (see ``sharding.shard``): null texts have size 1, null ids and repeated rows are rows like
    any other, equal texts stay together where they fit a shard, an empty table stays empty."""
    return sharding.shard(docs)


STAGES = [
    ("language ID", language_id),
    ("SimHash near-dedup", near_duplicates),
    ("benchmark decontamination", decontamination),
    ("mixing sources to target weights", mixture),
    ("sharding", shards),
]

#: The first two stages run a trained network and XXH64, which SQL does not have.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each is written to the shared folder and read by the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        out = stage(spark, docs, sf_dir)
        path = work_path(spark, "stage-" + name.split()[0])
        out.write.parquet(path)
        docs = spark.read.schema(out.schema).parquet(path)
    return docs
