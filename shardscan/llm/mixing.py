"""Mixing sources to target weights by Poisson replication.

Source ``s`` with ``n_s`` bytes shall make up the share ``w_s`` of a mixture
of ``N`` bytes, so each of its documents repeats at the mean rate
``w_s * N / n_s``.  A document's count is the inverse of the Poisson
distribution function at a uniform number from the md5 of seed, id and the text's md5:
independent of partitioning, and the same in any engine.  A rate above ``PART``
is drawn as a sum of independent parts of at most ``PART`` each, so the tabulated
function stays short.  Every copy gets a key
from the md5 of the same and the copy number; rows are dealt out by it and their place in the input, so that rows equal
in id and text do not meet in one task, and sorted by it.

Target weights default to ``n_s ** temperature``; or give ``weights``
(source -> weight; a source not named gets none).  Only DataFrame functions.

The per-source table has one row per source: broadcast up to
``max_broadcast_sources``; beyond that, rows and table are joined on (source, salt)
so that a source with a third of all rows is spread over ``salts`` keys.

Defined results: a null source is a source of its own; null and empty texts
have size 1; repeated rows share their count and keys; null ids draw like the
empty id, each by its text; a very long text is hashed once, never cut; an empty table gives an empty result; other columns
pass through, whatever their names (columns of the names under ``prefix`` are replaced).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shardscan.llm.common import documents, fresh, written

SEED = "mix-1"
PART = 128.0


def _uniform(*parts: Column) -> Column:
    """52 bits of md5 as a number in [0, 1)."""
    digest = F.md5(F.concat_ws("|", F.lit(SEED), *parts).cast("binary"))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") / F.lit(2.0 ** 52)


def _id(col: str) -> Column:
    return F.coalesce(F.col(col).cast("string"), F.lit(""))


def poisson_steps(rate: Column) -> Column:
    """The distribution function P(X <= k) for k = 0, 1, ... until 1 in double precision (rate <= ``PART``)."""
    top = F.ceil(rate + 12 * F.sqrt(rate) + 25).cast("int")
    start = F.struct((-rate).alias("log"), F.exp(-rate).alias("sum"), F.array(F.exp(-rate)).alias("steps"))

    def add(acc, k):
        log = acc["log"] + F.log(rate) - F.log(k.cast("double"))
        total = acc["sum"] + F.exp(log)
        return F.struct(log.alias("log"), total.alias("sum"), F.concat(acc["steps"], F.array(total)).alias("steps"))

    return F.when(rate > 0, F.aggregate(F.sequence(F.lit(1), top), start, add)["steps"]).otherwise(
        F.array(F.lit(1.0)))


def poisson_count(steps: Column, parts: Column, *key: Column) -> Column:
    """The sum of ``parts`` draws from the tabulated distribution, each inverted at its own uniform number."""
    def draw(u: Column) -> Column:
        return F.size(F.filter(steps, lambda c: c <= u)).cast("long")

    more = F.aggregate(F.sequence(F.lit(2), parts), F.lit(0).cast("long"),
                       lambda n, i: n + draw(_uniform(*key, F.concat(F.lit("part "), i.cast("string")))))
    return draw(_uniform(*key)) + F.when(parts > 1, more).otherwise(F.lit(0).cast("long"))


def source_rates(docs: DataFrame, temperature: float = 0.5, weights: dict[str, float] | None = None) -> DataFrame:
    """One row per source: ``mix_source, mix_rate``, the number of parts ``mix_parts`` its draws are made of
    and the distribution ``mix_steps`` of a part."""
    size = F.octet_length(F.coalesce(F.col("text").cast("string"), F.lit(""))) + 1
    by = docs.groupBy(F.col("source").cast("string").alias("mix_source")).agg(
        F.sum(size.cast("long")).cast("double").alias("n"))
    if weights is None:
        by = by.withColumn("w", F.pow("n", F.lit(temperature)))
    else:
        named = F.create_map(*[F.lit(x) for kv in weights.items() for x in kv])
        by = by.withColumn("w", F.coalesce(F.try_element_at(named, F.col("mix_source")), F.lit(0.0)).cast("double"))
    by = written(by, "sources")
    total = by.agg(F.sum("n").alias("n"), F.sum("w").alias("w")).first()
    all_n, all_w = F.lit(total["n"] or 0.0), F.lit(total["w"] or 0.0)
    rate = F.when(all_w > 0, F.col("w") / all_w * all_n / F.col("n")).otherwise(F.lit(0.0))
    parts = F.greatest(F.lit(1), F.ceil(F.col("mix_rate") / F.lit(PART)).cast("int"))
    return by.select("mix_source", rate.alias("mix_rate")).withColumn("mix_parts", parts).withColumn(
        "mix_steps", poisson_steps(F.col("mix_rate") / F.col("mix_parts")))


def mix(docs: DataFrame, temperature: float = 0.5, weights: dict[str, float] | None = None,
        max_broadcast_sources: int = 10_000, salts: int = 64, prefix: str = "mix_") -> DataFrame:
    """``docs`` with each row repeated by its count, shuffled, and the columns
    ``rate, count, copy`` (from 0) and ``key`` under ``prefix``."""
    spark = docs.sparkSession
    rate, count, copy, key = (f"{prefix}{x}" for x in ("rate", "count", "copy", "key"))
    docs = docs.drop(rate, count, copy, key)
    # columns of our own, by names the documents do not have
    own_source, own_rate, parts, steps, drawn, row, salt, salted_by = (
        fresh(docs, f"__mix_{x}") for x in ("source", "rate", "parts", "steps", "drawn", "row", "salt", "salted"))
    rates = source_rates(docs, temperature, weights).toDF(own_source, own_rate, parts, steps)
    text = F.md5(F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary"))
    docs = docs.withColumns({drawn: F.concat_ws("|", _id("doc_id"), text), row: F.xxhash64(F.monotonically_increasing_id())})
    few = rates.limit(max_broadcast_sources + 1).collect()
    source = F.col("source").cast("string")
    if len(few) <= max_broadcast_sources:
        side = F.broadcast(spark.createDataFrame(few, rates.schema))
        rows = docs.join(side, source.eqNullSafe(F.col(own_source)))
    else:
        salted = rates.withColumn(salt, F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
        left = docs.withColumn(salted_by, F.pmod(F.col(row), F.lit(salts)).cast("int"))
        rows = left.join(salted, source.eqNullSafe(F.col(own_source)) & (F.col(salted_by) == F.col(salt)))
    counted = rows.withColumn(rate, F.col(own_rate)).withColumn(
        count, poisson_count(F.col(steps), F.col(parts), F.col(drawn)).cast("int")).where(F.col(count) > 0)
    copies = counted.withColumn(copy, F.explode(F.sequence(F.lit(0), F.col(count) - 1)))
    keyed = copies.withColumn(key, F.md5(F.concat_ws("|", F.lit(SEED), F.col(drawn), F.col(copy).cast("string")).cast("binary")))
    # equal rows share a key: the place in the input, fixed by the scan, deals them out too
    dealt = keyed.drop(own_source, own_rate, parts, steps, drawn, salt, salted_by).repartition(F.col(key), F.col(row))
    return dealt.drop(row).sortWithinPartitions(key)


def op9_poisson_mixing(spark, sf_dir: str) -> DataFrame:
    """The mixture of ``documents``, sources at the square root of their bytes."""
    docs = documents(spark, sf_dir).select("doc_id", "text", "lang", "source", "n_chars")
    return mix(docs).select(
        "doc_id", "text", "lang", "source", "n_chars", F.round("mix_rate", 9).alias("rate"),
        F.col("mix_count").alias("n_copies"), F.col("mix_copy").alias("copy"), F.col("mix_key").alias("shuffle_key"))


_RATES_SQL = """
n AS (SELECT source, SUM(strlen(COALESCE(text, '')) + 1)::DOUBLE AS n FROM {docs} GROUP BY source),
t AS (SELECT SUM(n) AS all_n, SUM(pow(n, 0.5)) AS all_w FROM n),
r AS (SELECT source, pow(n, 0.5) / all_w * all_n / n AS rate FROM n, t),
q AS (SELECT source, rate, greatest(1, ceil(rate / 128.0))::INTEGER AS parts FROM r),
y AS (SELECT k, SUM(CASE WHEN k = 0 THEN 0 ELSE ln(k) END) OVER (ORDER BY k) AS lf FROM range(0, 400) x(k)),
p AS (SELECT source, rate, parts, k, exp(-rate / parts + k * ln(rate / parts) - lf) AS p
      FROM q JOIN y ON k <= rate / parts + 12 * sqrt(rate / parts) + 25),
c AS (SELECT source, rate, parts, k, SUM(p) OVER (PARTITION BY source ORDER BY k) AS f FROM p),
l AS (SELECT source, rate, parts, list(f ORDER BY k) AS steps FROM c GROUP BY ALL)"""

MIX_SQL = "WITH " + _RATES_SQL.format(docs="documents") + """,
d AS (SELECT *, 'mix-1|' || COALESCE(CAST(doc_id AS VARCHAR), '') || '|' || md5(COALESCE(text, '')) AS key FROM documents),
m AS (SELECT d.key, d.doc_id, d.text, d.lang, d.source, d.n_chars, round(l.rate, 9) AS rate,
        CAST(list_sum(list_transform(range(1, l.parts + 1), lambda i: len(list_filter(l.steps, lambda f: f <= (
          '0x' || substr(md5(d.key || CASE WHEN i = 1 THEN '' ELSE '|part ' || i END), 1, 13))::BIGINT
          / 4503599627370496.0)))) AS INTEGER) AS n_copies
      FROM d JOIN l ON d.source IS NOT DISTINCT FROM l.source)
SELECT doc_id, text, lang, source, n_chars, rate, n_copies, copy, md5(key || '|' || copy) AS shuffle_key
FROM (SELECT *, CAST(unnest(range(0, n_copies)) AS INTEGER) AS copy FROM m WHERE n_copies > 0)"""
