"""Mixing sources to target weights by Poisson replication, in Spark expressions.

A source's target weight fixes its mean repetition rate.  Each document draws
its number of copies from a Poisson distribution with that mean, by inverting
the distribution at a uniform number taken from a hash of seed, source and
id; copies are exploded and the whole mixture is shuffled globally by another
hash.  Everything follows from the hashes: a retried task, another cluster or
another number of partitions gives the same mixture.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marginlens.llm.scratch import cut

#: Sources up to this number are broadcast (after counting); more are joined by shuffle, salted.
BROADCAST_SOURCES = 10_000
SALTS = 64


def uniform(*parts: Column | str) -> Column:
    """A number in [0, 1) from the first 52 bits of an MD5 hash of the parts."""
    text = F.concat_ws(":", *[F.coalesce(p.cast("string"), F.lit("null")) if isinstance(p, Column) else F.lit(p) for p in parts])
    return F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("double") / F.lit(float(2**52))


def poisson_first(rate: Column) -> Column:
    """The smallest count that a number of 52 random bits above 0 can reach."""
    return F.greatest(F.lit(0), F.floor(rate - 12 * F.sqrt(rate) - 24).cast("int"))


def poisson_cdf(rate: Column) -> Column:
    """Cumulative probabilities of ``poisson_first(rate)`` and the counts after it as an
    array, up to a count that 52 random bits cannot exceed.

    Probabilities are taken relative to the mode's, downward and upward from it, and
    divided by their sum, so that no rate makes them vanish."""
    first, mode = poisson_first(rate), F.floor(rate).cast("int")
    last = F.ceil(rate + 12 * F.sqrt(rate) + 24).cast("int")

    def running(start: Column, values: Column, following, finish=lambda acc: acc["all"]) -> Column:
        """``start`` and what ``following`` makes of the last number and each of the values."""
        state = F.struct(F.array(start).alias("all"), start.alias("last"))

        def step(acc: Column, x: Column) -> Column:
            value = following(acc["last"], x)
            return F.struct(F.concat(acc["all"], F.array(value)).alias("all"), value.alias("last"))

        return F.aggregate(values, state, step, finish)

    one, none = F.lit(1.0), F.array().cast("array<int>")
    down = F.when(mode > first, F.sequence(mode, first + 1, F.lit(-1))).otherwise(none)
    below = F.slice(F.reverse(running(one, down, lambda p, k: p * k / rate)), F.lit(1), mode - first)
    weights = F.concat(below, running(one, F.sequence(mode + 1, last), lambda p, k: p * rate / k))
    return running(F.lit(0.0), weights, lambda total, p: total + p,
                   lambda acc: F.transform(F.slice(acc["all"], F.lit(2), last - first + 1), lambda total: total / acc["last"]))


def source_rates(docs: DataFrame, alpha: float = 0.5, total: float = 1.0) -> DataFrame:
    """``source, rate`` for temperature weights: a source's share of the target
    is proportional to its number of documents to the power ``alpha``, and the
    mixture has ``total`` times as many documents as the corpus (in the mean)."""
    n = cut(docs.groupBy("source").agg(F.count(F.lit(1)).alias("n")))
    weight = F.pow(F.col("n").cast("double"), F.lit(alpha))
    whole = n.agg(F.sum("n").alias("n"), F.sum(weight).alias("w")).first()
    return n.select("source", (weight / F.lit(whole["w"]) * F.lit(whole["n"]) * total / F.col("n")).alias("rate"))


def mix_sources(docs: DataFrame, rates: DataFrame, seed: str = "mix", id_col: str = "doc_id") -> DataFrame:
    """The documents replicated to their sources' rates and globally shuffled.

    ``rates`` has ``source`` (unique; NULL is a source like any other) and
    ``rate`` (mean copies of each document, any number from 0).  Sources that it does
    not name, and those with a NULL rate, get none.  Adds ``copy`` (from 0)
    and ``shuffle_key`` (the place in the global order); columns of these
    names are replaced.  Rows with the same source and id are replicated
    alike.  Documents may have any text, NULL too.  Rates below 0, NaN and
    infinite ones raise ``ValueError``.
    """
    cols = [c for c in docs.columns if c not in ("copy", "shuffle_key")]
    table = cut(rates.select(F.col("source").alias("__source"), F.col("rate").cast("double").alias("__rate"))
                .filter("__rate IS NOT NULL"))
    stats = table.agg(F.count(F.lit(1)).alias("n"), F.min("__rate").alias("low"), F.max("__rate").alias("high")).first()
    if stats["n"] and not 0 <= stats["low"] <= stats["high"] < math.inf:
        raise ValueError("rates must be finite and not below 0")
    table = table.withColumn("__first", poisson_first(F.col("__rate"))).withColumn("__cdf", poisson_cdf(F.col("__rate")))
    source, ident = F.col("source"), F.col(f"`{id_col}`")
    if stats["n"] <= BROADCAST_SOURCES:
        joined = docs.join(F.broadcast(table), source.eqNullSafe(F.col("__source")))
    else:
        salted = table.withColumn("__salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        joined = docs.join(salted, source.eqNullSafe(F.col("__source"))
                           & (F.pmod(F.xxhash64(ident), F.lit(SALTS)) == F.col("__salt")))
    u = uniform(seed, source, ident)
    count = F.col("__first") + F.size(F.filter("__cdf", lambda c: c <= F.col("__u")))
    copies = joined.withColumn("__u", u).withColumn("__n", count).filter("__n > 0").select(
        *[F.col(f"`{c}`") for c in cols], F.explode(F.sequence(F.lit(0), F.col("__n") - 1)).alias("copy"))
    return (copies.withColumn("shuffle_key", uniform(f"{seed}/order", F.col("source"), ident, F.col("copy")))
            .orderBy("shuffle_key"))


def op8_mix_sources(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return mix_sources(docs, source_rates(docs.select("source"), alpha=0.5))


OP8_SQL = r"""
WITH n AS (SELECT source, count(*) AS n FROM documents GROUP BY source
), w AS (SELECT sum(n) AS n_all, sum(pow(CAST(n AS DOUBLE), 0.5)) AS w_all FROM n
), r AS (SELECT source, pow(CAST(n AS DOUBLE), 0.5) / w_all * n_all * 1.0 / n AS rate FROM n, w
), p AS (
  SELECT source, rate, k, CASE WHEN k = 0 THEN exp(-rate) ELSE exp(-rate + k * ln(rate) - lgamma(k + 1)) END AS p
  FROM r, (SELECT unnest(range(0, m)) AS k FROM (SELECT CAST(max(ceil(rate + 12 * sqrt(rate) + 24)) AS BIGINT) + 1 AS m FROM r))
  WHERE k <= ceil(rate + 12 * sqrt(rate) + 24)
), c AS (SELECT source, k, sum(p) OVER (PARTITION BY source ORDER BY k) AS cdf FROM p
), t AS (SELECT source, list(cdf ORDER BY k) AS cdf FROM c GROUP BY source
), d AS (
  SELECT d.*, t.cdf, CAST(CAST('0x' || substr(md5('mix:' || coalesce(d.source, 'null') || ':'
           || coalesce(CAST(doc_id AS VARCHAR), 'null')), 1, 13) AS BIGINT) AS DOUBLE) / 4503599627370496.0 AS u
  FROM documents d JOIN t ON d.source IS NOT DISTINCT FROM t.source
), m AS (SELECT doc_id, text, lang, source, n_chars, unnest(range(0, len(list_filter(cdf, lambda x: x <= u)))) AS copy FROM d)
SELECT doc_id, text, lang, source, n_chars, CAST(copy AS INTEGER) AS copy,
  CAST(CAST('0x' || substr(md5('mix/order:' || coalesce(source, 'null') || ':' || coalesce(CAST(doc_id AS VARCHAR), 'null')
       || ':' || CAST(copy AS VARCHAR)), 1, 13) AS BIGINT) AS DOUBLE) / 4503599627370496.0 AS shuffle_key
FROM m
"""
