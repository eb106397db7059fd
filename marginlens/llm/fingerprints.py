"""Document fingerprints by consistent weighted sampling, in Spark expressions.

A text is a weighted set: its five-word shingles, each weighing as much as it
occurs often.  For every term and sample number, hashes of both give

    r, c ~ Gamma(2, 1),  b ~ Uniform(0, 1)
    t = floor(ln(weight) / r + b),   ln a = ln c - r (t - b + 1)

and the sample is the (term, t) with the smallest a.  Two texts agree in a
sample with a probability equal to their generalised Jaccard similarity (sum
of smaller over sum of larger weights).

Terms are exploded and reduced by one aggregate with a ``min`` per sample, of
a long with a quantised ln a above and 32 bits of a hash of (term, t) below.
The smallest a of a text of total weight W is exponential with mean 1/W, so
a term with a > 16 / W wins with a probability of exp(-16) only, and is left
out (a sample that no term wins agrees only with another such).  Since a weight >= c exp(-r) = -ln(u3 u4) u1 u2 for the four uniforms
behind c and r, most terms fail by products alone, before any logarithm.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from marginlens.llm.scratch import cut
from marginlens.llm.textkeys import mixed

SAMPLES = 64
WORDS = 5
#: Samples that one row of the aggregate holds (``samples`` is a multiple).
WIDTH = 16
#: Terms with a > REACH / W are not looked at first.  A sample that no term below that wins, which happens with
#: probability exp(-REACH), is taken again from all terms of its text, so each is the least of all terms.
REACH = 16
LOW, HALF = (1 << 32) - 1, 1 << 31
#: Keys of texts with open samples that are broadcast (after counting).
BROADCAST_ROWS = 1_000_000
#: A sample of a text without words.
NOTHING = (1 << 63) - 1


def with_words(texts: DataFrame, text: str, name: str) -> DataFrame:
    """``texts`` with ``<name>_keys``, the sorted hashes of a text's five-word
    shingles, and ``<name>_once``, the distinct ones, instead of ``text``.

    Words are ``[^\\x20\\x09-\\x0D]+``; fewer than five are one shingle, and a
    text without words has none.  Five-word hashes are made from pairs of
    pairs, a whole array at a time.
    """
    keep = [c for c in texts.columns if c != text]
    n = F.size("w1")

    def paired(a: str, b: str, distance: int) -> Column:
        return F.zip_with(a, F.slice(b, F.lit(distance + 1), n), lambda x, y: F.xxhash64(x, y))

    words = F.filter(F.split(text, "[\\x20\\x09-\\x0D]+"), lambda x: x != "")
    whole = F.slice(paired("w4", "w1", 4), F.lit(1), F.greatest(n - (WORDS - 1), F.lit(1)))
    return (
        texts.select(*keep, F.transform(words, lambda x: F.xxhash64(x)).alias("w1"))
        .withColumn("w2", paired("w1", "w1", 1)).withColumn("w4", paired("w2", "w2", 2))
        .select(*keep, F.sort_array(whole).alias(f"{name}_keys"))
        .withColumn(f"{name}_once", F.array_distinct(f"{name}_keys"))
    )


def _repeats(name: str) -> Column:
    return F.size(f"{name}_once") < F.size(f"{name}_keys")


def _single(hashes: Column, kind: int) -> Column:
    return F.transform(hashes, lambda h: F.struct(F.lit(kind).alias("kind"), h.alias("h"), F.lit(1).alias("w")))


def _weighted(name: str, kind: int) -> Column:
    """Terms with their weights: the run lengths of the sorted hashes."""
    keys, starts = f"{name}_keys", f"{name}_starts"
    runs = F.transform(starts, lambda s, j: F.struct(
        F.lit(kind).alias("kind"), F.get(keys, s).alias("h"), (F.coalesce(F.get(starts, j + 1), F.size(keys)) - s).alias("w")))
    return F.when(_repeats(name), runs).otherwise(_single(F.col(f"{name}_once"), kind))


def _with_starts(texts: DataFrame, name: str) -> DataFrame:
    keys = f"{name}_keys"
    starts = F.filter(F.sequence(F.lit(0), F.size(keys) - 1), lambda i: (i == 0) | (F.get(keys, i) != F.get(keys, i - 1)))
    return texts.withColumn(f"{name}_starts", F.when(_repeats(name), starts))


def _constant(k: int) -> Column:
    """The k-th of a fixed sequence of 64-bit constants."""
    return F.lit(int(mixed(np.array([k + 1], np.uint64)).view(np.int64)[0]))


def _product(x: Column) -> Column:
    """2**64 times the product of two uniform numbers in (0, 1), from a 64-bit hash."""
    high = F.shiftrightunsigned(x, 32).cast("double") + 0.5
    return high * (x.bitwiseAND(F.lit(LOW)).cast("double") + 0.5)


def sample(k: int) -> Column:
    """What a term offers to sample ``k``; NULL if it cannot be the smallest.

    Of the columns ``h`` (hash), ``w`` (weight), ``ln_w`` and ``bound``, which
    is 2**64 times the largest a worth a look times the weight.
    """
    h = F.col("h")
    small = _product(F.xxhash64(h.bitwiseXOR(_constant(3 * k))))
    other = _product(F.xxhash64(h.bitwiseXOR(_constant(3 * k + 1)))) * 2.0**-64
    d = 1 - other  # c = -ln(1 - d) is more than the first terms of its series
    r = -F.log(small * 2.0**-64)
    b = (F.shiftrightunsigned(F.xxhash64(h.bitwiseXOR(_constant(3 * k + 2))), 11).cast("double")) * 2.0**-53
    t = F.floor(F.col("ln_w") / r + b)
    ln_a = F.log(-F.log(other)) - r * (t - b + 1)
    rank = F.floor((F.greatest(ln_a, F.lit(-60.0)) + 64) * 2.0**24)
    offer = F.shiftleft(rank, 32).bitwiseOR(F.hash(h, t).cast("long").bitwiseAND(F.lit(LOW)))
    return F.when(d * (1 + d * (1 / 2 + d * (1 / 3 + d * (1 / 4 + d * (1 / 5 + d / 6))))) * small <= F.col("bound"), offer)


def least_offers(terms: DataFrame, keys: list[str], samples: int, reach: float) -> DataFrame:
    """``keys``, ``part`` and the smallest offer to each sample of the part, over
    rows ``keys, h, w`` and the text's total ``weight``; with ``limit``, below
    which an offer's rank is the least of all terms, and ``some``, whether there are any."""
    limit = F.floor((F.log(reach / F.col("weight")) + 64) * 2.0**24)
    parts = terms.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(samples // WIDTH - 1)))).select(
        *keys, "part", F.xxhash64("h", "part").alias("h"), F.log(F.col("w").cast("double")).alias("ln_w"),
        (F.col("w") / F.col("weight") * reach * 2.0**64).alias("bound"), limit.alias("limit"))
    return parts.groupBy(*keys, "part").agg(
        *[F.min(sample(k)).alias(f"s{k}") for k in range(WIDTH)], F.max("limit").alias("limit"), (F.count("ln_w") > 0).alias("some"))


def _least(k: int, condition: Column | None) -> Column:
    offer = F.col(f"s{k}") if condition is None else F.when(condition, F.col(f"s{k}"))
    return F.coalesce(F.min(offer), F.lit(NOTHING))


def _values(condition: Column | None = None) -> Column:
    """The part's samples as an array of ints: the lower bits of the smallest offers, less 2**31."""
    return F.array(*[(_least(k, condition).bitwiseAND(F.lit(LOW)) - HALF).cast("int") for k in range(WIDTH)])


def _open(condition: Column | None = None) -> Column:
    """Whether a term that was not looked at may win one of the part's samples."""
    some = F.max(F.col("some") if condition is None else F.when(condition, F.col("some")))
    far = [F.shiftright(_least(k, condition), 32) >= F.max("limit") for k in range(WIDTH)]
    return F.coalesce(some, F.lit(False)) & F.greatest(*far)


def _in_order(values: str) -> Column:
    """The arrays of all parts, one after another."""
    return F.flatten(F.transform(F.sort_array(F.collect_list(F.struct("part", values))), lambda x: x[values]))


def _whole(texts: DataFrame, keys: list[str], bounded, only=None) -> DataFrame:
    """``bounded(texts, reach)``, written; the few texts with open samples are
    done again from all terms (``only`` makes them from their keys, if that is
    cheaper than filtering ``texts``)."""
    made = cut(bounded(texts, REACH))
    again = made.filter("open").select(*[F.col(k).alias(f"__{k}") for k in keys]).distinct()
    if again.isEmpty():
        return made.drop("open")
    same = [F.col(k) == F.col(f"__{k}") for k in keys]
    redone = bounded((only(again) if only else texts).join(again, same, "left_semi"), float("inf"))
    return made.filter("NOT open").unionByName(redone).drop("open")


def fingerprint(texts: DataFrame, keys: list[str], samples: int = SAMPLES) -> DataFrame:
    """``keys`` and ``samples`` (array of ints) per distinct key of ``texts``,
    whose other column is ``text``; neither is NULL.  Numbers as keys are
    fastest.  Rows with the same key must have the same text.  Equal texts get
    equal samples; texts without words agree with each other only."""

    def bounded(rows: DataFrame, reach: float) -> DataFrame:
        words = _with_starts(with_words(rows.select(*keys, "text"), "text", "a"), "a")
        terms = words.select(*keys, F.size("a_keys").alias("weight"), F.explode_outer(_weighted("a", 0)).alias("x")).select(
            *keys, "weight", "x.h", "x.w")
        least = least_offers(terms, keys, samples, reach).groupBy(*keys, "part").agg(_values().alias("values"), _open().alias("open"))
        return least.groupBy(*keys).agg(_in_order("values").alias("samples"), F.max("open").alias("open"))

    return _whole(texts, keys, bounded)


def _bounded_pairs(texts: DataFrame, keys: list[str], samples: int, reach: float) -> DataFrame:
    """``keys, own, edited, open`` of :func:`fingerprint_pairs`, from terms within ``reach``."""
    words = with_words(with_words(texts.select(*keys, "text", "edited"), "text", "a"), "edited", "b")
    words = _with_starts(_with_starts(words, "a"), "b").withColumn("common", F.array_intersect("a_once", "b_once"))
    shared = F.concat(_single(F.col("common"), 2), _single(F.array_except("a_once", "common"), 0),
                      _single(F.array_except("b_once", "common"), 1))
    both = F.when(_repeats("a") | _repeats("b"), F.concat(_weighted("a", 0), _weighted("b", 1))).otherwise(shared)
    # the lighter of the two texts has the wider bound, which serves both
    weight = F.greatest(F.least(F.size("a_keys"), F.size("b_keys")), F.lit(1))
    terms = words.select(*keys, weight.alias("weight"), F.explode_outer(both).alias("x")).select(
        *keys, "weight", F.coalesce("x.kind", F.lit(2)).alias("kind"), "x.h", "x.w")
    own, edited = F.col("kind") != 1, F.col("kind") != 0
    least = least_offers(terms, [*keys, "kind"], samples, reach).groupBy(*keys, "part").agg(
        _values(own).alias("own"), _values(edited).alias("edited"), (_open(own) | _open(edited)).alias("open"))
    return least.groupBy(*keys).agg(_in_order("own").alias("own"), _in_order("edited").alias("edited"), F.max("open").alias("open"))


def fingerprint_pairs(texts: DataFrame, keys: list[str], samples: int = SAMPLES) -> DataFrame:
    """``keys, own, edited``: the fingerprints of the columns ``text`` and
    ``edited``, each what :func:`fingerprint` gives.  Terms that weigh the same
    in both are sampled once."""
    return _whole(texts, keys, lambda rows, reach: _bounded_pairs(rows, keys, samples, reach))


def likeness(a: str, b: str) -> Column:
    """Share of the samples in which two fingerprints agree."""
    same = F.aggregate(F.zip_with(a, b, lambda x, y: (x == y).cast("int")), F.lit(0), lambda s, x: s + x)
    return same.cast("double") / F.size(a)


def as_text(samples: str) -> Column:
    return F.array_join(F.transform(samples, lambda x: F.lpad(F.lower(F.hex(x.cast("long") + HALF)), 8, "0")), "")


def next_keys(docs: DataFrame) -> DataFrame:
    """``key, next_key``: distinct keys with the next larger one, the last with
    the first.  Keys are range-partitioned and written once, so the ranges are
    the same for every later read; only one row per range meets in one task."""
    ranged = cut(docs.select("key").distinct().repartitionByRange("key").withColumn("range", F.spark_partition_id()))
    order = W.orderBy("range")
    first = ranged.groupBy("range").agg(F.min("key").alias("first"))
    after = first.select("range", F.coalesce(F.lead("first").over(order), F.first("first").over(
        order.rowsBetween(W.unboundedPreceding, W.currentRow))).alias("after"))
    inside = F.lead("key").over(W.partitionBy("range").orderBy("key"))
    return ranged.join(F.broadcast(after), "range").select("key", F.coalesce(inside, "after").alias("next_key"))


def edited_fingerprints(docs: DataFrame, samples: int = SAMPLES) -> DataFrame:
    """Fingerprints of every whole text and of its edited text.

    The last quarter of the code points (rounded down) is replaced by the
    first as many (or all) of the next document's, in ascending ``doc_id``;
    the last document is followed by the first.  Returns ``doc_id, n_chars,
    edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next``.

    NULL text counts as empty, a NULL id as smaller than all others.  Repeated
    rows come out repeatedly; among different texts of one id, that with the
    smallest hash is the next document of the id before.  Equal texts have
    equal fingerprints.  Other columns, whatever their names, are ignored.
    """
    base = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63))).alias("key"),
                       F.coalesce("text", F.lit("")).alias("text"))
    follow = cut(next_keys(base))

    def with_edits(rows: DataFrame) -> DataFrame:
        """``key, h_text, text, edited`` of those ``rows`` whose next key is among them, too."""
        need = rows.groupBy("key").agg(F.max(F.floor(F.length("text") / 4)).cast("int").alias("need"))
        asked = need.join(follow, "key").select(F.col("next_key").alias("key"), F.col("key").alias("asker"), "need")
        heads = (
            rows.join(asked, "key")
            .groupBy("asker").agg(F.min(F.struct(F.xxhash64("text").alias("h"), F.expr("substring(text, 1, need)").alias("head"))).alias("m"))
            .select(F.col("asker").alias("key"), "m.head")
        )
        quarter = F.floor(F.length("text") / 4).cast("int")
        edited = F.concat(F.expr("substring(text, 1, length(text) - cast(floor(length(text) / 4) as int))"),
                          F.substring("head", F.lit(1), quarter))
        return rows.join(heads, "key").select("key", F.xxhash64("text").alias("h_text"), "text", edited.alias("edited"))

    def only(again: DataFrame) -> DataFrame:
        """The texts with open samples and the next ones, from a scan that drops all others."""
        mine = again.select(F.col("__key").alias("key"))
        wanted = cut(mine.unionByName(mine.join(follow, "key").select(F.col("next_key").alias("key"))).distinct())
        return with_edits(base.join(F.broadcast(wanted) if wanted.count() <= BROADCAST_ROWS else wanted, "key", "left_semi"))

    ids = ["key", "h_text"]
    # Both sides are partitioned by the key already; as an equality, the hash
    # would be a join key too, and both sides would be shuffled again.
    same = (F.col("key") == F.col("k")) & (F.col("h_text") <= F.col("h")) & (F.col("h_text") >= F.col("h"))

    def bounded(rows: DataFrame, reach: float) -> DataFrame:
        about = rows.select(  # one row per document
            F.col("key").alias("k"), F.col("h_text").alias("h"), F.length("text").cast("long").alias("n_chars"),
            F.sha2("edited", 256).alias("edited_sha256"))
        return _bounded_pairs(rows, ids, samples, reach).join(about, same).drop("k", "h")

    pairs = _whole(with_edits(base), ids, bounded, only)
    of_next = pairs.groupBy("key").agg(F.min_by("own", "h_text").alias("of_next")).withColumnRenamed("key", "next_key")
    return pairs.join(follow, "key").join(of_next, "next_key").select(
        F.when(F.col("key") != -(1 << 63), F.col("key")).alias("doc_id"), "n_chars", "edited_sha256",
        as_text("own").alias("fingerprint"), as_text("edited").alias("edited_fingerprint"),
        likeness("own", "edited").alias("near_edited"), likeness("own", "of_next").alias("near_next"))


def op2_document_fingerprints(spark, sf_dir: str) -> DataFrame:
    return edited_fingerprints(spark.read.parquet(f"{sf_dir}/documents.parquet"))
