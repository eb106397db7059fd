"""Corpus pipeline: documents to packed training sequences in five stages.

``STAGES`` lists (name, function); each function takes ``(spark, docs,
sf_dir)`` and returns a DataFrame that is written as Parquet and read again
as the next one's ``docs``.  All but the last return the columns of
``documents``.
"""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from marginlens.llm import line_dedup, mixing, ngram_join, packing, quality
from marginlens.llm.scratch import cut
from marginlens.plans.session import remove, shared_scratch

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def reject_junk(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier predicts as label 0 go; texts are not changed.

    NULL and empty texts have the score of the bias alone and all go or stay
    together.  Repeated rows have the same score.  Documents with a NULL id are
    scored, never learnt from.  An empty table stays empty; without any labels
    every document stays (score 0.5)."""
    model = quality.fit_quality(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return quality.score_quality(docs.select(*COLUMNS), model).filter("predicted = 1").select(*COLUMNS)


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines found in 10 documents or more go; every document stays, with its new length.

    A row is a document, so repeated rows count once each.  NULL text becomes
    the empty string, as one empty line; empty lines never go.  NULL ids are
    ordinary values, and an empty table stays empty."""
    out = line_dedup.drop_repeated_lines(docs, min_docs=10, min_chars=1)
    return out.withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of rows linked by 80 % of their five-word shingles, the one with the
    smallest id stays, a row without id only if none has one.  Of rows of that
    id, or of none, the one with the smallest text key, then of the smallest
    other columns stays.  Rows without shingles are linked with nothing and stay."""
    key = ["doc_id", "key_a", "key_b"]
    found = ngram_join.jaccard_components(docs, size=5, percent=80, keyed=True).filter("n_shingles > 0")
    rows = cut(found.groupBy("component", *key).agg(F.count(F.lit(1)).alias("n")))
    first = rows.groupBy("component").agg(F.min(F.struct(F.isnull("doc_id").alias("none"), *key)).alias("first"))
    stays = F.struct(F.isnull("doc_id").alias("none"), *key).eqNullSafe(F.col("first"))
    marked = cut(rows.join(first, "component").withColumn("gone", ~stays).filter("gone OR n > 1").select(
        *[F.col(c).alias(f"__{c}") for c in key], "gone"))
    keyed = docs.select(*COLUMNS, *ngram_join.text_keys("text"))
    same = [F.col(c).eqNullSafe(F.col(f"__{c}")) for c in key]
    out = keyed.join(marked.filter("gone"), same, "left_anti")
    repeated = marked.filter("NOT gone")
    if repeated.take(1):
        order = Window.partitionBy(*key).orderBy(*[c for c in COLUMNS if c not in ("doc_id", "text")])
        one = out.join(repeated, same, "left_semi").withColumn("__rank", F.row_number().over(order)).filter("__rank = 1")
        out = out.join(repeated, same, "left_anti").unionByName(one.drop("__rank"))
    return out.select(*COLUMNS)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each source repeated to its target rate (temperature 0.5).

    A document may come out no time, once or more often, with its row unchanged;
    rows with equal source and id, NULL ones too, come out equally often.  A NULL
    source is a source; NULL and empty texts are documents; an empty table stays
    empty."""
    return mixing.mix_sources(docs, mixing.source_rates(docs.select("source"), alpha=0.5)).select(*COLUMNS)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every copy cut into pieces and packed into sequences of 1024 tokens.

    Each row is packed on its own, repeated ones too; a NULL or empty text is
    one piece of the end token alone, and a NULL id stays NULL.  An empty table
    gives no pieces."""
    return packing.pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("quality", reject_junk),
    ("line_dedup", dedup_lines),
    ("near_copies", drop_near_copies),
    ("mixing", mix),
    ("packing", pack),
]

#: The classifier's and the joins' work cannot be said in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages applied to ``documents``, each written and read again; a
    stage's table goes when the next one is written."""
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES:
        out = f"{shared_scratch(spark, name)}-{uuid.uuid4().hex[:8]}"
        stage(spark, docs, sf_dir).write.parquet(out)
        if before:
            remove(spark, before)
        docs, before = spark.read.parquet(out), out
    return docs
