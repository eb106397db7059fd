"""Line dedup: drop lines found in many documents, with Spark expressions only.

Every text is split at ``\\n``; a line's key is the line without the white
space ``[\\x20\\x09-\\x0D]`` at its ends, with A-Z in lower case.  Keys found
in at least ``min_docs`` documents lose all their lines everywhere.

Plan: hash the lines of each text (128 bits), keep the arrays of hashes as a
checkpoint, explode each document's *distinct* hashes and count documents per
hash (combined on the map side), then join the frequent hashes, salted, back
to the exploded positions and rebuild each text from the positions that stay.
Line texts are never shuffled by line, so a line that a third of all
documents share costs one count per map task and one salted share per reducer.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marginlens.llm.scratch import cut

#: The white space that is stripped, and the letters that are folded.
SPACE = " \t\n\x0b\f\r"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"

#: Copies of the frequent-hash list, and shares a hot line's rows are dealt to.
SALTS = 16


def lines_of(text: Column) -> Column:
    """Lines of a text; NULL and empty text are one empty line."""
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def line_key(line: Column) -> Column:
    return F.translate(F.btrim(line, F.lit(SPACE)), UPPER, LOWER)


def _hash(key: Column) -> Column:
    """128 bits of a key as two longs; NULL for a key of too few code points."""
    return F.struct(F.xxhash64(key).alias("a"), F.xxhash64(F.lit("second"), key).alias("b"))


def drop_repeated_lines(docs: DataFrame, min_docs: int = 10, min_chars: int = 1, text_col: str = "text",
                        id_col: str = "doc_id") -> DataFrame:
    """``docs`` with the repeated lines gone from ``text_col``, plus ``n_lines``
    (before dropping) and ``n_dropped``.

    Each row is a document, so a repeated row counts once more.  NULL text
    counts as one empty line and comes back as the empty string; keys shorter
    than ``min_chars`` code points are never dropped.  NULL ids are ordinary
    values.  Input columns named like the two new ones are replaced.  An
    empty table gives an empty table.
    """
    kept_cols = [c for c in docs.columns if c not in ("n_lines", "n_dropped")]
    base = docs.select(*[F.col(f"`{c}`") for c in kept_cols])
    text, ident = F.col(f"`{text_col}`"), F.col(f"`{id_col}`")

    def keyed(line: Column) -> Column:
        return F.when(F.length(line) >= min_chars, _hash(line))

    hashed = cut(base.select(
        ident.alias("id"),
        F.xxhash64(text).alias("row_key"),
        F.transform(F.transform(lines_of(text), line_key), keyed).alias("hashes"),
    ))
    frequent = (
        hashed.select(F.explode(F.array_distinct("hashes")).alias("h")).filter("h IS NOT NULL")
        .groupBy("h.a", "h.b").agg(F.count(F.lit(1)).alias("n_docs"))
        .filter(F.col("n_docs") >= min_docs)
        .select("a", "b", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    )
    dropped = (
        hashed.select("id", "row_key", F.posexplode("hashes").alias("pos", "h")).filter("h IS NOT NULL")
        .select("id", "row_key", "pos", "h.a", "h.b",
                F.pmod(F.hash("id", "row_key"), F.lit(SALTS)).alias("salt"))
        .join(frequent, ["a", "b", "salt"], "left_semi")
        .groupBy("id", "row_key").agg(F.collect_set("pos").alias("gone"))
        .withColumnsRenamed({"id": "__id", "row_key": "__row_key", "gone": "__gone"})
    )
    joined = base.join(dropped, ident.eqNullSafe(F.col("__id")) & (F.xxhash64(text) == F.col("__row_key")), "left")
    lines = lines_of(text)
    stay = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.coalesce("__gone", F.array().cast("array<int>")))
    kept = F.when(F.col("__gone").isNull(), F.coalesce(text, F.lit(""))).otherwise(
        F.array_join(F.transform(stay, lambda i: F.get(lines, i)), "\n"))
    return joined.select(
        *[kept.alias(c) if c == text_col else F.col(f"`{c}`") for c in kept_cols],
        F.size(lines).cast("long").alias("n_lines"),
        (F.size(lines) - F.size(stay)).cast("long").alias("n_dropped"),
    )


def op7_line_dedup(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return drop_repeated_lines(docs, min_docs=10, min_chars=1).select(
        "doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


OP7_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents
), l AS (
  SELECT r, doc_id, unnest(lines) AS line, generate_subscripts(lines, 1) AS pos FROM d
), k AS (
  SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l
), bad AS (
  SELECT key FROM k WHERE length(key) >= 1 GROUP BY key HAVING count(DISTINCT r) >= 10
)
SELECT doc_id, count(*) AS n_lines,
       CAST(sum(CASE WHEN bad.key IS NOT NULL THEN 1 ELSE 0 END) AS BIGINT) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE bad.key IS NULL), '')) AS kept_sha256
FROM k LEFT JOIN bad USING (key)
GROUP BY r, doc_id
"""
