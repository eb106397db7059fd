"""Quality classifier: Naive Bayes support vectors over hashed word n-grams.

A document's n-grams (single words, pairs of neighbours, and one indicator of
a word that stands four times in a row) are hashed to ``2**bits`` indicators.
Indicators are scaled by the log-ratio of their smoothed counts in the two
classes, documents to unit length, and a linear hinge-loss model is fitted by
dual coordinate descent.

The fit sees at most about ``max_rows`` labelled documents, chosen by a hash
of the id, in one task; its model is two arrays of ``2**bits`` floats whatever
the input.  Scoring is one pass over whole texts without a shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marginlens.llm.textkeys import STEP, mixed, slices, word_keys

#: Documents in the fit, up to the chance of the hash.
MAX_ROWS = 12_000
BITS = 18
#: Hash of the indicator of a run of four equal words.
RUN = np.uint64(0x52554E)


def ngram_indicators(column: pa.Array, bits: int = BITS) -> Iterator[np.ndarray]:
    """Distinct hashed n-grams of each text, sorted; NULL and empty texts have none."""
    shift = np.uint64(64 - bits)
    for words in word_keys(column, lower=False):
        keys = [words]
        if len(words) > 1:
            keys.append(mixed(words[:-1] * STEP + words[1:]))
        if len(words) > 3:
            same = words[1:] == words[:-1]
            if (same[:-2] & same[1:-1] & same[2:]).any():
                keys.append(mixed(np.array([RUN])))
        yield np.unique((np.concatenate(keys) >> shift).astype(np.int32))


@dataclass
class Model:
    weight: np.ndarray  # hinge weight times log-count ratio
    square: np.ndarray  # squared log-count ratio
    bias: float

    def margins(self, column: pa.Array, bits: int) -> np.ndarray:
        out = np.full(len(column), self.bias)
        for i, x in enumerate(ngram_indicators(column, bits)):
            length = float(self.square[x].sum())
            if length > 0:
                out[i] += float(self.weight[x].sum()) / length ** 0.5
        return out


def fit_arrays(rows: list[np.ndarray], labels: np.ndarray, bits: int = BITS, epochs: int = 10, cost: float = 1.0,
               seed: int = 0) -> Model:
    """Log-count ratios and dual coordinate descent over the rows' indicators.

    With fewer than two classes the score is that of the classes' smoothed share.
    """
    dims = 1 << bits
    counts = np.ones((2, dims))
    for x, y in zip(rows, labels):
        counts[y, x] += 1
    n1 = int(labels.sum())
    if not 0 < n1 < len(labels):
        return Model(np.zeros(dims, np.float32), np.zeros(dims, np.float32), 0.5 * np.log((n1 + 1) / (len(labels) - n1 + 1)))
    ratio = np.log(counts[1] / counts[1].sum()) - np.log(counts[0] / counts[0].sum())
    values = []
    for x in rows:
        v = ratio[x]
        length = np.sqrt((v * v).sum())
        values.append(v / length if length else v)
    sign, dual = np.where(labels == 1, 1.0, -1.0), np.zeros(len(rows))
    w, bias, rng = np.zeros(dims), 0.0, np.random.default_rng(seed)
    norms = [1.0 + float((v * v).sum()) for v in values]  # the bias is a feature that is always 1
    for _ in range(epochs):
        for i in rng.permutation(len(rows)):
            x, v = rows[i], values[i]
            slope = sign[i] * (float((w[x] * v).sum()) + bias) - 1
            new = min(max(dual[i] - slope / norms[i], 0.0), cost)
            step = (new - dual[i]) * sign[i]
            if step:
                w[x] += step * v
                bias += step
                dual[i] = new
    return Model((w * ratio).astype(np.float32), (ratio * ratio).astype(np.float32), bias)


def held_out(doc_id: Column) -> Column:
    """Rows that are never learnt from: crc32 of the id as text mod 3 is 1, and rows without id."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(True))


def fit_quality(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS, bits: int = BITS) -> Model:
    """A model of ``labels.quality`` (0 or 1; other values and NULL are
    ignored) from the labelled documents that are not held out.

    Only ``text`` is an input.  Repeated labels (same id and quality) count
    once, an id with both qualities counts as both, and repeated documents
    count each time, so ``max_rows`` bounds the labels, not the rows, of a table
    that repeats ids.  Without any labelled document every score is 0.5.
    """
    usable = labels.filter(F.col("quality").isin(0, 1) & ~held_out(F.col("doc_id"))).select(
        F.col("doc_id").alias("label_id"), F.col("quality").cast("int").alias("quality")).distinct()
    n = usable.count()
    share = min(1.0, max_rows / n) if n else 0.0
    # a signed 64-bit hash, compared with the share of its range
    chosen = usable.filter(F.xxhash64("label_id").cast("double") <= (share * 2 - 1) * 2.0**63)
    sample = docs.select("doc_id", "text").join(F.broadcast(chosen), F.col("doc_id") == F.col("label_id"))

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            rows = [x.tobytes() for x in ngram_indicators(batch.column(1), bits)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(rows, pa.binary())],
                                             names=["doc_id", "quality", "x"])

    def fit(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["doc_id", "quality", "x"], ignore_index=True)
        model = fit_arrays([np.frombuffer(x, np.int32) for x in rows["x"]], rows["quality"].to_numpy(), bits)
        return pd.DataFrame({"weight": [model.weight.tobytes()], "square": [model.square.tobytes()], "bias": [model.bias]})

    made = (sample.select("doc_id", "text", "quality").mapInArrow(features, "doc_id long, quality int, x binary")
            .groupBy(F.lit(0).alias("all")).applyInPandas(fit, "weight binary, square binary, bias double").collect())
    if not made:
        return fit_arrays([], np.empty(0, np.int64), bits)
    return Model(np.frombuffer(made[0].weight, np.float32), np.frombuffer(made[0].square, np.float32), made[0].bias)


def score_quality(docs: DataFrame, model: Model, bits: int = BITS) -> DataFrame:
    """``docs`` plus ``score`` (0 to 1, the higher the likelier label 1) and
    ``predicted`` (1 if the score is 0.5 or more); input columns of these names
    are replaced.  NULL and empty texts get the score of the bias alone."""
    base = docs.drop("score", "predicted")
    at = base.columns.index("text")
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fitted = sent.value
        for batch in slices(batches):
            p = 1 / (1 + np.exp(-2 * np.clip(fitted.margins(batch.column(at), bits), -300, 300)))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(p), pa.array((p >= 0.5).astype(np.int32))],
                names=[*batch.schema.names, "score", "predicted"])

    schema = T.StructType([*base.schema.fields, T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())])
    return base.mapInArrow(score, schema)


def op10_quality_classifier(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    model = fit_quality(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    scored = score_quality(docs, model)
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")
