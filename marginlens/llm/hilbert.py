"""Approximate nearest neighbours along shifted Hilbert curves.

Vectors are projected to a few random directions, shifted and ordered along a
Hilbert curve, several times with other directions and shifts.  Spark
range-partitions the rows by (curve, key); counts per range turn places into
ranks, ranks into blocks of fixed size, and each query meets the blocks that
its window touches, in one task per (curve, block).  The nearest of all
windows are merged per query and reranked by their exact distances.

Blocks are cut by rank, so equal or crowded vectors never crowd a task.  The
window's width is fitted: for a bounded sample of rows the true neighbours are
found by brute force, and the width is the one at which the wanted share of
them lies within it on some curve.  On structured vectors it stays small; for
vectors without structure no ordering helps, and it grows with the table.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window as W

from marginlens.llm.scratch import cut

#: Curves, projected dimensions, bits of each.
CURVES, DIMS, BITS = 12, 8, 8
#: Rows that fit projections, rows whose true neighbours fit the window, share of these neighbours it shall hold.
FIT_ROWS, WINDOW_ROWS, RECALL = 4096, 192, 0.97
#: Ranks in a block.
BLOCK = 4096


def hilbert_keys(cells: np.ndarray, bits: int) -> np.ndarray:
    """Keys (rows of bytes, most significant first) of cells on the Hilbert
    curve through ``dims`` dimensions of ``2**bits`` cells, by the transposed
    form: undo excess work from the top bit down, then Gray-encode."""
    x = cells.T.astype(np.uint32)
    dims, one = len(x), np.uint32(1)
    for level in range(bits - 1, 0, -1):
        bit = one << np.uint32(level)
        below = bit - one
        for i in range(dims):
            set_ = (x[i] & bit) != 0
            swap = np.where(set_, np.uint32(0), (x[0] ^ x[i]) & below)
            x[0] ^= np.where(set_, below, swap)
            x[i] ^= swap
    for i in range(1, dims):
        x[i] ^= x[i - 1]
    flip = np.zeros_like(x[0])
    for level in range(bits - 1, 0, -1):
        bit = one << np.uint32(level)
        flip ^= np.where((x[-1] & bit) != 0, bit - one, np.uint32(0))
    x ^= flip
    planes = (x[:, :, None] >> np.arange(bits - 1, -1, -1, dtype=np.uint32)) & one
    return np.packbits(planes.transpose(1, 2, 0).reshape(len(cells), -1).astype(np.uint8), axis=1)


class Curves:
    """Projections, shifts and scale of all curves, from a bounded sample."""

    def __init__(self, sample: np.ndarray, curves: int = CURVES, dims: int = DIMS, bits: int = BITS, seed: int = 0):
        rng, size = np.random.default_rng(seed), sample.shape[1]
        self.bits, self.mean = bits, sample.mean(0) if len(sample) else np.zeros(size)
        self.parts = []
        for _ in range(curves):
            axes = np.linalg.qr(rng.normal(size=(size, size)))[0][:, :dims]
            shift = rng.uniform(0, 1, axes.shape[1])
            reach = np.abs((sample - self.mean) @ axes).max(initial=0) * 1.1 or 1.0
            self.parts.append((axes, shift, reach))

    def keys(self, vectors: np.ndarray) -> list[np.ndarray]:
        out = []
        for axes, shift, reach in self.parts:
            place = (np.clip((vectors - self.mean) @ axes / reach, -1, 1) + 1) / 2  # in 0 .. 1, then shifted by up to 1
            cells = np.minimum((place + shift) / 2 * (1 << self.bits), (1 << self.bits) - 1)
            out.append(hilbert_keys(cells.astype(np.uint32), self.bits))
        return out


def usable(vector: Column) -> Column:
    """Neither NULL nor zero, all components finite numbers."""
    return (vector.isNotNull() & F.exists(vector, lambda x: x != 0)
            & F.forall(vector, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False))))


def matrix(column: pa.Array) -> np.ndarray:
    """Rows of equal length as a matrix of doubles."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1)


def distances(query: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    gap = vectors - query
    return np.sqrt((gap * gap).sum(1))


def _nearest(vec_id: np.ndarray, score: np.ndarray, k: int) -> np.ndarray:
    """Places of the ``k`` smallest scores, ties to smaller ids."""
    if len(score) > 4 * k:
        near = np.flatnonzero(score <= np.partition(score, k - 1)[k - 1])
    else:
        near = np.arange(len(score))
    return near[np.lexsort((vec_id[near], score[near]))[:k]]


def best(found: DataFrame, k: int) -> DataFrame:
    """The ``k`` nearest per query of ``query_id, vec_id, score``, with ``rank`` from 1."""
    once = found.groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
    order = W.partitionBy("query_id").orderBy("score", "vec_id")
    return once.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def exact_neighbours(vectors: DataFrame, queries: list[tuple[int, list[float]]], k: int) -> DataFrame:
    """True neighbours of a bounded list of queries, by one pass over ``vec_id, embedding``."""
    ids, points = [q for q, _ in queries], np.array([v for _, v in queries], dtype=np.float64)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vec_id, rows = batch.column(0).to_numpy(), matrix(batch.column(1))
            out: list[list] = [[], [], []]
            for q, point in zip(ids, points):
                other = np.flatnonzero(vec_id != q)
                score = distances(point, rows[other])
                for i in _nearest(vec_id[other], score, k):
                    out[0].append(q)
                    out[1].append(int(vec_id[other[i]]))
                    out[2].append(float(score[i]))
            yield pa.RecordBatch.from_arrays([pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()), pa.array(out[2], pa.float64())],
                                             names=["query_id", "vec_id", "score"])

    return best(vectors.select("vec_id", "embedding").mapInArrow(scan, "query_id long, vec_id long, score double"), k)


def hashed_share(rows: int, n: int) -> Column:
    """About ``rows`` of ``n`` rows, by a hash of the id."""
    return F.xxhash64(F.col("vec_id"), F.lit(17)).cast("double") <= (min(1.0, rows / max(1, n)) * 2 - 1) * 2.0**63


def curve_ranks(vectors: DataFrame, curves: Curves) -> DataFrame:
    """``curve, rank, vec_id, embedding``: every vector's place on every curve."""

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [k.tobytes() for k in curves.keys(matrix(batch.column(1)))]
            width = curves.bits * curves.parts[0][0].shape[1]
            step = (width + 7) // 8
            n, count = len(batch), len(made)
            values = [made[c][i * step:(i + 1) * step] for i in range(n) for c in range(count)]
            lists = pa.ListArray.from_arrays(pa.array(np.arange(n + 1) * count, pa.int32()), pa.array(values, pa.binary()))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), lists], names=["vec_id", "embedding", "keys"])

    schema = T.StructType([*vectors.select("vec_id", "embedding").schema.fields, T.StructField("keys", T.ArrayType(T.BinaryType()))])
    keyed = vectors.select("vec_id", "embedding").mapInArrow(keys, schema).select("vec_id", "embedding", F.posexplode("keys").alias("curve", "key"))
    ordered = cut(keyed.repartitionByRange("curve", "key", "vec_id").sortWithinPartitions("curve", "key", "vec_id")
                  .select("curve", "vec_id", "embedding", F.monotonically_increasing_id().alias("place")))
    part = F.shiftright("place", 33)  # the id's upper bits are the partition
    ranges = ordered.groupBy("curve", part.alias("part")).agg(F.count(F.lit(1)).alias("n"), F.min("place").alias("low"))
    before = F.coalesce(F.sum("n").over(W.partitionBy("curve").orderBy("part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    starts = ranges.select("curve", "part", (before - F.col("low")).alias("offset"))
    return ordered.withColumn("part", part).join(F.broadcast(starts), ["curve", "part"]).select(
        "curve", (F.col("place") + F.col("offset")).alias("rank"), "vec_id", "embedding")


def fitted_window(ranked: DataFrame, truth: DataFrame, share: float) -> int:
    """Ranks to each side within which ``share`` of the true neighbours lie on some curve."""
    near = cut(truth.select("query_id", "vec_id"))
    ids = near.select(F.col("query_id").alias("id")).union(near.select(F.col("vec_id").alias("id"))).distinct()
    places = cut(ranked.select("curve", "rank", F.col("vec_id").alias("id")).join(F.broadcast(ids), "id", "left_semi"))
    gaps = (
        near.join(places.select(F.col("id").alias("query_id"), "curve", F.col("rank").alias("a")), "query_id")
        .join(places.select(F.col("id").alias("vec_id"), "curve", F.col("rank").alias("b")), ["vec_id", "curve"])
        .groupBy("query_id", "vec_id").agg(F.min(F.abs(F.col("a") - F.col("b"))).alias("gap"))
    )
    wide = gaps.agg(F.percentile("gap", F.lit(share)).alias("w")).first()["w"]
    return max(64, int(np.ceil(wide or 0)) + 1)


def windows(ranked: DataFrame, is_query: Column, width: int, k: int) -> DataFrame:
    """``query_id, vec_id, score``: the ``k`` nearest of each query per curve and block."""
    block = F.floor(F.col("rank") / BLOCK)
    rows = ranked.withColumn("block", block.cast("long"))
    touched = F.sequence(F.floor(F.greatest(F.col("rank") - width, F.lit(0)) / BLOCK).cast("long"),
                         F.floor((F.col("rank") + width) / BLOCK).cast("long"))
    asked = ranked.filter(is_query).select(
        F.col("curve").alias("q_curve"), F.col("rank").alias("place"), F.col("vec_id").alias("query_id"),
        F.col("embedding").alias("vector"), F.explode(touched).alias("q_block"))

    def search(held: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        out: list[tuple] = []
        if len(held) and len(queries):
            held = held.sort_values("rank", ignore_index=True)
            rank, ids = held["rank"].to_numpy(), held["vec_id"].to_numpy()
            points = np.stack(held["embedding"].to_numpy()).astype(np.float64)
            for place, query, vector in zip(queries["place"], queries["query_id"], queries["vector"]):
                lo, hi = np.searchsorted(rank, [place - width, place + width + 1])
                other = np.flatnonzero(ids[lo:hi] != query) + lo
                score = distances(np.asarray(vector, np.float64), points[other])
                out += [(query, int(ids[other[i]]), float(score[i])) for i in _nearest(ids[other], score, k)]
        return pd.DataFrame(out, columns=["query_id", "vec_id", "score"]).astype({"query_id": "int64", "vec_id": "int64", "score": "float64"})

    return rows.groupBy("curve", "block").cogroup(asked.groupBy("q_curve", "q_block")).applyInPandas(
        search, "query_id long, vec_id long, score double")


def nearest_neighbours(vectors: DataFrame, is_query: Column, k: int = 10, curves: int = CURVES, dims: int = DIMS,
                       recall: float = RECALL) -> DataFrame:
    """``query_id, rank, vec_id, score`` for the rows of ``vectors`` (``vec_id,
    embedding``) that ``is_query`` names, against all rows but the query's own.

    Scores are Euclidean distances of the original vectors in double
    precision; the ``k`` nearest found come nearest first, ties to the smaller
    id.  Rows without id, with a NULL or zero vector, or with a component that
    is NULL or not finite take no part, nor do vectors of another length than
    most.  Repeated ids are one row with several vectors: the nearest counts.
    Other columns are ignored; a table without usable rows gives none.
    """
    rows = vectors.select(F.col("vec_id").cast("long"), "embedding").filter(F.col("vec_id").isNotNull() & usable(F.col("embedding")))
    sizes = rows.groupBy(F.size("embedding").alias("size")).count().orderBy(F.desc("count"), "size").first()
    if sizes is None:
        return rows.select(F.col("vec_id").alias("query_id"), F.lit(0).alias("rank"), "vec_id", F.lit(0.0).alias("score")).limit(0)
    rows, n = rows.filter(F.size("embedding") == sizes["size"]), sizes["count"]
    sample = np.array([r[0] for r in rows.filter(hashed_share(FIT_ROWS, n)).select("embedding").collect()], np.float64)
    fit = Curves(sample.reshape(-1, sizes["size"]), curves, dims)
    ranked = curve_ranks(rows, fit)
    probes = rows.filter(hashed_share(WINDOW_ROWS, n)).collect()
    width = n if not probes else fitted_window(ranked, exact_neighbours(rows, [(r[0], r[1]) for r in probes], k), recall)
    return best(windows(ranked, is_query, width, k), k)


def op9_hilbert_neighbours(spark, sf_dir: str) -> DataFrame:
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    return nearest_neighbours(vectors, F.col("vec_id") % 100 == 0)
