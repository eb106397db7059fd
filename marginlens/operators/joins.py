"""Equi-joins of a fact table to a dimension with unique keys that split hot keys.

:func:`split_join`, the default of the denormalised orders, needs no number
from its caller: the write of the cleaned orders fills a mergeable top-k sketch
that names the hot keys (:func:`written_with_hot_keys`).

:func:`salted_join` takes a threshold instead, and any number of hot keys.

A key that holds a large share of the fact rows (a customer with a third
of all orders) puts all of them into one task of a shuffle join.  Here the
hot keys are found first, from a count per key that Spark combines map-side
(a hot key costs one row per map task).  They are written once as a
checkpoint and counted.  Only their fact rows are then spread over
``buckets`` salt values, by a hash of the whole row, so the result is
deterministic.  Only their dimension rows are copied once per salt value,
and the join runs on (key, salt).  Every other row keeps salt 0, so the
join moves nothing extra for them.

The hot-key list has at most ``fact rows / min_rows`` entries.  Within
``broadcast_keys`` (it is counted) it is broadcast; beyond, the fact rows look
their key up by (key, salt), with the list copied once per salt, so no step
ever sends all rows of a key to one task.
"""

from __future__ import annotations

from math import ceil, log2

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from marginlens.operators.cleaning import quote
from marginlens.plans.session import ensure_checkpoint_dir, metrics, written

SALT, HOT = "__salt", "__hot"
BROADCAST_KEYS = 100_000

#: A key is hot from this share of the fact's rows (1 / HOT_IDS) and from this many rows on.
HOT_IDS, HOT_ROWS = 1024, 1000
#: Keys that a sketch tracks: its error, 3.5 / TRACKED of the rows, stays below half of a hot share.
TRACKED = 8192


def _c(name: str) -> Column:
    return F.col(f"`{name}`")


def hot_keys(fact: DataFrame, key: str, min_rows: int) -> DataFrame:
    """Keys with at least ``min_rows`` fact rows, as ``(key, __hot)``."""
    return (
        fact.where(_c(key).isNotNull())
        .groupBy(_c(key))
        .agg(F.count(F.lit(1)).alias("__rows"))
        .where(F.col("__rows") >= min_rows)
        .select(_c(key), F.lit(True).alias(HOT))
    )


def salted_join(
    fact: DataFrame,
    dim: DataFrame,
    key: str,
    min_rows: int,
    buckets: int = 32,
    broadcast_keys: int = BROADCAST_KEYS,
    hot: DataFrame | None = None,
) -> DataFrame:
    """Inner join of ``fact`` and ``dim`` (unique ``key``) on ``key``; same rows as ``fact.join(dim, key)``.

    ``hot`` is the checkpointed list of :func:`hot_keys`, if the caller has it
    (of the same fact or of one with more rows); else it is written here.
    ``fact`` should be cheap to read twice, as a checkpoint is.
    """
    if hot is None:
        ensure_checkpoint_dir(fact.sparkSession)
        hot = hot_keys(fact, key, min_rows).checkpoint(eager=True)
    row_salt = F.pmod(F.xxhash64(*[_c(c) for c in fact.columns]), F.lit(buckets)).cast("int")
    fact_cols = [_c(c) for c in fact.columns]
    every_salt = F.explode(F.sequence(F.lit(0), F.lit(buckets - 1)))
    if hot.count() <= broadcast_keys:
        tagged = fact.withColumn(SALT, row_salt).join(F.broadcast(hot), key, "left")
        dim_tags = F.broadcast(hot)
    else:
        tagged = fact.withColumn(SALT, row_salt).join(hot.withColumn(SALT, every_salt), [key, SALT], "left")
        dim_tags = hot
    is_hot = F.coalesce(F.col(HOT), F.lit(False))
    salted_fact = tagged.select(*fact_cols, F.when(is_hot, F.col(SALT)).otherwise(F.lit(0)).alias(SALT))
    copies = F.when(is_hot, F.sequence(F.lit(0), F.lit(buckets - 1))).otherwise(F.array(F.lit(0)))
    salted_dim = dim.join(dim_tags, key, "left").select(*[_c(c) for c in dim.columns], F.explode(copies).alias(SALT))
    return salted_fact.join(salted_dim, [key, SALT], "inner").drop(SALT)


def written_with_hot_keys(fact: DataFrame, keys: list[str]) -> tuple[DataFrame, dict[str, dict[int, list]]]:
    """``fact`` as a checkpoint, and the hot values of each key by the number of parts to cut them into.

    The write's own tasks fill a frequent-item sketch per key
    (``DataFrame.observe``), so the hot keys cost no further pass.  A key is
    hot from a share of 1 / ``HOT_IDS`` of the rows on, so there are at most
    that many, and is cut into enough parts, a power of two, for each to hold
    about that share.
    """
    seen = Observation()
    sketches = [F.expr(f"approx_top_k({quote(k)}, {HOT_IDS}, {TRACKED})").alias(k) for k in keys]
    table = written(fact.observe(seen, F.count(F.lit(1)).alias("n"), *sketches))
    found = metrics(seen) or {"n": 0, **dict.fromkeys(keys)}
    hot: dict[str, dict[int, list]] = {}
    for k in keys:
        parts: dict[int, list] = {}
        for item in found[k] or []:
            share = item["count"] * HOT_IDS / found["n"]
            if item["item"] is not None and share >= 1 and item["count"] >= HOT_ROWS:
                parts.setdefault(1 << max(1, ceil(log2(share))), []).append(item["item"])
        hot[k] = parts
    return table, hot


def parts_of(key: str, parts: dict[int, list]) -> Column:
    """Into how many parts a row's key is cut (1: not hot)."""
    out = F.lit(1)
    for n, values in sorted(parts.items()):
        out = F.when(_c(key).isin(values), F.lit(n)).otherwise(out)
    return out


def split_join(fact: DataFrame, dim: DataFrame, key: str, parts: dict[int, list]) -> DataFrame:
    """Inner join of ``fact`` and ``dim`` (unique ``key``) on ``key``; same rows as ``fact.join(dim, key)``.

    ``parts`` names the hot keys (:func:`written_with_hot_keys`).  Their fact
    rows are dealt over the parts by a hash of the row, their dimension rows are
    copied once per part; both sides read the same list, so any list gives the
    same rows.  Without hot keys it is a plain join.
    """
    if not parts:
        return fact.join(dim, key, "inner")
    n = parts_of(key, parts)
    dealt = F.when(n > 1, F.pmod(F.xxhash64(*[_c(c) for c in fact.columns]), n).cast("int")).otherwise(F.lit(0))
    copies = dim.select(*[_c(c) for c in dim.columns], F.explode(F.sequence(F.lit(0), n - 1)).alias(SALT))
    return fact.withColumn(SALT, dealt).join(copies, [key, SALT], "inner").drop(SALT)
