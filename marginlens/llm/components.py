"""Connected components of an edge table, by alternating large and small stars.

Each round joins edges to the smallest neighbour of their ends; the rounds
end when the edges are stars around the smallest node of each component.
Edges are first contracted within each partition, and every round is written
as a checkpoint, so neither lineage nor memory grows with the rounds.  Once at
most ``ONE_TASK`` edges are left (they are counted), one task contracts them
to the same stars.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marginlens.llm.scratch import cut

#: Edges a task contracts at once.
STRETCH = 500_000
#: Edges that one task finishes: 16 bytes each, and a few hundred in its forest.
ONE_TASK = 200_000


class Forest:
    """Disjoint sets whose root is their smallest member."""

    def __init__(self):
        self.up: dict[int, int] = {}

    def root(self, x: int) -> int:
        up = self.up
        r = x
        while (n := up.get(r, r)) != r:
            r = n
        while x != r:
            up[x], x = r, up.get(x, r)
        return r

    def join(self, a: int, b: int) -> None:
        a, b = self.root(a), self.root(b)
        if a != b:
            self.up[max(a, b)] = min(a, b)

    def stars(self) -> list[tuple[int, int]]:
        return [(x, self.root(x)) for x in self.up]


def contract(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Stars that connect what the edges ``u, v`` of each stretch connect."""

    def stars(forest: Forest) -> pd.DataFrame:
        return pd.DataFrame([(u, v) for u, v in forest.stars() if u != v], columns=["u", "v"], dtype="int64")

    forest, seen = Forest(), 0
    for batch in batches:
        for u, v in zip(batch["u"].tolist(), batch["v"].tolist()):
            forest.join(u, v)
        seen += len(batch)
        if seen >= STRETCH:
            yield stars(forest)
            forest, seen = Forest(), 0
    yield stars(forest)


def components(edges: DataFrame) -> DataFrame:
    """``node, label`` for every node of ``edges`` (``u, v``: long, never
    NULL) that has another neighbour than itself; the label is the smallest
    node reachable.  Repeated edges, either direction and loops are fine."""
    def contracted(df: DataFrame) -> DataFrame:
        return cut(df.mapInPandas(contract, "u long, v long").distinct())

    stars = contracted(edges.filter("u != v").select("u", "v"))
    state = None
    while True:
        now = tuple(stars.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v")), F.bit_xor(F.hash("v", "u"))).first())
        if now == state or not now[0]:
            break
        if now[0] <= ONE_TASK:
            stars = contracted(stars.coalesce(1))
            break
        state = now
        both = stars.select("u", "v").union(stars.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least("u", F.min("v")).alias("m"))
        large = both.filter("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        moved = large.join(least, "u").filter("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        stars = cut(moved.union(least.select("u", F.col("m").alias("v"))).distinct())
    return stars.select(F.col("u").alias("node"), F.col("v").alias("label")).union(
        stars.select(F.col("v").alias("node"), F.col("v").alias("label")).distinct())
