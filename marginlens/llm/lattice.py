"""Embedding near-duplicates by lattice hashing.

Unit vectors are projected to a few dimensions, eight at a time, and each
eight are decoded to the nearest point of the E8 lattice; the points of a table
are its cell.  Several tables with other projections and shifts are used, and
each vector also looks into the neighbouring cells nearest to it, so two close
vectors meet in some table with a probability of all but 1e-4 at a cosine of
0.93 in 64 dimensions (higher above it).  Vectors that meet are compared by a
short code whose distance bounds theirs from below, and what remains by their
cosine in double precision.

Crowded cells never emit their pairs.  Equal vectors are one class with a
weight.  Where many classes share a cell, those within half of the linking
angle of a pivot form a ball: by the triangle inequality all of them link with
each other, so their links are counted, not compared, and a ball takes part as
one token per cell.  Links of a ball's members with others are counted by
products of blocks of bounded size.  What is left of a cell beyond ``BLOCK``
tokens is compared in pairs of blocks.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marginlens.llm.components import components
from marginlens.llm.hilbert import usable
from marginlens.llm.scratch import cut
from marginlens.llm.textkeys import mixed
from marginlens.operators.joins import salted_join

#: Tables, lattice points of a cell, neighbouring cells looked into, and the lattice's scale
#: (the share of a unit vector that a projection keeps on average is 1).
TABLES, POINTS, PROBES, SCALE = 8, 2, 6, 0.6
#: Tables in which balls are looked for, and classes of a cell from which on it offers a pivot.
BALL_TABLES, DENSE = 2, 64
#: Tokens or vectors compared at once.
BLOCK = 1024
#: Tasks over which the rows of one join key are spread.
SALTS = 16
#: Copies of a vector from which on its rows are spread.
HOT = 10_000
TOKEN = "cell long, own boolean, ent long, code binary"
#: Dimensions and steps of the code.
CODE_DIMS, CODE_STEPS = 16, 127


def minimal_vectors() -> np.ndarray:
    """The 240 shortest vectors of the E8 lattice."""
    out = []
    for i, j in itertools.combinations(range(8), 2):
        for a, b in itertools.product((1.0, -1.0), repeat=2):
            v = [0.0] * 8
            v[i], v[j] = a, b
            out.append(v)
    out += [list(v) for v in itertools.product((0.5, -0.5), repeat=8) if sum(x < 0 for x in v) % 2 == 0]
    return np.array(out)


NEAR = minimal_vectors()


def nearest_even(x: np.ndarray) -> np.ndarray:
    """Nearest points with whole entries of an even sum."""
    whole = np.rint(x)
    gap = x - whole
    worst, rows = np.abs(gap).argmax(1), np.arange(len(x))
    step = np.where(gap[rows, worst] >= 0, 1.0, -1.0)
    whole[rows, worst] += np.where(whole.sum(1) % 2 != 0, step, 0.0)
    return whole


def nearest_e8(x: np.ndarray) -> np.ndarray:
    """Nearest points of the E8 lattice: of its even half and the half shifted by 1/2."""
    even, half = nearest_even(x), nearest_even(x - 0.5) + 0.5
    closer = ((x - even) ** 2).sum(1) <= ((x - half) ** 2).sum(1)
    return np.where(closer[:, None], even, half)


class Tables:
    """Projections and cells, for vectors of any length (each has its own)."""

    def __init__(self, tables: int = TABLES, points: int = POINTS, probes: int = PROBES, scale: float = SCALE, seed: int = 0):
        self.tables, self.points, self.probes, self.scale, self.seed = tables, points, probes, scale, seed
        self.made: dict[int, tuple] = {}

    def of(self, size: int) -> tuple:
        if size not in self.made:
            rng, wide, dims = np.random.default_rng([self.seed, size]), max(size, 8 * self.points, CODE_DIMS), 8 * self.points
            code = np.linalg.qr(rng.normal(size=(wide, CODE_DIMS)))[0][:size]
            parts = []
            for _ in range(self.tables):
                axes = np.linalg.qr(rng.normal(size=(wide, dims)))[0][:size] / (self.scale * np.sqrt(dims / wide))
                weights = rng.integers(0, 1 << 63, dims, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
                twice = (2 * NEAR).astype(np.int64).view(np.uint64)
                steps = [(twice * weights[8 * b:8 * b + 8]).sum(1, dtype=np.uint64) for b in range(self.points)]
                parts.append((axes, rng.uniform(0, 2, dims), weights, steps, rng.integers(0, 1 << 63, dtype=np.uint64)))
            self.made[size] = (code, parts)
        return self.made[size]

    def codes(self, units: np.ndarray) -> np.ndarray:
        return np.rint(units @ self.of(units.shape[1])[0] * CODE_STEPS).astype(np.int8)

    def cells(self, units: np.ndarray, labels: np.ndarray, tables: int | None = None, probes: int | None = None) -> np.ndarray:
        """Keys of each vector's own cell and its nearest neighbours, table by table: (rows, tables, 1 + probes)."""
        probes, n = self.probes if probes is None else probes, len(units)
        out = []
        for axes, shift, weights, steps, salt in self.of(units.shape[1])[1][:tables]:
            place = units @ axes + shift
            flat = place.reshape(n * self.points, 8)
            point = nearest_e8(flat)
            twice = (2 * point).astype(np.int64).view(np.uint64).reshape(n, -1)
            base = (twice * weights).sum(1, dtype=np.uint64) + salt + labels.astype(np.int64).view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
            cost, keys = np.zeros((n, 1)), base[:, None]
            if probes:
                far = 2 - 2 * ((flat - point) @ NEAR.T)  # how much farther a neighbouring point is, squared
                near = np.argpartition(far, probes, 1)[:, :probes]
                more = np.concatenate([np.zeros((len(far), 1)), np.take_along_axis(far, near, 1)], 1).reshape(n, self.points, -1)
                near = near.reshape(n, self.points, -1)
                for b in range(self.points):
                    add = np.concatenate([np.zeros((n, 1), np.uint64), steps[b][near[:, b]]], 1)
                    cost = (cost[:, :, None] + more[:, b][:, None, :]).reshape(n, -1)
                    keys = (keys[:, :, None] + add[:, None, :]).reshape(n, -1)
                    best = np.argsort(cost, 1, kind="stable")[:, :probes + 1]
                    cost, keys = np.take_along_axis(cost, best, 1), np.take_along_axis(keys, best, 1)
            out.append(keys)
        return mixed(np.stack(out, 1)).view(np.int64)


def chord(cosine: float) -> float:
    return float(np.sqrt(max(0.0, 2 - 2 * cosine)))


class Angles:
    """Bounds that follow from the linking cosine."""

    def __init__(self, cosine: float):
        angle = float(np.arccos(cosine))
        self.link = cosine
        self.ball = float(np.cos(angle / 2)) + 1e-9  # members of a ball, so any two of them link
        # By the number of balls in a pair: cosine and code distance that no linked pair misses.
        self.least = [cosine, float(np.cos(min(np.pi, 1.5 * angle))) - 1e-9, float(np.cos(min(np.pi, 2 * angle))) - 1e-9]
        spare = np.sqrt(CODE_DIMS) + 0.01  # half a step for each code and dimension
        self.codes = np.array([(CODE_STEPS * chord(c) + spare) ** 2 for c in self.least])


def unit_rows(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places and unit vectors of the rows, length by length."""
    sizes = pc.list_value_length(column).to_numpy(zero_copy_only=False)
    for size in np.unique(sizes):
        at = np.flatnonzero(sizes == size)
        rows = column.take(pa.array(at)).flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(at), -1)
        rows = rows / np.abs(rows).max(1)[:, None]
        yield at, rows / np.sqrt((rows * rows).sum(1))[:, None]


def spread(rows: DataFrame, few: DataFrame, key: str, by: str) -> DataFrame:
    """Inner join on ``key``; the rows of each key are spread over ``SALTS`` tasks by ``by``."""
    left = rows.withColumn("salt", F.pmod(F.xxhash64(by), F.lit(SALTS)))
    right = few.withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))))
    return left.join(right, [key, "salt"]).drop("salt")


def vector_classes(rows: DataFrame) -> DataFrame:
    """Equal vectors of equal labels as one class: ``cid, key, label, embedding, w, first_id``."""
    return cut(rows.groupBy("key").agg(
        F.first("label").alias("label"), F.first("embedding").alias("embedding"), F.count(F.lit(1)).alias("w"),
        F.min("vec_id").alias("first_id")).withColumn("cid", F.monotonically_increasing_id()))


def _cells(frame: DataFrame, keep: list[str], tables: Tables, count: int, probes: int) -> DataFrame:
    """``cell`` and the ``keep`` columns: a row for each of the first ``count`` tables and cells of each vector."""
    fields = [f for f in frame.schema.fields if f.name in keep]
    schema = "cell long, " + ", ".join(f"{c} {next(f for f in fields if f.name == c).dataType.simpleString()}" for c in keep)

    def expand(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, units in unit_rows(batch.column("embedding")):
                labels = batch.column("label").take(pa.array(at)).to_numpy(zero_copy_only=False)
                cells = tables.cells(units, labels, count, probes).reshape(len(at), -1)
                again = pa.array(np.repeat(at, cells.shape[1]))
                yield pa.RecordBatch.from_arrays([pa.array(cells.ravel()), *[batch.column(c).take(again) for c in keep]], names=["cell", *keep])

    return frame.select(*dict.fromkeys([*keep, "label", "embedding"])).mapInArrow(expand, schema)


def find_balls(classes: DataFrame, tables: Tables, angles: Angles) -> DataFrame | None:
    """``cid, ball, ball_code``: classes within half of the linking angle of a
    pivot (a class, named by its cid), or None if no cell is crowded."""
    own = _cells(classes, ["cid"], tables, BALL_TABLES, 0)
    crowded = own.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), F.min("cid").alias("cid")).filter(F.col("n") > DENSE)
    pivots = cut(classes.select("cid", "label", "embedding").join(crowded.select("cid").distinct(), "cid"))
    if pivots.isEmpty():
        return None
    offered = _cells(pivots.withColumnRenamed("cid", "ball").withColumn("pivot", F.col("embedding")), ["ball", "pivot"], tables, BALL_TABLES, tables.probes)
    met = spread(_cells(classes, ["cid", "embedding"], tables, BALL_TABLES, 0), offered, "cell", "cid")

    def inside(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, _, code = near_pairs(batch.column("embedding"), batch.column("pivot"), angles.ball, tables)
            rows = pa.array(at)
            yield pa.RecordBatch.from_arrays([batch.column("cid").take(rows), batch.column("ball").take(rows), pa.array(code, pa.binary())],
                                             names=["cid", "ball", "ball_code"])

    found = met.select("cid", "ball", "embedding", "pivot").mapInArrow(inside, "cid long, ball long, ball_code binary")
    return cut(found.groupBy("cid").agg(F.min(F.struct("ball", "ball_code")).alias("b")).select("cid", "b.ball", "b.ball_code"))


def near_pairs(left: pa.Array, right: pa.Array, least: float | np.ndarray, tables: Tables | None = None) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
    """Places of rows whose two vectors have a cosine of at least ``least``, the cosines, and the second ones' codes."""
    n = len(left)
    score, codes = np.full(n, -2.0), [b""] * n
    sizes = [pc.list_value_length(c).to_numpy(zero_copy_only=False) for c in (left, right)]
    same = np.flatnonzero(sizes[0] == sizes[1])
    taken = pa.array(same)
    for (at, a), (_, b) in zip(unit_rows(left.take(taken)), unit_rows(right.take(taken))):
        score[same[at]] = (a * b).sum(1)
        if tables is not None:
            for i, code in zip(same[at], tables.codes(b)):
                codes[i] = code.tobytes()
    near = np.flatnonzero(score >= least)
    return near, score[near], [codes[i] for i in near]


def cell_tokens(classes: DataFrame, tables: Tables) -> DataFrame:
    """``cell, own, ent, code``: each class, or ball, once in each cell that it
    lies in (``own``) or looks into.  A ball's ``ent`` is -1 - its number."""

    def expand(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, units in unit_rows(batch.column("embedding")):
                rows = pa.array(at)
                cells = tables.cells(units, batch.column("label").take(rows).to_numpy(zero_copy_only=False))
                each = cells.shape[1] * cells.shape[2]
                balls = batch.column("ball").take(rows)
                is_ball = balls.is_valid().to_numpy(zero_copy_only=False)
                ent = np.where(is_ball, -1 - balls.fill_null(0).to_numpy(zero_copy_only=False), batch.column("cid").take(rows).to_numpy(zero_copy_only=False))
                given = batch.column("ball_code").take(rows).to_pylist()
                code = pa.array([g if g is not None else c.tobytes() for g, c in zip(given, tables.codes(units))], pa.binary())
                own = np.zeros(cells.shape, bool)
                own[:, :, 0] = True
                yield pa.RecordBatch.from_arrays(
                    [pa.array(cells.ravel()), pa.array(own.ravel()), pa.array(np.repeat(ent, each)), code.take(pa.array(np.repeat(np.arange(len(at)), each)))],
                    names=["cell", "own", "ent", "code"])

    return classes.select("cid", "label", "embedding", "ball", "ball_code").mapInArrow(expand, TOKEN)


def _codes(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.int8).reshape(len(column), CODE_DIMS).astype(np.int16)


def _close(ent_a, ent_b, code_a, code_b, limits) -> np.ndarray:
    """Whether two tokens may link, by their codes."""
    gap = (code_a - code_b).astype(np.int32)
    return (gap * gap).sum(1) <= limits[(ent_a < 0).astype(int) + (ent_b < 0)]


def pair_tokens(tokens: DataFrame, angles: Angles) -> DataFrame:
    """``a, b`` (a < b), distinct: tokens that share a cell that one of them lies in, and may link.

    Cells stream by, sorted; those of more than ``BLOCK`` tokens are handed on in
    blocks, which then meet in pairs, each pair in a task of its own.
    """
    limits = angles.codes
    schema = "a long, b long, part int, " + TOKEN

    def batch_of(table: pa.Table, pairs: list[np.ndarray], parts: np.ndarray | None) -> pa.RecordBatch:
        k = len(pairs[0])
        m = 0 if parts is None else table.num_rows
        made = [pa.concat_arrays([pa.array(p, pa.int64()), pa.nulls(m, pa.int64())]) for p in pairs]
        made.append(pa.concat_arrays([pa.nulls(k, pa.int32()), pa.array([] if parts is None else parts, pa.int32())]))
        for name, kind in (("cell", pa.int64()), ("own", pa.bool_()), ("ent", pa.int64()), ("code", pa.binary())):
            rest = pa.nulls(0, kind) if parts is None else table[name].combine_chunks()
            made.append(pa.concat_arrays([pa.nulls(k, kind), rest]))
        return pa.RecordBatch.from_arrays(made, names=["a", "b", "part", "cell", "own", "ent", "code"])

    def within(table: pa.Table) -> list[np.ndarray]:
        cell, own, ent = (table[c].to_numpy() for c in ("cell", "own", "ent"))
        code = _codes(table["code"].combine_chunks())
        ends = np.searchsorted(cell, cell, "right")
        at, found, k = np.arange(len(cell)), [], 0
        while True:
            k += 1
            at = at[at + k < ends[at]]
            if not len(at):
                break
            i, j = at, at + k
            good = (own[i] | own[j]) & (ent[i] != ent[j])
            i, j = i[good], j[good]
            good = _close(ent[i], ent[j], code[i], code[j], limits)
            found.append((ent[i[good]], ent[j[good]]))
        if not found:
            return [np.empty(0, np.int64)] * 2
        a, b = (np.concatenate(x) for x in zip(*found))
        both = np.unique(np.stack([np.minimum(a, b), np.maximum(a, b)], 1), axis=0)
        return [both[:, 0], both[:, 1]]

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None  # a cell that may go on
        large, passed = None, 0  # a cell whose tokens are handed on, and how many were
        none = [np.empty(0, np.int64)] * 2
        for batch in batches:
            for lo in range(0, batch.num_rows, 4 * BLOCK):
                table = pa.Table.from_batches([batch.slice(lo, 4 * BLOCK)])
                if large is not None:
                    k = int((table["cell"].to_numpy() == large).sum())
                    if k:
                        yield batch_of(table.slice(0, k), none, (passed + np.arange(k)) // BLOCK)
                        passed += k
                    table = table.slice(k)
                    if not table.num_rows:
                        continue
                    large = None
                if held is not None:
                    table = pa.concat_tables([held, table])
                cell = table["cell"].to_numpy()
                last = int(np.searchsorted(cell, cell[-1]))
                if last:
                    yield from split(table.slice(0, last))
                held = table.slice(last)
                if held.num_rows > BLOCK:
                    large, passed = int(cell[-1]), held.num_rows
                    yield batch_of(held, none, np.arange(passed) // BLOCK)
                    held = None
        if held is not None:
            yield from split(held)

    def split(table: pa.Table) -> Iterator[pa.RecordBatch]:
        """Pairs of whole cells; the tokens of large ones in blocks."""
        cell = table["cell"].to_numpy()
        starts = np.flatnonzero(np.append(True, cell[1:] != cell[:-1]))
        counts = np.diff(np.append(starts, len(cell)))
        place = np.arange(len(cell)) - np.repeat(starts, counts)
        size = np.repeat(counts, counts)
        some = table.take(pa.array(np.flatnonzero((size > 1) & (size <= BLOCK))))
        big = np.flatnonzero(size > BLOCK)
        pairs = within(some) if some.num_rows else [np.empty(0, np.int64)] * 2
        yield batch_of(table.take(pa.array(big)), pairs, (place[big] // BLOCK).astype(np.int32))

    met = cut(tokens.repartition("cell").sortWithinPartitions("cell").mapInArrow(meet, schema))
    pairs = met.filter("a IS NOT NULL").select("a", "b")
    rest = met.filter("cell IS NOT NULL").select("part", "cell", "own", "ent", "code")
    if not rest.isEmpty():
        blocks = cut(rest.groupBy("cell").agg((F.max("part") + 1).alias("parts")))
        with_parts = spread(rest, blocks, "cell", "ent")
        other = F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("other")
        sides = with_parts.select("*", other).select(
            "cell", F.least("part", "other").alias("i"), F.greatest("part", "other").alias("j"), "part", "own", "ent", "code")

        def between(frame: pd.DataFrame) -> pd.DataFrame:
            out = []
            i, j = int(frame["i"].iat[0]), int(frame["j"].iat[0])
            left, right = (frame[frame["part"] == p] for p in (i, j))
            sides = []
            for side in (left, right):
                codes = np.frombuffer(b"".join(side["code"]), np.int8).reshape(len(side), CODE_DIMS).astype(np.int16)
                sides.append((side["own"].to_numpy(), side["ent"].to_numpy(), codes))
            (own_b, ent_b, code_b) = sides[1]
            for own, ent, code in zip(*sides[0]):
                good = (own_b | own) & (ent_b != ent)
                if i == j:
                    good &= ent_b > ent
                at = np.flatnonzero(good)
                at = at[_close(np.full(len(at), ent), ent_b[at], code[None, :], code_b[at], limits)]
                out.append(np.stack([np.minimum(ent, ent_b[at]), np.maximum(ent, ent_b[at])], 1))
            return pd.DataFrame(np.concatenate(out) if out else np.empty((0, 2), np.int64), columns=["a", "b"])

        pairs = pairs.unionByName(sides.groupBy("cell", "i", "j").applyInPandas(between, "a long, b long"))
    return pairs.distinct()


def verified(pairs: DataFrame, vectors: DataFrame, angles: Angles) -> DataFrame:
    """``a, b, wa, wb`` of pairs whose vectors (pivots, for balls) are near enough and whose labels are equal."""
    sides = [vectors.select(F.col("ent").alias(x), F.col("label").alias(f"l{x}"), F.col("embedding").alias(f"v{x}"), F.col("w").alias(f"w{x}")) for x in "ab"]
    both = pairs.join(sides[0], "a").join(sides[1], "b").filter("la = lb").select("a", "b", "wa", "wb", "va", "vb")
    least = np.array(angles.least)

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = batch.column("a").to_numpy(), batch.column("b").to_numpy()
            near, _, _ = near_pairs(batch.column("va"), batch.column("vb"), least[(a < 0).astype(int) + (b < 0)])
            yield batch.select(["a", "b", "wa", "wb"]).take(pa.array(near))

    return cut(both.mapInArrow(check, "a long, b long, wa long, wb long"))


def ball_links(classes: DataFrame, near: DataFrame, angles: Angles) -> DataFrame:
    """``cid, n, other``: each class's links found between a ball's members and
    the classes that ask them (of another ball or none), block by block, with one linked class."""
    members = classes.filter("ball IS NOT NULL").select("ball", "cid", "embedding", "w")
    single = near.filter("a < 0 AND b >= 0").select((-1 - F.col("a")).alias("ball"), F.col("b").alias("cid"))
    two = near.filter("b < 0").select((-1 - F.col("a")).alias("ball"), (-1 - F.col("b")).alias("asked"))
    from_balls = spread(members.select("ball", "cid"), two, "ball", "cid").select(F.col("asked").alias("ball"), "cid")
    asks = cut(single.unionByName(from_balls).distinct())
    sizes = members.groupBy("ball").agg(F.count(F.lit(1)).alias("n")).join(asks.groupBy("ball").agg(F.count(F.lit(1)).alias("m")), "ball")
    parts = cut(sizes.select("ball", F.ceil(F.col("n") / BLOCK).cast("int").alias("rows"), F.ceil(F.col("m") / BLOCK).cast("int").alias("cols")))
    mine = spread(members, parts, "ball", "cid")
    theirs = spread(asks, parts, "ball", "cid")

    def placed(frame: DataFrame, own: str, other: str) -> DataFrame:
        """The row's own block, by a hash of its class, beside every block of the other side."""
        block = F.pmod(F.xxhash64("cid"), F.col(own)).cast("int").alias(own[0])
        return frame.select("*", block, F.explode(F.sequence(F.lit(0), F.col(other) - 1)).alias(other[0]))

    left = placed(mine, "rows", "cols").select("ball", "r", "c", "cid", "embedding", "w")
    right = placed(theirs, "cols", "rows").join(classes.select("cid", "embedding", "w"), "cid").select("ball", "r", "c", "cid", "embedding", "w")

    def units(frame: pd.DataFrame, size: int) -> tuple[np.ndarray, pd.DataFrame]:
        frame = frame[frame["embedding"].map(len) == size]
        if not len(frame):
            return np.empty((0, size)), frame
        rows = np.stack(frame["embedding"].to_numpy()).astype(np.float64)
        rows = rows / np.abs(rows).max(1)[:, None]
        return rows / np.sqrt((rows * rows).sum(1))[:, None], frame

    def product(held: pd.DataFrame, asking: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(held) and len(asking):
            (a, held), (b, asking) = units(held, len(held["embedding"].iat[0])), units(asking, len(held["embedding"].iat[0]))
            linked = a @ b.T >= angles.link
            for links, mine, others in ((linked, held, asking), (linked.T, asking, held)):
                counts = links @ others["w"].to_numpy()
                at = np.flatnonzero(counts)
                first = links[at].argmax(1)
                out.append(pd.DataFrame({"cid": mine["cid"].to_numpy()[at], "n": counts[at], "other": others["cid"].to_numpy()[first]}))
        return pd.concat(out) if out else pd.DataFrame({"cid": [], "n": [], "other": []}, dtype="int64")

    return cut(left.groupBy("ball", "r", "c").cogroup(right.groupBy("ball", "r", "c")).applyInPandas(product, "cid long, n long, other long"))


def class_links(classes: DataFrame, cosine: float, tables: Tables) -> tuple[DataFrame, DataFrame]:
    """``cid, n`` (links to other classes, weighted; repeated cids add up) and the ``edges`` (u, v) that connect them."""
    angles = Angles(cosine)
    balls = find_balls(classes, tables, angles)
    if balls is None:
        classes = classes.withColumn("ball", F.lit(None).cast("long")).withColumn("ball_code", F.lit(None).cast("binary"))
        tokens, vectors = cell_tokens(classes, tables), classes.select(F.col("cid").alias("ent"), "label", "embedding", "w")
    else:
        classes = cut(classes.join(balls, "cid", "left"))
        once = cell_tokens(classes.filter("ball IS NOT NULL"), tables).groupBy("cell", "ent", "code").agg(F.max("own").alias("own"))
        tokens = cell_tokens(classes.filter("ball IS NULL"), tables).unionByName(once)
        pivots = classes.join(balls.select(F.col("ball").alias("cid")).distinct(), "cid").select((-1 - F.col("cid")).alias("ent"), "label", "embedding", "w")
        vectors = classes.filter("ball IS NULL").select(F.col("cid").alias("ent"), "label", "embedding", "w").unionByName(pivots)
    near = verified(pair_tokens(tokens, angles), vectors, angles)
    links = near.filter("a >= 0")  # a < b, so neither is a ball
    counts = links.select(F.col("a").alias("cid"), F.col("wb").alias("n")).unionByName(links.select(F.col("b").alias("cid"), F.col("wa").alias("n")))
    edges = links.select(F.col("a").alias("u"), F.col("b").alias("v"))
    if balls is not None:
        weight = classes.filter("ball IS NOT NULL").groupBy("ball").agg(F.sum("w").alias("total"))
        inside = spread(classes.filter("ball IS NOT NULL").select("cid", "ball", "w"), weight, "ball", "cid")
        across = ball_links(classes, near, angles)
        counts = counts.unionByName(inside.select("cid", (F.col("total") - F.col("w")).alias("n"))).unionByName(across.select("cid", "n"))
        edges = edges.unionByName(inside.select(F.col("cid").alias("u"), F.col("ball").alias("v"))).unionByName(
            across.select(F.col("cid").alias("u"), F.col("other").alias("v")))
    return counts, edges


def near_duplicates(vectors: DataFrame, cosine: float = 0.93, tables: Tables | None = None) -> DataFrame:
    """``vec_id, n_links, component_id, kept``, one row per row of ``vectors``
    (``vec_id, embedding, label``).

    Rows link if their labels are equal and their cosine, in double precision,
    is at least ``cosine``.  ``n_links`` counts the other rows linked directly,
    ``component_id`` is the smallest id reachable, ``kept`` says that the row has
    it.  Rows with a NULL label, a NULL, empty or zero vector, or a component
    that is NULL or not finite link with nothing; vectors of different lengths
    don't link.  Repeated rows are rows of their own, linked with each other; all
    rows of the smallest id are kept.  A NULL id is never the smallest: a
    component of such rows alone has a NULL id and keeps none, and ``kept`` is
    false for them.  Other columns are ignored; an empty table gives none.
    """
    tables = tables or Tables()
    label = F.col("label")
    key = F.concat(*[F.lower(F.hex(F.xxhash64(F.lit(i), label, F.size("embedding"), F.col("embedding")))) for i in range(2)])
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding", "label")
    good = F.coalesce(usable(F.col("embedding")) & label.isNotNull(), F.lit(False))
    linked = rows.filter(good).withColumn("key", key)
    classes = vector_classes(linked.withColumn("label", F.xxhash64("label")))
    counts, edges = class_links(classes, cosine, tables)
    links = counts.groupBy("cid").agg(F.sum("n").alias("n"))
    stars = components(edges)
    named = cut(classes.select("cid", "key", "w", "first_id").join(stars.withColumnRenamed("node", "cid"), "cid", "left")
                .withColumn("comp", F.coalesce("label", "cid")).drop("label").join(links, "cid", "left")
                .select("cid", "key", "w", "first_id", "comp", (F.coalesce("n", F.lit(0)) + F.col("w") - 1).cast("long").alias("n_links")))
    least = named.groupBy("comp").agg(F.min("first_id").alias("component_id"))
    result = spread(named, least, "comp", "cid").select("key", "n_links", "component_id")
    hot = cut(named.filter(F.col("w") >= HOT).select("key", F.lit(True).alias("__hot")))
    out = salted_join(linked.select("vec_id", "key"), result, "key", HOT, SALTS, hot=hot).select("vec_id", "n_links", "component_id")
    alone = rows.filter(~good).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return out.unionByName(alone).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))


def op11_lattice_near_duplicates(spark, sf_dir: str) -> DataFrame:
    return near_duplicates(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
