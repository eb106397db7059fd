"""Lattice near-duplicates against all pairs."""

import itertools

import numpy as np
import pytest

from marginlens.llm import lattice

SCHEMA = "vec_id long, embedding array<double>, label int, cell string, w string, ball int"


def brute(rows, cosine=0.93):
    """(n_links, component_id, kept) of each row, in order."""
    def unit(v):
        if v is None or not len(v) or any(c is None or not np.isfinite(c) for c in v) or not any(v):
            return None
        u = np.array(v, np.float64)
        u = u / np.abs(u).max()
        return u / np.linalg.norm(u)

    units, up = [unit(v) for _, v, _ in rows], list(range(len(rows)))
    links = [0] * len(rows)

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for i, j in itertools.combinations(range(len(rows)), 2):
        a, b, same = units[i], units[j], rows[i][2] is not None and rows[i][2] == rows[j][2]
        if same and a is not None and b is not None and len(a) == len(b) and a @ b >= cosine:
            links[i] += 1
            links[j] += 1
            up[max(root(i), root(j))] = min(root(i), root(j))
    ids = {}
    for i, (vec_id, _, _) in enumerate(rows):
        ids.setdefault(root(i), []).append(vec_id)
    least = [min((v for v in ids[root(i)] if v is not None), default=None) for i in range(len(rows))]
    return sorted((str(r[0]), n, str(c), c is not None and c == r[0]) for r, n, c in zip(rows, links, least))


def found(spark, rows):
    frame = spark.createDataFrame([(i, v, label, "c", "w", 1) for i, v, label in rows], SCHEMA)
    return sorted((str(r.vec_id), r.n_links, str(r.component_id), r.kept) for r in lattice.near_duplicates(frame).collect())


def near(rng, u, cosine):
    w = rng.normal(size=len(u))
    w -= (w @ u) * u
    return cosine * u + np.sqrt(1 - cosine**2) * w / np.linalg.norm(w)


def unit(rng, size):
    u = rng.normal(size=size)
    return u / np.linalg.norm(u)


def test_decoding_finds_the_nearest_lattice_point():
    rng = np.random.default_rng(1)
    assert len(lattice.NEAR) == 240 and np.allclose((lattice.NEAR**2).sum(1), 2)
    x = rng.normal(size=(500, 8)) * 3
    point = lattice.nearest_e8(x)
    twice = np.rint(2 * point)
    assert np.allclose(2 * point, twice) and (point.sum(1) % 2 == 0).all()
    assert (np.isin(twice % 2, 0).all(1) | np.isin(twice % 2, 1).all(1)).all()
    gap = ((x - point) ** 2).sum(1)
    for v in lattice.NEAR:  # the neighbours bound the nearest point's region
        assert (((x - point - v) ** 2).sum(1) >= gap - 1e-9).all()


def test_pairs_at_the_threshold_meet():
    """Near 0.93 all but about 1e-4 of the pairs share a cell; their codes never part them."""
    rng = np.random.default_rng(4)
    a = np.stack([unit(rng, 64) for _ in range(4000)])
    b = np.stack([near(rng, u, 0.9301) for u in a])
    tables, labels = lattice.Tables(), np.zeros(4000, np.int64)
    x, y = tables.cells(a, labels), tables.cells(b, labels)
    met = ((x[:, :, :1] == y) | (x == y[:, :, :1])).any((1, 2))
    assert met.mean() >= 0.999
    ca, cb = tables.codes(a).astype(np.int16), tables.codes(b).astype(np.int16)
    assert lattice._close(labels, labels, ca, cb, lattice.Angles(0.93).codes).all()
    far = np.roll(b, 1, 0)
    z = tables.cells(far, labels)
    assert ((x[:, :, :1] == z) | (x == z[:, :, :1])).any((1, 2)).mean() < 0.05
    other = tables.cells(a, labels + 1)
    assert not (other == x).any()


def test_probed_cells_are_the_nearest():
    rng = np.random.default_rng(6)
    tables = lattice.Tables(tables=1, points=1, probes=5)
    u = np.stack([unit(rng, 16) for _ in range(50)])
    axes, shift, weights, _, salt = tables.of(16)[1][0]
    place = u @ axes + shift
    point = lattice.nearest_e8(place)
    for i, keys in enumerate(tables.cells(u, np.zeros(50, np.int64))[:, 0]):
        around = point[i] + np.concatenate([np.zeros((1, 8)), lattice.NEAR])
        order = np.argsort(((place[i] - around) ** 2).sum(1))[:6]
        want = [lattice.mixed(((2 * around[o]).astype(np.int64).view(np.uint64) * weights).sum(dtype=np.uint64)[None] + salt).view(np.int64)[0] for o in order]
        assert set(want) == set(keys.tolist())


@pytest.mark.parametrize("block, dense", [(1024, 64), (16, 8), (8, 10_000)])
def test_all_links_are_found(spark, monkeypatch, block, dense):
    """Pairs, chains, crowded groups and copies; small blocks take the paths of crowded cells."""
    monkeypatch.setattr(lattice, "BLOCK", block)
    monkeypatch.setattr(lattice, "DENSE", dense)
    rng = np.random.default_rng(8)
    rows = []

    def add(v, label):
        rows.append((len(rows) * 7 % 1009, list(map(float, v)), label))

    for i in range(60):
        u = unit(rng, 24)
        add(u, i % 3)
        add(near(rng, u, rng.choice([0.94, 0.97, 0.92, 0.999])) * rng.uniform(0.1, 9), i % 3)
    chain = unit(rng, 24)
    for _ in range(12):
        add(chain, 1)
        chain = near(rng, chain, 0.95)
    for spread in (0.99, 0.975, 0.96):  # groups whose members are farther and farther from each other
        u = unit(rng, 24)
        for _ in range(70):
            add(near(rng, u, spread), 2)
    u = unit(rng, 24)
    for _ in range(80):
        add(u, 0)
    for _ in range(5):
        add(u, 1)
    assert found(spark, rows) == brute(rows)


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, [1.0, 0.0, 0.0], 0), (2, [2.0, 0.0, 0.1], 0), (2, [2.0, 0.0, 0.1], 0), (3, [1.0, 0.0, 0.0], 1), (4, [1.0, 0.0, 0.0], None),
        (5, None, 0), (6, [0.0, 0.0, 0.0], 0), (7, [nan, 1.0, 0.0], 0), (8, [inf, 1.0, 0.0], 0), (9, [None, 1.0, 0.0], 0), (10, [], 0),
        (11, [1.0, 0.0], 0), (12, [5.0, 0.0], 0), (None, [0.0, 1.0, 0.0], 0), (None, [0.0, 1.0, 0.0], 0), (13, [0.0, 0.0, 1.0], 0),
        (None, [0.0, 0.0, 3.0], 0), (14, [1e300, 1e300, 0.0], 2), (15, [1e-300, 1e-300, 0.0], 2), (1, [0.0, 1.0, 0.0], 3), (16, [3.0], 0), (17, [-3.0], 0),
    ]
    assert found(spark, rows) == brute(rows)
    assert found(spark, rows[4:10]) == brute(rows[4:10])
    assert lattice.near_duplicates(spark.createDataFrame([], SCHEMA)).collect() == []


def test_the_table(spark):
    path = "/root/testdata/sf0.1"
    table = spark.read.parquet(f"{path}/embeddings.parquet").collect()
    rows = [(r.vec_id, r.embedding, r.label) for r in table]
    got = sorted((str(r.vec_id), r.n_links, str(r.component_id), r.kept) for r in lattice.op11_lattice_near_duplicates(spark, path).collect())
    assert got == brute(rows)
