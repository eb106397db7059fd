"""The eigensolver against numpy's, and whitening against brute force."""

import numpy as np
import pytest

from marginlens.llm import whitening as W

SCHEMA = "vec_id long, embedding array<double>, component string, n int"


def matrices():
    rng = np.random.default_rng(2)
    for size in (1, 2, 3, 5, 20, 64):
        b = rng.normal(size=(size, size + 3)) * rng.uniform(0.1, 9, size)[:, None]
        yield b @ b.T
        yield np.eye(size) * 3.0  # one eigenvalue, size times
        yield np.zeros((size, size))
        yield np.diag(np.arange(size, dtype=float))  # nothing off the diagonal
    q = np.linalg.qr(rng.normal(size=(40, 40)))[0]
    yield q @ np.diag([5.0] * 4 + [5 - 1e-13, 5 - 1e-9] + list(rng.uniform(0, 1, 34))) @ q.T  # clusters
    yield (q[:, :2] * [1e150, 1e140]) @ q[:, :2].T
    yield (q[:, :3] * [1e-150, 1e-151, 1e-152]) @ q[:, :3].T
    blocks = np.zeros((30, 30))
    for i in range(10):
        b = np.array([[2.0, 1, 0], [1, 3, 1], [0, 1, 4]])
        blocks[3 * i:3 * i + 3, 3 * i:3 * i + 3] = b  # ten equal blocks: each eigenvalue ten times
    yield blocks


@pytest.mark.parametrize("case", range(28))
def test_leading_components(case):
    matrix = list(matrices())[case]
    matrix = (matrix + matrix.T) / 2
    values, vectors = W.leading_components(matrix, 6)
    want = np.sort(np.linalg.eigvalsh(matrix))[::-1][:6]
    norm = np.abs(want).max() or 1.0
    assert np.abs(values - want).max() <= 1e-13 * norm
    assert np.abs(matrix @ vectors - vectors * values).max() <= 2e-13 * norm
    assert np.abs(vectors.T @ vectors - np.eye(len(values))).max() <= 1e-12


def check(got, rows, k=4):
    """Compare result rows with brute force over whole numbers."""
    x = {}
    for i, (_, v) in enumerate(rows):
        x[i] = [int(np.floor(256 * c)) for c in v]
    fit = np.array(sorted(set(map(tuple, x.values()))), dtype=np.int64)
    n, sums = len(fit), fit.sum(0)
    centred = fit - sums / n
    cov = centred.T @ centred / n
    e = np.linalg.eigvalsh(cov)[::-1]
    count = min(k, int((e > np.trace(cov) * 1e-13).sum()))
    assert len(got) == len(rows) * count
    by_id = {}
    for r in got:
        by_id.setdefault(r.vec_id, {}).setdefault(r.component, r)
    white = np.array([[by_id[rows[i][0]][c + 1].whitened for c in range(count)] for i in x])
    for i, (vec_id, _) in enumerate(rows):
        deviation = sum((n * v - int(s)) ** 2 for v, s in zip(x[i], sums))
        for c in range(count):
            r = by_id[vec_id][c + 1]
            assert r.n == n and r.deviation == deviation
            assert abs(r.explained - e[c] / np.trace(cov)) <= 1e-9 * r.explained
            assert r.identity_error <= 1e-9
    # Whitened values come from unit eigenvectors: solve for them and check the residual.
    xs = np.array([x[i] for i in x]) - sums / n
    directions = np.linalg.lstsq(xs, white * np.sqrt(e[:count]), rcond=None)[0]
    assert np.abs(xs @ directions - white * np.sqrt(e[:count])).max() < 1e-6
    if np.linalg.matrix_rank(xs) == xs.shape[1]:
        assert np.abs((directions ** 2).sum(0) - 1).max() < 1e-9
        assert np.abs(cov @ directions - directions * e[:count]).max() < 1e-9 * e[0]


def test_the_table(spark):
    path = "/root/testdata/sf0.01"
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{path}/embeddings.parquet").collect()]
    check(W.op12_whitening(spark, path).collect(), rows)


def test_odd_rows(spark):
    rng = np.random.default_rng(0)
    good = [(i, rng.normal(size=5).tolist()) for i in range(60)]
    good += [(100 + i, good[0][1]) for i in range(30)]  # a third are copies
    nan, inf = float("nan"), float("inf")
    bad = [(200, None), (201, [nan] * 5), (202, [1.0, inf, 0.0, 0.0, 0.0]), (203, [1.0, None, 0.0, 0.0, 0.0]), (204, []), (205, [1.0, 2.0])]
    zero = [(300, [0.0, -0.0, 0.0, 0.0, 0.0])]
    frame = spark.createDataFrame([(i, v, "c", 3) for i, v in good + bad + zero], SCHEMA)
    check(W.whiten(frame).collect(), good + zero)
    same = spark.createDataFrame([(i, [1.0, 2.0], "c", 3) for i in range(5)], SCHEMA)
    assert W.whiten(same).collect() == []
    line = [(i, [float(i), 2.0 * i, 0.0]) for i in range(9)]  # rank one
    check(W.whiten(spark.createDataFrame([(i, v, "c", 3) for i, v in line], SCHEMA)).collect(), line)
    assert W.whiten(frame.limit(0)).collect() == []
    assert W.whiten(spark.createDataFrame([(i, v, "c", 3) for i, v in bad[:5]], SCHEMA)).collect() == []
    twice = spark.createDataFrame([(None, [1.0, 0.0], "c", 3), (None, [0.0, 1.0], "c", 3), (1, [1.0, 0.0], "c", 3), (1, [4.0, 2.0], "c", 3)], SCHEMA)
    assert sorted(str(r.vec_id) for r in W.whiten(twice).collect()) == ["1"] * 4 + ["None"] * 4


def test_large_entries_stay_exact(spark):
    rows = [(0, [1e300, 1.0]), (1, [-1e300, 2.0]), (2, [5.0, 3.0])]
    got = W.whiten(spark.createDataFrame([(i, v, "c", 3) for i, v in rows], SCHEMA)).collect()
    assert {r.vec_id for r in got} == {0, 1, 2} and all(r.deviation is None for r in got if r.vec_id < 2)
    near = [(0, [1e6, 1.0]), (1, [-1e6, 2.0]), (2, [5.0, 3.0])]
    check(W.whiten(spark.createDataFrame([(i, v, "c", 3) for i, v in near], SCHEMA)).collect(), near)
    x = np.array([[1 << 40, -(1 << 40)]])
    assert W.deviations(x, 10**6, [7, 9]) == [None]
    assert W.deviations(np.array([[3, 4]]), 10, [1, 2]) == [29**2 + 38**2]
