"""Nearest neighbours along Hilbert curves against brute force."""

import itertools

import numpy as np

from marginlens.llm import hilbert
from pyspark.sql import functions as F

SCHEMA = "vec_id long, embedding array<float>, curve string, rank string, place int, block int"


def brute(rows, is_query, k=10):
    good = [(i, np.asarray(v, np.float64)) for i, v in rows]
    out = {}
    for q, a in good:
        if is_query(q):
            d = sorted((float(np.sqrt(((b - a) ** 2).sum())), i) for i, b in good if i != q)
            out[q] = d[:k]
    return out


def test_curve_steps_to_neighbouring_cells():
    for dims, bits in ((2, 4), (3, 3), (4, 2)):
        cells = np.array(list(itertools.product(range(1 << bits), repeat=dims)))
        keys = [k.tobytes() for k in hilbert.hilbert_keys(cells, bits)]
        assert len(set(keys)) == len(cells)
        path = cells[np.argsort(np.array([int.from_bytes(k, "big") for k in keys]))]
        assert (np.abs(np.diff(path, axis=0)).sum(1) == 1).all()


def test_recall_on_the_table(spark):
    path = "/root/testdata/sf0.1"
    got = {}
    for r in hilbert.op9_hilbert_neighbours(spark, path).collect():
        got.setdefault(r.query_id, []).append((r.rank, r.score, r.vec_id))
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{path}/embeddings.parquet").collect()]
    true = brute(rows, lambda q: q % 100 == 0)
    assert set(got) == set(true)
    hits = 0
    vectors = {i: np.asarray(v, np.float64) for i, v in rows}
    for q, found in got.items():
        found.sort()
        assert [r for r, _, _ in found] == list(range(1, 11))
        assert [(s, v) for _, s, v in found] == sorted((s, v) for _, s, v in found)
        assert all(abs(s - np.sqrt(((vectors[v] - vectors[q]) ** 2).sum())) < 1e-12 for _, s, v in found)
        hits += len({v for _, _, v in found} & {v for _, v in true[q]})
    assert hits / sum(map(len, true.values())) >= 0.9


def test_odd_rows_and_small_tables(spark, monkeypatch):
    monkeypatch.setattr(hilbert, "BLOCK", 32)
    nan, inf = float("nan"), float("inf")
    good = [(i, [float(i % 3), 1.0, float(i // 40)]) for i in range(120)]  # many ties
    bad = [(200, None), (300, [0.0, 0.0, 0.0]), (400, [nan, 1.0, 1.0]), (500, [1.0, inf, 0.0]), (600, [1.0, None, 0.0]), (700, [1.0, 2.0]), (None, [1.0, 1.0, 1.0]), (800, [])]
    df = spark.createDataFrame([(i, v, "c", "r", 1, 2) for i, v in good + bad + good[:3]], SCHEMA)
    got = {}
    for r in hilbert.nearest_neighbours(df, F.col("vec_id") % 10 == 0, k=5).collect():
        got.setdefault(r.query_id, []).append((r.rank, r.score, r.vec_id))
    true = brute(good, lambda q: q % 10 == 0, 5)
    assert {q: [(s, v) for _, s, v in sorted(f)] for q, f in got.items()} == true
    few = spark.createDataFrame([(i, v, "c", "r", 1, 2) for i, v in good[:4]], SCHEMA)
    assert len(hilbert.nearest_neighbours(few, F.lit(True)).collect()) == 12
    for none in (few.limit(0), spark.createDataFrame([(i, v, "c", "r", 1, 2) for i, v in bad[:5]], SCHEMA)):
        assert hilbert.nearest_neighbours(none, F.lit(True)).collect() == []
