"""Quality classifier: held-out accuracy, odd rows, empty tables."""

import numpy as np

from marginlens.llm import quality

SCHEMA = "doc_id long, text string, score string, quality int, label_id long"


def test_held_out_accuracy_on_labels(spark):
    path = "/root/testdata/sf0.01"
    got = quality.op10_quality_classifier(spark, path).alias("g").join(spark.read.parquet(f"{path}/labels.parquet"), "doc_id")
    rows = [r for r in got.collect() if r.held_out]
    clean, junk = [r for r in rows if r.quality], [r for r in rows if not r.quality]
    assert len(clean) > 50 and np.mean([r.predicted for r in clean]) > 0.95
    pairs = [(a.score > b.score) + 0.5 * (a.score == b.score) for a in clean for b in junk]
    assert np.mean(pairs) > 0.9
    assert all(r.predicted == (r.score >= 0.5) and 0 <= r.score <= 1 for r in rows)


def test_odd_rows(spark):
    rows = [(i, f"fine words {i} here" if i % 2 else f"bad!! words!! {i} x x x x", "clash", 9, 8) for i in range(200)]
    rows += [(None, "fine", "c", 9, 8), (300, None, "c", 9, 8), (301, "", "c", 9, 8), (302, "bad!! " * 200_000, "c", 9, 8), (1, rows[1][1], "c", 9, 8)]
    docs = spark.createDataFrame(rows, SCHEMA)
    labels = spark.createDataFrame([(i, i % 2) for i in range(200)] + [(None, 1), (5, None), (7, 3)], "doc_id long, quality int")
    model = quality.fit_quality(docs, labels, max_rows=150)
    out = quality.score_quality(docs, model)
    assert out.columns == ["doc_id", "text", "quality", "label_id", "score", "predicted"]
    got = out.collect()
    assert len(got) == len(rows)
    assert all(r.predicted == r.doc_id % 2 for r in got if r.doc_id is not None and r.doc_id < 200)
    by = {r.doc_id: r.score for r in got}
    assert by[300] == by[301] and by[302] < 0.5
    assert quality.score_quality(docs.limit(0), model).collect() == []
    empty = quality.fit_quality(docs, labels.limit(0))
    assert {r.score for r in quality.score_quality(docs, empty).collect()} == {0.5}


def test_dual_coordinate_descent_meets_its_conditions():
    rng = np.random.default_rng(0)
    rows = [np.unique(rng.integers(0, 64, 6)).astype(np.int32) for _ in range(80)]
    labels = np.array([int((x < 32).mean() > 0.5) for x in rows])
    model = quality.fit_arrays(rows, labels, bits=6, epochs=400)
    margin = np.array([model.weight[x].sum() / np.sqrt(model.square[x].sum()) + model.bias for x in rows])
    assert np.mean((margin > 0) == (labels == 1)) > 0.95


def test_the_solver_reaches_the_optimum_of_another():
    """The hinge loss of the fitted model against the dual's optimum, found by a plain box-constrained solver."""
    rng = np.random.default_rng(1)
    rows = [np.unique(rng.integers(0, 32, 5)).astype(np.int32) for _ in range(60)]
    labels = np.array([int((x < 16).mean() + rng.normal() * 0.3 > 0.5) for x in rows])
    model = quality.fit_arrays(rows, labels, bits=5, epochs=600)
    ratio = np.sqrt(model.square.astype(np.float64))
    sign = np.where(labels == 1, 1.0, -1.0)
    signed = np.where(ratio > 0, model.weight / np.where(ratio > 0, ratio, 1), 0)  # the weights, up to the ratios' signs
    margins = np.array([model.weight[x].sum() / np.sqrt(model.square[x].sum()) + model.bias for x in rows])
    primal = 0.5 * ((signed**2).sum() + model.bias**2) + np.maximum(0, 1 - sign * margins).sum()
    counts = np.ones((2, 32))
    for x, y in zip(rows, labels):
        counts[y, x] += 1
    ratios = np.log(counts[1] / counts[1].sum()) - np.log(counts[0] / counts[0].sum())
    full = np.zeros((60, 33))
    for i, x in enumerate(rows):
        full[i, x] = ratios[x] / np.sqrt((ratios[x] ** 2).sum())
    full[:, 32] = 1
    q = (full @ full.T) * sign[:, None] * sign
    dual, step = np.zeros(60), 1 / np.linalg.eigvalsh(q).max()
    for _ in range(40_000):  # projected gradient
        dual = np.clip(dual + step * (1 - q @ dual), 0, 1)
    best = dual.sum() - 0.5 * dual @ q @ dual
    assert best <= primal + 1e-6 and primal - best <= 1e-3 * primal
