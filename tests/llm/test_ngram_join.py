"""N-gram Jaccard join and components against brute force."""

import random
import re

import pytest

from marginlens.llm import components as module
from marginlens.llm import ngram_join
from marginlens.llm.components import components
from pyspark.sql import functions as F

SCHEMA = "doc_id long, text string, n string, sig string, rid int, c int"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingles(text, size):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = WORD.findall(low)
    return {tuple(w[i:i + size]) for i in range(max(1, len(w) - size + 1))} if w else set()


def brute(rows, size, percent):
    sets = [shingles(t, size) for _, t in rows]
    up = list(range(len(rows)))

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= percent * len(sets[i] | sets[j]):
                up[root(i)] = root(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[root(i)] = min(least.get(root(i), d), d)
    return sorted(((d, len(s), least.get(root(i))) for i, ((d, _), s) in enumerate(zip(rows, sets))), key=repr)


def corpus(seed, n_bases, copies, vocabulary=400):
    rnd = random.Random(seed)
    words = [f"w{i}" for i in range(vocabulary)]
    rows = [(None, None), (1, ""), (2, " \n"), (3, "one"), (4, "One"), (5, "one two"), (6, "one two"), (6, "one two")]
    passage = [rnd.choice(words) for _ in range(60)]
    for b in range(n_bases):
        base = [rnd.choice(words) for _ in range(rnd.choice([3, 8, 30, 90, 300]))]
        if b % 3 == 0:
            base += passage
        for _ in range(rnd.choice(copies)):
            w = list(base)
            for _ in range(rnd.choice([0, 0, 1, 1, 2, 4])):
                w[rnd.randrange(len(w))] = rnd.choice(words).upper()
            rows.append((rnd.randint(10, 10**6), " ".join(w) + rnd.choice(["", "\n"])))
    rnd.shuffle(rows)
    return rows


@pytest.mark.parametrize("size,percent,block", [(3, 90, 2048), (5, 80, 2048), (2, 80, 7)])
def test_equals_brute_force(spark, monkeypatch, size, percent, block):
    monkeypatch.setattr(ngram_join, "BLOCK_DOCS", block)
    rows = corpus(size, 40, [1, 1, 2, 40])
    df = spark.createDataFrame([(*r, "n", "s", 1, 1) for r in rows], SCHEMA)
    got = ngram_join.jaccard_components(df, size, percent)
    assert got.columns == ["doc_id", "n_shingles", "component_id"]
    assert sorted((tuple(r) for r in got.collect()), key=repr) == brute(rows, size, percent)


def test_shuffle_path_of_the_second_scan(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "BROADCAST_ROWS", 0)
    rows = corpus(9, 10, [1, 3])
    df = spark.createDataFrame([(*r, "n", "s", 1, 1) for r in rows], SCHEMA)
    assert sorted((tuple(r) for r in ngram_join.jaccard_components(df, 3, 80).collect()), key=repr) == brute(rows, 3, 80)


def test_index_meets_in_a_key():
    """Any two sets over the threshold share an index key, whatever the frequencies."""
    rnd = random.Random(4)
    for trial in range(1500):
        percent = rnd.choice([80, 90])
        n = rnd.randint(1, 400)
        x = rnd.sample(range(1 << 40), n)
        drop = rnd.randint(0, max(1, n // 6))
        y = x[drop:] + rnd.sample(range(1 << 40, 1 << 41), rnd.randint(0, max(1, n // 8)))
        if not y or 100 * len(set(x) & set(y)) < percent * len(set(x) | set(y)):
            continue
        bound = rnd.choice([1 << 41, 1 << 38, 0])
        high = rnd.choice([3, 40])
        df = {t: rnd.randint(2, high) for t in set(x) & set(y)}
        keys = []
        for s in (x, y):
            counted = [t for t in s if t < bound]
            need = max(0, ngram_join.prefix_length(len(s), percent) + 1 - len(counted))
            keys.append(set(ngram_join.index_keys(
                len(s), len(counted), [(df[t], t) for t in counted if t in df], sorted(t for t in s if t >= bound)[:need], percent)))
        assert keys[0] & keys[1], trial


def test_one_shared_token_of_two_links_at_50_percent(spark):
    common, own = (40, 7), [(40, 100 + i) for i in range(20)]
    keys = [set(ngram_join.index_keys(len(s), len(s), [common], [], 50)) for s in ([common], [common, own[0]])]
    assert keys[0] & keys[1]
    rows = [(1, "a b"), *[(10 + i, f"a b w{i}") for i in range(30)], (90, "c d"), (91, "c d e f")]
    df = spark.createDataFrame([(*r, "n", "s", 1, 1) for r in rows], SCHEMA)
    got = ngram_join.jaccard_components(df, 2, 50).collect()
    assert sorted((tuple(r) for r in got), key=repr) == brute(rows, 2, 50)
    assert {r.component_id for r in got if r.doc_id < 90} == {1}


@pytest.mark.parametrize("one_task", [0, 200_000])
def test_empty_table_and_far_components(spark, monkeypatch, one_task):
    monkeypatch.setattr(module, "ONE_TASK", one_task)
    assert ngram_join.jaccard_components(spark.createDataFrame([], SCHEMA)).collect() == []
    chain = [(i + 1, i) for i in range(200)] + [(500, 900), (900, 501)]
    random.Random(0).shuffle(chain)
    got = dict(tuple(r) for r in components(spark.createDataFrame(chain, "u long, v long").repartition(20)).collect())
    assert got == {i: 0 for i in range(201)} | {500: 500, 501: 500, 900: 500}


def test_template_pages_leave_before_verification(spark):
    """Pages with a common template (Jaccard about 0.43) fill large buckets but have no link: none is verified."""
    rnd = random.Random(6)
    template = [f"t{i}" for i in range(180)]
    rows = [(i, " ".join(template + [f"{i}x{k}" for k in range(120)])) for i in range(400)]
    rows += [(1000 + i, " ".join(template + [f"near{k}" for k in range(119)] + [f"{i}y"])) for i in range(40)]  # near copies among them
    rnd.shuffle(rows)
    df = spark.createDataFrame([(*r, "n", "s", 1, 1) for r in rows], SCHEMA)
    docs = df.select("doc_id", "text")
    made = ngram_join.sketches(docs, 3, 90)
    classes = made.groupBy("sig").agg(F.min("rid").alias("cls"), F.min("doc_id").alias("least"))
    ids = {r.rid: r.doc_id for r in made.select("rid", "doc_id").collect()}
    stars = components(ngram_join.candidate_edges(made, classes, 90)).collect()
    assert len(stars) > 400  # by the counted share alone, all pages are one candidate group
    edges = ngram_join.candidate_edges(made, classes, 90, docs, 3).collect()
    assert edges and all(ids[e.u] >= 1000 and ids[e.v] >= 1000 for e in edges)
    got = ngram_join.jaccard_components(df, 3, 90).collect()
    assert {r.component_id for r in got if r.doc_id >= 1000} == {1000} and all(r.component_id == r.doc_id for r in got if r.doc_id < 1000)


def test_no_task_needs_two_python_workers(spark, monkeypatch):
    plans, cut = [], ngram_join.cut

    def seen(df):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return cut(df)

    monkeypatch.setattr(ngram_join, "cut", seen)
    monkeypatch.setattr("marginlens.llm.components.cut", seen)
    monkeypatch.setattr(ngram_join, "FREQUENT", 3)  # buckets of copies are large, so that their documents are joined once more
    docs = spark.createDataFrame([(i, " ".join(f"w{j}" for j in range(60)) + f" x{i}") for i in range(30)], "doc_id long, text string")
    found = ngram_join.jaccard_components(docs, size=3, percent=80)
    assert found.filter("component = 0").count() == 30
    nodes = [re.findall(r"MapInArrow|MapInPandas|Exchange", p) for p in plans]
    assert sum(map(len, nodes)) and not any(re.search(r"MapIn\w+ MapIn", " ".join(n)) for n in nodes)
