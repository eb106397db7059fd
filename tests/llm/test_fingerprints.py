"""Consistent weighted sampling: collision rates, edited texts, odd rows."""

import hashlib
import random
import re
from collections import Counter

from marginlens.llm import fingerprints as fp
from pyspark.sql import functions as F

SCHEMA = "doc_id long, text string, h string, w string, part int, samples int"


def terms(text, size=5):
    w = [x for x in re.split(r"[\x20\x09-\x0D]+", text) if x]
    return Counter(tuple(w[i:i + size]) for i in range(max(1, len(w) - size + 1))) if w else Counter()


def generalised(a, b):
    a, b = terms(a), terms(b)
    top = sum((a | b).values())
    return sum((a & b).values()) / top if top else 1.0


def frame(spark, rows):
    return spark.createDataFrame([(*r, "h", "w", 1, 2) for r in rows], SCHEMA)


def test_collisions_estimate_generalised_jaccard(spark):
    rnd = random.Random(1)
    words = [f"w{i}" for i in range(30)]
    pairs = []
    for i in range(120):
        a = [rnd.choice(words[: rnd.choice([2, 30])]) for _ in range(rnd.choice([8, 60, 200]))]
        a += a[:20] * rnd.randint(0, 4)
        cut = rnd.randint(0, len(a))
        pairs.append((i, " ".join(a), " ".join(a[:cut] + [rnd.choice(words) for _ in range(len(a) - cut)] + a[:10])))
    df = spark.createDataFrame(pairs, "i long, a string, b string")
    made = [fp.fingerprint(df.select("i", F.col(c).alias("text")), ["i"], samples=256).withColumnRenamed("samples", c) for c in "ab"]
    got = {r.i: r.near for r in made[0].join(made[1], "i").select("i", fp.likeness("a", "b").alias("near")).collect()}
    errors = [got[i] - generalised(a, b) for i, a, b in pairs]
    assert abs(sum(errors)) / len(errors) < 0.01
    assert max(map(abs, errors)) < 0.14  # over four standard deviations


def test_edited_texts(spark):
    rnd = random.Random(2)
    rows = [(i * 3, " ".join(rnd.choice(["ab", "é", "中文", "x\n"]) for _ in range(rnd.randint(0, 40)))) for i in range(150)]
    rows += [(7, None), (8, ""), (10**15, "a b c d e f " * 20_000), (None, "first of all " * 30), (None, "first of all " * 30)]
    rows.sort(key=lambda r: (r[0] is not None, r[0] or 0))
    rnd.shuffle(shuffled := list(rows))
    got = {r.doc_id: r for r in fp.edited_fingerprints(frame(spark, shuffled)).collect()}
    distinct = list(dict.fromkeys(rows))
    assert len(got) == len(distinct)
    prints, samples = {}, 64
    for k, (doc_id, text) in enumerate(distinct):
        text, after = text or "", distinct[(k + 1) % len(distinct)][1] or ""
        q = len(text) // 4
        edited = text[:len(text) - q] + after[:q]
        r = got[doc_id]
        assert r.n_chars == len(text) and r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert len(r.fingerprint) == len(r.edited_fingerprint) == 8 * samples
        for t, f in ((text, r.fingerprint), (edited, r.edited_fingerprint)):
            assert prints.setdefault(tuple(sorted(terms(t).items())), f) == f
        same = sum(r.fingerprint[8 * i:8 * i + 8] == r.edited_fingerprint[8 * i:8 * i + 8] for i in range(samples))
        assert r.near_edited == same / samples and abs(r.near_edited - generalised(text, edited)) < 0.3
        assert abs(r.near_next - generalised(text, after)) < 0.3


def test_one_row_repeated_ids_and_empty_table(spark):
    one = fp.edited_fingerprints(frame(spark, [(1, "abcdefgh")])).collect()
    assert one[0].edited_sha256 == hashlib.sha256(b"abcdefab").hexdigest() and one[0].near_next == 1
    two = fp.edited_fingerprints(frame(spark, [(1, "a b"), (1, "c d e f g h"), (2, "x y")])).collect()
    assert sorted(r.doc_id for r in two) == [1, 1, 2]
    df = fp.edited_fingerprints(frame(spark, []))
    assert df.collect() == []


def test_no_python_in_the_plan(spark):
    df = fp.fingerprint(frame(spark, [(1, "a")]).select("doc_id", "text"), ["doc_id"])
    assert "Python" not in df._jdf.queryExecution().toString()


def test_equal_texts_have_equal_fingerprints_within_any_reach(spark, monkeypatch):
    """A low reach leaves many samples open at first; a text's partner must not show in its fingerprint."""
    rnd = random.Random(5)
    texts = [" ".join(rnd.choice(["ab", "cd", "ef", "gh", "ij"]) + str(rnd.randint(0, 30)) for _ in range(rnd.randint(12, 60))) for _ in range(40)]
    rows = []
    for i, text in enumerate(texts):  # each text once before a text of one long word, once before another text
        rows += [(4 * i, text), (4 * i + 1, "x" * 400), (4 * i + 2, text), (4 * i + 3, texts[(i * 7 + 3) % 40])]
    made = {}
    for reach in (16, 2, 0.5):
        monkeypatch.setattr(fp, "REACH", reach)
        got = {r.doc_id: r for r in fp.edited_fingerprints(frame(spark, rows)).collect()}
        for i in range(40):
            assert got[4 * i].fingerprint == got[4 * i + 2].fingerprint
        made[reach] = {i: (r.fingerprint, r.edited_fingerprint) for i, r in got.items()}
        one = fp.fingerprint(frame(spark, rows).select("doc_id", "text"), ["doc_id"]).select("doc_id", fp.as_text("samples").alias("f"))
        assert {r.doc_id: r.f for r in one.collect()} == {i: f[0] for i, f in made[reach].items()}
    assert made[16] == made[2] == made[0.5]


def test_repeated_rows_stay(spark):
    rows = [(1, "a b c d e f g h"), (1, "a b c d e f g h"), (2, "x"), (None, None), (None, None)]
    got = sorted(str(r.doc_id) for r in fp.edited_fingerprints(frame(spark, rows)).collect())
    assert got == ["1", "1", "2", "None", "None"]
