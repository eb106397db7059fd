"""Line dedup against a brute-force version on odd rows."""

import random

from marginlens.llm.line_dedup import LOWER, UPPER, drop_repeated_lines

SCHEMA = "doc_id long, text string, n_lines string, h string, pos int, salt int"


def brute(rows, min_docs, min_chars):
    def key(line):
        return line.strip(" \t\n\x0b\f\r").translate(str.maketrans(UPPER, LOWER))

    counts = {}
    for _, t in rows:
        for k in {key(x) for x in (t or "").split("\n")}:
            counts[k] = counts.get(k, 0) + 1
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if len(key(x)) < min_chars or counts[key(x)] < min_docs]
        out.append((i, "\n".join(kept), len(lines), len(lines) - len(kept)))
    return sorted(out, key=repr)


def test_equals_brute_force(spark):
    rnd = random.Random(2)
    pool = ["", " ", "Foo bar", "foo BAR\r", "\tfoo bar ", "É", "é", "\xa0foo", "z", "中文", "tail "]
    rows = [(rnd.choice([None, rnd.randint(0, 30)]), rnd.choice([None, "", "\n".join(
        rnd.choice([*pool, f"own {rnd.randint(0, 99)}"]) for _ in range(rnd.randint(1, 9)))])) for _ in range(120)]
    rows += [(5, "same\nfoo bar")] * 4 + [(6, "\n".join(f"line {i % 50}" for i in range(20_000)))]
    for min_docs, min_chars in ((10, 1), (3, 1), (2, 4)):
        df = spark.createDataFrame([(*r, "clash", "c", 1, 2) for r in rows], SCHEMA)
        got = drop_repeated_lines(df, min_docs, min_chars)
        assert got.columns == ["doc_id", "text", "h", "pos", "salt", "n_lines", "n_dropped"]
        assert sorted(((r.doc_id, r.text, r.n_lines, r.n_dropped) for r in got.collect()), key=repr) == brute(rows, min_docs, min_chars)


def test_empty_table_and_no_python(spark):
    df = drop_repeated_lines(spark.createDataFrame([], SCHEMA))
    assert df.collect() == []
    assert "Python" not in df._jdf.queryExecution().toString()
