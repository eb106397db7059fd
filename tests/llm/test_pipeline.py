"""The corpus pipeline, stage by stage, against brute-force versions."""

import collections
import math
import subprocess
import sys

import duckdb
import public_tokenizers
import pytest
from test_line_dedup import brute as drop_lines
from test_mixing import draws
from test_ngram_join import brute as components
from tokenizers import Tokenizer

import corpus_pipeline
from marginlens.llm import catalog, packing

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """The rows before the first stage and after each one."""
    docs, out = spark.read.parquet(f"{SF}/documents.parquet"), []
    out.append(docs.collect())
    for name, stage in corpus_pipeline.STAGES:
        path = str(tmp_path_factory.mktemp(name) / "out")
        stage(spark, docs, SF).write.parquet(path)
        docs = spark.read.parquet(path)
        out.append(docs.collect())
        if name != "packing":
            assert docs.columns == corpus_pipeline.COLUMNS
    return out


def test_junk_goes_and_clean_documents_stay(spark, stages):
    before, after = stages[0], stages[1]
    kept = {r.doc_id: r for r in after}
    assert all(tuple(kept[r.doc_id]) == tuple(r) for r in before if r.doc_id in kept) and len(kept) == len(after)
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    clean = [d for d, q in labels.items() if q]
    junk = [d for d, q in labels.items() if not q]
    assert sum(d in kept for d in clean) >= 0.98 * len(clean) and sum(d in kept for d in junk) <= 0.3 * len(junk)


def test_repeated_lines_go(stages):
    before, after = stages[1], stages[2]
    want = {i: text for i, text, *_ in drop_lines([(r.doc_id, r.text) for r in before], 10, 1)}
    assert {r.doc_id: r.text for r in after} == want
    assert all(r.n_chars == len(r.text) for r in after)


def test_one_of_each_group_of_near_copies_stays(stages):
    before, after = stages[2], stages[3]
    want = {d for d, _, c in components([(r.doc_id, r.text) for r in before], 5, 80) if c == d}
    assert {r.doc_id for r in after} == want and len(after) == len(want) < len(before)


def test_one_row_of_each_group_stays_with_null_and_repeated_ids(spark):
    def text(name, edit=""):
        return " ".join(f"{name}{i}" for i in range(60)) + edit

    rows = [(1, text("a"), "en", "s", 1), (5, text("a", " more"), "en", "s", 1), (5, text("b"), "en", "s", 1),  # one copy, one clean text
            (None, text("c"), "en", "s", 1), (None, text("c", " more"), "en", "s", 1), (None, text("c"), "en", "s", 1),  # no id in the group
            (None, text("d"), "en", "s", 1), (7, text("d", " more"), "en", "s", 1),
            (8, text("e"), "fr", "s", 1), (8, text("e"), "en", "s", 1), (8, text("e"), "en", "s", 1),  # repeated rows
            (None, text("f"), "en", "s", 1), (9, "", "en", "s", 0), (9, "", "en", "s", 0), (None, None, "en", "s", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(4)
    got = [tuple(r) for r in corpus_pipeline.drop_near_copies(spark, docs, SF).collect()]
    of_c = [r for r in got if r[1] and r[1].startswith("c0 ")]
    assert len(of_c) == 1 and of_c[0] in rows
    want = [rows[0], rows[2], rows[7], rows[9], rows[11], rows[12], rows[13], rows[14]]
    assert sorted((r for r in got if r not in of_c), key=repr) == sorted(want, key=repr)


def test_copies_follow_the_rates(stages):
    before, after = stages[3], stages[4]
    n = collections.Counter(r.source for r in before)
    weight = sum(math.sqrt(v) for v in n.values())
    rate = {s: math.sqrt(v) / weight * len(before) / v for s, v in n.items()}
    want = collections.Counter({tuple(r): draws("mix", r.source, r.doc_id, rate[r.source]) for r in before})
    assert collections.Counter(tuple(r) for r in after) == +want


def test_sequences_hold_every_token(stages):
    before, after = stages[4], stages[5]
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = collections.Counter()
    for r in before:
        ids = len(tokenizer.encode(r.text or "", add_special_tokens=False).ids) + 1
        want.update((r.doc_id, k, start, length) for k, (start, length) in enumerate(packing.cut_points(ids, 1024)))
    assert collections.Counter((r.doc_id, r.piece, r.start, r.length) for r in after) == want
    ends = collections.defaultdict(list)
    for r in after:
        ends[r.sequence_id].append((r.offset, r.length))
    for spans in ends.values():
        assert [o for o, _ in sorted(spans)] == [sum(n for _, n in sorted(spans)[:i]) for i in range(len(spans))]
        assert sum(n for _, n in spans) <= 1024
    assert len(ends) <= 1.1 * sum(r.length for r in after) / 1024 + 1


def test_run_applies_all_stages(spark, stages):
    got = corpus_pipeline.run(spark, SF)
    key = ["doc_id", "piece", "start", "length", "ids_crc32"]
    assert sorted(map(tuple, got.select(key).collect())) == sorted(tuple(r[k] for k in key) for r in stages[5])


@pytest.mark.parametrize("name", sorted(catalog.SQL))
def test_queries_equal_their_sql(spark, name):
    con = duckdb.connect()
    for table in ("documents", "conversations"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{SF}/{table}.parquet')")
    rel = con.sql(catalog.SQL[name])
    columns = sorted(rel.columns)
    df = catalog.QUERIES[name](spark, SF)
    assert sorted(df.columns) == columns
    order = [rel.columns.index(c) for c in columns]
    assert sorted((tuple(r) for r in df.select(columns).collect()), key=repr) == sorted(
        (tuple(r[i] for i in order) for r in rel.fetchall()), key=repr)


def test_entry_works_without_the_subpackage(tmp_path):
    code = ("import sys\n"
            "class Gone:\n"
            "    def find_spec(self, name, path=None, target=None):\n"
            "        if name == 'corpus_pipeline' or name.startswith('marginlens.llm'):\n"
            "            raise ModuleNotFoundError(name)\n"
            "sys.meta_path.insert(0, Gone())\n"
            "import __spark_entry__ as e\n"
            "assert 'a1_profit_summary' in e.queries() and not any(n.startswith('op') for n in e.queries())\n"
            "assert set(e.oracle_sql()) <= set(e.queries())\n")
    subprocess.run([sys.executable, "-c", code], check=True, cwd=corpus_pipeline.__file__.rpartition("/")[0])


def test_empty_tables(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    docs.limit(0).write.parquet(f"{tmp_path}/documents.parquet")
    spark.read.parquet(f"{SF}/labels.parquet").limit(0).write.parquet(f"{tmp_path}/labels.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []


@pytest.mark.parametrize("stage", range(5))
def test_stages_take_odd_rows(spark, stage):
    """NULLs in all columns, empty texts and repeated rows: what each stage's docstring says."""
    name, function = corpus_pipeline.STAGES[stage]
    odd = [(None, None, None, None, None), (1, "", "en", "a", 0), (1, "", "en", "a", 0), (2, None, None, None, None), (3, "Some words, here.", "en", "a", 17)]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    rows = function(spark, spark.createDataFrame(odd, schema), SF).collect()
    if name == "line_dedup":
        assert sorted((str(r.doc_id), r.text, r.n_chars) for r in rows) == [("1", "", 0)] * 2 + [("2", "", 0), ("3", odd[4][1], 17), ("None", "", 0)]
    elif name == "near_copies":
        assert len(rows) == 5  # nothing but row 3 has words
    elif name == "packing":
        assert sorted(str(r.doc_id) for r in rows) == ["1", "1", "2", "3", "None"]
    elif name == "mixing":
        ones = [r for r in rows if r.doc_id == 1]
        assert len(ones) % 2 == 0 and {tuple(r) for r in rows} <= set(odd)
    else:
        assert {tuple(r) for r in rows} <= set(odd) and len([r for r in rows if r.doc_id == 1]) in (0, 2)
    none = function(spark, spark.createDataFrame([], schema), SF)
    assert none.collect() == [] and (name == "packing" or none.columns == corpus_pipeline.COLUMNS)
