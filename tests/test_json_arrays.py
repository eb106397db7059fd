"""JSON arrays read in byte ranges, against Spark's whole-file reader."""

import json
import random

import pytest

from marginlens.sources.arrays import TASKS_PER_CORE, read_json_arrays
from test_skew import conf

SCHEMA = "id long, text string, inner struct<a: array<long>, b: string>, x double"
ODD = ['plain', 'quote " in', 'brace } in', '}{][', '\\', '\\"}', 'end\\\\', '', 'é中\n}', '"', '{"id": 1}']


def rows(rng, n):
    return [{"id": i, "text": rng.choice(ODD) * rng.randint(1, 3), "inner": {"a": [1, 2, i], "b": rng.choice(ODD)}, "x": i / 4, "more": [{"id": 9}]}
            for i in range(n)]


def both(spark, path):
    plain = spark.read.schema(SCHEMA).option("multiLine", True).json(str(path))
    made = read_json_arrays(spark, str(path), SCHEMA)
    return sorted(map(repr, made.collect())), sorted(map(repr, plain.collect()))


@pytest.mark.parametrize("size", [64, 1000, 1 << 20])
def test_equals_the_whole_file_reader(spark, tmp_path, size):
    rng = random.Random(size)
    (tmp_path / "a.json").write_text(json.dumps(rows(rng, 40)))
    (tmp_path / "b.json").write_text(json.dumps(rows(rng, 25), indent=2, ensure_ascii=False) + "\n")
    (tmp_path / "c.json").write_text("[" + ",".join(json.dumps(r, separators=(",", ":")) for r in rows(rng, 30)) + "]")
    (tmp_path / "one.json").write_text(json.dumps(rows(rng, 1)[0]))
    with conf(spark, spark__sql__files__maxPartitionBytes=str(size), spark__sql__files__openCostInBytes="0", spark__sql__files__minPartitionNum="1"):
        got, want = both(spark, tmp_path)
        assert got == want and len(got) == 96
        if size == 64:
            assert spark.read.option("lineSep", "}").text(str(tmp_path / "a.json")).rdd.getNumPartitions() > 20


def test_a_record_longer_than_several_ranges(spark, tmp_path):
    data = [{"id": 1, "text": "x}" * 3000}, {"id": 2, "text": "short"}, {"id": 3, "inner": {"a": list(range(2000))}}]
    (tmp_path / "a.json").write_text(json.dumps(data))
    with conf(spark, spark__sql__files__maxPartitionBytes="500", spark__sql__files__openCostInBytes="0", spark__sql__files__minPartitionNum="1"):
        got, want = both(spark, tmp_path)
    assert got == want and len(got) == 3


def test_odd_files(spark, tmp_path):
    (tmp_path / "empty.json").write_text("")
    (tmp_path / "none.json").write_text("[]")
    (tmp_path / "mixed.json").write_text('[1, "a}", {"id": 5}, null, [2], {"id": "bad", "text": "kept"}]')
    (tmp_path / "lines.json").write_text('{"id": 7}\n{"id": 8, "text": "}"}\n')
    (tmp_path / "cut.json").write_text('[{"id": 9}, {"id": 10, "text"')
    got = {(r.id, r.text) for r in read_json_arrays(spark, str(tmp_path), SCHEMA).collect()}
    assert {(5, None), (None, "kept"), (7, None), (8, "}"), (9, None)} <= got
    assert len(got) == 6


def test_elements_that_are_no_objects_are_skipped_across_ranges(spark, tmp_path):
    (tmp_path / "a.json").write_text(json.dumps([[{"id": 1, "text": "x" * 300}, {"id": 2}], {"id": 3}, [[{"id": 4}], {"b": "}" * 500}], {"id": 5}]))
    with conf(spark, spark__sql__files__maxPartitionBytes="64", spark__sql__files__openCostInBytes="0", spark__sql__files__minPartitionNum="1"):
        assert sorted(r.id for r in read_json_arrays(spark, str(tmp_path), "id long").collect()) == [3, 5]


def test_small_ranges_share_tasks(spark, tmp_path):
    (tmp_path / "a.json").write_text(json.dumps(rows(random.Random(5), 400)))
    tasks = TASKS_PER_CORE * spark.sparkContext.defaultParallelism
    with conf(spark, spark__sql__files__maxPartitionBytes="64", spark__sql__files__openCostInBytes="0", spark__sql__files__minPartitionNum="1"):
        assert spark.read.option("lineSep", "}").text(str(tmp_path)).rdd.getNumPartitions() > 3 * tasks
        made = read_json_arrays(spark, str(tmp_path), SCHEMA)
        assert made.rdd.getNumPartitions() <= tasks + int(spark.conf.get("spark.sql.shuffle.partitions"))
        got, want = both(spark, tmp_path)
    assert got == want and len(got) == 400
