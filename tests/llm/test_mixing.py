"""Poisson replication against a direct inversion of the distribution."""

import hashlib
import math

import pytest

from marginlens.llm.mixing import mix_sources, source_rates

SCHEMA = "doc_id long, text string, source string, copy string, rate int"


def draws(seed, source, doc_id, rate):
    u = int(hashlib.md5(f"{seed}:{source or 'null'}:{'null' if doc_id is None else doc_id}".encode()).hexdigest()[:13], 16) / 2**52
    k, p = 0, math.exp(-rate)
    total = p
    while u >= total:
        k += 1
        p *= rate / k
        total += p
    return k


def test_copies_follow_the_distribution(spark):
    rates = {"a": 0.3, "b": 2.5, None: 1.0, "none": 0.0, "many": 40.0}
    rows = [(i if i % 50 else None, None if i % 7 == 0 else "t" * (i % 5), s, "clash", 1)
            for i in range(2000) for s in ([*rates, "absent"][i % 6],)]
    df = spark.createDataFrame(rows, SCHEMA)
    table = spark.createDataFrame(list(rates.items()), "source string, rate double")
    got = mix_sources(df, table, seed="s")
    assert got.columns == ["doc_id", "text", "source", "rate", "copy", "shuffle_key"]
    out = got.collect()
    assert [r.shuffle_key for r in out] == sorted(r.shuffle_key for r in out)
    have, want = {}, {}
    for r in out:
        have[(r.doc_id, r.text, r.source)] = have.get((r.doc_id, r.text, r.source), 0) + 1
    for i, t, s, *_ in rows:
        if s != "absent" and (n := draws("s", s, i, rates[s])):
            want[(i, t, s)] = want.get((i, t, s), 0) + n
    assert have == want
    mean = sum(r.source == "many" for r in out) / sum(r[2] == "many" for r in rows)
    assert 37 < mean < 43


def test_rates_keep_the_total_and_bad_rates_raise(spark):
    df = spark.createDataFrame([(i, "t", "big" if i % 3 else "small", "c", 1) for i in range(900)], SCHEMA)
    rates = {r.source: r.rate for r in source_rates(df).collect()}
    assert abs(rates["big"] * 600 + rates["small"] * 300 - 900) < 1e-6 and rates["big"] < 1 < rates["small"]
    with pytest.raises(ValueError):
        mix_sources(df, spark.createDataFrame([("big", -1.0)], "source string, rate double"))


def test_empty_tables(spark):
    empty, rates = spark.createDataFrame([], SCHEMA), spark.createDataFrame([], "source string, rate double")
    assert mix_sources(empty, source_rates(empty)).collect() == []
    assert mix_sources(spark.createDataFrame([(1, "t", "s", "c", 1)], SCHEMA), rates).collect() == []


def test_large_rates_follow_the_distribution(spark):
    """A tiny source of a large corpus: far more copies than exp(-rate) can start from."""
    rates = {"over": 701.0, "far": 6000.5, None: 1500.0, "mid": 250.0, "one": 1.0}
    rows = [(i, "t", s, "c", 1) for s in rates for i in range(60)]
    table = spark.createDataFrame(list(rates.items()), "source string, rate double")
    got = mix_sources(spark.createDataFrame(rows, SCHEMA), table, seed="s").groupBy("source", "doc_id").count().collect()
    have = {(r["source"], r["doc_id"]): r["count"] for r in got}
    want = {}
    for i, _, s, *_ in rows:
        u = int(hashlib.md5(f"s:{s or 'null'}:{i}".encode()).hexdigest()[:13], 16) / 2**52
        k, total = 0, math.exp(-rates[s])
        while u >= total:
            k += 1
            total += math.exp(-rates[s] + k * math.log(rates[s]) - math.lgamma(k + 1))
        if k:
            want[(s, i)] = k
    assert have == want
    for bad in (math.inf, math.nan):
        with pytest.raises(ValueError):
            mix_sources(spark.createDataFrame(rows[:1], SCHEMA), spark.createDataFrame([("over", bad)], "source string, rate double"))


def test_many_sources_take_the_salted_join(spark, monkeypatch):
    from marginlens.llm import mixing

    rows = [(i, "t", [None, "a", "b", "rare"][i % 4 if i % 7 else 1], "c", 1) for i in range(400)]
    docs = spark.createDataFrame(rows, SCHEMA)
    rates = spark.createDataFrame([(None, 0.5), ("a", 3.0), ("b", 1.0), ("rare", 8.0)], "source string, rate double")
    broadcast = sorted(map(str, mix_sources(docs, rates).collect()))
    monkeypatch.setattr(mixing, "BROADCAST_SOURCES", 0)
    assert sorted(map(str, mix_sources(docs, rates).collect())) == broadcast
