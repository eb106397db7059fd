"""Exact sums of amounts of any magnitude."""

import math
import random
from fractions import Fraction

import pytest

from marginlens.functions.money import exact_totals
from pyspark.sql import functions as F

nan, inf = float("nan"), float("inf")


def totals(spark, rows, parts):
    df = spark.createDataFrame(rows, "k string, x double").repartition(parts)
    out = exact_totals(df, ["k"], {"total": F.col("x")}, {"n": F.col("x")})
    return {r.k: (r.total, r.n) for r in out.collect()}


CASES = {
    "huge": [1e300] * 7 + [3e300],
    "tiny": [1e-300, 4e-300, 5e-324, 5e-324],
    "cancel": [1e300, 5.0, -1e300, 0.25, 1e-20, -1e-20],
    "mixed": [1e16, 2.5, 1e-13, 3e17, 0.1, 0.2],
    "digits": [0.0010000000000000002, 1000.0000000000001, 1234567.1234567891, 9007199254740993.0],
    "cents": [0.1] * 10 + [1e14, -1e14],
    "edge": [1e15, 999999999999999.9, -1e15],
    "zero": [0.0, -0.0],
    "nulls": [None, None],
    "some": [None, 1.5],
    "nan": [1.0, nan, 1e300],
    "inf": [inf, 1.0, -1e300],
    "both": [inf, -inf, 2.0],
    "largest": [1.7976931348623157e308, -1.7976931348623157e308, 7.0],
}


@pytest.mark.parametrize("parts", [1, 3, 8])
def test_sums_do_not_depend_on_partitioning(spark, parts):
    rng = random.Random(parts)
    rows = [(k, x) for k, values in CASES.items() for x in values]
    rng.shuffle(rows)
    got = totals(spark, rows, parts)
    for k, values in CASES.items():
        some = [x for x in values if x is not None]
        total, n = got[k]
        assert n == len(some)
        if not some:
            assert total is None
        elif any(math.isnan(x) for x in some) or k == "both":
            assert math.isnan(total)
        elif any(math.isinf(x) for x in some):
            assert total == inf
        else:  # the exact sum of the amounts' shortest texts, but for the last bits where windows meet
            want = sum(Fraction(repr(x)) for x in some)
            assert abs(Fraction(total) - want) <= abs(want) * Fraction(1, 2**51), k


def test_windows_split_only_odd_amounts(spark):
    from marginlens.functions.money import partial_totals

    df = spark.range(1000).select((F.col("id") % 5).cast("string").alias("k"), (F.col("id") / 100).alias("x"))
    assert partial_totals(df, ["k"], {"x": F.col("x")}, {"n": F.col("x")}).count() == 5


def test_random_amounts_of_all_exponents(spark):
    rng = random.Random(5)
    rows = [(str(i % 4), rng.uniform(-1, 1) * 10.0 ** rng.randint(-320, 305)) for i in range(600)]
    first = totals(spark, rows, 2)
    rng.shuffle(rows)
    assert totals(spark, rows, 7) == first
    for k, (total, _) in first.items():
        want = sum(Fraction(repr(x)) for g, x in rows if g == k)
        assert abs(Fraction(total) - want) <= abs(want) * Fraction(1, 2**50)
