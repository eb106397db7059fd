"""Property test: the order-cleaning chain against a brute-force model."""

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType

from marginlens.operators import cleaning as C

SCHEMA = StructType([
    StructField("Row ID", LongType()), StructField("Order ID", StringType()),
    StructField("Order Date", StringType()), StructField("Ship Date", StringType()),
    StructField("Customer ID", StringType()), StructField("Product ID", StringType()),
    StructField("Profit", DoubleType()),
])
DATES = ["1/2/2014", "29/2/2016", "31/2/2016", "2014-01-02", "07/03/2015", None]


def parses(text):
    if text is None:
        return False
    parts = text.split("/")
    if len(parts) != 3 or not all(p.isdigit() for p in parts) or len(parts[2]) != 4 \
            or not (1 <= len(parts[0]) <= 2 and 1 <= len(parts[1]) <= 2):
        return False
    try:
        dt.date(int(parts[2]), int(parts[1]), int(parts[0]))
        return True
    except ValueError:
        return False


def brute_force(rows):
    kept = [r for r in rows if r[6] is not None and r[6] >= 0 and r[1] is not None]
    first = {}
    # Order by Row ID, then the remaining columns, NULLs first.
    key = lambda r: tuple((v is not None, v) for v in (r[0], r[2], r[3], r[4], r[5], r[6]))
    for r in sorted(kept, key=key):
        first.setdefault(r[1], r)
    return sorted(
        (r for r in first.values() if parses(r[2]) and parses(r[3]) and r[4] is not None and r[5] is not None),
        key=str,
    )


row = st.tuples(
    st.one_of(st.none(), st.integers(1, 4)),
    st.one_of(st.none(), st.sampled_from(["O1", "O2", "O3"])),
    st.sampled_from(DATES), st.sampled_from(DATES),
    st.one_of(st.none(), st.sampled_from(["C1", "C2"])),
    st.one_of(st.none(), st.sampled_from(["P1", "P2"])),
    st.one_of(st.none(), st.sampled_from([-1.5, 0.0, 2.25])),
)


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(row, max_size=14))
def test_clean_orders_matches_brute_force(spark, rows):
    got = sorted((tuple(r) for r in C.clean_orders(spark.createDataFrame(rows, SCHEMA)).collect()), key=str)
    assert got == brute_force(rows)
