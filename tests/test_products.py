import random

import pytest
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from marginlens.operators import cleaning as C
from marginlens.operators import products as P

SCHEMA = StructType([
    StructField("Product ID", StringType()), StructField("Category", StringType()),
    StructField("Price per product", DoubleType()),
])


def tiers(df):
    return {r["Product ID"]: r["price_position"] for r in df.collect()}


@pytest.mark.parametrize("method", ["window", "range"])
def test_price_positions(spark, method):
    a = spark.createDataFrame(
        [("P1", "Lamps", 95.5), ("P2", "Lamps", 61.0), ("P3", "Lamps", 22.25), ("P4", "Lamps", 3.0)], SCHEMA
    )
    out = tiers(P.classify_price_level(a, method=method))
    assert out == {"P1": "Premium", "P2": "Mid-Range", "P3": "Mid-Range", "P4": "Budget"}


@pytest.mark.parametrize("method", ["window", "range"])
def test_null_price_sorts_first(spark, method):
    df = spark.createDataFrame([("P1", "T", None), ("P2", "T", 5.0), ("P3", "T", 6.0), ("P4", "T", 7.0)], SCHEMA)
    rows = {r["Product ID"]: r["price_tier"] for r in P.classify_price_level(df, method=method).collect()}
    assert rows == {"P1": 1, "P2": 2, "P3": 3, "P4": 4}


def test_range_tiers_equal_ntile_for_all_small_sizes(spark):
    rng = random.Random(7)
    rows = []
    for n in range(1, 30):
        for i in range(n):
            price = None if rng.random() < 0.05 else float(rng.randint(1, 6))  # many ties and some NULLs
            rows.append((f"P{n:02d}-{i:02d}", f"cat{n:02d}", price))
    rows.append(("PX", None, 3.0))  # a NULL category is a group of its own
    df = spark.createDataFrame(rows, SCHEMA)
    window = P.classify_price_level(df, method="window")
    for parts in (1, 5):
        ranged = P.classify_price_level(df.repartition(parts), method="range")
        assert window.exceptAll(ranged).count() == 0 and ranged.exceptAll(window).count() == 0


def test_range_tiers_without_broadcast_match(spark):
    # Past the broadcast limit the offsets are joined by a shuffle on the run key.
    from conftest import SF_SMALL
    from marginlens.sources import testdata as td

    products = C.clean_products(td.products(spark, SF_SMALL, dirty=True))
    window = P.classify_price_level(products, clean=False, method="window")
    shuffled = P._with_position(P._tiers_range(products, broadcast_bytes=0))
    assert window.exceptAll(shuffled).count() == 0 and shuffled.exceptAll(window).count() == 0


@pytest.mark.parametrize("total,label", [(101, "Fast Moving"), (100, "Medium Moving"), (21, "Medium Moving"), (20, "Slow Moving"), (0, "Slow Moving")])
def test_velocity(spark, total, label):
    products = spark.createDataFrame([("T-9", "Trowel")], ["Product ID", "Product Name"])
    orders = spark.createDataFrame([("T-9", total), ("T-8", 7)], ["Product ID", "Quantity"])
    row = P.sales_velocity(products, orders).first()
    assert row["total_quantity_sold"] == total and row["inventory_velocity"] == label


def test_velocity_zero_fill_covers_numeric_columns(spark):
    products = spark.createDataFrame([("P1", "T", None)], SCHEMA)
    orders = spark.createDataFrame([("P9", 3)], ["Product ID", "Quantity"])
    row = P.sales_velocity(products, orders).first()
    assert row["total_quantity_sold"] == 0 and row["Price per product"] == 0.0
    assert row["inventory_velocity"] == "Slow Moving"
    narrow = P.sales_velocity(products, orders, fill_columns=["total_quantity_sold"]).first()
    assert narrow["Price per product"] is None


def test_range_tiers_on_testdata(spark):
    from conftest import SF_CHECK
    from marginlens.sources import testdata as td

    products = td.products(spark, SF_CHECK, dirty=True)
    window = P.classify_price_level(products, method="window")
    ranged = P.classify_price_level(products, method="range")
    assert window.exceptAll(ranged).count() == 0 and ranged.count() == window.count()


def test_ntile_formula_exhaustive(spark):
    def ntile(rank, n, k=4):
        q, m = divmod(n, k)
        return rank // (q + 1) + 1 if rank < m * (q + 1) else m + (rank - m * (q + 1)) // q + 1

    pairs = [(r, n) for n in range(1, 201) for r in range(n)]
    df = spark.createDataFrame(pairs, "rank long, total long")
    from pyspark.sql import functions as F

    got = df.select("rank", "total", P.ntile_from_rank(F.col("rank"), F.col("total")).alias("t")).collect()
    assert all(row["t"] == ntile(row["rank"], row["total"]) for row in got)
    # And the definition itself agrees with Spark's ntile on a few sizes.
    from pyspark.sql import Window
    for n in (1, 2, 3, 5, 7, 13):
        w = spark.range(n).withColumn("t", F.ntile(4).over(Window.orderBy("id"))).collect()
        assert [r["t"] for r in w] == [ntile(i, n) for i in range(n)]


def test_range_tiers_split_a_hot_category(spark):
    # One category holds a third of the products; the range rank spreads it
    # over several tasks and still deals out exactly the ntile tiers.
    from pyspark.sql import functions as F

    rng = random.Random(11)
    rows = [(f"H{i:05d}", "HOT", float(rng.randint(1, 50))) for i in range(1200)]
    rows += [(f"C{i:05d}", f"cat{i % 150:03d}", float(rng.randint(1, 50))) for i in range(2400)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(6)
    window = P.classify_price_level(df, method="window")
    ranged = P._with_position(P._tiers_range(C.clean_products(df), partitions=8))
    assert window.exceptAll(ranged).count() == 0 and ranged.exceptAll(window).count() == 0
    hot_tasks = ranged.filter("Category = 'HOT'").select(F.spark_partition_id().alias("p")).distinct().count()
    assert hot_tasks > 1
