"""Cleaning, report, profile and hot ids from one pass, and the split joins."""

from conftest import SF_CHECK, SF_SMALL
from marginlens.operators import cleaning as C
from marginlens.operators import joins as J
from marginlens.operators import orders as O
from marginlens.operators import profile as Q
from marginlens.plans.pipeline import run_pipeline
from marginlens.sources import testdata as td
from pyspark.sql import functions as F
from test_skew import conf, hot_sources

KEYS = O.DIMENSION_KEYS


def same(a, b):
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_one_pass_gives_the_rows_and_the_report(spark):
    orders = td.orders(spark, SF_SMALL, dirty=True)
    seen = C.ObservedOrders(orders, KEYS)
    assert seen.exact
    assert same(seen.cleaned, C.clean_orders(orders))
    assert same(seen.report(), C.orders_cleaning_report(orders))
    assert seen.rows == orders.count()
    assert same(Q.profile_samples(orders, "orders", seen.sample), Q.profile_samples(orders, "orders"))


def test_a_task_that_counted_twice_is_noticed(spark):
    orders = td.orders(spark, SF_SMALL, dirty=True)
    seen = C.ObservedOrders(orders, KEYS)
    # As after a lost executor: one more contribution than there are ranges.
    seen._before = {**seen._before, "tasks": seen._before["tasks"] + 1, "original": seen._before["original"] + 5}
    assert not seen.exact
    assert seen.rows == orders.count()
    assert same(seen.report(), C.orders_cleaning_report(orders))


def test_odd_tables(spark):
    orders = td.orders(spark, SF_SMALL, dirty=True)
    for df in (orders.limit(0), orders.drop("Profit"), orders.drop("Ship Date", "Customer ID"), orders.limit(1)):
        seen = C.ObservedOrders(df, [k for k in KEYS if k in df.columns])
        assert same(seen.cleaned, C.clean_orders(df))
        assert same(seen.report(), C.orders_cleaning_report(df))
    assert C.ObservedOrders(orders.limit(0), KEYS).sample is None


def test_a_customer_with_a_third_of_all_orders_is_split_by_default(spark):
    orders, customers, products = hot_sources(spark)
    cleaned, hot = J.written_with_hot_keys(C.clean_orders(orders), KEYS)
    assert [v for values in hot["Customer ID"].values() for v in values] == [1] and not hot["Product ID"]
    with conf(spark, spark__sql__autoBroadcastJoinThreshold="-1", spark__sql__adaptive__autoBroadcastJoinThreshold="-1",
              spark__sql__adaptive__coalescePartitions__enabled="false"):
        split = O.enriched_orders(orders, customers, products)
        plain = O.enriched_orders(orders, customers, products, split_hot=False)
        assert same(split, plain)
        parts = hot["Customer ID"]
        dim = C.clean_customers(customers).select("Customer ID", "Customer Name")
        joined = J.split_join(cleaned, dim, "Customer ID", parts)
        tasks = joined.where("`Customer ID` = 1").groupBy(F.spark_partition_id()).count().collect()
        assert len(tasks) > 4 and max(r["count"] for r in tasks) < sum(r["count"] for r in tasks) / 2


def test_text_ids_and_absent_hot_ids(spark):
    rows = [("a" if i % 3 else f"k{i}", i) for i in range(6000)] + [(None, -1)]
    fact = spark.createDataFrame(rows, "k string, v int")
    dim = spark.createDataFrame([("a", 1), ("k3", 2)], "k string, w int")
    table, hot = J.written_with_hot_keys(fact, ["k"])
    assert list(hot["k"].values()) == [["a"]]
    assert same(J.split_join(table, dim, "k", hot["k"]), fact.join(dim, "k"))
    assert same(J.split_join(table, dim.where("k <> 'a'"), "k", hot["k"]), fact.join(dim.where("k <> 'a'"), "k"))
    assert same(J.split_join(table, dim, "k", {4: ["k3", "zz"]}), fact.join(dim, "k"))


def test_materialised_pipeline_reads_the_raw_orders_once(spark):
    src = td.sources(spark, SF_CHECK, dirty=True)
    lazy = run_pipeline(src["customers"], src["orders"], src["products"], as_of="2001-08-01")
    read = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            read.add(batch.num_rows)
            yield batch

    orders = src["orders"].mapInArrow(counted, src["orders"].schema)
    n = src["orders"].count()
    out = run_pipeline(src["customers"], orders, src["products"], as_of="2001-08-01", materialize=True)
    for name in ("cleaning_report", "profiles", "validation", "profit_summary", "profit_by_year", "profit_by_customer_year"):
        assert same(out[name], lazy[name]), name
    assert read.value == n
