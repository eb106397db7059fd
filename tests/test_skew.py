"""One customer holding a third of all orders (SURVEY's hot-key case)."""

from contextlib import contextmanager

from pyspark.sql import functions as F

from conftest import SF_CHECK
from marginlens.operators import orders as O
from marginlens.operators import profit as A
from marginlens.sources import testdata as td


@contextmanager
def conf(spark, **values):
    keys = {k.replace("__", "."): v for k, v in values.items()}
    before = {k: spark.conf.get(k, None) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def hot_sources(spark):
    src = td.sources(spark, SF_CHECK)
    orders = src["orders"].withColumn(
        "Customer ID", F.when(F.col("Order ID") % 3 == 0, F.lit(1).cast("bigint")).otherwise(F.col("Customer ID"))
    )
    return orders, src["customers"], src["products"]


def test_hot_customer_shuffle_join_is_exact(spark):
    # As on a cluster where no dimension fits a broadcast: every join is a
    # sort-merge join on its key, the hot customer's rows meet in one key group.
    orders, customers, products = hot_sources(spark)
    expected = O.enriched_orders(orders, customers, products)
    expected_rows = sorted(map(tuple, A.profit_by_customer(expected, unique_orders=True).collect()))
    with conf(spark, spark__sql__autoBroadcastJoinThreshold="-1",
              spark__sql__adaptive__autoBroadcastJoinThreshold="-1"):
        by_customer = A.profit_by_customer(O.enriched_orders(orders, customers, products), unique_orders=True)
        rows = sorted(map(tuple, by_customer.collect()))
        plan = by_customer._jdf.queryExecution().executedPlan().toString()
        assert "isFinalPlan=true" in plan and "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan
    assert rows == expected_rows
    hot_name = customers.filter("`Customer ID` = 1").first()["Customer Name"]
    hot = [r for r in rows if r[0] == hot_name]
    assert hot and hot[0][2] >= sum(r[2] for r in rows) // 4


def test_aggregates_combine_map_side(spark):
    orders, customers, products = hot_sources(spark)
    enriched = O.enriched_orders(orders, customers, products)
    for df in [A.profit_summary(enriched), A.profit_by_customer(enriched),
               A.profit_by_customer(enriched, unique_orders=True), A.profit_by_customer_year(enriched)]:
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "partial_sum" in plan, plan


def test_salted_joins_spread_the_hot_customer_and_keep_every_row(spark):
    from marginlens.operators.joins import hot_keys

    orders, customers, products = hot_sources(spark)
    plain = O.enriched_orders(orders, customers, products)
    with conf(spark, spark__sql__autoBroadcastJoinThreshold="-1",
              spark__sql__adaptive__autoBroadcastJoinThreshold="-1"):
        salted = O.enriched_orders(orders, customers, products, hot_key_rows=1000, salt_buckets=8)
        assert plain.exceptAll(salted).count() == 0 and salted.exceptAll(plain).count() == 0
        assert salted.count() == plain.count()
    from marginlens.operators.cleaning import clean_orders
    hot = [r["Customer ID"] for r in hot_keys(clean_orders(orders), "Customer ID", 1000).collect()]
    assert hot == [1]
    # The hot customer's orders leave the customer join in several tasks.
    from marginlens.operators.joins import salted_join
    from marginlens.operators.cleaning import clean_customers
    with conf(spark, spark__sql__autoBroadcastJoinThreshold="-1",
              spark__sql__adaptive__autoBroadcastJoinThreshold="-1",
              spark__sql__adaptive__coalescePartitions__enabled="false"):
        joined = salted_join(clean_orders(orders), clean_customers(customers).select("Customer ID", "Customer Name"),
                             "Customer ID", 1000, buckets=8)
        tasks = joined.where("`Customer ID` = 1").select(F.spark_partition_id().alias("p")).distinct().count()
    assert tasks > 1


def test_many_hot_ids_never_meet_in_one_task(spark):
    # Past the broadcast limit the orders look up the hot ids by (id, salt).
    orders, customers, products = hot_sources(spark)
    plain = O.enriched_orders(orders, customers, products)
    with conf(spark, spark__sql__autoBroadcastJoinThreshold="-1",
              spark__sql__adaptive__autoBroadcastJoinThreshold="-1"):
        salted = O.enriched_orders(orders, customers, products, hot_key_rows=2, salt_buckets=8, broadcast_keys=0)
        plan = salted._jdf.queryExecution().executedPlan().toString()
        assert plain.exceptAll(salted).count() == 0 and salted.exceptAll(plain).count() == 0
    # No exchange of order lines (they carry a Quantity) on an id alone.
    lines = plan.split("\n")
    for i, line in enumerate(lines):
        if "Exchange hashpartitioning(Customer ID" in line or "Exchange hashpartitioning(Product ID" in line:
            assert "__salt" in line or "Quantity" not in lines[i + 1], line


def test_hot_order_id_is_trimmed_before_the_shuffle(spark):
    from marginlens.operators.cleaning import clean_orders
    from marginlens.sources.testdata import table

    lines = table(spark, SF_CHECK, "lineitem").selectExpr(
        "CAST(l_linenumber AS BIGINT) * 1000000000 + l_partkey AS `Row ID`",
        "CASE WHEN l_partkey % 3 = 0 THEN 1 ELSE l_orderkey END AS `Order ID`", "l_discount AS Profit")
    plan = clean_orders(lines)._jdf.queryExecution().executedPlan().toString()
    partial = plan.index("Partial")
    assert plan.index("Final") < plan.index("Exchange hashpartitioning(Order ID") < partial
