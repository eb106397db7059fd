from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType

from marginlens.operators import cleaning as C

ORDERS = StructType([
    StructField("Row ID", LongType()),
    StructField("Order ID", StringType()),
    StructField("Order Date", StringType()),
    StructField("Ship Date", StringType()),
    StructField("Customer ID", StringType()),
    StructField("Product ID", StringType()),
    StructField("Price", DoubleType()),
    StructField("Profit", DoubleType()),
])


def orders(spark, rows):
    return spark.createDataFrame(rows, ORDERS)


def ids(df, col="Order ID"):
    return sorted(r[0] for r in df.select(col).collect())


def test_negative_and_null_profit_dropped(spark):
    df = orders(spark, [
        (1, "O1", "1/1/2014", "2/1/2014", "C1", "P1", 10.0, 5.0),
        (2, "O2", "1/1/2014", "2/1/2014", "C1", "P1", 10.0, -0.01),
        (3, "O3", "1/1/2014", "2/1/2014", "C1", "P1", 10.0, None),
        (4, "O4", "1/1/2014", "2/1/2014", "C1", "P1", 10.0, 0.0),
    ])
    assert ids(C.drop_negative_profit(df)) == ["O1", "O4"]


def test_keep_first_is_by_row_id_and_partition_independent(spark):
    rows = [(r, f"O{r % 3}", "1/1/2014", "2/1/2014", "C1", f"P{r}", 1.0, 1.0) for r in range(30, 0, -1)]
    df = orders(spark, rows)
    expected = {("O0", 3), ("O1", 1), ("O2", 2)}
    for parts in (1, 7):
        kept = C.dedupe_orders(df.repartition(parts))
        assert {(r["Order ID"], r["Row ID"]) for r in kept.collect()} == expected


def test_dates_must_both_parse(spark):
    df = orders(spark, [
        (1, "O1", "21/8/2016", "25/8/2016", "C1", "P1", 1.0, 1.0),
        (2, "O2", "01/02/2014", "03/02/2014", "C1", "P1", 1.0, 1.0),
        (3, "O3", "2016-08-21", "25/8/2016", "C1", "P1", 1.0, 1.0),
        (4, "O4", "21/8/2016", "31/2/2016", "C1", "P1", 1.0, 1.0),
        (5, "O5", None, "25/8/2016", "C1", "P1", 1.0, 1.0),
    ])
    assert ids(C.drop_unparsable_dates(df)) == ["O1", "O2"]
    # Only applied when both columns exist.
    assert C.drop_unparsable_dates(df.drop("Ship Date")).count() == 5


def test_rule_order_kept_duplicate_can_still_fail(spark):
    # O1's first line (by Row ID) has a bad date, so the whole order vanishes
    # even though its second line would have passed.
    df = orders(spark, [
        (1, "O1", "bad", "2/1/2014", "C1", "P1", 1.0, 1.0),
        (2, "O1", "1/1/2014", "2/1/2014", "C1", "P1", 1.0, 1.0),
        (3, "O2", "1/1/2014", "2/1/2014", None, "P1", 1.0, 1.0),
        (4, "O3", "1/1/2014", "2/1/2014", "C1", None, 1.0, 1.0),
        (5, None, "1/1/2014", "2/1/2014", "C1", "P1", 1.0, 1.0),
        (6, "O4", "1/1/2014", "2/1/2014", "C1", "P1", 1.0, -1.0),
        (7, "O4", "1/1/2014", "2/1/2014", "C2", "P1", 1.0, 2.0),
    ])
    cleaned = C.clean_orders(df)
    assert [(r["Order ID"], r["Row ID"]) for r in cleaned.collect()] == [("O4", 7)]


def test_rules_skip_missing_columns(spark):
    df = spark.createDataFrame([("C1", "P1"), ("C1", "P1")], ["Customer ID", "Product ID"])
    assert C.clean_orders(df).count() == 2


def test_customer_names(spark):
    df = spark.createDataFrame(
        [("1", "José  O'Brien 123"), ("2", "  Anne-Marie   Smith "), ("3", None), ("4", "123")],
        ["Customer ID", "Customer Name"],
    )
    out = {r[0]: r[1] for r in C.normalise_customer_names(df).collect()}
    assert out == {"1": "Jos OBrien", "2": "AnneMarie Smith", "3": None, "4": ""}


def test_clean_customers_and_products(spark):
    customers = spark.createDataFrame(
        [("C1", "Zed"), ("C1", "Amy"), (None, "Nobody"), ("C2", "Bo#b")], ["Customer ID", "Customer Name"]
    )
    assert sorted(map(tuple, C.clean_customers(customers).collect())) == [("C1", "Amy"), ("C2", "Bob")]
    products = spark.createDataFrame([("P1", "B"), ("P1", "A"), (None, "X")], ["Product ID", "Category"])
    assert [tuple(r) for r in C.clean_products(products).collect()] == [("P1", "A")]


def test_cleaning_report_counts_each_rule_once(spark):
    df = orders(spark, [
        (1, "O1", "1/1/2014", "2/1/2014", "C1", "P1", 1.0, None),      # null profit
        (2, "O1", "1/1/2014", "2/1/2014", "C1", "P1", 1.0, -1.0),      # negative
        (3, None, "1/1/2014", "2/1/2014", "C1", "P1", 1.0, 1.0),       # null order id
        (4, "O2", "1/1/2014", "2/1/2014", "C1", "P1", 1.0, 1.0),       # kept
        (5, "O2", "1/1/2014", "2/1/2014", "C1", "P1", 1.0, 1.0),       # duplicate
        (6, "O3", "2014-01-01", "2/1/2014", "C1", "P1", 1.0, 1.0),     # date
        (7, "O4", "1/1/2014", "2/1/2014", None, "P1", 1.0, 1.0),       # customer
        (8, "O5", "1/1/2014", "2/1/2014", "C1", None, 1.0, 1.0),       # product
        (9, "O6", "1/1/2014", "2/1/2014", "C1", "P1", 1.0, 1.0),       # kept
    ])
    report = {r["rule"]: r["row_count"] for r in C.orders_cleaning_report(df).collect()}
    assert report == {
        "original": 9, "null_profit": 1, "negative_profit": 1, "null_order_id": 1, "duplicate_order_id": 1,
        "invalid_date": 1, "null_customer_id": 1, "null_product_id": 1, "final": 2, "total_removed": 7,
    }
    assert report["final"] == C.clean_orders(df).count()


def test_cleaning_report_matches_cleaning_on_testdata(spark):
    from conftest import SF_SMALL
    from marginlens.sources import testdata as td

    src = td.sources(spark, SF_SMALL, dirty=True)
    report = {(r["table_name"], r["rule"]): r["row_count"]
              for r in C.cleaning_report(src["customers"], src["orders"], src["products"]).collect()}
    assert report[("orders", "final")] == C.clean_orders(src["orders"]).count()
    assert report[("customers", "final")] == C.clean_customers(src["customers"]).count()
    assert report[("products", "final")] == C.clean_products(src["products"]).count()
    assert report[("orders", "original")] == src["orders"].count()


def test_keep_first_plans_partial_group_limit(spark):
    df = orders(spark, [(1, "O1", "1/1/2014", "2/1/2014", "C1", "P1", 1.0, 1.0)])
    plan = C.clean_orders(df)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan
