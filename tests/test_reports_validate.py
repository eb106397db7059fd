from pyspark.sql.types import DoubleType, IntegerType, LongType, StringType, StructField, StructType

from marginlens.operators import profile as Q
from marginlens.operators import reports as R
from marginlens.operators import validate as V

SUMMARY = StructType([
    StructField("Year", IntegerType()), StructField("Category", StringType()),
    StructField("Sub-Category", StringType()), StructField("Customer Name", StringType()),
    StructField("Total_Profit", DoubleType()), StructField("Order_Count", LongType()),
])


def summary(spark):
    return spark.createDataFrame([
        (2014, "Tech", "Phones", "A", 10.0, 1),
        (2014, "Tech", "Phones", "B", 10.0, 2),
        (2015, "Office", "Paper", "A", -2.5, 1),
        (2015, "Tech", "Phones", "C", 30.25, 3),
        (2016, "Office", "Paper", "B", 0.0, 1),
        (2016, "Tech", "Laptops", "D", 10.0, 1),
    ], SUMMARY)


def test_summary_statistics(spark):
    row = R.summary_statistics(summary(spark)).first()
    assert row["Total_Profit_All_Groups"] == 57.75
    assert row["Average_Profit_Per_Group"] == 9.63  # 9.625 rounds half up
    assert (row["Max_Profit_Group"], row["Min_Profit_Group"], row["Total_Groups"]) == (30.25, -2.5, 6)


def test_top_and_bottom_are_deterministic_on_ties(spark):
    top = [r["Customer Name"] for r in R.top_groups(summary(spark), 4).collect()]
    assert top == ["C", "A", "B", "D"]
    bottom = [r["Customer Name"] for r in R.bottom_groups(summary(spark), 2).collect()]
    assert bottom == ["A", "B"]


def test_sql_reports(spark):
    by_year = {r["Year"]: (r["Total_Profit"], r["Groups"]) for r in R.sql_profit_by_year(summary(spark)).collect()}
    assert by_year == {2014: (20.0, 2), 2015: (27.75, 2), 2016: (10.0, 2)}
    top = R.sql_top_customers(summary(spark), 2).collect()
    assert [(r["Customer Name"], r["Total_Customer_Profit"]) for r in top] == [("C", 30.25), ("B", 10.0)]


def test_top_customer_trends(spark):
    by_customer = spark.createDataFrame(
        [("A", 30.0, 2), ("B", 20.0, 1), ("C", 5.0, 1)], ["Customer Name", "Total_Profit", "Order_Count"]
    ).orderBy("Total_Profit", ascending=False)
    by_customer_year = spark.createDataFrame(
        [("A", 2014, 10.0, 1), ("A", 2015, 20.0, 1), ("B", 2014, 20.0, 1), ("C", 2014, 5.0, 1)],
        ["Customer Name", "Year", "Total_Profit", "Order_Count"],
    )
    rows = R.top_customer_trends(by_customer, by_customer_year, n=2).collect()
    assert [(r["Customer Name"], r["Year"], r["Customer_Total_Profit"]) for r in rows] == [
        ("A", 2014, 30.0), ("A", 2015, 30.0), ("B", 2014, 20.0)
    ]


def report(df):
    return {r["check"]: (r["violations"], r["passed"]) for r in df.collect()}


def test_customer_validator_counts_seeded_violations(spark):
    df = spark.createDataFrame(
        [("C1", 1.0, 1.0, "Low Risk"), ("C1", 1.0, 1.0, "Low Risk"), (None, 1.0, 1.0, None),
         (None, -1.0, 1.0, "Unknown"), ("C2", 1.0, -3.0, "High Risk")],
        ["Customer ID", "total_sales", "total_profit", "churn_risk_score"],
    )
    assert report(V.validate_enriched_customers(df)) == {
        "null_customer_id": (2, False), "duplicate_customer_id": (2, False),
        "negative_sales_or_profit": (2, False), "invalid_churn_risk_score": (1, False),
    }


def test_product_validator(spark):
    df = spark.createDataFrame(
        [("P1", "Premium", "Fast Moving", 5), ("P2", "Cheap", "Slow Moving", -1), ("P3", None, "Glacial", 0)],
        ["Product ID", "price_position", "inventory_velocity", "total_quantity_sold"],
    )
    assert report(V.validate_enriched_products(df)) == {
        "null_product_id": (0, True), "duplicate_product_id": (0, True), "negative_quantity": (1, False),
        "invalid_price_position": (1, False), "invalid_inventory_velocity": (1, False),
    }


def test_orders_validator(spark):
    enriched = spark.createDataFrame(
        [("O1", "1/1/2014", "A", "X", 1, 1.0), ("O2", None, None, "X", 0, -1.0)],
        ["Order ID", "Order Date", "Customer Name", "Product Name", "Quantity", "Price"],
    )
    original = spark.createDataFrame([(i,) for i in range(5)], ["Order ID"])
    out = report(V.validate_enriched_orders(enriched, original))
    assert out["row_count_mismatch"] == (3, False)
    assert out["null_order_date"] == (1, False) and out["null_customer_name"] == (1, False)
    assert out["null_order_id"] == (0, True)
    assert out["non_positive_quantity"] == (1, False) and out["negative_price"] == (1, False)


def test_summary_validator(spark):
    rows = summary(spark).collect() + [tuple(summary(spark).first())]
    df = spark.createDataFrame(rows + [(None, "Tech", "Phones", "Z", None, 0)], SUMMARY)
    enriched = spark.createDataFrame([(1,), (2,)], ["x"])
    out = report(V.validate_profit_summary(df, enriched))
    assert out["duplicate_rows"] == (1, False) and out["null_year"] == (1, False)
    assert out["null_total_profit"] == (1, False) and out["non_positive_order_count"] == (1, False)
    assert out["summary_exceeds_source"] == (6, False)


def test_aggregate_validator(spark):
    good = spark.createDataFrame([(2014, 1.0, 1), (2015, None, 0)], ["Year", "Total_Profit", "Order_Count"])
    out = report(V.validate_profit_aggregate(good))
    assert out["valid"] == (0, True) and out["null_total_profit"] == (1, False)
    assert V.is_valid(V.validate_profit_aggregate(good))
    empty = good.limit(0)
    assert not V.is_valid(V.validate_profit_aggregate(empty))
    assert report(V.validate_profit_aggregate(empty))["empty_result"] == (1, False)


def test_profile(spark):
    df = spark.createDataFrame([("a", 1, 2.0), ("b", 2, 3.0), ("c", 3, 4.0)], ["Name-x", "Some col", "v"])
    rows = Q.profile(df, "t").collect()
    assert [(r["column_name"], r["ordinal"], r["data_type"], r["record_count"]) for r in rows] == [
        ("Name-x", 1, "string", 3), ("Some col", 2, "bigint", 3), ("v", 3, "double", 3)
    ]
    assert Q.profile(df.limit(0), "t").first()["status"] == "Passed"
    assert Q.profile(None, "t", spark).first()["status"] == "Failed"
    d = Q.profile_dict(df, "t")
    assert d["status"] == "Passed" and d["number_of_records"] == 3 and len(d["sample_records"]) == 2
    assert Q.profile_dict(None, "t")["status"] == "Failed"
