"""Reports over the outputs.

The reference builds these in notebooks, several of them with pandas on the
driver; here each one is a DataFrame.  Top-N cuts carry full tie-breakers so
they are deterministic, and the SQL-style reports go through ``spark.sql``
with the input passed as a parameter (no session-global view is touched).

Sums of the (already rounded) profit columns are exact (``functions.money``);
averages are the double quotient of that sum and the count.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marginlens import schemas as s
from marginlens.functions.money import exact_sum, exact_sum_sql, round_money


def _c(name: str) -> Column:
    return F.col(f"`{name}`")


def _exact_sum(name: str) -> Column:
    return exact_sum(_c(name))


def _mean(name: str) -> Column:
    return F.try_divide(_exact_sum(name), F.count(_c(name)))


def _keys_asc() -> list[Column]:
    return [_c(k).asc_nulls_first() for k in s.SUMMARY_KEYS]

# --- over the profit summary (R1-R8) ----------------------------------------


def summary_statistics(summary: DataFrame) -> DataFrame:
    """Total, mean, max and min group profit and the number of groups."""
    return summary.agg(
        round_money(_exact_sum("Total_Profit")).alias("Total_Profit_All_Groups"),
        F.round(_mean("Total_Profit"), 2).alias("Average_Profit_Per_Group"),
        round_money(F.max("Total_Profit")).alias("Max_Profit_Group"),
        round_money(F.min("Total_Profit")).alias("Min_Profit_Group"),
        F.count(F.lit(1)).alias("Total_Groups"),
    )


def yearly_breakdown(summary: DataFrame) -> DataFrame:
    """R2: profit and group count per year."""
    return (
        summary.groupBy("Year")
        .agg(
            round_money(_exact_sum("Total_Profit")).alias("Yearly_Profit"),
            F.count(F.lit(1)).alias("Groups_Per_Year"),
        )
        .orderBy(F.col("Year").asc_nulls_first())
    )


def category_breakdown(summary: DataFrame) -> DataFrame:
    """Profit and group count per category."""
    return (
        summary.groupBy(s.CATEGORY)
        .agg(
            round_money(_exact_sum("Total_Profit")).alias("Category_Profit"),
            F.count(F.lit(1)).alias("Groups_Per_Category"),
        )
        .orderBy(_c(s.CATEGORY).asc_nulls_first())
    )


def top_groups(summary: DataFrame, n: int = 5) -> DataFrame:
    """The ``n`` most profitable summary groups."""
    return summary.orderBy(F.col("Total_Profit").desc_nulls_last(), *_keys_asc()).limit(n)


def bottom_groups(summary: DataFrame, n: int = 5) -> DataFrame:
    """The ``n`` least profitable summary groups."""
    return summary.orderBy(F.col("Total_Profit").asc_nulls_last(), *_keys_asc()).limit(n)


def _sql(summary: DataFrame, text: str) -> DataFrame:
    return summary.sparkSession.sql(text, summary=summary)


def sql_profit_by_year(summary: DataFrame) -> DataFrame:
    """Unrounded yearly profit and group count, in SQL."""
    return _sql(
        summary,
        f"""SELECT Year, {exact_sum_sql("Total_Profit")} AS Total_Profit, COUNT(*) AS Groups
            FROM {{summary}} GROUP BY Year ORDER BY Year""",
    )


def sql_top_customers(summary: DataFrame, n: int = 10) -> DataFrame:
    """The ``n`` customers with the highest summed profit, in SQL."""
    return _sql(
        summary,
        f"""SELECT `Customer Name`,
                   {exact_sum_sql("Total_Profit")} AS Total_Customer_Profit,
                   COUNT(*) AS Order_Groups
            FROM {{summary}} GROUP BY `Customer Name`
            ORDER BY Total_Customer_Profit DESC, `Customer Name` LIMIT {int(n)}""",
    )


def sql_category_performance(summary: DataFrame) -> DataFrame:
    """Profit and group count per category x sub-category, in SQL."""
    return _sql(
        summary,
        f"""SELECT Category, `Sub-Category`, {exact_sum_sql("Total_Profit")} AS Total_Profit, COUNT(*) AS Groups
            FROM {{summary}} GROUP BY Category, `Sub-Category`
            ORDER BY Category, Total_Profit DESC, `Sub-Category`""",
    )


# --- over the enriched customers (R9-R11) ------------------------------------


def top_average_order_value(customers: DataFrame, n: int = 5) -> DataFrame:
    """Customers with the highest (rounded) average order value."""
    return (
        customers.select(
            s.CUSTOMER_ID, s.CUSTOMER_NAME, F.round("average_order_value", 2).alias("average_order_value")
        )
        .orderBy(F.col("average_order_value").desc_nulls_last(), _c(s.CUSTOMER_ID).asc_nulls_first())
        .limit(n)
    )


def top_product_variety(customers: DataFrame, n: int = 5) -> DataFrame:
    """Customers who bought the most distinct products."""
    return (
        customers.select(s.CUSTOMER_ID, s.CUSTOMER_NAME, "unique_products_purchased")
        .orderBy(F.col("unique_products_purchased").desc_nulls_last(), _c(s.CUSTOMER_ID).asc_nulls_first())
        .limit(n)
    )


def longest_lapsed(customers: DataFrame, n: int = 5) -> DataFrame:
    """Customers with the most days since their last order (known recency only)."""
    return (
        customers.select(s.CUSTOMER_ID, s.CUSTOMER_NAME, "days_since_last_order", "churn_risk_score")
        .where(F.col("days_since_last_order").isNotNull())
        .orderBy(F.col("days_since_last_order").desc(), _c(s.CUSTOMER_ID).asc_nulls_first())
        .limit(n)
    )


# --- previews of registered views (R12, R13) ---------------------------------

PREVIEW_COLUMNS = {
    "customers": [s.CUSTOMER_ID, s.CUSTOMER_NAME, s.COUNTRY],
    "orders": [s.ORDER_ID, s.CUSTOMER_ID, s.PRODUCT_ID, s.QUANTITY],
    "products": [s.PRODUCT_ID, s.CATEGORY, s.SUB_CATEGORY, s.PRODUCT_NAME],
}
PREVIEW_ORDER = {
    "customers": [s.CUSTOMER_ID],
    "orders": [s.ORDER_ID, s.ROW_ID, s.PRODUCT_ID],
    "products": [s.PRODUCT_ID],
    "enriched_customers": [s.CUSTOMER_ID],
    "enriched_products": [s.PRODUCT_ID],
    "enriched_orders": [s.ORDER_ID],
}


def _ordered(df: DataFrame, kind: str) -> DataFrame:
    keys = [k for k in PREVIEW_ORDER[kind] if k in df.columns]
    rest = [c for c in df.columns if c not in keys]
    return df.orderBy(*[_c(k).asc_nulls_first() for k in keys + rest])


def raw_preview(df: DataFrame, kind: str, n: int = 3) -> DataFrame:
    """A few identifying columns of a raw table, first ``n`` by key."""
    return _ordered(df, kind).select(*PREVIEW_COLUMNS[kind]).limit(n)


def enriched_preview(df: DataFrame, kind: str, n: int = 5) -> DataFrame:
    """The first ``n`` rows (by key) of an enriched table."""
    return _ordered(df, kind).limit(n)


# --- over the profit aggregates (R14-R19) ------------------------------------


def first_rows(aggregate: DataFrame, n: int = 10) -> DataFrame:
    """The first ``n`` rows of an aggregate in its own sort order."""
    return aggregate.limit(n)


def top_customer_trends(by_customer: DataFrame, by_customer_year: DataFrame, n: int = 5) -> DataFrame:
    """Yearly profit of the ``n`` most profitable customers, with each one's total.

    The top-``n`` list is at most ``n`` rows, so broadcasting it is safe; the
    per-customer total is a window over those customers' rows only.
    """
    top = by_customer.limit(n).select(s.CUSTOMER_NAME)
    rows = by_customer_year.join(F.broadcast(top), s.CUSTOMER_NAME, "left_semi")
    total = exact_sum(F.col("Total_Profit"), Window.partitionBy(_c(s.CUSTOMER_NAME)))
    return rows.withColumn("Customer_Total_Profit", round_money(total)).orderBy(
        _c(s.CUSTOMER_NAME).asc_nulls_first(), F.col("Year").asc_nulls_first()
    )


def customer_trends(customers: DataFrame, n: int = 5) -> DataFrame:
    """R16 from ``profit.customer_year_totals``, in one branch: the ``n`` most
    profitable customers are taken with their years and unfolded."""
    top = customers.orderBy(F.col("Total_Profit").desc_nulls_last(), _c(s.CUSTOMER_NAME).asc_nulls_first()).limit(n)
    rows = top.select(_c(s.CUSTOMER_NAME), F.inline("years"))
    total = exact_sum(F.col("Total_Profit"), Window.partitionBy(_c(s.CUSTOMER_NAME)))
    return rows.withColumn("Customer_Total_Profit", round_money(total)).orderBy(
        _c(s.CUSTOMER_NAME).asc_nulls_first(), F.col("Year").asc_nulls_first()
    )


def year_metrics(by_year: DataFrame) -> DataFrame:
    """Total profit, total orders and mean yearly profit."""
    return by_year.agg(
        round_money(_exact_sum("Total_Profit")).alias("Total_Profit"),
        F.sum("Order_Count").alias("Total_Orders"),
        F.round(_mean("Total_Profit"), 2).alias("Average_Profit_Per_Year"),
    )


def customer_metrics_report(by_customer: DataFrame) -> DataFrame:
    """Number of customers and mean, max and min customer profit."""
    return by_customer.agg(
        F.count(F.lit(1)).alias("Total_Customers"),
        F.round(_mean("Total_Profit"), 2).alias("Average_Customer_Profit"),
        F.max("Total_Profit").alias("Max_Customer_Profit"),
        F.min("Total_Profit").alias("Min_Customer_Profit"),
    )


def category_totals(by_year_category: DataFrame) -> DataFrame:
    """Profit per category over all years, highest first."""
    return (
        by_year_category.groupBy(s.CATEGORY)
        .agg(round_money(_exact_sum("Total_Profit")).alias("Category_Profit"))
        .orderBy(F.col("Category_Profit").desc_nulls_last(), _c(s.CATEGORY).asc_nulls_first())
    )
