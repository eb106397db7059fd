"""Declared schemas, column names and fixed label values.

The three source tables carry business-style column names (with spaces and
hyphens), so SQL against them needs back-ticks.  Every field is nullable.
"""

from __future__ import annotations

from pyspark.sql.types import (
    DecimalType,
    DoubleType,
    IntegerType,
    StringType,
    StructField,
    StructType,
)

# --- Column names -----------------------------------------------------------
ROW_ID = "Row ID"
ORDER_ID = "Order ID"
ORDER_DATE = "Order Date"
SHIP_DATE = "Ship Date"
SHIP_MODE = "Ship Mode"
CUSTOMER_ID = "Customer ID"
CUSTOMER_NAME = "Customer Name"
PRODUCT_ID = "Product ID"
PRODUCT_NAME = "Product Name"
CATEGORY = "Category"
SUB_CATEGORY = "Sub-Category"
COUNTRY = "Country"
QUANTITY = "Quantity"
PRICE = "Price"
DISCOUNT = "Discount"
PROFIT = "Profit"
UNIT_PRICE = "Price per product"


def _strings(*names: str) -> list[StructField]:
    return [StructField(n, StringType(), True) for n in names]


CUSTOMERS_SCHEMA = StructType(
    _strings(
        CUSTOMER_ID, CUSTOMER_NAME, "email", "phone", "address", "Segment",
        COUNTRY, "City", "State", "Postal Code", "Region",
    )
)

ORDERS_SCHEMA = StructType(
    [
        StructField(ROW_ID, IntegerType(), True),
        *_strings(ORDER_ID, ORDER_DATE, SHIP_DATE, SHIP_MODE, CUSTOMER_ID, PRODUCT_ID),
        StructField(QUANTITY, IntegerType(), True),
        StructField(PRICE, DoubleType(), True),
        StructField(DISCOUNT, DoubleType(), True),
        StructField(PROFIT, DoubleType(), True),
    ]
)

PRODUCTS_SCHEMA = StructType(
    [
        *_strings(PRODUCT_ID, CATEGORY, SUB_CATEGORY, PRODUCT_NAME, "State"),
        StructField(UNIT_PRICE, DoubleType(), True),
    ]
)

# The 13 columns of the denormalised orders table, in output order.
ENRICHED_ORDER_COLUMNS = [
    ORDER_ID, ORDER_DATE, SHIP_DATE, SHIP_MODE, CUSTOMER_NAME, COUNTRY,
    CATEGORY, SUB_CATEGORY, PRODUCT_NAME, QUANTITY, PRICE, DISCOUNT, PROFIT,
]

# Keys of the profit summary, in grouping and sort order.
SUMMARY_KEYS = ["Year", CATEGORY, SUB_CATEGORY, CUSTOMER_NAME]

# Money is summed as a wide exact decimal, so sums do not depend on
# partitioning, and handed out as double (functions.money).
MONEY = DecimalType(38, 12)

# --- Fixed values (must equal the reference's for equal results) ------------
# Dates in the source files are day/month/year without zero padding.
DATE_PATTERN = "d/M/yyyy"
# Churn tiers: more than 180 days -> High, more than 90 -> Medium, else Low.
CHURN_HIGH, CHURN_MEDIUM, CHURN_LOW = "High Risk", "Medium Risk", "Low Risk"
CHURN_HIGH_DAYS, CHURN_MEDIUM_DAYS = 180, 90
# Price position from ntile(4) within a category: 4 Premium, 2-3 Mid-Range, 1 Budget.
PRICE_PREMIUM, PRICE_MID, PRICE_BUDGET = "Premium", "Mid-Range", "Budget"
PRICE_TIERS = 4
# Sales velocity: total quantity above 100 Fast, above 20 Medium, else Slow.
VELOCITY_FAST, VELOCITY_MEDIUM, VELOCITY_SLOW = "Fast Moving", "Medium Moving", "Slow Moving"
VELOCITY_FAST_QTY, VELOCITY_MEDIUM_QTY = 100, 20
# Customer names keep ASCII letters and whitespace only.
NAME_DROP_PATTERN = r"[^a-zA-Z\s]"
NAME_SPACE_PATTERN = r"\s+"
