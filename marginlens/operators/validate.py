"""Validators (V1-V5) as report DataFrames.

The reference prints a warning per failed check and returns its input.
Here each validator is one aggregation pass that yields rows
``(check, violations, passed)``; the caller decides what to do with them
(show, fail the job, write to a quality table).

Duplicate-key checks group by the key with partial aggregation, so a hot key
collapses map-side; the row-level checks ride along in the same groups, and
one global aggregation of the (much smaller) grouped rows produces the
report.  Two-input checks (enriched vs. original row counts) union the two
one-row aggregates instead of joining them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marginlens import schemas as s

REPORT_COLUMNS = ["check", "violations", "passed"]


def _c(name: str) -> Column:
    return F.col(f"`{name}`")


def _report(one_row: DataFrame, checks: Sequence[str], passed: dict[str, Column] | None = None) -> DataFrame:
    """Unpivot a one-row frame of violation counts into report rows."""
    passed = passed or {}
    entries = [
        F.struct(
            F.lit(name).alias("check"),
            F.col(name).cast("bigint").alias("violations"),
            passed.get(name, F.col(name) == 0).alias("passed"),
        )
        for name in checks
    ]
    return one_row.select(F.inline(F.array(*entries)))


def _invalid(column: str, allowed: Sequence[str]) -> Column:
    return _c(column).isNotNull() & ~_c(column).isin(*allowed)


def _keyed_checks(df: DataFrame, key: str, row_checks: dict[str, Column]) -> DataFrame:
    """One row: NULL keys, duplicate key groups, and a count per row check."""
    per_key = df.groupBy(_c(key).alias("__key")).agg(
        F.count(F.lit(1)).alias("__n"),
        *[F.count_if(cond).alias(name) for name, cond in row_checks.items()],
    )
    return per_key.agg(
        F.coalesce(F.sum(F.when(F.col("__key").isNull(), F.col("__n"))), F.lit(0)).alias("null_key"),
        F.count_if(F.col("__n") > 1).alias("duplicate_key_groups"),
        *[F.coalesce(F.sum(name), F.lit(0)).alias(name) for name in row_checks],
    )


def validate_enriched_customers(df: DataFrame) -> DataFrame:
    """V1: NULL ids, duplicate id groups (NULL ids group together), negative
    sales or profit, churn labels outside the three tiers (NULL allowed)."""
    one = _keyed_checks(
        df,
        s.CUSTOMER_ID,
        {
            "negative_sales_or_profit": (F.col("total_sales") < 0) | (F.col("total_profit") < 0),
            "invalid_churn_risk_score": _invalid("churn_risk_score", [s.CHURN_LOW, s.CHURN_MEDIUM, s.CHURN_HIGH]),
        },
    ).withColumnsRenamed({"null_key": "null_customer_id", "duplicate_key_groups": "duplicate_customer_id"})
    return _report(
        one,
        ["null_customer_id", "duplicate_customer_id", "negative_sales_or_profit", "invalid_churn_risk_score"],
    )


def validate_enriched_products(df: DataFrame) -> DataFrame:
    """V2: NULL ids, duplicate id groups, negative quantity, and price
    position / velocity labels outside their tiers (NULL allowed)."""
    one = _keyed_checks(
        df,
        s.PRODUCT_ID,
        {
            "negative_quantity": F.col("total_quantity_sold") < 0,
            "invalid_price_position": _invalid("price_position", [s.PRICE_PREMIUM, s.PRICE_MID, s.PRICE_BUDGET]),
            "invalid_inventory_velocity": _invalid(
                "inventory_velocity", [s.VELOCITY_FAST, s.VELOCITY_MEDIUM, s.VELOCITY_SLOW]
            ),
        },
    ).withColumnsRenamed({"null_key": "null_product_id", "duplicate_key_groups": "duplicate_product_id"})
    return _report(
        one,
        [
            "null_product_id", "duplicate_product_id", "negative_quantity",
            "invalid_price_position", "invalid_inventory_velocity",
        ],
    )


ORDER_KEY_COLUMNS = [s.ORDER_ID, s.CUSTOMER_NAME, s.PRODUCT_NAME, s.ORDER_DATE]


def _null_name(column: str) -> str:
    return "null_" + column.lower().replace(" ", "_").replace("-", "_")


def validate_enriched_orders(enriched: DataFrame, original: DataFrame | int) -> DataFrame:
    """V3: enriched row count vs. the original orders or their number
    (``violations`` = rows lost, negative if rows were gained), NULLs in the
    key columns, non-positive quantities and negative prices."""
    checks = {_null_name(c): _c(c).isNull() for c in ORDER_KEY_COLUMNS}
    checks["non_positive_quantity"] = _c(s.QUANTITY) <= 0
    checks["negative_price"] = _c(s.PRICE) < 0
    enriched_counts = enriched.agg(
        F.count(F.lit(1)).alias("enriched_rows"), *[F.count_if(c).alias(n) for n, c in checks.items()]
    )
    if isinstance(original, int):
        original_counts = enriched.sparkSession.range(1).select(F.lit(original).cast("bigint").alias("original_rows"))
    else:
        original_counts = original.agg(F.count(F.lit(1)).alias("original_rows"))
    both = enriched_counts.unionByName(original_counts, allowMissingColumns=True).agg(
        *[F.sum(n).alias(n) for n in ["enriched_rows", "original_rows", *checks]]
    )
    one = both.withColumn("row_count_mismatch", F.col("original_rows") - F.col("enriched_rows"))
    return _report(one, ["row_count_mismatch", *checks])


def _missing(orders: DataFrame, dimension: DataFrame, key: str, flag: str) -> DataFrame:
    """Ids of the orders that the dimension lacks; the orders' ids are made distinct map-side first."""
    ids = orders.select(_c(key)).where(_c(key).isNotNull()).distinct()
    return ids.join(dimension.select(_c(key)), key, "left_anti").withColumn(flag, F.lit(True))


def orphan_orders(orders: DataFrame, customers: DataFrame, products: DataFrame) -> DataFrame:
    """The cleaned orders that the denormalised table loses, with
    ``no_customer`` and ``no_product``: no customer or product has their id.

    Only lists of missing ids meet the orders, so Spark broadcasts them, or
    filters the orders by a Bloom filter of them, where they are few.
    """
    flagged = orders
    for dimension, key, flag in ((customers, s.CUSTOMER_ID, "no_customer"), (products, s.PRODUCT_ID, "no_product")):
        flagged = flagged.join(_missing(orders, dimension, key, flag), key, "left")
    flags = [F.coalesce(F.col(flag), F.lit(False)).alias(flag) for flag in ("no_customer", "no_product")]
    return flagged.where("no_customer OR no_product").select(*[_c(c) for c in orders.columns], *flags)


def orphan_report(orders: DataFrame, customers: DataFrame, products: DataFrame) -> DataFrame:
    """V3's lost rows by cause: orders without customer, without product, without both, and all lost.

    One pass over the orders counts each pair of ids map-side, so an id that
    holds a large share of the orders brings at most a row per id it meets.
    """
    pairs = orders.groupBy(_c(s.CUSTOMER_ID), _c(s.PRODUCT_ID)).agg(F.count(F.lit(1)).alias("n"))
    for dimension, key, flag in ((customers, s.CUSTOMER_ID, "has_customer"), (products, s.PRODUCT_ID, "has_product")):
        pairs = pairs.join(dimension.select(_c(key), F.lit(True).alias(flag)), key, "left")
    no_customer, no_product = F.col("has_customer").isNull(), F.col("has_product").isNull()
    checks = {
        "missing_customer": no_customer, "missing_product": no_product, "missing_both": no_customer & no_product,
        "lost_orders": no_customer | no_product,
    }
    one = pairs.agg(*[F.coalesce(F.sum(F.when(condition, F.col("n"))), F.lit(0)).alias(name) for name, condition in checks.items()])
    return _report(one, list(checks))


def validate_profit_summary(summary: DataFrame, enriched: DataFrame) -> DataFrame:
    """V4: NULLs in each key, duplicate rows on the keys (total minus
    distinct), NULL profit, non-positive order counts, and more summary rows
    than enriched order rows (``violations`` = the excess)."""
    keys = s.SUMMARY_KEYS
    per_key = summary.groupBy(*[_c(k) for k in keys]).agg(
        F.count(F.lit(1)).alias("__n"),
        F.count_if(F.col("Total_Profit").isNull()).alias("null_total_profit"),
        F.count_if(F.col("Order_Count") <= 0).alias("non_positive_order_count"),
    )
    summary_counts = per_key.agg(
        *[F.coalesce(F.sum(F.when(_c(k).isNull(), F.col("__n"))), F.lit(0)).alias(_null_name(k)) for k in keys],
        (F.coalesce(F.sum("__n"), F.lit(0)) - F.count(F.lit(1))).alias("duplicate_rows"),
        F.coalesce(F.sum("null_total_profit"), F.lit(0)).alias("null_total_profit"),
        F.coalesce(F.sum("non_positive_order_count"), F.lit(0)).alias("non_positive_order_count"),
        F.coalesce(F.sum("__n"), F.lit(0)).alias("summary_rows"),
    )
    source_counts = enriched.agg(F.count(F.lit(1)).alias("source_rows"))
    names = [*[_null_name(k) for k in keys], "duplicate_rows", "null_total_profit", "non_positive_order_count"]
    both = summary_counts.unionByName(source_counts, allowMissingColumns=True).agg(
        *[F.sum(n).alias(n) for n in [*names, "summary_rows", "source_rows"]]
    )
    one = both.withColumn(
        "summary_exceeds_source", F.greatest(F.col("summary_rows") - F.col("source_rows"), F.lit(0))
    )
    return _report(one, [*names, "summary_exceeds_source"])


def validate_profit_aggregate(aggregate: DataFrame) -> DataFrame:
    """V5: an empty aggregate fails (``valid`` false); NULL profit, NULL or
    non-positive order counts are reported but, as in the reference, do not
    make it invalid."""
    one = aggregate.agg(
        F.count(F.lit(1)).alias("__rows"),
        F.count_if(F.col("Total_Profit").isNull()).alias("null_total_profit"),
        F.count_if(F.col("Order_Count").isNull()).alias("null_order_count"),
        F.count_if(F.col("Order_Count") <= 0).alias("non_positive_order_count"),
    ).withColumn("empty_result", F.when(F.col("__rows") == 0, 1).otherwise(0))
    one = one.withColumn("valid", F.col("empty_result"))
    return _report(
        one,
        ["empty_result", "null_total_profit", "null_order_count", "non_positive_order_count", "valid"],
        passed={"valid": F.col("__rows") > 0},
    )


def is_valid(report: DataFrame) -> bool:
    """Driver-side verdict of a V5 report (a handful of rows)."""
    row = report.filter(F.col("check") == "valid").select("passed").first()
    return bool(row and row[0])
