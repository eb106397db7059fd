"""Profit summary and profit aggregates (A1-A5).

All of them group the denormalised orders; ``Year`` comes from the parsed
``Order Date`` (text, date or timestamp), and an unparsable date lands in a
NULL-year group.  Profit is summed exactly (decimal) and rounded HALF_UP to
cents.  Grouping is by customer *name*: two customers whose names clean to
the same text are one group, as in the reference.

``sort=False`` leaves an aggregate unsorted for callers that sort or join
it again: a global sort is a range shuffle plus a sampling job.

Order counts differ on purpose: the summary counts rows with an ``Order ID``
(``count``), the four aggregates count distinct ids.  The denormalised
orders built by ``enriched_orders`` hold one row per ``Order ID`` (the dedupe
runs before the joins and both dimension keys are unique after cleaning), so
callers that pass that table can say ``unique_orders=True``: the distinct
count becomes a plain count, which drops the extra shuffle on
(group keys, order id) that a distinct aggregate needs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marginlens import schemas as s
from marginlens.functions.dates import order_date
from marginlens.functions.money import exact_sum, exact_totals, merged_totals, partial_totals, round_money, total_of
from marginlens.schemas import MONEY

YEAR = "Year"


def _c(name: str) -> Column:
    return F.col(f"`{name}`")


def _with_year(df: DataFrame) -> DataFrame:
    return df.withColumn(YEAR, F.year(order_date(df)))


def _rounded(totals: DataFrame, keys: list[str]) -> DataFrame:
    return totals.select(*[_c(k) for k in keys], round_money(F.col("Total_Profit")).alias("Total_Profit"), "Order_Count")


AMOUNT, COUNT = ["Total_Profit"], ["Order_Count"]


def profit_base(enriched: DataFrame) -> DataFrame:
    """Exact partial sums per Year x Category x Sub-Category x Customer Name.

    All five aggregates follow from it (``from_base=True``), so the
    denormalised orders are shuffled once for them.  It holds one row a group,
    more only where amounts of very different magnitudes meet.
    """
    return partial_totals(_with_year(enriched), s.SUMMARY_KEYS, {"Total_Profit": _c(s.PROFIT)}, {"Order_Count": _c(s.ORDER_ID)})


def profit_summary(enriched: DataFrame, from_base: bool = False) -> DataFrame:
    """A1: profit and order lines per Year x Category x Sub-Category x Customer Name.

    No negative-profit filter: losses count.  Sorted by the four keys.
    """
    base = enriched if from_base else profit_base(enriched)
    totals = merged_totals(base, s.SUMMARY_KEYS, AMOUNT, COUNT, grouped=True)
    return _rounded(totals, s.SUMMARY_KEYS).orderBy(*[_c(k).asc_nulls_first() for k in s.SUMMARY_KEYS])


def _aggregate(
    enriched: DataFrame, keys: list[str], order: list[Column], unique_orders: bool, sort: bool, from_base: bool
) -> DataFrame:
    if from_base:
        out = _rounded(merged_totals(enriched, keys, AMOUNT, COUNT), keys)
    elif unique_orders:
        amounts, counts = {"Total_Profit": _c(s.PROFIT)}, {"Order_Count": _c(s.ORDER_ID)}
        out = _rounded(exact_totals(_with_year(enriched), keys, amounts, counts), keys)
    else:
        out = _with_year(enriched).groupBy(*[_c(k) for k in keys]).agg(
            round_money(exact_sum(_c(s.PROFIT))).alias("Total_Profit"), F.count_distinct(_c(s.ORDER_ID)).alias("Order_Count"))
    return out.orderBy(*order) if sort else out


def profit_by_year(enriched: DataFrame, unique_orders: bool = False, sort: bool = True, from_base: bool = False) -> DataFrame:
    """A2: ``Year, Total_Profit, Order_Count`` ordered by year."""
    return _aggregate(enriched, [YEAR], [_c(YEAR).asc_nulls_first()], unique_orders, sort, from_base)


def profit_by_year_category(
    enriched: DataFrame, unique_orders: bool = False, sort: bool = True, from_base: bool = False
) -> DataFrame:
    """A3: ``Year, Category, Total_Profit, Order_Count`` ordered by year, category."""
    keys = [YEAR, s.CATEGORY]
    return _aggregate(enriched, keys, [_c(k).asc_nulls_first() for k in keys], unique_orders, sort, from_base)


def profit_by_customer(
    enriched: DataFrame, unique_orders: bool = False, sort: bool = True, from_base: bool = False
) -> DataFrame:
    """A4: ``Customer Name, Total_Profit, Order_Count``, most profitable first.

    Equal profits are ordered by name so a top-N cut is deterministic.
    """
    order = [F.col("Total_Profit").desc_nulls_last(), _c(s.CUSTOMER_NAME).asc_nulls_first()]
    return _aggregate(enriched, [s.CUSTOMER_NAME], order, unique_orders, sort, from_base)


def profit_by_customer_year(
    enriched: DataFrame, unique_orders: bool = False, sort: bool = True, from_base: bool = False
) -> DataFrame:
    """A5: ``Customer Name, Year, Total_Profit, Order_Count`` ordered by year, name."""
    order = [_c(YEAR).asc_nulls_first(), _c(s.CUSTOMER_NAME).asc_nulls_first()]
    return _aggregate(enriched, [s.CUSTOMER_NAME, YEAR], order, unique_orders, sort, from_base)


def customer_year_totals(enriched: DataFrame) -> DataFrame:
    """``Customer Name, Total_Profit, years``: a row per customer, with an array
    of ``struct(Year, Total_Profit, Order_Count)``; all profits rounded.

    One shuffle of partial sums by (customer, year), one by customer.
    """
    parts = partial_totals(_with_year(enriched), [s.CUSTOMER_NAME, YEAR], {"p": _c(s.PROFIT)}, {"Order_Count": _c(s.ORDER_ID)})
    per_year = parts.groupBy(_c(s.CUSTOMER_NAME)).agg(F.collect_list(F.struct(
        F.col(YEAR), F.col("p__window").alias("window"), F.col("p__money").alias("money"), F.col("p__odd").alias("odd"),
        F.col("p__special").alias("special"), F.col("Order_Count"))).alias("parts"))

    def total(rows: str) -> str:
        def added(field: str, kind: str) -> str:
            some = f"FILTER(TRANSFORM({rows}, r -> CAST(r.{field} AS {kind})), v -> v IS NOT NULL)"
            return f"CASE WHEN SIZE({some}) > 0 THEN AGGREGATE({some}, CAST(0 AS {kind}), (t, v) -> CAST(t + v AS {kind})) END"

        odd = f"TRANSFORM(FILTER({rows}, r -> r.window IS NOT NULL), r -> STRUCT(r.window AS window, r.odd AS odd))"
        return f"ROUND({total_of(added('money', MONEY.simpleString()), added('special', 'DOUBLE'), odd)}, 2)"

    of_year = "FILTER(parts, r -> r.Year <=> y)"
    orders = f"AGGREGATE({of_year}, 0L, (t, r) -> t + r.Order_Count)"
    years = f"TRANSFORM(ARRAY_DISTINCT(TRANSFORM(parts, r -> r.Year)), y -> STRUCT(y AS Year, {total(of_year)} AS Total_Profit, {orders} AS Order_Count))"
    return per_year.selectExpr(f"`{s.CUSTOMER_NAME}`", f"{total('parts')} AS Total_Profit", f"{years} AS years")
