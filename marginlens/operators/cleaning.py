"""Data-quality rules for orders, customers and products.

Every rule is a lazy ``DataFrame -> DataFrame`` step that applies only when
its column exists (a plan-time check of ``df.columns``; no job runs).  The
order rules run in a fixed sequence: a kept duplicate may later fail the
date or id rules and then its order vanishes.

"Keep first" is made deterministic: rows are ranked inside each key by
``Row ID`` (when present) and then by every other column, and rank 1 is
kept.  Spark plans ``row_number() = 1`` with a partial ``WindowGroupLimit``
before the shuffle, so each map task already trims a key to one row and a hot
key cannot pile up in one reducer.

The cleaning reports replace the reference's many ``count()`` actions with
one job of a few aggregations: each removed row is counted under the first
rule it fails, and no step ranks all rows of a key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, MapType, StructType

from marginlens import schemas as s
from marginlens.functions.dates import parse_date
from marginlens.functions.text import clean_name
from marginlens.plans.session import metrics

_RANK = "__keep_rank"


def _c(name: str) -> Column:
    return F.col(f"`{name}`")


def quote(name: str) -> str:
    """A column name as a SQL identifier."""
    return "`" + name.replace("`", "``") + "`"


def tiebreak_names(df: DataFrame, keys: Sequence[str]) -> list[str]:
    """``Row ID`` first (if present), then every other orderable column."""
    rest = [
        f.name
        for f in df.schema.fields
        if f.name not in keys and not isinstance(f.dataType, (MapType, ArrayType, StructType))
    ]
    if s.ROW_ID in rest:
        rest.remove(s.ROW_ID)
        rest.insert(0, s.ROW_ID)
    return rest


def tiebreak_order(df: DataFrame, keys: Sequence[str]) -> list[Column]:
    return [_c(n).asc_nulls_first() for n in tiebreak_names(df, keys)]


def _order_sql(names: Sequence[str]) -> str:
    return ", ".join(f"{quote(n)} ASC NULLS FIRST" for n in names)


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[Column] | None = None) -> DataFrame:
    """One row per key combination: the first by ``order`` (deterministic).

    The default order is written as one SQL window expression, which the JVM
    parses in a single call instead of one call per column.
    """
    keys = list(keys)
    if order is None:
        rank = F.expr(
            f"row_number() OVER (PARTITION BY {', '.join(quote(k) for k in keys)} "
            f"ORDER BY {_order_sql(tiebreak_names(df, keys))})"
        )
    else:
        rank = F.row_number().over(Window.partitionBy(*[_c(k) for k in keys]).orderBy(*order))
    return df.withColumn(_RANK, rank).filter(f"{_RANK} = 1").drop(_RANK)


# --- single rules -----------------------------------------------------------

def drop_negative_profit(df: DataFrame) -> DataFrame:
    """Keep ``Profit >= 0``; a NULL profit is dropped too (three-valued logic)."""
    return df.filter(_c(s.PROFIT) >= 0) if s.PROFIT in df.columns else df


def drop_null(df: DataFrame, column: str) -> DataFrame:
    """Drop rows whose ``column`` is NULL."""
    return df.filter(_c(column).isNotNull()) if column in df.columns else df


def dedupe_orders(df: DataFrame) -> DataFrame:
    """One line per ``Order ID`` (first by Row ID, then the other columns)."""
    return keep_first(df, [s.ORDER_ID]) if s.ORDER_ID in df.columns else df


def _dates_valid(df: DataFrame) -> Column:
    return parse_date(df, s.ORDER_DATE).isNotNull() & parse_date(df, s.SHIP_DATE).isNotNull()


def drop_unparsable_dates(df: DataFrame) -> DataFrame:
    """C4: both dates must parse as ``d/M/yyyy``; only when both columns exist.

    The original date values are kept; the parsed values are not added.
    """
    if s.ORDER_DATE in df.columns and s.SHIP_DATE in df.columns:
        return df.filter(_dates_valid(df))
    return df


def normalise_customer_names(df: DataFrame) -> DataFrame:
    """ASCII letters and single spaces only, trimmed; NULL stays NULL."""
    if s.CUSTOMER_NAME not in df.columns:
        return df
    return df.withColumn(s.CUSTOMER_NAME, clean_name(_c(s.CUSTOMER_NAME)))


# --- table cleaners ---------------------------------------------------------

def clean_orders(orders: DataFrame) -> DataFrame:
    """C1 -> C2 -> C3 -> C4 -> C5 -> C6, each skipped if its column is absent.

    C1 and C2 reach the scan as pushed filters; C4-C6 run after the dedupe
    and must stay there (they look at non-key columns of the kept row).
    """
    df = drop_negative_profit(orders)
    df = drop_null(df, s.ORDER_ID)
    df = dedupe_orders(df)
    df = drop_unparsable_dates(df)
    df = drop_null(df, s.CUSTOMER_ID)
    return drop_null(df, s.PRODUCT_ID)


def clean_customers(customers: DataFrame) -> DataFrame:
    """Normalise names, drop NULL ``Customer ID``, one row per id."""
    df = normalise_customer_names(customers)
    if s.CUSTOMER_ID in df.columns:
        df = keep_first(drop_null(df, s.CUSTOMER_ID), [s.CUSTOMER_ID])
    return df


def clean_products(products: DataFrame) -> DataFrame:
    """Drop NULL ``Product ID``, one row per id."""
    if s.PRODUCT_ID in products.columns:
        return keep_first(drop_null(products, s.PRODUCT_ID), [s.PRODUCT_ID])
    return products


# --- cleaning reports (C11) -------------------------------------------------
#
# Every rule's removals come from aggregations, never from ranking all rows
# of a key: the duplicate count is "rows that reached the dedupe minus rows it
# kept", and the dedupe itself is the group-limited keep-first above.  A key
# holding a third of the table therefore costs the same as any other.

REPORT_COLUMNS = ["table_name", "step", "rule", "row_count"]
ORDER_RULES = [
    "null_profit", "negative_profit", "null_order_id", "duplicate_order_id",
    "invalid_date", "null_customer_id", "null_product_id",
]


def _report_rows(one_row: DataFrame, table: str, rules: Sequence[str]) -> DataFrame:
    """Unpivot a one-row frame (``original``, one count per rule) into report rows.

    Rows: ``original``, each rule's removals in order, ``final`` and
    ``total_removed``.  A rule whose column is absent reports 0.
    """
    removed = sum((F.col(r) for r in rules[1:]), F.col(rules[0]))
    names = ["original", *rules]
    entries = [
        F.struct(F.lit(i).alias("step"), F.lit(n).alias("rule"), F.col(n).cast("bigint").alias("row_count"))
        for i, n in enumerate(names)
    ]
    entries += [
        F.struct(F.lit(len(names)).alias("step"), F.lit("final").alias("rule"),
                 (F.col("original") - removed).cast("bigint").alias("row_count")),
        F.struct(F.lit(len(names) + 1).alias("step"), F.lit("total_removed").alias("rule"),
                 removed.cast("bigint").alias("row_count")),
    ]
    return one_row.select(F.inline(F.array(*entries))).select(
        F.lit(table).alias("table_name"), "step", "rule", "row_count"
    )


def _zero() -> Column:
    return F.lit(0).cast("bigint")


def orders_cleaning_report(orders: DataFrame) -> DataFrame:
    """Rows removed by each order rule, in rule order.

    ``negative_profit`` counts ``Profit < 0`` as the reference reports it;
    NULL profits, which the same rule also drops, are reported separately.
    One pass: an aggregation per order id, which Spark combines on the map
    side, holds the rules' counts and the line that the dedupe keeps (the
    smallest struct of the tie-break columns, in its order); a second, global
    one adds them up and looks at the kept lines.
    """
    cols = orders.columns
    profit, oid = _c(s.PROFIT), _c(s.ORDER_ID)
    has_id = s.ORDER_ID in cols
    passed = (profit >= 0) if s.PROFIT in cols else F.lit(True)
    line = F.struct(*[_c(n) for n in tiebreak_names(orders, [s.ORDER_ID])])
    counts = [
        F.count(F.lit(1)).alias("__n"),
        (F.count_if(profit.isNull()) if s.PROFIT in cols else _zero()).alias("null_profit"),
        (F.count_if(profit < 0) if s.PROFIT in cols else _zero()).alias("negative_profit"),
    ]
    if has_id:
        per_id = orders.groupBy(oid).agg(
            *counts, F.count_if(passed).alias("__reached"), F.min(F.when(passed, line)).alias("__kept"))
        no_id = oid.isNull()
    else:  # nothing is dropped for its id or deduplicated: every line is its own group
        per_id = orders.select(
            F.lit(1).alias("__n"), (profit.isNull() if s.PROFIT in cols else F.lit(False)).cast("long").alias("null_profit"),
            ((profit < 0) if s.PROFIT in cols else F.lit(False)).cast("long").alias("negative_profit"),
            F.coalesce(passed, F.lit(False)).cast("long").alias("__reached"), line.alias("__kept"))
        no_id = F.lit(False)
    flat = per_id.select(
        "__n", "null_profit", "negative_profit", "__reached", no_id.alias("__no_id"),
        *[F.col(f"__kept.{quote(n)}") for n in tiebreak_names(orders, [s.ORDER_ID])])
    later = []
    if s.ORDER_DATE in cols and s.SHIP_DATE in cols:
        later.append(("invalid_date", ~_dates_valid(flat)))
    if s.CUSTOMER_ID in cols:
        later.append(("null_customer_id", _c(s.CUSTOMER_ID).isNull()))
    if s.PRODUCT_ID in cols:
        later.append(("null_product_id", _c(s.PRODUCT_ID).isNull()))
    # Each kept line counts for the first later rule it fails.
    failure = F.lit(None).cast("string")
    for name, condition in reversed(later):
        failure = F.when(condition, name).otherwise(failure)
    no_id, kept = F.col("__no_id"), ~F.col("__no_id") & (F.col("__reached") > 0)
    removed = {
        "null_profit": F.sum("null_profit"),
        "negative_profit": F.sum("negative_profit"),
        "null_order_id": F.sum(F.when(no_id, F.col("__reached"))),
        "duplicate_order_id": F.sum(F.when(kept, F.col("__reached") - 1)),
        **{name: F.count_if(kept & (F.col("__failure") == name)) for name in ORDER_RULES[4:]},
    }
    one_row = flat.withColumn("__failure", failure).agg(
        F.coalesce(F.sum("__n"), _zero()).alias("original"),
        *[F.coalesce(value, _zero()).cast("bigint").alias(name) for name, value in removed.items()])
    return _report_rows(one_row, "orders", ORDER_RULES)


def _id_table_report(df: DataFrame, key: str, table: str, prefix: str) -> DataFrame:
    """NULL ids and repeated ids, from counts alone (distinct count is map-side combined)."""
    null_rule, dup_rule = f"null_{prefix}_id", f"duplicate_{prefix}_id"
    if key not in df.columns:
        one_row = df.agg(F.count(F.lit(1)).alias("original"), _zero().alias(null_rule), _zero().alias(dup_rule))
    else:
        one_row = df.agg(
            F.count(F.lit(1)).alias("original"),
            F.count_if(_c(key).isNull()).alias(null_rule),
            (F.count(_c(key)) - F.count_distinct(_c(key))).alias(dup_rule),
        )
    return _report_rows(one_row, table, [null_rule, dup_rule])


def customers_cleaning_report(customers: DataFrame) -> DataFrame:
    """Rows removed from customers by the NULL-id and duplicate-id rules."""
    return _id_table_report(customers, s.CUSTOMER_ID, "customers", "customer")


def products_cleaning_report(products: DataFrame) -> DataFrame:
    return _id_table_report(products, s.PRODUCT_ID, "products", "product")


def cleaning_report(
    customers: DataFrame, orders: DataFrame, products: DataFrame, orders_report: DataFrame | None = None
) -> DataFrame:
    """C11 for all three tables as one DataFrame ``(table_name, step, rule, row_count)``;
    ``orders_report`` is that of an earlier pass over the orders."""
    return (
        (orders_cleaning_report(orders) if orders_report is None else orders_report)
        .unionByName(customers_cleaning_report(customers))
        .unionByName(products_cleaning_report(products))
    )


# --- cleaning, report and profile in one pass ---------------------------------
#
# ``DataFrame.observe`` gathers counts while the cleaned table is written.  The
# rules before the dedupe are counted in its map stage, whose tasks Spark may
# run again after a lost executor and then counts twice; the metrics therefore
# also count the task contributions, and a table whose ranges did not all
# contribute once is counted again from its source.

_PART, _FIRST = "__part", "__first"


class ObservedOrders:
    """The cleaned orders of :func:`clean_orders`, written, and what that pass saw.

    ``cleaned`` is the written table, ``hot`` the hot ids of ``keys``
    (``operators.joins``), ``report()`` the rows of
    :func:`orders_cleaning_report`, ``rows`` the number of raw orders and
    ``sample`` the smallest and the largest raw row (by all columns, NULLs
    first), None for an empty table.
    """

    def __init__(self, orders: DataFrame, keys: Sequence[str] = ()):
        from marginlens.operators.joins import written_with_hot_keys

        self._orders = orders
        cols = orders.columns
        passed = (_c(s.PROFIT) >= 0) if s.PROFIT in cols else F.lit(True)
        has_id = s.ORDER_ID in cols
        no_id = _c(s.ORDER_ID).isNull() if has_id else F.lit(False)
        row = F.struct(*[_c(c) for c in cols])
        before, after = Observation(), Observation()
        marked = orders.withColumn(_PART, F.spark_partition_id()).withColumn(
            _FIRST, F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1) == 0)
        seen = marked.observe(
            before, F.count(F.lit(1)).alias("original"),
            (F.count_if(_c(s.PROFIT).isNull()) if s.PROFIT in cols else F.sum(F.lit(0))).alias("null_profit"),
            (F.count_if(_c(s.PROFIT) < 0) if s.PROFIT in cols else F.sum(F.lit(0))).alias("negative_profit"),
            F.count_if(passed & no_id).alias("null_order_id"), F.count_if(passed & ~no_id).alias("reached"),
            F.min(row).alias("low"), F.max(row).alias("high"),
            F.count_if(_FIRST).alias("tasks"), F.collect_set(_PART).alias("parts"))
        kept = dedupe_orders(drop_null(drop_negative_profit(seen.drop(_PART, _FIRST)), s.ORDER_ID))
        later = []
        if s.ORDER_DATE in cols and s.SHIP_DATE in cols:
            later.append(("invalid_date", ~_dates_valid(kept)))
        later += [(f"null_{name}", _c(c).isNull()) for name, c in (("customer_id", s.CUSTOMER_ID), ("product_id", s.PRODUCT_ID)) if c in cols]
        failure = F.lit("")
        for name, condition in reversed(later):
            failure = F.when(condition, name).otherwise(failure)
        checked = kept.withColumn("__failure", failure).observe(
            after, F.count(F.lit(1)).alias("kept"),
            *[F.count_if(F.col("__failure") == name).alias(name) for name in ORDER_RULES[4:]])
        self.cleaned, self.hot = written_with_hot_keys(checked.filter("__failure = ''").drop("__failure"), list(keys))
        self._before, self._after = metrics(before), metrics(after)

    @property
    def exact(self) -> bool:
        """Whether every range of the source contributed once."""
        return None not in (self._before, self._after) and self._before["tasks"] == len(self._before["parts"])

    @property
    def rows(self) -> int:
        return self._before["original"] if self.exact else self._orders.count()

    @property
    def sample(self) -> tuple | None:
        if self._before is None:
            row = F.struct(*[_c(c) for c in self._orders.columns])
            low, high = self._orders.agg(F.min(row), F.max(row)).first()
        else:
            low, high = self._before["low"], self._before["high"]
        return None if low is None else (low, high)

    def report(self) -> DataFrame:
        if not self.exact:
            return orders_cleaning_report(self._orders)
        seen = {**self._before, **self._after}
        seen["duplicate_order_id"] = seen["reached"] - seen["kept"]
        one = self._orders.sparkSession.range(1).select(
            F.lit(seen["original"]).alias("original"), *[F.lit(seen[rule] or 0).cast("bigint").alias(rule) for rule in ORDER_RULES])
        return _report_rows(one, "orders", ORDER_RULES)
