"""Denormalised orders."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marginlens import schemas as s
from marginlens.operators.cleaning import clean_customers, clean_orders, clean_products, quote
from marginlens.operators.joins import BROADCAST_KEYS, hot_keys, salted_join, split_join, written_with_hot_keys
from marginlens.plans.session import ensure_checkpoint_dir

DIMENSION_KEYS = [s.CUSTOMER_ID, s.PRODUCT_ID]


def _c(name: str) -> Column:
    return F.col(f"`{name}`")


def enriched_orders(
    orders: DataFrame,
    customers: DataFrame,
    products: DataFrame,
    clean: bool = True,
    hot_key_rows: int | None = None,
    salt_buckets: int = 32,
    broadcast_keys: int = BROADCAST_KEYS,
    split_hot: bool = True,
    hot: dict[str, dict[int, list]] | None = None,
) -> DataFrame:
    """Orders inner-joined to customers and products, ``Profit`` rounded to cents.

    Orders whose customer or product is missing drop out (inner joins).  The
    dimensions are cut to the columns the output needs before joining, which
    also leaves out the ``State`` column both of them carry.  No join hint:
    Spark broadcasts a dimension only when its measured size is under the
    broadcast threshold, and AQE re-plans at run time.

    A customer or product id that holds a large share of the orders would
    fill one task of a shuffle join.  By default the cleaned orders are written
    as a checkpoint, that write finds such ids, and their orders are cut into
    parts (``operators.joins``).  ``hot`` takes the ids of an earlier write of
    ``orders``; ``split_hot=False`` joins plainly and runs no job.
    ``hot_key_rows`` instead salts every id with at least that many orders over
    ``salt_buckets`` tasks, from counts.  The rows are the same every way.
    """
    if clean:
        orders, customers, products = clean_orders(orders), clean_customers(customers), clean_products(products)
    customer_cols = customers.select(s.CUSTOMER_ID, s.CUSTOMER_NAME, s.COUNTRY)
    product_cols = products.select(s.PRODUCT_ID, s.CATEGORY, s.SUB_CATEGORY, s.PRODUCT_NAME)
    if hot_key_rows is None:
        if hot is None and split_hot:
            orders, hot = written_with_hot_keys(orders, DIMENSION_KEYS)
        joined = orders
        for dim, k in ((customer_cols, s.CUSTOMER_ID), (product_cols, s.PRODUCT_ID)):
            joined = split_join(joined, dim, k, (hot or {}).get(k, {}))
    else:
        # The orders are written once; both hot lists and the joins read that copy.
        ensure_checkpoint_dir(orders.sparkSession)
        orders = orders.checkpoint(eager=True)
        lists = {k: hot_keys(orders, k, hot_key_rows).checkpoint(eager=True) for k in DIMENSION_KEYS}
        joined = orders
        for dim, k in ((customer_cols, s.CUSTOMER_ID), (product_cols, s.PRODUCT_ID)):
            joined = salted_join(joined, dim, k, hot_key_rows, salt_buckets, broadcast_keys, lists[k])
    # One projection: the 12 kept columns and the profit rounded to cents, once, on the double.
    return joined.selectExpr(
        *[quote(c) for c in s.ENRICHED_ORDER_COLUMNS if c != s.PROFIT],
        f"ROUND({quote(s.PROFIT)}, 2) AS {quote(s.PROFIT)}",
    ).select(*s.ENRICHED_ORDER_COLUMNS)


def profitable_orders(enriched: DataFrame) -> DataFrame:
    """Enriched orders with ``Profit >= 0``."""
    return enriched.filter(_c(s.PROFIT) >= 0)
