"""Named temp views over the raw and enriched tables.

Views are session-scoped names for SQL users.  Library code itself never
reads through them: operators take DataFrames, and the SQL reports pass their
input as a parameter, so concurrent callers cannot clobber each other's view.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

# Fixed view names.
RAW_VIEWS = {"customers": "raw_customers_vw", "orders": "raw_orders_vw", "products": "raw_products_vw"}
ENRICHED_VIEWS = {
    "enriched_customers": "enriched_customers_view",
    "enriched_products": "enriched_products_view",
    "enriched_orders": "enriched_orders_view",
    "profit_summary": "profit_summary_view",
}


def _register(frames: dict[str, DataFrame], names: dict[str, str]) -> dict[str, str]:
    registered = {}
    for kind, df in frames.items():
        if kind not in names:
            raise KeyError(f"no view name for {kind!r}; expected one of {sorted(names)}")
        df.createOrReplaceTempView(names[kind])
        registered[kind] = names[kind]
    return registered


def register_raw_views(customers: DataFrame, orders: DataFrame, products: DataFrame) -> dict[str, str]:
    """``raw_customers_vw``, ``raw_orders_vw``, ``raw_products_vw``."""
    return _register({"customers": customers, "orders": orders, "products": products}, RAW_VIEWS)


def register_enriched_views(**frames: DataFrame) -> dict[str, str]:
    """Any of ``enriched_customers``, ``enriched_products``,
    ``enriched_orders``, ``profit_summary`` as their fixed view names."""
    return _register(frames, ENRICHED_VIEWS)
