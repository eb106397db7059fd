"""End-to-end pipeline.

``run_pipeline`` returns a mapping of every output of the reference's main
program: profiles, the cleaning report, the cleaned tables, enriched customers
and products, the denormalised orders, the profit summary and aggregates, and
one validation report.  An output's plan is built when it is asked for, from
the plans that it needs, and nothing else is; the caller picks the actions
(show, write, count).

The sources are cleaned once and every output is derived from the same
cleaned frames.  Spark re-executes a shared input for each action, so when
several outputs are materialised, ``materialize=True`` writes the cleaned
orders, the denormalised orders and the base of the profit aggregates (the
large tables, each read by many outputs) once, when first asked for, as reliable checkpoints
in the session's ``spark.checkpoint.dir``: later actions read those copies, and
a lost executor does not force the cleaning and joins to rerun.  The raw orders
are then scanned once: the pass that cleans them also finds the hot ids and
counts what the cleaning report, the profile and the validation say.  Those
writes and the range price tiers' one (see ``operators.products``) are the only
jobs that asking for an output may start.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import cached_property, reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marginlens.operators import cleaning as C
from marginlens.operators import customers as E
from marginlens.operators import orders as O
from marginlens.operators import products as P
from marginlens.operators import profile as Q
from marginlens.operators import profit as A
from marginlens.operators import validate as V
from marginlens.plans.session import written

AGGREGATES = {
    "profit_by_year": A.profit_by_year,
    "profit_by_year_category": A.profit_by_year_category,
    "profit_by_customer": A.profit_by_customer,
    "profit_by_customer_year": A.profit_by_customer_year,
}


def _tagged(report: DataFrame, output: str) -> DataFrame:
    return report.select(F.lit(output).alias("output"), "check", "violations", "passed")


class Outputs(Mapping):
    """Output name -> DataFrame, each built once when first asked for."""

    NAMES = (
        "profiles", "cleaning_report", "clean_orders", "clean_customers", "clean_products", "enriched_customers",
        "enriched_products", "enriched_orders", "profitable_orders", "profit_summary", *AGGREGATES, "validation",
    )

    def __init__(self, customers, orders, products, as_of, tier_method, materialize, hot_key_rows):
        self.customers, self.orders, self.products = customers, orders, products
        self.as_of, self.tier_method = as_of, tier_method
        self.materialize, self.hot_key_rows = materialize, hot_key_rows
        self._built: dict[str, DataFrame] = {}

    def __iter__(self):
        return iter(self.NAMES)

    def __len__(self) -> int:
        return len(self.NAMES)

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self.NAMES:
            raise KeyError(name)
        if name not in self._built:
            self._built[name] = self._aggregate(name) if name in AGGREGATES else getattr(self, f"_{name}")()
        return self._built[name]

    def _once(self, df: DataFrame) -> DataFrame:
        return written(df) if self.materialize else df

    @cached_property
    def _observed(self) -> C.ObservedOrders:
        return C.ObservedOrders(self.orders, O.DIMENSION_KEYS)

    def _profiles(self) -> DataFrame:
        rows = self._observed.rows if self.materialize else None
        return (
            Q.profile(self.customers, "customers")
            .unionByName(Q.profile(self.orders, "orders", rows=rows))
            .unionByName(Q.profile(self.products, "products"))
        )

    def _cleaning_report(self) -> DataFrame:
        orders = self._observed.report() if self.materialize else None
        return C.cleaning_report(self.customers, self.orders, self.products, orders)

    def _clean_orders(self) -> DataFrame:
        return self._observed.cleaned if self.materialize else C.clean_orders(self.orders)

    def _clean_customers(self) -> DataFrame:
        return C.clean_customers(self.customers)

    def _clean_products(self) -> DataFrame:
        return C.clean_products(self.products)

    def _enriched_customers(self) -> DataFrame:
        return E.enrich_customers(
            self["clean_customers"], self["clean_orders"], as_of=self.as_of, clean=False, deduplicated=True
        )

    def _enriched_products(self) -> DataFrame:
        tiered = P.classify_price_level(self["clean_products"], clean=False, method=self.tier_method)
        return P.sales_velocity(tiered, self["clean_orders"], clean=False)

    def _enriched_orders(self) -> DataFrame:
        orders = self["clean_orders"]
        return self._once(O.enriched_orders(
            orders, self["clean_customers"], self["clean_products"], clean=False,
            hot_key_rows=self.hot_key_rows, split_hot=False, hot=self._observed.hot if self.materialize else None,
        ))

    @cached_property
    def _base(self) -> DataFrame:
        return self._once(A.profit_base(self["enriched_orders"]))

    def _profitable_orders(self) -> DataFrame:
        return O.profitable_orders(self["enriched_orders"])

    def _profit_summary(self) -> DataFrame:
        return A.profit_summary(self._base, from_base=True)

    def _aggregate(self, name: str) -> DataFrame:
        # One row per order id here (see ``operators.profit``): the base's plain counts suffice.
        return AGGREGATES[name](self._base, from_base=True)

    def _validation(self) -> DataFrame:
        reports = {
            "enriched_customers": V.validate_enriched_customers(self["enriched_customers"]),
            "enriched_products": V.validate_enriched_products(self["enriched_products"]),
            "enriched_orders": V.validate_enriched_orders(
                self["enriched_orders"], self._observed.rows if self.materialize else self.orders),
            "profit_summary": V.validate_profit_summary(self["profit_summary"], self["enriched_orders"]),
            **{name: V.validate_profit_aggregate(self[name]) for name in AGGREGATES},
        }
        return reduce(DataFrame.unionByName, (_tagged(report, name) for name, report in reports.items()))


def run_pipeline(
    customers: DataFrame,
    orders: DataFrame,
    products: DataFrame,
    as_of=None,
    tier_method: str = "range",
    materialize: bool = False,
    hot_key_rows: int | None = None,
) -> Outputs:
    """All outputs by name, built on request.  ``as_of`` fixes the recency date
    (default: today); ``hot_key_rows`` salts the order joins on ids with that
    many orders (``operators.joins``)."""
    return Outputs(customers, orders, products, as_of, tier_method, materialize, hot_key_rows)
