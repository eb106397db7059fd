"""Query catalog: every operator as a runnable query over the driver tables.

``QUERIES[name](spark, sf_dir)`` builds a lazy DataFrame from the parquet
tables through the adapter in ``marginlens.sources.testdata``; ``SQL[name]``
is the DuckDB text computing the same rows (absent for queries with no SQL
equivalent).  Keys are ``<survey id>_<name>``.

Orders-side aggregates run on the *clean* adapter; cleaning rules,
enrichment and validators run on the *dirty* one so every rule removes
rows.  The churn queries fix ``as_of`` to the latest order date so the
result does not depend on the day the check runs.
"""

from __future__ import annotations

import datetime as _dt
import itertools
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from marginlens.operators import cleaning as C
from marginlens.operators import customers as E
from marginlens.operators import orders as O
from marginlens.operators import products as P
from marginlens.operators import profile as Q
from marginlens.operators import profit as A
from marginlens.operators import reports as R
from marginlens.operators import validate as V
from marginlens.operators.cleaning import quote
from marginlens.plans import oracle as sql
from marginlens.plans.pipeline import run_pipeline
from marginlens.plans.session import read_once, shared_scratch
from marginlens.schemas import CUSTOMERS_SCHEMA, ORDERS_SCHEMA
from marginlens.sources import arrays, files, views, workbook
from marginlens.sources import testdata as td

QueryFn = Callable[[SparkSession, str], DataFrame]
AS_OF = _dt.date.fromisoformat(sql.AS_OF)

QUERIES: dict[str, QueryFn] = {}
SQL: dict[str, str] = {}


def register(name: str, oracle: str | None = None):
    def wrap(fn: QueryFn) -> QueryFn:
        QUERIES[name] = fn
        if oracle is not None:
            SQL[name] = oracle
        return fn

    return wrap


def _enriched(spark: SparkSession, sf_dir: str, dirty: bool = False) -> DataFrame:
    src = td.sources(spark, sf_dir, dirty)
    return O.enriched_orders(src["orders"], src["customers"], src["products"])


CLEAN, DIRTY = sql.ctes(dirty=False), sql.ctes(dirty=True)

# --- A: profit summary and aggregates (clean adapter) -----------------------

register("a1_profit_summary", CLEAN + sql.profit_summary_sql())(
    lambda spark, d: A.profit_summary(_enriched(spark, d))
)
register("a2_profit_by_year", CLEAN + sql.aggregate_sql(["Year"]))(
    lambda spark, d: A.profit_by_year(_enriched(spark, d), unique_orders=True)
)
register("a3_profit_by_year_category", CLEAN + sql.aggregate_sql(["Year", "Category"]))(
    lambda spark, d: A.profit_by_year_category(_enriched(spark, d), unique_orders=True)
)
register("a4_profit_by_customer", CLEAN + sql.aggregate_sql(["Customer Name"]))(
    lambda spark, d: A.profit_by_customer(_enriched(spark, d), unique_orders=True)
)
register("a5_profit_by_customer_year", CLEAN + sql.aggregate_sql(["Customer Name", "Year"]))(
    lambda spark, d: A.profit_by_customer_year(_enriched(spark, d), unique_orders=True)
)

# The public default: an exact distinct count of order ids.
for _name, _fn, _keys in [
    ("a2_profit_by_year_distinct", A.profit_by_year, ["Year"]),
    ("a3_profit_by_year_category_distinct", A.profit_by_year_category, ["Year", "Category"]),
    ("a4_profit_by_customer_distinct", A.profit_by_customer, ["Customer Name"]),
    ("a5_profit_by_customer_year_distinct", A.profit_by_customer_year, ["Customer Name", "Year"]),
]:
    register(_name, CLEAN + sql.aggregate_sql(_keys))(lambda spark, d, fn=_fn: fn(_enriched(spark, d)))

# --- C: cleaning rules (dirty adapter) --------------------------------------


def _dirty_orders(spark: SparkSession, d: str) -> DataFrame:
    return td.orders(spark, d, dirty=True)


register("c1_drop_negative_profit", DIRTY + 'SELECT * FROM src_orders WHERE "Profit" >= 0')(
    lambda spark, d: C.drop_negative_profit(_dirty_orders(spark, d))
)
register("c2_drop_null_order_id", DIRTY + 'SELECT * FROM src_orders WHERE "Order ID" IS NOT NULL')(
    lambda spark, d: C.drop_null(_dirty_orders(spark, d), "Order ID")
)
register("c3_dedupe_order_id", DIRTY + sql.keep_first("src_orders", '"Order ID"', sql.ORDER_TIEBREAK))(
    lambda spark, d: C.dedupe_orders(_dirty_orders(spark, d))
)
register("c4_drop_unparsable_dates", DIRTY + f"SELECT * FROM src_orders WHERE {sql.DATES_VALID}")(
    lambda spark, d: C.drop_unparsable_dates(_dirty_orders(spark, d))
)
register("c5_drop_null_customer_id", DIRTY + 'SELECT * FROM src_orders WHERE "Customer ID" IS NOT NULL')(
    lambda spark, d: C.drop_null(_dirty_orders(spark, d), "Customer ID")
)
register("c6_drop_null_product_id", DIRTY + 'SELECT * FROM src_orders WHERE "Product ID" IS NOT NULL')(
    lambda spark, d: C.drop_null(_dirty_orders(spark, d), "Product ID")
)
register("c7_clean_orders", DIRTY + "SELECT * FROM cln_orders")(
    lambda spark, d: C.clean_orders(_dirty_orders(spark, d))
)
register(
    "c8_normalise_customer_names",
    sql.raw_customers_names() + f'SELECT * REPLACE ({sql.CLEAN_NAME} AS "Customer Name") FROM src_customers',
)(lambda spark, d: C.normalise_customer_names(td.customers(spark, d, raw_names=True)))
register("c9_clean_customers", DIRTY + "SELECT * FROM cln_customers")(
    lambda spark, d: C.clean_customers(td.customers(spark, d, dirty=True))
)
register("c10_clean_products", DIRTY + "SELECT * FROM cln_products")(
    lambda spark, d: C.clean_products(td.products(spark, d, dirty=True))
)


def _c11(spark: SparkSession, d: str) -> DataFrame:
    src = td.sources(spark, d, dirty=True)
    return C.cleaning_report(src["customers"], src["orders"], src["products"])


register("c11_cleaning_report", DIRTY + sql.cleaning_report_sql())(_c11)

# --- E: enrichment (dirty adapter) ------------------------------------------


def _dirty(spark: SparkSession, d: str) -> dict[str, DataFrame]:
    return td.sources(spark, d, dirty=True)


def _customers_q(fn):
    def run(spark: SparkSession, d: str) -> DataFrame:
        src = _dirty(spark, d)
        return fn(src["customers"], src["orders"])

    return run


register("e1_lifetime_value", DIRTY + sql.lifetime_value_sql())(_customers_q(E.lifetime_value))
register("e2_average_basket_size", DIRTY + sql.average_basket_sql())(_customers_q(E.average_basket_size))
register("e3_product_variety", DIRTY + sql.product_variety_sql())(_customers_q(E.product_variety))
register("e4_churn_risk", DIRTY + sql.churn_risk_sql())(
    _customers_q(lambda c, o: E.churn_risk(c, o, as_of=AS_OF))
)
register("e5_enriched_customers", DIRTY + sql.enriched_customers_sql())(
    _customers_q(lambda c, o: E.enrich_customers(c, o, as_of=AS_OF))
)
# Both keys run the distributed rank, the second with its offsets joined by a
# shuffle instead of a broadcast; the ``ntile`` window keeps a whole category
# in one task and stays a small-input option and test model.
register("e6_price_tier", DIRTY + sql.price_tier_sql())(
    lambda spark, d: P.classify_price_level(td.products(spark, d, dirty=True))
)
register("e6_price_tier_range", DIRTY + sql.price_tier_sql())(
    lambda spark, d: P.classify_price_level(td.products(spark, d, dirty=True), broadcast_bytes=0)
)
register("e7_sales_velocity", DIRTY + sql.sales_velocity_sql())(
    lambda spark, d: P.sales_velocity(td.products(spark, d, dirty=True), _dirty_orders(spark, d))
)
register("e8_enriched_products", DIRTY + sql.enriched_products_sql())(
    lambda spark, d: P.enrich_products(td.products(spark, d, dirty=True), _dirty_orders(spark, d))
)
register("e9_enriched_orders", DIRTY + "SELECT * FROM enriched")(lambda spark, d: _enriched(spark, d, dirty=True))
# The same rows through the salted joins: ids with 8 or more orders count as hot,
# once with the list of hot ids broadcast and once too long for that.
register("e9_enriched_orders_salted", DIRTY + "SELECT * FROM enriched")(
    lambda spark, d: O.enriched_orders(
        *(td.sources(spark, d, dirty=True)[k] for k in ("orders", "customers", "products")), hot_key_rows=8
    )
)
register("e9_enriched_orders_many_hot_ids", DIRTY + "SELECT * FROM enriched")(
    lambda spark, d: O.enriched_orders(
        *(td.sources(spark, d, dirty=True)[k] for k in ("orders", "customers", "products")), hot_key_rows=2,
        broadcast_keys=0,
    )
)
register("e10_profitable_orders", DIRTY + 'SELECT * FROM enriched WHERE "Profit" >= 0')(
    lambda spark, d: O.profitable_orders(_enriched(spark, d, dirty=True))
)

# --- amounts that a narrow decimal would cut, round twice or overflow ---------

# 5 to 8 decimals just below half a cent; a sum of many tiny prices; totals over 1e15.
EDGES = {"profit": "CAST(l_linenumber AS DOUBLE) + CAST(l_suppkey % 100 AS DOUBLE) / 100 + CAST(0.00499996 AS DOUBLE)"}
SMALL = {"price": "CAST(0.00004 AS DOUBLE)"}
LARGE = {"profit": "CAST(90000000000000 AS DOUBLE) + l_linenumber"}


def _with_amounts(amounts: dict[str, str], fn) -> QueryFn:
    return lambda spark, d: fn(*(td.sources(spark, d, **amounts)[k] for k in ("orders", "customers", "products")))


register("e9_rounding_edges", sql.ctes(**EDGES) + "SELECT * FROM enriched")(_with_amounts(EDGES, O.enriched_orders))
register("e1_small_amounts", sql.ctes(**SMALL) + sql.lifetime_value_sql())(
    _with_amounts(SMALL, lambda o, c, p: E.lifetime_value(c, o))
)
# Amounts of any magnitude: sums of whole numbers of 1e300 or 1e-300, and small,
# usual and large amounts in one group.
HUGE, TINY = ({"profit": amount, "price": amount} for amount in (
    f"CAST(CAST(l_suppkey % 100 + 1 AS STRING) || '{unit}' AS DOUBLE)" for unit in ("e300", "e-300")))
MIXED = {"profit": "CASE l_suppkey % 3 WHEN 0 THEN CAST('1e-300' AS DOUBLE) WHEN 1 THEN CAST(l_suppkey % 100 AS DOUBLE) / 4 "
                   "ELSE CAST(CAST(l_suppkey % 7 + 1 AS STRING) || 'e16' AS DOUBLE) END"}
register("a4_huge_amounts", sql.ctes(**HUGE) + sql.scaled_by_customer("e300"))(
    _with_amounts(HUGE, lambda o, c, p: A.profit_by_customer(O.enriched_orders(o, c, p), unique_orders=True))
)
register("a2_mixed_amounts", sql.ctes(**MIXED) + sql.mixed_by_year())(
    _with_amounts(MIXED, lambda o, c, p: A.profit_by_year(O.enriched_orders(o, c, p), unique_orders=True))
)
for _case, _amounts, _unit in [("huge", HUGE, "e300"), ("tiny", TINY, "e-300")]:
    register(f"e1_{_case}_amounts", sql.ctes(**_amounts) + sql.scaled_lifetime_value(_unit))(
        _with_amounts(_amounts, lambda o, c, p: E.lifetime_value(c, o))
    )
register("r1_large_totals", sql.ctes(**LARGE) + sql.with_aggregates() + sql.REPORT_SQL["r1"])(
    _with_amounts(LARGE, lambda o, c, p: R.summary_statistics(A.profit_summary(O.enriched_orders(o, c, p))))
)

# --- R: reports -------------------------------------------------------------


def _summary(spark: SparkSession, d: str) -> DataFrame:
    return A.profit_summary(_enriched(spark, d))


AGG = CLEAN + sql.with_aggregates()

for _name, _fn, _key in [
    ("r1_summary_statistics", R.summary_statistics, "r1"),
    ("r2_yearly_breakdown", R.yearly_breakdown, "r2"),
    ("r3_category_breakdown", R.category_breakdown, "r3"),
    ("r4_top_groups", R.top_groups, "r4"),
    ("r5_bottom_groups", R.bottom_groups, "r5"),
]:
    register(_name, AGG + sql.REPORT_SQL[_key])(lambda spark, d, fn=_fn: fn(_summary(spark, d)))


def _summary_view(spark: SparkSession, d: str) -> DataFrame:
    return spark.table(views.register_enriched_views(profit_summary=_summary(spark, d))["profit_summary"])


# The SQL reports read the summary's registered view, as a SQL user would.
for _name, _fn, _key in [
    ("r6_sql_profit_by_year", R.sql_profit_by_year, "r6"),
    ("r7_sql_top_customers", R.sql_top_customers, "r7"),
    ("r8_sql_category_performance", R.sql_category_performance, "r8"),
]:
    register(_name, AGG + sql.REPORT_SQL[_key])(lambda spark, d, fn=_fn: fn(_summary_view(spark, d)))


def _enriched_customers(spark: SparkSession, d: str) -> DataFrame:
    src = _dirty(spark, d)
    return E.enrich_customers(src["customers"], src["orders"], as_of=AS_OF)


ENRICHED_CUSTOMERS = DIRTY + sql.enriched_customers_ctes()
for _name, _fn, _key in [
    ("r9_top_average_order_value", R.top_average_order_value, "r9"),
    ("r10_top_product_variety", R.top_product_variety, "r10"),
    ("r11_longest_lapsed", R.longest_lapsed, "r11"),
]:
    register(_name, ENRICHED_CUSTOMERS + sql.CUSTOMER_REPORT_SQL[_key])(
        lambda spark, d, fn=_fn: fn(_enriched_customers(spark, d))
    )


def _raw_view(kind: str):
    def run(spark: SparkSession, d: str) -> DataFrame:
        src = td.sources(spark, d)
        names = views.register_raw_views(src["customers"], src["orders"], src["products"])
        return R.raw_preview(spark.table(names[kind]), kind)

    return run


for _kind in ["customers", "orders", "products"]:
    _name = f"r12_raw_{_kind}_preview"
    register(_name, CLEAN + sql.RAW_VIEW_CTES + sql.PREVIEW_SQL[_name])(_raw_view(_kind))


def _enriched_view(kind: str):
    def run(spark: SparkSession, d: str) -> DataFrame:
        src = _dirty(spark, d)
        frames = {
            "enriched_customers": E.enrich_customers(src["customers"], src["orders"], as_of=AS_OF),
            "enriched_products": P.enrich_products(src["products"], src["orders"]),
            "enriched_orders": O.enriched_orders(src["orders"], src["customers"], src["products"]),
        }
        names = views.register_enriched_views(**{kind: frames[kind]})
        return R.enriched_preview(spark.table(names[kind]), kind)

    return run


for _kind, _ctes in [
    ("enriched_customers", sql.enriched_customers_ctes()),
    ("enriched_products", sql.enriched_products_ctes()),
    ("enriched_orders", ""),
]:
    _name = f"r13_{_kind}_preview"
    register(_name, DIRTY + _ctes + sql.PREVIEW_SQL[_name])(_enriched_view(_kind))


register("r14_top_customers", AGG + sql.REPORT_SQL["r14"])(
    lambda spark, d: R.first_rows(A.profit_by_customer(_enriched(spark, d), unique_orders=True), 10)
)
register("r15_profit_by_year_first", AGG + sql.REPORT_SQL["r15_year"])(
    lambda spark, d: R.first_rows(A.profit_by_year(_enriched(spark, d), unique_orders=True), 10)
)
register("r15_profit_by_year_category_first", AGG + sql.REPORT_SQL["r15_year_category"])(
    lambda spark, d: R.first_rows(A.profit_by_year_category(_enriched(spark, d), unique_orders=True), 15)
)
register("r15_profit_by_customer_year_first", AGG + sql.REPORT_SQL["r15_customer_year"])(
    lambda spark, d: R.first_rows(A.profit_by_customer_year(_enriched(spark, d), unique_orders=True), 15)
)


def _r16(spark: SparkSession, d: str) -> DataFrame:
    enriched = _enriched(spark, d)
    # The yearly rows are re-sorted by the report, so they skip their own sort.
    return R.top_customer_trends(
        A.profit_by_customer(enriched, unique_orders=True),
        A.profit_by_customer_year(enriched, unique_orders=True, sort=False),
    )


register("r16_top_customer_trends", AGG + sql.REPORT_SQL["r16"])(_r16)
# The same rows from one aggregation of the denormalised orders.
register("r16_customer_trends_one_branch", AGG + sql.REPORT_SQL["r16"])(
    lambda spark, d: R.customer_trends(A.customer_year_totals(_enriched(spark, d)))
)
register("r17_year_metrics", AGG + sql.REPORT_SQL["r17"])(
    lambda spark, d: R.year_metrics(A.profit_by_year(_enriched(spark, d), unique_orders=True))
)
register("r18_customer_metrics", AGG + sql.REPORT_SQL["r18"])(
    lambda spark, d: R.customer_metrics_report(A.profit_by_customer(_enriched(spark, d), unique_orders=True))
)
register("r19_category_totals", AGG + sql.REPORT_SQL["r19"])(
    lambda spark, d: R.category_totals(A.profit_by_year_category(_enriched(spark, d), unique_orders=True))
)

# --- V: validators (dirty adapter) ------------------------------------------


def _v1(spark: SparkSession, d: str) -> DataFrame:
    # Customers left uncleaned so NULL and repeated ids reach the validator.
    src = _dirty(spark, d)
    enriched = E.enrich_customers(src["customers"], C.clean_orders(src["orders"]), as_of=AS_OF, clean=False)
    return V.validate_enriched_customers(enriched)


register(
    "v1_validate_enriched_customers",
    DIRTY + sql.unclean_customers_ctes()
    + sql.keyed_validation("enriched_customers", '"Customer ID"', sql.V1_CHECKS, "null_customer_id",
                           "duplicate_customer_id"),
)(_v1)
register(
    "v2_validate_enriched_products",
    DIRTY + sql.enriched_products_ctes()
    + sql.keyed_validation("enriched_products", '"Product ID"', sql.V2_CHECKS, "null_product_id",
                           "duplicate_product_id"),
)(lambda spark, d: V.validate_enriched_products(P.enrich_products(*_dirty_pair(spark, d))))


def _dirty_pair(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    src = _dirty(spark, d)
    return src["products"], src["orders"]


def _v3(spark: SparkSession, d: str) -> DataFrame:
    src = _dirty(spark, d)
    return V.validate_enriched_orders(O.enriched_orders(src["orders"], src["customers"], src["products"]),
                                      src["orders"])


register("v3_validate_enriched_orders", DIRTY + sql.v3_sql())(_v3)


def _v4(spark: SparkSession, d: str) -> DataFrame:
    enriched = _enriched(spark, d, dirty=True)
    return V.validate_profit_summary(A.profit_summary(enriched), enriched)


register("v4_validate_profit_summary", DIRTY + sql.v4_sql())(_v4)
register("v5_validate_profit_aggregate", DIRTY + sql.v5_sql())(
    lambda spark, d: V.validate_profit_aggregate(A.profit_by_year(_enriched(spark, d, dirty=True), unique_orders=True))
)

# Violating and empty input: the validators' other branches.


def _v2_violations(spark: SparkSession, d: str) -> DataFrame:
    # Uncleaned products keep NULL and repeated ids; quantities and labels are spoilt by fixed rules.
    src = _dirty(spark, d)
    tiers = P.classify_price_level(src["products"], clean=False)
    enriched = P.sales_velocity(tiers, C.clean_orders(src["orders"]), clean=False, fill_columns=["total_quantity_sold"])
    size = F.length("Product Name")
    return V.validate_enriched_products(
        enriched.withColumn("total_quantity_sold", F.when(size % 3 == 0, -F.col("total_quantity_sold")).otherwise(F.col("total_quantity_sold")))
        .withColumn("price_position", F.when(size % 4 == 0, "Luxury").otherwise(F.col("price_position")))
        .withColumn("inventory_velocity", F.when(size % 5 == 0, "Stuck").otherwise(F.col("inventory_velocity"))))


register("v2_validate_products_violations", DIRTY + sql.v2_violations_sql())(_v2_violations)


def _v4_violations(spark: SparkSession, d: str) -> DataFrame:
    # The summary twice, with NULL keys and totals and zero counts by fixed rules, against half of its source.
    enriched = _enriched(spark, d, dirty=True)
    summary = A.profit_summary(enriched)
    spoilt = summary.withColumn("Category", F.when(F.col("Order_Count") > 1, F.lit(None)).otherwise(F.col("Category"))) \
        .withColumn("Total_Profit", F.when(F.col("Year") % 2 == 0, F.lit(None)).otherwise(F.col("Total_Profit"))) \
        .withColumn("Order_Count", F.when(F.col("Year") % 3 == 0, F.lit(0)).otherwise(F.col("Order_Count")))
    return V.validate_profit_summary(summary.unionByName(spoilt), enriched.filter(F.col("Order ID") % 2 == 0))


register("v4_validate_summary_violations", DIRTY + sql.v4_violations_sql())(_v4_violations)


def _v5_empty(spark: SparkSession, d: str) -> DataFrame:
    enriched = _enriched(spark, d, dirty=True).filter(F.col("Profit") < 0)  # cleaning left none
    return V.validate_profit_aggregate(A.profit_by_year(enriched, unique_orders=True))


register("v5_validate_empty_aggregate", DIRTY + sql.v5_empty_sql())(_v5_empty)


def _v3_orphans(spark: SparkSession, d: str) -> DataFrame:
    src = _dirty(spark, d)
    return V.orphan_report(C.clean_orders(src["orders"]), C.clean_customers(src["customers"]), C.clean_products(src["products"]))


register("v3_orphans", DIRTY + sql.v3_orphans_sql())(_v3_orphans)
register("v3_orphan_orders", DIRTY + sql.v3_orphan_orders_sql())(
    lambda spark, d: V.orphan_orders(
        C.clean_orders(_dirty(spark, d)["orders"]), C.clean_customers(_dirty(spark, d)["customers"]), C.clean_products(_dirty(spark, d)["products"]))
)

# --- Q: table profiles (clean adapter) --------------------------------------

for _kind in ["customers", "orders", "products"]:
    register(f"q1_profile_{_kind}", CLEAN + sql.profile_sql(_kind))(
        lambda spark, d, kind=_kind: Q.profile(td.sources(spark, d)[kind], kind)
    )

for _kind in ["customers", "orders", "products"]:
    register(f"q1_profile_samples_{_kind}", DIRTY + sql.profile_samples_sql(_kind))(
        lambda spark, d, kind=_kind: Q.profile_samples(_dirty(spark, d)[kind], kind)
    )
    register(f"q1_profile_summary_{_kind}", DIRTY + sql.profile_summary_sql(_kind))(
        lambda spark, d, kind=_kind: Q.profile_summary(_dirty(spark, d)[kind], kind)
    )


def _q1_failed(spark: SparkSession, d: str) -> DataFrame:
    """The profiles of tables of which one cannot be loaded: that one is Failed."""
    frames, errors = {}, {}
    for kind in ("customers", "orders", "products"):
        try:
            frames[kind] = files.read_products(spark, f"{d}/no-such-products") if kind == "products" else td.sources(spark, d)[kind]
        except files.SourceError as exc:
            frames[kind], errors[kind] = None, str(exc).split(":")[1].strip()
    out = [Q.profile_summary(frame, kind, spark, errors.get(kind)) for kind, frame in frames.items()]
    return out[0].unionByName(out[1]).unionByName(out[2])


register("q1_profile_failed", CLEAN + sql.profile_failed_sql())(_q1_failed)

# --- S: file sources (round trips through Spark's own writers) --------------



# The adapter's Row ID is a bigint ordering key; the declared schema is kept
# otherwise (ids and dates read back as text).
ORDERS_SCHEMA_BIGINT_ROW_ID = StructType([StructField("Row ID", LongType(), True), *ORDERS_SCHEMA.fields[1:]])

# JSON Lines are written compressed, in files short enough that none has to be split to be read.
PACKED = {"compression": "snappy", "maxRecordsPerFile": 1_000_000}


def _s2(spark: SparkSession, d: str) -> DataFrame:
    out = shared_scratch(spark, "orders-json")
    td.orders(spark, d, dirty=True).write.mode("overwrite").options(**PACKED).json(out)
    return read_once(files.read_orders(spark, out, multi_line=False, schema=ORDERS_SCHEMA_BIGINT_ROW_ID), out)


ARRAY_ORDERS = 10_000


def _json_arrays(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows of a task as JSON arrays of ``ARRAY_ORDERS`` each; the last one holds the rest."""
    rows: list[str] = []
    for batch in itertools.chain(batches, [None]):
        rows += batch.column(0).to_pylist() if batch is not None else []
        while len(rows) >= ARRAY_ORDERS or rows and batch is None:
            yield pa.RecordBatch.from_arrays([pa.array(["[" + ",\n".join(rows[:ARRAY_ORDERS]) + "]"])], names=["value"])
            del rows[:ARRAY_ORDERS]


def _array_files(spark: SparkSession, d: str, compression: str = "none") -> str:
    """JSON array files of at most 10,000 orders each, made where the orders come out of their join."""
    out, orders = shared_scratch(spark, "orders-json-arrays"), td.orders(spark, d, dirty=True)
    rows = orders.select(F.to_json(F.struct(*[F.col(quote(c)) for c in orders.columns])).alias("row"))
    rows.mapInArrow(_json_arrays, "value string").write.option("maxRecordsPerFile", 1).option("compression", compression).text(out)
    return out


def _s2_array(spark: SparkSession, d: str) -> DataFrame:
    out = _array_files(spark, d, "snappy")  # files of one task each, compressed or not
    with files.numbers_in_stream(spark):
        return read_once(files.read_orders(spark, out, schema=ORDERS_SCHEMA_BIGINT_ROW_ID, strict_fields=True), out)


def _s2_ranges(spark: SparkSession, d: str) -> DataFrame:
    """The same files in ranges of 256 KB, so that each array is read by several tasks."""
    out, setting = _array_files(spark, d), "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(setting)
    spark.conf.set(setting, 256 << 10)
    try:
        return read_once(arrays.read_json_arrays(spark, out, ORDERS_SCHEMA_BIGINT_ROW_ID), out)
    finally:
        spark.conf.set(setting, before)


def _s3(spark: SparkSession, d: str) -> DataFrame:
    out = shared_scratch(spark, "products-csv")
    td.products(spark, d, dirty=True).write.mode("overwrite").option("header", True).csv(out)
    return read_once(files.read_products(spark, out), out)


def _damaged_orders(spark: SparkSession, d: str) -> tuple[files.Quarantined, str]:
    """JSON Lines of the orders with damaged records, read with a quarantine."""
    out, orders = shared_scratch(spark, "orders-damaged"), td.orders(spark, d, dirty=True)
    whole = F.to_json(F.struct(*[F.col(quote(c)) for c in orders.columns]))
    head, left = F.concat(F.lit('{"Row ID":'), F.col("Row ID")), F.col("Row ID") % 50
    orders.select(F.when(left == 0, head).when(left == 1, F.concat(head, F.lit(',"Quantity":"many"}'))).otherwise(whole).alias("value")).write.options(**PACKED).text(out)
    return files.read_orders(spark, out, multi_line=False, schema=ORDERS_SCHEMA_BIGINT_ROW_ID, quarantined=True), out


def _quarantine(side: str):
    def run(spark: SparkSession, d: str) -> DataFrame:
        split, out = _damaged_orders(spark, d)
        return read_once(split.accepted if side == "accepted" else split.rejected.select("record"), out)

    return run


register("s4_quarantine", DIRTY + sql.S4_QUARANTINE)(_quarantine("rejected"))
register("s4_accepted", DIRTY + sql.S4_ACCEPTED)(_quarantine("accepted"))
register("s2_json_orders_roundtrip", DIRTY + sql.S2_ROUNDTRIP)(_s2)
register("s2_json_array_orders", DIRTY + sql.S2_ROUNDTRIP)(_s2_array)
register("s2_json_array_ranges", DIRTY + sql.S2_ROUNDTRIP)(_s2_ranges)
register("s3_csv_products_roundtrip", DIRTY + sql.S3_ROUNDTRIP)(_s3)

# --- P: the end-to-end pipeline, output by output (dirty adapter) -----------


def _pipeline_output(name: str):
    def run(spark: SparkSession, d: str) -> DataFrame:
        src = _dirty(spark, d)
        return run_pipeline(src["customers"], src["orders"], src["products"], as_of=AS_OF)[name]

    return run


def _validation_sql() -> str:
    """The eight reports of the pipeline in one."""
    parts = {
        "enriched_customers": sql.enriched_customers_ctes() + sql.keyed_validation(
            "enriched_customers", '"Customer ID"', sql.V1_CHECKS, "null_customer_id", "duplicate_customer_id"),
        "enriched_products": sql.enriched_products_ctes() + sql.keyed_validation(
            "enriched_products", '"Product ID"', sql.V2_CHECKS, "null_product_id", "duplicate_product_id"),
        "enriched_orders": sql.v3_sql(),
        "profit_summary": sql.v4_sql(),
        **{name: sql.v5_sql(keys) for name, keys in sql.AGGREGATE_KEYS.items()},
    }
    return "\nUNION ALL ".join(f"SELECT '{name}' AS output, * FROM ({DIRTY} {text})" for name, text in parts.items())


PIPELINE_SQL = {
    "profiles": DIRTY + "\nUNION ALL ".join(f"SELECT * FROM ({sql.profile_sql(k)})" for k in ("customers", "orders", "products")),
    "cleaning_report": DIRTY + sql.cleaning_report_sql(),
    "clean_orders": DIRTY + "SELECT * FROM cln_orders",
    "clean_customers": DIRTY + "SELECT * FROM cln_customers",
    "clean_products": DIRTY + "SELECT * FROM cln_products",
    "enriched_customers": DIRTY + sql.enriched_customers_ctes() + "SELECT * FROM enriched_customers",
    "enriched_products": DIRTY + sql.enriched_products_ctes() + "SELECT * FROM enriched_products",
    "enriched_orders": DIRTY + "SELECT * FROM enriched",
    "profitable_orders": DIRTY + 'SELECT * FROM enriched WHERE "Profit" >= 0',
    "profit_summary": DIRTY + sql.profit_summary_sql(),
    **{name: DIRTY + sql.aggregate_sql(keys) for name, keys in sql.AGGREGATE_KEYS.items()},
    "validation": _validation_sql(),
}
for _name, _sql in PIPELINE_SQL.items():
    register(f"p1_pipeline_{_name}", _sql)(_pipeline_output(_name))
# From the pass that cleans and writes the orders, and from the shared base of the aggregates.
for _name in ("profit_summary", "cleaning_report", "profiles", "validation", "profit_by_customer"):
    register(f"p1_pipeline_materialized_{_name}", PIPELINE_SQL[_name])(
        lambda spark, d, name=_name: run_pipeline(
            *(_dirty(spark, d)[k] for k in ("customers", "orders", "products")), as_of=AS_OF, materialize=True
        )[name]
    )

# --- S1: workbooks, round-tripped in memory and through files ---------------------------------



def _s1(spark: SparkSession, d: str) -> DataFrame:
    customers = td.customers(spark, d, dirty=True)
    text = customers.selectExpr(*[f"CAST({quote(c)} AS STRING) AS {quote(c)}" for c in customers.columns])
    return workbook.decode_records(workbook.to_workbook_records(text), CUSTOMERS_SCHEMA)


def _s1_files(spark: SparkSession, d: str) -> DataFrame:
    customers = td.customers(spark, d, dirty=True)
    out = shared_scratch(spark, "customers-xlsx")
    workbook.write_workbooks(customers.selectExpr(*[f"CAST({quote(c)} AS STRING) AS {quote(c)}" for c in customers.columns]), out)
    return read_once(workbook.read_workbooks(spark, out, CUSTOMERS_SCHEMA, glob="part-*"), out)


register("s1_workbook_customers_roundtrip", DIRTY + sql.S1_ROUNDTRIP)(_s1)
register("s1_workbook_files", DIRTY + sql.S1_ROUNDTRIP)(_s1_files)
