"""Adapter from the driver's TPC-H-style parquet tables to the three source schemas.

Used by the query catalog, the tests and the benchmark.  Every mapping is
written so the same text runs in DuckDB (see ``marginlens.plans.oracle``).

* customers: ``Customer ID`` = ``c_custkey``; ``Customer Name`` = ``c_name``
  with ``#`` and digits translated to a space and letters, because raw names
  all clean to the single word ``Customer``; segment, nation and region
  names; the contact and address columns are NULL.
* products: ``Product ID`` = ``p_partkey``, ``Category`` = ``p_type``,
  ``Sub-Category`` = ``p_brand``, ``Product Name`` = ``p_name``,
  ``Price per product`` = ``p_retailprice``.
* orders: one row per lineitem joined to its order; ``Row ID`` orders the
  lines of an order; dates as ``d/M/yyyy`` text; ``Profit`` =
  ``extendedprice * (0.05 - discount)`` computed in decimal, so it has both
  signs.

Ids stay numeric (the operators accept any id type; the file sources read
them as text).  The *dirty* variants inject NULL ids, orphans, unparsable
dates and duplicate rows by fixed rules over the whole tables, so every
cleaning rule and validator has work to do.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


# Fixed values of the adapter (shared with the DuckDB text in plans/oracle.py).
NAME_FROM, NAME_TO = "#0123456789", " ABCDEFGHIJ"
ROW_ID_LINE, ROW_ID_PART = 10**12, 10**5
PROFIT_MARGIN = Decimal("0.05")


# Parquet schemas of the driver tables.  Declaring them skips the footer-
# reading inference job Spark otherwise runs for every read.
TABLE_SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
                "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, "
                "l_linestatus string, l_shipdate timestamp_ntz",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    reader = spark.read.schema(TABLE_SCHEMAS[name]) if name in TABLE_SCHEMAS else spark.read
    return reader.parquet(f"{sf_dir}/{name}.parquet")


def spread_single_split(df: DataFrame) -> DataFrame:
    """``df`` dealt over the session's cores if its file is one split (a single
    row group cannot be read by several tasks); larger tables pass as they are."""
    if df.rdd.getNumPartitions() > 1:
        return df
    return df.repartition(df.sparkSession.sparkContext.defaultParallelism)


def _dmy(ts: str) -> str:
    """``date_format(ts, 'd/M/yyyy')`` from integer fields (no formatter per row)."""
    return (f"concat_ws('/', CAST(dayofmonth({ts}) AS STRING), CAST(month({ts}) AS STRING), "
            f"lpad(CAST(year({ts}) AS STRING), 4, '0'))")


def _cents(column: str) -> str:
    """A 2-decimal double as its exact integer number of hundredths."""
    return f"CAST(rint({column} * 100) AS BIGINT)"


_NULL = "CAST(NULL AS STRING)"


def _customer_exprs(cid: str, name: str, segment: str) -> list[str]:
    return [
        f"{cid} AS `Customer ID`", f"{name} AS `Customer Name`", f"{_NULL} AS email", f"{_NULL} AS phone",
        f"{_NULL} AS address", f"{segment} AS Segment", "n_name AS Country", f"{_NULL} AS City",
        f"{_NULL} AS State", f"{_NULL} AS `Postal Code`", "r_name AS Region",
    ]


def customers(spark: SparkSession, sf_dir: str, dirty: bool = False, raw_names: bool = False) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    n = table(spark, sf_dir, "nation")
    r = table(spark, sf_dir, "region")
    base = c.join(n, F.expr("c_nationkey = n_nationkey"), "left").join(r, F.expr("n_regionkey = r_regionkey"), "left")
    name = "c_name" if raw_names else f"translate(c_name, '{NAME_FROM}', '{NAME_TO}')"
    cid = "CASE WHEN c_custkey % 37 = 0 THEN CAST(NULL AS BIGINT) ELSE c_custkey END" if dirty else "c_custkey"
    out = base.selectExpr(*_customer_exprs(cid, name, "c_mktsegment"))
    if dirty:
        # A second copy of every 11th customer, raw name and another segment.
        copies = base.filter("c_custkey % 11 = 0").selectExpr(*_customer_exprs("c_custkey", "c_name", "'DUPLICATE'"))
        out = out.unionByName(copies)
    return out


def _product_exprs(pid: str, price: str) -> list[str]:
    return [
        f"{pid} AS `Product ID`", "p_type AS Category", "p_brand AS `Sub-Category`", "p_name AS `Product Name`",
        f"{_NULL} AS State", f"{price} AS `Price per product`",
    ]


def products(spark: SparkSession, sf_dir: str, dirty: bool = False) -> DataFrame:
    p = table(spark, sf_dir, "part")
    if not dirty:
        return p.selectExpr(*_product_exprs("p_partkey", "p_retailprice"))
    out = p.selectExpr(*_product_exprs(
        "CASE WHEN p_partkey % 41 = 0 THEN CAST(NULL AS BIGINT) ELSE p_partkey END",
        "CASE WHEN p_partkey % 43 = 0 THEN CAST(NULL AS DOUBLE) ELSE p_retailprice END",
    ))
    # A second copy of every 13th product under a shifted price.
    copies = p.filter("p_partkey % 13 = 0").selectExpr(*_product_exprs("p_partkey", "p_retailprice + 1"))
    return out.unionByName(copies)


def orders(
    spark: SparkSession, sf_dir: str, dirty: bool = False, profit: str | None = None, price: str = "l_extendedprice"
) -> DataFrame:
    """Order lines; ``profit`` and ``price`` are other SQL expressions over the
    raw columns, for queries about unusual amounts."""
    li = spread_single_split(table(spark, sf_dir, "lineitem"))
    o = table(spark, sf_dir, "orders")
    lines = li.join(o, F.expr("l_orderkey = o_orderkey"), "inner")
    if dirty:
        order_id = "CASE WHEN l_linenumber = 7 AND l_suppkey % 10 = 0 THEN CAST(NULL AS BIGINT) ELSE l_orderkey END"
        ship_date = f"CASE WHEN l_partkey % 17 = 0 THEN date_format(l_shipdate, 'yyyy-MM-dd') ELSE {_dmy('l_shipdate')} END"
        customer_id = ("CASE WHEN l_orderkey % 29 = 0 THEN CAST(NULL AS BIGINT) "
                       "WHEN l_orderkey % 23 = 0 THEN o_custkey + 1000000 ELSE o_custkey END")
        product_id = "CASE WHEN l_partkey % 31 = 0 THEN CAST(NULL AS BIGINT) ELSE l_partkey END"
    else:
        order_id, ship_date, customer_id, product_id = "l_orderkey", _dmy("l_shipdate"), "o_custkey", "l_partkey"
    # decimal(price) * (0.05 - decimal(discount)) has four decimals; computed on
    # integer hundredths and divided once, it is the same double as the decimal
    # cast (both are the correctly rounded quotient of two exact integers).
    margin = int(PROFIT_MARGIN * 100)
    margins = f"({_cents('l_extendedprice')} * ({margin} - {_cents('l_discount')})) / 10000D"
    return lines.selectExpr(
        f"CAST(l_linenumber AS BIGINT) * {ROW_ID_LINE} + l_partkey * {ROW_ID_PART} + l_suppkey AS `Row ID`",
        f"{order_id} AS `Order ID`",
        f"{_dmy('o_orderdate')} AS `Order Date`",
        f"{ship_date} AS `Ship Date`",
        "o_orderpriority AS `Ship Mode`",
        f"{customer_id} AS `Customer ID`",
        f"{product_id} AS `Product ID`",
        "CAST(l_quantity AS INT) AS Quantity",
        f"{price} AS Price",
        "l_discount AS Discount",
        f"{profit or margins} AS Profit",
    )


def sources(spark: SparkSession, sf_dir: str, dirty: bool = False, **amounts: str) -> dict[str, DataFrame]:
    return {
        "customers": customers(spark, sf_dir, dirty),
        "orders": orders(spark, sf_dir, dirty, **amounts),
        "products": products(spark, sf_dir, dirty),
    }
