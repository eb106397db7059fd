"""DuckDB SQL equal to each catalog query (the correctness oracle).

The driver registers the raw parquet tables as views (``customer``,
``orders``, ``lineitem`` ...).  Each query below starts from them with the
same adapter as ``marginlens.sources.testdata`` and the same cleaning rules,
written in DuckDB's dialect:

* ``try_strptime(x, '%d/%m/%Y')`` for ``try_to_date(x, 'd/M/yyyy')``;
* ``strftime(x, '%-d/%-m/%Y')`` for ``date_format(x, 'd/M/yyyy')``;
* ``ASC NULLS FIRST`` written out (DuckDB sorts NULLs last by default);
* DuckDB's BIGINT years, ntiles and date differences and HUGEINT integer
  sums are cast to Spark's INTEGER / BIGINT.
"""

from __future__ import annotations

AS_OF = "2001-08-01"  # fixed recency date for the churn queries (latest order date)

_DMY = "'%d/%m/%Y'"


def parsed(col: str) -> str:
    return f"CAST(try_strptime({col}, {_DMY}) AS DATE)"


def year_of(col: str = '"Order Date"') -> str:
    return f"CAST(year({parsed(col)}) AS INTEGER)"


def money(col: str) -> str:
    """Wide enough to hold every amount's text; not the engine's own type."""
    return f"CAST({col} AS DECIMAL(38,10))"


def round_money(expr: str) -> str:
    return f"CAST(ROUND({expr}, 2) AS DOUBLE)"


# --- adapter ----------------------------------------------------------------

_NULL = "CAST(NULL AS VARCHAR)"


def _customers(dirty: bool, raw_names: bool = False) -> str:
    name = "c.c_name" if raw_names else "translate(c.c_name, '#0123456789', ' ABCDEFGHIJ')"
    cid = "CASE WHEN c.c_custkey % 37 = 0 THEN NULL ELSE c.c_custkey END" if dirty else "c.c_custkey"
    body = f"""
    SELECT {cid} AS "Customer ID", {name} AS "Customer Name", {_NULL} AS email, {_NULL} AS phone,
           {_NULL} AS address, c.c_mktsegment AS "Segment", n.n_name AS "Country", {_NULL} AS "City",
           {_NULL} AS "State", {_NULL} AS "Postal Code", r.r_name AS "Region"
    FROM customer c LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
                    LEFT JOIN region r ON n.n_regionkey = r.r_regionkey"""
    if dirty:
        body += f"""
    UNION ALL
    SELECT c.c_custkey, c.c_name, {_NULL}, {_NULL}, {_NULL}, 'DUPLICATE', n.n_name, {_NULL}, {_NULL}, {_NULL}, r.r_name
    FROM customer c LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
                    LEFT JOIN region r ON n.n_regionkey = r.r_regionkey
    WHERE c.c_custkey % 11 = 0"""
    return body


def _products(dirty: bool) -> str:
    pid = "CASE WHEN p_partkey % 41 = 0 THEN NULL ELSE p_partkey END" if dirty else "p_partkey"
    price = "CASE WHEN p_partkey % 43 = 0 THEN NULL ELSE p_retailprice END" if dirty else "p_retailprice"
    body = f"""
    SELECT {pid} AS "Product ID", p_type AS "Category", p_brand AS "Sub-Category", p_name AS "Product Name",
           {_NULL} AS "State", {price} AS "Price per product"
    FROM part"""
    if dirty:
        body += f"""
    UNION ALL
    SELECT p_partkey, p_type, p_brand, p_name, {_NULL}, p_retailprice + 1 FROM part WHERE p_partkey % 13 = 0"""
    return body


def _orders(dirty: bool, profit: str | None = None, price: str = "l.l_extendedprice") -> str:
    profit = profit or ("CAST(CAST(l.l_extendedprice AS DECIMAL(12,2)) * (0.05 - CAST(l.l_discount AS DECIMAL(4,2))) "
                        "AS DOUBLE)")
    if dirty:
        oid = "CASE WHEN l.l_linenumber = 7 AND l.l_suppkey % 10 = 0 THEN NULL ELSE l.l_orderkey END"
        ship = ("CASE WHEN l.l_partkey % 17 = 0 THEN strftime(l.l_shipdate, '%Y-%m-%d') "
                "ELSE strftime(l.l_shipdate, '%-d/%-m/%Y') END")
        cid = ("CASE WHEN l.l_orderkey % 29 = 0 THEN NULL WHEN l.l_orderkey % 23 = 0 "
               "THEN o.o_custkey + 1000000 ELSE o.o_custkey END")
        pid = "CASE WHEN l.l_partkey % 31 = 0 THEN NULL ELSE l.l_partkey END"
    else:
        oid, ship = "l.l_orderkey", "strftime(l.l_shipdate, '%-d/%-m/%Y')"
        cid, pid = "o.o_custkey", "l.l_partkey"
    return f"""
    SELECT CAST(l.l_linenumber AS BIGINT) * 1000000000000 + l.l_partkey * 100000 + l.l_suppkey AS "Row ID",
           {oid} AS "Order ID", strftime(o.o_orderdate, '%-d/%-m/%Y') AS "Order Date", {ship} AS "Ship Date",
           o.o_orderpriority AS "Ship Mode", {cid} AS "Customer ID", {pid} AS "Product ID",
           CAST(l.l_quantity AS INTEGER) AS "Quantity", {price} AS "Price", l.l_discount AS "Discount",
           {profit} AS "Profit"
    FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey"""


# --- cleaning ---------------------------------------------------------------

ORDER_TIEBREAK = ['"Row ID"', '"Order Date"', '"Ship Date"', '"Ship Mode"', '"Customer ID"', '"Product ID"',
                  '"Quantity"', '"Price"', '"Discount"', '"Profit"']
CUSTOMER_TIEBREAK = ['"Customer Name"', "email", "phone", "address", '"Segment"', '"Country"', '"City"',
                     '"State"', '"Postal Code"', '"Region"']
PRODUCT_TIEBREAK = ['"Category"', '"Sub-Category"', '"Product Name"', '"State"', '"Price per product"']


def order_by(cols: list[str]) -> str:
    return ", ".join(f"{c} ASC NULLS FIRST" for c in cols)


def keep_first(source: str, key: str, tiebreak: list[str], where: str = "TRUE") -> str:
    return f"""
    SELECT * EXCLUDE (__rn) FROM (
      SELECT *, row_number() OVER (PARTITION BY {key} ORDER BY {order_by(tiebreak)}) AS __rn
      FROM {source} WHERE {where}) WHERE __rn = 1"""


ORDER_DATE, SHIP_DATE, PROFIT, PRICE = '"Order Date"', '"Ship Date"', '"Profit"', '"Price"'
DATES_VALID = f"{parsed(ORDER_DATE)} IS NOT NULL AND {parsed(SHIP_DATE)} IS NOT NULL"
CLEAN_NAME = r"""trim(regexp_replace(regexp_replace("Customer Name", '[^a-zA-Z\s]', '', 'g'), '\s+', ' ', 'g'))"""


def ctes(dirty: bool = False, **amounts: str) -> str:
    """WITH clause defining src_*, cln_* and ``enriched`` over the raw views;
    ``profit`` and ``price`` replace the amounts of the order lines."""
    dedup = keep_first("src_orders", '"Order ID"', ORDER_TIEBREAK, '"Profit" >= 0 AND "Order ID" IS NOT NULL')
    return f"""WITH
  src_customers AS ({_customers(dirty)}),
  src_products AS ({_products(dirty)}),
  src_orders AS ({_orders(dirty, **amounts)}),
  cln_orders AS (
    SELECT * FROM ({dedup})
    WHERE {DATES_VALID} AND "Customer ID" IS NOT NULL AND "Product ID" IS NOT NULL),
  named_customers AS (SELECT * REPLACE ({CLEAN_NAME} AS "Customer Name") FROM src_customers),
  cln_customers AS ({keep_first("named_customers", '"Customer ID"', CUSTOMER_TIEBREAK, '"Customer ID" IS NOT NULL')}),
  cln_products AS ({keep_first("src_products", '"Product ID"', PRODUCT_TIEBREAK, '"Product ID" IS NOT NULL')}),
  enriched AS (
    SELECT o."Order ID", o."Order Date", o."Ship Date", o."Ship Mode", c."Customer Name", c."Country",
           p."Category", p."Sub-Category", p."Product Name", o."Quantity", o."Price", o."Discount",
           {round_money(money('o."Profit"'))} AS "Profit"
    FROM cln_orders o JOIN cln_customers c ON o."Customer ID" = c."Customer ID"
                      JOIN cln_products p ON o."Product ID" = p."Product ID")
"""


def raw_customers_names() -> str:
    return f"WITH src_customers AS ({_customers(False, raw_names=True)})\n"


# --- profit aggregates ------------------------------------------------------

TOTAL_PROFIT = round_money(f"SUM({money(PROFIT)})") + ' AS "Total_Profit"'


def profit_summary_sql(source: str = "enriched") -> str:
    return f"""
    SELECT {year_of()} AS "Year", "Category", "Sub-Category", "Customer Name", {TOTAL_PROFIT},
           COUNT("Order ID") AS "Order_Count"
    FROM {source} GROUP BY ALL"""


def aggregate_sql(keys: list[str], source: str = "enriched") -> str:
    cols = ", ".join(f'{year_of()} AS "Year"' if k == "Year" else f'"{k}"' for k in keys)
    return f"""
    SELECT {cols}, {TOTAL_PROFIT}, COUNT(DISTINCT "Order ID") AS "Order_Count"
    FROM {source} GROUP BY ALL"""


# --- sums of amounts beyond any decimal ---------------------------------------

JOINED = """cln_orders o JOIN cln_customers c ON o."Customer ID" = c."Customer ID"
                      JOIN cln_products p ON o."Product ID" = p."Product ID\""""


def _units(column: str, unit: str) -> str:
    """The sum of whole multiples of a unit, as the double nearest to it."""
    return f"CAST(CAST(CAST(SUM(ROUND({column} / CAST('1{unit}' AS DOUBLE))) AS BIGINT) AS VARCHAR) || '{unit}' AS DOUBLE)"


def scaled_by_customer(unit: str) -> str:
    return f"""
    SELECT "Customer Name", {_units('o."Profit"', unit)} AS "Total_Profit", COUNT(*) AS "Order_Count"
    FROM {JOINED} GROUP BY ALL"""


def scaled_lifetime_value(unit: str) -> str:
    return f""",
  m AS (SELECT "Customer ID", {_units(PRICE, unit)} AS total_sales, {_units(PROFIT, unit)} AS total_profit, COUNT(*) AS total_orders
        FROM cln_orders GROUP BY "Customer ID")
SELECT * FROM cln_customers LEFT JOIN m USING ("Customer ID")"""


def mixed_by_year() -> str:
    """Large amounts are added up first, then the usual ones; 1e-300 rounds to no cents."""
    large, small = 'CASE WHEN "Profit" >= 1e15 THEN "Profit" ELSE 0 END', 'CASE WHEN "Profit" < 1e15 THEN "Profit" ELSE 0 END'
    return f"""
    SELECT {year_of()} AS "Year", {_units(large, "e16")} + CAST(SUM(CAST(ROUND(({small}) * 4) AS BIGINT)) AS DOUBLE) / 4 AS "Total_Profit",
           COUNT(*) AS "Order_Count"
    FROM {JOINED} GROUP BY ALL"""


# --- cleaning report --------------------------------------------------------

def _report_rows(table: str, rules: list[str]) -> str:
    names = ["original", *rules, "final"]
    counts = ", ".join(
        ["COUNT(*) AS original"]
        + [f"COUNT_IF(reason = '{r}') AS {r}" for r in rules]
        + ["COUNT_IF(reason IS NULL) AS final"]
    )
    rows = [
        f"SELECT '{table}' AS table_name, {i} AS step, '{n}' AS rule, CAST({n} AS BIGINT) AS row_count FROM {table}_counts"
        for i, n in enumerate(names)
    ]
    rows.append(
        f"SELECT '{table}', {len(names)}, 'total_removed', CAST(original - final AS BIGINT) FROM {table}_counts"
    )
    return f"{table}_counts AS (SELECT {counts} FROM {table}_tagged)", "\n    UNION ALL ".join(rows)


ORDER_RULES = ["null_profit", "negative_profit", "null_order_id", "duplicate_order_id",
               "invalid_date", "null_customer_id", "null_product_id"]


def cleaning_report_sql() -> str:
    survived = '"Profit" >= 0 AND "Order ID" IS NOT NULL'
    orders_tagged = f"""orders_tagged AS (
    SELECT CASE WHEN "Profit" IS NULL THEN 'null_profit' WHEN "Profit" < 0 THEN 'negative_profit'
                WHEN "Order ID" IS NULL THEN 'null_order_id'
                WHEN row_number() OVER (PARTITION BY "Order ID", CASE WHEN {survived} THEN 0 ELSE 1 END
                                        ORDER BY {order_by(ORDER_TIEBREAK)}) > 1 THEN 'duplicate_order_id'
                WHEN NOT ({DATES_VALID}) THEN 'invalid_date'
                WHEN "Customer ID" IS NULL THEN 'null_customer_id'
                WHEN "Product ID" IS NULL THEN 'null_product_id' END AS reason
    FROM src_orders)"""

    def id_tagged(table: str, source: str, key: str, prefix: str, tiebreak: list[str]) -> str:
        return f"""{table}_tagged AS (
    SELECT CASE WHEN {key} IS NULL THEN 'null_{prefix}_id'
                WHEN row_number() OVER (PARTITION BY {key} ORDER BY {order_by(tiebreak)}) > 1
                THEN 'duplicate_{prefix}_id' END AS reason
    FROM {source})"""

    parts = [
        (orders_tagged, *_report_rows("orders", ORDER_RULES)),
        (id_tagged("customers", "named_customers", '"Customer ID"', "customer", CUSTOMER_TIEBREAK),
         *_report_rows("customers", ["null_customer_id", "duplicate_customer_id"])),
        (id_tagged("products", "src_products", '"Product ID"', "product", PRODUCT_TIEBREAK),
         *_report_rows("products", ["null_product_id", "duplicate_product_id"])),
    ]
    defs = ",\n  ".join(f"{tagged},\n  {counts}" for tagged, counts, _ in parts)
    selects = "\n    UNION ALL ".join(rows for _, _, rows in parts)
    return f",\n  {defs}\n    {selects}"


# --- customer enrichment ----------------------------------------------------

CHURN = """CASE WHEN days_since_last_order > 180 THEN 'High Risk'
                WHEN days_since_last_order > 90 THEN 'Medium Risk' ELSE 'Low Risk' END"""
DAYS = f"CAST(date_diff('day', MAX({parsed(ORDER_DATE)}), DATE '{AS_OF}') AS INTEGER) AS days_since_last_order"


def lifetime_value_sql() -> str:
    return f""",
  m AS (SELECT "Customer ID", CAST(SUM({money(PRICE)}) AS DOUBLE) AS total_sales,
               CAST(SUM({money(PROFIT)}) AS DOUBLE) AS total_profit, COUNT(DISTINCT "Order ID") AS total_orders
        FROM cln_orders WHERE "Price" >= 0 GROUP BY "Customer ID")
SELECT * FROM cln_customers LEFT JOIN m USING ("Customer ID")"""


AOV = f"CAST(SUM({money(PRICE)}) AS DOUBLE) / COUNT(DISTINCT \"Order ID\")"


def average_basket_sql() -> str:
    return f""",
  m AS (SELECT "Customer ID", {AOV} AS average_order_value FROM cln_orders GROUP BY "Customer ID")
SELECT * FROM src_customers LEFT JOIN m USING ("Customer ID")"""


def product_variety_sql() -> str:
    return """,
  m AS (SELECT "Customer ID", COUNT(DISTINCT "Product ID") AS unique_products_purchased
        FROM cln_orders GROUP BY "Customer ID")
SELECT * FROM src_customers LEFT JOIN m USING ("Customer ID")"""


def churn_risk_sql() -> str:
    return f""",
  d AS (SELECT "Customer ID", {DAYS} FROM cln_orders GROUP BY "Customer ID"),
  m AS (SELECT *, {CHURN} AS churn_risk_score FROM d)
SELECT * FROM src_customers LEFT JOIN m USING ("Customer ID")"""


def customer_metrics_cte() -> str:
    valid = '"Price" >= 0'
    return f"""d AS (
    SELECT "Customer ID",
           CAST(SUM(CASE WHEN {valid} THEN {money(PRICE)} END) AS DOUBLE) AS total_sales,
           CAST(SUM(CASE WHEN {valid} THEN {money(PROFIT)} END) AS DOUBLE) AS total_profit,
           NULLIF(COUNT(DISTINCT CASE WHEN {valid} THEN "Order ID" END), 0) AS total_orders,
           {AOV} AS average_order_value,
           COUNT(DISTINCT "Product ID") AS unique_products_purchased,
           {DAYS}
    FROM cln_orders GROUP BY "Customer ID"),
  m AS (SELECT *, {CHURN} AS churn_risk_score FROM d)"""


def enriched_customers_sql() -> str:
    return f""",
  {customer_metrics_cte()},
  enriched_customers AS (SELECT * FROM cln_customers LEFT JOIN m USING ("Customer ID"))
SELECT * FROM enriched_customers"""


# --- product enrichment -----------------------------------------------------

PRICE_POSITION = """CASE WHEN price_tier = 4 THEN 'Premium' WHEN price_tier IN (2, 3) THEN 'Mid-Range'
                ELSE 'Budget' END"""
VELOCITY = """CASE WHEN total_quantity_sold > 100 THEN 'Fast Moving'
                WHEN total_quantity_sold > 20 THEN 'Medium Moving' ELSE 'Slow Moving' END"""


def tiered_cte(source: str = "cln_products") -> str:
    return f"""tiered AS (
    SELECT *, {PRICE_POSITION} AS price_position FROM (
      SELECT *, CAST(ntile(4) OVER (PARTITION BY "Category"
                     ORDER BY "Price per product" ASC NULLS FIRST, "Product ID" ASC NULLS FIRST,
                              "Sub-Category" ASC NULLS FIRST, "Product Name" ASC NULLS FIRST,
                              "State" ASC NULLS FIRST) AS INTEGER)
             AS price_tier
      FROM {source}))"""


SOLD = """sold AS (SELECT "Product ID", CAST(SUM("Quantity") AS BIGINT) AS total_quantity_sold
                FROM cln_orders GROUP BY "Product ID")"""


def price_tier_sql() -> str:
    return f""",
  {tiered_cte()}
SELECT * FROM tiered"""


def sales_velocity_sql() -> str:
    return f""",
  {SOLD},
  j AS (SELECT * REPLACE (COALESCE("Price per product", 0) AS "Price per product",
                          COALESCE(total_quantity_sold, 0) AS total_quantity_sold)
        FROM cln_products LEFT JOIN sold USING ("Product ID"))
SELECT *, {VELOCITY} AS inventory_velocity FROM j"""


def enriched_products_sql() -> str:
    return f""",
  {tiered_cte()},
  {SOLD},
  j AS (SELECT * REPLACE (COALESCE("Price per product", 0) AS "Price per product",
                          COALESCE(price_tier, 0) AS price_tier,
                          COALESCE(total_quantity_sold, 0) AS total_quantity_sold)
        FROM tiered LEFT JOIN sold USING ("Product ID")),
  enriched_products AS (SELECT *, {VELOCITY} AS inventory_velocity FROM j)
SELECT * FROM enriched_products"""


# --- reports ----------------------------------------------------------------

def round_double(expr: str) -> str:
    """Spark's ``round(double, 2)``: HALF_UP on the value's decimal text."""
    return f"CAST(ROUND(CAST({expr} AS DECIMAL(38,10)), 2) AS DOUBLE)"


def exact_sum(col: str) -> str:
    return f"SUM({money(col)})"


def mean(col: str) -> str:
    return f"CAST({exact_sum(col)} AS DOUBLE) / COUNT({col})"


SUMMARY_KEYS_ASC = '"Year" ASC NULLS FIRST, "Category" ASC NULLS FIRST, "Sub-Category" ASC NULLS FIRST, ' \
                   '"Customer Name" ASC NULLS FIRST'


def with_aggregates() -> str:
    """Extra CTEs: the summary and the four aggregates over ``enriched``."""
    return f""",
  summary AS ({profit_summary_sql()}),
  by_year AS ({aggregate_sql(["Year"])}),
  by_year_category AS ({aggregate_sql(["Year", "Category"])}),
  by_customer AS ({aggregate_sql(["Customer Name"])}),
  by_customer_year AS ({aggregate_sql(["Customer Name", "Year"])})
"""


TP = '"Total_Profit"'
BY_CUSTOMER_ORDER = '"Total_Profit" DESC NULLS LAST, "Customer Name" ASC NULLS FIRST'

REPORT_SQL = {
    "r1": f"""SELECT {round_money(exact_sum(TP))} AS Total_Profit_All_Groups,
       {round_double(mean(TP))} AS Average_Profit_Per_Group,
       {round_money(money(f"MAX({TP})"))} AS Max_Profit_Group,
       {round_money(money(f"MIN({TP})"))} AS Min_Profit_Group,
       COUNT(*) AS Total_Groups FROM summary""",
    "r2": f"""SELECT "Year", {round_money(exact_sum(TP))} AS Yearly_Profit, COUNT(*) AS Groups_Per_Year
       FROM summary GROUP BY "Year" """,
    "r3": f"""SELECT "Category", {round_money(exact_sum(TP))} AS Category_Profit, COUNT(*) AS Groups_Per_Category
       FROM summary GROUP BY "Category" """,
    "r4": f"SELECT * FROM summary ORDER BY {TP} DESC NULLS LAST, {SUMMARY_KEYS_ASC} LIMIT 5",
    "r5": f"SELECT * FROM summary ORDER BY {TP} ASC NULLS LAST, {SUMMARY_KEYS_ASC} LIMIT 5",
    "r6": f"""SELECT "Year", CAST({exact_sum(TP)} AS DOUBLE) AS Total_Profit, COUNT(*) AS Groups
       FROM summary GROUP BY "Year" """,
    "r7": f"""SELECT "Customer Name", CAST({exact_sum(TP)} AS DOUBLE) AS Total_Customer_Profit,
       COUNT(*) AS Order_Groups FROM summary GROUP BY "Customer Name"
       ORDER BY Total_Customer_Profit DESC NULLS LAST, "Customer Name" ASC NULLS FIRST LIMIT 10""",
    "r8": f"""SELECT "Category", "Sub-Category", CAST({exact_sum(TP)} AS DOUBLE) AS Total_Profit, COUNT(*) AS Groups
       FROM summary GROUP BY "Category", "Sub-Category" """,
    "r14": f"SELECT * FROM by_customer ORDER BY {BY_CUSTOMER_ORDER} LIMIT 10",
    "r15_year": 'SELECT * FROM by_year ORDER BY "Year" ASC NULLS FIRST LIMIT 10',
    "r15_year_category": 'SELECT * FROM by_year_category ORDER BY "Year" ASC NULLS FIRST, '
                         '"Category" ASC NULLS FIRST LIMIT 15',
    "r15_customer_year": 'SELECT * FROM by_customer_year ORDER BY "Year" ASC NULLS FIRST, '
                         '"Customer Name" ASC NULLS FIRST LIMIT 15',
    "r16": f"""SELECT *, {round_money(f'SUM({money(TP)}) OVER (PARTITION BY "Customer Name")')}
         AS Customer_Total_Profit
       FROM by_customer_year WHERE "Customer Name" IN (
         SELECT "Customer Name" FROM by_customer ORDER BY {BY_CUSTOMER_ORDER} LIMIT 5)""",
    "r17": f"""SELECT {round_money(exact_sum(TP))} AS Total_Profit, CAST(SUM("Order_Count") AS BIGINT) AS Total_Orders,
       {round_double(mean(TP))} AS Average_Profit_Per_Year FROM by_year""",
    "r18": f"""SELECT COUNT(*) AS Total_Customers, {round_double(mean(TP))} AS Average_Customer_Profit,
       MAX({TP}) AS Max_Customer_Profit, MIN({TP}) AS Min_Customer_Profit FROM by_customer""",
    "r19": f"""SELECT "Category", {round_money(exact_sum(TP))} AS Category_Profit
       FROM by_year_category GROUP BY "Category" """,
}

CUSTOMER_REPORT_SQL = {
    "r9": f"""SELECT "Customer ID", "Customer Name", {round_double("average_order_value")} AS average_order_value
       FROM enriched_customers
       ORDER BY average_order_value DESC NULLS LAST, "Customer ID" ASC NULLS FIRST LIMIT 5""",
    "r10": """SELECT "Customer ID", "Customer Name", unique_products_purchased FROM enriched_customers
       ORDER BY unique_products_purchased DESC NULLS LAST, "Customer ID" ASC NULLS FIRST LIMIT 5""",
    "r11": """SELECT "Customer ID", "Customer Name", days_since_last_order, churn_risk_score FROM enriched_customers
       WHERE days_since_last_order IS NOT NULL
       ORDER BY days_since_last_order DESC, "Customer ID" ASC NULLS FIRST LIMIT 5""",
}


# --- previews ---------------------------------------------------------------

CUSTOMER_COLUMNS = ['"Customer ID"', *CUSTOMER_TIEBREAK]
ORDER_COLUMNS = ['"Row ID"', '"Order ID"', '"Order Date"', '"Ship Date"', '"Ship Mode"', '"Customer ID"',
                 '"Product ID"', '"Quantity"', '"Price"', '"Discount"', '"Profit"']
PRODUCT_COLUMNS = ['"Product ID"', *PRODUCT_TIEBREAK]
ENRICHED_ORDER_COLUMNS = ['"Order ID"', '"Order Date"', '"Ship Date"', '"Ship Mode"', '"Customer Name"',
                          '"Country"', '"Category"', '"Sub-Category"', '"Product Name"', '"Quantity"', '"Price"',
                          '"Discount"', '"Profit"']
CUSTOMER_METRIC_COLUMNS = ["total_sales", "total_profit", "total_orders", "average_order_value",
                           "unique_products_purchased", "days_since_last_order", "churn_risk_score"]
PRODUCT_METRIC_COLUMNS = ["price_tier", "price_position", "total_quantity_sold", "inventory_velocity"]


def preview(source: str, columns: list[str], keys: list[str], select: list[str] | None, n: int) -> str:
    rest = [c for c in columns if c not in keys]
    cols = ", ".join(select) if select else "*"
    return f"SELECT {cols} FROM {source} ORDER BY {order_by(keys + rest)} LIMIT {n}"


PREVIEW_SQL = {
    "r12_raw_customers_preview": preview("raw_customers_vw", CUSTOMER_COLUMNS, ['"Customer ID"'],
                                         ['"Customer ID"', '"Customer Name"', '"Country"'], 3),
    "r12_raw_orders_preview": preview("raw_orders_vw", ORDER_COLUMNS, ['"Order ID"', '"Row ID"', '"Product ID"'],
                                      ['"Order ID"', '"Customer ID"', '"Product ID"', '"Quantity"'], 3),
    "r12_raw_products_preview": preview("raw_products_vw", PRODUCT_COLUMNS, ['"Product ID"'],
                                        ['"Product ID"', '"Category"', '"Sub-Category"', '"Product Name"'], 3),
    "r13_enriched_customers_preview": preview("enriched_customers", CUSTOMER_COLUMNS + CUSTOMER_METRIC_COLUMNS,
                                              ['"Customer ID"'], None, 5),
    "r13_enriched_products_preview": preview("enriched_products", PRODUCT_COLUMNS + PRODUCT_METRIC_COLUMNS,
                                             ['"Product ID"'], None, 5),
    "r13_enriched_orders_preview": preview("enriched", ENRICHED_ORDER_COLUMNS, ['"Order ID"'], None, 5),
}

RAW_VIEW_CTES = """,
  raw_customers_vw AS (SELECT * FROM src_customers),
  raw_orders_vw AS (SELECT * FROM src_orders),
  raw_products_vw AS (SELECT * FROM src_products)
"""


# --- validators -------------------------------------------------------------

def report_rows(source: str, checks: list[str], passed: dict[str, str] | None = None) -> str:
    passed = passed or {}
    return "\nUNION ALL ".join(
        f"""SELECT '{c}' AS "check", CAST({c} AS BIGINT) AS violations, {passed.get(c, f"{c} = 0")} AS passed
        FROM {source}"""
        for c in checks
    )


def _invalid(col: str, allowed: list[str]) -> str:
    values = ", ".join(f"'{v}'" for v in allowed)
    return f"{col} IS NOT NULL AND {col} NOT IN ({values})"


def keyed_validation(source: str, key: str, checks: dict[str, str], null_name: str, dup_name: str) -> str:
    per_key = ", ".join(f"COUNT_IF({cond}) AS {name}" for name, cond in checks.items())
    sums = ", ".join(f"COALESCE(SUM({name}), 0) AS {name}" for name in checks)
    return f""",
  v_key AS (SELECT {key} AS k, COUNT(*) AS n, {per_key} FROM {source} GROUP BY {key}),
  v_one AS (SELECT COALESCE(SUM(CASE WHEN k IS NULL THEN n END), 0) AS {null_name},
                   COUNT_IF(n > 1) AS {dup_name}, {sums} FROM v_key)
{report_rows("v_one", [null_name, dup_name, *checks])}"""


V1_CHECKS = {
    "negative_sales_or_profit": "total_sales < 0 OR total_profit < 0",
    "invalid_churn_risk_score": _invalid("churn_risk_score", ["Low Risk", "Medium Risk", "High Risk"]),
}
V2_CHECKS = {
    "negative_quantity": "total_quantity_sold < 0",
    "invalid_price_position": _invalid("price_position", ["Premium", "Mid-Range", "Budget"]),
    "invalid_inventory_velocity": _invalid("inventory_velocity", ["Fast Moving", "Medium Moving", "Slow Moving"]),
}

V3_NULLS = {"null_order_id": '"Order ID"', "null_customer_name": '"Customer Name"',
            "null_product_name": '"Product Name"', "null_order_date": '"Order Date"'}


def v3_sql() -> str:
    counts = ", ".join(f"COUNT_IF({c} IS NULL) AS {n}" for n, c in V3_NULLS.items())
    return f""",
  v_one AS (SELECT (SELECT COUNT(*) FROM src_orders) - COUNT(*) AS row_count_mismatch, {counts},
                   COUNT_IF("Quantity" <= 0) AS non_positive_quantity, COUNT_IF("Price" < 0) AS negative_price
            FROM enriched)
{report_rows("v_one", ["row_count_mismatch", *V3_NULLS, "non_positive_quantity", "negative_price"])}"""


def v4_sql() -> str:
    keys = {"null_year": '"Year"', "null_category": '"Category"', "null_sub_category": '"Sub-Category"',
            "null_customer_name": '"Customer Name"'}
    nulls = ", ".join(f"COALESCE(SUM(CASE WHEN {c} IS NULL THEN n END), 0) AS {name}" for name, c in keys.items())
    names = [*keys, "duplicate_rows", "null_total_profit", "non_positive_order_count", "summary_exceeds_source"]
    return f""",
  summary AS ({profit_summary_sql()}),
  v_key AS (SELECT "Year", "Category", "Sub-Category", "Customer Name", COUNT(*) AS n,
                   COUNT_IF("Total_Profit" IS NULL) AS ntp, COUNT_IF("Order_Count" <= 0) AS npo
            FROM summary GROUP BY ALL),
  v_one AS (SELECT {nulls}, COALESCE(SUM(n), 0) - COUNT(*) AS duplicate_rows,
                   COALESCE(SUM(ntp), 0) AS null_total_profit, COALESCE(SUM(npo), 0) AS non_positive_order_count,
                   GREATEST(COALESCE(SUM(n), 0) - (SELECT COUNT(*) FROM enriched), 0) AS summary_exceeds_source
            FROM v_key)
{report_rows("v_one", names)}"""


AGGREGATE_KEYS = {
    "profit_by_year": ["Year"],
    "profit_by_year_category": ["Year", "Category"],
    "profit_by_customer": ["Customer Name"],
    "profit_by_customer_year": ["Customer Name", "Year"],
}


def v5_sql(keys: list[str] | None = None, source: str = "enriched") -> str:
    return f""",
  by_year AS ({aggregate_sql(keys or ["Year"], source)}),
  v_one AS (SELECT COUNT(*) AS n, COUNT_IF("Total_Profit" IS NULL) AS null_total_profit,
                   COUNT_IF("Order_Count" IS NULL) AS null_order_count,
                   COUNT_IF("Order_Count" <= 0) AS non_positive_order_count,
                   CASE WHEN COUNT(*) = 0 THEN 1 ELSE 0 END AS empty_result,
                   CASE WHEN COUNT(*) = 0 THEN 1 ELSE 0 END AS valid FROM by_year)
{report_rows("v_one", ["empty_result", "null_total_profit", "null_order_count", "non_positive_order_count",
                        "valid"], passed={"valid": "n > 0"})}"""


def v5_empty_sql() -> str:
    text = v5_sql(source='(SELECT * FROM enriched WHERE "Profit" < 0)')
    for check in ('"Total_Profit" IS NULL', '"Order_Count" IS NULL', '"Order_Count" <= 0'):
        text = text.replace(f"COUNT_IF({check})", f"COUNT(*) FILTER ({check})")  # COUNT_IF of no rows is NULL
    return text


def v2_violations_sql() -> str:
    tiers, sold = tiered_cte("src_products"), SOLD
    return f""",
  {tiers},
  {sold},
  ep_j AS (SELECT * REPLACE (COALESCE(total_quantity_sold, 0) AS total_quantity_sold)
           FROM tiered LEFT JOIN sold USING ("Product ID")),
  ep_v AS (SELECT *, {VELOCITY} AS inventory_velocity FROM ep_j),
  spoilt AS (SELECT * REPLACE (
      CASE WHEN length("Product Name") % 3 = 0 THEN -total_quantity_sold ELSE total_quantity_sold END AS total_quantity_sold,
      CASE WHEN length("Product Name") % 4 = 0 THEN 'Luxury' ELSE price_position END AS price_position,
      CASE WHEN length("Product Name") % 5 = 0 THEN 'Stuck' ELSE inventory_velocity END AS inventory_velocity) FROM ep_v)
{keyed_validation("spoilt", '"Product ID"', V2_CHECKS, "null_product_id", "duplicate_product_id")}"""


def v4_violations_sql() -> str:
    text = v4_sql().replace("(SELECT COUNT(*) FROM enriched)", '(SELECT COUNT(*) FROM enriched WHERE "Order ID" % 2 = 0)')
    both = f"""summary_once AS ({profit_summary_sql()}),
  summary AS (SELECT * FROM summary_once UNION ALL BY NAME SELECT * REPLACE (
      CASE WHEN "Order_Count" > 1 THEN NULL ELSE "Category" END AS "Category",
      CASE WHEN "Year" % 2 = 0 THEN NULL ELSE "Total_Profit" END AS "Total_Profit",
      CASE WHEN "Year" % 3 = 0 THEN 0 ELSE "Order_Count" END AS "Order_Count") FROM summary_once)"""
    return text.replace(f"summary AS ({profit_summary_sql()})", both)


_ORPHANS = """,
  lost AS (SELECT o.*, o."Customer ID" NOT IN (SELECT "Customer ID" FROM cln_customers) AS no_customer,
                  o."Product ID" NOT IN (SELECT "Product ID" FROM cln_products) AS no_product FROM cln_orders o)
"""


def v3_orphans_sql() -> str:
    counts = {"missing_customer": "no_customer", "missing_product": "no_product", "missing_both": "no_customer AND no_product",
              "lost_orders": "no_customer OR no_product"}
    cells = ", ".join(f"COUNT_IF({c}) AS {n}" for n, c in counts.items())
    return f"""{_ORPHANS.rstrip()},
  v_one AS (SELECT {cells} FROM lost)
{report_rows("v_one", list(counts))}"""


def v3_orphan_orders_sql() -> str:
    return _ORPHANS + "SELECT * FROM lost WHERE no_customer OR no_product"


# --- profiles ---------------------------------------------------------------

SOURCE_TYPES = {
    "customers": [("Customer ID", "bigint"), ("Customer Name", "string"), ("email", "string"),
                  ("phone", "string"), ("address", "string"), ("Segment", "string"), ("Country", "string"),
                  ("City", "string"), ("State", "string"), ("Postal Code", "string"), ("Region", "string")],
    "orders": [("Row ID", "bigint"), ("Order ID", "bigint"), ("Order Date", "string"), ("Ship Date", "string"),
               ("Ship Mode", "string"), ("Customer ID", "bigint"), ("Product ID", "bigint"), ("Quantity", "int"),
               ("Price", "double"), ("Discount", "double"), ("Profit", "double")],
    "products": [("Product ID", "bigint"), ("Category", "string"), ("Sub-Category", "string"),
                 ("Product Name", "string"), ("State", "string"), ("Price per product", "double")],
}


def profile_sql(table: str) -> str:
    values = ", ".join(f"('{n}', {i}, '{t}')" for i, (n, t) in enumerate(SOURCE_TYPES[table], start=1))
    return f"""
SELECT '{table}' AS table_name, c.column_name, CAST(c.ordinal AS INTEGER) AS ordinal, c.data_type,
       cnt.record_count, 'Passed' AS status
FROM (SELECT COUNT(*) AS record_count FROM src_{table}) cnt,
     (VALUES {values}) AS c(column_name, ordinal, data_type)"""


def profile_samples_sql(table: str) -> str:
    names = [n for n, _ in SOURCE_TYPES[table]]
    up, down = (", ".join(f'"{n}" {way}' for n in names) for way in ("ASC NULLS FIRST", "DESC NULLS LAST"))
    cells = "\nUNION ALL ".join(
        f"""SELECT '{table}' AS table_name, sample, '{n}' AS column_name, {i} AS ordinal, CAST("{n}" AS VARCHAR) AS value FROM both_rows"""
        for i, n in enumerate(names, start=1))
    return f""",
  both_rows AS (SELECT 1 AS sample, * FROM (SELECT * FROM src_{table} ORDER BY {up} LIMIT 1)
                UNION ALL SELECT 2, * FROM (SELECT * FROM src_{table} ORDER BY {down} LIMIT 1) WHERE (SELECT COUNT(*) FROM src_{table}) > 1)
{cells}"""


def profile_summary_sql(table: str) -> str:
    return f"""
SELECT '{table}' AS table_name, TRUE AS dataframe_created, {len(SOURCE_TYPES[table])} AS total_columns,
       COUNT(*) AS number_of_records, 'Passed' AS status, CAST(NULL AS VARCHAR) AS error FROM src_{table}"""


def profile_failed_sql() -> str:
    return f"""{profile_summary_sql("customers")} UNION ALL {profile_summary_sql("orders")}
UNION ALL SELECT 'products', FALSE, 0, 0, 'Failed', 'path not found'"""


def enriched_customers_ctes() -> str:
    return f""",
  {customer_metrics_cte()},
  enriched_customers AS (SELECT * FROM cln_customers LEFT JOIN m USING ("Customer ID"))
"""


def enriched_products_ctes() -> str:
    return f""",
  {tiered_cte()},
  {SOLD},
  ep_j AS (SELECT * REPLACE (COALESCE("Price per product", 0) AS "Price per product",
                             COALESCE(price_tier, 0) AS price_tier,
                             COALESCE(total_quantity_sold, 0) AS total_quantity_sold)
           FROM tiered LEFT JOIN sold USING ("Product ID")),
  enriched_products AS (SELECT *, {VELOCITY} AS inventory_velocity FROM ep_j)
"""


def unclean_customers_ctes() -> str:
    """Enriched customers without customer cleaning (NULL and repeated ids kept)."""
    return f""",
  {customer_metrics_cte()},
  enriched_customers AS (SELECT * FROM src_customers LEFT JOIN m USING ("Customer ID"))
"""


# --- source round trips -----------------------------------------------------

S2_ROUNDTRIP = """
SELECT "Row ID", CAST("Order ID" AS VARCHAR) AS "Order ID", "Order Date", "Ship Date", "Ship Mode",
       CAST("Customer ID" AS VARCHAR) AS "Customer ID", CAST("Product ID" AS VARCHAR) AS "Product ID",
       "Quantity", "Price", "Discount", "Profit"
FROM src_orders"""
S3_ROUNDTRIP = """
SELECT CAST("Product ID" AS VARCHAR) AS "Product ID", "Category", "Sub-Category", "Product Name", "State",
       "Price per product"
FROM src_products"""
S1_ROUNDTRIP = """
SELECT CAST("Customer ID" AS VARCHAR) AS "Customer ID", "Customer Name", email, phone, address, "Segment",
       "Country", "City", "State", "Postal Code", "Region"
FROM src_customers"""

# Every 50th record is cut off, every 50th has a quantity that is no number.
S4_QUARANTINE = """
SELECT '{"Row ID":' || "Row ID" || CASE WHEN "Row ID" % 50 = 0 THEN '' ELSE ',"Quantity":"many"}' END AS record
FROM src_orders WHERE "Row ID" % 50 < 2"""
S4_ACCEPTED = S2_ROUNDTRIP + """ WHERE "Row ID" % 50 >= 2"""
