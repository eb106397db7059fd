"""Product enrichment.

Price tiers are ``ntile(4)`` over each category ordered by price (NULL
prices first, ``Product ID`` breaking ties so the result is deterministic).

``ntile`` over ``Window.partitionBy(Category)`` puts a whole category in one
task.  With a handful of categories and billions of products that task is
the job.  ``method="range"`` (the default) computes the same tiers from a
distributed rank instead:

1. range-partition the products by (category, price, id, other columns)
   into a fixed number of partitions and sort inside each partition, so
   partitions hold consecutive runs of the global order;
2. tag each row with its partition (``spark_partition_id``) and an id that
   increases along the partition (``monotonically_increasing_id``), so
   position inside a (partition, category) run = id - the run's first id;
3. count rows per (partition, category) - a table of at most
   partitions + categories - 1 rows, since each partition holds one
   contiguous range of categories - and turn the counts into per-category
   prefix offsets and totals with a small window;
4. rank = offset + position inside the partition; with ``q = n div 4`` and
   ``m = n mod 4`` the first ``m`` tiers hold ``q + 1`` rows and the rest
   ``q``, which is how ``ntile`` deals rows out.

Steps 3 and 4 read the numbered rows twice.  Spark does not share work that
carries a nondeterministic expression, and its range partitioner seeds the
sample it draws its bounds from with the id of the RDD being built, so two
evaluations could cut the ranges differently and disagree on positions.
The numbered rows are therefore written once as a reliable checkpoint in
the session's ``spark.checkpoint.dir`` (shared storage on a cluster) and
both readers use that copy; it also means a lost executor cannot renumber
anything.  The offsets table is checkpointed too and its rows counted: when
it is within ``BROADCAST_RUNS`` rows it is broadcast to the numbered rows,
which then stay where the range partitioning put them; beyond that both
sides are hash-partitioned on the run key.  These writes and the count
happen when the function is called.

Nothing is collected to the driver but that one count; only the sample and
the offsets table grow with the number of categories.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marginlens import schemas as s
from marginlens.functions.labels import price_position_label, velocity_label
from marginlens.operators.cleaning import clean_orders, clean_products, tiebreak_order
from marginlens.plans.session import ensure_checkpoint_dir


def _c(name: str) -> Column:
    return F.col(f"`{name}`")


def _tier_order(df: DataFrame) -> list[Column]:
    """Price (NULL first), then ``Product ID``, then the remaining columns so
    the order is total even if ids repeat."""
    head = [_c(s.UNIT_PRICE).asc_nulls_first(), _c(s.PRODUCT_ID).asc_nulls_first()]
    return head + tiebreak_order(df, [s.CATEGORY, s.UNIT_PRICE, s.PRODUCT_ID])


def _with_position(df: DataFrame) -> DataFrame:
    return df.withColumn("price_position", price_position_label(F.col("price_tier")))


def _tiers_window(products: DataFrame) -> DataFrame:
    window = Window.partitionBy(_c(s.CATEGORY)).orderBy(*_tier_order(products))
    return products.withColumn("price_tier", F.ntile(s.PRICE_TIERS).over(window))


def ntile_from_rank(rank: Column, total: Column, buckets: int = s.PRICE_TIERS) -> Column:
    """1-based ``ntile(buckets)`` of the row with 0-based ``rank`` among ``total`` rows."""
    q = F.floor(total / buckets).cast("long")
    m = (total % buckets).cast("long")
    big = m * (q + 1)
    # q is 0 only when total < buckets, and then every rank takes the first branch.
    return (
        F.when(rank < big, F.floor(rank / (q + 1)) + 1)
        .otherwise(m + F.floor((rank - big) / F.greatest(q, F.lit(1))) + 1)
        .cast("int")
    )


_POS, _PART, _CK, _CN = "__pos", "__part", "__cat_key", "__cat_null"

# Largest offsets table (bytes of its longs and category texts) that is broadcast.
BROADCAST_BYTES = 32 << 20


def _tiers_range(
    products: DataFrame, partitions: int | None = None, broadcast_bytes: int = BROADCAST_BYTES
) -> DataFrame:
    order = [_c(s.CATEGORY).asc_nulls_first(), *_tier_order(products)]
    if partitions is None:
        configured = products.sparkSession.conf.get("spark.sql.shuffle.partitions")
        partitions = int(configured) if configured.isdigit() else products.sparkSession.sparkContext.defaultParallelism
    # Category as a plain equi-join key: its text plus a NULL flag, so a NULL
    # category is a group of its own (as in the window) and '' stays distinct.
    run_key = [F.col(_PART), F.col(_CK), F.col(_CN)]
    numbered = (
        products.repartitionByRange(partitions, *order)
        .sortWithinPartitions(*order)
        .withColumn(_PART, F.spark_partition_id())
        .withColumn(_POS, F.monotonically_increasing_id())
        .withColumn(_CK, F.coalesce(_c(s.CATEGORY).cast("string"), F.lit("")))
        .withColumn(_CN, _c(s.CATEGORY).isNull())
    )
    ensure_checkpoint_dir(products.sparkSession)
    numbered = numbered.checkpoint(eager=True)
    runs = numbered.groupBy(*run_key).agg(F.count(F.lit(1)).alias("__run"), F.min(_POS).alias("__first"))
    by_category = Window.partitionBy(F.col(_CK), F.col(_CN))
    before = by_category.orderBy(F.col(_PART)).rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.select(
        *run_key,
        "__first",
        F.coalesce(F.sum("__run").over(before), F.lit(0)).alias("__offset"),
        F.sum("__run").over(by_category).alias("__total"),
    )
    runs = runs.checkpoint(eager=True)
    size = runs.agg(F.sum(F.octet_length(_CK) + 64)).first()[0] or 0
    if size <= broadcast_bytes:
        runs = F.broadcast(runs)
    else:
        numbered, runs = numbered.repartition(*run_key), runs.repartition(*run_key)
    rank = F.col("__offset") + (F.col(_POS) - F.col("__first"))
    return numbered.join(runs, [_PART, _CK, _CN]).select(
        *[_c(c) for c in products.columns],
        ntile_from_rank(rank, F.col("__total")).alias("price_tier"),
    )


def classify_price_level(
    products: DataFrame, clean: bool = True, method: str = "range", broadcast_bytes: int = BROADCAST_BYTES
) -> DataFrame:
    """``price_tier`` (1-4) and ``price_position`` within each category.

    ``method="range"`` (default) is the distributed rank and writes its
    checkpoints when called (module docstring).  ``method="window"`` is the
    plain ``ntile`` window: a whole category in one task, so only for small
    inputs; the tests use it as the model the range method must equal.
    """
    df = clean_products(products) if clean else products
    if method == "window":
        tiered = _tiers_window(df)
    elif method == "range":
        tiered = _tiers_range(df, broadcast_bytes=broadcast_bytes)
    else:
        raise ValueError(f"unknown method {method!r}; expected 'window' or 'range'")
    return _with_position(tiered)


def sales_velocity(
    products: DataFrame,
    orders: DataFrame,
    clean: bool = True,
    fill_columns: list[str] | None = None,
    fast: int = s.VELOCITY_FAST_QTY,
    medium: int = s.VELOCITY_MEDIUM_QTY,
) -> DataFrame:
    """``total_quantity_sold`` per product and an ``inventory_velocity`` tier.

    Unsold products get 0.  As in the reference, the zero fill covers every
    numeric column (a NULL ``Price per product`` becomes 0 too) unless
    ``fill_columns`` narrows it.
    """
    if clean:
        products, orders = clean_products(products), clean_orders(orders)
    sold = orders.groupBy(s.PRODUCT_ID).agg(F.sum(_c(s.QUANTITY)).alias("total_quantity_sold"))
    joined = products.join(sold, s.PRODUCT_ID, "left")
    filled = joined.fillna(0) if fill_columns is None else joined.fillna(0, subset=fill_columns)
    return filled.withColumn("inventory_velocity", velocity_label(F.col("total_quantity_sold"), fast, medium))


def enrich_products(products: DataFrame, orders: DataFrame, method: str = "range") -> DataFrame:
    """Price tiers (computed before the zero fill), then sales velocity."""
    tiered = classify_price_level(products, method=method)
    # The tiered frame is already cleaned; only the orders still need it.
    return sales_velocity(tiered, clean_orders(orders), clean=False)
