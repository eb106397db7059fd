"""Incremental ingestion of order and product files (Structured Streaming).

The reference is a batch job and has no streaming operators.  What carries
over to a stream is the part that comes before the keep-first dedupe: the file
sources with their declared schemas and the rules C1 (negative profit) and C2
(NULL order id).  Those run here as a streaming query that appends new files
to a parquet table with exactly-once file-sink semantics; the batch operators
then read that table.

The dedupe is not streamed: which line of an order is "first" depends on lines
that may not have arrived yet.  The rules after it (dates, customer and product
ids) look at the kept line only, so they cannot run before it either: a bad
first line must still remove its order.  ``clean_orders`` over the ingested
table gives the same rows as over the files.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from marginlens import schemas as s
from marginlens.operators import cleaning as C


def read_orders_stream(
    spark: SparkSession,
    path: str,
    multi_line: bool = False,
    schema: StructType = s.ORDERS_SCHEMA,
    max_files_per_trigger: int | None = None,
) -> DataFrame:
    """Orders arriving as JSON files under ``path`` (JSON Lines by default)."""
    reader = spark.readStream.schema(schema).option("multiLine", multi_line)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.json(path)


def read_products_stream(spark: SparkSession, path: str, schema: StructType = s.PRODUCTS_SCHEMA) -> DataFrame:
    """Products arriving as CSV files with a header checked against the schema."""
    return spark.readStream.schema(schema).option("header", True).option("enforceSchema", False).csv(path)


def row_rules(orders: DataFrame) -> DataFrame:
    """The rules that come before the dedupe: C1, then C2."""
    return C.drop_null(C.drop_negative_profit(orders), s.ORDER_ID)


def ingest(stream: DataFrame, table_path: str, checkpoint_location: str, available_now: bool = True) -> StreamingQuery:
    """Append a stream to a parquet table; the checkpoint makes restarts exactly-once.

    ``available_now`` processes everything present and stops (scheduled
    incremental runs); otherwise the query keeps running with default
    micro-batch triggers.
    """
    writer = (
        stream.writeStream.format("parquet")
        .option("path", table_path)
        .option("checkpointLocation", checkpoint_location)
        .outputMode("append")
    )
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()
