"""Table profile (Q1).

The reference returns a dict (created?, columns, count, schema, two sample
rows, status).  :func:`profile` gives the same facts as a DataFrame, one row
per column, from a single count; the schema facts need no job at all.
:func:`profile_dict` is the thin dict view for interactive use: one count
and a two-row ``take``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType, IntegerType

PROFILE_SCHEMA = StructType(
    [
        StructField("table_name", StringType(), False),
        StructField("column_name", StringType(), True),
        StructField("ordinal", IntegerType(), True),
        StructField("data_type", StringType(), True),
        StructField("record_count", LongType(), False),
        StructField("status", StringType(), False),
    ]
)


def _columns(df: DataFrame) -> Column:
    return F.array(*[
        F.struct(
            F.lit(f.name).alias("column_name"),
            F.lit(i).alias("ordinal"),
            F.lit(f.dataType.simpleString()).alias("data_type"),
        )
        for i, f in enumerate(df.schema.fields, start=1)
    ])


def profile(
    df: DataFrame | None, table_name: str, spark: SparkSession | None = None, rows: int | None = None
) -> DataFrame:
    """One row per column: ``table_name, column_name, ordinal, data_type,
    record_count, status``.  An empty table still passes; a missing table
    (``None``) gives one ``Failed`` row with zero records (needs ``spark``).
    ``rows``, if an earlier pass counted them, saves the count."""
    if df is None:
        if spark is None:
            raise ValueError("profile(None, ...) needs the spark session to build its report")
        return spark.createDataFrame([(table_name, None, None, None, 0, "Failed")], PROFILE_SCHEMA)
    if rows is None:
        counted = df.agg(F.count(F.lit(1)).alias("record_count"))
    else:
        counted = df.sparkSession.range(1).select(F.lit(rows).cast("bigint").alias("record_count"))
    return counted.select(
        F.lit(table_name).alias("table_name"),
        F.inline(_columns(df)),
        "record_count",
        F.lit("Passed").alias("status"),
    )


def profile_summary(df: DataFrame | None, table_name: str, spark: SparkSession | None = None, error: str | None = None) -> DataFrame:
    """The report's head, one row: ``table_name, dataframe_created,
    total_columns, number_of_records, status, error``.

    A missing table (``None``; ``error`` says why, if known) is ``Failed``
    with zero columns and records."""
    if df is None:
        if spark is None:
            raise ValueError("profile_summary(None, ...) needs the spark session to build its report")
        counted, columns, status = spark.range(1).select(F.lit(0).cast("bigint").alias("number_of_records")), 0, "Failed"
    else:
        counted, columns, status = df.agg(F.count(F.lit(1)).alias("number_of_records")), len(df.columns), "Passed"
    return counted.select(
        F.lit(table_name).alias("table_name"), F.lit(df is not None).alias("dataframe_created"),
        F.lit(columns).alias("total_columns"), "number_of_records", F.lit(status).alias("status"),
        F.lit(error).cast("string").alias("error"))


def _unfold(df: DataFrame, name: str, table_name: str) -> DataFrame:
    """``sample`` rows (a struct each) as one row per column."""
    cells = [F.struct(F.lit(f.name).alias("column_name"), F.lit(i).alias("ordinal"), F.col(f"{name}.`{f.name}`").cast("string").alias("value"))
             for i, f in enumerate(df.schema[name].dataType.fields, start=1)]
    return df.select(F.lit(table_name).alias("table_name"), "sample", F.inline(F.array(*cells)))


def profile_samples(df: DataFrame, table_name: str, sample: tuple | None = None) -> DataFrame:
    """Two sample records as ``table_name, sample, column_name, ordinal, value``.

    They are the smallest (1) and the largest (2) row by all columns, NULLs
    first: one aggregation, and the same rows on any partitioning.  A table of
    one row has sample 1 only, an empty one none.  ``sample``, if an earlier
    pass kept both, saves the aggregation.
    """
    if sample is not None:
        schema = StructType([StructField("low", df.schema), StructField("high", df.schema)])
        both = df.sparkSession.createDataFrame([sample], schema).withColumn("n", F.lit(2))
    else:
        row = F.struct(*[F.col(f"`{c}`") for c in df.columns])
        both = df.agg(F.min(row).alias("low"), F.max(row).alias("high"), F.count(F.lit(1)).alias("n"))
    numbered = F.array(F.struct(F.lit(1).alias("sample"), F.col("low").alias("row")), F.struct(F.lit(2).alias("sample"), F.col("high").alias("row")))
    rows = both.select("n", F.inline(numbered)).where(F.col("sample") <= F.col("n")).select("sample", "row")
    return _unfold(rows, "row", table_name)


def profile_dict(df: DataFrame | None, table_name: str) -> dict:
    """The reference's report shape, computed with one count and one take(2)."""
    report = {
        "table_name": table_name,
        "dataframe_created": df is not None,
        "columns_available": [],
        "total_columns": 0,
        "number_of_records": 0,
        "schema": None,
        "sample_records": [],
        "status": "Failed",
    }
    if df is None:
        return report
    try:
        report["columns_available"] = df.columns
        report["total_columns"] = len(df.columns)
        report["schema"] = df.schema
        report["number_of_records"] = df.count()
        report["sample_records"] = df.take(2)
        report["status"] = "Passed"
    except Exception as exc:  # the report carries the failure instead of raising
        report["error"] = str(exc)
    return report
