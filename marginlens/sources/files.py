"""File sources for the three tables.

All readers apply the declared schema (no inference pass over the data) and
stay lazy: the files are listed when the DataFrame is built, read when an
action runs.

* Orders are JSON.  ``multi_line=True`` reads a JSON *array* per file (the
  reference's format); such a file cannot be split, so each file is one
  task, and ids that are numbers are slow but for :func:`numbers_in_stream`.
  JSON Lines (``multi_line=False``) splits like text and is the
  format to use at scale.  Fields bind by name: a missing field is NULL, an
  extra one is ignored, a malformed value is NULL for that field only.
* Products are CSV with a header.  ``enforceSchema`` is off, so every file's
  header is checked against the schema names when the file is scanned and a
  reordered or renamed header fails the job instead of silently binding
  columns by position.
* A path that does not exist, a CSV whose (first) header is not the schema's
  and, with ``strict_fields``, JSON that lacks a field of the schema raise
  :class:`SourceError` at build time rather than yielding ``None``.  The CSV
  check reads the head of the files, the JSON check all records once.  Files
  that turn out unreadable later fail the action that reads them, with
  Spark's own error.
"""

from __future__ import annotations

from contextlib import contextmanager
from typing import NamedTuple

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from marginlens.schemas import CUSTOMERS_SCHEMA, ORDERS_SCHEMA, PRODUCTS_SCHEMA


CORRUPT = "__corrupt_record"


class SourceError(Exception):
    """A source could not be loaded: missing path, bad header or missing fields
    at build time, an unreadable file within :func:`source_errors`."""


@contextmanager
def source_errors(kind: str, path: str | list[str]):
    """Failures of the actions inside, as :class:`SourceError` (Spark's own error is its cause)."""
    try:
        yield
    except (PySparkException, Py4JJavaError) as exc:
        raise SourceError(f"{kind}: cannot read {path}: {str(exc).splitlines()[0]}") from exc


@contextmanager
def numbers_in_stream(spark: SparkSession):
    """Actions inside read numbers of text fields (ids) of JSON arrays in the stream, not each by a read of its own.

    Spark takes the text of such a number from the file by a positioned read,
    which opens a local file once more for each id.  Inside, whole numbers are
    the same text; fractions are written anew (``1.50`` is ``1.5``), as they are
    from compressed files anyway.
    """
    setting = "spark.sql.json.enableExactStringParsing"
    before = spark.conf.get(setting)
    spark.conf.set(setting, False)
    try:
        yield
    finally:
        spark.conf.set(setting, before)


class Quarantined(NamedTuple):
    """The ``accepted`` records, and the ``rejected`` ones as ``record`` (their text) and ``file``."""

    accepted: DataFrame
    rejected: DataFrame


def _split(reader: DataFrameReader, load, schema: StructType) -> Quarantined:
    """One read with Spark's column for records that don't fit; each side is a filter on it."""
    both = StructType([*schema.fields, StructField(CORRUPT, StringType())])
    rows = load(reader.schema(both).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT))
    rows = rows.select("*", F.col("_metadata.file_path").alias("__file"))
    # Spark parses only the columns that a query reads, and forbids reading the
    # text column alone, so both sides' condition reads all of them.
    read = F.length(F.concat_ws("", *[F.col(f"`{n}`").cast("string") for n in schema.fieldNames()])) >= 0
    accepted = rows.where(F.col(CORRUPT).isNull() & read).select(*[F.col(f"`{n}`") for n in schema.fieldNames()])
    rejected = rows.where(F.col(CORRUPT).isNotNull() & read).select(F.col(CORRUPT).alias("record"), F.col("__file").alias("file"))
    return Quarantined(accepted, rejected)


def _load(kind: str, path: str | list[str], build) -> DataFrame:
    try:
        return build()
    except AnalysisException as exc:
        condition = getattr(exc, "getCondition", lambda: None)() or ""
        if "PATH_NOT_FOUND" in condition or "Path does not exist" in str(exc):
            raise SourceError(f"{kind}: path not found: {path}") from exc
        raise SourceError(f"{kind}: cannot load {path}: {exc}") from exc


def read_orders(
    spark: SparkSession,
    path: str | list[str],
    multi_line: bool = True,
    schema: StructType = ORDERS_SCHEMA,
    strict_fields: bool = False,
    quarantined: bool = False,
) -> DataFrame | Quarantined:
    """Orders from JSON (array per file, or JSON Lines with ``multi_line=False``).

    ``strict_fields`` infers the fields of all records first and refuses input
    without some of the schema's, which would all be NULL.  ``quarantined``
    gives :class:`Quarantined` instead of a DataFrame; a whole array file that
    is cut off is one rejected record.
    """
    if strict_fields:
        found = _load("orders", path, lambda: spark.read.option("multiLine", multi_line).json(path))
        missing = [n for n in schema.fieldNames() if n not in found.columns]
        if missing:
            raise SourceError(f"orders: {path} has no field {missing}")
    reader = spark.read.option("multiLine", multi_line)
    if quarantined:
        return _load("orders", path, lambda: _split(reader, lambda r: r.json(path), schema))
    return _load("orders", path, lambda: reader.schema(schema).json(path))


def _csv(spark: SparkSession, kind: str, path, schema: StructType, quarantined: bool = False) -> DataFrame | Quarantined:
    head = _load(kind, path, lambda: spark.read.option("header", True).csv(path)).columns
    if head != schema.fieldNames():
        raise SourceError(f"{kind}: the header of {path} is {head}, not {schema.fieldNames()}")
    if quarantined:  # the extra column keeps Spark from checking headers, so each file's is left to the head check
        reader = spark.read.option("header", True)
        return _load(kind, path, lambda: _split(reader, lambda r: r.csv(path), schema))
    return _load(
        kind,
        path,
        lambda: spark.read.schema(schema)
        .option("header", True)
        .option("enforceSchema", False)
        .option("mode", "PERMISSIVE")
        .csv(path),
    )


def read_products(
    spark: SparkSession, path: str | list[str], schema: StructType = PRODUCTS_SCHEMA, quarantined: bool = False
) -> DataFrame | Quarantined:
    """S3: products from CSV with a header that must match the schema names."""
    return _csv(spark, "products", path, schema, quarantined)


def read_customers_csv(
    spark: SparkSession, path: str | list[str], schema: StructType = CUSTOMERS_SCHEMA
) -> DataFrame:
    """Customers exported as CSV (same header rule as products)."""
    return _csv(spark, "customers", path, schema)
