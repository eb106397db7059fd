"""Date handling that accepts string, date and timestamp columns.

Source files hold dates as ``d/M/yyyy`` text; tests and upstream jobs may
hand over real ``DateType`` or timestamps.  Text is parsed with
``try_to_date`` so a malformed value becomes NULL instead of failing the job
under ANSI mode.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, StringType, TimestampNTZType, TimestampType

from marginlens.schemas import DATE_PATTERN, ORDER_DATE


def parse_date(df: DataFrame, name: str, pattern: str = DATE_PATTERN) -> Column:
    """``name`` of ``df`` as a DateType column (NULL where text does not parse)."""
    dtype = df.schema[name].dataType
    column = F.col(f"`{name}`")
    if isinstance(dtype, DateType):
        return column
    if isinstance(dtype, (TimestampType, TimestampNTZType)):
        return F.to_date(column)
    if isinstance(dtype, StringType):
        return F.try_to_date(column, pattern)
    raise TypeError(f"column {name!r} has type {dtype.simpleString()}, expected string/date/timestamp")


def order_date(df: DataFrame) -> Column:
    return parse_date(df, ORDER_DATE)
