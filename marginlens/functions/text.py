"""Text normalisation."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from marginlens.schemas import NAME_DROP_PATTERN, NAME_SPACE_PATTERN


def clean_name(column: Column) -> Column:
    """Keep ASCII letters and whitespace, collapse whitespace runs, trim.

    Digits, punctuation and accented letters vanish; NULL stays NULL.
    """
    letters = F.regexp_replace(column, NAME_DROP_PATTERN, "")
    return F.trim(F.regexp_replace(letters, NAME_SPACE_PATTERN, " "))
