"""Lineage cuts in the folder that the session names in ``spark.checkpoint.dir``."""

from __future__ import annotations

from pyspark.sql import DataFrame

from marginlens.plans.session import ensure_checkpoint_dir


def cut(df: DataFrame) -> DataFrame:
    """``df`` written once as a reliable checkpoint; later reads survive lost executors."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint()
