"""Tier labels as ``CASE`` expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from marginlens import schemas as s


def churn_label(days: Column, high: int = s.CHURN_HIGH_DAYS, medium: int = s.CHURN_MEDIUM_DAYS) -> Column:
    """High above ``high`` days, Medium above ``medium``, else Low (NULL days -> Low)."""
    return (
        F.when(days > high, s.CHURN_HIGH)
        .when(days > medium, s.CHURN_MEDIUM)
        .otherwise(s.CHURN_LOW)
    )


def price_position_label(tier: Column) -> Column:
    return (
        F.when(tier == s.PRICE_TIERS, s.PRICE_PREMIUM)
        .when(tier.isin(2, 3), s.PRICE_MID)
        .otherwise(s.PRICE_BUDGET)
    )


def velocity_label(quantity: Column, fast: int = s.VELOCITY_FAST_QTY, medium: int = s.VELOCITY_MEDIUM_QTY) -> Column:
    return (
        F.when(quantity > fast, s.VELOCITY_FAST)
        .when(quantity > medium, s.VELOCITY_MEDIUM)
        .otherwise(s.VELOCITY_SLOW)
    )
