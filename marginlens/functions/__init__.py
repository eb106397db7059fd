"""Column-level building blocks: pure ``Column`` expressions, no jobs."""

from marginlens.functions.dates import order_date, parse_date
from marginlens.functions.labels import churn_label, price_position_label, velocity_label
from marginlens.functions.money import exact_sum, round_money
from marginlens.functions.text import clean_name

__all__ = [
    "churn_label",
    "clean_name",
    "exact_sum",
    "order_date",
    "parse_date",
    "price_position_label",
    "round_money",
    "velocity_label",
]
