"""marginlens: retail profitability analytics as lazy Spark DataFrame operators.

Load customers, orders and products, clean them under fixed data-quality
rules, enrich customers and products, denormalise orders and aggregate
profit - every step a ``DataFrame -> DataFrame`` function that launches no
job until the caller runs an action.
"""

__version__ = "0.1.0"
