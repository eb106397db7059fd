"""Money sums that do not depend on the order of rows.

A double sum depends on the order rows arrive in, so the same query could
round differently on another partitioning.  Amounts are summed as
``decimal(38,12)`` and the sum handed out as the nearest double; twelve
decimals hold every amount whose shortest text has no more, others are cut
to them.

:func:`exact_sum` makes a group with NaN, infinities or anything from 1e15 up a
plain double sum: NaN and infinities propagate as they do in double arithmetic,
and large totals do not overflow.  :func:`exact_totals` has no such limits: it
sums amounts of any magnitude exactly, by windows of exponents.  NULL amounts
are skipped, as in any sum.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, WindowSpec
from pyspark.sql import functions as F

from marginlens.schemas import MONEY

#: Below it, 1e11 amounts fit the decimal sum; from it on, doubles are coarser than cents anyway.
WIDE = 1e15


def exact_sum(amount: Column, over: WindowSpec | None = None) -> Column:
    """Sum of a double column, as a double (NULL without amounts)."""
    amount = amount.cast("double")
    fits = F.abs(amount) < WIDE
    parts = [F.sum(F.when(fits, amount.cast(MONEY))), F.coalesce(F.bool_or(~fits), F.lit(False)), F.sum(amount)]
    if over is not None:
        parts[0], parts[2] = parts[0].over(over), parts[2].over(over)
        parts[1] = F.coalesce(F.bool_or(~fits).over(over), F.lit(False))
    exact, wide, plain = parts
    return F.when(wide, plain).otherwise(exact.cast("double"))


def exact_sum_sql(amount: str) -> str:
    """``exact_sum`` as SQL text."""
    fits = f"ABS({amount}) < {WIDE:.0f}D"
    exact = f"CAST(SUM(CASE WHEN {fits} THEN CAST({amount} AS {MONEY.simpleString()}) END) AS DOUBLE)"
    return f"CASE WHEN COALESCE(BOOL_OR(NOT ({fits})), FALSE) THEN SUM({amount}) ELSE {exact} END"


def round_money(amount: Column, scale: int = 2) -> Column:
    """HALF_UP round of a double, on its shortest decimal text (what ``round`` does)."""
    return F.round(amount, scale)


# --- sums of amounts of any magnitude ----------------------------------------
#
# A decimal(38,12) holds amounts below WIDE with at most twelve decimals.  Any
# other finite amount is odd: its shortest text, m x 10^e, goes to the window
# floor(e / 8) of its exponent and is summed there as decimal(38,20).  Windows
# are a further grouping key, so partial sums merge exactly in any order, and
# a group of usual amounts has one row.  NaN and infinities are summed apart
# (their sum is the same in any order).  A group's parts are added up as
# doubles from the highest window down, a fixed order.

WINDOW = 8
ODD = "decimal(38,20)"


def amount_parts(x: str) -> str:
    """SQL of a double as ``struct(window, money, odd, special)``; all NULL for NULL.

    ``x`` is a column name.  SQL text, as the JVM parses it in one call.
    """
    money = f"CAST(CASE WHEN ABS({x}) < {WIDE:.0f}D THEN {x} END AS {MONEY.simpleString()})"
    usual = f"COALESCE(CAST({money} AS DOUBLE) = {x}, FALSE)"
    finite = f"COALESCE(ABS({x}) < DOUBLE('Infinity'), FALSE)"
    text = f"CAST({x} AS STRING)"
    exponent = f"COALESCE(TRY_CAST(SUBSTRING(REGEXP_EXTRACT({text}, 'E.*', 0), 2) AS INT), 0)"
    window = f"CAST(FLOOR({exponent} / {WINDOW}) AS INT)"
    shift = f"CASE PMOD({exponent}, {WINDOW}) " + " ".join(f"WHEN {k} THEN CAST({10**k} AS DECIMAL(8,0))" for k in range(WINDOW)) + " END"
    odd = f"CAST(CAST(SUBSTRING_INDEX({text}, 'E', 1) AS DECIMAL(28,20)) * {shift} AS {ODD})"
    return (f"NAMED_STRUCT('window', CASE WHEN {finite} AND NOT {usual} THEN {window} END, 'money', CASE WHEN {usual} THEN {money} END, "
            f"'odd', CASE WHEN {finite} AND NOT {usual} THEN {odd} END, 'special', CASE WHEN {x} IS NOT NULL AND NOT {finite} THEN {x} END)")


def total_of(money: str, special: str, odd: str) -> str:
    """SQL of the double of a group's parts; ``odd`` is an array of ``struct(window, odd)``."""
    windows = f"SORT_ARRAY(ARRAY_DISTINCT(TRANSFORM({odd}, o -> o.window)), FALSE)"
    total = f"AGGREGATE(FILTER({odd}, o -> o.window = w), CAST(0 AS {ODD}), (t, o) -> CAST(t + o.odd AS {ODD}))"
    value = f"CAST(CONCAT(CAST({total} AS STRING), 'E', CAST(w * {WINDOW} AS STRING)) AS DOUBLE)"

    def added(which: str) -> str:
        return f"AGGREGATE(FILTER({windows}, w -> w {which} 0), 0D, (t, w) -> t + {value})"

    return (f"CASE WHEN {special} IS NOT NULL THEN {special} WHEN SIZE({odd}) = 0 THEN CAST({money} AS DOUBLE) "
            f"ELSE {added('>=')} + COALESCE(CAST({money} AS DOUBLE), 0D) + {added('<')} END")


def partial_totals(df: DataFrame, keys: list[str], amounts: dict[str, Column], counts: dict[str, Column]) -> DataFrame:
    """Exact partial sums per ``keys`` and the amounts' windows; :func:`merged_totals` finishes them."""
    named = df.select(*[F.col(f"`{k}`") for k in keys], *[a.cast("double").alias(f"__{n}") for n, a in amounts.items()],
                      *[c.alias(f"__{n}") for n, c in counts.items()])
    parts = named.selectExpr(*[f"`{k}`" for k in keys], *[f"{amount_parts(f'__{n}')} AS __{n}" for n in amounts], *[f"__{n}" for n in counts])
    sums = [F.expr(f"SUM(__{n}.{p}) AS {n}__{p}") for n in amounts for p in ("money", "odd", "special")]
    return parts.groupBy(*[F.col(f"`{k}`") for k in keys], *[F.expr(f"__{n}.window AS {n}__window") for n in amounts]).agg(
        *sums, *[F.expr(f"COUNT(__{n}) AS {n}") for n in counts])


def merged_totals(parts: DataFrame, keys: list[str], amounts: list[str], counts: list[str], grouped: bool = False) -> DataFrame:
    """``keys``, a double per amount and a long per count, from partial totals
    over these keys or more (``grouped``: over exactly these)."""
    key, summed = [F.col(f"`{k}`") for k in keys], [F.expr(f"SUM({n}) AS {n}") for n in counts]
    if not grouped:
        sums = [F.expr(f"SUM({n}__{p}) AS {n}__{p}") for n in amounts for p in ("money", "odd", "special")]
        parts = parts.groupBy(*key, *[f"{n}__window" for n in amounts]).agg(*sums, *summed)
    aggs = []
    for n in amounts:
        odd = f"CASE WHEN {n}__window IS NOT NULL THEN STRUCT({n}__window AS window, {n}__odd AS odd) END"
        aggs += [F.expr(text) for text in (f"SUM({n}__money) AS {n}__money", f"SUM({n}__special) AS {n}__special", f"COLLECT_LIST({odd}) AS {n}__odd")]
    out = parts.groupBy(*key).agg(*aggs, *summed)
    return out.selectExpr(*[f"`{k}`" for k in keys], *[f"{total_of(f'{n}__money', f'{n}__special', f'{n}__odd')} AS {n}" for n in amounts], *counts)


def exact_totals(df: DataFrame, keys: list[str], amounts: dict[str, Column], counts: dict[str, Column]) -> DataFrame:
    """Sums of doubles of any magnitude, the same on any partitioning, and counts, per ``keys``."""
    return merged_totals(partial_totals(df, keys, amounts, counts), keys, list(amounts), list(counts), grouped=True)
