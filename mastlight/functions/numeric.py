"""Rounding and averaging that agree with SQL ``numeric`` results."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def exact_round(value: Column, digits: int) -> Column:
    """Half-away-from-zero rounding in decimal arithmetic, as a decimal with ``digits`` places."""
    return F.round(value.cast("decimal(38,10)"), digits)


def rounded(value: Column, digits: int) -> Column:
    """``exact_round`` returned as a double."""
    return exact_round(value, digits).cast("double")


def half_up_tenth(value: Column) -> Column:
    """Round to one decimal with halves going up."""
    return F.floor(value * 10 + F.lit(0.5)) / 10


def exact_round_sql(value: str, digits: int) -> str:
    """``exact_round`` as SQL text over a SQL expression."""
    return f"round(cast({value} AS decimal(38,10)), {digits})"


def rounded_sql(value: str, digits: int) -> str:
    """``rounded`` as SQL text over a SQL expression."""
    return f"cast({exact_round_sql(value, digits)} AS double)"


def exact_sum_sql(value: str) -> str:
    """Sum of doubles in decimals: the same however the rows are split, also where rounding is a tie."""
    return f"sum(cast({value} AS decimal(28,10)))"
