"""Aggregates that can be computed in two steps, so raw rows shrink before any join."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from mastlight.functions.numeric import exact_sum_sql, rounded_sql


@dataclass(frozen=True)
class Measure:
    """``kind`` is rows (count), matches (count where), mean or total of ``value``.

    ``value`` is a SQL expression over the raw rows.  ``digits`` rounds means and totals.
    """

    name: str
    kind: str
    value: str | None = None
    digits: int | None = None

    def partial(self) -> list[Column]:
        """Aggregates over raw rows."""
        if self.kind == "rows":
            return [F.expr(f"count(*) AS {self.name}_n")]
        if self.kind == "matches":
            return [F.expr(f"count_if({self.value}) AS {self.name}_n")]
        exact = self.kind == "total" and self.digits is not None
        summed = F.expr(f"{exact_sum_sql(self.value) if exact else f'sum({self.value})'} AS {self.name}_s")
        return [summed] if self.kind == "total" else [summed, F.expr(f"count({self.value}) AS {self.name}_n")]

    def partial_names(self) -> list[str]:
        if self.kind in ("rows", "matches"):
            return [f"{self.name}_n"]
        return [f"{self.name}_s"] if self.kind == "total" else [f"{self.name}_s", f"{self.name}_n"]

    def result_sql(self) -> str:
        """Final value from merged partial columns; counts of nothing are 0, other values NULL."""
        if self.kind in ("rows", "matches"):
            return f"coalesce({self.name}_n, 0) AS {self.name}"
        value = f"{self.name}_s"
        if self.kind == "mean":
            value = f"CASE WHEN {self.name}_n > 0 THEN {self.name}_s / {self.name}_n END"
        return f"{value if self.digits is None else rounded_sql(value, self.digits)} AS {self.name}"


def rows(name: str) -> Measure:
    return Measure(name, "rows")


def matches(name: str, condition: str) -> Measure:
    return Measure(name, "matches", condition)


def average(name: str, value: str, digits: int | None = None) -> Measure:
    return Measure(name, "mean", value, digits)


def total(name: str, value: str, digits: int | None = None) -> Measure:
    return Measure(name, "total", value, digits)


def partials(measures: Sequence[Measure]) -> list[Column]:
    return [c for m in measures for c in m.partial()]


def partial_names(measures: Sequence[Measure]) -> list[str]:
    return [n for m in measures for n in m.partial_names()]


def merges(measures: Sequence[Measure]) -> list[Column]:
    """Aggregates over partial rows, keeping the partial form."""
    return [F.expr(f"sum({n}) AS {n}") for n in partial_names(measures)]


def results(measures: Sequence[Measure]) -> list[Column]:
    return [F.expr(m.result_sql()) for m in measures]
