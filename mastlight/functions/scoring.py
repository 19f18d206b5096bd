"""Score ramps, bands and provider sub-scores as column expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from mastlight.fixed_values import FRESHNESS_TIERS, STALE_FRESHNESS


def ramp_sql(value: str, start: float, end: float, points: float) -> str:
    """SQL of a score: 0 at ``start`` rising to ``points`` at ``end`` (which may lie below ``start``).

    A missing value scores like the number 0; that is part of the published scores.
    """
    v = f"coalesce(cast({value} AS double), 0D)"
    above = f"{v} - {float(start)}D" if end >= start else f"{float(start)}D - {v}"
    share = f"least(1D, greatest(0D, ({above}) / {float(abs(end - start))!r}D))"
    return f"{share} * {float(points)}D"


def tier(value: Column, tiers: Sequence[tuple[float, str]], otherwise: str) -> Column:
    """Name of the first tier whose threshold the value reaches."""
    out = None
    for threshold, name in tiers:
        hit = value >= F.lit(threshold)
        out = F.when(hit, name) if out is None else out.when(hit, name)
    return out.otherwise(otherwise)


def _percent(value: Column, floor: float = 0.0) -> Column:
    return F.greatest(F.lit(floor), F.least(F.lit(100.0), value))


def signal_score(dbm: Column) -> Column:
    return _percent((F.coalesce(dbm, F.lit(0.0)) + 110) / 60 * 100)


def latency_score(ms: Column) -> Column:
    return _percent(F.lit(100.0) - F.coalesce(ms, F.lit(0.0)) / 200 * 100)


def download_score(mbps: Column) -> Column:
    return _percent(F.coalesce(mbps, F.lit(0.0)) / 50 * 100)


def sample_score(count: Column) -> Column:
    return _percent(count / 80 * 100, floor=20.0)


def freshness_score(age_seconds: Column) -> Column:
    """Score by the age of the oldest sample used."""
    out = None
    for limit, score in FRESHNESS_TIERS:
        hit = age_seconds <= F.lit(limit)
        out = F.when(hit, float(score)) if out is None else out.when(hit, float(score))
    return out.otherwise(float(STALE_FRESHNESS))
