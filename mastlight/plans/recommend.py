"""Provider recommendations near destinations."""

from __future__ import annotations

import datetime as dt
import math
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mastlight.fixed_values import COVERAGE_WEIGHTS, LIVE_WEIGHTS, RECOMMENDATION_CONFIDENCE
from mastlight.functions import scoring
from mastlight.functions.geo import near_box
from mastlight.functions.numeric import half_up_tenth
from mastlight.operators.geo_radius import within_radius
from mastlight.operators.listing import leading_int
from mastlight.operators.measures import average, merges, partial_names, partials, results, rows
from mastlight.operators.timeslice import as_time, at_or_after, hours_before
from mastlight.session import written

LIVE_MEASURES = (
    rows("sample_count"),
    average("avg_signal", "signal_dbm", 1),
    average("avg_latency", "latency_ms", 0),
    average("avg_dl", "dl_mbps", 1),
    average("avg_ul", "ul_mbps", 1),
)
COVERAGE_MEASURES = (
    rows("sample_count"),
    average("avg_signal", "signal_strength_dbm", 1),
    average("avg_latency", "latency_ms", 0),
    average("avg_dl", "download_speed_mbps", 1),
    average("avg_ul", "upload_speed_mbps", 1),
)
COVERAGE_NOTE = "Based on synthetic coverage: no recent live reading lies nearby."
NOTHING_NOTE = "Neither a recent reading nor a coverage sample lies nearby."
PROVIDER_COLUMNS = (
    "dest_id", "place", "operator", "score", "sample_count", "avg_signal", "avg_latency",
    "avg_dl", "avg_ul", "nearest_km", "source", "confidence",
)


def clamp_radius(radius_km: object) -> float:
    """Radius in km: missing means 5, then 1..50."""
    value = float(radius_km or 5)
    if math.isnan(value):
        raise ValueError("radius_km is not a number")
    return min(max(value, 1.0), 50.0)


def clamp_hours(hours: object) -> int:
    """Look-back: unreadable or zero means 24, then 1..168."""
    return min(max(leading_int(hours) or 24, 1), 168)


def _nearest() -> Column:
    return F.round(F.min("distance_km").cast("decimal(38,10)"), 2).cast("double").alias("nearest_km")


def live_evidence(
    destinations: DataFrame, readings: DataFrame, towers: DataFrame, as_of: Column, hours: int
) -> DataFrame:
    """Recent readings near each destination per operator.

    The distance depends on the tower only, so readings shrink to one row per tower and operator, and those of
    towers at one place to one row, before they meet the destinations.  Towers without a recent reading meet none.
    """
    recent = at_or_after(readings, "recorded_at", hours_before(as_of, hours), strict=True)
    per_tower = (
        recent.filter("tower_id IS NOT NULL")
        .groupBy("tower_id", "operator")
        .agg(*partials(LIVE_MEASURES), F.min("recorded_at").alias("oldest"))
    )
    located = per_tower.join(towers.select("id", "lat", "lon"), F.col("tower_id") == F.col("id"))
    per_site = located.groupBy("lat", "lon", "operator").agg(*merges(LIVE_MEASURES), F.min("oldest").alias("oldest"))
    near = within_radius(destinations, per_site, ["operator", *partial_names(LIVE_MEASURES), "oldest"])
    age = (
        F.unix_micros(as_of.cast("timestamp")) - F.unix_micros(F.min("oldest").cast("timestamp"))
    ) / 1e6
    merged = near.groupBy("dest_id", "operator").agg(
        *merges(LIVE_MEASURES), _nearest(), F.round(age.cast("decimal(38,10)"), 0).cast("double").alias("max_age_sec")
    )
    return merged.select("dest_id", "operator", *results(LIVE_MEASURES), "nearest_km", "max_age_sec")


def coverage_evidence(destinations: DataFrame, coverage: DataFrame) -> DataFrame:
    """Coverage samples near each destination per operator, first summed up per site."""
    per_site = coverage.groupBy("lat", "lon", "operator").agg(*partials(COVERAGE_MEASURES))
    near = within_radius(destinations, per_site, ["operator", *partial_names(COVERAGE_MEASURES)])
    merged = near.groupBy("dest_id", "operator").agg(*merges(COVERAGE_MEASURES), _nearest())
    return merged.select("dest_id", "operator", *results(COVERAGE_MEASURES), "nearest_km")


def weighted_score(weights: Mapping[str, float]) -> Column:
    """Weighted total of the sub-scores over the evidence columns, to one decimal."""
    parts = {
        "signal": scoring.signal_score(F.col("avg_signal")),
        "latency": scoring.latency_score(F.col("avg_latency")),
        "download": scoring.download_score(F.col("avg_dl")),
        "samples": scoring.sample_score(F.col("sample_count")),
    }
    if "freshness" in weights:
        parts["freshness"] = scoring.freshness_score(F.col("max_age_sec"))
    total = None
    for name, weight in weights.items():
        term = parts[name] * F.lit(weight)
        total = term if total is None else total + term
    return half_up_tenth(total)


def rank_providers(evidence: DataFrame, weights: Mapping[str, float], source: str) -> DataFrame:
    """Scored providers per destination, best first; a missing average shows as 0."""
    averages = {c: F.coalesce(c, F.lit(0.0)) for c in ("avg_signal", "avg_latency", "avg_dl", "avg_ul")}
    scored = evidence.withColumn("score", weighted_score(weights)).withColumns(
        {**averages, "operator": F.coalesce(F.nullif("operator", F.lit("")), F.lit("Unknown"))}
    )
    per_destination = Window.partitionBy("dest_id")
    best_first = per_destination.orderBy(F.desc("score"), F.desc("sample_count"), "operator")
    samples = F.sum("sample_count").over(per_destination)
    live = source == "live_readings"
    confidence = scoring.tier(samples, RECOMMENDATION_CONFIDENCE, "low") if live else F.lit("medium")
    return scored.withColumns(
        {"place": F.row_number().over(best_first), "source": F.lit(source), "confidence": confidence}
    ).select(*PROVIDER_COLUMNS)


def recommend_for(
    destinations: DataFrame,
    tables: Mapping[str, DataFrame],
    as_of: dt.datetime | str,
    hours: int | str = 24,
) -> DataFrame:
    """Ranked providers for many destinations (dest_id, lat, lon, radius_km).

    Destinations without a live reading nearby fall back to coverage samples; those with neither
    have no row here (see ``summarise_destinations``).
    """
    hours = clamp_hours(hours)
    live = rank_providers(
        live_evidence(destinations, tables["readings"], tables["towers"], as_time(as_of), hours),
        LIVE_WEIGHTS,
        "live_readings",
    )
    # Read twice below, so it is written once: readings are scanned a single time.
    live = written(live, "live-providers")
    unserved = destinations.join(live.select("dest_id").distinct(), "dest_id", "left_anti")
    fallback = rank_providers(
        coverage_evidence(unserved, tables["coverage_data"]), COVERAGE_WEIGHTS, "synthetic_coverage"
    )
    return live.unionByName(fallback)


def summarise_destinations(destinations: DataFrame, providers: DataFrame) -> DataFrame:
    """One row per destination: confidence, best provider and a note where evidence is weak."""
    best = providers.filter("place = 1").select(
        "dest_id",
        "confidence",
        F.col("operator").alias("best_provider"),
        F.col("score").alias("best_score"),
        "source",
    )
    note = F.when(F.col("source") == "synthetic_coverage", COVERAGE_NOTE).when(
        F.col("source").isNull(), NOTHING_NOTE
    )
    return destinations.join(best, "dest_id", "left").select(
        *destinations.columns,
        F.coalesce("confidence", F.lit("low")).alias("confidence"),
        "best_provider",
        "best_score",
        "source",
        note.alias("note"),
    )


def recommend(
    tables: Mapping[str, DataFrame],
    lat: float,
    lon: float,
    as_of: dt.datetime | str,
    radius_km: float | str | None = 5,
    hours: int | str = 24,
) -> DataFrame:
    """Ranked providers near one destination."""
    lat, lon = float(lat), float(lon)
    if not (math.isfinite(lat) and math.isfinite(lon)):
        raise ValueError("lat and lon are required numbers")
    radius = clamp_radius(radius_km)
    spark = tables["readings"].sparkSession
    one = spark.range(1).select(
        F.lit(0).alias("dest_id"), F.lit(lat).alias("lat"), F.lit(lon).alias("lon"), F.lit(radius).alias("radius_km")
    )
    box = near_box(F.col("lat"), F.col("lon"), lat, lon, radius)
    near = {
        **tables,
        "towers": tables["towers"].filter(box),
        "coverage_data": tables["coverage_data"].filter(box),
    }
    return recommend_for(one, near, as_of, hours).drop("dest_id").orderBy("place")
