"""Counts, averages and time series over towers, readings and outages."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mastlight.functions.numeric import rounded
from mastlight.operators.levels import grouped_levels, top_of_level
from mastlight.operators.measures import average, rows
from mastlight.operators.timeslice import as_time, at_or_after, hours_before

TOP_CITIES = 20
SUMMARY_CITIES = 14


def tower_count(towers: DataFrame) -> DataFrame:
    """Health check: how many towers are stored."""
    return towers.agg(F.count("*").alias("towers_in_db"))


def tower_stats(towers: DataFrame, cities: int | None = TOP_CITIES) -> dict[str, DataFrame]:
    """Tower counts by operator, network and city (the largest ``cities``; None: all), and in total."""
    levels = grouped_levels(
        towers, ["operator", "network", "city"], ["operator", "network", "city", None], [rows("count")]
    )

    def level(name: str) -> DataFrame:
        return (
            levels.filter(F.col("level") == name)
            .select(F.col("key").alias(name), "count")
            .orderBy(F.desc("count"), F.asc_nulls_last(name))
        )

    by_city = level("city")
    return {
        "by_operator": level("operator"),
        "by_network": level("network"),
        "by_city": by_city if cities is None else by_city.limit(cities),
        "total": levels.filter("level = 'total'").select("count"),
    }


def tower_stats_rows(towers: DataFrame, cities: int | None = TOP_CITIES) -> DataFrame:
    """``tower_stats`` in one frame: level, key, count."""
    levels = grouped_levels(
        towers, ["operator", "network", "city"], ["operator", "network", "city", None], [rows("count")]
    )
    return top_of_level(levels, "city", cities, [F.desc("count")])


READING_MEASURES = (
    rows("readings"),
    average("avg_signal", "signal_dbm", 1),
    average("avg_latency", "latency_ms", 0),
    average("avg_dl", "dl_mbps", 1),
)


def recent(readings: DataFrame, as_of: dt.datetime | str | Column, hours: int) -> DataFrame:
    """Readings strictly later than ``hours`` before ``as_of``."""
    return at_or_after(readings, "recorded_at", hours_before(as_time(as_of), hours), strict=True)


def readings_summary(readings: DataFrame, as_of: dt.datetime | str, hours: int = 1,
                     cities: int | None = SUMMARY_CITIES) -> DataFrame:
    """Recent averages in total, per operator, per network and for the strongest ``cities`` (None: all)."""
    levels = grouped_levels(
        recent(readings, as_of, hours),
        ["operator", "network", "city"],
        ["operator", "network", "city", None],
        READING_MEASURES,
    )
    return top_of_level(levels, "city", cities, [F.desc_nulls_first("avg_signal")])


def readings_by_operator(readings: DataFrame, as_of: dt.datetime | str, hours: int = 1) -> DataFrame:
    """Recent averages per operator, strongest first."""
    return (
        recent(readings, as_of, hours)
        .groupBy("operator")
        .agg(
            rounded(F.avg("signal_dbm"), 1).alias("avg_signal"),
            rounded(F.avg("dl_mbps"), 1).alias("avg_dl"),
            rounded(F.avg("latency_ms"), 0).alias("avg_latency"),
            F.count("*").alias("readings"),
        )
        .orderBy(F.desc_nulls_first("avg_signal"), "operator")
    )


def readings_history(
    readings: DataFrame,
    as_of: dt.datetime | str,
    hours: int = 1,
    city: str | None = None,
    operator: str | None = None,
) -> DataFrame:
    """Averages per operator, network, city and minute, oldest minute first."""
    kept = recent(readings, as_of, hours)
    if city:
        kept = kept.filter(F.col("city") == city)
    if operator:
        kept = kept.filter(F.col("operator") == operator)
    minute = F.date_trunc("minute", "recorded_at").cast("timestamp_ntz")
    return (
        kept.groupBy("operator", "network", "city", minute.alias("bucket"))
        .agg(
            F.avg("signal_dbm").alias("avg_signal"),
            F.avg("latency_ms").alias("avg_latency"),
            F.avg("dl_mbps").alias("avg_dl"),
            F.avg("ul_mbps").alias("avg_ul"),
            F.count("*").alias("count"),
        )
        .orderBy("bucket")
    )


def outage_stats(outages: DataFrame) -> DataFrame:
    """Outages per operator with average severity and duration and the newest start."""
    return (
        outages.groupBy("operator")
        .agg(
            F.count("*").alias("total_outages"),
            rounded(F.avg("severity"), 1).alias("avg_severity"),
            rounded(F.avg("duration_min"), 1).alias("avg_duration_min"),
            F.max("started_at").alias("most_recent_outage"),
        )
        .orderBy(F.desc("total_outages"), "operator")
    )


def outages_last_30_days(outages: DataFrame, as_of: dt.datetime | str) -> DataFrame:
    """How many outages started in the 30 days before ``as_of``."""
    start = as_time(as_of) - F.make_dt_interval(days=F.lit(30))
    return at_or_after(outages, "started_at", start, strict=True).agg(
        F.count("*").alias("total_outages_30d")
    )


# Breakdown printed after each load: grouping columns and an optional averaged column.
BREAKDOWNS: dict[str, tuple[tuple[str, ...], tuple[str, str] | None]] = {
    "towers": (("operator", "network"), None),
    "qos_metrics": (("operator", "network"), None),
    "coverage_data": (("operator", "network"), None),
    "network_events": (("operator", "event_type"), None),
    "hardware_sensors": (("equipment_type", "health_status"), None),
    "uptime_logs": (("outage_reason",), None),
    "energy_consumption": (("power_source",), ("daily_consumption_kwh", "avg_kwh")),
    "maintenance_orders": (("maintenance_type", "status"), None),
    "latency_logs": (("operator", "network"), ("latency_ms", "avg_latency_ms")),
    "handover_records": (("operator", "network", "success"), None),
}


def load_breakdown(table: str, df: DataFrame) -> DataFrame:
    """Row counts per group of a loaded table, largest or alphabetical first."""
    keys, averaged = BREAKDOWNS[table]
    aggregates = [F.count("*").alias("rows")]
    if averaged:
        aggregates.append(rounded(F.avg(averaged[0]), 2).alias(averaged[1]))
    out = df.groupBy(*keys).agg(*aggregates)
    if len(keys) == 1:
        return out.orderBy(F.desc("rows"), F.asc_nulls_last(keys[0]))
    return out.orderBy(*[F.asc_nulls_last(k) for k in keys])
