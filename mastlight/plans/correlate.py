"""Signals that preceded each outage."""

from __future__ import annotations

import re
from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mastlight.fixed_values import BAD_HEALTH, HIGH_PRIORITY
from mastlight.operators.listing import clamp_limit
from mastlight.operators.measures import Measure, average, matches, rows, total
from mastlight.operators.preceding import CATEGORIES, daily_stats, few, preceding_of_tables, preceding_stats
from mastlight.schemas import PARTITION_COLUMN
from mastlight.session import pinned, written


def _one_of(column: str, words: tuple[str, ...]) -> str:
    listed = ", ".join(f"'{w}'" for w in words)
    return f"lower(coalesce({column}, '')) IN ({listed})"


@dataclass(frozen=True)
class Block:
    """One fact table's part of the correlation.

    Windows are ``hours`` long and half-open before the start, or ``days`` back to the start's day
    inclusive.  Tables without an operator give every outage the same nation-wide rows.
    """

    table: str
    time: str
    measures: tuple[Measure, ...]
    hours: int | None = None
    days: int | None = None
    by_operator: bool = True
    category: str | None = None
    map_name: str | None = None

    @property
    def keys(self) -> list[str]:
        return ["operator"] if self.by_operator else []

    @property
    def window(self) -> list[str]:
        return [*self.keys, "day" if self.days is not None else "upper"]

    @property
    def cell(self) -> str:
        return "minute" if self.hours <= 6 else "hour"


BLOCKS: dict[str, Block] = {
    "readings": Block("readings", "recorded_at", (
        rows("sample_count"),
        average("pre_avg_signal", "signal_dbm", 1),
        average("pre_avg_latency", "latency_ms", 1),
        average("pre_avg_dl", "dl_mbps", 1),
    ), hours=2),
    "events": Block("network_events", "event_time", (
        rows("pre_event_count"),
        average("pre_avg_packet_loss", "packet_loss_percent", 2),
    ), hours=2, category="event_type", map_name="pre_event_types"),
    "hardware": Block("hardware_sensors", "sensor_time", (
        rows("pre_hardware_sample_count"),
        matches("pre_hardware_alert_count", "alert_triggered"),
        matches("pre_hardware_bad_health_count", _one_of("health_status", BAD_HEALTH)),
        average("pre_avg_temperature_celsius", "temperature_celsius", 1),
        average("pre_avg_power_draw_watts", "power_draw_watts", 1),
    ), hours=2, by_operator=False),
    "uptime": Block("uptime_logs", "log_date", (
        rows("uptime_log_count"),
        average("avg_uptime_percentage", "uptime_percentage", 2),
        total("total_downtime_minutes", "downtime_minutes", 1),
        total("total_synthetic_outages", "outage_count"),
    ), days=1, category="outage_reason", map_name="outage_reason_counts"),
    "energy": Block("energy_consumption", "usage_date", (
        rows("energy_record_count"),
        average("avg_daily_consumption_kwh", "daily_consumption_kwh", 2),
        average("avg_grid_availability_hours", "grid_availability_hours", 1),
        average("avg_generator_runtime_hours", "generator_runtime_hours", 1),
        total("total_fuel_consumed_liters", "fuel_consumed_liters", 1),
        total("total_carbon_emissions_kg", "carbon_emissions_kg", 1),
    ), days=1, by_operator=False),
    "maintenance": Block("maintenance_orders", "scheduled_date", (
        rows("maintenance_order_count"),
        matches("high_priority_maintenance_count", _one_of("priority", HIGH_PRIORITY)),
        average("avg_repair_duration_hours", "repair_duration_hours", 1),
        total("maintenance_downtime_minutes", "downtime_minutes", 1),
    ), days=7, category="issue_category", map_name="maintenance_issue_counts"),
    "latency": Block("latency_logs", "measured_at", (
        rows("latency_log_count"),
        average("avg_ultra_latency_ms", "latency_ms", 2),
        average("avg_ultra_jitter_ms", "jitter_ms", 2),
        average("avg_ultra_packet_loss_percent", "packet_loss_percent", 2),
        matches("latency_sla_miss_count", "NOT sla_met"),
    ), hours=2),
    "handover": Block("handover_records", "handover_time", (
        rows("handover_count"),
        matches("handover_failure_count", "NOT success"),
        average("avg_handover_duration_ms", "duration_ms", 1),
        average("avg_handover_source_signal_dbm", "source_signal_dbm", 1),
        average("avg_handover_target_signal_dbm", "target_signal_dbm", 1),
    ), hours=2),
    "dropped": Block("dropped_calls", "dropped_at", (
        rows("dropped_call_count"),
        average("avg_dropped_call_signal_dbm", "signal_strength_dbm", 1),
    ), hours=2, category="drop_reason", map_name="dropped_call_reason_counts"),
    "technician": Block("technician_logs", "started_at", (
        rows("technician_activity_count"),
        matches("unresolved_technician_activity_count", "NOT issue_resolved"),
        average("avg_technician_duration_min", "duration_min", 1),
        total("total_technician_travel_km", "travel_km", 1),
    ), hours=168),
}

#: Totals that are reported as 0, not NULL, when nothing preceded the outage.
ZERO_TOTALS = ("total_synthetic_outages",)
OUTAGE_COLUMNS = ("operator", "signal_type", "severity", "started_at", "ended_at", "duration_min")


def newest_outages(outages: DataFrame, limit: int | str | None = 100) -> DataFrame:
    """The newest outages (1..500), or all of them for ``limit=None``."""
    columns = [c for c in ("id", *OUTAGE_COLUMNS) if c in outages.columns]
    slim = outages.select(*columns)
    if limit is None:
        return slim
    tie = [F.asc_nulls_last(c) for c in columns if c != "started_at"]
    return slim.orderBy(F.desc_nulls_first("started_at"), *tie).limit(clamp_limit(limit, 100, 500))


def block_summary(name: str, outages: DataFrame, facts: DataFrame, bounded: bool = False) -> DataFrame:
    """Partial aggregates per distinct window (outages that share one are computed once).

    ``bounded`` is for a list that a limit or ``few`` keeps small.
    """
    block = BLOCKS[name]
    facts = _used(facts, block)
    if block.days is not None:
        windows = outages.select(*block.keys, F.to_date("started_at").alias("day")).distinct()
        return daily_stats(
            windows, facts, block.time, block.keys, block.measures, block.days, block.category
        )
    return preceding_stats(
        _windows(outages, block.keys, block.hours), facts, block.time, block.keys, block.measures, block.cell, block.category, bounded
    )


def _windows(outages: DataFrame, keys: list[str], hours: int) -> DataFrame:
    lower = F.expr(f"started_at - INTERVAL {hours} HOURS AS lower")
    return outages.select(*keys, lower, F.col("started_at").alias("upper")).distinct()


def _used(facts: DataFrame, block: Block) -> DataFrame:
    used = {*block.keys, block.time, block.category, PARTITION_COLUMN}
    return facts.select(*[c for c in facts.columns if c in used or _measured(c, block)])


def _measured(column: str, block: Block) -> bool:
    return any(m.value and re.search(rf"\b{column}\b", m.value) for m in block.measures)


def _result_sql(block: Block) -> list[str]:
    return [
        f"coalesce({m.name}_s, 0) AS {m.name}" if m.name in ZERO_TOTALS else m.result_sql()
        for m in block.measures
    ]


def _anchored(outages: DataFrame) -> DataFrame:
    """Outages with the window columns that the summaries are keyed by."""
    return outages.selectExpr("*", "started_at AS upper", "to_date(started_at) AS day")


def _joined(left: DataFrame, name: str, facts: DataFrame, outages: DataFrame, bounded: bool, stored: bool = False) -> DataFrame:
    summary = block_summary(name, outages, facts, bounded).withColumnRenamed(CATEGORIES, f"{CATEGORIES}_{name}")
    return left.join(written(summary, "summary") if stored else summary, BLOCKS[name].window, "left")


def _joined_to_all(left: DataFrame, tables: Mapping[str, DataFrame], outages: DataFrame) -> DataFrame:
    """All ten summaries of many outages: blocks with the same windows are made up together and joined once."""
    alike: dict[tuple[tuple[str, ...], int], list[str]] = {}
    for name, block in BLOCKS.items():
        if block.days is None:
            alike.setdefault((tuple(block.keys), block.hours), []).append(name)
    # Fewest columns first, as the outages are dealt out anew for other keys.
    for (keys, hours), names in sorted(alike.items(), key=lambda group: (len(group[0][0]), len(group[1]))):
        windows = written(_windows(outages, list(keys), hours), "windows")
        parts = {n: (_used(tables[BLOCKS[n].table], BLOCKS[n]), BLOCKS[n].time, BLOCKS[n].measures, BLOCKS[n].category) for n in names}
        left = left.join(preceding_of_tables(windows, parts, keys), [*keys, "upper"], "left")
    for name, block in BLOCKS.items():
        if block.days is not None:
            # Written, so that its size is known: where it is small the outages are not dealt out by day.
            left = _joined(left, name, tables[block.table], outages, False, True)
    return left


def block_stats(name: str, outages: DataFrame, facts: DataFrame, bounded: bool = False) -> DataFrame:
    """The given outages with one block's columns; ``bounded`` for a list that may be short, which is counted."""
    out = _joined(_anchored(outages), name, facts, outages, bounded and few(outages))
    return out.selectExpr(*outages.columns, *_result_sql(BLOCKS[name]))


def block_categories(name: str, outages: DataFrame, facts: DataFrame, bounded: bool = False) -> DataFrame:
    """Category counts before each outage as rows: outage columns, category, total."""
    out = _joined(_anchored(outages), name, facts, outages, bounded and few(outages))
    return out.selectExpr(*outages.columns, f"inline({CATEGORIES}_{name})")


def correlate_outages(tables: Mapping[str, DataFrame], limit: int | str | None = 100) -> DataFrame:
    """Each of the newest outages with the statistics of all ten fact tables before it.

    Category counts are maps with sorted keys.  ``limit=None`` takes every outage: windows are then made up from
    sums over the time line, and nothing is broadcast by hint.
    """
    bounded = limit is not None  # at most 500, by newest_outages
    outages = pinned(newest_outages(tables["outages"], limit))
    out = _anchored(outages)
    columns = ["id AS outage_id" if c == "id" else c for c in outages.columns]
    if not bounded:
        out = _joined_to_all(out, tables, outages)
    for name, block in BLOCKS.items():
        if bounded:
            out = _joined(out, name, tables[block.table], outages, bounded)
        columns += _result_sql(block)
        if block.map_name:
            sorted_entries = f"coalesce(array_sort({CATEGORIES}_{name}), array())"
            columns.append(f"map_from_entries({sorted_entries}) AS {block.map_name}")
    result = out.selectExpr(*columns)
    tie = ["outage_id"] if "id" in outages.columns else []
    return result.orderBy(F.desc_nulls_first("started_at"), *tie)
