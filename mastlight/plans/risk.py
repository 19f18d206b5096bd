"""Explainable outage-risk score per operator."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mastlight.fixed_values import (
    BAD_HEALTH,
    HIGH_PRIORITY,
    RISK_BANDS,
    RISK_CONFIDENCE,
    RISK_CONTRIBUTORS,
    RISK_MODEL,
    RISK_OPERATORS,
    TOP_CONTRIBUTORS,
)
from mastlight.functions.numeric import exact_round_sql, exact_sum_sql
from mastlight.functions.parsing import listed, quoted
from mastlight.functions.scoring import ramp_sql, tier
from mastlight.operators.listing import leading_int
from mastlight.operators.timeslice import as_time, at_or_after, hours_before, last_days, last_hours

EVIDENCE_COUNTS = (
    "live_sample_count", "qos_sample_count", "event_count", "uptime_log_count",
    "maintenance_order_count", "latency_log_count", "handover_count", "dropped_call_count",
    "technician_activity_count",
)
COUNTS = (
    *EVIDENCE_COUNTS, "uptime_outage_count", "hardware_alert_count", "hardware_bad_health_count",
    "maintenance_high_priority_count", "latency_sla_miss_count", "handover_failure_count",
    "technician_unresolved_count",
)


def clamp_hours(hours: object) -> int:
    """Window length: unreadable or zero means 6, then 1..72."""
    return min(max(leading_int(hours) or 6, 1), 72)


def _worded(column: str, words: Sequence[str]) -> str:
    return f"lower(coalesce({column}, '')) IN ({listed(words)})"


def _mean(column: str, digits: int, name: str) -> Column:
    return F.expr(f"{exact_round_sql(f'avg({column})', digits)} AS {name}")


def _matching(condition: str, name: str) -> Column:
    return F.expr(f"count_if({condition}) AS {name}")


def risk_inputs(
    tables: Mapping[str, DataFrame],
    as_of: dt.datetime | str,
    hours: int | str = 6,
    operators: Sequence[str] = RISK_OPERATORS,
) -> DataFrame:
    """The model's inputs per operator: one scan and one small aggregate per fact table."""
    hours = clamp_hours(hours)

    def of_operators(df: DataFrame) -> DataFrame:
        return df.filter(F.col("operator").isin(*operators))

    count = F.count("*")
    live = of_operators(
        at_or_after(tables["readings"], "recorded_at", hours_before(as_time(as_of), hours))
    ).groupBy("operator").agg(
        count.alias("live_sample_count"),
        _mean("signal_dbm", 1, "live_avg_signal"),
        _mean("latency_ms", 1, "live_avg_latency"),
        _mean("dl_mbps", 1, "live_avg_dl"),
    )
    qos = of_operators(last_hours(tables["qos_metrics"], "measured_at", hours)).groupBy("operator").agg(
        count.alias("qos_sample_count"),
        _mean("signal_strength_dbm", 1, "qos_avg_signal"),
        _mean("latency_ms", 1, "qos_avg_latency"),
        _mean("packet_loss_rate", 2, "qos_avg_packet_loss"),
        _mean("error_rate", 2, "qos_avg_error_rate"),
    )
    events = of_operators(last_hours(tables["network_events"], "event_time", hours)).groupBy("operator").agg(
        count.alias("event_count"), _mean("packet_loss_percent", 2, "event_avg_packet_loss")
    )
    uptime = of_operators(last_days(tables["uptime_logs"], "log_date", 7)).groupBy("operator").agg(
        count.alias("uptime_log_count"),
        _mean("uptime_percentage", 2, "uptime_avg_percentage"),
        F.expr(f"{exact_round_sql(exact_sum_sql('downtime_minutes'), 1)} AS uptime_downtime_minutes"),
        F.sum("outage_count").alias("uptime_outage_count"),
    )
    maintenance = of_operators(
        last_days(tables["maintenance_orders"], "scheduled_date", 14)
    ).groupBy("operator").agg(
        count.alias("maintenance_order_count"),
        _matching(_worded("priority", HIGH_PRIORITY), "maintenance_high_priority_count"),
        F.expr(f"{exact_round_sql(exact_sum_sql('downtime_minutes'), 1)} AS maintenance_downtime_minutes"),
    )
    latency = of_operators(last_hours(tables["latency_logs"], "measured_at", hours)).groupBy("operator").agg(
        count.alias("latency_log_count"),
        _mean("packet_loss_percent", 2, "latency_avg_packet_loss"),
        _matching("NOT sla_met", "latency_sla_miss_count"),
    )
    handover = of_operators(
        last_hours(tables["handover_records"], "handover_time", hours)
    ).groupBy("operator").agg(
        count.alias("handover_count"), _matching("NOT success", "handover_failure_count")
    )
    dropped = of_operators(last_hours(tables["dropped_calls"], "dropped_at", hours)).groupBy("operator").agg(
        count.alias("dropped_call_count"), _mean("signal_strength_dbm", 1, "dropped_avg_signal")
    )
    technician = of_operators(last_days(tables["technician_logs"], "started_at", 7)).groupBy("operator").agg(
        count.alias("technician_activity_count"),
        _matching("NOT issue_resolved", "technician_unresolved_count"),
    )
    # These two carry no operator: one row for the whole country.
    hardware = last_hours(tables["hardware_sensors"], "sensor_time", hours).agg(
        _matching("alert_triggered", "hardware_alert_count"),
        _matching(_worded("health_status", BAD_HEALTH), "hardware_bad_health_count"),
    )
    energy = last_days(tables["energy_consumption"], "usage_date", 2).agg(
        _mean("grid_availability_hours", 1, "energy_avg_grid_hours"),
        _mean("generator_runtime_hours", 1, "energy_avg_generator_hours"),
    )
    spark = tables["readings"].sparkSession
    out = spark.range(1).selectExpr(f"explode(array({listed(operators)})) AS operator")
    # Every frame joined below has at most one row per listed operator, or exactly one row.
    for stats in (live, qos, events, uptime, maintenance, latency, handover, dropped, technician):
        out = out.join(F.broadcast(stats), "operator", "left")
    out = out.crossJoin(F.broadcast(hardware)).crossJoin(F.broadcast(energy))
    others = [c for c in out.columns if c not in COUNTS]
    return out.selectExpr(*others, *[f"coalesce({c}, 0) AS {c}" for c in COUNTS])


def _contributors_sql() -> str:
    """All contributors with points, in model order; those without points are left out."""
    entries = []
    for rank, (label, source, parts, column, suffix, blank) in enumerate(RISK_CONTRIBUTORS):
        points = " + ".join(ramp_sql(name, start, end, most) for _, name, start, end, most in parts)
        shown = column if blank else f"coalesce({column}, 0)"
        entries.append(
            f"CASE WHEN {points} > 0 THEN named_struct('label', {quoted(label)}, "
            f"'points', floor(({points}) * 10 + 0.5D) / 10, "
            f"'evidence', concat(cast({shown} AS string), {quoted(suffix)}), "
            f"'source', {quoted(source)}, 'rank', {rank}) END"
        )
    return f"array_compact(array({', '.join(entries)}))"


def _strongest_sql(contributors: str) -> str:
    """The top contributors, most points first, equal points in model order."""
    keyed = f"transform({contributors}, c -> struct(-c.points AS place, c.rank AS rank, c AS entry))"
    return (
        f"transform(slice(array_sort({keyed}), 1, {TOP_CONTRIBUTORS}), "
        "k -> named_struct('label', k.entry.label, 'points', k.entry.points, "
        "'evidence', k.entry.evidence, 'source', k.entry.source))"
    )


def score_risk(inputs: DataFrame) -> DataFrame:
    """Score, band, confidence and top contributors from ``risk_inputs`` rows."""
    scored = inputs.selectExpr("*", f"{_contributors_sql()} AS _all").selectExpr(
        "*",
        "floor(least(100D, aggregate(_all, 0D, (sum, c) -> sum + c.points)) * 10 + 0.5D) / 10 AS score",
        f"cast({' + '.join(EVIDENCE_COUNTS)} AS bigint) AS evidence_count",
    )
    return scored.select(
        "operator",
        "score",
        tier(F.col("score"), RISK_BANDS, "low").alias("band"),
        tier(F.col("evidence_count"), RISK_CONFIDENCE, "low").alias("confidence"),
        "evidence_count",
        F.expr(
            "struct(live_sample_count AS sample_count, cast(live_avg_signal AS double) AS avg_signal, "
            "cast(live_avg_latency AS double) AS avg_latency, cast(live_avg_dl AS double) AS avg_dl)"
        ).alias("live"),
        F.expr(
            "struct(qos_sample_count AS qos_samples, event_count AS network_events, "
            "uptime_outage_count AS uptime_outages, hardware_alert_count AS hardware_alerts, "
            "maintenance_order_count AS maintenance_orders, latency_sla_miss_count AS latency_sla_misses, "
            "handover_failure_count AS handover_failures, dropped_call_count AS dropped_calls, "
            "technician_unresolved_count AS unresolved_technician_jobs)"
        ).alias("synthetic"),
        F.expr(_strongest_sql("_all")).alias("contributors"),
        F.lit(RISK_MODEL).alias("model"),
    )


def outage_risk(
    tables: Mapping[str, DataFrame],
    as_of: dt.datetime | str,
    hours: int | str = 6,
    operators: Sequence[str] = RISK_OPERATORS,
) -> DataFrame:
    """Risk per operator, highest first."""
    return score_risk(risk_inputs(tables, as_of, hours, operators)).orderBy(F.desc("score"), "operator")


def highest_risk(risks: DataFrame) -> DataFrame:
    """The single riskiest operator."""
    return risks.orderBy(F.desc("score"), "operator").limit(1)


def risk_contributors(risks: DataFrame) -> DataFrame:
    """The contributors as rows, with their place in each operator's list."""
    return risks.select(
        "operator", F.posexplode("contributors").alias("place", "entry")
    ).select("operator", "place", "entry.label", "entry.points", "entry.evidence", "entry.source")
