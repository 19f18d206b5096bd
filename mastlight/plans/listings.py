"""Specs of the list queries."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mastlight.operators.listing import ListSpec, Match, capped, listing, ordering, same
from mastlight.operators.timeslice import as_time, at_or_after
from mastlight.schemas import PARTITION_COLUMN, TABLES

NEWEST = "desc_nulls_first"
NEWEST_KNOWN = "desc_nulls_last"
A_TO_Z = "asc_nulls_last"


def _columns(table: str, *extra: str) -> tuple[str, ...]:
    return (*TABLES[table].columns, *extra)


def _network() -> Match:
    return Match("network", ("network",), "network")


def _tower(length: int = 40) -> Match:
    return same("tower_id", "source_tower_id", length, literal_all=True)


LISTS: dict[str, ListSpec] = {
    "towers": ListSpec(
        "towers",
        ("id", "cell_id", "radio", "operator", "network", "city", "lat", "lon",
         "range_m", "samples", "average_signal"),
        (same("operator"), same("network"), same("city")),
        (("samples", NEWEST),),
        box="unchecked",
        default_limit=5000,
        most=None,
    ),
    "qos": ListSpec(
        "qos_metrics",
        _columns("qos_metrics", "source"),
        (same("city"), same("operator"), _network(), _tower()),
        (("measured_at", NEWEST),),
        time="measured_at",
    ),
    "coverage": ListSpec(
        "coverage_data",
        _columns("coverage_data", "source"),
        (same("city"), same("operator"), _network()),
        (("signal_strength_dbm", NEWEST_KNOWN),),
        box="checked",
        most=2000,
    ),
    "events": ListSpec(
        "network_events",
        _columns("network_events", "source"),
        (same("operator"), same("city"), same("type", "event_type", 60), same("severity", length=20), _network()),
        (("event_time", NEWEST),),
        time="event_time",
    ),
    "hardware": ListSpec(
        "hardware_sensors",
        _columns("hardware_sensors", "source"),
        (same("city"), _tower(), same("equipment_type", length=40), same("health_status", length=20),
         Match("alert", ("alert_triggered",), "flag")),
        (("sensor_time", NEWEST),),
        time="sensor_time",
    ),
    "uptime": ListSpec(
        "uptime_logs",
        _columns("uptime_logs", "source"),
        (same("operator"), same("city"), same("state"), same("reason", "outage_reason", 40), _network(), _tower()),
        (("log_date", NEWEST), ("downtime_minutes", NEWEST_KNOWN)),
        time="log_date",
        time_is_date=True,
    ),
    "energy": ListSpec(
        "energy_consumption",
        _columns("energy_consumption", "source"),
        (same("city"), _tower(), same("power_source", length=40)),
        (("usage_date", NEWEST), ("daily_consumption_kwh", NEWEST_KNOWN)),
        time="usage_date",
        time_is_date=True,
    ),
    "maintenance": ListSpec(
        "maintenance_orders",
        _columns("maintenance_orders", "source"),
        (same("operator"), same("city"), _tower(), same("type", "maintenance_type", 40),
         same("issue", "issue_category", 60), same("priority", length=20), same("status", length=30)),
        (("scheduled_date", NEWEST_KNOWN), ("priority", A_TO_Z)),
        time="scheduled_date",
        time_is_date=True,
    ),
    "latency": ListSpec(
        "latency_logs",
        _columns("latency_logs", "source"),
        (same("operator"), same("city"), _network(), _tower(), same("application_type", length=60)),
        (("measured_at", NEWEST),),
        time="measured_at",
    ),
    "handovers": ListSpec(
        "handover_records",
        _columns("handover_records", "source"),
        (same("operator"), Match("city", ("source_city", "target_city")), _network(),
         Match("tower_id", ("source_tower_id", "target_tower_id"), length=40, literal_all=True),
         Match("success", ("success",), "flag")),
        (("handover_time", NEWEST),),
        time="handover_time",
    ),
    "dropped_calls": ListSpec(
        "dropped_calls",
        _columns("dropped_calls", "source"),
        (same("operator"), same("city"), _network(), same("reason", "drop_reason", 60), _tower()),
        (("dropped_at", NEWEST),),
        time="dropped_at",
    ),
    "mobility": ListSpec(
        "mobility_traces",
        _columns("mobility_traces", "source"),
        (same("city"), _tower(), same("density", "user_density", 20), same("location_type", length=40)),
        (("trace_time", NEWEST),),
        box="checked",
    ),
    "penetration": ListSpec(
        "network_penetration",
        _columns("network_penetration", "source"),
        (same("operator"), same("city"), same("state")),
        (("month", NEWEST), ("city", A_TO_Z), ("operator", A_TO_Z)),
        time="month",
        time_is_date=True,
    ),
    "technicians": ListSpec(
        "technician_logs",
        _columns("technician_logs", "source"),
        (same("operator"), same("city"), _tower(), same("technician_id", length=40, literal_all=True),
         same("status", length=30), same("type", "activity_type", 60)),
        (("started_at", NEWEST_KNOWN),),
        time="started_at",
    ),
}


def run_list(name: str, df: DataFrame, **params: object) -> DataFrame:
    """Run a list query by name.  ``from_`` stands for the parameter ``from``."""
    return listing(df, LISTS[name], {k.rstrip("_"): v for k, v in params.items()})


SPEED_TEST_LIMIT = 50


def latest_speed_tests(speed_tests: DataFrame, limit: int | None = SPEED_TEST_LIMIT) -> DataFrame:
    """The newest speed tests with all their columns; ``limit=None`` lists all."""
    columns = [c for c in speed_tests.columns if c != PARTITION_COLUMN]
    order = [("tested_at", NEWEST), *((c, A_TO_Z) for c in columns if c != "tested_at")]
    ordered = speed_tests.select(*columns).orderBy(*ordering(order))
    return ordered if limit is None else ordered.limit(limit)


OUTAGE_COLUMNS = (
    "id", "source", "entity_type", "entity_code", "operator", "severity", "signal_type",
    "started_at", "ended_at", "duration_min", "raw_data",
)


def list_outages(
    outages: DataFrame,
    as_of: dt.datetime | str,
    operator: str | None = None,
    from_: float | None = None,
    until: float | None = None,
    min_severity: float | str | None = 0,
    limit: int | str | None = 200,
) -> DataFrame:
    """Newest outages that started in a range of epoch seconds (default: the last 7 days); ``limit=None`` lists all."""
    now = as_time(as_of)
    upper = F.timestamp_seconds(F.lit(float(until))).cast("timestamp_ntz") if until else now
    lower = (
        F.timestamp_seconds(F.lit(float(from_))).cast("timestamp_ntz")
        if from_
        else now - F.make_dt_interval(days=F.lit(7))
    )
    rows = at_or_after(outages, "started_at", lower).filter(F.col("started_at") <= upper)
    if operator and operator != "all":
        rows = rows.filter(F.col("operator") == operator)
    try:
        least = float(min_severity or 0)
    except ValueError:
        least = 0.0
    if 0 < least < float("inf"):
        rows = rows.filter(F.col("severity") >= least)
    columns = [c for c in OUTAGE_COLUMNS if c in outages.columns]
    order = [("started_at", NEWEST), *((c, A_TO_Z) for c in columns if c != "started_at")]
    return capped(rows.select(*columns).orderBy(*ordering(order)), limit, 200, 500)
