"""Monitoring tables derived from the given tables, every one over all rows of its base table.

An expression is one SQL text where Spark and DuckDB agree, else a (Spark, DuckDB) pair.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

Expr = str | tuple[str, str]
AS_OF = "2024-01-31 00:00:00"
MONTH_START = 1704067200  # 2024-01-01 in epoch seconds


def _operator(n: str) -> str:
    return (
        f"CASE CAST({n} % 4 AS INT) WHEN 0 THEN 'MTN' WHEN 1 THEN 'Airtel' WHEN 2 THEN 'Glo' ELSE '9mobile' END"
    )


def _network(n: str) -> str:
    return f"CASE CAST({n} % 4 AS INT) WHEN 0 THEN '2G' WHEN 1 THEN '3G' WHEN 2 THEN '4G' ELSE '5G' END"


def _label(prefix: str, n: str) -> str:
    return f"concat('{prefix}', CAST({n} AS STRING))"


def _city(n: str) -> str:
    return _label("CITY_", f"{n} % 25")


def _at(seconds: str) -> tuple[str, str]:
    """Timestamp a number of seconds into January 2024."""
    return (
        f"CAST(timestamp_seconds({MONTH_START} + {seconds}) AS TIMESTAMP_NTZ)",
        f"make_timestamp(({MONTH_START} + {seconds}) * 1000000)",
    )


def _unless(condition: str, value: Expr) -> Expr:
    if isinstance(value, tuple):
        return tuple(_unless(condition, v) for v in value)
    return f"CASE WHEN {condition} THEN NULL ELSE {value} END"


def _number(n: str, scale: str = "1e0") -> str:
    return f"CAST({n} AS DOUBLE) / {scale}"


_DAY = "make_date(2024, 1, 1 + CAST({} % 30 AS INT))"
_OUTAGE_START = "(o_orderkey * 7919) % 2592000"

VIEWS: dict[str, tuple[str, dict[str, Expr]]] = {
    "towers": ("supplier", {
        "id": "CAST(s_suppkey AS INT)",
        "cell_id": "1000 + s_suppkey % 700",
        "radio": "CASE CAST(s_nationkey % 4 AS INT) WHEN 0 THEN 'GSM' WHEN 1 THEN 'UMTS' WHEN 2 THEN 'LTE' ELSE 'NR' END",
        "operator": _operator("s_suppkey"),
        "network": _network("s_nationkey"),
        "city": _city("s_nationkey"),
        "lat": "4e0 + " + _number("(s_suppkey * 37) % 1000", "1e2"),
        "lon": "3e0 + " + _number("(s_suppkey * 53) % 1000", "1e2"),
        "range_m": "CAST(500 + s_suppkey % 3000 AS INT)",
        "samples": "CAST(s_suppkey % 50 AS INT)",
        "average_signal": "CAST(-60 - s_suppkey % 40 AS INT)",
    }),
    "readings": ("events", {
        "id": "event_id",
        "tower_id": _unless("event_id % 10 = 0", "CAST(user_id AS INT)"),
        "cell_id": _unless("event_id % 20 = 0", "1000 + user_id"),
        "city": _city("user_id"),
        "operator": _operator("user_id"),
        "network": _network("event_id"),
        "signal_dbm": _unless("event_id % 97 = 0", "-50e0 - " + _number("(event_id * 7) % 65")),
        "latency_ms": "CAST(20 + (event_id * 13) % 260 AS INT)",
        "dl_mbps": "value",
        "ul_mbps": "value / 4e0",
        "rsrp": "-70e0 - " + _number("event_id % 60"),
        "rsrq": "-3e0 - " + _number("event_id % 20"),
        "recorded_at": "ts",
    }),
    "outages": ("orders", {
        "id": "o_orderkey",
        "source": "'IODA'",
        "entity_type": "CASE CAST(o_custkey % 5 AS INT) WHEN 4 THEN 'country' ELSE 'asn' END",
        "entity_code": "CASE CAST(o_custkey % 5 AS INT) WHEN 0 THEN '29465' WHEN 1 THEN '36873' "
                       "WHEN 2 THEN '37148' WHEN 3 THEN '37076' ELSE 'NG' END",
        "operator": "CASE CAST(o_custkey % 5 AS INT) WHEN 0 THEN 'MTN' WHEN 1 THEN 'Airtel' "
                    "WHEN 2 THEN 'Glo' WHEN 3 THEN '9mobile' ELSE 'Nigeria' END",
        "severity": _number("o_orderkey % 100"),
        "signal_type": "CASE CAST(o_orderkey % 3 AS INT) WHEN 0 THEN 'bgp' WHEN 1 THEN 'ping' ELSE 'ibr' END",
        "started_at": _at(_OUTAGE_START),
        "ended_at": _unless("o_orderkey % 7 = 0", _at(f"{_OUTAGE_START} + (5 + o_orderkey % 600) * 60")),
        "duration_min": _unless("o_orderkey % 7 = 0", "CAST(5 + o_orderkey % 600 AS INT)"),
        "raw_data": "concat('{\"order\":', CAST(o_orderkey AS STRING), '}')",
    }),
    "qos_metrics": ("events", {
        "metric_id": _label("QOS-", "event_id"),
        "measured_at": "ts",
        "source_tower_id": _label("T-", "user_id % 10"),
        "city": _city("user_id"),
        "operator": _operator("user_id"),
        "network": _network("event_id"),
        "latency_ms": _number("30 + (event_id * 11) % 300"),
        "jitter_ms": _number("event_id % 40"),
        "throughput_mbps": "value",
        "packet_loss_rate": _number("event_id % 90", "1e1"),
        "error_rate": _number("event_id % 60", "1e1"),
        "signal_strength_dbm": "-70e0 - " + _number("(event_id * 3) % 50"),
        "active_users": "CAST(event_id % 500 AS INT)",
        "source": "'synthetic'",
    }),
    "coverage_data": ("events", {
        "measurement_id": _label("COV-", "event_id"),
        "lat": "4e0 + " + _number("(event_id * 37) % 1000", "1e2"),
        "lon": "3e0 + " + _number("(event_id * 53) % 1000", "1e2"),
        "city": _city("user_id"),
        "operator": _operator("user_id"),
        "network": _network("event_id"),
        "signal_strength_dbm": _unless("event_id % 89 = 0", "-60e0 - " + _number("(event_id * 7) % 55")),
        "coverage_quality": "CASE event_id % 3 WHEN 0 THEN 'poor' WHEN 1 THEN 'fair' ELSE 'good' END",
        "download_speed_mbps": "value",
        "upload_speed_mbps": "value / 4e0",
        "latency_ms": _number("20 + (event_id * 13) % 260"),
        "source_tower_id": _label("T-", "user_id % 10"),
        "distance_to_tower_km": _number("event_id % 77", "1e1"),
        "indoor_outdoor": "CASE event_id % 2 WHEN 0 THEN 'indoor' ELSE 'outdoor' END",
        "source": "'synthetic'",
    }),
    "network_events": ("events", {
        "event_id": _label("EVT-", "event_id"),
        "event_time": "ts",
        "source_tower_id": _label("T-", "user_id % 10"),
        "city": _city("user_id"),
        "event_type": _unless("event_id % 13 = 0", "event_type"),
        "severity": "CASE event_id % 3 WHEN 0 THEN 'low' WHEN 1 THEN 'medium' ELSE 'high' END",
        "affected_users": "CAST(event_id % 900 AS INT)",
        "packet_loss_percent": _number("event_id % 100", "1e1"),
        "network": _network("event_id"),
        "operator": _operator("user_id"),
        "source": "'synthetic'",
    }),
    "hardware_sensors": ("events", {
        "sensor_id": _label("HWS-", "event_id"),
        "sensor_time": "ts",
        "source_tower_id": _label("T-", "user_id % 10"),
        "city": _city("user_id"),
        "equipment_type": "CASE event_id % 3 WHEN 0 THEN 'battery' WHEN 1 THEN 'rectifier' ELSE 'antenna' END",
        "temperature_celsius": _number("20 + event_id % 45"),
        "power_draw_watts": "value * 1e1",
        "voltage_v": "48e0 + " + _number("event_id % 10", "1e1"),
        "humidity_percent": _number("event_id % 100"),
        "vibration_level": _number("event_id % 30", "1e1"),
        "health_status": "CASE event_id % 5 WHEN 0 THEN 'Warning' WHEN 1 THEN 'critical' WHEN 2 THEN NULL ELSE 'ok' END",
        "alert_triggered": _unless("event_id % 17 = 0", "event_id % 7 = 0"),
        "source": "'synthetic'",
    }),
    "uptime_logs": ("lineitem", {
        "source_tower_id": _label("T-", "l_suppkey"),
        "log_date": _DAY.format("l_orderkey"),
        "operator": _operator("l_suppkey"),
        "city": _city("l_suppkey"),
        "state": _label("STATE_", "l_suppkey % 7"),
        "uptime_percentage": "100e0 - l_quantity / 1e1",
        "downtime_minutes": "l_quantity",
        "outage_count": "CAST(l_linenumber AS INT)",
        "outage_reason": _unless("l_returnflag = 'N'", "l_returnflag"),
        "network": _network("l_partkey"),
        "avg_users_affected": "CAST(l_partkey % 400 AS INT)",
        "source": "'synthetic'",
    }),
    "energy_consumption": ("lineitem", {
        "source_tower_id": _label("T-", "l_suppkey"),
        "usage_date": _DAY.format("l_orderkey"),
        "city": _city("l_suppkey"),
        "power_source": "CASE l_returnflag WHEN 'A' THEN 'grid' WHEN 'N' THEN 'solar' ELSE 'diesel' END",
        "daily_consumption_kwh": "l_quantity",
        "cost_per_kwh_ngn": "2e2 + l_tax * 1e2",
        "total_cost_ngn": "l_extendedprice",
        "grid_availability_hours": "CAST(l_linenumber * 3 AS INT)",
        "generator_runtime_hours": "CAST(24 - l_linenumber * 3 AS INT)",
        "solar_generation_kwh": "l_quantity / 2e0",
        "fuel_consumed_liters": "l_extendedprice / 1e3",
        "carbon_emissions_kg": "l_extendedprice / 1e2",
        "source": "'synthetic'",
    }),
    "maintenance_orders": ("orders", {
        "work_order_id": _label("MWO-", "o_orderkey"),
        "source_tower_id": _label("T-", "o_custkey % 100"),
        "city": _city("o_custkey"),
        "operator": _operator("o_custkey"),
        "maintenance_type": "CASE CAST(o_orderkey % 3 AS INT) WHEN 0 THEN 'preventive' WHEN 1 THEN 'corrective' ELSE 'emergency' END",
        "issue_category": _unless("o_orderkey % 19 = 0", "o_orderpriority"),
        "priority": "CASE WHEN o_orderpriority = '1-URGENT' THEN 'Urgent' WHEN o_orderpriority = '2-HIGH' THEN 'High' "
                    "WHEN o_orderkey % 23 = 0 THEN NULL ELSE 'low' END",
        "status": "o_orderstatus",
        "scheduled_date": _unless("o_orderkey % 29 = 0", _DAY.format("o_orderkey")),
        "completed_date": _unless("o_orderstatus = 'O'", _DAY.format("(o_orderkey + 3)")),
        "technician_id": _label("TEC-", "o_custkey % 40"),
        "repair_duration_hours": _number("o_orderkey % 48", "2e0"),
        "parts_replaced": "CASE WHEN o_orderkey % 2 = 0 THEN 'None' ELSE 'fuse' END",
        "cost_ngn": "o_totalprice",
        "downtime_minutes": "o_totalprice / 1e3",
        "source": "'synthetic'",
    }),
    "latency_logs": ("events", {
        "log_id": _label("LAT-", "event_id"),
        "measured_at": "ts",
        "source_tower_id": _label("T-", "user_id % 10"),
        "city": _city("user_id"),
        "operator": _operator("user_id"),
        "network": _network("event_id"),
        "application_type": "event_type",
        "latency_ms": _number("1 + event_id % 30"),
        "jitter_ms": _number("event_id % 9", "2e0"),
        "packet_loss_percent": _number("event_id % 80", "1e1"),
        "throughput_mbps": "value",
        "edge_server_id": _label("EDGE-", "user_id % 6"),
        "edge_distance_km": _number("event_id % 55", "1e1"),
        "sla_target_ms": "2e1",
        "sla_met": _unless("event_id % 11 = 0", "event_id % 30 < 20"),
        "reliability_percent": "99e0 + " + _number("event_id % 10", "1e1"),
        "active_connections": "CAST(event_id % 250 AS INT)",
        "source": "'synthetic'",
    }),
    "handover_records": ("events", {
        "handover_id": _label("HND-", "event_id"),
        "handover_time": "ts",
        "source_tower_id": _label("T-", "user_id % 10"),
        "target_tower_id": _label("T-", "(user_id + 1) % 10"),
        "source_city": _city("user_id"),
        "target_city": _city("(user_id + 7)"),
        "operator": _operator("user_id"),
        "network": _network("event_id"),
        "handover_type": "CASE event_id % 2 WHEN 0 THEN 'intra' ELSE 'inter' END",
        "success": _unless("event_id % 31 = 0", "event_id % 6 <> 0"),
        "duration_ms": "value * 1e1",
        "source_signal_dbm": "-70e0 - " + _number("event_id % 40"),
        "target_signal_dbm": "-65e0 - " + _number("event_id % 35"),
        "failure_reason": "CASE WHEN event_id % 6 = 0 THEN 'timeout' ELSE 'None' END",
        "active_call": "event_id % 2 = 0",
        "active_data_session": "event_id % 3 = 0",
        "device_speed_kmh": _number("event_id % 120"),
        "source": "'synthetic'",
    }),
    "dropped_calls": ("events", {
        "drop_id": _label("DRP-", "event_id"),
        "dropped_at": "ts",
        "operator": _operator("user_id"),
        "calling_number": _label("+234", "user_id"),
        "called_number": _label("+235", "user_id"),
        "source_tower_id": _label("T-", "user_id % 10"),
        "city": _city("user_id"),
        "call_duration_before_drop": "CAST(event_id % 600 AS INT)",
        "drop_reason": "CASE event_id % 4 WHEN 0 THEN 'weak_signal' WHEN 1 THEN 'handover_failure' "
                       "WHEN 2 THEN 'congestion' ELSE NULL END",
        "signal_strength_dbm": "-75e0 - " + _number("(event_id * 3) % 45"),
        "network": _network("event_id"),
        "source": "'synthetic'",
    }),
    "mobility_traces": ("events", {
        "trace_id": _label("TRC-", "event_id"),
        "trace_time": "ts",
        "customer_id": _label("CUS-", "user_id"),
        "lat": "4e0 + " + _number("(event_id * 17) % 1000", "1e2"),
        "lon": "3e0 + " + _number("(event_id * 29) % 1000", "1e2"),
        "city": _city("user_id"),
        "source_tower_id": _label("T-", "user_id % 10"),
        "movement_speed_kmh": "value",
        "direction_degrees": "CAST(event_id % 360 AS INT)",
        "user_density": "CASE event_id % 3 WHEN 0 THEN 'low' WHEN 1 THEN 'medium' ELSE 'high' END",
        "time_of_day": "CASE event_id % 2 WHEN 0 THEN 'day' ELSE 'night' END",
        "day_of_week": _label("D", "event_id % 7"),
        "location_type": "CASE event_id % 2 WHEN 0 THEN 'urban' ELSE 'rural' END",
        "source": "'synthetic'",
    }),
    "technician_logs": ("events", {
        "activity_id": _label("TECH-", "event_id"),
        "technician_id": _label("TEC-", "user_id % 40"),
        "source_tower_id": _label("T-", "user_id % 10"),
        "city": _city("user_id"),
        "operator": _operator("user_id"),
        "activity_type": "event_type",
        "priority": "CASE event_id % 3 WHEN 0 THEN 'low' WHEN 1 THEN 'medium' ELSE 'high' END",
        "status": "CASE event_id % 3 WHEN 0 THEN 'open' WHEN 1 THEN 'closed' ELSE 'waiting' END",
        "started_at": _unless("event_id % 41 = 0", "ts"),
        "ended_at": _unless("event_id % 3 = 0", "ts"),
        "duration_min": "CAST(15 + event_id % 200 AS INT)",
        "issue_resolved": "CASE event_id % 3 WHEN 0 THEN false WHEN 1 THEN true ELSE NULL END",
        "travel_km": "value / 2e0",
        "materials_used": "CASE WHEN event_id % 2 = 0 THEN 'None' ELSE 'cable' END",
        "notes": "''",
        "source": "'synthetic'",
    }),
    "speed_tests": ("events", {
        "id": "event_id",
        "server_city": _city("user_id"),
        "operator": _operator("user_id"),
        "dl_mbps": "value",
        "ul_mbps": "value / 3e0",
        "ping_ms": _number("event_id % 120"),
        "jitter_ms": _number("event_id % 20", "2e0"),
        "rating": "CASE WHEN value > 5e1 THEN 'good' ELSE 'poor' END",
        "tested_at": "ts",
    }),
    "destinations": ("customer", {
        "dest_id": "c_custkey",
        "lat": "4e0 + " + _number("(c_custkey * 41) % 1000", "1e2"),
        "lon": "3e0 + " + _number("(c_custkey * 59) % 1000", "1e2"),
        "radius_km": "5e1",
    }),
}

_PENETRATION_KEYS = {
    "city": _city("c_nationkey"),
    "state": _label("STATE_", "c_nationkey % 5"),
    "operator": _operator("c_custkey"),
    "month": "make_date(2024, 1 + CAST(c_custkey % 12 AS INT), 1)",
}
_SEGMENTS = {"users_2g": "BUILDING", "users_3g": "MACHINERY", "users_4g": "FURNITURE", "users_5g": "HOUSEHOLD"}


def _penetration_sql() -> str:
    keys = ", ".join(f"{e} AS {n}" for n, e in _PENETRATION_KEYS.items())
    counts = ", ".join(
        f"CAST(SUM(CASE WHEN c_mktsegment = '{s}' THEN 1 ELSE 0 END) AS INT) AS {n}" for n, s in _SEGMENTS.items()
    )
    return (
        f"SELECT city, state, operator, month, CAST(COUNT(*) AS INT) AS total_users, {counts}, "
        "AVG(growth) AS penetration_4g_percent, AVG(growth) / 2e0 AS penetration_5g_percent, "
        "AVG(growth) / 4e0 AS growth_rate_4g_percent, AVG(growth) / 8e0 AS growth_rate_5g_percent, "
        f"'synthetic' AS source FROM (SELECT {keys}, c_mktsegment, CAST(c_custkey % 64 AS DOUBLE) AS growth FROM customer) base "
        "GROUP BY city, state, operator, month"
    )


def _pick(expr: Expr, engine: int) -> str:
    return expr[engine] if isinstance(expr, tuple) else expr


def duck_view(name: str) -> str:
    """The view's SELECT for DuckDB."""
    if name == "network_penetration":
        return _penetration_sql()
    base, columns = VIEWS[name]
    return f"SELECT {', '.join(f'{_pick(e, 1)} AS {c}' for c, e in columns.items())} FROM {base}"


def view_sql(name: str) -> list[str]:
    """The view's columns for Spark."""
    return [f"{_pick(e, 0)} AS {c}" for c, e in VIEWS[name][1].items()]


def base_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


class Tables(dict):
    """All views of one folder by name, built when first asked for; each base table is opened once."""

    def __init__(self, spark: SparkSession, folder: str):
        super().__init__()
        self.spark, self.folder = spark, folder
        self.base: dict[str, DataFrame] = {}

    def open(self, name: str) -> DataFrame:
        if name not in self.base:
            self.base[name] = base_table(self.spark, self.folder, name)
        return self.base[name]

    def __missing__(self, name: str) -> DataFrame:
        if name == "network_penetration":
            sql = _penetration_sql().replace("FROM customer)", "FROM {customer})")
            self[name] = self.spark.sql(sql, customer=self.open("customer"))
        elif name in VIEWS:
            self[name] = self.open(VIEWS[name][0]).selectExpr(*view_sql(name))
        else:
            raise KeyError(name)
        return self[name]
