"""Table schemas, natural keys and event-time columns."""

from __future__ import annotations

from dataclasses import dataclass

#: Column that the table store derives from the event time and partitions by.
PARTITION_COLUMN = "event_date"


@dataclass(frozen=True)
class TableSchema:
    """Schema of one table.  ``natural_key`` empty means append-only."""

    name: str
    ddl: str
    natural_key: tuple[str, ...] = ()
    event_time: str | None = None

    @property
    def columns(self) -> list[str]:
        return [part.split()[0] for part in self.ddl.split(",")]


_TABLES = (
    TableSchema(
        "towers",
        """id INT, cell_id BIGINT, radio STRING, mcc INT, mnc INT, lac INT, lon DOUBLE, lat DOUBLE,
        range_m INT, samples INT, average_signal INT, created_at BIGINT, updated_at BIGINT,
        operator STRING, network STRING, city STRING""",
        ("cell_id", "lac", "mnc"),
    ),
    TableSchema(
        "readings",
        """tower_id INT, cell_id BIGINT, city STRING, operator STRING, network STRING,
        signal_dbm DOUBLE, latency_ms INT, dl_mbps DOUBLE, ul_mbps DOUBLE, rsrp DOUBLE,
        rsrq DOUBLE, recorded_at TIMESTAMP_NTZ""",
        (),
        "recorded_at",
    ),
    TableSchema(
        "speed_tests",
        """server_city STRING, operator STRING, dl_mbps DOUBLE, ul_mbps DOUBLE, ping_ms DOUBLE,
        jitter_ms DOUBLE, rating STRING, tested_at TIMESTAMP_NTZ""",
        (),
        "tested_at",
    ),
    TableSchema(
        "outages",
        """source STRING, entity_type STRING, entity_code STRING, operator STRING, severity DOUBLE,
        signal_type STRING, started_at TIMESTAMP_NTZ, ended_at TIMESTAMP_NTZ, duration_min INT,
        raw_data STRING""",
        ("source", "entity_type", "entity_code", "operator", "signal_type", "started_at", "ended_at"),
        "started_at",
    ),
    TableSchema(
        "qos_metrics",
        """metric_id STRING, measured_at TIMESTAMP_NTZ, source_tower_id STRING, city STRING,
        operator STRING, network STRING, latency_ms DOUBLE, jitter_ms DOUBLE,
        throughput_mbps DOUBLE, packet_loss_rate DOUBLE, error_rate DOUBLE,
        signal_strength_dbm DOUBLE, active_users INT""",
        ("metric_id",),
        "measured_at",
    ),
    TableSchema(
        "coverage_data",
        """measurement_id STRING, lat DOUBLE, lon DOUBLE, city STRING, operator STRING,
        network STRING, signal_strength_dbm DOUBLE, coverage_quality STRING,
        download_speed_mbps DOUBLE, upload_speed_mbps DOUBLE, latency_ms DOUBLE,
        source_tower_id STRING, distance_to_tower_km DOUBLE, indoor_outdoor STRING""",
        ("measurement_id",),
    ),
    TableSchema(
        "network_events",
        """event_id STRING, event_time TIMESTAMP_NTZ, source_tower_id STRING, city STRING,
        event_type STRING, severity STRING, affected_users INT, packet_loss_percent DOUBLE,
        network STRING, operator STRING""",
        ("event_id",),
        "event_time",
    ),
    TableSchema(
        "hardware_sensors",
        """sensor_id STRING, sensor_time TIMESTAMP_NTZ, source_tower_id STRING, city STRING,
        equipment_type STRING, temperature_celsius DOUBLE, power_draw_watts DOUBLE,
        voltage_v DOUBLE, humidity_percent DOUBLE, vibration_level DOUBLE,
        health_status STRING, alert_triggered BOOLEAN""",
        ("sensor_id",),
        "sensor_time",
    ),
    TableSchema(
        "uptime_logs",
        """source_tower_id STRING, log_date DATE, operator STRING, city STRING, state STRING,
        uptime_percentage DOUBLE, downtime_minutes DOUBLE, outage_count INT,
        outage_reason STRING, network STRING, avg_users_affected INT""",
        ("source_tower_id", "log_date", "operator", "network"),
        "log_date",
    ),
    TableSchema(
        "energy_consumption",
        """source_tower_id STRING, usage_date DATE, city STRING, power_source STRING,
        daily_consumption_kwh DOUBLE, cost_per_kwh_ngn DOUBLE, total_cost_ngn DOUBLE,
        grid_availability_hours INT, generator_runtime_hours INT, solar_generation_kwh DOUBLE,
        fuel_consumed_liters DOUBLE, carbon_emissions_kg DOUBLE""",
        ("source_tower_id", "usage_date", "power_source"),
        "usage_date",
    ),
    TableSchema(
        "maintenance_orders",
        """work_order_id STRING, source_tower_id STRING, city STRING, operator STRING,
        maintenance_type STRING, issue_category STRING, priority STRING, status STRING,
        scheduled_date DATE, completed_date DATE, technician_id STRING,
        repair_duration_hours DOUBLE, parts_replaced STRING, cost_ngn DOUBLE,
        downtime_minutes DOUBLE""",
        ("work_order_id",),
        "scheduled_date",
    ),
    TableSchema(
        "latency_logs",
        """log_id STRING, measured_at TIMESTAMP_NTZ, source_tower_id STRING, city STRING,
        operator STRING, network STRING, application_type STRING, latency_ms DOUBLE,
        jitter_ms DOUBLE, packet_loss_percent DOUBLE, throughput_mbps DOUBLE,
        edge_server_id STRING, edge_distance_km DOUBLE, sla_target_ms DOUBLE, sla_met BOOLEAN,
        reliability_percent DOUBLE, active_connections INT""",
        ("log_id",),
        "measured_at",
    ),
    TableSchema(
        "handover_records",
        """handover_id STRING, handover_time TIMESTAMP_NTZ, source_tower_id STRING,
        target_tower_id STRING, source_city STRING, target_city STRING, operator STRING,
        network STRING, handover_type STRING, success BOOLEAN, duration_ms DOUBLE,
        source_signal_dbm DOUBLE, target_signal_dbm DOUBLE, failure_reason STRING,
        active_call BOOLEAN, active_data_session BOOLEAN, device_speed_kmh DOUBLE""",
        ("handover_id",),
        "handover_time",
    ),
    TableSchema(
        "dropped_calls",
        """drop_id STRING, dropped_at TIMESTAMP_NTZ, operator STRING, calling_number STRING,
        called_number STRING, source_tower_id STRING, city STRING,
        call_duration_before_drop INT, drop_reason STRING, signal_strength_dbm DOUBLE,
        network STRING""",
        ("drop_id",),
        "dropped_at",
    ),
    TableSchema(
        "mobility_traces",
        """trace_id STRING, trace_time TIMESTAMP_NTZ, customer_id STRING, lat DOUBLE, lon DOUBLE,
        city STRING, source_tower_id STRING, movement_speed_kmh DOUBLE, direction_degrees INT,
        user_density STRING, time_of_day STRING, day_of_week STRING, location_type STRING""",
        ("trace_id",),
        "trace_time",
    ),
    TableSchema(
        "network_penetration",
        """city STRING, state STRING, operator STRING, month DATE, total_users INT, users_2g INT,
        users_3g INT, users_4g INT, users_5g INT, penetration_4g_percent DOUBLE,
        penetration_5g_percent DOUBLE, growth_rate_4g_percent DOUBLE,
        growth_rate_5g_percent DOUBLE""",
        ("city", "state", "operator", "month"),
        "month",
    ),
    TableSchema(
        "technician_logs",
        """activity_id STRING, technician_id STRING, source_tower_id STRING, city STRING,
        operator STRING, activity_type STRING, priority STRING, status STRING,
        started_at TIMESTAMP_NTZ, ended_at TIMESTAMP_NTZ, duration_min INT,
        issue_resolved BOOLEAN, travel_km DOUBLE, materials_used STRING, notes STRING""",
        ("activity_id",),
        "started_at",
    ),
)

TABLES: dict[str, TableSchema] = {t.name: t for t in _TABLES}
