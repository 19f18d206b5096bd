"""Source layouts: which source columns feed each target column, and how they are read."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Field:
    """One target column.

    ``kind`` is text, number, int, network, boolean, timestamp, date or month.  ``required`` rejects
    the row when the value is missing; ``epoch_when_missing`` reads an absent time as 1970-01-01
    (an unreadable one still rejects).
    """

    target: str
    kind: str
    names: tuple[str, ...]
    length: int = 0
    fallback: str = "Unknown"
    words: str = "plain"
    required: bool = False
    epoch_when_missing: bool = False


@dataclass(frozen=True)
class Layout:
    """All fields of a dataset; ``id_prefix`` builds fallback ids from the row's ordinal."""

    table: str
    fields: tuple[Field, ...]
    id_prefix: str | None = None

    @property
    def id_field(self) -> Field | None:
        return self.fields[0] if self.id_prefix else None


def text(target: str, length: int, *names: str, fallback: str = "Unknown", required: bool = False) -> Field:
    return Field(target, "text", names or (target,), length, fallback, required=required)


def num(target: str, *names: str, required: bool = False) -> Field:
    return Field(target, "number", names or (target,), required=required)


def whole(target: str, *names: str) -> Field:
    return Field(target, "int", names or (target,))


def net(*names: str) -> Field:
    return Field("network", "network", names or ("network_type",))


def flag(target: str, words: str, *names: str) -> Field:
    return Field(target, "boolean", names or (target,), words=words)


def when(target: str, kind: str, *names: str, required: bool = False, epoch: bool = False) -> Field:
    return Field(target, kind, names, required=required, epoch_when_missing=epoch)


# --- fixed values: source column names per target column, in order of preference --------------
LAYOUTS: dict[str, Layout] = {
    "qos_metrics": Layout("qos_metrics", (
        text("metric_id", 40, required=True),
        when("measured_at", "timestamp", "timestamp", required=True),
        text("source_tower_id", 40, "tower_id"),
        text("city", 60),
        text("operator", 20),
        net(),
        num("latency_ms"),
        num("jitter_ms"),
        num("throughput_mbps"),
        num("packet_loss_rate"),
        num("error_rate"),
        num("signal_strength_dbm"),
        whole("active_users"),
    )),
    "coverage_data": Layout("coverage_data", (
        text("measurement_id", 40, "measurement_id", "coverage_id", "record_id", "id"),
        num("lat", "latitude", "lat", required=True),
        num("lon", "longitude", "lon", "lng", required=True),
        text("city", 60),
        text("operator", 20, "operator", "provider"),
        net("network_type", "network"),
        num("signal_strength_dbm", "signal_strength_dbm", "signal_dbm"),
        text("coverage_quality", 20, "coverage_quality", "quality"),
        num("download_speed_mbps", "download_speed_mbps", "dl_mbps"),
        num("upload_speed_mbps", "upload_speed_mbps", "ul_mbps"),
        num("latency_ms"),
        text("source_tower_id", 40, "tower_id", "source_tower_id"),
        num("distance_to_tower_km", "distance_to_tower_km", "distance_km"),
        text("indoor_outdoor", 20, "indoor_outdoor", "environment"),
    ), id_prefix="COV-"),
    "network_events": Layout("network_events", (
        text("event_id", 40, required=True),
        when("event_time", "timestamp", "timestamp", required=True),
        text("source_tower_id", 40, "tower_id"),
        text("city", 60),
        text("event_type", 60),
        text("severity", 20),
        whole("affected_users"),
        num("packet_loss_percent"),
        net(),
        text("operator", 20),
    )),
    "hardware_sensors": Layout("hardware_sensors", (
        text("sensor_id", 40, "sensor_id", "reading_id", "id"),
        when("sensor_time", "timestamp", "timestamp", "sensor_time", "recorded_at", required=True, epoch=True),
        text("source_tower_id", 40, "tower_id", "source_tower_id"),
        text("city", 60),
        text("equipment_type", 40, "equipment_type", "equipment"),
        num("temperature_celsius", "temperature_celsius", "temperature_c", "temperature"),
        num("power_draw_watts", "power_draw_watts", "power_watts", "power_draw"),
        num("voltage_v", "voltage_v", "voltage"),
        num("humidity_percent", "humidity_percent", "humidity"),
        num("vibration_level", "vibration_level", "vibration"),
        text("health_status", 20, "health_status", "status"),
        flag("alert_triggered", "plain", "alert_triggered", "alert_flag", "alert"),
    ), id_prefix="HWS-"),
    "uptime_logs": Layout("uptime_logs", (
        text("source_tower_id", 40, "tower_id", required=True),
        when("log_date", "date", "date", required=True),
        text("operator", 20),
        text("city", 60),
        text("state", 60),
        num("uptime_percentage"),
        num("downtime_minutes"),
        whole("outage_count"),
        text("outage_reason", 40, fallback="none"),
        net(),
        whole("avg_users_affected"),
    )),
    "energy_consumption": Layout("energy_consumption", (
        text("source_tower_id", 40, "tower_id", "source_tower_id", required=True),
        when("usage_date", "date", "date", "usage_date", "record_date", required=True, epoch=True),
        text("city", 60),
        text("power_source", 40, "power_source", "primary_power_source"),
        num("daily_consumption_kwh", "daily_consumption_kwh", "energy_consumption_kwh", "consumption_kwh"),
        num("cost_per_kwh_ngn", "cost_per_kwh_ngn", "cost_per_kwh"),
        num("total_cost_ngn", "total_cost_ngn", "daily_cost_ngn", "cost_ngn"),
        whole("grid_availability_hours", "grid_availability_hours", "grid_hours"),
        whole("generator_runtime_hours", "generator_runtime_hours", "generator_hours"),
        num("solar_generation_kwh", "solar_generation_kwh", "solar_kwh"),
        num("fuel_consumed_liters", "fuel_consumed_liters", "fuel_liters"),
        num("carbon_emissions_kg", "carbon_emissions_kg", "co2_emissions_kg"),
    )),
    "maintenance_orders": Layout("maintenance_orders", (
        text("work_order_id", 40, "work_order_id", "order_id", "maintenance_id", "id"),
        text("source_tower_id", 40, "tower_id", "source_tower_id"),
        text("city", 60),
        text("operator", 20, "operator", "provider"),
        text("maintenance_type", 40, "maintenance_type", "type"),
        text("issue_category", 60, "issue_category", "issue_type", "fault_category"),
        text("priority", 20),
        text("status", 30, "status", "work_order_status"),
        when("scheduled_date", "date", "scheduled_date", "schedule_date"),
        when("completed_date", "date", "completed_date", "completion_date", "closed_date"),
        text("technician_id", 40, "technician_id", "assigned_technician"),
        num("repair_duration_hours", "repair_duration_hours", "duration_hours"),
        text("parts_replaced", 120, "parts_replaced", "parts_used", fallback="None"),
        num("cost_ngn", "cost_ngn", "repair_cost_ngn", "maintenance_cost_ngn"),
        num("downtime_minutes", "downtime_minutes", "downtime_min"),
    ), id_prefix="MWO-"),
    "latency_logs": Layout("latency_logs", (
        text("log_id", 40, "log_id", "latency_id", "record_id", "id"),
        when("measured_at", "timestamp", "timestamp", "measured_at", "recorded_at", "log_time",
             required=True, epoch=True),
        text("source_tower_id", 40, "tower_id", "source_tower_id"),
        text("city", 60),
        text("operator", 20, "operator", "provider"),
        net("network_type", "network"),
        text("application_type", 60, "application_type", "service_type", "use_case", "app_type"),
        num("latency_ms", "latency_ms", "round_trip_latency_ms", "rtt_ms", "e2e_latency_ms"),
        num("jitter_ms"),
        num("packet_loss_percent", "packet_loss_percent", "packet_loss_rate"),
        num("throughput_mbps", "throughput_mbps", "bandwidth_mbps"),
        text("edge_server_id", 40, "edge_server_id", "server_id"),
        num("edge_distance_km", "edge_distance_km", "edge_server_distance_km", "distance_to_edge_km"),
        num("sla_target_ms", "sla_target_ms", "sla_requirement_ms", "latency_requirement_ms"),
        flag("sla_met", "sla", "sla_met", "sla_compliance", "requirement_met"),
        num("reliability_percent", "reliability_percent", "availability_percent"),
        whole("active_connections", "active_connections", "connected_users", "active_users"),
    ), id_prefix="LAT-"),
    "handover_records": Layout("handover_records", (
        text("handover_id", 40, "handover_id", "record_id", "event_id", "id"),
        when("handover_time", "timestamp", "timestamp", "handover_time", "recorded_at",
             required=True, epoch=True),
        text("source_tower_id", 40, "source_tower_id", "from_tower_id", "tower_id_from", "origin_tower_id"),
        text("target_tower_id", 40, "target_tower_id", "to_tower_id", "tower_id_to", "destination_tower_id"),
        text("source_city", 60, "source_city", "from_city", "origin_city", "city_from"),
        text("target_city", 60, "target_city", "to_city", "destination_city", "city_to"),
        text("operator", 20, "operator", "provider"),
        net("network_type", "network"),
        text("handover_type", 40, "handover_type", "type"),
        flag("success", "handover", "success", "handover_success", "successful", "status"),
        num("duration_ms", "duration_ms", "handover_duration_ms"),
        num("source_signal_dbm", "source_signal_dbm", "from_signal_dbm", "signal_before_dbm"),
        num("target_signal_dbm", "target_signal_dbm", "to_signal_dbm", "signal_after_dbm"),
        text("failure_reason", 80, "failure_reason", "drop_reason", "reason", fallback="None"),
        flag("active_call", "handover", "active_call", "call_active", "voice_call_active"),
        flag("active_data_session", "handover", "active_data_session", "data_session_active", "active_data"),
        num("device_speed_kmh", "device_speed_kmh", "speed_kmh", "user_speed_kmh"),
    ), id_prefix="HND-"),
    "dropped_calls": Layout("dropped_calls", (
        text("drop_id", 40, required=True),
        when("dropped_at", "timestamp", "timestamp", required=True),
        text("operator", 20),
        text("calling_number", 30),
        text("called_number", 30),
        text("source_tower_id", 40, "tower_id"),
        text("city", 60),
        whole("call_duration_before_drop"),
        text("drop_reason", 60),
        num("signal_strength_dbm"),
        net(),
    )),
    "mobility_traces": Layout("mobility_traces", (
        text("trace_id", 40, required=True),
        when("trace_time", "timestamp", "timestamp", required=True),
        text("customer_id", 40),
        num("lat", "latitude"),
        num("lon", "longitude"),
        text("city", 60),
        text("source_tower_id", 40, "tower_id"),
        num("movement_speed_kmh"),
        whole("direction_degrees"),
        text("user_density", 20),
        text("time_of_day", 20),
        text("day_of_week", 20),
        text("location_type", 40),
    )),
    "network_penetration": Layout("network_penetration", (
        text("city", 60, required=True),
        text("state", 60, required=True),
        text("operator", 20, required=True),
        when("month", "month", "month", required=True),
        whole("total_users"),
        whole("users_2g"),
        whole("users_3g"),
        whole("users_4g"),
        whole("users_5g"),
        num("penetration_4g_percent"),
        num("penetration_5g_percent"),
        num("growth_rate_4g_percent"),
        num("growth_rate_5g_percent"),
    )),
    "technician_logs": Layout("technician_logs", (
        text("activity_id", 40, "activity_id", "log_id", "ticket_id", "work_order_id", "id"),
        text("technician_id", 40, "technician_id", "tech_id", "field_technician_id"),
        text("source_tower_id", 40, "tower_id", "source_tower_id", "site_id"),
        text("city", 60, "city", "location_city"),
        text("operator", 20, "operator", "provider"),
        text("activity_type", 60, "activity_type", "job_type", "task_type"),
        text("priority", 20),
        text("status", 30, "status", "outcome"),
        when("started_at", "timestamp", "started_at", "start_time", "timestamp", "dispatch_time"),
        when("ended_at", "timestamp", "ended_at", "end_time", "completed_at", "completion_time"),
        whole("duration_min", "duration_min", "duration_minutes", "activity_duration_min"),
        flag("issue_resolved", "technician", "issue_resolved", "resolved", "outcome"),
        num("travel_km", "travel_km", "distance_km"),
        text("materials_used", 120, "materials_used", "parts_used", fallback="None"),
        text("notes", 1000, "notes", "description", "remarks", fallback=""),
    ), id_prefix="TECH-"),
}

# --- fixed values: positions in the headerless tower file --------------------------------------
TOWER_POSITIONS = (
    "radio", "mcc", "mnc", "lac", "cell_id", "unit", "lon", "lat",
    "range_m", "samples", "changeable", "created_at", "updated_at", "average_signal",
)
