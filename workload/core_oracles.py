"""Independent SQL for the batch queries, in DuckDB's dialect."""

from __future__ import annotations

from mastlight.plans.listings import LISTS
from workload.known_values import CITIES, COVERAGE_WEIGHTS, LIVE_WEIGHTS, RISK_CONTRIBUTORS
from workload.views import AS_OF, duck_view

NOW = f"TIMESTAMP '{AS_OF}'"
BAD = "('warning', 'critical', 'fault', 'faulty', 'degraded')"
URGENT = "('high', 'critical', 'urgent')"


def over(*views: str, steps: dict[str, str] | None = None, sql: str) -> str:
    """SQL with the views, then the steps, as common table expressions."""
    ctes = [f"{v} AS ({duck_view(v)})" for v in views]
    ctes += [f"{n} AS ({s})" for n, s in (steps or {}).items()]
    return f"WITH {', '.join(ctes)} {sql}"


def rnd(expr: str, digits: int) -> str:
    return f"CAST(ROUND(CAST({expr} AS DECIMAL(38,10)), {digits}) AS DOUBLE)"


def avg(column: str, digits: int) -> str:
    return rnd(f"AVG({column})", digits)


def total(column: str, digits: int) -> str:
    # Exact, so that the result does not depend on the order of addition.
    return rnd(f"SUM(CAST({column} AS DECIMAL(28,10)))", digits)


def listed(name: str, where: str, limit: int) -> str:
    """A list query: the condition is written out by hand, ties are broken by all columns."""
    spec = LISTS[name]
    how = {"desc_nulls_first": "DESC NULLS FIRST", "desc_nulls_last": "DESC NULLS LAST",
           "asc_nulls_last": "ASC NULLS LAST"}
    order = ", ".join(f"{c} {how[h]}" for c, h in spec.sort_columns())
    columns = ", ".join(spec.columns)
    return over(spec.table, sql=f"SELECT {columns} FROM {spec.table} WHERE {where} ORDER BY {order} LIMIT {limit}")


LIST_WHERE = {
    "towers": "operator = 'Glo' AND lat BETWEEN 4.5 AND 12.5 AND lon BETWEEN 3.5 AND 12.0",
    "qos": "operator = 'MTN' AND network = '4G' AND measured_at >= TIMESTAMP '2024-01-10' "
           "AND measured_at <= TIMESTAMP '2024-01-20 12:00:00'",
    "coverage": "city = 'CITY_3' AND network = '5G' AND lat BETWEEN 4 AND 12 AND lon BETWEEN 3 AND 12",
    "events": "event_type = 'error' AND severity = 'high' AND network = '3G' AND event_time <= TIMESTAMP '2024-01-25'",
    "hardware": "equipment_type = 'battery' AND health_status = 'Warning' AND alert_triggered = false",
    "uptime": "operator = 'Airtel' AND state = 'STATE_2' AND outage_reason = 'R' "
              "AND log_date BETWEEN DATE '2024-01-05' AND DATE '2024-01-25'",
    "energy": "power_source = 'diesel' AND usage_date >= DATE '2024-01-11'",
    "maintenance": "operator = 'Glo' AND maintenance_type = 'corrective' AND priority = 'High' AND status = 'F'",
    "latency": "operator = '9mobile' AND application_type = 'click' AND network = '5G'",
    "handovers": "(source_city = 'CITY_7' OR target_city = 'CITY_7') "
                 "AND (source_tower_id = 'T-2' OR target_tower_id = 'T-2') AND success = false",
    "dropped_calls": "operator = 'MTN' AND drop_reason = 'congestion' AND dropped_at >= TIMESTAMP '2024-01-02'",
    "mobility": "user_density = 'high' AND location_type = 'urban' AND lat BETWEEN 5 AND 13 AND lon BETWEEN 4 AND 12",
    "penetration": "operator = 'MTN' AND state = 'STATE_1' AND month BETWEEN DATE '2024-02-01' AND DATE '2024-11-30'",
    "technicians": "operator = 'Airtel' AND status = 'closed' AND activity_type = 'view'",
}
LIST_LIMIT = {"towers": 5000, "coverage": 2000}

# --- outage correlation ------------------------------------------------------------------------
NEWEST_OUTAGES = (
    "SELECT * FROM outages ORDER BY started_at DESC NULLS FIRST, id, operator, signal_type, severity LIMIT 500"
)
HALF_OPEN = "f.{ts} >= o.started_at - INTERVAL {n} HOUR AND f.{ts} < o.started_at"
DAYS = "f.{ts} BETWEEN CAST(o.started_at AS DATE) - {n} AND CAST(o.started_at AS DATE)"

# block: (table, join condition, aggregates, category column and output name)
BLOCK_SQL: dict[str, tuple[str, str, dict[str, str], tuple[str, str] | None]] = {
    "readings": ("readings", "f.operator = o.operator AND " + HALF_OPEN.format(ts="recorded_at", n=2), {
        "sample_count": "COUNT(f.recorded_at)",
        "pre_avg_signal": avg("f.signal_dbm", 1),
        "pre_avg_latency": avg("f.latency_ms", 1),
        "pre_avg_dl": avg("f.dl_mbps", 1),
    }, None),
    "events": ("network_events", "f.operator = o.operator AND " + HALF_OPEN.format(ts="event_time", n=2), {
        "pre_event_count": "COUNT(f.event_time)",
        "pre_avg_packet_loss": avg("f.packet_loss_percent", 2),
    }, ("event_type", "pre_event_types")),
    "hardware": ("hardware_sensors", HALF_OPEN.format(ts="sensor_time", n=2), {
        "pre_hardware_sample_count": "COUNT(f.sensor_time)",
        "pre_hardware_alert_count": "COUNT(CASE WHEN f.alert_triggered THEN 1 END)",
        "pre_hardware_bad_health_count": f"COUNT(CASE WHEN lower(f.health_status) IN {BAD} THEN 1 END)",
        "pre_avg_temperature_celsius": avg("f.temperature_celsius", 1),
        "pre_avg_power_draw_watts": avg("f.power_draw_watts", 1),
    }, None),
    "uptime": ("uptime_logs", "f.operator = o.operator AND " + DAYS.format(ts="log_date", n=1), {
        "uptime_log_count": "COUNT(f.log_date)",
        "avg_uptime_percentage": avg("f.uptime_percentage", 2),
        "total_downtime_minutes": total("f.downtime_minutes", 1),
        "total_synthetic_outages": "CAST(COALESCE(SUM(f.outage_count), 0) AS BIGINT)",
    }, ("outage_reason", "outage_reason_counts")),
    "energy": ("energy_consumption", DAYS.format(ts="usage_date", n=1), {
        "energy_record_count": "COUNT(f.usage_date)",
        "avg_daily_consumption_kwh": avg("f.daily_consumption_kwh", 2),
        "avg_grid_availability_hours": avg("f.grid_availability_hours", 1),
        "avg_generator_runtime_hours": avg("f.generator_runtime_hours", 1),
        "total_fuel_consumed_liters": total("f.fuel_consumed_liters", 1),
        "total_carbon_emissions_kg": total("f.carbon_emissions_kg", 1),
    }, None),
    "maintenance": ("maintenance_orders", "f.operator = o.operator AND " + DAYS.format(ts="scheduled_date", n=7), {
        "maintenance_order_count": "COUNT(f.scheduled_date)",
        "high_priority_maintenance_count": f"COUNT(CASE WHEN lower(f.priority) IN {URGENT} THEN 1 END)",
        "avg_repair_duration_hours": avg("f.repair_duration_hours", 1),
        "maintenance_downtime_minutes": total("f.downtime_minutes", 1),
    }, ("issue_category", "maintenance_issue_counts")),
    "latency": ("latency_logs", "f.operator = o.operator AND " + HALF_OPEN.format(ts="measured_at", n=2), {
        "latency_log_count": "COUNT(f.measured_at)",
        "avg_ultra_latency_ms": avg("f.latency_ms", 2),
        "avg_ultra_jitter_ms": avg("f.jitter_ms", 2),
        "avg_ultra_packet_loss_percent": avg("f.packet_loss_percent", 2),
        "latency_sla_miss_count": "COUNT(CASE WHEN NOT f.sla_met THEN 1 END)",
    }, None),
    "handover": ("handover_records", "f.operator = o.operator AND " + HALF_OPEN.format(ts="handover_time", n=2), {
        "handover_count": "COUNT(f.handover_time)",
        "handover_failure_count": "COUNT(CASE WHEN NOT f.success THEN 1 END)",
        "avg_handover_duration_ms": avg("f.duration_ms", 1),
        "avg_handover_source_signal_dbm": avg("f.source_signal_dbm", 1),
        "avg_handover_target_signal_dbm": avg("f.target_signal_dbm", 1),
    }, None),
    "dropped": ("dropped_calls", "f.operator = o.operator AND " + HALF_OPEN.format(ts="dropped_at", n=2), {
        "dropped_call_count": "COUNT(f.dropped_at)",
        "avg_dropped_call_signal_dbm": avg("f.signal_strength_dbm", 1),
    }, ("drop_reason", "dropped_call_reason_counts")),
    "technician": ("technician_logs", "f.operator = o.operator AND " + HALF_OPEN.format(ts="started_at", n=168), {
        "technician_activity_count": "COUNT(f.activity_id)",
        "unresolved_technician_activity_count": "COUNT(CASE WHEN NOT f.issue_resolved THEN 1 END)",
        "avg_technician_duration_min": avg("f.duration_min", 1),
        "total_technician_travel_km": total("f.travel_km", 1),
    }, None),
}


def block_sql(name: str, key: str = "o.id, o.operator, o.started_at") -> str:
    table, condition, aggregates, _ = BLOCK_SQL[name]
    columns = ", ".join(f"{e} AS {n}" for n, e in aggregates.items())
    return f"SELECT {key}, {columns} FROM chosen o LEFT JOIN {table} f ON {condition} GROUP BY {key}"


def _categories(name: str) -> str:
    table, condition, _, category = BLOCK_SQL[name]
    column = f"f.{category[0]}"
    return (
        f"SELECT o.id, o.operator, o.started_at, {column} AS category, COUNT(*) AS total FROM chosen o "
        f"JOIN {table} f ON {condition} WHERE {column} IS NOT NULL GROUP BY o.id, o.operator, o.started_at, {column}"
    )


def _correlation(chosen: str = NEWEST_OUTAGES) -> str:
    views, steps, columns, joins = ["outages"], {"chosen": chosen}, [], []
    for name, (table, _, aggregates, category) in BLOCK_SQL.items():
        views.append(table)
        steps[f"s_{name}"] = block_sql(name, "o.id")
        columns += [f"s_{name}.{c}" for c in aggregates]
        joins.append(f"LEFT JOIN s_{name} ON s_{name}.id = chosen.id")
        if category:
            steps[f"c_{name}"] = (
                f"SELECT id, string_agg(category || '=' || total, ';' ORDER BY category) AS texts "
                f"FROM ({_categories(name)}) GROUP BY id"
            )
            columns.append(f"COALESCE(c_{name}.texts, '') AS {category[1]}")
            joins.append(f"LEFT JOIN c_{name} ON c_{name}.id = chosen.id")
    own = "chosen.id AS outage_id, chosen.operator, chosen.signal_type, chosen.severity, chosen.started_at, " \
          "chosen.ended_at, chosen.duration_min"
    return over(*views, steps=steps, sql=f"SELECT {own}, {', '.join(columns)} FROM chosen {' '.join(joins)}")


# --- risk --------------------------------------------------------------------------------------
HOURS = 48
FOUR = "operator IN ('MTN', 'Airtel', 'Glo', '9mobile')"


def _recent(table: str, ts: str, span: str) -> str:
    return f"{table} WHERE {ts} >= (SELECT MAX({ts}) FROM {table}) - INTERVAL {span}"


def _per_operator(source: str, columns: dict[str, str]) -> str:
    picked = ", ".join(f"{e} AS {n}" for n, e in columns.items())
    return f"SELECT operator, {picked} FROM {source} AND {FOUR} GROUP BY operator"


RISK_VIEWS = ("readings", "qos_metrics", "network_events", "uptime_logs", "hardware_sensors", "energy_consumption",
              "maintenance_orders", "latency_logs", "handover_records", "dropped_calls", "technician_logs")
RISK_STEPS = {
    "i_live": _per_operator(f"readings WHERE recorded_at >= {NOW} - INTERVAL {HOURS} HOUR", {
        "live_sample_count": "COUNT(*)", "live_avg_signal": avg("signal_dbm", 1),
        "live_avg_latency": avg("latency_ms", 1), "live_avg_dl": avg("dl_mbps", 1)}),
    "i_qos": _per_operator(_recent("qos_metrics", "measured_at", f"{HOURS} HOUR"), {
        "qos_sample_count": "COUNT(*)", "qos_avg_signal": avg("signal_strength_dbm", 1),
        "qos_avg_latency": avg("latency_ms", 1), "qos_avg_packet_loss": avg("packet_loss_rate", 2),
        "qos_avg_error_rate": avg("error_rate", 2)}),
    "i_event": _per_operator(_recent("network_events", "event_time", f"{HOURS} HOUR"), {
        "event_count": "COUNT(*)", "event_avg_packet_loss": avg("packet_loss_percent", 2)}),
    "i_uptime": _per_operator(_recent("uptime_logs", "log_date", "7 DAY"), {
        "uptime_log_count": "COUNT(*)", "uptime_avg_percentage": avg("uptime_percentage", 2),
        "uptime_downtime_minutes": total("downtime_minutes", 1),
        "uptime_outage_count": "CAST(COALESCE(SUM(outage_count), 0) AS BIGINT)"}),
    "i_maintenance": _per_operator(_recent("maintenance_orders", "scheduled_date", "14 DAY"), {
        "maintenance_order_count": "COUNT(*)",
        "maintenance_high_priority_count": f"COUNT(CASE WHEN lower(priority) IN {URGENT} THEN 1 END)",
        "maintenance_downtime_minutes": total("downtime_minutes", 1)}),
    "i_latency": _per_operator(_recent("latency_logs", "measured_at", f"{HOURS} HOUR"), {
        "latency_log_count": "COUNT(*)", "latency_avg_packet_loss": avg("packet_loss_percent", 2),
        "latency_sla_miss_count": "COUNT(CASE WHEN NOT sla_met THEN 1 END)"}),
    "i_handover": _per_operator(_recent("handover_records", "handover_time", f"{HOURS} HOUR"), {
        "handover_count": "COUNT(*)", "handover_failure_count": "COUNT(CASE WHEN NOT success THEN 1 END)"}),
    "i_dropped": _per_operator(_recent("dropped_calls", "dropped_at", f"{HOURS} HOUR"), {
        "dropped_call_count": "COUNT(*)", "dropped_avg_signal": avg("signal_strength_dbm", 1)}),
    "i_technician": _per_operator(_recent("technician_logs", "started_at", "7 DAY"), {
        "technician_activity_count": "COUNT(*)",
        "technician_unresolved_count": "COUNT(CASE WHEN NOT issue_resolved THEN 1 END)"}),
    "n_hardware": "SELECT COUNT(CASE WHEN alert_triggered THEN 1 END) AS hardware_alert_count, "
                  f"COUNT(CASE WHEN lower(health_status) IN {BAD} THEN 1 END) AS hardware_bad_health_count FROM "
                  + _recent("hardware_sensors", "sensor_time", f"{HOURS} HOUR"),
    "n_energy": f"SELECT {avg('grid_availability_hours', 1)} AS energy_avg_grid_hours, "
                f"{avg('generator_runtime_hours', 1)} AS energy_avg_generator_hours FROM "
                + _recent("energy_consumption", "usage_date", "2 DAY"),
}
RISK_COUNTS = (
    "live_sample_count", "qos_sample_count", "event_count", "uptime_log_count", "maintenance_order_count",
    "latency_log_count", "handover_count", "dropped_call_count", "technician_activity_count",
)
OTHER_COUNTS = (
    "uptime_outage_count", "hardware_alert_count", "hardware_bad_health_count", "maintenance_high_priority_count",
    "latency_sla_miss_count", "handover_failure_count", "technician_unresolved_count",
)
RISK_MEASURES = (
    "live_avg_signal", "live_avg_latency", "live_avg_dl", "qos_avg_signal", "qos_avg_latency", "qos_avg_packet_loss",
    "qos_avg_error_rate", "event_avg_packet_loss", "uptime_avg_percentage", "uptime_downtime_minutes",
    "energy_avg_grid_hours", "energy_avg_generator_hours", "maintenance_downtime_minutes", "latency_avg_packet_loss",
    "dropped_avg_signal",
)


def _risk_inputs() -> str:
    counts = ", ".join(f"COALESCE({c}, 0) AS {c}" for c in (*RISK_COUNTS, *OTHER_COUNTS))
    joins = " ".join(f"LEFT JOIN {s} USING (operator)" for s in RISK_STEPS if s.startswith("i_"))
    return (
        f"SELECT operator, {counts}, {', '.join(RISK_MEASURES)} "
        "FROM (SELECT unnest(['MTN', 'Airtel', 'Glo', '9mobile']) AS operator) names "
        f"{joins} CROSS JOIN n_hardware CROSS JOIN n_energy"
    )


def _points(parts: tuple) -> str:
    terms = []
    for kind, column, start, end, points in parts:
        v = f"CAST(COALESCE({column}, 0) AS DOUBLE)"
        ratio = f"({v} - {float(start)}e0) / {float(end - start)!r}e0" if kind == "above" else (
            f"({float(start)}e0 - {v}) / {float(start - end)!r}e0"
        )
        terms.append(f"least(1e0, greatest(0e0, {ratio})) * {float(points)}e0")
    return " + ".join(terms)


def _contributors() -> str:
    """One row per operator and contributor that has points."""
    selects = []
    for place, (label, source, parts, column, suffix, blank) in enumerate(RISK_CONTRIBUTORS):
        if blank:
            shown = f"CAST(CAST({column} AS DECIMAL(30,1)) AS VARCHAR)"
        else:
            shown = f"CAST(COALESCE({column}, 0) AS VARCHAR)"
        selects.append(
            f"SELECT operator, {place} AS rank, '{label}' AS label, '{source}' AS source, "
            f"CASE WHEN {column} IS NULL AND {str(blank).lower()} THEN NULL ELSE {shown} || '{suffix}' END AS evidence, "
            f"{_points(parts)} AS raw FROM inputs"
        )
    return (
        "SELECT operator, rank, label, source, evidence, floor(raw * 10 + 5e-1) / 10 AS points "
        f"FROM ({' UNION ALL '.join(selects)}) every WHERE raw > 0"
    )


RISK_SCORED = (
    "SELECT i.*, floor(least(1e2, COALESCE(s.points, 0)) * 10 + 5e-1) / 10 AS score, "
    f"CAST({' + '.join(RISK_COUNTS)} AS BIGINT) AS evidence_count FROM inputs i "
    "LEFT JOIN (SELECT operator, SUM(points ORDER BY rank) AS points FROM contributors GROUP BY operator) s USING (operator)"
)
BAND = "CASE WHEN score >= 70 THEN 'critical' WHEN score >= 45 THEN 'high' WHEN score >= 25 THEN 'medium' ELSE 'low' END"


def _risk(sql: str, scored: bool = True) -> str:
    steps = {**RISK_STEPS, "inputs": _risk_inputs()}
    if scored:
        steps |= {"contributors": _contributors(), "scored": RISK_SCORED}
    return over(*RISK_VIEWS, steps=steps, sql=sql)


# --- recommendations ---------------------------------------------------------------------------
def _km(lat1: str, lon1: str, lat2: str, lon2: str) -> str:
    return (
        f"6371 * acos(least(1e0, greatest(-1e0, cos(radians({lat1})) * cos(radians({lat2})) * "
        f"cos(radians({lon2}) - radians({lon1})) + sin(radians({lat1})) * sin(radians({lat2})))))"
    )


def _score(weights: dict[str, float]) -> str:
    parts = {
        "signal": "greatest(0e0, least(1e2, (COALESCE(avg_signal, 0) + 110) / 60 * 100))",
        "latency": "greatest(0e0, least(1e2, 100 - COALESCE(avg_latency, 0) / 200 * 100))",
        "download": "greatest(0e0, least(1e2, COALESCE(avg_dl, 0) / 50 * 100))",
        "freshness": "CASE WHEN max_age_sec <= 3600 THEN 1e2 WHEN max_age_sec <= 21600 THEN 75e0 ELSE 50e0 END",
        "samples": "greatest(20e0, least(1e2, CAST(sample_count AS DOUBLE) / 80 * 100))",
    }
    total_score = " + ".join(f"({parts[n]}) * {w}e0" for n, w in weights.items())
    return f"floor(({total_score}) * 10 + 5e-1) / 10"


def _ranked(source: str, weights: dict[str, float], confidence: str, label: str) -> str:
    return (
        f"SELECT dest_id, CAST(row_number() OVER (PARTITION BY dest_id ORDER BY score DESC, sample_count DESC, operator) AS INTEGER) AS place, "
        f"operator, score, sample_count, COALESCE(avg_signal, 0) AS avg_signal, COALESCE(avg_latency, 0) AS avg_latency, "
        f"COALESCE(avg_dl, 0) AS avg_dl, COALESCE(avg_ul, 0) AS avg_ul, nearest_km, '{label}' AS source, "
        f"{confidence} AS confidence FROM (SELECT *, {_score(weights)} AS score FROM {source}) scored"
    )


def _recommend(places: str, hours: int, sql: str) -> str:
    """``places`` selects dest_id, lat, lon, radius_km."""
    samples = "SUM(sample_count) OVER (PARTITION BY dest_id)"
    steps = {
        "places": places,
        "near_towers": f"SELECT p.dest_id, t.id, {_km('p.lat', 'p.lon', 't.lat', 't.lon')} AS km, p.radius_km "
                       "FROM places p CROSS JOIN towers t",
        "live": "SELECT n.dest_id, r.operator, COUNT(*) AS sample_count, "
                f"{avg('r.signal_dbm', 1)} AS avg_signal, {avg('r.latency_ms', 0)} AS avg_latency, "
                f"{avg('r.dl_mbps', 1)} AS avg_dl, {avg('r.ul_mbps', 1)} AS avg_ul, {rnd('MIN(n.km)', 2)} AS nearest_km, "
                f"{rnd(f'(epoch_us({NOW}) - epoch_us(MIN(r.recorded_at))) / 1e6', 0)} AS max_age_sec "
                "FROM near_towers n JOIN readings r ON r.tower_id = n.id "
                f"WHERE n.km <= n.radius_km AND r.recorded_at > {NOW} - INTERVAL {hours} HOUR GROUP BY n.dest_id, r.operator",
        "covered": f"SELECT p.dest_id, c.*, {_km('p.lat', 'p.lon', 'c.lat', 'c.lon')} AS km, p.radius_km FROM places p "
                   "CROSS JOIN coverage_data c WHERE p.dest_id NOT IN (SELECT dest_id FROM live)",
        "coverage": "SELECT dest_id, operator, COUNT(*) AS sample_count, "
                    f"{avg('signal_strength_dbm', 1)} AS avg_signal, {avg('latency_ms', 0)} AS avg_latency, "
                    f"{avg('download_speed_mbps', 1)} AS avg_dl, {avg('upload_speed_mbps', 1)} AS avg_ul, "
                    f"{rnd('MIN(km)', 2)} AS nearest_km FROM covered WHERE km <= radius_km GROUP BY dest_id, operator",
        "providers": _ranked("live", LIVE_WEIGHTS,
                             f"CASE WHEN {samples} >= 120 THEN 'high' WHEN {samples} >= 40 THEN 'medium' ELSE 'low' END",
                             "live_readings")
                     + " UNION ALL " + _ranked("coverage", COVERAGE_WEIGHTS, "'medium'", "synthetic_coverage"),
    }
    return over("destinations", "towers", "readings", "coverage_data", steps=steps, sql=sql)


def _one_place(lat: float, lon: float) -> str:
    return f"SELECT 0 AS dest_id, {lat}e0 AS lat, {lon}e0 AS lon, 5e1 AS radius_km"


ALL_PLACES = "SELECT dest_id, lat, lon, radius_km FROM destinations"
PROVIDERS = "SELECT * FROM providers"
ONE_PROVIDERS = "SELECT * EXCLUDE (dest_id) FROM providers"


# --- everything --------------------------------------------------------------------------------
def _levels(table: str, where: str, columns: str, cities: int, order: str) -> str:
    parts = []
    for level in ("operator", "network", "city"):
        sql = f"SELECT '{level}' AS level, {level} AS key, {columns} FROM {table} WHERE {where} GROUP BY {level}"
        if level == "city":
            sql = f"SELECT * FROM ({sql}) c ORDER BY {order}, key LIMIT {cities}"
        parts.append(f"SELECT * FROM ({sql}) l_{level}")
    parts.append(f"SELECT 'total' AS level, CAST(NULL AS VARCHAR) AS key, {columns} FROM {table} WHERE {where}")
    return over(table, sql=" UNION ALL ".join(parts))


def _nearest_city() -> str:
    rows = ", ".join(f"({i}, '{n}', {la}e0, {lo}e0)" for i, (n, la, lo) in enumerate(CITIES))
    return over(
        "coverage_data",
        steps={"cities": f"SELECT * FROM (VALUES {rows}) v(place, name, clat, clon)"},
        sql="SELECT measurement_id, name AS nearest FROM coverage_data CROSS JOIN cities "
            "QUALIFY row_number() OVER (PARTITION BY measurement_id ORDER BY (clat - lat) * (clat - lat) + "
            "(clon - lon) * (clon - lon), place) = 1",
    )


def _history(where: str) -> str:
    return over("readings", sql=(
        "SELECT operator, network, city, date_trunc('minute', recorded_at) AS bucket, "
        f"{avg('signal_dbm', 6)} AS avg_signal, {avg('latency_ms', 6)} AS avg_latency, "
        f"{avg('dl_mbps', 6)} AS avg_dl, {avg('ul_mbps', 6)} AS avg_ul, COUNT(*) AS count "
        f"FROM readings WHERE {where} GROUP BY operator, network, city, bucket"
    ))


def core_oracles() -> dict[str, str]:
    out = {
        "towers_health_count": over("towers", sql="SELECT COUNT(*) AS towers_in_db FROM towers"),
        "towers_stats": _levels("towers", "true", "COUNT(*) AS count", 20, "count DESC"),
        "towers_stats_by_city": over("towers", sql="SELECT city, COUNT(*) AS count FROM towers GROUP BY city "
                                                   "ORDER BY count DESC, city LIMIT 20"),
        "best_tower_per_cell": over("towers", sql="SELECT DISTINCT ON (cell_id) id, cell_id FROM towers "
                                                  "ORDER BY cell_id, samples DESC, id"),
        "nearest_city": _nearest_city(),
        "readings_summary": _levels(
            "readings", f"recorded_at > {NOW} - INTERVAL 48 HOUR",
            f"COUNT(*) AS readings, {avg('signal_dbm', 1)} AS avg_signal, {avg('latency_ms', 0)} AS avg_latency, "
            f"{avg('dl_mbps', 1)} AS avg_dl", 14, "avg_signal DESC NULLS FIRST"),
        "readings_summary_by_operator": over("readings", sql=(
            f"SELECT operator, {avg('signal_dbm', 1)} AS avg_signal, {avg('dl_mbps', 1)} AS avg_dl, "
            f"{avg('latency_ms', 0)} AS avg_latency, COUNT(*) AS readings FROM readings "
            f"WHERE recorded_at > {NOW} - INTERVAL 48 HOUR GROUP BY operator")),
        "readings_latest": over("readings", steps={
            "keyed": "SELECT *, COALESCE(CAST(tower_id AS BIGINT), -cell_id, -id) AS entity FROM readings"},
            sql="SELECT tower_id, cell_id, city, operator, network, signal_dbm, latency_ms, dl_mbps, ul_mbps, rsrp, rsrq, "
                "recorded_at FROM (SELECT DISTINCT ON (entity) * FROM keyed ORDER BY entity, recorded_at DESC, id DESC) d "
                "ORDER BY entity LIMIT 20000"),
        "readings_resolve_tower": over("readings", "towers", steps={
            "best": "SELECT cell_id, arg_max(id, samples * 100000 - id) AS found FROM towers GROUP BY cell_id"},
            sql="SELECT r.id, CASE WHEN COALESCE(r.tower_id, 0) = 0 AND COALESCE(r.cell_id, 0) <> 0 THEN b.found "
                "ELSE r.tower_id END AS tower_id, r.cell_id, r.operator, r.recorded_at "
                "FROM readings r LEFT JOIN best b ON b.cell_id = r.cell_id"),
        "readings_history_minute": _history(f"recorded_at > {NOW} - INTERVAL 720 HOUR"),
        "readings_history_filtered": _history(
            f"recorded_at > {NOW} - INTERVAL 400 HOUR AND city = 'CITY_4' AND operator = 'MTN'"),
        "speedtests_latest": over("speed_tests", sql="SELECT * FROM speed_tests ORDER BY tested_at DESC, id LIMIT 50"),
        "outages_list": over("outages", sql=(
            f"SELECT * FROM outages WHERE started_at >= {NOW} - INTERVAL 7 DAY AND started_at <= {NOW} "
            "AND operator = 'MTN' AND severity >= 20 ORDER BY started_at DESC, id LIMIT 500")),
        "outages_list_range": over("outages", sql=(
            "SELECT * FROM outages WHERE started_at BETWEEN TIMESTAMP '2024-01-06' AND TIMESTAMP '2024-01-16' "
            "ORDER BY started_at DESC, id LIMIT 500")),
        "outages_stats": over("outages", sql=(
            f"SELECT operator, COUNT(*) AS total_outages, {avg('severity', 1)} AS avg_severity, "
            f"{avg('duration_min', 1)} AS avg_duration_min, MAX(started_at) AS most_recent_outage "
            "FROM outages GROUP BY operator")),
        "outages_last_30_days": over("outages", sql=(
            f"SELECT COUNT(*) AS total_outages_30d FROM outages WHERE started_at > {NOW} - INTERVAL 30 DAY")),
        "outages_correlate": _correlation(),
        "outages_correlate_all": _correlation("SELECT * FROM outages"),
        "risk_inputs": _risk("SELECT * FROM inputs", scored=False),
        "outage_risk": _risk(
            f"SELECT operator, score, {BAND} AS band, CASE WHEN evidence_count >= 300 THEN 'high' "
            "WHEN evidence_count >= 60 THEN 'medium' ELSE 'low' END AS confidence, evidence_count, "
            "live_sample_count AS sample_count, live_avg_signal AS avg_signal, live_avg_latency AS avg_latency, "
            "live_avg_dl AS avg_dl, qos_sample_count AS qos_samples, event_count AS network_events, "
            "uptime_outage_count AS uptime_outages, hardware_alert_count AS hardware_alerts, "
            "maintenance_order_count AS maintenance_orders, latency_sla_miss_count AS latency_sla_misses, "
            "handover_failure_count AS handover_failures, dropped_call_count AS dropped_calls, "
            "technician_unresolved_count AS unresolved_technician_jobs, 'baseline_weighted_v1' AS model FROM scored"),
        "outage_risk_highest": _risk(f"SELECT operator, score, {BAND} AS band FROM scored ORDER BY score DESC, operator LIMIT 1"),
        "risk_contributors": _risk(
            "SELECT operator, CAST(row_number() OVER w - 1 AS INTEGER) AS place, label, points, evidence, source "
            "FROM contributors WINDOW w AS (PARTITION BY operator ORDER BY points DESC, rank) QUALIFY row_number() OVER w <= 6"),
        "recommend_live": _recommend(_one_place(9.0, 8.0), 168, ONE_PROVIDERS),
        "recommend_coverage": _recommend(_one_place(13.9, 3.1), 1, ONE_PROVIDERS),
        "recommend_destinations": _recommend(ALL_PLACES, 48, PROVIDERS),
        "recommend_destinations_summary": _recommend(ALL_PLACES, 48, (
            "SELECT d.dest_id, COALESCE(p.confidence, 'low') AS confidence, p.operator AS best_provider, "
            "p.score AS best_score, p.source, CASE WHEN p.source = 'synthetic_coverage' THEN 'Based on synthetic "
            "coverage: no recent live reading lies nearby.' WHEN p.source IS NULL THEN "
            "'Neither a recent reading nor a coverage sample lies nearby.' END AS note "
            "FROM destinations d LEFT JOIN (SELECT * FROM providers WHERE place = 1) p USING (dest_id)")),
    }
    for name in LISTS:
        out[f"{name}_list"] = listed(name, "true", LIST_LIMIT.get(name, 1000))
        out[f"{name}_list_filtered"] = listed(name, LIST_WHERE[name], LIST_LIMIT.get(name, 1000))
    out["towers_list_all"] = listed("towers", "true", 10**9)
    out["towers_list_top"] = listed("towers", "true", 7)
    out["penetration_list_top"] = listed("penetration", "operator = 'MTN'", 5)
    out["hardware_list_cut_filter"] = listed("hardware", "equipment_type = 'battery'", 1000).replace(
        "SELECT " + ", ".join(LISTS["hardware"].columns), "SELECT " + ", ".join(
            "rpad(equipment_type, 40, '-') AS equipment_type" if c == "equipment_type" else c for c in LISTS["hardware"].columns))
    out["readings_latest_all"] = out["readings_latest"].replace(" LIMIT 20000", "")
    out["readings_latest_first"] = out["readings_latest"].replace(" LIMIT 20000", " LIMIT 25")
    breakdowns = {
        "towers": ("operator, network", ""), "qos_metrics": ("operator, network", ""),
        "coverage_data": ("operator, network", ""), "network_events": ("operator, event_type", ""),
        "hardware_sensors": ("equipment_type, health_status", ""), "uptime_logs": ("outage_reason", ""),
        "energy_consumption": ("power_source", f", {avg('daily_consumption_kwh', 2)} AS avg_kwh"),
        "maintenance_orders": ("maintenance_type, status", ""),
        "latency_logs": ("operator, network", f", {avg('latency_ms', 2)} AS avg_latency_ms"),
        "handover_records": ("operator, network, success", ""),
    }
    for table, (keys, more) in breakdowns.items():
        out[f"load_breakdown_{table}"] = over(
            table, sql=f"SELECT {keys}, COUNT(*) AS rows{more} FROM {table} GROUP BY {keys}")
    for name, (table, _, _, category) in BLOCK_SQL.items():
        for suffix, chosen in (("", NEWEST_OUTAGES), ("_all_outages", "SELECT * FROM outages")):
            out[f"correlate_{name}{suffix}"] = over("outages", table, steps={"chosen": chosen}, sql=block_sql(name))
            if category:
                out[f"correlate_{name}_categories{suffix}"] = over("outages", table, steps={"chosen": chosen}, sql=_categories(name))
    return out
