"""Word lists, lookup tables and constants that results depend on.

Everything here is data.  The rules that use it live in the other modules.
"""

# --- fixed values: operators and radio generations -----------------------------------------
MNC_OPERATORS = {30: "MTN", 20: "Airtel", 50: "Glo", 60: "9mobile"}
RADIO_NETWORKS = {"GSM": "2G", "UMTS": "3G", "LTE": "4G", "NR": "5G"}
NETWORK_SYNONYMS = {
    "5G": ("NR", "5G"),
    "4G": ("LTE", "4G"),
    "3G": ("UMTS", "HSPA", "3G"),
    "2G": ("GSM", "EDGE", "2G"),
}
RISK_OPERATORS = ("MTN", "Airtel", "Glo", "9mobile")

# --- fixed values: entities of the outage feed (operator, entity type, entity code) ---------
FEED_SOURCE = "IODA"
FEED_ENTITIES = (
    ("MTN", "asn", "29465"),
    ("Airtel", "asn", "36873"),
    ("Glo", "asn", "37148"),
    ("9mobile", "asn", "37076"),
    ("Nigeria", "country", "NG"),
)

# --- fixed values: city centres (name, latitude, longitude) ---------------------------------
CITIES = (
    ("Lagos", 6.5244, 3.3792),
    ("Abuja", 9.0765, 7.3986),
    ("Kano", 12.0022, 8.5920),
    ("Port Harcourt", 4.8156, 7.0498),
    ("Ibadan", 7.3775, 3.9470),
    ("Kaduna", 10.5222, 7.4383),
    ("Enugu", 6.4584, 7.5464),
    ("Benin City", 6.3350, 5.6037),
    ("Maiduguri", 11.8333, 13.1500),
    ("Jos", 9.8965, 8.8583),
    ("Warri", 5.5167, 5.7500),
    ("Aba", 5.1066, 7.3667),
    ("Ilorin", 8.4966, 4.5420),
    ("Uyo", 5.0481, 7.9237),
    ("Zaria", 11.0667, 7.7000),
    ("Sokoto", 13.0622, 5.2339),
    ("Onitsha", 6.1667, 6.7833),
    ("Calabar", 4.9500, 8.3250),
    ("Akure", 7.2500, 5.1950),
    ("Abeokuta", 7.1558, 3.3450),
)
EARTH_RADIUS_KM = 6371

# --- fixed values: words read as booleans, per kind of column (true words, false words) ------
BOOLEAN_WORDS = {
    "plain": (("true", "yes", "y", "1"), ("false", "no", "n", "0")),
    "sla": (
        ("true", "yes", "y", "1", "met", "pass", "passed"),
        ("false", "no", "n", "0", "missed", "fail", "failed"),
    ),
    "handover": (
        ("true", "yes", "y", "1", "success", "successful", "completed"),
        ("false", "no", "n", "0", "failure", "failed", "dropped"),
    ),
    "technician": (
        ("true", "yes", "y", "1", "resolved", "completed", "success"),
        ("false", "no", "n", "0", "unresolved", "failed"),
    ),
}
BAD_HEALTH = ("warning", "critical", "fault", "faulty", "degraded")
HIGH_PRIORITY = ("high", "critical", "urgent")

# --- fixed values: limits applied to a device reading ----------------------------------------
READING_RANGES = {
    "signal_dbm": (-140, -20),
    "latency_ms": (0, 5000),
    "dl_mbps": (0, 10000),
    "ul_mbps": (0, 10000),
    "rsrp": (-160, -20),
    "rsrq": (-40, 5),
}
MAX_BULK_READINGS = 1000

# --- fixed values: risk model -----------------------------------------------------------------
RISK_MODEL = "baseline_weighted_v1"
RISK_BANDS = ((70, "critical"), (45, "high"), (25, "medium"))
RISK_CONFIDENCE = ((300, "high"), (60, "medium"))
TOP_CONTRIBUTORS = 6
# label, source, parts, evidence column, evidence suffix, whether a missing value gives no evidence.
# A part is (kind, input column, from, to, points): "above" earns points as the value rises from
# `from` to `to`, "below" as it falls from `from` to `to`.
RISK_CONTRIBUTORS = (
    ("Weak recent signal", "live_readings",
     (("below", "live_avg_signal", -85, -110, 18),),
     "live_avg_signal", " dBm", True),
    ("High live latency", "live_readings",
     (("above", "live_avg_latency", 80, 260, 12),),
     "live_avg_latency", " ms", True),
    ("Low live download speed", "live_readings",
     (("below", "live_avg_dl", 12, 3, 8),),
     "live_avg_dl", " Mbps", True),
    ("Synthetic QoS degradation", "synthetic_training",
     (("below", "qos_avg_signal", -88, -112, 10),
      ("above", "qos_avg_latency", 90, 260, 6),
      ("above", "qos_avg_packet_loss", 1, 8, 6),
      ("above", "qos_avg_error_rate", 0.5, 5, 4)),
     "qos_sample_count", " QoS samples", False),
    ("Network event spike", "synthetic_training",
     (("above", "event_count", 50, 1500, 12),
      ("above", "event_avg_packet_loss", 1, 10, 5)),
     "event_count", " events", False),
    ("Uptime outage labels", "synthetic_training",
     (("above", "uptime_downtime_minutes", 10, 240, 10),
      ("above", "uptime_outage_count", 1000, 20000, 8),
      ("below", "uptime_avg_percentage", 99.2, 95, 8)),
     "uptime_outage_count", " synthetic outages", False),
    ("Infrastructure hardware alerts", "synthetic_training",
     (("above", "hardware_alert_count", 20, 500, 7),
      ("above", "hardware_bad_health_count", 20, 500, 7)),
     "hardware_alert_count", " alerts", False),
    ("Energy pressure", "synthetic_training",
     (("below", "energy_avg_grid_hours", 18, 6, 5),
      ("above", "energy_avg_generator_hours", 3, 16, 5)),
     "energy_avg_grid_hours", "h grid avg", True),
    ("Maintenance backlog", "synthetic_training",
     (("above", "maintenance_high_priority_count", 1, 12, 8),
      ("above", "maintenance_downtime_minutes", 30, 360, 7)),
     "maintenance_high_priority_count", " high-priority orders", False),
    ("Latency SLA misses", "synthetic_training",
     (("above", "latency_sla_miss_count", 2, 30, 8),
      ("above", "latency_avg_packet_loss", 1, 8, 5)),
     "latency_sla_miss_count", " SLA misses", False),
    ("Handover failures", "synthetic_training",
     (("above", "handover_failure_count", 2, 35, 8),),
     "handover_failure_count", " failures", False),
    ("Dropped-call spike", "synthetic_training",
     (("above", "dropped_call_count", 20, 500, 10),
      ("below", "dropped_avg_signal", -88, -112, 5)),
     "dropped_call_count", " dropped calls", False),
    ("Unresolved technician activity", "synthetic_training",
     (("above", "technician_unresolved_count", 1, 15, 8),),
     "technician_unresolved_count", " unresolved jobs", False),
)

# --- fixed values: provider recommendation ----------------------------------------------------
# weights of the sub-scores per kind of evidence
LIVE_WEIGHTS = {"signal": 0.4, "latency": 0.25, "download": 0.2, "freshness": 0.1, "samples": 0.05}
COVERAGE_WEIGHTS = {"signal": 0.45, "latency": 0.2, "download": 0.25, "samples": 0.1}
FRESHNESS_TIERS = ((3600, 100), (21600, 75))
STALE_FRESHNESS = 50
RECOMMENDATION_CONFIDENCE = ((120, "high"), (40, "medium"))
