"""Batch queries over the derived views."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mastlight.functions.geo import nearest_city
from mastlight.functions.numeric import rounded
from mastlight.operators.latest import best_tower_per_cell, latest_readings
from mastlight.plans import correlate, listings, recommend, risk, summaries
from mastlight.session import pinned
from mastlight.sources.readings import resolve_towers
from workload.views import AS_OF, Tables

Query = Callable[[SparkSession, str], DataFrame]

#: Filters of the second run of each list query.
LIST_FILTERS: dict[str, dict[str, object]] = {
    "towers": {"operator": "Glo", "network": "all", "bbox": "4.5,3.5,12.5,12.0", "limit": "5000"},
    "qos": {"operator": "MTN", "network": "lte", "from": "2024-01-10", "until": "2024-01-20T12:00:00Z", "limit": "1000"},
    "coverage": {"city": "CITY_3", "network": "5G", "bbox": "4,3,12,12", "limit": 2000},
    "events": {"type": "error", "severity": "high", "network": "umts", "until": "2024-01-25", "limit": 1000},
    "hardware": {"equipment_type": "battery", "health_status": "Warning", "alert": "false", "limit": 1000},
    "uptime": {"operator": "Airtel", "state": "STATE_2", "reason": "R", "from": "2024-01-05", "until": "2024-01-25", "limit": 1000},
    "energy": {"power_source": "diesel", "from": "2024-01-11", "limit": 1000},
    "maintenance": {"operator": "Glo", "type": "corrective", "priority": "High", "status": "F", "limit": 1000},
    "latency": {"operator": "9mobile", "application_type": "click", "network": "nr", "limit": 1000},
    "handovers": {"city": "CITY_7", "tower_id": "T-2", "success": "false", "limit": 1000},
    "dropped_calls": {"operator": "MTN", "reason": "congestion", "from": "2024-01-02", "limit": 1000},
    "mobility": {"density": "high", "location_type": "urban", "bbox": "5,4,13,12", "limit": 1000},
    "penetration": {"operator": "MTN", "state": "STATE_1", "from": "2024-02-01", "until": "2024-11-30", "limit": 1000},
    "technicians": {"operator": "Airtel", "status": "closed", "type": "view", "limit": 1000},
}
#: Characters of the filter on equipment types that count.
PADDED = 40
#: Several filters above leave few rows; these variants keep one filter each.
LIST_NEWEST_LIMIT = {"towers": 5000, "coverage": 2000}


def _list_query(name: str, params: dict[str, object]) -> Query:
    spec = listings.LISTS[name]

    def run(spark: SparkSession, folder: str) -> DataFrame:
        return listings.listing(Tables(spark, folder)[spec.table], spec, params)

    return run


def _padded_list(spark: SparkSession, folder: str) -> DataFrame:
    """Types as long as the filter's cut: a longer filter finds them."""
    spec = listings.LISTS["hardware"]
    table = Tables(spark, folder)[spec.table].withColumn("equipment_type", F.rpad("equipment_type", PADDED, "-"))
    return listings.listing(table, spec, {"equipment_type": "battery".ljust(PADDED, "-") + " and more", "limit": 1000})


def _flat_correlation(df: DataFrame) -> DataFrame:
    """Maps as sorted ``name=count`` text, so that they compare across engines."""
    maps = [b.map_name for b in correlate.BLOCKS.values() if b.map_name]
    return df.withColumns(
        {
            m: F.array_join(
                F.transform(
                    F.map_entries(m), lambda e: F.concat(e["key"], F.lit("="), e["value"].cast("string"))
                ),
                ";",
            )
            for m in maps
        }
    )


def _with_outages(build: Callable[[Tables, DataFrame], DataFrame], limit: int | None) -> Query:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        tables = Tables(spark, folder)
        chosen = correlate.newest_outages(tables["outages"], limit)
        return build(tables, chosen if limit is None else pinned(chosen))

    return run


def _block_query(name: str, limit: int | None = 500) -> Query:
    def build(tables: Tables, outages: DataFrame) -> DataFrame:
        facts = tables[correlate.BLOCKS[name].table]
        out = correlate.block_stats(name, outages, facts, bounded=limit is not None)
        return out.drop("signal_type", "severity", "ended_at", "duration_min")

    return _with_outages(build, limit)


def _category_query(name: str, limit: int | None = 500) -> Query:
    def build(tables: Tables, outages: DataFrame) -> DataFrame:
        facts = tables[correlate.BLOCKS[name].table]
        out = correlate.block_categories(name, outages, facts, bounded=limit is not None)
        return out.select("id", "operator", "started_at", "category", "total")

    return _with_outages(build, limit)


def _history(spark: SparkSession, folder: str, **params: object) -> DataFrame:
    out = summaries.readings_history(Tables(spark, folder)["readings"], AS_OF, **params)
    # Plain averages differ in their last bits with the order of addition.
    return out.withColumns({c: rounded(F.col(c), 6) for c in ("avg_signal", "avg_latency", "avg_dl", "avg_ul")})


def _risks(spark: SparkSession, folder: str, hours: int = 48) -> DataFrame:
    return risk.outage_risk(Tables(spark, folder), AS_OF, hours)


def _risk_rows(spark: SparkSession, folder: str) -> DataFrame:
    return _risks(spark, folder).select(
        "operator", "score", "band", "confidence", "evidence_count", "live.*", "synthetic.*", "model"
    )


def _risk_inputs(spark: SparkSession, folder: str) -> DataFrame:
    out = risk.risk_inputs(Tables(spark, folder), AS_OF, 48)
    decimals = [c for c, t in out.dtypes if t.startswith("decimal")]
    return out.withColumns({c: F.col(c).cast("double") for c in decimals})


def _destinations(spark: SparkSession, folder: str) -> DataFrame:
    return Tables(spark, folder)["destinations"]


def _recommend_many(spark: SparkSession, folder: str) -> DataFrame:
    tables = Tables(spark, folder)
    return recommend.recommend_for(tables["destinations"], tables, AS_OF, 48)


def _recommend_summary(spark: SparkSession, folder: str) -> DataFrame:
    tables = Tables(spark, folder)
    providers = recommend.recommend_for(tables["destinations"], tables, AS_OF, 48)
    return recommend.summarise_destinations(tables["destinations"].select("dest_id"), providers)


def core_queries() -> dict[str, Query]:
    out: dict[str, Query] = {}

    def add(name: str, build: Callable[[Tables], DataFrame]) -> None:
        out[name] = lambda spark, folder: build(Tables(spark, folder))

    add("towers_health_count", lambda t: summaries.tower_count(t["towers"]))
    add("towers_stats", lambda t: summaries.tower_stats_rows(t["towers"]))
    add("towers_stats_by_city", lambda t: summaries.tower_stats(t["towers"])["by_city"])
    add("best_tower_per_cell", lambda t: best_tower_per_cell(t["towers"]))
    add("nearest_city", lambda t: t["coverage_data"].select(
        "measurement_id", nearest_city(F.col("lat"), F.col("lon")).alias("nearest")))
    add("readings_summary", lambda t: summaries.readings_summary(t["readings"], AS_OF, 48))
    add("readings_summary_by_operator", lambda t: summaries.readings_by_operator(t["readings"], AS_OF, 48))
    add("readings_latest", lambda t: latest_readings(t["readings"], 20000))
    add("readings_resolve_tower", lambda t: resolve_towers(t["readings"], t["towers"]).select(
        "id", "tower_id", "cell_id", "operator", "recorded_at"))
    out["readings_history_minute"] = lambda s, d: _history(s, d, hours=720)
    out["readings_history_filtered"] = lambda s, d: _history(s, d, hours=400, city="CITY_4", operator="MTN")
    for name in listings.LISTS:
        newest = {"limit": LIST_NEWEST_LIMIT.get(name, 1000)}
        out[f"{name}_list"] = _list_query(name, newest)
        out[f"{name}_list_filtered"] = _list_query(name, LIST_FILTERS[name])
    out["towers_list_all"] = _list_query("towers", {"limit": None})
    out["towers_list_top"] = _list_query("towers", {"limit": "7"})
    out["penetration_list_top"] = _list_query("penetration", {"operator": "MTN", "limit": 5})
    out["hardware_list_cut_filter"] = _padded_list
    add("readings_latest_all", lambda t: latest_readings(t["readings"], None))
    add("readings_latest_first", lambda t: latest_readings(t["readings"], 25))
    add("speedtests_latest", lambda t: listings.latest_speed_tests(t["speed_tests"]))
    add("outages_list", lambda t: listings.list_outages(
        t["outages"], AS_OF, operator="MTN", min_severity="20", limit=500))
    add("outages_list_range", lambda t: listings.list_outages(
        t["outages"], AS_OF, from_=1704499200, until=1705363200, limit=500))
    add("outages_stats", lambda t: summaries.outage_stats(t["outages"]))
    add("outages_last_30_days", lambda t: summaries.outages_last_30_days(t["outages"], AS_OF))
    for table in summaries.BREAKDOWNS:
        add(f"load_breakdown_{table}", lambda t, table=table: summaries.load_breakdown(table, t[table]))
    for name, block in correlate.BLOCKS.items():
        for suffix, limit in (("", 500), ("_all_outages", None)):
            out[f"correlate_{name}{suffix}"] = _block_query(name, limit)
            if block.category:
                out[f"correlate_{name}_categories{suffix}"] = _category_query(name, limit)
    add("outages_correlate", lambda t: _flat_correlation(correlate.correlate_outages(t, 500)))
    add("outages_correlate_all", lambda t: _flat_correlation(correlate.correlate_outages(t, None)))
    out["risk_inputs"] = _risk_inputs
    out["outage_risk"] = _risk_rows
    out["outage_risk_highest"] = lambda s, d: risk.highest_risk(_risks(s, d)).select("operator", "score", "band")
    out["risk_contributors"] = lambda s, d: risk.risk_contributors(_risks(s, d))
    add("recommend_live", lambda t: recommend.recommend(t, 9.0, 8.0, AS_OF, radius_km=50, hours=168))
    add("recommend_coverage", lambda t: recommend.recommend(
        {**t, "readings": t["readings"], "towers": t["towers"], "coverage_data": t["coverage_data"]},
        13.9, 3.1, AS_OF, radius_km=50, hours=1))
    out["recommend_destinations"] = _recommend_many
    out["recommend_destinations_summary"] = _recommend_summary
    return out
