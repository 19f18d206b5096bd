"""Load jobs: raw files derived from the views are written, loaded twice and read back."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mastlight.plans.listings import latest_speed_tests
from mastlight.schemas import TABLES
from mastlight.session import new_work_folder
from mastlight.sources import feed, loaders
from mastlight.sources.layouts import LAYOUTS
from mastlight.sources.readings import bulk_readings, bulk_refusals, device_readings, resolve_towers
from mastlight.sources.store import TableStore
from workload import raw_files
from workload.core_oracles import NOW
from workload.known_values import CITIES
from workload.views import AS_OF, Tables, duck_view

Query = Callable[[SparkSession, str], DataFrame]
READING_TYPES = "k, tower_id, cell_id, city, operator, network, signal_dbm, latency_ms, dl_mbps, ul_mbps, rsrp, rsrq, recorded_at"


def _store(spark: SparkSession) -> TableStore:
    return TableStore(spark, new_work_folder(spark, "store"))


def _load_twice(table: str) -> Query:
    """The table after loading the same files twice (the second load must add nothing)."""

    def run(spark: SparkSession, folder: str) -> DataFrame:
        store = _store(spark)
        path = raw_files.write_raw_csv(Tables(spark, folder), table)
        loaders.load_dataset(store, table, path)
        loaders.load_dataset(store, table, path)
        return store.read(table).select(*TABLES[table].columns)

    return run


def _load_towers(spark: SparkSession, folder: str) -> DataFrame:
    store = _store(spark)
    path = raw_files.write_raw_towers(Tables(spark, folder))
    loaders.load_towers(store, path)
    if loaders.load_towers(store, path) is not None:
        raise AssertionError("a second load must be skipped")
    loaders.load_towers(store, path, force=True)
    return store.read("towers").select(*TABLES["towers"].columns)


def _load_reports(spark: SparkSession, folder: str) -> DataFrame:
    """Counts of a first and a second load of one dataset."""
    store = _store(spark)
    path = raw_files.write_raw_csv(Tables(spark, folder), "uptime_logs")
    reports = [loaders.load_dataset(store, "uptime_logs", path) for _ in range(2)]
    rows = [(n, r.parsed, r.sent, r.skipped, r.inserted) for n, r in enumerate(reports, 1)]
    return spark.createDataFrame(rows, "load INT, parsed BIGINT, sent BIGINT, skipped BIGINT, inserted BIGINT")


def _speed_tests(spark: SparkSession, folder: str) -> DataFrame:
    store = _store(spark)
    loaders.append_speed_tests(store, Tables(spark, folder)["speed_tests"], AS_OF)
    return latest_speed_tests(store.read("speed_tests").select(*TABLES["speed_tests"].columns))


def _stored_readings(spark: SparkSession, folder: str) -> DataFrame:
    """Bulk requests appended to a store that holds the loaded towers."""
    tables, store = Tables(spark, folder), _store(spark)
    loaders.load_towers(store, raw_files.write_raw_towers(tables))
    loaders.append_readings(store, bulk_readings(raw_files.bulk_requests(tables), AS_OF))
    return store.read("readings").groupBy("operator", "network").agg(
        F.count("*").alias("readings"), F.count("tower_id").alias("located"), F.max("recorded_at").alias("newest"))


def _feed_rows(spark: SparkSession, folder: str) -> DataFrame:
    path = raw_files.write_raw_feed(Tables(spark, folder))
    return feed.outages_from_feed(feed.read_feed(spark, path, per_line=True)).drop("raw_data")


def _feed_synced(nulls_equal: bool) -> Query:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        store = _store(spark)
        responses = feed.read_feed(spark, raw_files.write_raw_feed(Tables(spark, folder)), per_line=True)
        for _ in range(2):
            feed.sync_outages(store, responses, nulls_equal)
        return store.read("outages").select(*[c for c in TABLES["outages"].columns if c != "raw_data"])

    return run


def _feed_report(spark: SparkSession, folder: str) -> DataFrame:
    store = _store(spark)
    responses = feed.read_feed(spark, raw_files.write_raw_feed(Tables(spark, folder)), per_line=True)
    feed.sync_outages(store, responses)
    return feed.sync_outages(store, responses)


def _device(spark: SparkSession, folder: str) -> DataFrame:
    lines = raw_files.reading_lines(Tables(spark, folder))
    return device_readings(lines, AS_OF)


def _bulk(spark: SparkSession, folder: str) -> DataFrame:
    tables = Tables(spark, folder)
    accepted = bulk_readings(raw_files.bulk_requests(tables), AS_OF)
    return resolve_towers(accepted, tables["towers"])


def _refused(spark: SparkSession, folder: str) -> DataFrame:
    """Refused bulk requests by reason and place of the first bad reading."""
    return bulk_refusals(raw_files.bulk_requests(Tables(spark, folder)), AS_OF).groupBy("error").agg(F.count("*").alias("requests"))


def _provenance(spark: SparkSession, folder: str) -> DataFrame:
    """What the loaded rows say of where they come from, of two datasets loaded under different names."""
    store = _store(spark)
    for table, source in (("uptime_logs", loaders.SYNTHETIC_SOURCE), ("energy_consumption", "meter export")):
        loaders.load_dataset(store, table, raw_files.write_raw_csv(Tables(spark, folder), table), source, passing=True)
    return store.read("uptime_logs").select("source").unionByName(store.read("energy_consumption").select("source")).groupBy(
        "source").agg(F.count("*").alias("rows"))


def load_queries() -> dict[str, Query]:
    out: dict[str, Query] = {f"load_{table}": _load_twice(table) for table in LAYOUTS}
    out["load_towers"] = _load_towers
    out["load_report"] = _load_reports
    out["outage_feed_rows"] = _feed_rows
    out["outage_feed_synced_twice"] = _feed_synced(False)
    out["outage_feed_synced_twice_null_safe"] = _feed_synced(True)
    out["outage_feed_report"] = _feed_report
    out["readings_normalise"] = _device
    out["readings_bulk_requests"] = _bulk
    out["readings_bulk_refused"] = _refused
    out["load_provenance"] = _provenance
    out["readings_stored"] = _stored_readings
    out["speedtests_appended"] = _speed_tests
    return out


def _nearest_of(lat: str, lon: str) -> str:
    listed = ", ".join(f"{{'d': (({la}e0) - {lat}) * (({la}e0) - {lat}) + (({lo}e0) - {lon}) * (({lo}e0) - {lon}), "
                       f"'r': {i}, 'n': '{n}'}}" for i, (n, la, lo) in enumerate(CITIES))
    return f"list_sort([{listed}])[1]['n']"


def load_oracles() -> dict[str, str]:
    typed = raw_files.typed_readings_sql(NOW)
    columns = READING_TYPES.removeprefix("k, ")
    found = raw_files.feed_rows_sql()
    out = {f"load_{table}": raw_files.loaded_sql(table) for table in LAYOUTS}
    out["load_towers"] = raw_files.loaded_towers_sql(_nearest_of("x_lat", "x_lon"))
    loaded = raw_files.loaded_sql("uptime_logs")
    with_typed = loaded[: loaded.rindex(" SELECT ")]
    counts = "(SELECT COUNT(*) FROM typed)", "(SELECT COUNT(*) FROM typed WHERE NOT refused)"
    key = ", ".join(TABLES["uptime_logs"].natural_key)
    added = f"(SELECT COUNT(*) FROM (SELECT DISTINCT {key} FROM typed WHERE NOT refused) d)"
    out["load_report"] = (
        f"{with_typed} SELECT CAST(load AS INTEGER) AS load, {counts[0]} AS parsed, {counts[1]} AS sent, "
        f"{counts[0]} - {counts[1]} AS skipped, CASE load WHEN 1 THEN {added} ELSE 0 END AS inserted "
        "FROM (VALUES (1), (2)) loads(load)"
    )
    out["load_provenance"] = (
        f"SELECT 'synthetic training data' AS source, COUNT(*) AS rows FROM ({loaded}) u UNION ALL "
        f"SELECT 'meter export', COUNT(*) FROM ({raw_files.loaded_sql('energy_consumption')}) e")
    out["readings_bulk_refused"] = (
        f"WITH typed AS ({typed}), firsts AS (SELECT k // 20 AS request, arg_min(error, k) AS error FROM typed "
        "WHERE error IS NOT NULL GROUP BY 1) SELECT error, COUNT(*) AS requests FROM firsts GROUP BY error")
    out["outage_feed_rows"] = found
    out["outage_feed_synced_twice"] = (
        f"WITH found AS ({found}) SELECT * FROM found UNION ALL SELECT * FROM found WHERE ended_at IS NULL")
    out["outage_feed_synced_twice_null_safe"] = found
    out["outage_feed_report"] = (
        f"WITH found AS ({found}) SELECT operator, COUNT(*) AS found, COUNT(*) FILTER (WHERE ended_at IS NULL) AS inserted "
        "FROM found GROUP BY operator")
    out["readings_normalise"] = f"SELECT {columns}, error FROM ({typed}) t"
    out["speedtests_appended"] = (
        f"SELECT * EXCLUDE (id) FROM ({duck_view('speed_tests')}) v "
        "ORDER BY tested_at DESC, server_city, operator, dl_mbps, ul_mbps, ping_ms LIMIT 50")
    stored_towers = raw_files.loaded_towers_sql("CAST(NULL AS VARCHAR)")
    out["readings_stored"] = (
        f"WITH typed AS ({typed}), towers AS ({stored_towers}), known AS (SELECT DISTINCT cell_id FROM towers), "
        "refused AS (SELECT DISTINCT k // 20 AS request FROM typed WHERE error IS NOT NULL) "
        "SELECT operator, network, COUNT(*) AS readings, "
        "COUNT(CASE WHEN COALESCE(t.tower_id, 0) <> 0 OR known.cell_id IS NOT NULL THEN 1 END) AS located, "
        "MAX(recorded_at) AS newest FROM typed t LEFT JOIN known ON known.cell_id = t.cell_id "
        "WHERE t.k // 20 NOT IN (SELECT request FROM refused) GROUP BY operator, network")
    out["readings_bulk_requests"] = (
        f"WITH typed AS ({typed}), towers AS ({duck_view('towers')}), "
        "best AS (SELECT cell_id, arg_max(id, samples * 100000 - id) AS found FROM towers GROUP BY cell_id), "
        "refused AS (SELECT DISTINCT k // 20 AS request FROM typed WHERE error IS NOT NULL) "
        "SELECT CASE WHEN COALESCE(t.tower_id, 0) = 0 AND t.cell_id <> 0 THEN b.found ELSE t.tower_id END AS tower_id, "
        "t.cell_id, city, operator, network, signal_dbm, latency_ms, dl_mbps, ul_mbps, rsrp, rsrq, recorded_at "
        "FROM typed t LEFT JOIN best b ON b.cell_id = t.cell_id WHERE t.k // 20 NOT IN (SELECT request FROM refused)"
    )
    return out
