import datetime as dt
import glob
import gzip
import json
import time

import duckdb
import pytest
from pyspark.sql import functions as F

from mastlight import session
from mastlight.operators.latest import best_tower_per_cell
from mastlight.schemas import PARTITION_COLUMN, TABLES
from mastlight.sources import feed, loaders
from mastlight.sources import store as store_module
from mastlight.sources.layouts import LAYOUTS
from mastlight.sources.normalise import normalise
from mastlight.sources.readings import bulk_readings, check_all_valid, device_readings, resolve_towers
from mastlight.sources.store import TableStore
from workload import raw_files
from workload.load_queries import load_oracles, load_queries
from workload.views import Tables

NOW = "2024-01-31 00:00:00"


@pytest.fixture
def store(spark, tmp_path):
    return TableStore(spark, str(tmp_path / "store"))


def write(tmp_path, text, name="in.csv"):
    path = tmp_path / name
    path.write_text(text)
    return str(path)


def test_layouts_fill_their_tables():
    for name, layout in LAYOUTS.items():
        assert sorted(f.target for f in layout.fields) == sorted(TABLES[name].columns)


@pytest.mark.parametrize("table", sorted(LAYOUTS))
def test_every_alias_is_read(spark, table):
    """Each alias alone feeds its target."""
    sample = {"text": "T-1", "number": "4.5", "int": "7", "network": "lte", "boolean": "yes", "timestamp": "2024-01-02T03:04:05Z",
              "date": "2024-01-02", "month": "2024-02"}
    value = {"text": "T-1", "number": 4.5, "int": 7, "network": "4G", "boolean": True,
             "timestamp": dt.datetime(2024, 1, 2, 3, 4, 5), "date": dt.date(2024, 1, 2), "month": dt.date(2024, 2, 1)}
    layout = LAYOUTS[table]
    for depth in range(max(len(f.names) for f in layout.fields)):
        header = {f.names[min(depth, len(f.names) - 1)]: sample[f.kind] for f in layout.fields}
        raw = spark.createDataFrame([tuple(header.values())], ", ".join(f"`{n}` STRING" for n in header))
        got = normalise(raw, layout).first()
        for spec in layout.fields:
            name = spec.names[min(depth, len(spec.names) - 1)]
            shared = [f for f in layout.fields if name in f.names]
            if len({f.kind for f in shared}) == 1:
                assert got[spec.target] == value[spec.kind], (table, spec.target, depth)


def test_file_order_ids_and_reload(spark, store, tmp_path):
    path = write(tmp_path, "latitude,longitude,operator,coverage_id,signal_dbm\n"
                           "6.5,3.4,MTN,A,-80\n"
                           "x,3.4,MTN,B,-80\n"
                           '"6.6"," 3.5","Glo, ""Ltd""",,-81\n'
                           "\n"
                           "6.7,3.6,,A,-82\n"
                           "6.8,3.7,Airtel,,bad\n"
                           "6.9\n")
    first = loaders.load_dataset(store, "coverage_data", path)
    assert (first.parsed, first.sent, first.skipped, first.inserted) == (6, 4, 2, 3)
    got = {r.measurement_id: r for r in store.read("coverage_data").collect()}
    assert sorted(got) == ["A", "COV-3", "COV-5"]
    assert got["A"].lat == 6.5 and got["COV-3"].operator == 'Glo, "Ltd"' and got["COV-5"].signal_strength_dbm is None
    assert got["A"].city == "Unknown" and got["A"].source == loaders.SYNTHETIC_SOURCE and got["A"].imported_at is not None
    assert loaders.load_dataset(store, "coverage_data", path).inserted == 0


def test_ordinals_run_over_many_files_and_splits(spark, store, tmp_path):
    folder = tmp_path / "many"
    folder.mkdir()
    n = 0
    for part in range(4):
        lines = ["activity_id,notes"]
        for _ in range(300 * (part + 1)):
            n += 1
            lines.append(f",{n}")
        (folder / f"part-{part}.csv").write_text("\n".join(lines) + "\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1000")
    spark.conf.set("spark.sql.files.openCostInBytes", "100")
    try:
        loaders.load_dataset(store, "technician_logs", str(folder))
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    rows = store.read("technician_logs").select("activity_id", "notes").collect()
    assert len(rows) == n and all(r.activity_id == f"TECH-{r.notes}" for r in rows)


def test_missing_time_is_the_epoch_only_where_aliases_are_read(spark, store, tmp_path):
    path = write(tmp_path, "sensor_id,timestamp\nA,\nB,soon\nC,2024-01-01\n")
    assert loaders.load_dataset(store, "hardware_sensors", path).inserted == 2
    got = {r.sensor_id: r.sensor_time for r in store.read("hardware_sensors").collect()}
    assert got == {"A": dt.datetime(1970, 1, 1), "C": dt.datetime(2024, 1, 1)}
    path = write(tmp_path, "drop_id,timestamp\nA,\nB,2024-01-01\n", "drops.csv")
    assert loaders.load_dataset(store, "dropped_calls", path).inserted == 1


def test_store_partitions_by_date(spark, store, tmp_path):
    path = write(tmp_path, "event_id,timestamp\nA,2024-01-01T23:59:59Z\nB,2024-01-02\n")
    loaders.load_dataset(store, "network_events", path)
    days = {r.event_id: r[PARTITION_COLUMN] for r in store.read("network_events").collect()}
    assert days == {"A": dt.date(2024, 1, 1), "B": dt.date(2024, 1, 2)}
    from mastlight.plans.listings import run_list
    plan = run_list("events", store.read("network_events"), from_="2024-01-02")
    assert [r.event_id for r in plan.collect()] == ["B"]
    assert "PartitionFilters: [isnotnull(event_date" in plan._jdf.queryExecution().executedPlan().toString()


TOWERS = """LTE,621,30,10,500,0,3.38,6.52,1000,5,1,1500000000,1600000000,-80
,621,99,10,501,0,3.38,6.52,,0,1,,,
NR,621,20,10,502,0,0,6.52,1,1,1,1,1,1
UMTS,621,20,x,503,0,3.38,6.52,1,1,1,1,1,1
GSM,621,30,10,500,0,7.4,9.07,1,9,1,1,1,1
GSM,621,60,11,504,0,8.6,12.0
"""


def test_towers_skip_and_force(spark, store, tmp_path):
    path = write(tmp_path, TOWERS)
    report = loaders.load_towers(store, path)
    assert (report.parsed, report.sent, report.inserted) == (6, 4, 3)
    got = {r.cell_id: r for r in store.read("towers").collect()}
    assert (got[500].operator, got[500].network, got[500].city, got[500].id) == ("MTN", "4G", "Lagos", 1)
    assert (got[501].operator, got[501].radio, got[501].network, got[501].samples) == ("Unknown", "GSM", "2G", 1)
    assert (got[504].operator, got[504].range_m, got[504].city) == ("9mobile", 0, "Kano")
    readings = spark.createDataFrame([(1, dt.datetime(2024, 1, 1))], "tower_id int, recorded_at timestamp_ntz")
    for column in TABLES["readings"].ddl.replace("\n", " ").split(","):
        name, kind = column.split()
        if name not in readings.columns:
            readings = readings.selectExpr("*", f"cast(NULL AS {kind}) AS {name}")
    store.append("readings", readings)
    store.append("readings", readings)
    assert store.count("readings") == 2
    assert loaders.load_towers(store, path) is None and store.count("readings") == 2
    assert loaders.load_towers(store, path, force=True).inserted == 3
    assert store.count("towers") == 3 and store.count("readings") == 0


FEED = {"outages": [{"start": 1700000000, "end": 1700000090, "score": 42.5, "signal_types": ["BGP", "Ping"]},
                    {"started_at": 0, "from": 1700003600, "level": "high"}, {"end": 5}]}


def put_feed(tmp_path, body, code="29465"):
    folder = tmp_path / "feed" / f"entity_code={code}"
    folder.mkdir(parents=True, exist_ok=True)
    (folder / "response.json").write_text(body if isinstance(body, str) else json.dumps(body, indent=1))
    return str(tmp_path / "feed")


def test_feed_rows(spark, tmp_path):
    path = put_feed(tmp_path, FEED)
    put_feed(tmp_path, [{"start": "2024-01-01T00:00:00Z", "severity": None, "value": "7"}], "NG")
    put_feed(tmp_path, "not json", "36873")
    put_feed(tmp_path, {"outages": None, "events": "none", "results": [{"start": 1}]}, "37148")
    got = feed.outages_from_feed(feed.read_feed(spark, path)).orderBy("operator", "started_at", "signal_type").collect()
    first = dt.datetime(2023, 11, 14, 22, 13, 20)
    assert [(r.operator, r.started_at, r.ended_at, r.duration_min, r.severity, r.signal_type) for r in got] == [
        ("MTN", first, first + dt.timedelta(seconds=90), 2, 42.5, "bgp"),
        ("MTN", first, first + dt.timedelta(seconds=90), 2, 42.5, "ping"),
        ("MTN", first + dt.timedelta(hours=1), None, None, 0.0, "unknown"),
        ("Nigeria", dt.datetime(2024, 1, 1), None, None, 7.0, "unknown")]
    assert json.loads(got[0].raw_data)["signal_types"] == ["BGP", "Ping"]


def test_open_outages_are_added_again_unless_null_safe(spark, store, tmp_path):
    responses = feed.read_feed(spark, put_feed(tmp_path, FEED))
    report = lambda **how: [(r.operator, r.found, r.inserted) for r in feed.sync_outages(store, responses, **how).collect()]
    assert report() == [("MTN", 3, 3)]
    assert report() == [("MTN", 3, 1)]
    assert report(nulls_equal=True) == [("MTN", 3, 0)]


def lines(spark, *readings):
    return spark.createDataFrame([(r if isinstance(r, str) else json.dumps(r),) for r in readings], "value string")


def test_device_reading(spark):
    sent = {"cell_id": 123456789, "city": "Lagos", "operator": "MTN", "network": "4G", "signal_dbm": -83, "latency_ms": 42,
            "dl_mbps": 18.7, "ul_mbps": 7.1, "rsrp": -95, "rsrq": -10.5, "recorded_at": "2026-04-27T22:40:00.000Z"}
    got = device_readings(lines(spark, sent), NOW).first()
    assert got.error is None and got.tower_id is None and got.recorded_at == dt.datetime(2026, 4, 27, 22, 40)
    assert (got.cell_id, got.signal_dbm, got.latency_ms, got.dl_mbps, got.rsrq) == (123456789, -83.0, 42, 18.7, -10.5)


@pytest.mark.parametrize("reading,field,expected", [
    ({"signal_dbm": None}, "signal_dbm", -20.0), ({"signal_dbm": ""}, "signal_dbm", -20.0),
    ({"signal_dbm": True}, "signal_dbm", -20.0), ({"signal_dbm": "-90"}, "signal_dbm", -90.0),
    ({"signal_dbm": -1, "rsrp": None}, "rsrp", -20.0), ({"signal_dbm": -1}, "rsrp", None),
    ({"signal_dbm": -1, "latency_ms": None}, "latency_ms", None), ({"signal_dbm": -1, "recorded_at": 0}, "recorded_at", dt.datetime(2024, 1, 31)),
    ({"signal_dbm": -1, "recorded_at": 1700000000000}, "recorded_at", dt.datetime(2023, 11, 14, 22, 13, 20)),
    ({"signal_dbm": -1, "recorded_at": ""}, "recorded_at", dt.datetime(2024, 1, 31)),
    ({"signal_dbm": -1, "network": "wifi"}, "network", "4G"), ({}, "error", "signal_dbm is required and must be numeric"),
    ({"signal_dbm": "loud"}, "error", "signal_dbm is required and must be numeric"),
    ({"signal_dbm": -1, "recorded_at": "soon"}, "error", "recorded_at must be a valid date/time")])
def test_reading_fields(spark, reading, field, expected):
    assert device_readings(lines(spark, reading), NOW).first()[field] == expected


def test_a_bad_reading_refuses_its_request(spark):
    good, bad = {"signal_dbm": -80}, {"signal_dbm": "x"}
    requests = lines(spark, {"readings": [good, good]}, {"readings": [good, bad]}, {"readings": []}, {"other": 1}, "junk",
                     {"readings": [good] * 1001}, {"readings": [good] * 1000})
    assert bulk_readings(requests, NOW).count() == 1002
    with pytest.raises(ValueError, match="signal_dbm"):
        check_all_valid(device_readings(lines(spark, good, bad), NOW))
    assert check_all_valid(device_readings(lines(spark, good), NOW)).count() == 1


def test_resolving_towers(spark):
    towers = spark.createDataFrame([(1, 50, 5), (2, 50, 9), (3, 50, 9), (4, 60, None), (5, 60, 7)], "id int, cell_id bigint, samples int")
    assert {(r.cell_id, r.id) for r in best_tower_per_cell(towers).collect()} == {(50, 2), (60, 4)}
    readings = spark.createDataFrame(
        [(None, 50), (0, 60), (9, 50), (None, 0), (None, None), (None, 70)], "tower_id int, cell_id bigint"
    ).selectExpr("*", "timestamp_ntz'2024-01-01' AS recorded_at", "-80D AS signal_dbm")
    for threshold in ("10MB", "-1"):
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
        got = [(r.cell_id, r.tower_id) for r in resolve_towers(readings, towers).collect()]
        assert sorted(got, key=str) == sorted([(50, 2), (60, 4), (50, 9), (0, None), (None, None), (70, None)], key=str)
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_appending_readings_and_speed_tests(spark, store, tmp_path):
    loaders.load_towers(store, write(tmp_path, TOWERS))
    loaders.append_readings(store, bulk_readings(lines(spark, {"readings": [{"signal_dbm": -80, "cell_id": 500}]}), NOW))
    got = store.read("readings").first()
    assert (got.tower_id, got.cell_id, got.recorded_at) == (1, 500, dt.datetime(2024, 1, 31))
    ddl = "server_city string, operator string, dl_mbps double, ul_mbps double, ping_ms double, jitter_ms double, rating string"
    row = ("Lagos", "MTN", 1.0, 2.0, 3.0, 4.0, "good")
    loaders.append_speed_tests(store, spark.createDataFrame([row], ddl), NOW)
    timed = spark.createDataFrame([(*row, dt.datetime(2024, 1, 1)), (*row, None)], f"{ddl}, tested_at timestamp_ntz")
    loaders.append_speed_tests(store, timed, NOW)
    times = sorted(r.tested_at for r in store.read("speed_tests").collect())
    assert times == [dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 31), dt.datetime(2024, 1, 31)]


def test_feed_stream_takes_overlapping_responses(spark, store, tmp_path):
    from mastlight.streaming.outages import sync_feed

    check = str(tmp_path / "check")
    for part, rows in enumerate(([{"start": 100}, {"start": 200, "end": 300}], [{"start": 100}, {"start": 400}])):
        path = put_feed(tmp_path, json.dumps(rows))
        (tmp_path / "feed" / "entity_code=29465" / "response.json").rename(
            tmp_path / "feed" / "entity_code=29465" / f"response-{part}.json")
        sync_feed(store, feed.read_feed(spark, path, streaming=True), check)
    starts = sorted(int((r.started_at - dt.datetime(1970, 1, 1)).total_seconds()) for r in store.read("outages").collect())
    assert starts == [100, 200, 400]


def test_refusals_are_listed(spark, tmp_path):
    from mastlight.sources.readings import LENGTH_ERROR, SIGNAL_ERROR, TIME_ERROR, UNREADABLE_ERROR, bulk_refusals
    from mastlight.streaming.readings import ingest_readings

    good, bad, late = {"signal_dbm": -80}, {"signal_dbm": "x"}, {"signal_dbm": -80, "recorded_at": "soon"}
    requests = lines(spark, {"readings": [good]}, {"readings": [good, bad, late]}, {"readings": [late]}, {"other": 1}, "junk",
                     {"readings": [good] * 1001}, {"readings": []})
    got = sorted(((r.position, r.error) for r in bulk_refusals(requests, NOW).collect()), key=str)
    assert got == sorted([(1, SIGNAL_ERROR), (0, TIME_ERROR), (None, UNREADABLE_ERROR), (None, UNREADABLE_ERROR), (None, LENGTH_ERROR)], key=str)
    assert bulk_readings(requests, NOW, most=None).count() == 1002 and bulk_refusals(requests, NOW, most=None).count() == 4
    with pytest.raises(ValueError, match="signal_dbm|recorded_at|list|many"):
        bulk_readings(requests, NOW, strict=True)
    assert bulk_readings(lines(spark, {"readings": [good]}), NOW, strict=True).count() == 1
    source = tmp_path / "lines"
    source.mkdir()
    (source / "a.json").write_text("\n".join(json.dumps(x) for x in (good, bad, late)))
    towers = spark.createDataFrame([], "id int, cell_id bigint, samples int")
    ingest_readings(spark.readStream.text(str(source)), towers, str(tmp_path / "out"), str(tmp_path / "check"), NOW)
    assert spark.read.parquet(str(tmp_path / "out")).count() == 1
    refused = spark.read.parquet(str(tmp_path / "out_refused")).collect()
    assert sorted((json.loads(r.line) == bad, r.error) for r in refused) == [(False, TIME_ERROR), (True, SIGNAL_ERROR)]


def test_first_of_equal_feed_rows_wins_and_open_ones_stay(spark, store, tmp_path):
    rows = [{"start": 100, "end": 200, "severity": 90}, {"start": 100, "end": 200, "severity": 10}, {"start": 300}, {"start": 300}]
    path = put_feed(tmp_path, json.dumps(rows))
    report = feed.sync_outages(store, feed.read_feed(spark, path)).collect()
    assert [(r.found, r.inserted) for r in report] == [(4, 3)]
    got = sorted((r.severity, r.ended_at is None) for r in store.read("outages").collect())
    assert got == [(0.0, True), (0.0, True), (90.0, False)]


def test_first_response_to_arrive_wins(spark, store, tmp_path):
    """Spark reads large files first; the first file to arrive has the rows that stay, however small it is."""
    import os

    path = put_feed(tmp_path, json.dumps([{"start": 100, "end": 200, "severity": 90}]))
    folder = tmp_path / "feed" / "entity_code=29465"
    (folder / "response.json").rename(folder / "z-first.json")
    later = [{"start": 100, "end": 200, "severity": 10}] + [{"start": 1000 + i, "end": 5000, "severity": 1} for i in range(500)]
    (folder / "a-later.json").write_text(json.dumps(later))
    for name, time in (("z-first.json", 1_700_000_000), ("a-later.json", 1_700_000_100)):
        os.utime(folder / name, (time, time))
    feed.sync_outages(store, feed.read_feed(spark, path))
    assert [r.severity for r in store.read("outages").collect() if r.ended_at == dt.datetime(1970, 1, 1, 0, 3, 20)] == [90.0]


def test_headers_of_a_folder_must_agree(spark, tmp_path):
    from mastlight.sources.rows import read_headed_csv

    folder = tmp_path / "two"
    folder.mkdir()
    (folder / "a.csv").write_text("metric_id,operator\n1,MTN\n")
    (folder / "b.csv").write_text("operator,metric_id\nGlo,2\n")
    with pytest.raises(Exception, match="(?i)header"):
        read_headed_csv(spark, str(folder)).collect()
    (folder / "b.csv").write_text("metric_id,operator\n2,Glo\n")
    assert sorted(r.metric_id for r in read_headed_csv(spark, str(folder)).collect()) == ["1", "2"]


def test_long_expressions_are_split_while_rows_are_typed(spark, tmp_path, monkeypatch):
    """Generated methods of more than 8000 bytes would run uncompiled; the session's own limit comes back afterwards."""
    name, seen = "spark.sql.codegen.hugeMethodLimit", []
    before, write = spark.conf.get(name), loaders.written
    monkeypatch.setattr(loaders, "written", lambda rows, label: (seen.append(spark.conf.get(name)), write(rows, label))[1])
    file = tmp_path / "uptime.csv"
    file.write_text("tower_id,date\nT1,2024-01-02\n")
    assert loaders.stage_dataset(spark, "uptime_logs", str(file)).parsed == 1
    assert seen == ["8000"] and spark.conf.get(name) == before


def test_partitions_follow_the_rows_of_a_load(spark, store, tmp_path, monkeypatch):
    """A task sorts about as many rows however large the load; small loads keep the session's settings."""
    names = ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")
    before, seen = [spark.conf.get(n) for n in names], []

    def spied(*args):
        seen.append([spark.conf.get(n) for n in names])
        return absent_from(*args)

    absent_from = store_module.absent_from
    monkeypatch.setattr(store_module, "absent_from", spied)
    header = "latitude,longitude,operator,coverage_id,signal_dbm\n"
    path = write(tmp_path, header + "".join(f"6.5,3.4,MTN,C{i},-80\n" for i in range(130)))
    assert loaders.load_dataset(store, "coverage_data", path).inserted == 130
    monkeypatch.setattr(session, "ROWS_OF_A_TASK", 10)
    assert loaders.load_dataset(store, "coverage_data", path).inserted == 0
    assert seen == [before, ["13", "false"]] and [spark.conf.get(n) for n in names] == before
    assert store.count("coverage_data") == 130


@pytest.fixture
def work(tmp_path, monkeypatch):
    """A folder for the work tables of one test; gives what lists them."""
    folder = tmp_path / "work" / "mastlight"
    folder.mkdir(parents=True)
    monkeypatch.setattr(session, "shared_folder", lambda spark: str(folder.parent))
    return lambda: sorted(p.name.rpartition("-")[0] for p in folder.iterdir())


def lineitems(spark, tmp_path, count=700):
    """Lineitem rows that are out of order, many with equal keys."""
    spark.range(count).repartition(3).orderBy(F.hash("id")).selectExpr(
        "id AS l_orderkey", "id % 9 AS l_partkey", "id % 11 AS l_suppkey", "cast(1 + id % 7 AS int) AS l_linenumber", "id % 50 / 1D AS l_quantity",
        "id * 1.5D AS l_extendedprice", "id % 8 / 1e2D AS l_tax", "element_at(array('A', 'N', 'R'), cast(1 + id % 3 AS int)) AS l_returnflag",
    ).write.parquet(str(tmp_path / "lineitem.parquet"))
    return str(tmp_path)


def test_a_load_leaves_no_staged_table(spark, store, tmp_path, work):
    path = write(tmp_path, "latitude,longitude,coverage_id\n6.5,3.4,A\n6.6,3.5,\n")
    assert loaders.load_dataset(store, "coverage_data", path).inserted == 2
    assert work() == [] and sorted(r.measurement_id for r in store.read("coverage_data").collect()) == ["A", "COV-2"]


def test_provenance_leaves_only_what_it_loaded(spark, tmp_path, work, monkeypatch):
    """The raw files, staged rows and shuffle files of two datasets would lie on the disk at once."""
    folder = lineitems(spark, tmp_path)
    blocks = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def shuffled():
        return {f for f in blocks.getAllFiles().mkString("\n").split("\n") if "shuffle_" in f and f.endswith(".data")}

    def left():
        return sum(spark._jvm.java.io.File(f).length() for f in shuffled() - before)

    before, seen, absent_from = shuffled(), [], store_module.absent_from
    monkeypatch.setattr(store_module, "absent_from", lambda *args: (seen.append(work()), absent_from(*args))[1])
    rows = load_queries()["load_provenance"](spark, folder)
    assert seen == [["stage-uptime_logs"], ["stage-energy_consumption", "store"]] and work() == ["store"]
    until = time.monotonic() + 20
    while left() > 1000 and time.monotonic() < until:  # they go in the background, but for a row per task of the span of dates
        time.sleep(0.2)
    assert left() <= 1000
    connection = duckdb.connect()
    connection.execute(f"CREATE VIEW lineitem AS SELECT * FROM '{folder}/lineitem.parquet/*.parquet'")
    assert sorted(map(tuple, rows.collect())) == sorted(connection.execute(load_oracles()["load_provenance"]).fetchall())


def test_raw_files_are_small_and_in_row_order(spark, tmp_path, work, monkeypatch):
    """Base rows are sorted, not the text made from them; compressed files stay small enough for a task each."""
    tables = Tables(spark, lineitems(spark, tmp_path))
    rows = raw_files.raw_rows(tables, "energy_consumption")
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    assert "concat" in plan and "concat" not in plan[plan.index("Sort ["):]
    monkeypatch.setattr(raw_files, "ROWS_OF_A_FILE", 50)
    folder = raw_files.write_raw_csv(tables, "energy_consumption")
    files = sorted(glob.glob(f"{folder}/part-*.csv.gz"))
    texts = [gzip.open(f, "rt").read().splitlines() for f in files]
    assert len(files) >= 14 and len({t[0] for t in texts}) == 1 and max(map(len, texts)) < 300
    costs = [line.split(",")[texts[0][0].split(",").index("total_cost_ngn")] for t in texts for line in t[1:]]
    assert [float(c) for c in costs if c != "n/a"] == [i * 1.5 for i in range(700) if (i * 8 + 1 + i % 7) % 10 != 3]


def test_staged_files_are_small_and_packed_tightly(spark, tmp_path, monkeypatch):
    """What the tasks that sort them spill lies on the disk until they end; the session's own settings come back afterwards."""
    names = ("spark.sql.files.maxRecordsPerFile", "spark.sql.parquet.compression.codec", "spark.sql.files.maxPartitionBytes")
    before = [spark.conf.get(n) for n in names]
    monkeypatch.setattr(session, "ROWS_OF_A_STAGED_FILE", 10)
    path = write(tmp_path, "tower_id,date\n" + "".join(f"T{i},2024-01-02\n" for i in range(35)))
    staged = loaders.stage_dataset(spark, "uptime_logs", path)
    assert staged.parsed == 35 and staged.rows.count() == 35
    assert [f.endswith(".zstd.parquet") for f in staged.rows.inputFiles()] == [True] * 4
    with session.sorting_staged(spark):
        assert int(spark.conf.get(names[2])) == session.BYTES_OF_A_SORTING_TASK
        with session.set_within(spark, {names[2]: "1000"}), session.sorting_staged(spark):
            assert spark.conf.get(names[2]) == "1000"
    assert [spark.conf.get(n) for n in names] == before
