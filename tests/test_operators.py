import datetime as dt
import math
import random
from decimal import ROUND_HALF_UP, Decimal

import pytest
from pyspark.sql import functions as F

from mastlight.operators.geo_radius import within_radius
from mastlight.operators.latest import latest_readings
from mastlight.operators.levels import grouped_levels
from mastlight.operators.listing import listing
from mastlight.operators import sumtree
from mastlight.operators.measures import average, matches, partials, results, rows, total
from mastlight.operators.preceding import CATEGORIES, preceding_stats
from mastlight.plans import correlate, recommend, summaries
from mastlight.plans.listings import LISTS, list_outages, run_list
from mastlight.schemas import TABLES

START = dt.datetime(2024, 1, 1)
MEASURES = (rows("n"), average("mean", "x", 3), total("sum", "x", 3), matches("big", "x > 5"))


def half_up(x):
    return float(Decimal(repr(x)).quantize(Decimal("0.001"), ROUND_HALF_UP))


def brute(windows, facts, by_key):
    out = {}
    for key, upper in windows:
        lower = upper - dt.timedelta(hours=2)
        hit = [(x, c) for k, t, x, c in facts if (not by_key or k == key) and lower <= t < upper]
        if not hit:
            continue
        known = [x for x, _ in hit if x is not None]
        kinds = {}
        for _, c in hit:
            if c is not None:
                kinds[c] = kinds.get(c, 0) + 1
        out[(key if by_key else None, upper)] = (
            len(hit), half_up(sum(known) / len(known)) if known else None, half_up(sum(known)) if known else None,
            sum(1 for x in known if x > 5), kinds)
    return out


@pytest.mark.parametrize("bounded", [True, False])
@pytest.mark.parametrize("by_key", [True, False])
@pytest.mark.parametrize("seed,crowded", [(1, False), (2, True), (3, True)])
def test_windows_match_brute_force(spark, seed, crowded, by_key, bounded):
    """Crowded: most windows and facts fall in one minute, many edges hit facts exactly."""
    rng = random.Random(seed)
    second = (lambda: rng.choice([rng.randrange(7200, 7260), rng.randrange(0, 60), rng.randrange(0, 20000)])) if crowded \
        else (lambda: rng.randrange(0, 40000))
    windows = {(rng.choice("ab"), START + dt.timedelta(seconds=second() + 7200)) for _ in range(40)}
    facts = [(rng.choice("abc"), START + dt.timedelta(seconds=second()), rng.choice([None, rng.randrange(0, 80) / 8]),
              rng.choice([None, "p", "q", "r"])) for _ in range(600)]
    facts += [("a", u, 1.0, "p") for _, u in windows] + [("b", u - dt.timedelta(hours=2), 2.0, "q") for _, u in windows]
    keys = ["k"] if by_key else []
    w = spark.createDataFrame(list(windows), "k string, upper timestamp_ntz").select(
        *keys, F.expr("upper - INTERVAL 2 HOURS AS lower"), "upper").distinct()
    f = spark.createDataFrame(facts, "k string, t timestamp_ntz, x double, c string")
    for category in (None, "c"):
        got = preceding_stats(w, f, "t", keys, MEASURES, "minute", category, bounded)
        extra = [CATEGORIES] if category else []
        seen = {}
        for r in got.select(*keys, "upper", *results(MEASURES), *extra).collect():
            kinds = {e.category: e.total for e in r[CATEGORIES]} if category else None
            seen[(r.k if by_key else None, r.upper)] = (r.n, r["mean"], r["sum"], r.big, kinds)
        expected = brute(windows, facts, by_key)
        if not category:
            expected = {k: (*v[:4], None) for k, v in expected.items()}
        nothing = {k: v for k, v in seen.items() if k not in expected}
        assert all(v[0] == 0 for v in nothing.values())
        assert {k: v for k, v in seen.items() if k in expected} == expected


def empty_tables(spark):
    out = {}
    for name, table in TABLES.items():
        ddl = table.ddl if "id " in table.ddl[:4] else f"id BIGINT, {table.ddl}"
        out[name] = spark.createDataFrame([], ddl)
    return out


def test_correlation_with_empty_facts_keeps_every_outage(spark):
    tables = empty_tables(spark)
    tables["outages"] = spark.createDataFrame(
        [(1, "MTN", START), (2, "Glo", START)], "id bigint, operator string, started_at timestamp_ntz"
    ).selectExpr("id", "operator", "'bgp' AS signal_type", "1D AS severity", "started_at",
                 "cast(NULL AS timestamp_ntz) AS ended_at", "cast(NULL AS int) AS duration_min")
    for limit in (100, None):
        got = correlate.correlate_outages(tables, limit)
        assert len(got.columns) == 52
        listed = got.collect()
        assert [r.outage_id for r in listed] == [1, 2]
        assert listed[0].sample_count == 0 and listed[0].pre_avg_signal is None
        assert listed[0].total_synthetic_outages == 0 and listed[0].pre_event_types == {}


def test_correlation_of_no_outages(spark):
    assert correlate.correlate_outages(empty_tables(spark), 10).collect() == []


def km(a, b):
    (la, lo), (lb, lp) = [tuple(map(math.radians, p)) for p in (a, b)]
    c = math.cos(la) * math.cos(lb) * math.cos(lp - lo) + math.sin(la) * math.sin(lb)
    return 6371 * math.acos(min(1, max(-1, c)))


@pytest.mark.parametrize("centre", [(6.5, 3.4), (0.0, 179.9), (-17.0, -179.95), (89.7, 10.0), (60.0, -0.1), (4.0, 3.0)])
def test_radius_join_matches_brute_force(spark, centre):
    rng = random.Random(7)
    wrap = lambda lon: (lon + 180) % 360 - 180
    spread = 2.0 if abs(centre[0]) < 80 else 170.0
    points = [(i, max(-90.0, min(90.0, centre[0] + rng.uniform(-1, 1))), wrap(centre[1] + rng.uniform(-spread, spread)))
              for i in range(400)]
    places = [(0, *centre, 50.0), (1, *centre, 1.0), (2, max(-90.0, centre[0] - 0.3), wrap(centre[1] + 0.2), 20.0)]
    d = spark.createDataFrame(places, "dest_id int, lat double, lon double, radius_km double")
    p = spark.createDataFrame(points, "id int, lat double, lon double")
    got = {(r.dest_id, r.id) for r in within_radius(d, p, ["id"]).collect()}
    expected = {(n, i) for n, la, lo, radius in places for i, pa, po in points if km((la, lo), (pa, po)) <= radius}
    assert got == expected and expected


def test_latest_readings_key_and_ties(spark):
    rows_ = [(1, 5, 9, START), (2, 5, 9, START + dt.timedelta(hours=1)), (3, None, 9, START), (4, None, 9, START),
             (5, None, None, START), (6, None, None, START)]
    df = spark.createDataFrame(rows_, "id bigint, tower_id int, cell_id bigint, recorded_at timestamp_ntz")
    for column in ("city", "operator", "network", "signal_dbm", "latency_ms", "dl_mbps", "ul_mbps", "rsrp", "rsrq"):
        df = df.withColumn(column, F.col("id"))
    got = latest_readings(df).collect()
    assert [r.city for r in got] == [4, 6, 5, 2]
    assert [r.city for r in latest_readings(df, 2).collect()] == [4, 6]


def test_levels_of_empty_input_have_a_total(spark):
    df = spark.createDataFrame([], "a string, b string, x double")
    got = grouped_levels(df, ["a", "b"], ["a", "b", None], (rows("n"), average("m", "x", 1))).collect()
    assert [(r.level, r.key, r.n, r.m) for r in got] == [("total", None, 0, None)]


def test_no_city_limit_lists_all_cities(spark):
    towers = spark.createDataFrame([("MTN", "4G", f"c{i}") for i in range(30)], "operator string, network string, city string")
    for cities, n in ((None, 30), (3, 3), (summaries.TOP_CITIES, 20)):
        assert summaries.tower_stats(towers, cities)["by_city"].count() == n
        assert summaries.tower_stats_rows(towers, cities).where("level = 'city'").count() == n
    readings = towers.selectExpr("*", "timestamp_ntz '2024-01-30 23:30:00' AS recorded_at", "-80.0D AS signal_dbm",
                                 "20.0D AS latency_ms", "5.0D AS dl_mbps")
    for cities, n in ((None, 30), (summaries.SUMMARY_CITIES, 14)):
        got = summaries.readings_summary(readings, "2024-01-31 00:00:00", cities=cities)
        assert got.where("level = 'city'").count() == n


def test_levels_keep_null_keys(spark):
    df = spark.createDataFrame([(None, "u", 1.0), ("p", "u", 3.0), (None, "v", 5.0)], "a string, b string, x double")
    got = {(r.level, r.key): (r.n, r.m) for r in
           grouped_levels(df, ["a", "b"], ["a", "b", None], (rows("n"), average("m", "x", 1))).collect()}
    assert got == {("a", None): (2, 3.0), ("a", "p"): (1, 3.0), ("b", "u"): (2, 2.0), ("b", "v"): (1, 5.0), ("total", None): (3, 3.0)}


def hardware(spark):
    spec = TABLES["hardware_sensors"]
    base = spark.range(30).selectExpr(
        "concat('S', id) AS sensor_id", "timestamp_ntz'2024-01-01' + make_dt_interval(0, cast(id AS int)) AS sensor_time",
        "CASE WHEN id % 3 = 0 THEN NULL ELSE id % 3 = 1 END AS alert_triggered", "'x' AS source")
    missing = [f"cast(NULL AS {p.split()[1]}) AS {p.split()[0]}" for p in spec.ddl.replace("\n", " ").split(",")
               if p.split()[0] not in base.columns]
    return base.selectExpr("*", *missing)


def test_listing_filters_limits_and_errors(spark):
    df = hardware(spark)
    assert run_list("hardware", df, alert="true", limit="4").count() == 4
    assert run_list("hardware", df, alert="all").count() == 30
    assert run_list("hardware", df, alert="FALSE").count() == 10
    assert run_list("hardware", df, limit="0").count() == 30
    assert run_list("hardware", df, limit="-3").count() == 1
    assert run_list("hardware", df, from_="2024-01-01T05:00:00Z", until="2024-01-01T07:00:00+00:00").count() == 3
    assert run_list("hardware", df, city="", tower_id=None).count() == 30
    for bad in ({"alert": "perhaps"}, {"from_": "yesterday"}, {"nonsense": 1}):
        with pytest.raises(ValueError):
            run_list("hardware", df, **bad)
    first = run_list("hardware", df, limit=1).first()
    assert first.sensor_id == "S29"


def test_box_is_checked_only_where_the_service_checks(spark):
    assert LISTS["towers"].box == "unchecked" and LISTS["coverage"].box == "checked"
    with pytest.raises(ValueError):
        listing(spark.createDataFrame([], "lat double"), LISTS["coverage"], {"bbox": "1,2,3,inf"})


def test_filter_reaches_the_scan(spark, tmp_path, capsys):
    path = str(tmp_path / "t")
    hardware(spark).write.parquet(path)
    run_list("hardware", spark.read.parquet(path), alert="true", from_="2024-01-01T05:00:00").explain("formatted")
    plan = capsys.readouterr().out
    pushed = next(line for line in plan.splitlines() if line.startswith("PushedFilters"))
    assert "EqualTo(alert_triggered,true)" in pushed and "GreaterThanOrEqual(sensor_time" in pushed
    assert "TakeOrderedAndProject" in plan


def test_outages_default_to_the_last_week(spark):
    df = spark.createDataFrame([(1, START), (2, START - dt.timedelta(days=7)), (3, START - dt.timedelta(days=8))],
                               "id int, started_at timestamp_ntz").selectExpr("*", "'MTN' AS operator", "id * 10D AS severity")
    assert [r.id for r in list_outages(df, START).collect()] == [1, 2]
    assert [r.id for r in list_outages(df, START, min_severity="15").collect()] == [2]
    assert [r.id for r in list_outages(df, START, operator="Glo").collect()] == []
    epoch = (START - dt.datetime(1970, 1, 1)).total_seconds()
    assert [r.id for r in list_outages(df, START, from_=epoch - 8 * 86400, until=epoch - 1).collect()] == [2, 3]


def test_no_limit_lists_everything(spark):
    from mastlight.operators.latest import latest_readings
    from mastlight.plans.listings import latest_speed_tests

    df = spark.range(3000).selectExpr("cast(id AS int) AS tower_id", "timestamp_ntz'2024-01-01' AS recorded_at", "id",
                                      *[f"cast(NULL AS string) AS {c}" for c in ("city", "operator", "network")], "0L AS cell_id")
    assert latest_readings(df, None).count() > latest_readings(df, 5).count() == 5
    tests = spark.range(60).selectExpr("id", "timestamp_ntz'2024-01-01' AS tested_at")
    assert latest_speed_tests(tests).count() == 50 and latest_speed_tests(tests, None).count() == 60


def test_clusters_need_a_shared_folder():
    from types import SimpleNamespace

    from mastlight.session import shared_folder

    session = SimpleNamespace(conf=SimpleNamespace(get=lambda key, default: default), sparkContext=SimpleNamespace(master="yarn"))
    with pytest.raises(ValueError, match="checkpoint"):
        shared_folder(session)


@pytest.mark.parametrize("seed", range(4))
def test_dyadic_cover_is_small_and_exact(spark, seed):
    rng = random.Random(seed)
    pairs = [(a, a + rng.choice([0, 1, 2, rng.randrange(1, 130), rng.randrange(1, 10_000)])) for a in (rng.randrange(-5000, 30_000_000) for _ in range(200))]
    levels = max(b - a for a, b in pairs).bit_length()
    frame = spark.createDataFrame(pairs, "first long, last long").select("first", "last", sumtree.cover("first", "last", levels).alias("nodes"))
    for row in frame.collect():
        minutes = [m for n in row.nodes for m in range(n.node << n.level, (n.node + 1) << n.level)]
        assert sorted(minutes) == list(range(row["first"], row["last"]))
        assert len(row.nodes) <= 2 * max(1, (row["last"] - row["first"]).bit_length())


def test_window_sums_over_weeks_and_before_1970(spark):
    start = dt.datetime(1969, 12, 30, 23, 59, 59, 999000)
    rng = random.Random(11)
    facts = [(start + dt.timedelta(milliseconds=rng.randrange(0, 30 * 86_400_000)), rng.randrange(0, 64) / 8) for _ in range(800)]
    windows = [(start + dt.timedelta(seconds=a), start + dt.timedelta(seconds=a + n)) for a, n in
               ((rng.randrange(0, 20 * 86_400), rng.choice([120, 7200, 86_400, 14 * 86_400 + 7])) for _ in range(60))]
    got = sumtree.window_sums(
        spark.createDataFrame(windows, "lower timestamp_ntz, upper timestamp_ntz"), spark.createDataFrame(facts, "t timestamp_ntz, x double"),
        "t", [], [total("s", "x"), rows("n")])
    found = {(r.lower, r.upper): (r.n_n, r.s_s) for r in got.collect() if r.n_n}
    wanted = {w: [x for t, x in facts if w[0] <= t < w[1]] for w in windows}
    assert found == {w: (len(x), sum(x)) for w, x in wanted.items() if x}


def test_facts_of_many_windows_are_summed_before_any_exchange(spark):
    facts = spark.range(1000).selectExpr("cast(timestamp_seconds(id) AS timestamp_ntz) AS t", "id AS x")
    plan = facts.groupBy("t").agg(*partials([total("s", "x")]))._jdf.queryExecution().executedPlan().toString()
    base = sumtree.instants(facts, "t", [], [total("s", "x")], None)
    assert plan.index("Exchange") < plan.rindex("HashAggregate")  # printed from the top: an aggregate lies below the exchange
    assert base.count() == 1000 and set(base.columns) == {"at", "s_s", "minute"}


def test_only_places_with_recent_readings_meet_destinations(spark, monkeypatch):
    """Towers at one place are one point, and towers without a recent reading are none."""
    met = []

    def spied(destinations, points, carry):
        met.append(points.count())
        return within_radius(destinations, points, carry)

    monkeypatch.setattr(recommend, "within_radius", spied)
    towers = spark.createDataFrame([(1, 6.5, 3.3), (2, 6.5, 3.3), (3, 6.6, 3.3), (4, 6.5, 3.3)], "id int, lat double, lon double")
    reading = "tower_id int, operator string, signal_dbm double, latency_ms int, dl_mbps double, ul_mbps double, recorded_at timestamp_ntz"
    at = dt.datetime(2024, 1, 1)
    rows = [(1, "MTN", -80.0, 10, 1.0, 1.0, at), (2, "MTN", -90.0, 30, 1.0, 1.0, at - dt.timedelta(minutes=1)),
            (None, "MTN", -10.0, 10, 1.0, 1.0, at), (4, "Glo", -70.0, 10, 1.0, 1.0, at - dt.timedelta(days=3))]
    near = spark.createDataFrame([(7, 6.5, 3.3, 5.0), (8, 6.5, 3.31, 5.0)], "dest_id bigint, lat double, lon double, radius_km double")
    found = recommend.live_evidence(near, spark.createDataFrame(rows, reading), towers, F.lit("2024-01-01 01:00:00").cast("timestamp_ntz"), 24)
    got = {(r.dest_id, r.operator): (r.sample_count, r.avg_signal, r.nearest_km, r.max_age_sec) for r in found.collect()}
    assert got == {(7, "MTN"): (2, -85.0, 0.0, 3660.0), (8, "MTN"): (2, -85.0, 1.1, 3660.0)}
    assert met == [1]


def filled(spark, name, count, values):
    """Rows of one table: the given expressions of ``id``, NULL elsewhere."""
    schema = spark.createDataFrame([], TABLES[name].ddl).schema
    at = "timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(0, 0, 0, cast(pmod(hash(id, {}), 40000000) / 1000 AS decimal(18,3)))"
    values = {"operator": "element_at(array('MTN', 'Glo', NULL, 'Airtel'), cast(1 + pmod(hash(id, 7), 4) AS int))", **values}
    return spark.range(count).select(*[
        F.expr(f"cast({values.get(f.name, 'NULL').replace('AT', at.format(len(name)))} AS {f.dataType.simpleString()})").alias(f.name) for f in schema])


@pytest.mark.parametrize("whole", [True, False])
@pytest.mark.parametrize("kinds", [3, 40])
def test_all_outages_are_correlated_like_a_limited_list(spark, monkeypatch, kinds, whole):
    """Equal windows need no tree, and tables with the same windows and few categories are summed in one pass."""
    steps = []

    def spied(base, *others):
        steps.append("tree")
        return tree(base, *others)

    def stored(df, label):
        steps.append(label)
        return written(df, label)

    tree, written = sumtree.tree, sumtree.written
    monkeypatch.setattr(sumtree, "tree", spied)
    monkeypatch.setattr(sumtree, "written", stored)
    # A quote, a backslash and an empty text are categories like others.
    kind = "element_at(array('it\\'s', 'a\\\\b', '', NULL), cast(1 + pmod(hash(id, 3), 4) AS int))" if kinds == 3 else "concat('k', id % 40)"
    eighth = "pmod(hash(id), 640) / 8D"
    tables = empty_tables(spark) | {
        "readings": filled(spark, "readings", 500, {"recorded_at": "AT", "signal_dbm": eighth, "latency_ms": "id % 50", "dl_mbps": eighth}),
        "network_events": filled(spark, "network_events", 500, {"event_time": "AT", "event_type": kind, "packet_loss_percent": eighth}),
        "hardware_sensors": filled(spark, "hardware_sensors", 500, {"sensor_time": "AT", "temperature_celsius": eighth, "health_status": "'critical'"}),
        "latency_logs": filled(spark, "latency_logs", 500, {"measured_at": "AT", "latency_ms": eighth, "sla_met": "id % 3 = 0"}),
        "handover_records": filled(spark, "handover_records", 500, {"handover_time": "AT", "duration_ms": eighth, "success": "id % 2 = 0"}),
        "dropped_calls": filled(spark, "dropped_calls", 500, {"dropped_at": "AT", "drop_reason": "concat('r', id % 2)"}),
        "technician_logs": filled(spark, "technician_logs", 500, {"started_at": "AT", "duration_min": "id % 90", "travel_km": eighth}),
        "uptime_logs": filled(spark, "uptime_logs", 50, {"log_date": "date'2024-01-01'", "outage_reason": "'A'"}),
    }
    started = "AT" if not whole else "cast(date_trunc('second', AT) AS timestamp_ntz)"
    outages = filled(spark, "outages", 120, {"started_at": f"CASE WHEN id % 19 > 0 THEN {started} END", "signal_type": "'bgp'", "severity": "id"})
    same = outages.unionByName(outages.where("severity < 9"))  # repeated rows stay
    found = {}
    for limit in (500, None):
        got = correlate.correlate_outages(tables | {"outages": same}, limit)
        found[limit] = sorted(repr(sorted(r.asDict(recursive=True).items())) for r in got.collect())
    assert len(found[None]) == 129 and found[None] == found[500]
    assert any("('pre_event_types', {})" not in r for r in found[None])
    assert steps.count("tree") == (1 if kinds == 40 else 0)
    # One table for the blocks that share two hours by operator, one each for hardware and technicians.
    assert steps.count("instants") == (4 if kinds == 40 else 3)


def test_shape_of_windows(spark):
    def shape(*pairs):
        return sumtree.shape_of(spark.createDataFrame(
            [(START + dt.timedelta(seconds=a), START + dt.timedelta(seconds=b)) for a, b in pairs], "lower timestamp_ntz, upper timestamp_ntz"))

    assert shape((0, 7200), (5, 7205)) == sumtree.Shape(120, True)
    assert shape((0, 7200), (5.25, 7205.25)) == sumtree.Shape(120, False)
    assert shape((0, 7200), (5, 7206)) == sumtree.Shape(None, True)
    assert shape((0, 90), (5, 95)) == sumtree.Shape(None, True)
    assert shape() == sumtree.Shape(None, True)
