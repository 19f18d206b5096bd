import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from mastlight.streaming import gate
from mastlight.streaming import outages as outage_streams
from mastlight.streaming import readings as reading_streams
from mastlight.streaming.runs import append_available
from mastlight.streaming.snapshot import Snapshot

START = dt.datetime(2024, 1, 1)
READING = "id bigint, tower_id int, cell_id bigint, city string, operator string, network string, signal_dbm double, " \
          "latency_ms int, dl_mbps double, ul_mbps double, rsrp double, rsrq double, recorded_at timestamp_ntz"


def reading(i, minutes, operator="MTN", signal=-80.0, tower=1):
    return (i, tower, None, "Lagos", operator, "4G", signal, 10, 1.0, 1.0, None, None, START + dt.timedelta(minutes=minutes))


@pytest.fixture
def feed(spark, tmp_path):
    """Adds Parquet files to a streamed folder."""
    class Feed:
        def __init__(self, name, ddl):
            self.path, self.ddl = str(tmp_path / name), ddl
            spark.createDataFrame([], ddl).write.parquet(self.path)

        def add(self, *rows):
            spark.createDataFrame(list(rows), self.ddl).coalesce(1).write.mode("append").parquet(self.path)

        def stream(self):
            return spark.readStream.schema(self.ddl).parquet(self.path)

    return Feed


def test_late_rows_are_dropped_and_windows_close(spark, feed, tmp_path):
    source = feed("readings", READING)
    out, check = str(tmp_path / "out"), str(tmp_path / "check")

    def run():
        append_available(reading_streams.minute_averages(source.stream(), "10 minutes"), out, check)
        return {(r.bucket, r["count"], r.avg_signal) for r in spark.read.parquet(out).collect()}

    source.add(reading(1, 0), reading(2, 0.5, signal=-90.0), reading(3, 5))
    assert run() == set()
    source.add(reading(4, 30))
    assert run() == {(START, 2, -85.0), (START + dt.timedelta(minutes=5), 1, -80.0)}
    source.add(reading(5, 0.2), reading(6, 60))
    assert run() == {(START, 2, -85.0), (START + dt.timedelta(minutes=5), 1, -80.0), (START + dt.timedelta(minutes=30), 1, -80.0)}


def test_late_rows_are_kept(spark, feed, tmp_path):
    source = feed("readings", READING)
    path, check, out, check_out = (str(tmp_path / n) for n in ("gate", "check", "out", "check_out"))
    schema = source.stream().schema
    dropped, sent = 0, []
    parts = [[reading(1, 0), reading(2, 30)], [reading(3, 18), reading(4, 19.5), reading(5, 20.2), reading(6, 100)],
             [reading(7, 40), reading(8, 89.9), reading(9, 90.1), reading(10, 200)], [reading(11, 0)]]
    for rows in parts:
        source.add(*rows)
        sent += rows
        for _ in range(2):  # a run without new rows changes nothing
            gate.gate(source.stream(), "recorded_at", dt.timedelta(minutes=10), path, check, "1 minute")
        query = reading_streams.minute_averages(gate.in_time(spark, path, schema)).writeStream.format("parquet").option(
            "path", out).option("checkpointLocation", check_out).trigger(availableNow=True).start()
        query.awaitTermination()
        dropped += sum(o["numRowsDroppedByWatermark"] for p in query.recentProgress for o in p["stateOperators"])
    late = gate.late(spark, path, schema)
    assert {(r.id, r.batch) for r in late.collect()} == {(3, 1), (4, 1), (7, 2), (8, 2), (11, 3)} and dropped == 0
    counted = gate.notes(spark, path).agg(F.sum("in_time").alias("n"), F.sum("late").alias("late")).first()
    assert (counted.n, counted.late) == (len(sent) - 5, 5)
    closed = spark.read.parquet(out).agg(F.sum("count").alias("n")).first().n
    assert closed == len(sent) - 5 - 1  # the newest minute is open still


def test_latest_state_over_batches(spark, feed, tmp_path):
    source = feed("readings", READING)
    out, check = str(tmp_path / "out"), str(tmp_path / "check")
    source.add(reading(1, 0, tower=1), reading(2, 9, tower=2))
    reading_streams.track_latest(source.stream(), out, check)
    source.add(reading(3, 5, tower=1), reading(4, 4, tower=2))
    reading_streams.track_latest(source.stream(), out, check)
    assert {(r.tower_id, r.id) for r in reading_streams.read_latest(spark, out).collect()} == {(1, 3), (2, 2)}


def test_latest_state_stays_small(spark, tmp_path):
    """Ten batches over the same entities: the folder levels off, and a batch that runs again changes nothing."""
    out, sizes = str(tmp_path / "state"), []
    state = Snapshot(spark, out, "_entity", buckets=4)
    newest = F.struct("recorded_at", "id")
    for batch in range(10):
        rows = [(e, *reading(100 * batch + e, batch * 10 + e, tower=e)) for e in range(40)]
        frame = spark.createDataFrame(rows, "_entity bigint, " + READING)
        state.merge(frame, batch, newest)
        if batch == 6:
            state.merge(frame, batch, newest)
        sizes.append(sum(1 for p in (tmp_path / "state").rglob("*.parquet")))
    assert state.versions() == [8, 9] and sizes[-1] == sizes[3] and max(sizes) <= 2 * 4 + 2
    got = {r.tower_id: r.id for r in reading_streams.read_latest(spark, out).collect()}
    assert got == {e: 900 + e for e in range(40)}
    # One bucket touched: the others keep their folders, and the one that is not named any more goes.
    state.merge(spark.createDataFrame([(7, *reading(5000, 5000, tower=7))], "_entity bigint, " + READING), 10, newest,
                F.col("recorded_at") >= F.lit(START + dt.timedelta(minutes=2000)))
    got = {r.tower_id: r.id for r in reading_streams.read_latest(spark, out).collect()}
    assert got[7] == 5000 and 20 < len(got) < 40  # the rest of its bucket has expired
    state.merge(spark.createDataFrame([], "_entity bigint, " + READING), 11, newest)
    assert reading_streams.read_latest(spark, out).count() == len(got) and state.versions() == [10, 11]


def test_forgotten_entities(spark, feed, tmp_path):
    source = feed("readings", READING)
    out, check = str(tmp_path / "out"), str(tmp_path / "check")
    for day in (0, 3):
        source.add(reading(day, day * 1440, tower=day))
        reading_streams.track_latest(source.stream(), out, check, buckets=1, keep_days=2)
    assert [r.tower_id for r in reading_streams.read_latest(spark, out).collect()] == [3]


def test_overlapping_windows_are_made_from_panes(spark, feed, tmp_path):
    source = feed("readings", READING)
    out, check = str(tmp_path / "out"), str(tmp_path / "check")
    source.add(*[reading(i, i / 10, signal=-float(i % 7)) for i in range(600)])
    source.add(reading(1000, 300))
    stream = reading_streams.rolling_summary(source.stream())
    query = (stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", check)
             .trigger(availableNow=True).start())
    query.awaitTermination()
    # 600 readings lie in 12 panes: neither operator ever holds a reading for each window that covers it.
    assert max(o["numRowsUpdated"] for p in query.recentProgress for o in p["stateOperators"]) <= 12 * 12 + 12
    rows = {r.bucket: (r["count"], r.avg_signal) for r in spark.read.parquet(out).collect()}
    for bucket, (count, signal) in rows.items():
        inside = [-float(i % 7) for i in range(600) if bucket <= START + dt.timedelta(minutes=i / 10) < bucket + dt.timedelta(hours=1)]
        assert count == len(inside) and abs(signal - sum(inside) / count) < 1e-9
    assert len(rows) == 23


def test_repeats_are_dropped_across_batches(spark, feed, tmp_path):
    source = feed("events", "event_id string, event_time timestamp_ntz")
    out, check = str(tmp_path / "out"), str(tmp_path / "check")
    for rows in ([("A", START), ("A", START), ("B", START)], [("A", START), ("C", START)]):
        source.add(*rows)
        append_available(outage_streams.first_arrivals(source.stream(), ["event_id"], "event_time"), out, check)
    assert sorted(r.event_id for r in spark.read.parquet(out).collect()) == ["A", "B", "C"]


def test_signals_before_outages_in_any_arrival_order(spark, feed, tmp_path):
    outage = "id bigint, operator string, started_at timestamp_ntz"
    outages, readings = feed("outages", outage), feed("readings", READING)
    out, check = str(tmp_path / "out"), str(tmp_path / "check")

    def run():
        outage_streams.track_signals_before(outages.stream(), readings.stream(), out, check, "6 hours")
        return {r.id: (r.sample_count, r.pre_avg_signal) for r in outage_streams.read_signals_before(spark, out).collect()}

    def hour(n):
        return START + dt.timedelta(hours=n)

    outages.add((1, "MTN", hour(2)), (2, "Glo", hour(2)), (4, None, hour(2)))
    readings.add(reading(1, 0), reading(2, 119, signal=-90.0), reading(3, 120))
    assert run() == {}  # no second is closed yet
    readings.add(reading(4, 60, signal=-100.0), reading(5, 60, operator="Airtel"))
    outages.add((3, "Airtel", hour(3)), (5, "MTN", hour(30)))
    run()
    # Both watermarks pass the starts: sums, and outages without any reading, come out.
    readings.add(reading(6, 60 * 40))
    outages.add((6, "Glo", hour(40)))
    run()
    outages.add((7, "Glo", hour(41)))
    readings.add(reading(7, 60 * 41))
    assert run() == {1: (3, -90.0), 2: (0, None), 3: (1, -80.0), 4: (0, None), 5: (0, None)}


def test_all_outages_come_with_their_whole_windows_at_the_end(spark, feed, tmp_path):
    """Open outages have the sums so far; starts and readings within one second are told apart."""
    outage = "id bigint, operator string, started_at timestamp_ntz"
    outages, readings = feed("outages", outage), feed("readings", READING)
    half = START + dt.timedelta(hours=2, milliseconds=500)
    outages.add((1, "MTN", half), (2, "MTN", START + dt.timedelta(hours=50)), (3, "Glo", None))
    readings.add(reading(1, 0), reading(2, 120, signal=-90.0), reading(3, 60 * 50 - 1, signal=-100.0))
    out = str(tmp_path / "out")
    outage_streams.track_signals_before(outages.stream(), readings.stream(), out, str(tmp_path / "check"))
    assert {r.id for r in outage_streams.read_signals_before(spark, out).collect()} == {1}
    got = outage_streams.read_signals_before(spark, out, still_open=True).collect()
    assert {r.id: (r.sample_count, r.pre_avg_signal) for r in got} == {1: (1, -90.0), 2: (1, -100.0), 3: (0, None)}


def test_outages_that_come_late_are_closed_once(spark, feed, tmp_path):
    outage = "id bigint, operator string, started_at timestamp_ntz"
    outages, readings = feed("outages", outage), feed("readings", READING)
    out, check = str(tmp_path / "out"), str(tmp_path / "check")

    def run():
        outage_streams.track_signals_before(outages.stream(), readings.stream(), out, check)
        return {r.id: r.sample_count for r in outage_streams.read_signals_before(spark, out).collect()}

    outages.add((1, "MTN", START + dt.timedelta(hours=1)), (2, "MTN", START + dt.timedelta(hours=9)))
    readings.add(reading(1, 0), reading(2, 60 * 9))
    assert run() == {1: 1}
    outages.add((3, "MTN", START + dt.timedelta(hours=2)), (4, "MTN", START + dt.timedelta(hours=9, minutes=30)))
    assert run() == {1: 1, 3: 1}
    assert {r.id: r.sample_count for r in outage_streams.read_signals_before(spark, out, still_open=True).collect()} == {1: 1, 2: 0, 3: 1, 4: 1}


def test_ingest_resumes_and_skips_bad_lines(spark, tmp_path):
    lines, out, check = tmp_path / "lines", str(tmp_path / "out"), str(tmp_path / "check")
    lines.mkdir()
    towers = spark.createDataFrame([(7, 55, 1)], "id int, cell_id bigint, samples int")
    for part, cell in enumerate((55, 56)):
        sent = [{"signal_dbm": -80, "cell_id": cell, "recorded_at": "2024-01-02T00:00:00Z"}, {"signal_dbm": "x"}]
        (lines / f"{part}.json").write_text("\n".join(map(json.dumps, sent)) + "\nbroken\n")
        reading_streams.ingest_readings(spark.readStream.text(str(lines)), towers, out, check, "2024-01-31")
    got = spark.read.parquet(out).select("cell_id", "tower_id", F.col("event_date").cast("string").alias("d")).collect()
    assert sorted((r.cell_id, r.tower_id, r.d) for r in got) == [(55, 7, "2024-01-02"), (56, None, "2024-01-02")]
