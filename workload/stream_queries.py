"""Streams run to the end of the available data and read back."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mastlight.functions.numeric import rounded
from mastlight.functions.scoring import freshness_score
from mastlight.operators.timeslice import as_time
from mastlight.schemas import TABLES
from mastlight.session import new_work_folder
from mastlight.sources import feed
from mastlight.sources.store import TableStore
from mastlight.streaming import gate
from mastlight.streaming import outages as outage_streams
from mastlight.streaming import readings as reading_streams
from mastlight.streaming.runs import append_available
from workload import raw_files
from workload.core_oracles import BLOCK_SQL, NOW, avg, block_sql, over
from workload.views import AS_OF, Tables, duck_view

Query = Callable[[SparkSession, str], DataFrame]
DELAY_MINUTES = 10


#: Parts of time in which a stream's rows arrive, one run each.
ARRIVALS = 3


def in_time_order(
    tables: Tables, times: dict[str, str], run: Callable[[dict[str, DataFrame]], None], delayed: str = "false"
) -> None:
    """Let the rows of some views arrive in parts, earlier times first, and run the stream after each part.

    ``times`` names the time column of each view; the runs share their checkpoint, so each goes on where the last one ended.
    ``delayed`` rows all come with the last part.
    """
    spark, folder = tables.spark, new_work_folder(tables.spark, "arriving")
    ends = [tables[name].agg(F.min(time).alias("low"), F.max(time).alias("high")).first() for name, time in times.items()]
    low, high = min(e.low for e in ends), max(e.high for e in ends)
    cuts = [low + (high - low) * i / ARRIVALS for i in range(1, ARRIVALS)]
    for part in range(ARRIVALS):
        streams = {}
        for name, time in times.items():
            rows = tables[name]
            place = sum(F.coalesce(F.col(time) >= F.lit(cut), F.lit(False)).cast("int") for cut in cuts)
            rows = rows.where(F.when(F.expr(delayed), ARRIVALS - 1).otherwise(place) == part)
            rows.write.mode("append").parquet(f"{folder}/{name}")
            streams[name] = spark.readStream.schema(rows.schema).parquet(f"{folder}/{name}")
        run(streams)


def _folders(spark: SparkSession, label: str) -> tuple[str, str]:
    folder = new_work_folder(spark, label)
    return f"{folder}/table", f"{folder}/checkpoint"


def _ingested(refused: bool) -> Query:
    """Lines that arrive in three parts: what was accepted, or what was refused and why."""
    def run(spark: SparkSession, folder: str) -> DataFrame:
        tables = Tables(spark, folder)
        lines = new_work_folder(spark, "lines")
        path, checkpoint = _folders(spark, "ingest")
        for part in range(ARRIVALS):
            raw_files.reading_lines(tables).where(f"k % {ARRIVALS} = {part}").select("value").write.mode("append").text(lines)
            reading_streams.ingest_readings(spark.readStream.text(lines), tables["towers"], path, checkpoint, AS_OF)
        if refused:
            return spark.read.parquet(f"{path}_refused").groupBy("error").agg(F.count("*").alias("lines"))
        return spark.read.parquet(path).drop("event_date", "batch")

    return run


def _averages(build: Callable[[DataFrame, str], DataFrame]) -> Query:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        path, checkpoint = _folders(spark, "averages")
        in_time_order(Tables(spark, folder), {"readings": "recorded_at"}, lambda streams: append_available(
            build(streams["readings"], f"{DELAY_MINUTES} minutes"), path, checkpoint))
        out = spark.read.parquet(path)
        return out.withColumns({c: rounded(F.col(c), 6) for c in ("avg_signal", "avg_latency", "avg_dl", "avg_ul")})

    return run


def _latest(spark: SparkSession, folder: str) -> DataFrame:
    path, checkpoint = _folders(spark, "latest")
    in_time_order(Tables(spark, folder), {"readings": "recorded_at"}, lambda streams: reading_streams.track_latest(
        streams["readings"], path, checkpoint))
    return reading_streams.read_latest(spark, path)


def _arrivals(spark: SparkSession, folder: str) -> DataFrame:
    """Every other event arrives twice."""
    path, checkpoint = _folders(spark, "arrivals")

    def run(streams: dict[str, DataFrame]) -> None:
        repeated = streams["network_events"].withColumn("copy", F.expr("explode(sequence(0, affected_users % 2))")).drop("copy")
        append_available(outage_streams.first_arrivals(repeated, ["event_id"], "event_time"), path, checkpoint)

    in_time_order(Tables(spark, folder), {"network_events": "event_time"}, run)
    out = spark.read.parquet(path)
    return out.withColumn("event_time", F.col("event_time").cast("timestamp_ntz"))


def _signals(spark: SparkSession, folder: str) -> DataFrame:
    """All outages: the closed ones as they came out, the others as they stand at the end of the data."""
    tables = Tables(spark, folder)
    path, checkpoint = _folders(spark, "signals")
    in_time_order(tables, {"outages": "started_at", "readings": "recorded_at"}, lambda streams: outage_streams.track_signals_before(
        streams["outages"], streams["readings"], path, checkpoint))
    return outage_streams.read_signals_before(spark, path, still_open=True)


def _late(spark: SparkSession, folder: str) -> DataFrame:
    """Every tenth reading comes with the last part: those that come too late for their minute."""
    path, checkpoint = _folders(spark, "late")
    tables = Tables(spark, folder)
    readings = tables["readings"]
    sums, sums_checkpoint = _folders(spark, "in-time")

    def run(streams: dict[str, DataFrame]) -> None:
        gate.gate(streams["readings"], "recorded_at", dt.timedelta(minutes=DELAY_MINUTES), path, checkpoint, "1 minute")
        append_available(reading_streams.minute_averages(gate.in_time(spark, path, readings.schema), f"{DELAY_MINUTES} minutes"),
                         sums, sums_checkpoint)

    in_time_order(tables, {"readings": "recorded_at"}, run, delayed="id % 10 = 0")
    return gate.late(spark, path, readings.schema).select("id", "operator", "recorded_at")


def _feed(spark: SparkSession, folder: str) -> DataFrame:
    path = raw_files.write_raw_feed(Tables(spark, folder))
    store_path, checkpoint = _folders(spark, "feed")
    store = TableStore(spark, store_path)
    responses = feed.read_feed(spark, path, per_line=True, streaming=True)
    outage_streams.sync_feed(store, responses, checkpoint)
    return store.read("outages").select(*[c for c in TABLES["outages"].columns if c != "raw_data"])


def _freshness(spark: SparkSession, folder: str) -> DataFrame:
    readings = Tables(spark, folder)["readings"]
    age = F.unix_seconds(as_time(AS_OF).cast("timestamp")) - F.unix_seconds(F.col("recorded_at").cast("timestamp"))
    return readings.select(freshness_score(age).alias("freshness")).groupBy("freshness").agg(F.count("*").alias("readings"))


def stream_queries() -> dict[str, Query]:
    return {
        "stream_readings_ingest": _ingested(False),
        "stream_readings_refused": _ingested(True),
        "stream_minute_averages": _averages(reading_streams.minute_averages),
        "stream_rolling_summary": _averages(reading_streams.rolling_summary),
        "stream_late_readings": _late,
        "stream_latest_state": _latest,
        "stream_first_arrivals": _arrivals,
        "stream_signals_before_outages": _signals,
        "stream_outage_feed": _feed,
        "readings_freshness": _freshness,
    }


def _closed(length_minutes: int) -> str:
    """Windows whose end the watermark reached."""
    return (f"bucket + INTERVAL {length_minutes} MINUTE <= "
            f"(SELECT MAX(recorded_at) FROM readings) - INTERVAL {DELAY_MINUTES} MINUTE")


_AVERAGES = (f"{avg('signal_dbm', 6)} AS avg_signal, {avg('latency_ms', 6)} AS avg_latency, "
             f"{avg('dl_mbps', 6)} AS avg_dl, {avg('ul_mbps', 6)} AS avg_ul, COUNT(*) AS count")


def stream_oracles() -> dict[str, str]:
    typed = raw_files.typed_readings_sql(NOW)
    columns = "cell_id, city, operator, network, signal_dbm, latency_ms, dl_mbps, ul_mbps, rsrp, rsrq, recorded_at"
    return {
        "stream_readings_ingest": (
            f"WITH typed AS ({typed}), towers AS ({duck_view('towers')}), "
            "best AS (SELECT cell_id AS cell, arg_max(id, samples * 100000 - id) AS found FROM towers GROUP BY cell_id) "
            f"SELECT CASE WHEN COALESCE(tower_id, 0) = 0 THEN found ELSE tower_id END AS tower_id, {columns} "
            "FROM typed LEFT JOIN best ON cell = cell_id WHERE error IS NULL"),
        "stream_readings_refused": f"WITH typed AS ({typed}) SELECT error, COUNT(*) AS lines FROM typed WHERE error IS NOT NULL GROUP BY error",
        "stream_minute_averages": over("readings", steps={
            "cut": "SELECT *, date_trunc('minute', recorded_at) AS bucket FROM readings"},
            sql=f"SELECT bucket, operator, network, city, {_AVERAGES} FROM cut WHERE {_closed(1)} "
                "GROUP BY bucket, operator, network, city"),
        "stream_rolling_summary": over("readings", steps={
            "cut": "SELECT *, time_bucket(INTERVAL 5 MINUTE, recorded_at) - INTERVAL 5 MINUTE * s.n AS bucket "
                   "FROM readings CROSS JOIN (SELECT unnest(range(12)) AS n) s"},
            sql=f"SELECT bucket, operator, {_AVERAGES} FROM cut WHERE {_closed(60)} GROUP BY bucket, operator"),
        "stream_late_readings": over("readings", steps={
            "parts": "SELECT *, MIN(recorded_at) OVER () + (MAX(recorded_at) OVER () - MIN(recorded_at) OVER ()) * 2 / 3 AS last_part FROM readings",
            "seen": "SELECT MAX(recorded_at) AS newest FROM parts WHERE recorded_at < last_part AND id % 10 <> 0"},
            sql="SELECT id, operator, recorded_at FROM parts WHERE id % 10 = 0 AND date_trunc('minute', recorded_at) + INTERVAL 1 MINUTE "
                f"<= (SELECT newest FROM seen) - INTERVAL {DELAY_MINUTES} MINUTE"),
        "stream_latest_state": over("readings", steps={
            "keyed": "SELECT *, COALESCE(CAST(tower_id AS BIGINT), -cell_id, -id) AS entity FROM readings"},
            sql="SELECT * EXCLUDE (entity) FROM (SELECT DISTINCT ON (entity) * FROM keyed "
                "ORDER BY entity, recorded_at DESC, id DESC) newest"),
        "stream_first_arrivals": over("network_events", sql="SELECT * FROM network_events"),
        "stream_signals_before_outages": over(
            "outages", BLOCK_SQL["readings"][0], steps={"chosen": "SELECT * FROM outages"}, sql=block_sql("readings")),
        "stream_outage_feed": raw_files.feed_rows_sql(),
        "readings_freshness": over("readings", sql=(
            f"SELECT CASE WHEN age <= 3600 THEN 1e2 WHEN age <= 21600 THEN 75e0 ELSE 5e1 END AS freshness, COUNT(*) AS readings "
            f"FROM (SELECT epoch_us({NOW}) // 1000000 - epoch_us(recorded_at) // 1000000 AS age FROM readings) ages GROUP BY 1")),
    }
