"""Live readings: ingest, rolling averages and the latest state per entity."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mastlight.operators.latest import READING_COLUMNS, entity_key
from mastlight.operators.measures import average, merges, partials, results, rows
from mastlight.schemas import PARTITION_COLUMN, TABLES
from mastlight.session import remove_folder
from mastlight.sources.readings import device_readings, resolve_towers
from mastlight.streaming.runs import event_time
from mastlight.streaming.snapshot import Snapshot


def ingest_readings(
    lines: DataFrame, towers: DataFrame, path: str, checkpoint: str, now: dt.datetime | str | None = None,
    refused_path: str | None = None,
) -> None:
    """Normalise JSON lines, resolve towers against the static table, append by date.

    Each micro-batch is parsed once, and what it was judged to be is split: accepted readings go below ``path``, refused lines
    with the reason below ``refused_path`` (by default a folder ``<path>_refused``), both in a folder ``batch=<id>`` that a
    repeated batch overwrites.
    """
    path = path.rstrip("/")
    refused = (refused_path or f"{path}_refused").rstrip("/")

    def take(batch: DataFrame, batch_id: int) -> None:
        spark, folder = batch.sparkSession, f"{path}_judged/batch={batch_id}"
        batch.write.mode("overwrite").parquet(folder)
        judged = spark.read.schema(batch.schema).parquet(folder)
        accepted = judged.filter("error IS NULL").select(*TABLES["readings"].columns)
        dated = resolve_towers(accepted, towers).withColumn(PARTITION_COLUMN, F.col("recorded_at").cast("date"))
        dated.write.mode("overwrite").partitionBy(PARTITION_COLUMN).parquet(f"{path}/batch={batch_id}")
        judged.filter("error IS NOT NULL").select("line", "error").write.mode("overwrite").parquet(f"{refused}/batch={batch_id}")
        remove_folder(spark, folder)

    (
        device_readings(lines, now, keep="value AS line").writeStream.foreachBatch(take)
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
    )


MEASURES = (
    average("avg_signal", "signal_dbm"),
    average("avg_latency", "latency_ms"),
    average("avg_dl", "dl_mbps"),
    average("avg_ul", "ul_mbps"),
    rows("count"),
)


def windowed_averages(
    readings: DataFrame, keys: list[str], length: str, step: str | None = None, delay: str = "10 minutes"
) -> DataFrame:
    """Averages per key and time window; a window comes out once the watermark has passed it.

    Overlapping windows are made up from panes as long as the step: a reading enters one pane, and a closed
    pane's sums enter the windows that cover it.
    """
    timed = event_time(readings, "recorded_at", delay)
    grouped = timed.groupBy(F.window("recorded_at", step or length).alias("_window"), *keys).agg(*partials(MEASURES))
    if step:
        whole = F.window(F.window_time("_window"), length, step)
        grouped = grouped.groupBy(whole.alias("_whole"), *keys).agg(*merges(MEASURES)).withColumnRenamed("_whole", "_window")
    return grouped.select(
        F.col("_window.start").cast("timestamp_ntz").alias("bucket"), *keys, *results(MEASURES)
    )


def minute_averages(readings: DataFrame, delay: str = "10 minutes") -> DataFrame:
    """Per-minute averages by operator, network and city."""
    return windowed_averages(readings, ["operator", "network", "city"], "1 minute", None, delay)


def rolling_summary(readings: DataFrame, delay: str = "10 minutes") -> DataFrame:
    """One-hour averages by operator, every five minutes."""
    return windowed_averages(readings, ["operator"], "1 hour", "5 minutes", delay)


def _entity_rows(readings: DataFrame) -> DataFrame:
    columns = [c for c in ("id", *READING_COLUMNS) if c in readings.columns]
    return readings.select(entity_key(readings).alias("_entity"), *columns)


def track_latest(
    readings: DataFrame, path: str, checkpoint: str, buckets: int = 16, keep_days: int | None = None
) -> None:
    """Keep the newest reading per entity as a versioned snapshot, which each micro-batch brings up to date.

    With ``keep_days`` an entity is forgotten, when its bucket is next written, once the batch is so much newer than it.
    """
    def take(batch: DataFrame, batch_id: int) -> None:
        state = Snapshot(batch.sparkSession, path, "_entity", buckets)
        keep = None
        if keep_days is not None:
            newest = batch.agg(F.max("recorded_at").alias("t")).first().t
            keep = None if newest is None else F.col("recorded_at") >= F.lit(newest - dt.timedelta(days=keep_days))
        state.merge(batch, batch_id, F.struct("recorded_at", "id"), keep)

    (
        _entity_rows(readings).writeStream.foreachBatch(take).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start().awaitTermination()
    )


def read_latest(spark: SparkSession, path: str) -> DataFrame:
    """The current state: the last version of the snapshot."""
    state = Snapshot(spark, path, "_entity")
    versions = state.versions()
    if not versions:
        raise ValueError(f"no snapshot at {path}")
    folders = list(state.folders(versions[-1]).values())
    if not folders:
        raise ValueError(f"the snapshot at {path} is empty")
    return spark.read.parquet(*folders).drop("_entity")
