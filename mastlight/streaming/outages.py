"""Outage streams: idempotent arrival, and signals before each outage while both sides stream."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from mastlight.operators.measures import merges, partial_names, results
from mastlight.operators.preceding import preceding_sums
from mastlight.operators.sumtree import instants
from mastlight.plans.correlate import BLOCKS
from mastlight.session import written
from mastlight.sources.feed import PLACE, outages_from_feed
from mastlight.sources.store import TableStore
from mastlight.streaming.runs import batches_of, batches_so_far, event_time, keep_batches

#: The block whose facts stream in beside the outages.
READINGS = BLOCKS["readings"]
OUTAGE = ("id", "operator", "started_at")
#: Up to where a run has closed outages: the watermark, and the last batch of outages that it saw.
NOTE = "watermark TIMESTAMP_NTZ, last BIGINT"


def first_arrivals(stream: DataFrame, key: Sequence[str], time: str, delay: str = "1 day") -> DataFrame:
    """Each natural key once, remembering keys for as long as repeats may arrive."""
    return event_time(stream, time, delay).dropDuplicatesWithinWatermark(list(key))


def sync_feed(store: TableStore, responses: DataFrame, checkpoint: str) -> None:
    """Add the outages of all feed responses that have arrived since the last run.

    Runs to the end of the available responses, so it can be started on any schedule.  Responses
    may overlap: outages that are known (also open ones) are not added again, which makes a
    repeated micro-batch harmless too.
    """

    def merge(batch: DataFrame, batch_id: int) -> None:
        found = written(outages_from_feed(batch, places=True), "stage-outages")
        store.merge_new("outages", found, PLACE, nulls_equal=True)

    (
        responses.writeStream.foreachBatch(merge)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
        .awaitTermination()
    )


def track_signals_before(
    outages: DataFrame, readings: DataFrame, path: str, checkpoint: str, delay: str = "1 hour"
) -> None:
    """Sum the readings in the two hours before each outage, as either side arrives.

    Readings are summed per operator and instant as they come, so no reading meets an outage; outages are kept beside them.
    The watermark is the earlier of both sides' latest times, less ``delay``.  When it has passed an outage's start, the outage
    is closed: its window is made up once, from the sums of its time, and comes out.  Late outages are closed by the
    next run; readings count for the outages that are not closed when they come.
    """
    keep_batches(outages.select(*OUTAGE), f"{path}/outages", f"{checkpoint}/outages")
    keep_batches(
        readings, f"{path}/instants", f"{checkpoint}/readings",
        shape=lambda batch: instants(batch, READINGS.time, READINGS.keys, READINGS.measures),
    )
    _close(outages.sparkSession, path, delay)


def _close(spark: SparkSession, path: str, delay: str) -> None:
    """Write the sums of the outages that have become closed; then a note up to where outages are closed."""
    outages, sums = _arrived(spark, path), _instants(spark, path)
    ends = outages.agg(F.max("started_at").alias("o")).join(sums.agg(F.max("at").alias("r")))
    # ``least`` of a side without rows would be the other side's time.
    mark = f"CASE WHEN o IS NOT NULL AND r IS NOT NULL THEN least(o, r) - INTERVAL {delay} END"
    last = max(batches_of(spark, f"{path}/outages"), default=-1)
    note = ends.select(F.expr(mark).alias("watermark"), F.lit(last).cast("long").alias("last")).first()
    run = len(batches_of(spark, f"{path}/notes"))
    fresh = outages.where(_closed(note.watermark, note.last) & ~_known(spark, path))
    _sums_before(fresh, sums).write.mode("overwrite").parquet(f"{path}/closed/batch={run}")
    spark.createDataFrame([(note.watermark, note.last)], NOTE).coalesce(1).write.mode("overwrite").parquet(f"{path}/notes/batch={run}")


def _arrived(spark: SparkSession, path: str) -> DataFrame:
    return batches_so_far(spark, f"{path}/outages", "id BIGINT, operator STRING, started_at TIMESTAMP_NTZ")


def _instants(spark: SparkSession, path: str) -> DataFrame:
    names = ", ".join(f"{n} {'BIGINT' if n.endswith('_n') else 'DOUBLE'}" for n in partial_names(READINGS.measures))
    return batches_so_far(spark, f"{path}/instants", f"operator STRING, at TIMESTAMP_NTZ, {names}, minute BIGINT")


def _closed(watermark: dt.datetime | None, last: int) -> Column:
    """Whether an outage was closed by a run that saw batches up to ``last``."""
    if watermark is None:
        return F.lit(False)
    return F.coalesce((F.col("started_at") <= F.lit(watermark)) & (F.col("batch") <= last), F.lit(False))


def _known(spark: SparkSession, path: str) -> Column:
    """Whether an outage was closed by a finished run."""
    note = batches_so_far(spark, f"{path}/notes", NOTE).orderBy(F.desc("batch")).first()
    return _closed(note.watermark, note.last) if note else F.lit(False)


def _sums_before(outages: DataFrame, sums: DataFrame) -> DataFrame:
    """The outages with the partial sums of their windows."""
    lower = F.expr(f"started_at - INTERVAL {READINGS.hours} HOURS AS lower")
    windows = outages.select(*READINGS.keys, lower, F.col("started_at").alias("upper")).distinct()
    found = preceding_sums(windows, sums, READINGS.keys, READINGS.measures).withColumnRenamed("upper", "started_at")
    return outages.join(found, [*READINGS.keys, "started_at"], "left").select(*OUTAGE, *partial_names(READINGS.measures))


def read_signals_before(spark: SparkSession, path: str, still_open: bool = False) -> DataFrame:
    """The outages that are closed, with their sums; those without a reading have count 0.

    ``still_open`` adds the others, with the sums so far: all outages, as at the end of the data.
    """
    runs = len(batches_of(spark, f"{path}/notes"))
    rows = spark.read.parquet(*[f"{path}/closed/batch={n}" for n in range(runs)])
    if still_open:
        rows = rows.unionByName(_sums_before(_arrived(spark, path).where(~_known(spark, path)), _instants(spark, path)))
    return rows.groupBy(*OUTAGE).agg(*merges(READINGS.measures)).select(*OUTAGE, *results(READINGS.measures))
