"""Late rows kept: a stream is split into rows in time and late ones before an operator with a watermark can drop any.

The gate tracks its own watermark: the latest event time of the batches before, less the delay.  A row is late by the rule that the
operator behind applies: its time, or the end of its window, is not after the watermark.  Rows in time, late rows, and
then a note of what the batch held are written in folders of the batch.  The operator reads the rows in time; as it
sees batches no earlier than the gate, its own watermark is never ahead, and it drops none of them.  A batch that
is run again finds its note and writes nothing twice.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mastlight.streaming.runs import batches_of

NOTE = "batch long, newest timestamp_ntz, in_time long, late long"


def notes(spark: SparkSession, path: str) -> DataFrame:
    """A row for each batch: its latest event time, and how many rows were in time and late."""
    found = [f"{path}/notes/batch={b}" for b in batches_of(spark, f"{path}/notes")]
    return spark.read.schema(NOTE).parquet(*found) if found else spark.createDataFrame([], NOTE)


def _lateness(time: str, watermark: dt.datetime | None, window: str | None) -> Column:
    if watermark is None:
        return F.lit(False)
    end = F.window(F.col(time).cast("timestamp"), window)["end"].cast("timestamp_ntz") if window else F.col(time)
    return F.coalesce(end <= F.lit(watermark), F.lit(False))


def gate(stream: DataFrame, time: str, delay: dt.timedelta, path: str, checkpoint: str, window: str | None = None) -> None:
    """Split what has arrived; ``window`` is the length of the windows of the operator behind, if it has any.

    Rows without a time are in time: the operator behind treats them as it would without a gate.
    """
    def split(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        if batch_id in batches_of(spark, f"{path}/notes"):
            return
        before = notes(spark, path).agg(F.max("newest").alias("t")).first().t
        # Event times count to the millisecond in a watermark.
        watermark = before and before.replace(microsecond=before.microsecond // 1000 * 1000) - delay
        marked = batch.withColumn("_late", _lateness(time, watermark, window))
        marked.write.mode("overwrite").partitionBy("_late").parquet(f"{path}/split/batch={batch_id}")
        judged = spark.read.schema(T.StructType([*batch.schema.fields, T.StructField("_late", T.BooleanType())])).parquet(
            f"{path}/split/batch={batch_id}")
        judged.agg(F.lit(batch_id).cast("long").alias("batch"), F.max(F.col(time).cast("timestamp_ntz")).alias("newest"),
                   F.count_if(~F.col("_late")).alias("in_time"), F.count_if("_late").alias("late")).coalesce(1).write.mode(
            "overwrite").parquet(f"{path}/notes/batch={batch_id}")

    stream.writeStream.foreachBatch(split).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def in_time(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The rows in time, as a stream."""
    return spark.readStream.schema(schema).parquet(f"{path}/split/batch=*/_late=false")


def late(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The late rows so far, with the batch in which they came."""
    found = batches_of(spark, f"{path}/notes")
    whole = T.StructType([*schema.fields, T.StructField("_late", T.BooleanType()), T.StructField("batch", T.LongType())])
    if not found:
        return spark.createDataFrame([], whole).drop("_late")
    rows = spark.read.option("basePath", f"{path}/split").schema(whole).parquet(*[f"{path}/split/batch={b}" for b in found])
    return rows.where("_late").drop("_late")
