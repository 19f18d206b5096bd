"""Running streams: catch up with what is there, write files, or keep per-batch results."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def event_time(stream: DataFrame, column: str, delay: str) -> DataFrame:
    """Make a wall-clock column the event time, tolerating rows ``delay`` late."""
    return stream.withColumn(column, F.col(column).cast("timestamp")).withWatermark(column, delay)


def children(spark: SparkSession, folder: str, prefix: str) -> list[str]:
    """Names below a folder that begin with the prefix; none if the folder is not there."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    system = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not system.exists(path):
        return []
    return [name for s in system.listStatus(path) if (name := s.getPath().getName()).startswith(prefix)]


def batches_of(spark: SparkSession, folder: str) -> list[int]:
    """The batches that have written a folder ``batch=<id>`` to its end, ascending."""
    names = [n for n in children(spark, folder, "batch=") if children(spark, f"{folder}/{n}", "_SUCCESS")]
    return sorted(int(name.split("=")[1]) for name in names)


def batches_so_far(spark: SparkSession, folder: str, schema: str) -> DataFrame:
    """The rows of all finished folders ``batch=<id>``, with their batch; ``schema`` is for when there is none yet."""
    found = [f"{folder}/batch={b}" for b in batches_of(spark, folder)]
    if not found:
        return spark.createDataFrame([], f"{schema}, batch INT")
    return spark.read.option("basePath", folder).parquet(*found)


def append_available(
    stream: DataFrame, path: str, checkpoint: str, partition_by: str | None = None
) -> None:
    """Process all data available now and append the result rows to Parquet files."""
    writer = stream.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint)
    if partition_by:
        writer = writer.partitionBy(partition_by)
    writer.outputMode("append").trigger(availableNow=True).start().awaitTermination()


def keep_batches(
    stream: DataFrame,
    path: str,
    checkpoint: str,
    mode: str = "append",
    shape: Callable[[DataFrame], DataFrame] | None = None,
) -> None:
    """Process all data available now; each micro-batch writes its own folder ``batch=<id>``.

    A batch that is run again after a failure overwrites its own folder, so results count once.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        rows = shape(batch) if shape else batch
        rows.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    (
        stream.writeStream.foreachBatch(write)
        .outputMode(mode)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
        .awaitTermination()
    )
