"""Session helpers: a tuned builder, and the shared scratch folder."""

from __future__ import annotations

import os
import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import AbstractContextManager, contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "mastlight", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the jobs expect: UTC wall time and adaptive execution."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.ui.enabled", "false")
        # Recording the Python call site of every column costs more than building the plans.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def pin_utc(spark: SparkSession) -> None:
    """All stored timestamps are UTC wall time, so casts must not shift them."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only where the setting is absent on a local master is one made, and recorded on the session; on a cluster a
    folder of the driver's machine would be out of the executors' reach.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors can reach")
        folder = tempfile.mkdtemp(prefix="mastlight-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def new_work_folder(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder for one job's tables and stream checkpoints."""
    return os.path.join(shared_folder(spark), "mastlight", f"{label}-{uuid.uuid4().hex}")


def pinned(df: DataFrame) -> DataFrame:
    """Checkpoint in the shared folder: computed once, read by every later step."""
    context = df.sparkSession.sparkContext
    if not context.getCheckpointDir():
        context.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint()


#: Work tables made within the innermost ``passing_tables``, or None outside of any.
_PASSING: ContextVar[list[str] | None] = ContextVar("passing", default=None)


def written(df: DataFrame, label: str) -> DataFrame:
    """Write to a fresh table in the shared folder and read it back."""
    return written_at(df, label)[0]


def written_at(df: DataFrame, label: str) -> tuple[DataFrame, str]:
    """Like ``written``, with the folder, for who removes it as soon as nothing reads the table any more."""
    folder = new_work_folder(df.sparkSession, label)
    df.write.parquet(folder)
    passing = _PASSING.get()
    if passing is not None:
        passing.append(folder)
    return df.sparkSession.read.parquet(folder), folder


@contextmanager
def passing_tables(spark: SparkSession, keep: int = 1) -> Iterator[None]:
    """Remove all tables that were written within, but for the last one, which holds the outcome (``keep=0``: that one too).

    What is still to be run afterwards must read no other of them.
    """
    outer, made = _PASSING.get(), []
    token = _PASSING.set(made)
    try:
        yield
    finally:
        _PASSING.reset(token)
    left = made[-keep:] if keep else []
    for folder in made[: len(made) - len(left)]:
        remove_folder(spark, folder)
    if outer is not None:
        outer += left


@contextmanager
def set_within(spark: SparkSession, settings: dict[str, str]) -> Iterator[None]:
    """Settings that hold within; the session's own come back afterwards."""
    before = {name: spark.conf.get(name) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


def small_methods(spark: SparkSession) -> AbstractContextManager[None]:
    """For jobs whose rows pass long expressions: the JVM compiles no method above 8000 bytes, so Spark is told to split those."""
    return set_within(spark, {"spark.sql.codegen.hugeMethodLimit": "8000"})


def passing_shuffles(spark: SparkSession) -> AbstractContextManager[None]:
    """For jobs that write what they shuffle: a write's shuffle files go as it ends, not when the driver happens to collect its garbage."""
    return set_within(spark, {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"})


#: Rows that a task of a shuffle is to sort, about.
ROWS_OF_A_TASK = 100_000


@contextmanager
def shuffled_for(spark: SparkSession, rows: int, each: int | None = None) -> Iterator[None]:
    """For a job that sorts so many rows after a shuffle: the shuffle's partitions follow them, so a task's memory does not.

    ``each`` is about how many rows a task gets, ``ROWS_OF_A_TASK`` if it is not given.

    Where the cores alone make tasks that small nothing changes; else partitions are not put together again, as that is done by
    bytes and down to the number of cores.  More partitions that the session asks for stay.
    """
    wanted, most = -(-rows // (each or ROWS_OF_A_TASK)), "spark.sql.shuffle.partitions"
    held = {most: str(max(int(spark.conf.get(most)), wanted)), "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    if wanted <= spark.sparkContext.defaultParallelism:
        held = {}
    with set_within(spark, held):
        yield


#: Rows of a file of a table that is staged for sorting, and bytes of such files that a task reads.
ROWS_OF_A_STAGED_FILE, BYTES_OF_A_SORTING_TASK = 1_000_000, 16 << 20


def staging(spark: SparkSession) -> AbstractContextManager[None]:
    """For writing a table that ``sorting_staged`` reads: small on disk, in files that a task can sort without spilling."""
    return set_within(spark, {
        "spark.sql.parquet.compression.codec": "zstd", "spark.sql.files.maxRecordsPerFile": str(ROWS_OF_A_STAGED_FILE)})


def sorting_staged(spark: SparkSession) -> AbstractContextManager[None]:
    """For a job that sorts rows in the tasks that read them: what they spill lies on the disk until a task ends, so tasks are small."""
    most = spark._jsparkSession.sessionState().conf().filesMaxPartitionBytes()
    return set_within(spark, {"spark.sql.files.maxPartitionBytes": str(min(most, BYTES_OF_A_SORTING_TASK))})


def folder_exists(spark: SparkSession, folder: str) -> bool:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path)


def remove_folder(spark: SparkSession, folder: str) -> None:
    """Delete a folder that only the caller's job has written and nothing reads any more."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
