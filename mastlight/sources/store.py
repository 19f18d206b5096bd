"""Parquet table store: typed reads, appends, and insert-if-absent on the natural key."""

from __future__ import annotations

import os
from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from mastlight.schemas import PARTITION_COLUMN, TABLES
from mastlight.session import folder_exists


def counted(rows: DataFrame, **more: Column) -> tuple[DataFrame, Callable[..., int]]:
    """Rows that are counted as they are written, and what tells the count afterwards (or that of a named column)."""
    seen = Observation()
    # Where nothing was written Spark may have left the counter out.
    return rows.observe(seen, F.count(F.lit(1)).alias("rows"), *[c.alias(n) for n, c in more.items()]), (
        lambda name="rows": int(seen.get.get(name) or 0))


def first_by_key(
    rows: DataFrame, key: Sequence[str], order: Sequence[Column | str], nulls_equal: bool = False
) -> DataFrame:
    """First row per key.  A key with a NULL part equals nothing unless ``nulls_equal``.

    ``row_number() = 1`` is limited per task before the shuffle, so a key that holds a large share
    of the rows sends one row per task.
    """
    parts: list[Column | str] = list(key)
    if not nulls_equal:
        has_null = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in key])
        parts.append(F.when(has_null, F.struct(*order)))
    ranked = rows.withColumn("_nth", F.row_number().over(Window.partitionBy(*parts).orderBy(*order)))
    return ranked.filter("_nth = 1").drop("_nth")


def absent_from(
    rows: DataFrame, target: DataFrame, key: Sequence[str], nulls_equal: bool = False
) -> DataFrame:
    """Rows whose key the target does not hold."""
    known = target.select(*[F.col(k).alias(f"_known_{k}") for k in key])
    tests = [
        F.col(k).eqNullSafe(F.col(f"_known_{k}")) if nulls_equal else F.col(k) == F.col(f"_known_{k}")
        for k in key
    ]
    return rows.join(known, reduce(lambda a, b: a & b, tests), "left_anti")


class TableStore:
    """Tables as Parquet folders below ``root``; timed tables are partitioned by event date."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root

    def path(self, name: str) -> str:
        return os.path.join(self.root, name)

    def _stored_columns(self, name: str) -> str:
        extra = "source STRING, imported_at TIMESTAMP_NTZ"
        ddl = f"{TABLES[name].ddl}, {extra}" if name != "outages" else f"{TABLES[name].ddl}, imported_at TIMESTAMP_NTZ"
        return f"{ddl}, {PARTITION_COLUMN} DATE" if TABLES[name].event_time else ddl

    def read(self, name: str) -> DataFrame:
        """The table, or an empty frame of its schema before the first load."""
        if not folder_exists(self.spark, self.path(name)):
            return self.spark.createDataFrame([], self._stored_columns(name))
        return self.spark.read.schema(self._stored_columns(name)).parquet(self.path(name))

    def _write(self, name: str, rows: DataFrame, mode: str) -> int:
        """Write the rows; returns how many went by."""
        event_time = TABLES[name].event_time
        if event_time is None:
            rows, seen = counted(rows)
            rows.write.mode(mode).parquet(self.path(name))
            return seen()
        dated = rows.withColumn(PARTITION_COLUMN, F.col(event_time).cast("date"))
        # Rebalancing keeps files large and splits a date that holds much of the load.
        dated, seen = counted(dated.hint("rebalance", PARTITION_COLUMN))
        dated.write.mode(mode).partitionBy(PARTITION_COLUMN).parquet(self.path(name))
        return seen()

    def _stamped(self, name: str, rows: DataFrame, source: str | None) -> DataFrame:
        columns = TABLES[name].columns
        out = rows.select(*columns)
        if "source" not in columns:
            out = out.withColumn("source", F.lit(source).cast("string"))
        return out.withColumn("imported_at", F.current_timestamp().cast("timestamp_ntz"))

    def append(self, name: str, rows: DataFrame, source: str | None = None) -> int:
        """Add rows without any duplicate check; returns their number."""
        return self._write(name, self._stamped(name, rows, source), "append")

    def merge_new(
        self,
        name: str,
        rows: DataFrame,
        order: Sequence[Column | str],
        source: str | None = None,
        nulls_equal: bool = False,
    ) -> int:
        """Add the rows whose natural key is new, and return their number; of equal keys within ``rows`` the first wins.

        By default a NULL key part never conflicts, so such rows are added at every load.
        """
        key, event_time = TABLES[name].natural_key, TABLES[name].event_time
        target = self.read(name)
        if event_time in key:
            # Equal keys have equal dates: only the partitions the load touches can hold them.
            span = rows.agg(F.min(event_time).cast("date").alias("lo"), F.max(event_time).cast("date").alias("hi"))
            day = F.col(PARTITION_COLUMN)
            target = target.filter((day >= span.select("lo").scalar()) & (day <= span.select("hi").scalar()))
        fresh = absent_from(first_by_key(rows, key, order, nulls_equal), target, key, nulls_equal)
        return self.append(name, fresh, source)

    def replace(self, name: str, rows: DataFrame, source: str | None = None) -> None:
        """Drop the table's content and write the rows; they must not be read from the table."""
        self._write(name, self._stamped(name, rows, source), "overwrite")

    def clear(self, name: str) -> None:
        """Empty the table."""
        empty = self.spark.createDataFrame([], TABLES[name].ddl)
        self._write(name, self._stamped(name, empty, None), "overwrite")

    def count(self, name: str) -> int:
        return self.read(name).count()
