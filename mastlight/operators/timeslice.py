"""Time predicates that reach the scan, and windows anchored at a table's newest row."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mastlight.schemas import PARTITION_COLUMN


def as_time(value: dt.datetime | str | Column) -> Column:
    """A UTC wall-time column from a Python datetime, an ISO text or a column."""
    if isinstance(value, Column):
        return value
    if isinstance(value, str):
        value = dt.datetime.fromisoformat(value)
    if value.tzinfo is not None:
        value = value.astimezone(dt.UTC).replace(tzinfo=None)
    return F.lit(value.isoformat(sep=" ")).cast("timestamp_ntz")


def hours_before(time: Column, hours: int) -> Column:
    return time - F.make_dt_interval(hours=F.lit(hours))


def at_or_after(df: DataFrame, column: str, lower: Column, strict: bool = False) -> DataFrame:
    """Rows from ``lower`` on (after it when ``strict``); prunes date partitions where there are any."""
    if PARTITION_COLUMN in df.columns:
        df = df.filter(F.col(PARTITION_COLUMN) >= lower.cast("date"))
    return df.filter(F.col(column) > lower if strict else F.col(column) >= lower)


def before(df: DataFrame, column: str, upper: Column) -> DataFrame:
    """Rows earlier than ``upper``; prunes date partitions where there are any."""
    if PARTITION_COLUMN in df.columns:
        df = df.filter(F.col(PARTITION_COLUMN) <= upper.cast("date"))
    return df.filter(F.col(column) < upper)


def newest(df: DataFrame, column: str) -> DataFrame:
    """The rows that can hold the table's newest time: its last date partition, or all rows."""
    if PARTITION_COLUMN in df.columns:
        last = df.agg(F.max(PARTITION_COLUMN)).scalar()
        df = df.filter(F.col(PARTITION_COLUMN) == last)
    return df


def last_hours(df: DataFrame, column: str, hours: int) -> DataFrame:
    """Rows within ``hours`` of the newest row of the whole table.

    The bound is a scalar subquery with its arithmetic inside, so Spark hands its value to the
    Parquet reader as a plain comparison.
    """
    bound = newest(df, column).agg(F.max(column) - F.make_dt_interval(hours=F.lit(hours)))
    return at_or_after(df, column, bound.scalar())


def last_days(df: DataFrame, column: str, days: int) -> DataFrame:
    """Rows within ``days`` of the newest row, for a date or timestamp column."""
    if df.schema[column].dataType.typeName() == "date":
        bound = newest(df, column).agg(F.date_sub(F.max(column), days))
    else:
        bound = newest(df, column).agg(F.max(column) - F.make_dt_interval(days=F.lit(days)))
    return at_or_after(df, column, bound.scalar())
