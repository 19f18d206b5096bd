"""One row per key by an ordering."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def pick_first(df: DataFrame, key: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """First row per key.  Each task keeps one candidate per key before the shuffle."""
    ranked = df.withColumn("_nth", F.row_number().over(Window.partitionBy(*key).orderBy(*order)))
    return ranked.filter("_nth = 1").drop("_nth")


def best_tower_per_cell(towers: DataFrame) -> DataFrame:
    """Per cell the tower with the most samples; the smaller id wins ties."""
    slim = towers.select("id", "cell_id", "samples")
    return pick_first(slim, ["cell_id"], [F.desc_nulls_first("samples"), F.asc("id")]).select("id", "cell_id")


def entity_key(df: DataFrame) -> Column:
    """What a reading belongs to: its tower, else its cell, else itself."""
    own = F.col("id") if "id" in df.columns else F.xxhash64(*df.columns)
    return F.coalesce(
        F.col("tower_id").cast("bigint"), F.negative("cell_id"), F.negative(own.cast("bigint"))
    )


READING_COLUMNS = (
    "tower_id", "cell_id", "city", "operator", "network", "signal_dbm", "latency_ms",
    "dl_mbps", "ul_mbps", "rsrp", "rsrq", "recorded_at",
)


def latest_readings(readings: DataFrame, limit: int | str | None = 10000) -> DataFrame:
    """Newest reading per entity, the first ``limit`` entities in key order (1..20000; None: all)."""
    from mastlight.operators.listing import capped

    tie = [F.desc("id")] if "id" in readings.columns else []
    keyed = readings.withColumn("_entity", entity_key(readings))
    newest = pick_first(keyed, ["_entity"], [F.desc_nulls_first("recorded_at"), *tie])
    columns = [c for c in READING_COLUMNS if c in readings.columns]
    return capped(newest.orderBy("_entity"), limit, 10000, 20000).select(*columns)
