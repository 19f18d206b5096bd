"""Several grouping levels of one relation from a single scan."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mastlight.operators.measures import Measure, merges, partials, results


def grouped_levels(
    df: DataFrame, keys: Sequence[str], levels: Sequence[str | None], measures: Sequence[Measure]
) -> DataFrame:
    """One row per value of each level (a key name, or None for the grand total).

    The raw rows are aggregated once by all keys together; the levels are grouping sets over that
    small result, so the rows are not multiplied by the number of levels.  The grand total is
    always there, even for an empty input.  Output: level, key, measures.
    """
    base = df.groupBy(*keys).agg(*partials(measures))
    frames = [key for key in levels if key is not None]
    sets = base.groupingSets([[F.col(k)] for k in frames], *keys).agg(
        F.grouping_id().alias("_set"), *merges(measures)
    )
    width = len(keys)
    masks = {k: (2**width - 1) - 2 ** (width - 1 - list(keys).index(k)) for k in frames}
    level = F.coalesce(*[F.when(F.col("_set") == mask, F.lit(k)) for k, mask in masks.items()])
    value = F.coalesce(*[F.when(F.col("_set") == mask, F.col(k)) for k, mask in masks.items()])
    out = sets.select(level.alias("level"), value.alias("key"), *results(measures))
    if None in levels:
        overall = base.agg(*merges(measures)).select(
            F.lit("total").alias("level"), F.lit(None).cast("string").alias("key"), *results(measures)
        )
        out = out.unionByName(overall)
    return out


def top_of_level(levels: DataFrame, level: str, limit: int | None, order: Sequence[Column]) -> DataFrame:
    """All rows of the other levels, and the first ``limit`` of this one (None: all)."""
    if limit is None:
        return levels
    place = F.row_number().over(Window.partitionBy("level").orderBy(*order, F.asc_nulls_last("key")))
    ranked = levels.withColumn("_place", place)
    return ranked.filter((F.col("level") != level) | (F.col("_place") <= limit)).drop("_place")
