"""All queries and their SQL, in one place."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from mastlight.session import pin_utc
from workload.core_oracles import core_oracles
from workload.core_queries import Query, core_queries
from workload.load_queries import load_oracles, load_queries
from workload.stream_queries import stream_oracles, stream_queries


def _in_utc(query: Query) -> Query:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        pin_utc(spark)
        return query(spark, folder)

    return run


def all_queries() -> dict[str, Query]:
    merged = {**core_queries(), **load_queries(), **stream_queries()}
    return {name: _in_utc(query) for name, query in merged.items()}


def all_oracles() -> dict[str, str]:
    return {**core_oracles(), **load_oracles(), **stream_oracles()}
