"""Outage feed: JSON responses with varying field names -> outage rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mastlight.fixed_values import FEED_ENTITIES, FEED_SOURCE
from mastlight.functions import parsing
from mastlight.schemas import TABLES
from mastlight.session import shuffled_for, small_methods, written
from mastlight.sources.store import TableStore, counted

# --- fixed values: field names of the feed, in order of preference -----------------------------
CONTAINERS = ("outages", "events", "results")
START_NAMES = ("started_at", "start", "start_ts", "from", "time_start")
END_NAMES = ("ended_at", "end", "end_ts", "until", "time_end")
SEVERITY_NAMES = ("severity", "score", "value", "level")
SIGNAL_NAMES = ("signal_type", "signal")


def _variant(name: str, row: str = "row") -> str:
    return f"try_variant_get({row}, '$.{name}', 'variant')"


def _kind(name: str) -> str:
    """Type name of a field; an absent field gives NULL, JSON null gives VOID."""
    return f"schema_of_variant({_variant(name)})"


def _text(name: str) -> str:
    return f"try_variant_get(row, '$.{name}', 'string')"


def _truthy(names: Sequence[str]) -> str:
    """Text of the first field that is neither absent, null, empty, zero nor false."""
    choices = [
        f"CASE WHEN {_kind(n)} = 'VOID' OR {_text(n)} = '' THEN NULL "
        f"WHEN {_kind(n)} <> 'STRING' AND ({_text(n)} = 'false' OR try_cast({_text(n)} AS double) = 0) THEN NULL "
        f"ELSE {_text(n)} END"
        for n in names
    ]
    return f"coalesce({', '.join(choices)})"


def _present(names: Sequence[str]) -> str:
    """Kind and text of the first field that is neither absent nor null."""
    choices = [
        f"CASE WHEN {_kind(n)} <> 'VOID' THEN struct({_kind(n)} AS kind, {_text(n)} AS text) END" for n in names
    ]
    return f"coalesce({', '.join(choices)})"


def read_feed(
    spark: SparkSession, path: str, per_line: bool = False, streaming: bool = False
) -> DataFrame:
    """Responses below ``<path>/entity_code=<code>/``: one per file, or one per line.

    ``arrived`` tells where a response stands among all: by its file's time and path, then by its place in the file.
    """
    reader = spark.readStream if streaming else spark.read
    responses = reader.schema("value STRING, entity_code STRING").text(path, wholetext=not per_line).withColumn(
        "arrived", F.struct("_metadata.file_modification_time", "_metadata.file_path", "_metadata.file_block_start"))
    # Entities are a fixed list of five, so this lookup is always broadcast.
    entities = spark.createDataFrame(FEED_ENTITIES, "operator STRING, entity_type STRING, entity_code STRING")
    return responses.join(F.broadcast(entities), "entity_code").select(
        "operator", "entity_type", "entity_code", F.col("value").alias("body"), "arrived"
    )


#: Place of a feed row: response, event within it, signal within that.
PLACE = ("_response", "_event", "_signal")


def outages_from_feed(responses: DataFrame, places: bool = False) -> DataFrame:
    """Rows of the outages table from ``operator, entity_type, entity_code, body`` responses.

    ``places`` adds the columns of PLACE, by which the first of equal rows is known: responses count as they ``arrived``, where
    that is known, and within a file in the order in which they are read, so the result must be written before it is used
    twice, and it must not be a stream.
    """
    entity = ("operator", "entity_type", "entity_code")
    where = list(PLACE[:2]) if places else []
    if places:
        known = ["arrived"] if "arrived" in responses.columns else []
        responses = responses.withColumn("_response", F.struct(*known, F.monotonically_increasing_id().alias("read")))
        entity_ = (*entity, "_response")
    else:
        entity_ = entity
    # A container that is there but holds no list stands for no rows.
    inside = [
        f"CASE WHEN schema_of_variant({_variant(n, 'body')}) <> 'VOID' THEN "
        f"coalesce(try_variant_get(body, '$.{n}', 'array<variant>'), cast(array() AS array<variant>)) END"
        for n in CONTAINERS
    ]
    listed = f"coalesce(try_variant_get(body, '$', 'array<variant>'), {', '.join(inside)})"
    rows = (
        responses.selectExpr(*entity_, "try_parse_json(body) AS body")
        .selectExpr(*entity_, f"{listed} AS listed")
        .selectExpr(*entity_, "posexplode(listed) AS (_event, row)")
    )
    # Texts first and types after, so that no look-up is repeated.
    texts = rows.selectExpr(
        *entity,
        *where,
        f"{_truthy(START_NAMES)} AS start_text",
        f"{_truthy(END_NAMES)} AS end_text",
        f"{_present(SEVERITY_NAMES)} AS level",
        "try_variant_get(row, '$.signal_types', 'array<variant>') AS signal_list",
        f"{_truthy(SIGNAL_NAMES)} AS signal_text",
        "to_json(row) AS raw_data",
    )
    numbers = texts.selectExpr(
        "*",
        f"{parsing.number('start_text')} AS start_number",
        f"{parsing.number('end_text')} AS end_number",
        f"{parsing.number('level.text')} AS level_number",
    )
    severity = "CASE WHEN level.kind = 'BOOLEAN' THEN if(level.text = 'true', 1D, 0D) ELSE level_number END"
    names = (
        "CASE WHEN size(signal_list) > 0 THEN transform(signal_list, "
        "s -> lower(coalesce(nullif(try_cast(s AS string), ''), 'unknown'))) "
        "ELSE array(lower(coalesce(signal_text, 'unknown'))) END"
    )
    typed = numbers.selectExpr(
        *entity,
        *where,
        f"'{FEED_SOURCE}' AS source",
        f"coalesce({severity}, 0D) AS severity",
        f"{names} AS signals",
        f"{parsing.epoch_or_text_timestamp('start_text', 'start_number')} AS started_at",
        f"{parsing.epoch_or_text_timestamp('end_text', 'end_number')} AS ended_at",
        "raw_data",
    ).filter("started_at IS NOT NULL")
    return typed.selectExpr(
        "*",
        "posexplode(signals) AS (_signal, signal_type)",
        f"{parsing.minutes_between('started_at', 'ended_at')} AS duration_min",
    ).select(*TABLES["outages"].columns, *(PLACE if places else ()))


def sync_outages(store: TableStore, responses: DataFrame, nulls_equal: bool = False) -> DataFrame:
    """Add new outages and report found and inserted rows per operator.

    Of equal keys the first in the responses wins.  ``nulls_equal`` also recognises an outage that is still open; by default such rows are added
    again at every sync.
    """
    spark = store.spark
    rows, seen = counted(outages_from_feed(responses, places=True))
    with small_methods(spark):
        found = written(rows, "stage-outages")
    known = _rows_per_operator(store, "before").collect()  # one row per feed operator
    with shuffled_for(spark, seen()):
        store.merge_new("outages", found, PLACE, nulls_equal=nulls_equal)
    before = spark.createDataFrame(known, "operator STRING, before BIGINT")
    return (
        found.groupBy("operator").agg(F.count("*").alias("found"))
        .join(F.broadcast(before), "operator", "left")
        .join(F.broadcast(_rows_per_operator(store, "after")), "operator", "left")
        .selectExpr("operator", "found", "coalesce(after, 0) - coalesce(before, 0) AS inserted")
    )


def _rows_per_operator(store: TableStore, name: str) -> DataFrame:
    operators = [operator for operator, _, _ in FEED_ENTITIES]
    return (
        store.read("outages")
        .filter(F.col("operator").isin(*operators))
        .groupBy("operator")
        .agg(F.count("*").alias(name))
    )
