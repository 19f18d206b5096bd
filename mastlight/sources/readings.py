"""Device readings: JSON requests -> typed rows with a resolved tower."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mastlight.fixed_values import MAX_BULK_READINGS, READING_RANGES
from mastlight.functions import parsing
from mastlight.operators.latest import best_tower_per_cell
from mastlight.schemas import TABLES

# --- fixed values: reasons for refusing a reading ------------------------------------------------
SIGNAL_ERROR = "signal_dbm is required and must be numeric"
TIME_ERROR = "recorded_at must be a valid date/time"
# Reasons of our own for whole requests.
LENGTH_ERROR = "too many readings in one request"
UNREADABLE_ERROR = "no list of readings"

MEASURES = ("signal_dbm", "dl_mbps", "ul_mbps", "rsrp", "rsrq")
PLAIN = ("tower_id", "cell_id", "city", "operator", "network", "latency_ms")


def _text(reading: str, name: str) -> str:
    return f"try_variant_get({reading}, '$.{name}', 'string')"


def _kind(reading: str, name: str) -> str:
    return f"schema_of_variant(try_variant_get({reading}, '$.{name}', 'variant'))"


def api_number(kind: str, text: str) -> str:
    """Number of a JSON field.  Only an absent field is missing: null and blank text count as 0."""
    return (
        f"CASE WHEN {kind} = 'VOID' OR {parsing.stripped(text)} = '' THEN 0D "
        f"WHEN {kind} = 'BOOLEAN' THEN if({text} = 'true', 1D, 0D) ELSE {parsing.number(text)} END"
    )


def reading_time(kind: str, text: str, now: str) -> str:
    """Time of a reading: absent, null, empty, zero or false mean ``now``; a number is epoch milliseconds."""
    millis = f"try_cast({text} AS double)"
    return (
        f"CASE WHEN {kind} IS NULL OR {kind} = 'VOID' OR {text} = '' THEN {now} "
        f"WHEN {kind} = 'STRING' THEN {parsing.timestamp(text)} "
        f"WHEN {text} = 'false' OR {millis} = 0 THEN {now} "
        f"ELSE {parsing.epoch_millis(millis)} END"
    )


def sql_time(now: dt.datetime | str | None) -> str:
    """SQL of a wall-clock time; None means the time of the query or micro-batch."""
    if now is None:
        return "cast(current_timestamp() AS timestamp_ntz)"
    return f"timestamp_ntz'{now}'"


def type_readings(
    readings: DataFrame, now: dt.datetime | str | None, column: str = "_reading", keep: Sequence[str] = ()
) -> DataFrame:
    """Typed columns and ``error`` (NULL when accepted) of JSON readings in a variant column, and the columns to keep."""
    fields = [f"{_text(column, n)} AS {n}" for n in (*PLAIN, *MEASURES, "recorded_at")]
    kinds = [f"{_kind(column, n)} AS _kind_{n}" for n in (*MEASURES, "recorded_at")]
    ranges = READING_RANGES
    measures = [f"{api_number(f'_kind_{n}', n)} AS {n}" for n in MEASURES]
    typed = readings.selectExpr(*keep, *fields, *kinds).selectExpr(
        *keep,
        f"{parsing.leading_int('tower_id')} AS tower_id",
        f"{parsing.leading_int('cell_id', 'bigint')} AS cell_id",
        f"{parsing.clean_text('city', 'Unknown', 60)} AS city",
        f"{parsing.clean_text('operator', 'Unknown', 20)} AS operator",
        f"{parsing.network_generation('network', unknown='4G')} AS network",
        f"{parsing.leading_int('latency_ms')} AS latency_ms",
        *measures,
        f"{reading_time('_kind_recorded_at', 'recorded_at', sql_time(now))} AS recorded_at",
    )
    limited = {n: f"cast({parsing.clamp(n, *ranges[n])} AS {'int' if n == 'latency_ms' else 'double'}) AS {n}" for n in ranges}
    return typed.selectExpr(
        *keep,
        *[limited.get(c, c) for c in TABLES["readings"].columns],
        f"CASE WHEN signal_dbm IS NULL THEN '{SIGNAL_ERROR}' WHEN recorded_at IS NULL THEN '{TIME_ERROR}' END AS error",
    )


def device_readings(
    lines: DataFrame, now: dt.datetime | str | None = None, body: str = "value", keep: str | None = None
) -> DataFrame:
    """One JSON reading per line; refused readings keep their ``error`` and typed columns.

    ``keep`` (``expression AS name``) adds a column of the lines.
    """
    kept = [keep] if keep else []
    names = [k.rsplit(" AS ", 1)[1] for k in kept]
    return type_readings(lines.selectExpr(*kept, f"try_parse_json({body}) AS _reading"), now, keep=names)


def _judged(requests: DataFrame, now: dt.datetime | str | None, body: str, most: int | None) -> DataFrame:
    """Bulk requests with the first refusal in them: ``_at`` (NULL: the request as a whole) and ``_why`` (NULL: none).

    That is decided inside the row, so no shuffle is needed.
    """
    signal = api_number(_kind("r", "signal_dbm"), _text("r", "signal_dbm"))
    time = reading_time(_kind("r", "recorded_at"), _text("r", "recorded_at"), sql_time(now))
    why = f"CASE WHEN ({signal}) IS NULL THEN '{SIGNAL_ERROR}' WHEN ({time}) IS NULL THEN '{TIME_ERROR}' END"
    too_long = f"size(_listed) > {most}" if most is not None else "false"
    return (
        requests.selectExpr(f"{body} AS _request", f"try_variant_get(try_parse_json({body}), '$.readings', 'array<variant>') AS _listed")
        .selectExpr("*", f"CASE WHEN NOT ({too_long}) THEN transform(_listed, r -> {why}) END AS _reasons")
        .selectExpr("*", "array_position(transform(_reasons, w -> w IS NOT NULL), true) AS _first")
        .selectExpr(
            "_request", "_listed", "cast(CASE WHEN _first > 0 THEN _first - 1 END AS int) AS _at",
            f"CASE WHEN _listed IS NULL THEN '{UNREADABLE_ERROR}' WHEN {too_long} THEN '{LENGTH_ERROR}' "
            "WHEN _first > 0 THEN element_at(_reasons, cast(_first AS int)) END AS _why")
    )


def bulk_readings(
    requests: DataFrame, now: dt.datetime | str | None = None, body: str = "value", *, strict: bool = False,
    most: int | None = MAX_BULK_READINGS,
) -> DataFrame:
    """Readings of bulk requests (``{"readings": [...]}`` per line), whole requests only.

    A request is refused when it is unreadable, longer than ``most`` (None: any length) or any reading in it is
    invalid; ``bulk_refusals`` lists those.  ``strict`` raises with the first reason instead.
    """
    judged = _judged(requests, now, body, most)
    if strict:
        problem = judged.filter("_why IS NOT NULL").select("_why").limit(1).collect()
        if problem:
            raise ValueError(problem[0]._why)
    accepted = judged.filter("_why IS NULL").selectExpr("explode(_listed) AS _reading")
    return type_readings(accepted, now).drop("error")


def bulk_refusals(
    requests: DataFrame, now: dt.datetime | str | None = None, body: str = "value", *, most: int | None = MAX_BULK_READINGS
) -> DataFrame:
    """The refused bulk requests: the request, the place of its first bad reading (NULL: all of it), the reason."""
    return _judged(requests, now, body, most).filter("_why IS NOT NULL").selectExpr(
        "_request AS request", "_at AS position", "_why AS error")


def resolve_towers(readings: DataFrame, towers: DataFrame) -> DataFrame:
    """Fill a missing (or zero) tower id from the cell's best tower.

    Rows that need no lookup get a spread key that matches nothing, so neither NULL cells nor
    resolved rows pile up in one task if the join is shuffled.
    """
    needs = "coalesce(tower_id, 0) = 0 AND coalesce(cell_id, 0) <> 0"
    spread = "pmod(xxhash64(recorded_at, signal_dbm, tower_id), 4096L) + 1"
    keyed = readings.selectExpr(
        "*",
        f"CASE WHEN {needs} THEN 0L ELSE {spread} END AS _lane",
        "cast(coalesce(cell_id, 0) AS bigint) AS _cell",
    )
    best = best_tower_per_cell(towers).selectExpr(
        "0L AS _lane", "cast(cell_id AS bigint) AS _cell", "cast(id AS int) AS _found"
    )
    out = keyed.join(best, ["_lane", "_cell"], "left")
    resolved = F.expr("CASE WHEN _lane = 0 THEN _found ELSE tower_id END")
    return out.withColumn("tower_id", resolved).select(*readings.columns)


def check_all_valid(readings: DataFrame) -> DataFrame:
    """Fail the batch with the first reason when any reading was refused."""
    problem = readings.filter("error IS NOT NULL").select("error").limit(1).collect()
    if problem:
        raise ValueError(problem[0].error)
    return readings.select(*TABLES["readings"].columns)
