"""Row normalisation: text columns in, typed columns plus a ``_valid`` flag out."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mastlight.fixed_values import MNC_OPERATORS, RADIO_NETWORKS
from mastlight.functions import geo, parsing
from mastlight.schemas import TABLES
from mastlight.sources.layouts import Field, Layout

_EPOCH = "1970-01-01"


def typed(spec: Field, raw: str) -> str:
    """SQL of the field's value from its source text."""
    if spec.kind == "text":
        return parsing.clean_text(raw, "" if spec.required else spec.fallback, spec.length)
    if spec.kind == "network":
        return parsing.network_generation(raw)
    if spec.kind == "boolean":
        return parsing.boolean(raw, spec.words)
    readers = {
        "number": parsing.number,
        "int": parsing.leading_int,
        "timestamp": parsing.timestamp,
        "date": parsing.date,
        "month": parsing.month_start,
    }
    return readers[spec.kind](raw)


def normalise(raw: DataFrame, layout: Layout, keep: tuple[str, ...] = ()) -> DataFrame:
    """Typed target columns, ``_valid``, and the ``keep`` columns of the input.

    Layouts with an ``id_prefix`` leave a missing id NULL for ``fill_ids``.
    """
    picked, values, bad = [], [], ["false"]
    for spec in layout.fields:
        source = parsing.first_present(raw.columns, spec.names)
        if spec.epoch_when_missing:
            source = f"coalesce({source}, '{_EPOCH}')"
        picked.append(f"{source} AS {spec.target}")
        value = typed(spec, spec.target)
        if spec is layout.id_field:
            value = f"substring(nullif(trim({spec.target}), ''), 1, {spec.length})"
        values.append(f"{value} AS {spec.target}")
        if spec.required:
            bad.append(f"{spec.target} = ''" if spec.kind == "text" else f"{spec.target} IS NULL")
    # Three steps, so that no expression is repeated inside another.
    return (
        raw.selectExpr(*picked, *keep)
        .selectExpr(*values, *keep)
        .selectExpr(*[f.target for f in layout.fields], f"NOT ({' OR '.join(bad)}) AS _valid", *keep)
    )


def fill_ids(rows: DataFrame, layout: Layout, ordinal: str = "_ordinal") -> DataFrame:
    """Give rows without an id the prefix followed by their row number."""
    spec = layout.id_field
    made = f"concat('{layout.id_prefix}', cast({ordinal} AS string))"
    return rows.withColumn(
        spec.target, F.expr(f"substring(coalesce({spec.target}, {made}), 1, {spec.length})")
    )


def _lookup(table: dict, key: str, default: str) -> str:
    cases = " ".join(
        f"WHEN {parsing.quoted(k) if isinstance(k, str) else k} THEN {parsing.quoted(v)}" for k, v in table.items()
    )
    return f"CASE {key} {cases} ELSE {parsing.quoted(default)} END"


def _count_or(name: str, default: int, to: str = "int") -> str:
    return f"cast(coalesce(nullif({parsing.leading_int(name, to)}, 0), {default}) AS {to}) AS {name}"


def normalise_towers(raw: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Tower rows: coordinates and ids must be numbers and coordinates not zero."""
    out = raw.selectExpr(
        f"{parsing.leading_int('cell_id', 'bigint')} AS cell_id",
        f"{parsing.clean_text('radio', 'GSM', 10)} AS radio",
        *[f"{parsing.leading_int(name)} AS {name}" for name in ("mcc", "mnc", "lac")],
        f"{parsing.leading_float('lon')} AS lon",
        f"{parsing.leading_float('lat')} AS lat",
        _count_or("range_m", 0),
        _count_or("samples", 1),
        _count_or("average_signal", 0),
        _count_or("created_at", 0, "bigint"),
        _count_or("updated_at", 0, "bigint"),
        f"{_lookup(MNC_OPERATORS, parsing.leading_int('mnc'), 'Unknown')} AS operator",
        f"{_lookup(RADIO_NETWORKS, 'radio', '2G')} AS network",
        *keep,
    )
    known = "lat <> 0 AND lon <> 0 AND cell_id IS NOT NULL AND mcc IS NOT NULL AND mnc IS NOT NULL AND lac IS NOT NULL"
    out = out.withColumn("_valid", F.expr(f"coalesce({known}, false)"))
    city = F.when(F.col("_valid"), geo.nearest_city(F.col("lat"), F.col("lon")))
    columns = [c for c in TABLES["towers"].columns if c != "id"]
    return out.withColumn("city", city).select(*columns, "_valid", *keep)
