"""Filtered top-k lists, described by specs."""

from __future__ import annotations

import datetime as dt
import math
import re
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mastlight.functions.parsing import network_parameter
from mastlight.schemas import PARTITION_COLUMN


def leading_int(value: object) -> int | None:
    """Integer prefix of a request parameter."""
    found = re.match(r"\s*([+-]?\d+)", str(value)) if value is not None else None
    return int(found.group(1)) if found else None


def clamp_limit(value: object, default: int, most: int) -> int:
    """Row limit from a parameter: unreadable or zero means the default, then 1..most."""
    return min(max(leading_int(value) or default, 1), most)


def capped(df: DataFrame, value: object, default: int, most: int) -> DataFrame:
    """At most as many rows as the parameter says; None means all."""
    return df if value is None else df.limit(clamp_limit(value, default, most))


def parse_time(name: str, value: object) -> dt.datetime:
    """UTC wall time of a parameter; refuses what is not a date/time."""
    if isinstance(value, dt.datetime):
        moment = value
    elif isinstance(value, dt.date):
        moment = dt.datetime(value.year, value.month, value.day)
    else:
        try:
            moment = dt.datetime.fromisoformat(str(value).strip())
        except ValueError:
            raise ValueError(f"{name} is not a date or time") from None
    if moment.tzinfo is not None:
        moment = moment.astimezone(dt.UTC).replace(tzinfo=None)
    return moment


def parse_box(value: str, checked: bool = True) -> tuple[float, float, float, float]:
    """minLat,minLon,maxLat,maxLon."""
    try:
        low_lat, low_lon, high_lat, high_lon = (float(p) for p in str(value).split(",")[:4])
    except ValueError:
        raise ValueError("bbox takes four numbers: south, west, north, east") from None
    box = (low_lat, low_lon, high_lat, high_lon)
    if checked and not all(math.isfinite(x) for x in box):
        raise ValueError("bbox takes four numbers: south, west, north, east")
    return box


@dataclass(frozen=True)
class Match:
    """Filter on a parameter.

    ``kind``: ``equals`` (any of ``columns`` equals the value cut to ``length``), ``network``
    (canonical generation) or ``flag`` (true/false).  ``all`` switches a filter off unless
    ``literal_all``.
    """

    param: str
    columns: tuple[str, ...]
    kind: str = "equals"
    length: int | None = None
    literal_all: bool = False

    def condition(self, value: object) -> Column | None:
        if self.kind == "flag":
            if value is None or value == "all":
                return None
            word = str(value).lower()
            if word not in ("true", "false"):
                raise ValueError(f"{self.param} is either true or false")
            return F.col(self.columns[0]) == F.lit(word == "true")
        if value is None or value == "" or (value == "all" and not self.literal_all):
            return None
        wanted = network_parameter(str(value)) if self.kind == "network" else value
        if self.length:
            wanted = str(wanted)[: self.length]
        tests = [F.col(c) == F.lit(wanted) for c in self.columns]
        return tests[0] if len(tests) == 1 else tests[0] | tests[1]


def same(param: str, column: str | None = None, length: int | None = None, literal_all: bool = False) -> Match:
    return Match(param, (column or param,), "equals", length, literal_all)


@dataclass(frozen=True)
class ListSpec:
    """A list query: columns, filters, ordering and limits of one table."""

    table: str
    columns: tuple[str, ...]
    matches: tuple[Match, ...]
    order: tuple[tuple[str, str], ...]
    time: str | None = None
    time_is_date: bool = False
    box: str | None = None
    default_limit: int = 200
    most: int | None = 1000

    def sort_columns(self) -> list[tuple[str, str]]:
        """The ordering made total: every other output column breaks ties."""
        used = {c for c, _ in self.order}
        return [*self.order, *((c, "asc_nulls_last") for c in self.columns if c not in used)]


def conditions(spec: ListSpec, params: Mapping[str, object], has_partitions: bool = False) -> list[Column]:
    """The conjuncts a parameter set switches on."""
    out = [c for m in spec.matches if (c := m.condition(params.get(m.param))) is not None]
    if spec.box and params.get("bbox"):
        low_lat, low_lon, high_lat, high_lon = parse_box(params["bbox"], spec.box == "checked")
        out += [F.col("lat").between(low_lat, high_lat), F.col("lon").between(low_lon, high_lon)]
    for name in ("from", "until"):
        if not spec.time or not params.get(name):
            continue
        moment = parse_time(name, params[name])
        bound: object = moment.date() if spec.time_is_date else moment
        literal = F.lit(bound) if spec.time_is_date else F.lit(moment.isoformat(sep=" ")).cast("timestamp_ntz")
        column, day = F.col(spec.time), F.col(PARTITION_COLUMN)
        out.append(column >= literal if name == "from" else column <= literal)
        if has_partitions:
            out.append(day >= F.lit(moment.date()) if name == "from" else day <= F.lit(moment.date()))
    return out


def ordering(pairs: Sequence[tuple[str, str]]) -> list[Column]:
    return [getattr(F, how)(name) for name, how in pairs]


def listing(df: DataFrame, spec: ListSpec, params: Mapping[str, object] | None = None) -> DataFrame:
    """Run a list query; columns the frame lacks come out as NULL text.  ``limit=None`` lists all rows."""
    params = params or {}
    unknown = set(params) - {m.param for m in spec.matches} - {"limit", "from", "until", "bbox"}
    if unknown:
        raise ValueError(f"{spec.table} has no filter {sorted(unknown)}")
    for condition in conditions(spec, params, PARTITION_COLUMN in df.columns):
        df = df.filter(condition)
    wanted = params.get("limit", spec.default_limit)
    ordered = df.select(*spec.columns).orderBy(*ordering(spec.sort_columns()))
    if wanted is None:
        return ordered
    if spec.most is None:
        limit = leading_int(wanted)
        if limit is None:
            raise ValueError("limit is not a number")
    else:
        limit = clamp_limit(wanted, spec.default_limit, spec.most)
    return ordered.limit(limit)
