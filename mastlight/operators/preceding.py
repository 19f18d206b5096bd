"""Statistics of fact rows in the window before each anchor time.

A plain range join would match every fact row with every window that covers it.  For a few windows each fact
row is snapped to the part of the time line it lies in: windows are cut into clock cells (minutes or hours), and
cells are cut again at the window edges.  Parts do not overlap and no window edge lies inside one, so a
fact row joins exactly one part, which is broadcast, and is summed up there, before the shuffle.  Many windows are made up from
sums over the time line (``sumtree``), which facts enter without meeting a window.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mastlight.operators.measures import Measure, merges, partial_names, partials
from mastlight.operators.sumtree import Part, shape_of, sums_of_instants, sums_of_tables
from mastlight.operators.timeslice import at_or_after, before
from mastlight.session import written

#: Windows whose parts may be broadcast: those of a limited list.
MOST_BOUNDED = 1000
#: Different categories that are counted in a column each, if windows are many.
MOST_KINDS = 32
#: Column with the category counts of a window: array of (category, total), unordered.
CATEGORIES = "_categories"
NO_CATEGORIES = "cast(array() AS array<struct<category: string, total: bigint>>)"


def _floor(time: str, cell: str) -> Column:
    return F.expr(f"cast(date_trunc('{cell}', {time}) AS timestamp_ntz)")


def parts_of(windows: DataFrame, keys: Sequence[str], cell: str) -> DataFrame:
    """All cells the windows touch, cut at every window edge: keys, cell, [part, part_end).  For few windows."""
    first, last = f"cast(date_trunc('{cell}', lower) AS timestamp_ntz)", f"cast(date_trunc('{cell}', upper) AS timestamp_ntz)"
    points = windows.selectExpr(
        *keys, f"explode(concat(sequence({first}, {last}, INTERVAL 1 {cell}), array(lower, upper))) AS part")
    points = points.distinct().withColumn("cell", _floor("part", cell))
    following = F.lead("part").over(Window.partitionBy(*keys, "cell").orderBy("part"))
    return points.withColumn("part_end", F.coalesce(following, F.expr(f"cell + INTERVAL 1 {cell}")))


def _between(windows: DataFrame, facts: DataFrame, time: str) -> DataFrame:
    """Facts between the first and the last edge; the bounds reach the scan."""
    edges = windows.agg(F.min("lower").alias("lower"), F.max("upper").alias("upper"))
    facts = at_or_after(facts, time, edges.select("lower").scalar())
    return before(facts, time, edges.select("upper").scalar())


def snap(
    windows: DataFrame,
    facts: DataFrame,
    time: str,
    keys: Sequence[str],
    measures: Sequence[Measure],
    cell: str,
    category: str | None,
) -> DataFrame:
    """Partial aggregates of the facts per keys, cell, part and category."""
    parts = F.broadcast(parts_of(windows, keys, cell).withColumnsRenamed({k: f"_part_{k}" for k in keys}))
    located = facts.withColumn("_cell", _floor(time, cell))
    test = (F.col("_cell") == F.col("cell")) & (F.col(time) >= F.col("part")) & (F.col(time) < F.col("part_end"))
    for key in keys:
        test = test & (F.col(key) == F.col(f"_part_{key}"))
    kind = [F.col(category).alias("_category")] if category else []
    return located.join(parts, test).groupBy(*keys, "cell", "part", *kind).agg(*partials(measures))


def _from_cells(
    windows: DataFrame, snapped: DataFrame, keys: Sequence[str], kind: Sequence[str], cell: str,
    measures: Sequence[Measure],
) -> DataFrame:
    """Windows meet the parts of every cell they touch.  For few windows."""
    spans = windows.select(
        *keys,
        "lower",
        "upper",
        F.expr(
            f"explode(sequence(cast(date_trunc('{cell}', lower) AS timestamp_ntz), upper, INTERVAL 1 {cell}))"
        ).alias("cell"),
    )
    covered = F.broadcast(spans).join(snapped, [*keys, "cell"]).filter("part >= lower AND part < upper")
    return covered.groupBy(*keys, "upper", *kind).agg(*merges(measures))


def few(anchors: DataFrame) -> bool:
    """Whether the rows that windows are made of are so few that the windows' parts may be broadcast; counted."""
    return anchors.limit(MOST_BOUNDED + 1).count() <= MOST_BOUNDED


def preceding_stats(
    windows: DataFrame,
    facts: DataFrame,
    time: str,
    keys: Sequence[str],
    measures: Sequence[Measure],
    cell: str,
    category: str | None = None,
    bounded: bool = False,
) -> DataFrame:
    """Partial aggregates of the facts in each half-open window ``[lower, upper)``.

    ``windows`` has distinct ``keys, lower, upper`` and spans at least two hours for minute cells,
    two days for hour cells.
    ``bounded`` says that they are few, by a limit or by ``few``: their parts are broadcast then.  All others are made up
    from the sum tree, without any broadcast.  Output: keys, upper, partial columns, and the category counts where there
    is a ``category``.
    """
    kind = ["_category"] if category else []
    facts = _between(windows, facts, time)
    if bounded:
        combined = _from_cells(windows, snap(windows, facts, time, keys, measures, cell, category), keys, kind, cell, measures)
    else:
        return preceding_of_tables(written(windows, "windows"), {"": (facts, time, measures, category)}, keys).withColumnRenamed(f"{CATEGORIES}_", CATEGORIES)
    return _fold(combined, [*keys, "upper"], measures, category)


def _kinds(facts: DataFrame, category: str | None) -> list[str] | None:
    """The categories as hexadecimal digits, which no setting reads in another way, if they are few texts."""
    if not category:
        return []
    if facts.schema[category].dataType.simpleString() != "string":
        return None
    known = facts.where(F.col(category).isNotNull()).select(F.hex(category).alias("digits"), F.is_valid_utf8(category).alias("valid"))
    found = known.distinct().limit(MOST_KINDS + 1).collect()
    return sorted(r.digits for r in found) if len(found) <= MOST_KINDS and all(r.valid for r in found) else None


def preceding_of_tables(windows: DataFrame, tables: Mapping[str, Part], keys: Sequence[str]) -> DataFrame:
    """``preceding_stats`` of several tables in the same many windows, which are stored.

    Output: keys, upper, all partial columns, and the category counts of a table in ``CATEGORIES_<its name>``.  Tables
    with few categories are summed together, the categories as further columns; others on their own.
    """
    shape = shape_of(windows)
    together, alone, counts = [], [], []
    for name, (facts, time, measures, category) in tables.items():
        facts = _between(windows, facts, time)
        kinds = _kinds(facts, category) if shape.length else None if category else []
        if kinds is None:
            sums = sums_of_tables(windows, [(facts, time, measures, category)], keys, shape)
            alone.append(_fold(sums, [*keys, "upper"], measures, category).withColumnRenamed(CATEGORIES, f"{CATEGORIES}_{name}"))
            continue
        counted = [Measure(f"_{name}_{i}", "matches", f"hex({category}) = '{k}'") for i, k in enumerate(kinds)]
        together.append((facts, time, [*measures, *counted], None))
        if category:
            each = [f"named_struct('category', cast(X'{k}' AS string), 'total', {m.name}_n)" for k, m in zip(kinds, counted)]
            found = f"filter(array({', '.join(each)}), x -> x.total > 0)"
            counts.append(f"{found if each else NO_CATEGORIES} AS {CATEGORIES}_{name}")
    if together:
        names = [n for _, _, measures, _ in together for n in partial_names(measures) if not n.startswith("_")]
        alone.append(sums_of_tables(windows, together, keys, shape).selectExpr(*keys, "upper", *names, *counts))
    out = alone[0]
    for other in alone[1:]:
        out = out.join(other, [*keys, "upper"], "full")
    return out


def preceding_sums(windows: DataFrame, base: DataFrame, keys: Sequence[str], measures: Sequence[Measure]) -> DataFrame:
    """Like ``preceding_stats`` for many windows, from a stored table of ``instants``."""
    return sums_of_instants(windows, _between(windows, base, "at"), keys, measures)


def _fold(
    combined: DataFrame, window: list[str], measures: Sequence[Measure], category: str | None
) -> DataFrame:
    """One row per window; its categories, which are few, become an array."""
    if not category:
        return combined
    counted = next(m for m in measures if m.kind == "rows").partial_names()[0]
    named = F.expr(
        f"collect_list(CASE WHEN _category IS NOT NULL AND {counted} > 0 "
        f"THEN struct(_category AS category, {counted} AS total) END)"
    )
    return combined.groupBy(*window).agg(*merges(measures), named.alias(CATEGORIES))


def daily_stats(
    windows: DataFrame,
    facts: DataFrame,
    date: str,
    keys: Sequence[str],
    measures: Sequence[Measure],
    days_back: int,
    category: str | None = None,
) -> DataFrame:
    """Partial aggregates of date-grain facts over ``[day - days_back, day]`` for each window.

    ``windows`` has distinct ``keys, day``.  Facts shrink to one row per key and date first.
    """
    span = windows.select(
        *keys, "day", F.expr(f"explode(sequence(date_sub(day, {days_back}), day))").alias("_date")
    )
    first = windows.agg(F.date_sub(F.min("day"), days_back).alias("d")).scalar()
    last = windows.agg(F.max("day").alias("d")).scalar()
    kind = ["_category"] if category else []
    daily = (
        facts.filter((F.col(date) >= first) & (F.col(date) <= last))
        .groupBy(*keys, F.col(date).alias("_date"), *([F.col(category).alias("_category")] if category else []))
        .agg(*partials(measures))
    )
    combined = span.join(daily, [*keys, "_date"]).groupBy(*keys, "day", *kind).agg(*merges(measures))
    return _fold(combined, [*keys, "day"], measures, category)
