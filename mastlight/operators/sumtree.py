"""Sums over many time windows from sums over the time line.

Windows of one length L, whole minutes long, need no tree.  The time line is cut into blocks of L: a window is the end of one block and
the start of the next, so running sums from a block's start and from its end make up both parts.  The running sums go over
the block's minutes first and then, with what these hand on, over the rows of a minute.  Windows of several lengths use a tree.

Rows are summed per key and instant in the scan.  From these come sums per minute, and from the minutes a tree of
dyadic intervals: 1, 2, 4, ... minutes, each aligned to its own length.  A window is the rest of its first minute, whole
minutes, and the start of its last minute.  Its whole minutes are at most two intervals of each length, found by arithmetic and
joined by equality; first and last minutes come from running sums inside a minute.  So rows never meet windows: the
work follows instants, minutes and windows, and no task holds more than a minute of a key.  Sums are added, never subtracted.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mastlight.operators.measures import Measure, merges, partial_names, partials
from mastlight.session import written

MINUTE = 60_000_000


def minute_of(time: str) -> Column:
    """Whole minutes since 1970 of a UTC wall time, rounded down."""
    micros = f"unix_micros(cast({time} AS timestamp))"
    return F.expr(f"({micros} - pmod({micros}, {MINUTE})) div {MINUTE}")


@dataclass(frozen=True)
class Shape:
    """What windows have in common: their ``length`` in minutes, if they are all equally long, and if all edges are ``whole`` seconds."""

    length: int | None
    whole: bool


def shape_of(windows: DataFrame) -> Shape:
    lower, upper = (f"unix_micros(cast({edge} AS timestamp))" for edge in ("lower", "upper"))
    row = windows.agg(
        F.expr(f"min({upper} - {lower}) AS least"), F.expr(f"max({upper} - {lower}) AS most"),
        F.expr(f"coalesce(bool_and({lower} % 1000000 = 0 AND {upper} % 1000000 = 0), true) AS whole")).first()
    even = row.least is not None and row.least == row.most and row.least > 0 and row.least % MINUTE == 0
    return Shape(row.least // MINUTE if even else None, row.whole)


def instants(
    facts: DataFrame, time: str, keys: Sequence[str], measures: Sequence[Measure], category: str | None = None
) -> DataFrame:
    """Partial aggregates per key, instant and category, with the minute."""
    kind = [F.col(category).alias("_category")] if category else []
    summed = facts.groupBy(*keys, F.col(time).alias("at"), *kind).agg(*partials(measures))
    return summed.withColumn("minute", minute_of("at"))


def tree(base: DataFrame, keys: Sequence[str], kind: Sequence[str], measures: Sequence[Measure], levels: int) -> DataFrame:
    """Partial aggregates per key, level, node (the interval's number among those of its length) and category."""
    minutes = base.groupBy(*keys, "minute", *kind).agg(*merges(measures))
    spread = minutes.withColumn("level", F.explode(F.sequence(F.lit(0), F.lit(levels))))
    return spread.groupBy(*keys, "level", F.expr("shiftright(minute, level)").alias("node"), *kind).agg(*merges(measures))


def cover(first: str, last: str, levels: int) -> Column:
    """Array of (level, node): the fewest dyadic intervals that make up the minutes from ``first`` up to ``last``."""
    # At each length, with the ends rounded inwards: an odd start and an odd end stand out of the next length.
    low, high = f"-shiftright(-{first}, l)", f"shiftright({last}, l)"
    left = f"CASE WHEN {low} < {high} AND {low} % 2 <> 0 THEN named_struct('level', l, 'node', {low}) END"
    right = (f"CASE WHEN {low} + abs({low} % 2) < {high} AND {high} % 2 <> 0 "
             f"THEN named_struct('level', l, 'node', {high} - 1) END")
    return F.expr(f"filter(flatten(transform(sequence(0, {levels}), l -> array({left}, {right}))), x -> x IS NOT NULL)")


def levels_of(windows: DataFrame) -> int:
    """Levels that the longest window needs."""
    row = windows.agg(F.max(minute_of("upper") - minute_of("lower")).alias("n")).first()
    return max(int(row.n or 1), 1).bit_length()


def _middles(
    windows: DataFrame, nodes: DataFrame, keys: Sequence[str], kind: Sequence[str], measures: Sequence[Measure], levels: int
) -> DataFrame:
    """Whole minutes of each window; windows with the same minutes are made up once."""
    ends = windows.select(*keys, "lower", "upper", (minute_of("lower") + 1).alias("first"), minute_of("upper").alias("last"))
    parts = ends.select(*keys, "first", "last").distinct().select(*keys, "first", "last", F.explode(cover("first", "last", levels)).alias("n"))
    sums = (
        parts.select(*keys, "first", "last", "n.level", "n.node").join(nodes, [*keys, "level", "node"])
        .groupBy(*keys, "first", "last", *kind).agg(*merges(measures))
    )
    return ends.join(sums, [*keys, "first", "last"]).select(*keys, "lower", "upper", *kind, *partial_names(measures))


def _edges(windows: DataFrame, base: DataFrame, keys: Sequence[str], kind: Sequence[str], measures: Sequence[Measure]) -> DataFrame:
    """First and last minute of each window, by running sums over the instants of the minute."""
    names = partial_names(measures)
    markers = windows.select(
        *keys, "lower", "upper", F.expr("explode(array(struct(lower AS at, true AS opens), struct(upper AS at, false AS opens)))").alias("m")
    ).select(*keys, "lower", "upper", "m.at", "m.opens").withColumn("minute", minute_of("at"))
    touched = markers.select(*keys, "minute").distinct()
    near = base.join(touched, [*keys, "minute"], "left_semi")
    if kind:
        markers = markers.join(near.select(*keys, "minute", *kind).distinct(), [*keys, "minute"])
    lined_up = near.unionByName(markers, allowMissingColumns=True)
    # A marker sorts before the rows of its own instant: "before" leaves them out, "from" has them.
    is_data = F.col("opens").isNull()
    cells = Window.partitionBy(*keys, "minute", *kind)
    before = cells.orderBy("at", is_data).rowsBetween(Window.unboundedPreceding, -1)
    onwards = cells.orderBy(F.desc("at"), is_data.desc()).rowsBetween(Window.unboundedPreceding, 0)
    summed = lined_up.select(
        *keys, "lower", "upper", "opens", *kind, *[F.sum(n).over(before).alias(f"_b_{n}") for n in names],
        *[F.sum(n).over(onwards).alias(f"_o_{n}") for n in names])
    return summed.where("opens IS NOT NULL").select(
        *keys, "lower", "upper", *kind, *[F.when(F.col("opens"), F.col(f"_o_{n}")).otherwise(F.col(f"_b_{n}")).alias(n) for n in names])


def _running(rows: DataFrame, keys: Sequence[str], order: Sequence[Column], measures: Sequence[Measure], kept: Sequence[str]) -> DataFrame:
    """Running sums up to each row that asks, which holds no sums itself."""
    line = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    names = partial_names(measures)
    summed = rows.select(*keys, *kept, "asks", *[F.sum(n).over(line).alias(n) for n in names]).where("asks")
    return summed.select(*keys, *kept, *names).where(" OR ".join(f"{n} IS NOT NULL" for n in names))


def _even_sums(windows: DataFrame, base: DataFrame, keys: Sequence[str], measures: Sequence[Measure], length: int) -> DataFrame:
    """Windows of one length: the sums before ``upper`` in its block, and those from ``lower`` on in the block before.

    Time runs forward (``way`` 1) for the first and backward (-1) for the second, so both are sums of what came before.
    """
    names = partial_names(measures)
    both = F.explode(F.array(F.lit(1), F.lit(-1))).alias("way")
    edge = F.expr("explode(array(struct(1 AS way, upper AS at), struct(-1 AS way, lower AS at))) AS e")
    asking = windows.dropna(subset=[*keys, "upper"]).select(*keys, "upper", edge).select(
        *keys, "e.way", minute_of("e.at").alias("minute"), F.expr("unix_micros(cast(e.at AS timestamp)) AS micros"), "upper", F.lit(True).alias("asks"))
    base = base.dropna(subset=[*keys, "at"])
    # What the other minutes of the block hand on to a minute: one that asks stands before its own sums.
    minutes = base.groupBy(*keys, "minute").agg(*merges(measures)).select(*keys, "minute", both, F.lit(False).alias("asks"), *names)
    asked = asking.select(*keys, "way", "minute", "asks").distinct()
    block = F.floor(F.col("minute") / length).alias("block")
    handed = _running(
        minutes.unionByName(asked, allowMissingColumns=True).select("*", block),
        [*keys, "way", "block"], [F.col("way") * F.col("minute"), F.desc("asks")], measures, ["minute"])
    first = F.lit(None).cast("long").alias("place")
    # An edge stands before the rows of its own instant going forward, and after them going backward; NULL comes first.
    place = F.expr("way * (2 * micros + CASE WHEN asks THEN 0 ELSE 1 END) AS place")
    rows = base.select("*", F.expr("unix_micros(cast(at AS timestamp)) AS micros"), both, F.lit(False).alias("asks"))
    lined_up = (
        rows.select(*keys, "way", "minute", "asks", place, *names)
        .unionByName(handed.select(*keys, "way", "minute", F.lit(False).alias("asks"), first, *names))
        .unionByName(asking.select(*keys, "way", "minute", "asks", place, "upper"), allowMissingColumns=True)
    )
    ends = _running(lined_up, [*keys, "way", "minute"], [F.asc_nulls_first("place")], measures, ["upper"])
    return ends.groupBy(*keys, "upper").agg(*merges(measures)).select(
        *keys, F.expr(f"upper - INTERVAL {length} MINUTES AS lower"), "upper", *names)


def window_sums(
    windows: DataFrame, facts: DataFrame, time: str, keys: Sequence[str], measures: Sequence[Measure], category: str | None = None
) -> DataFrame:
    """Partial aggregates of the facts in each half-open window ``[lower, upper)``.

    ``windows`` has distinct ``keys, lower, upper``, each over an edge of a minute at least.  Output: keys, lower, upper, the
    category where there is one, partial columns; windows without facts may be missing.
    """
    return sums_of_tables(windows, [(facts, time, measures, category)], keys)


#: A table of facts, its time column, what is summed, and the category column if there is one.
Part = tuple[DataFrame, str, Sequence[Measure], str | None]


def sums_of_tables(windows: DataFrame, parts: Sequence[Part], keys: Sequence[str], shape: Shape | None = None) -> DataFrame:
    """``window_sums`` of several tables at once, whose measures have different names; only a single one may have a category."""
    shape = shape or shape_of(windows)
    measures = [m for _, _, wanted, _ in parts for m in wanted]
    kind = ["_category"] if parts[0][3] else []
    if kind and len(parts) > 1:
        raise ValueError("several tables have no category in common")
    base = None
    for facts, time, wanted, category in parts:
        if shape.whole:  # all rows of a second are in the same windows
            facts = facts.withColumn(time, F.date_trunc("second", time).cast("timestamp_ntz"))
        one = instants(facts, time, keys, wanted, category)
        base = one if base is None else base.unionByName(one, allowMissingColumns=True)
    if len(parts) > 1:
        base = base.groupBy(*keys, "at", "minute").agg(*merges(measures))
    # Written, as minutes and rows within a minute both come from it.
    return sums_of_instants(windows, written(base, "instants"), keys, measures, kind, shape)


def sums_of_instants(
    windows: DataFrame, base: DataFrame, keys: Sequence[str], measures: Sequence[Measure], kind: Sequence[str] = (),
    shape: Shape | None = None,
) -> DataFrame:
    """Like ``window_sums``, from a stored table of ``instants``, which may hold an instant in several rows."""
    shape = shape or shape_of(windows)
    if shape.length and not kind:
        return _even_sums(windows, base, keys, measures, shape.length)
    levels = levels_of(windows)
    middles = _middles(windows, tree(base, keys, kind, measures, levels), keys, kind, measures, levels)
    both = _edges(windows, base, keys, kind, measures).unionByName(middles)
    return both.groupBy(*keys, "lower", "upper", *kind).agg(*merges(measures))
