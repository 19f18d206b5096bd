"""Load jobs: files -> staged typed rows -> insert-if-absent, with a report."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mastlight.session import (
    passing_shuffles,
    passing_tables,
    remove_folder,
    shuffled_for,
    small_methods,
    sorting_staged,
    staging,
    written,
)
from mastlight.sources.layouts import LAYOUTS
from mastlight.sources.normalise import fill_ids, normalise, normalise_towers
from mastlight.sources.readings import resolve_towers, sql_time
from mastlight.sources.rows import (
    POSITION,
    read_headed_csv,
    read_tower_csv,
    with_ordinal,
    with_position,
)
from mastlight.sources.store import TableStore, counted

SYNTHETIC_SOURCE = "synthetic training data"


@dataclass(frozen=True)
class LoadReport:
    """Rows read, accepted, rejected and really added by one load."""

    table: str
    parsed: int
    sent: int
    skipped: int
    inserted: int


@dataclass(frozen=True)
class Staged:
    """Typed rows in the shared folder, counted as they were written."""

    rows: DataFrame
    parsed: int
    valid: int


def _staged(rows: DataFrame, label: str) -> Staged:
    rows, seen = counted(rows, valid=F.count_if(F.col("_valid")))
    with small_methods(rows.sparkSession), staging(rows.sparkSession):
        staged = written(rows, label)
    return Staged(staged, seen(), seen("valid"))


def _finish(store: TableStore, table: str, staged: Staged, rows: DataFrame, source: str | None) -> LoadReport:
    """Add the valid rows; the report takes what the two writes have counted and reads nothing again."""
    with shuffled_for(store.spark, staged.valid), passing_shuffles(store.spark), sorting_staged(store.spark):
        inserted = store.merge_new(table, rows.filter("_valid"), POSITION, source)
    return LoadReport(table, staged.parsed, staged.valid, staged.parsed - staged.valid, inserted)


def stage_dataset(spark: SparkSession, table: str, path: str, multiline: bool = False) -> Staged:
    """Parse and type one headed file (or a folder of files with one header) into a staged table.

    Text is parsed once; everything after reads the staged columns.
    """
    raw = with_position(read_headed_csv(spark, path, multiline))
    return _staged(normalise(raw, LAYOUTS[table], POSITION), f"stage-{table}")


def load_dataset(
    store: TableStore, table: str, path: str, source: str = SYNTHETIC_SOURCE, multiline: bool = False, passing: bool = False
) -> LoadReport:
    """Load one of the thirteen headed datasets.  Running it again adds nothing.

    ``passing`` files are removed as soon as their rows are staged, so that they do not lie beside the shuffles of the merge.
    """
    layout = LAYOUTS[table]
    with passing_tables(store.spark, keep=0):
        staged = stage_dataset(store.spark, table, path, multiline)
        if passing:
            remove_folder(store.spark, path)
        rows = staged.rows
        if layout.id_prefix:
            id_missing = F.col(layout.id_field.target).isNull()
            if not rows.filter(id_missing & F.col("_valid")).isEmpty():
                rows = fill_ids(with_ordinal(rows), layout)
        return _finish(store, table, staged, rows, source)


def load_towers(store: TableStore, path: str, force: bool = False) -> LoadReport | None:
    """Load the tower file unless towers are present; ``force`` empties towers and readings first."""
    if not store.read("towers").isEmpty():
        if not force:
            return None
        store.clear("towers")
        store.clear("readings")
    raw = with_position(read_tower_csv(store.spark, path))
    staged = _staged(normalise_towers(raw, POSITION), "stage-towers")
    numbered = with_ordinal(staged.rows, "id").withColumn("id", F.col("id").cast("int"))
    return _finish(store, "towers", staged, numbered, None)


def append_readings(store: TableStore, readings: DataFrame) -> None:
    """Append accepted readings, with towers resolved from the store's tower table."""
    store.append("readings", resolve_towers(readings, store.read("towers")))


def append_speed_tests(store: TableStore, tests: DataFrame, now: dt.datetime | str | None = None) -> None:
    """Append speed tests as they are; a test without a time gets ``now``."""
    tested = f"coalesce(tested_at, {sql_time(now)})" if "tested_at" in tests.columns else sql_time(now)
    store.append("speed_tests", tests.withColumn("tested_at", F.expr(tested)))
