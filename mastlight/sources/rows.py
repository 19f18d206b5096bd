"""Reading delimited files and remembering where each row stood in them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from mastlight.sources.layouts import TOWER_POSITIONS

#: Orderable position of a row: file, start of its split, and rank within the task.
POSITION = ("_file", "_split", "_rank")


def with_position(df: DataFrame) -> DataFrame:
    """Add the position columns to a frame read straight from files."""
    return df.select(
        "*",
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_split"),
        F.monotonically_increasing_id().alias("_rank"),
    )


def read_headed_csv(spark: SparkSession, path: str, multiline: bool = False) -> DataFrame:
    """Headed file, every value text and trimmed.  ``multiline`` gives up splitting large files."""
    return (
        spark.read.option("header", True)
        .option("inferSchema", False)
        .option("ignoreLeadingWhiteSpace", True)
        .option("ignoreTrailingWhiteSpace", True)
        .option("escape", '"')
        .option("multiLine", multiline)
        .option("enforceSchema", False)  # files of a folder must have the same header, or reading fails
        .csv(path)
    )


def read_tower_csv(spark: SparkSession, path: str) -> DataFrame:
    """Headerless positional file; short rows are padded with NULL, extra cells dropped."""
    schema = ", ".join(f"{name} STRING" for name in TOWER_POSITIONS)
    return (
        spark.read.schema(schema)
        .option("header", False)
        .option("escape", '"')
        .option("mode", "PERMISSIVE")
        .csv(path)
    )


def with_ordinal(staged: DataFrame, name: str = "_ordinal") -> DataFrame:
    """Add the 1-based row number over all files in path order.

    ``staged`` must be a written table, so that the position columns do not change between the two
    reads.  Only one row per file split is ordered globally, not the data.
    """
    splits = staged.groupBy("_file", "_split").agg(
        F.min("_rank").alias("_first"), F.count("*").alias("_rows")
    )
    files = splits.groupBy("_file").agg(F.sum("_rows").alias("_file_rows"))
    before = Window.orderBy("_file").rowsBetween(Window.unboundedPreceding, -1)
    files = files.select("_file", F.coalesce(F.sum("_file_rows").over(before), F.lit(0)).alias("_base"))
    in_file = Window.partitionBy("_file").orderBy("_split").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        splits.withColumn("_ahead", F.coalesce(F.sum("_rows").over(in_file), F.lit(0)))
        .join(files, "_file")
        .select("_file", "_split", (F.col("_base") + F.col("_ahead") - F.col("_first") + 1).alias("_shift"))
    )
    return staged.join(offsets, ["_file", "_split"]).withColumn(
        name, F.col("_rank") + F.col("_shift")
    ).drop("_shift")
