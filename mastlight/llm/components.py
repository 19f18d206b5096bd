"""Connected components of a table of links, by label propagation with pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mastlight.session import remove_folder, written_at


def each_once(links: DataFrame) -> DataFrame:
    """(a, b) links in one direction and without repeats, and none of a thing with itself."""
    return links.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def connected_components(links: DataFrame) -> DataFrame:
    """(a, b) links to (id, component): the smallest id reachable, for every id that has a link.

    Every round reads the links, so they are a stored table, of ``each_once`` where they may come repeated.

    Each round takes the smallest label over an id's links (summed up before the shuffle, so that a star with a huge
    centre is fine), then replaces each label by that label's own label.  Rounds grow with the logarithm of the
    longest chain; each is written to the shared folder, which cuts the lineage and survives lost executors, and removed
    after the next one.
    """
    spark = links.sparkSession
    links = links.where("a <> b")
    both = links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    labels, labels_at = written_at(
        both.groupBy(F.col("a").alias("id")).agg(F.min("b").alias("low"))
        .select("id", F.least("id", "low").alias("component")), "labels")
    while True:
        seen = (
            both.join(labels.select(F.col("id").alias("a"), "component"), "a")
            .groupBy(F.col("b").alias("id")).agg(F.min("component").alias("near"))
        )
        lower, lower_at = written_at(
            labels.join(seen, "id", "left")
            .select("id", F.col("component").alias("old"), F.least("component", "near").alias("component")), "labels")
        jump = lower.select(F.col("id").alias("component"), F.col("component").alias("farther"))
        after, after_at = written_at(
            lower.join(jump, "component", "left")
            .select("id", "old", F.least("component", "farther").alias("component")), "labels")
        changed = after.where("component <> old").limit(1).count()
        remove_folder(spark, labels_at)
        remove_folder(spark, lower_at)
        labels, labels_at = after.select("id", "component"), after_at
        if not changed:
            return labels
