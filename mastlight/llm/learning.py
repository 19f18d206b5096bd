"""The bounded sample of labelled rows that the classifiers learn from."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ID, TEXT, LABEL = "__id", "__text", "__label"


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, learn: Column, bound: int,
                    key: str = "doc_id", text: str = "text") -> DataFrame:
    """At most ``bound`` labelled rows, the first by a hash of the key, with their whole texts.

    ``learn`` (over the key) tells which rows may be learnt from.  Labels other than 0 and 1, NULL keys and keys
    with two different labels are left out; a key that several rows of ``docs`` hold brings each of them.
    The ids of the sample are broadcast: their number is the bound.
    """
    chosen = (
        labels.select(F.col(key).alias(ID), F.col(label).cast("int").alias(LABEL))
        .where(F.col(ID).isNotNull() & F.col(LABEL).isin(0, 1))
        .withColumnRenamed(ID, key).where(learn).withColumnRenamed(key, ID)
        .groupBy(ID).agg(F.min(LABEL).alias(LABEL), F.max(LABEL).alias("__top"))
        .where(F.col(LABEL) == F.col("__top")).drop("__top")
        .orderBy(F.xxhash64(F.col(ID).cast("string")), ID).limit(bound)
    )
    rows = docs.select(F.col(key).alias(ID), F.col(text).cast("string").alias(TEXT))
    return rows.join(F.broadcast(chosen), ID)
