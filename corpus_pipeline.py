"""A training-data pipeline over ``documents``: each stage is written as Parquet and read again as the next one's input.

Stages drop toxic documents, all but one of each group of near duplicates, and documents with benchmark passages, then
take personal data out of the texts and encode what is left.  Every stage works on all that its predecessor kept.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mastlight.llm import decontaminate, neardup, pieces, pii, toxicity
from mastlight.llm.common import prepare, table
from mastlight.llm.queries import remainder
from mastlight.session import written

#: Documents with this score or more are toxic.
TOXIC = 0.7


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents that the classifier (learnt from the labelled rows that may be learnt from) does not reject."""
    prepare(spark)
    model = toxicity.fit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), remainder(3) != 1)
    return toxicity.score(docs, model).where(F.col("score") < TOXIC).select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group, that of the smallest id; documents without words are in no group."""
    prepare(spark)
    return neardup.one_of_each(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents in which no passage of the benchmark occurs."""
    prepare(spark)
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def sanitise(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Takes personal data, and terms that give it away, out of the texts; ``n_chars`` follows."""
    prepare(spark)
    return pii.sanitise(docs).withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Piece ids with their number and the text they decode to, beside id, language and source."""
    prepare(spark)
    model = spark.sparkContext.broadcast(pieces.codec_bytes(public_tokenizers.path("piece_bpe_32k.model")))
    return pieces.encode_decode(docs, model).select("doc_id", "lang", "source", "piece_ids", "n_pieces", "decoded")


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("personal_data", sanitise),
    ("pieces", encode),
]

#: No SQL: the first stage is a trained classifier.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a folder."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
