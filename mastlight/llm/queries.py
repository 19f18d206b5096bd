"""The registered queries of the operators, over whole tables with production settings."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from mastlight.llm import (collocations, decontaminate, language, neardup, neighbours, pieces, pii, quality, suffixes, tokens,
                           topk, toxicity, whitening)
from mastlight.llm.common import prepare, table

Query = Callable[[SparkSession, str], DataFrame]


def remainder(of: int) -> Column:
    return F.crc32(F.col("doc_id").cast("string")) % of


def predicted(frame: DataFrame, held_out: Column) -> DataFrame:
    return frame.select("doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), "score",
                        (F.col("score") >= 0.7).cast("int").alias("predicted"))


def op1_quality(spark: SparkSession, folder: str) -> DataFrame:
    docs, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    held = remainder(4) == 2
    return predicted(quality.score(docs.select("doc_id", "text"), quality.fit(docs, labels, ~held)), held)


def op2_near_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return neardup.near_duplicates(docs).select("doc_id", "n_shingles", "component_id", "kept")


def op3_language(spark: SparkSession, folder: str) -> DataFrame:
    return language.identify_pages(table(spark, folder, "pages"), table(spark, folder, "documents"))


def op4_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    found = decontaminate.report(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", "n_items",
                        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated")


def op5_pieces(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    model = spark.sparkContext.broadcast(pieces.codec_bytes(public_tokenizers.path("piece_bpe_32k.model")))
    return pieces.encode_decode(docs, model, digests=True).select(
        "doc_id", F.col("n_pieces").alias("n_tokens"), "ids_sha256", "decoded_sha256")


def op6_repeats(spark: SparkSession, folder: str) -> DataFrame:
    return suffixes.remove_repeats(table(spark, folder, "documents").select("doc_id", "text"), digests=True)


def op7_topk(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "embeddings")
    return topk.exact_topk(rows, F.col("vec_id") % 100 == 0, 10)


def op8_pii(spark: SparkSession, folder: str) -> DataFrame:
    return pii.report(table(spark, folder, "documents").select("doc_id", "text"))


def op9_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    vocabulary = spark.sparkContext.broadcast(tokens.vocabulary_bytes(public_tokenizers.path("word_bpe_49k.json")))
    return tokens.token_counts(docs, vocabulary).select("doc_id", "n_words", "n_tokens")


def op10_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    held = remainder(3) == 1
    return predicted(toxicity.score(docs.select("doc_id", "text"), toxicity.fit(docs, labels, ~held)), held)


def op11_collocations(spark: SparkSession, folder: str) -> DataFrame:
    return collocations.collocations(table(spark, folder, "documents"))


def op12_neighbours(spark: SparkSession, folder: str) -> DataFrame:
    return neighbours.nearest(table(spark, folder, "embeddings"), F.col("vec_id") % 20 == 0, 20)


def op13_whitening(spark: SparkSession, folder: str) -> DataFrame:
    return whitening.whitened_components(table(spark, folder, "embeddings"))


QUERIES: dict[str, Query] = {q.__name__: q for q in (
    op1_quality, op2_near_duplicates, op3_language, op4_decontaminate, op5_pieces, op6_repeats, op7_topk, op8_pii,
    op9_token_counts, op10_toxicity, op11_collocations, op12_neighbours, op13_whitening)}


def llm_queries() -> dict[str, Query]:
    """Every query by name, run with the package's session settings."""
    def prepared(query: Query) -> Query:
        def run(spark: SparkSession, folder: str) -> DataFrame:
            prepare(spark)
            return query(spark, folder)
        return run

    return {name: prepared(query) for name, query in QUERIES.items()}
