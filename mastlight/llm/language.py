"""Language of web pages: Bayesian fusion of text, declared markup, address suffix and host.

Two sources of evidence are multiplied as likelihoods per language, with a prior: (1) the page's visible text under character
trigram models learnt from the documents, tempered because trigrams overlap; (2) the declared language, as declarations
turn out among pages of each language; (3) a prior of the host, smoothed towards its domain, that towards the address's
last label, and that towards all pages.  The last label has no likelihood of its own: it counts through the prior only, the
less the more pages its host and domain have.  The likelihood of (2) and the prior of (3) are expected counts from the text
evidence, summed up over all pages by grouped aggregation.

Results: pages without text, address or declaration rest on the other sources; with none they have the overall prior.
NULLs count as missing evidence.  Ties go to the language that comes first.  Every page comes back once per row;
languages are those of the documents with at least one trigram.  Without any, the language is NULL.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mastlight.llm.common import slices
from mastlight.session import written

#: Buckets of hashed trigrams: the size of the models, whatever the data.
BUCKETS = 1 << 15
#: Weight of a trigram's log likelihood, and the most that a text counts (in trigrams).
TEMPER, MOST = 0.3, 200.0
#: Pseudo counts that tie a level of the prior to the one above.
TIE = 5.0
TAGS = re.compile(r"(?is)<(script|style)\b.*?</\1\s*>|<!--.*?-->|<[^>]*>")


def trigram_buckets(text: str) -> np.ndarray:
    """Bucket of each character trigram of the lower-cased text; blanks run together."""
    chars = np.frombuffer(" ".join(("", *text.lower().split(), "")).encode("utf-32-le", "replace"), np.uint32).astype(np.uint64)
    if len(chars) < 3:
        return np.zeros(0, np.int64)
    code = (chars[:-2] * np.uint64(0x9E3779B1) ^ chars[1:-1] * np.uint64(0x85EBCA77) ^ chars[2:] * np.uint64(0xC2B2AE3D))
    code = (code ^ (code >> np.uint64(15))) * np.uint64(0x2C1B3C6D)
    return ((code >> np.uint64(12)) % np.uint64(BUCKETS)).astype(np.int64)


def trigram_counts(docs: DataFrame, lang: str = "lang", text: str = "text") -> DataFrame:
    """(lang, bucket, n) over all documents; each task sums up before the shuffle."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch, texts in slices(batches, "text"):
            for name, value in zip(batch.column(0).to_pylist(), texts):
                own = sums.setdefault(name, np.zeros(BUCKETS, np.int64))
                own += np.bincount(trigram_buckets(value.decode("utf-8", "replace")), minlength=BUCKETS)
        for name, own in sums.items():
            at = np.flatnonzero(own)
            yield pa.RecordBatch.from_arrays(
                [pa.array([name] * len(at), pa.string()), pa.array(at), pa.array(own[at])], names=["lang", "bucket", "n"])

    return (
        docs.select(F.col(lang).cast("string").alias("lang"), F.col(text).cast("string").alias("text")).where("lang is not null")
        .mapInArrow(run, "lang string, bucket long, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    )


def text_model(docs: DataFrame, languages: int = 500) -> tuple[list[str], np.ndarray]:
    """Languages and their log likelihoods of each bucket.  The driver holds ``languages`` * BUCKETS numbers at most."""
    counts = written(trigram_counts(docs), "trigrams")
    names = [r.lang for r in counts.select("lang").distinct().orderBy("lang").limit(languages + 1).collect()]
    if len(names) > languages:
        raise ValueError(f"more than {languages} languages")
    grid = np.full((len(names), BUCKETS), 0.5)
    place = {name: i for i, name in enumerate(names)}
    for row in counts.toLocalIterator():
        grid[place[row.lang], row.bucket] += row.n
    return names, np.log(grid / grid.sum(1, keepdims=True)) if names else grid


def visible_text(html: str) -> str:
    return TAGS.sub(" ", html)


def text_evidence(pages: DataFrame, names: list[str], model: np.ndarray, html: str = "html") -> DataFrame:
    """Adds ``evidence``: log likelihood of the visible text per language, and drops the markup."""
    shared = pages.sparkSession.sparkContext.broadcast(model)
    kept = pages.drop(html)
    schema = T.StructType([*kept.schema.fields, T.StructField("evidence", T.ArrayType(T.DoubleType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in slices(batches, html):
            rows = []
            for value in texts:
                at = trigram_buckets(visible_text(value.decode("utf-8", "replace")))
                scale = TEMPER * min(1.0, MOST / len(at)) if len(at) else 0.0
                rows.append((scale * shared.value[:, at].sum(1)).tolist())
            columns = [batch.column(i) for i, n in enumerate(batch.schema.names) if n != html]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(rows, pa.list_(pa.float64()))], names=schema.names)

    return pages.select(*kept.columns, html).mapInArrow(run, schema)


def _softmax(column: str):
    top = F.array_max(column)
    scaled = F.transform(column, lambda x: F.exp(x - top))
    return F.transform(scaled, lambda x: x / F.aggregate(scaled, F.lit(0.0), lambda s, y: s + y))


def _expected(rows: DataFrame, keys: list[str], size: int) -> DataFrame:
    """Sums of the text posterior by key: one array per key."""
    sums = rows.groupBy(*keys).agg(*[F.sum(F.get("posterior", F.lit(i))).alias(f"s{i}") for i in range(size)])
    return sums.select(*keys, F.array(*[f"s{i}" for i in range(size)]).alias("sums"))


def identify_pages(pages: DataFrame, docs: DataFrame, *, key: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """Per page: key, language, its posterior, what was declared, and the language by text alone."""
    names, model = text_model(docs)
    size = len(names)
    address = F.coalesce(F.col(url).cast("string"), F.lit(""))
    markup = F.coalesce(F.col(html).cast("string"), F.lit(""))
    host = F.lower(F.regexp_extract(address, r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1))
    rows = pages.select(
        F.col(key).alias("key"), host.alias("host"),
        F.lower(F.regexp_extract(markup, r"(?is)<html\b[^>]*?\slang\s*=\s*[\"']?([a-zA-Z]{2,3})", 1)).alias("declared"),
        markup.alias("html"))
    rows = rows.withColumn("domain", F.substring_index("host", ".", -2)).withColumn("suffix", F.substring_index("host", ".", -1))
    if not size:
        return rows.select(F.col("key").alias(key), F.lit(None).cast("string").alias("language"),
                           F.lit(None).cast("double").alias("posterior"), "declared", F.lit(None).cast("string").alias("text_language"))
    rows = text_evidence(rows, names, model, "html").withColumn("posterior", _softmax("evidence"))
    rows = written(rows, "page-evidence")

    def level(keys: list[str], name: str) -> DataFrame:
        return written(_expected(rows, keys, size).withColumnRenamed("sums", name), name)

    all_ = _expected(rows.withColumn("one", F.lit(1)), ["one"], size).drop("one").withColumnRenamed("sums", "all_sums")  # one row
    by_declared, by_suffix = level(["declared"], "declared_sums"), level(["suffix"], "suffix_sums")
    by_domain, by_host = level(["domain"], "domain_sums"), level(["host"], "host_sums")
    joined = (
        rows.join(by_declared, "declared").join(by_suffix, "suffix").join(by_domain, "domain").join(by_host, "host")
        .join(F.broadcast(all_))
    )
    total = lambda c: F.aggregate(c, F.lit(0.0), lambda s, x: s + x)

    def smoothed(sums: str, above):
        """Shares of a level without the page's own count, tied to the level above."""
        own = F.zip_with(sums, "posterior", lambda s, p: F.greatest(s - p, F.lit(0.0)))
        return F.zip_with(own, above, lambda s, a: (s + TIE * a) / (total(own) + TIE))

    overall = F.transform("all_sums", lambda s: (s + 1.0) / (total("all_sums") + float(size)))
    joined = joined.withColumn("p_all", overall)
    for name, above in (("suffix", "p_all"), ("domain", "p_suffix"), ("host", "p_domain")):
        joined = joined.withColumn(f"p_{name}", F.when(F.col("host") == "", F.col("p_all")).otherwise(smoothed(f"{name}_sums", F.col(above))))
    # P(declared | language) over P(declared): the same for pages that declare nothing.
    lift = F.when(F.col("declared") == "", F.transform("p_all", lambda p: F.lit(0.0))).otherwise(
        F.zip_with(smoothed("declared_sums", F.col("p_all")), "p_all", lambda s, a: F.log(s / a)))
    fused = F.zip_with(F.zip_with("evidence", "p_host", lambda e, p: e + F.log(p)), lift, lambda e, x: e + x)
    joined = joined.withColumn("fused", fused).withColumn("share", _softmax("fused"))
    table = F.array(*[F.lit(n) for n in names])
    best = lambda c: F.get(table, F.array_position(c, F.array_max(c)).cast("int") - 1)
    return joined.select(
        F.col("key").alias(key), best("share").alias("language"), F.round(F.array_max("share"), 6).alias("posterior"),
        F.nullif("declared", F.lit("")).alias("declared"), best("evidence").alias("text_language"))
