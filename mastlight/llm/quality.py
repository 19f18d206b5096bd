"""Quality classifier: supervised subword embeddings.

Each word is its own hashed feature plus the hashed character n-grams between its word marks (a word that repeats the
one before is one feature of its own); a word's vector is the mean of its features' vectors, a document's vector the
mean over all its words, and a softmax layer on top gives the class.  Vectors and layer are learnt by stochastic
gradient descent in numpy from a bounded sample of labelled rows; every document is then scored whole, in its own task,
without a shuffle.  For the two classes the layer is folded into the vectors, so that a feature adds one number.
Hashes of all words and n-grams of a slice of texts are made at once from the array of its characters.

Results: NULL counts as empty text; a text without words gets the score of the layer's bias.  Without labelled rows
the score is 0.5; with rows of one class only, their smoothed share.  Rows repeat as they come; columns of ``docs``
pass through, but for those named like the added ones, which are replaced.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import types as T

from mastlight.llm.common import ODD, mixed, powers, slices
from mastlight.llm.learning import ID, LABEL, TEXT, labelled_sample

BLANK = 32


@dataclass(frozen=True)
class Settings:
    """``bound``: labelled rows to learn from, at most; ``lengths`` of the character n-grams."""

    bound: int = 3000
    buckets: int = 1 << 16
    size: int = 16
    lengths: tuple[int, ...] = (3, 4)
    epochs: int = 4
    rate: float = 4.0
    seed: int = 7


@dataclass(frozen=True)
class QualityModel:
    """``weights`` per bucket and ``bias``: log odds of class 1, the layer folded into the vectors."""

    settings: Settings
    weights: np.ndarray
    bias: float


@dataclass(frozen=True)
class Words:
    """The words of some texts: ``first`` word of each text, the bucket of each word, its begin and end in the
    characters, whether it repeats the word before, and for each n-gram length the bucket of the n-gram that begins at
    each character."""

    first: np.ndarray
    bucket: np.ndarray
    begin: np.ndarray
    end: np.ndarray
    again: np.ndarray
    grams: list[np.ndarray]


def words_of(texts: list[bytes], settings: Settings) -> Words:
    """Words are runs of characters above U+0020; the blanks beside a word serve as its marks in n-grams."""
    mask = np.uint64(settings.buckets - 1)
    chars = [np.frombuffer(t.decode("utf-8", "replace").encode("utf-32-le", "replace"), np.uint32) for t in texts]
    gap = np.full(max(settings.lengths), BLANK, np.uint32)
    data = np.concatenate([gap, *[x for c in chars for x in (c, gap)]]).astype(np.uint64)
    data[data <= BLANK] = BLANK
    bounds = np.cumsum([0, *[len(c) + len(gap) for c in chars]]) + 1
    inside = data > BLANK
    edges = np.flatnonzero(inside[1:] != inside[:-1]) + 1
    begin, end = edges[0::2], edges[1::2]
    first = np.searchsorted(begin, bounds)
    up = powers(len(data), ODD)
    down = np.uint64(pow(int(ODD), -1, 1 << 64))
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(data * up)])
    whole = mixed((sums[end] - sums[begin]) * powers(len(data), down)[begin])
    again = np.zeros(len(whole), bool)
    again[1:] = whole[1:] == whole[:-1]
    again[first[:-1][first[:-1] < len(whole)]] = False
    grams = []
    for n in settings.lengths:
        total = np.zeros(len(data) - n + 1, np.uint64)
        for i in range(n):
            total = total * ODD + data[i : len(data) - n + 1 + i]
        grams.append((mixed(total + np.uint64(n)) & mask).astype(np.int64))
    bucket = np.where(again, np.uint64(1), whole & mask).astype(np.int64)
    return Words(first, bucket, begin, end, again, grams)


def counts_of(words: Words, settings: Settings) -> tuple[list[np.ndarray], np.ndarray]:
    """N-grams of each word by length, and all its features."""
    size = words.end - words.begin
    grams = [np.where(words.again, 0, np.maximum(size + 3 - n, 0)) for n in settings.lengths]
    return grams, 1 + sum(grams)


def bags(texts: list[bytes], settings: Settings) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each text its buckets, in order, and their weights in its mean."""
    out = []
    for text in texts:
        words = words_of([text], settings)
        n = len(words.bucket)
        if not n:
            out.append((np.zeros(0, np.int32), np.zeros(0, np.float32)))
            continue
        grams, features = counts_of(words, settings)
        share = 1 / (n * features)
        ids, weights = [words.bucket], [share]
        for count, bucket in zip(grams, words.grams):
            start = np.repeat(words.begin - 1 - np.cumsum(count) + count, count)
            ids.append(bucket[start + np.arange(len(start))])
            weights.append(np.repeat(share, count))
        unique, where = np.unique(np.concatenate(ids), return_inverse=True)
        out.append((unique.astype(np.int32), np.bincount(where, np.concatenate(weights)).astype(np.float32)))
    return out


def train(rows: list[tuple[np.ndarray, np.ndarray]], labels: list[int], settings: Settings) -> QualityModel:
    """Stochastic gradient descent over the documents' bags, in the order given before shuffling."""
    if len(set(labels)) < 2:
        share = (sum(labels) + 1) / (len(labels) + 2)
        return QualityModel(settings, np.zeros(settings.buckets), math.log(share / (1 - share)))
    random = np.random.default_rng(settings.seed)
    vectors = random.uniform(-1, 1, (settings.buckets, settings.size)).astype(np.float32) / settings.size
    layer, bias = np.zeros((2, settings.size), np.float32), np.zeros(2, np.float32)
    steps, step = settings.epochs * len(rows), 0
    for _ in range(settings.epochs):
        for at in random.permutation(len(rows)):
            rate = np.float32(settings.rate * (1 - step / steps))
            step += 1
            ids, weights = rows[at]
            hidden = weights @ vectors[ids]
            logits = layer @ hidden + bias
            shares = np.exp(logits - logits.max())
            error = shares / shares.sum()
            error[labels[at]] -= 1
            back = error @ layer
            layer -= (rate * error)[:, None] * hidden
            bias -= np.float32(0.02) * rate * error
            vectors[ids] -= (rate * weights)[:, None] * back
    return QualityModel(settings, (vectors @ (layer[1] - layer[0])).astype(float), float(bias[1] - bias[0]))


def scores(texts: list[bytes], model: QualityModel) -> np.ndarray:
    """Of each text the softmax share of class 1."""
    words = words_of(texts, model.settings)
    values = model.weights[words.bucket]
    grams, features = counts_of(words, model.settings)
    for count, bucket in zip(grams, words.grams):
        if len(count):
            sums = np.add.reduceat(model.weights[bucket], np.stack([words.begin - 1, words.begin - 1 + count], 1).ravel())[::2]
            values = values + np.where(count > 0, sums, 0.0)
    values = values / features
    odds = np.array([model.bias + (values[a:b].mean() if b > a else 0.0) for a, b in zip(words.first, words.first[1:])])
    return 1 / (1 + np.exp(-np.clip(odds, -500, 500)))


def fit(docs: DataFrame, labels: DataFrame, learn: Column, settings: Settings = Settings(), *, label: str = "quality",
        key: str = "doc_id", text: str = "text") -> QualityModel:
    """Learn from a bounded sample; the driver receives the bags of ``settings.bound`` rows at most."""
    sample = labelled_sample(docs, labels, label, learn, settings.bound, key, text)

    def bagged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in slices(batches, TEXT):
            got = bags(texts, settings)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).cast(pa.string()), batch.column(batch.schema.get_field_index(LABEL)),
                 pa.array([ids.tobytes() for ids, _ in got], pa.binary()),
                 pa.array([weights.tobytes() for _, weights in got], pa.binary())],
                names=["id", "label", "ids", "weights"])

    got = sample.select(ID, TEXT, LABEL).mapInArrow(
        bagged, "id string, label int, ids binary, weights binary").toArrow()
    rows = sorted(zip(*[got[c].to_pylist() for c in ("id", "label", "ids", "weights")]))
    return train([(np.frombuffer(r[2], np.int32), np.frombuffer(r[3], np.float32)) for r in rows],
                 [int(r[1]) for r in rows], settings)


def score(docs: DataFrame, model: QualityModel, text: str = "text") -> DataFrame:
    """Adds ``score`` (0 to 1, that of class 1) to every row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # one number a bucket
    kept = docs.drop("score")
    schema = T.StructType([*kept.schema.fields, T.StructField("score", T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in slices(batches, text):
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(scores(texts, shared.value), pa.float64())],
                                             names=[f.name for f in schema.fields])

    return kept.mapInArrow(run, schema)
