"""Toxicity: gradient-boosted trees over dense features, calibrated by isotonic regression.

Features of a whole text: densities of a lexicon of words and word beginnings, the same near second-person words, and
rates of capitals, punctuation, drawn-out letters and obfuscated words (which are also looked up with the disguise
removed).  The lexicon holds the terms that speak for the label on one half of the sample of labelled rows; trees are
grown on most of the other half and calibrated on the rest, so that neither trusts what was fitted before it.

Only the lexicon and the sample's features (a documented bound) pass through the driver, no texts; every text is scored
in its own task, no shuffle.

Results: NULL counts as empty text; a text without words has all features 0 and the score that the trees give that.
Without labelled rows of both classes the score is the smoothed share of label 1.  Rows repeat as they come; columns
of ``docs`` pass through, but for those named like the added ones, which are replaced.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mastlight.llm.common import let_go, slices
from mastlight.llm.learning import ID, LABEL, TEXT, labelled_sample
from mastlight.session import written

#: Words that address somebody, in the four languages of the corpus.
SECOND_PERSON = frozenset(
    "you your yours yourself u ur du dich dir dein deine deinen deiner ihr euch euer tu te toi ton ta tes vous votre "
    "vos usted ustedes tú ti tus su vosotros os vuestro".split())
#: Letters that digits and signs stand for in disguised words.
PLAIN = str.maketrans("013457@$!|", "oieastasil")
LONG_WORD = 64
#: Words that a task keeps the marks of; with their length bounded, some 20 MB.
KEPT = 100_000
DRAWN_OUT = re.compile(r"([^\W\d_])\1{2,}").search
SIGNS = [ord(c) for c in "!?.,;:"]
UPPER = [*range(0x41, 0x5B), *range(0xC0, 0xD7), *range(0xD8, 0xDF)]
EDGES = ".,;:!?\"'()[]{}|*#%&$-"

# Marks of a word, one bit each; the lexicon weight sits above them.
SECOND, CAPITALS, LOUD, DRAWN, HIDDEN, HIT, SHIFT = 1, 2, 4, 8, 16, 32, 8
NAMES = ("hits", "weight", "weight_top", "weight_sum", "near_second", "second", "capitals", "upper_letters", "marks",
         "loud", "drawn", "hidden", "hidden_hits", "words")


@dataclass(frozen=True)
class Settings:
    """``bound``: labelled rows to learn from, at most; ``terms``: size of the lexicon, at most."""

    bound: int = 12_000
    terms: int = 4000
    least_docs: int = 4
    least_odds: float = 2.0
    beginnings: tuple[int, ...] = (4, 5, 6)
    near: int = 3
    trees: int = 60
    depth: int = 3
    bins: int = 32
    rate: float = 0.15
    smooth: float = 1.0


@dataclass(frozen=True)
class Trees:
    """Complete binary trees of one depth: feature, threshold by inner node, value by leaf."""

    base: float
    feature: np.ndarray
    threshold: np.ndarray
    value: np.ndarray

    def raw(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.base)
        rows = np.arange(len(x))
        for feature, threshold, value in zip(self.feature, self.threshold, self.value):
            node = np.zeros(len(x), np.int64)
            for _ in range((len(value) - 1).bit_length()):
                node = 2 * node + 1 + (x[rows, feature[node]] > threshold[node])
            out += value[node - len(feature)]
        return out


@dataclass(frozen=True)
class ToxicityModel:
    settings: Settings
    lexicon: dict[str, float]
    trees: Trees
    steps: tuple[np.ndarray, np.ndarray] = field(default=(np.zeros(1), np.zeros(1)))

    def score(self, x: np.ndarray) -> np.ndarray:
        at, value = self.steps
        return np.interp(self.trees.raw(x), at, value)


def bare(word: str) -> str:
    return word.lower().strip(EDGES)


def terms_of(word: str, beginnings: tuple[int, ...]) -> list[str]:
    """The word itself, and its beginnings (marked by a star) where something follows."""
    return [word, *[word[:n] + "*" for n in beginnings if len(word) > n]] if word else []


def undisguised(word: str) -> str:
    """The word with look-alike signs read as letters, other signs dropped and drawn-out letters shortened."""
    letters = "".join(c for c in word.translate(PLAIN) if c.isalpha())
    return re.sub(r"(.)\1{2,}", r"\1", letters)


class WordMarks(dict):
    """Bit marks and lexicon weight (in 1/64) of a word."""

    def __init__(self, lexicon: dict[str, float], settings: Settings):
        super().__init__()
        self.lexicon, self.settings = lexicon, settings

    def weight(self, word: str) -> float:
        lexicon = self.lexicon
        best = lexicon.get(word, 0.0)
        for n in self.settings.beginnings:
            if len(word) <= n:
                break
            best = max(best, lexicon.get(word[:n] + "*", 0.0))
        return best

    def __missing__(self, word: str) -> int:
        plain = bare(word)
        weight, marks = self.weight(plain), 0
        inner, drawn = plain.isalpha(), DRAWN_OUT(plain) is not None
        if (drawn or not inner) and any(c.isalpha() for c in plain):
            clear = undisguised(plain)
            if clear != plain:
                marks |= 0 if inner else HIDDEN
                weight = max(weight, self.weight(clear))
        marks |= (SECOND * (plain in SECOND_PERSON)) | (CAPITALS * (len(plain) > 2 and word.isupper()))
        marks |= (LOUD * ("!" in word or "?" in word)) | (DRAWN * drawn) | (HIT * (weight > 0))
        value = marks | int(round(weight * 64)) << SHIFT
        if len(word) <= LONG_WORD:
            if len(self) >= KEPT:
                self.clear()
            self[word] = value
        return value


def count_signs(text: str) -> tuple[int, int]:
    """Punctuation marks, and Latin capitals, of a text."""
    chars = np.frombuffer(text.encode("utf-32-le", "replace"), np.uint32)
    chars = chars[chars < 256]
    kinds = np.bincount(chars, minlength=256)
    return int(kinds[SIGNS].sum()), int(kinds[UPPER].sum())


def text_features(text: str, marks: WordMarks, near: int) -> list[float]:
    words = text.split()
    n = len(words)
    if not n:
        return [0.0] * len(NAMES)
    code = np.fromiter(map(marks.__getitem__, words), np.int64, n)
    hit = np.flatnonzero(code & HIT)
    second = np.flatnonzero(code & SECOND)
    weight = (code[hit] >> SHIFT) / 64.0
    signs, upper = count_signs(text)
    close = 0
    if len(hit) and len(second):
        at = np.searchsorted(second, hit)
        before = hit - second[np.maximum(at - 1, 0)]
        after = second[np.minimum(at, len(second) - 1)] - hit
        close = int(((np.abs(before) <= near) | (np.abs(after) <= near)).sum())
    return [
        len(hit) / n, float(weight.sum()) / n, float(weight.max()) if len(hit) else 0.0, float(weight.sum()),
        close / n, len(second) / n, np.count_nonzero(code & CAPITALS) / n, upper / len(text),
        signs / n, np.count_nonzero(code & LOUD) / n, np.count_nonzero(code & DRAWN) / n,
        np.count_nonzero(code & HIDDEN) / n, float(np.count_nonzero((code & HIDDEN > 0) & (code & HIT > 0))), float(n),
    ]


def learn_lexicon(sample: DataFrame, settings: Settings) -> dict[str, float]:
    """Terms by their smoothed log odds of label 1, counted once a document.

    Documents are counted where they lie, summed up slice by slice before the shuffle by term; the driver receives
    the finished lexicon alone.  The empty term stands for all documents.
    """
    def counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in slices(batches, TEXT):
            sums: dict[str, list[int]] = {}
            labels = batch.column(batch.schema.get_field_index(LABEL)).to_pylist()
            for row_id, label, value in zip(batch.column(0).cast(pa.string()).to_pylist(), labels, texts):
                if part_of(row_id) >= 5:
                    continue
                words = {bare(w) for w in value.decode("utf-8", "replace").split()}
                for term in {"", *(t for w in words for t in terms_of(w, settings.beginnings))}:
                    sums.setdefault(term, [0, 0])[label] += 1
            yield pa.RecordBatch.from_arrays(
                [pa.array(sums, pa.string()), pa.array([n[1] for n in sums.values()], pa.int64()),
                 pa.array([n[0] for n in sums.values()], pa.int64())], names=["term", "toxic", "other"])

    counted = written(
        sample.select(ID, TEXT, LABEL).mapInArrow(counts, "term string, toxic long, other long")
        .groupBy("term").agg(F.sum("toxic").alias("toxic"), F.sum("other").alias("other"))
        .where((F.col("toxic") >= settings.least_docs) | (F.col("term") == "")), "term-counts")
    every = counted.where("term = ''").first()
    if every is None:
        return {}
    share = F.log((F.col("toxic") + 0.1) / max(1, every.toxic)), F.log((F.col("other") + 0.5) / max(1, every.other))
    best = (counted.where("term <> ''").select("term", (share[0] - share[1]).alias("odds"))
            .where(F.col("odds") >= settings.least_odds).orderBy(F.desc("odds"), "term").limit(settings.terms))
    return {r.term: r.odds for r in best.collect()}


def grow(x: np.ndarray, y: np.ndarray, settings: Settings) -> Trees:
    """Boosting on the logistic loss with histogram splits."""
    share = (y.sum() + 1) / (len(y) + 2)
    base = float(np.log(share / (1 - share)))
    edges = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, settings.bins + 1)[1:-1])) for f in range(x.shape[1])]
    # Rare counts would fall into one bin: their own quantiles are added.
    edges = [np.unique(np.concatenate([e, np.quantile(x[x[:, f] > 0, f], np.linspace(0, 1, 9)[:-1]) * 0.999]))
             if (x[:, f] > 0).any() else e for f, e in enumerate(edges)]
    binned = np.stack([np.searchsorted(e, x[:, f], side="left") for f, e in enumerate(edges)], axis=1)
    inner, leaves, width = 2**settings.depth - 1, 2**settings.depth, settings.bins + 12
    raw, features, thresholds, values = np.full(len(y), base), [], [], []
    for _ in range(settings.trees):
        p = 1 / (1 + np.exp(-raw))
        g, h = y - p, p * (1 - p)
        feature, threshold = np.zeros(inner, np.int64), np.full(inner, np.inf)
        node = np.zeros(len(y), np.int64)
        for level in range(settings.depth):
            first, many = 2**level - 1, 2**level
            best = np.full(many, 1e-6)
            for f in range(x.shape[1]):
                if not len(edges[f]):
                    continue
                key = (node - first) * width + binned[:, f]
                sums = np.bincount(key, g, many * width).reshape(many, width).cumsum(1)
                hess = np.bincount(key, h, many * width).reshape(many, width).cumsum(1)
                gl, hl = sums[:, : len(edges[f])], hess[:, : len(edges[f])]
                gt, ht = sums[:, -1:], hess[:, -1:]
                gain = gl**2 / (hl + settings.smooth) + (gt - gl) ** 2 / (ht - hl + settings.smooth) - gt**2 / (ht + settings.smooth)
                at = gain.argmax(1)
                top = gain[np.arange(many), at]
                better = top > best
                best = np.where(better, top, best)
                feature[first : first + many] = np.where(better, f, feature[first : first + many])
                threshold[first : first + many] = np.where(better, edges[f][at], threshold[first : first + many])
            node = 2 * node + 1 + (x[np.arange(len(y)), feature[node]] > threshold[node])
        leaf = node - inner
        value = settings.rate * np.bincount(leaf, g, leaves) / (np.bincount(leaf, h, leaves) + settings.smooth)
        raw += value[leaf]
        features.append(feature), thresholds.append(threshold), values.append(value)
    return Trees(base, np.array(features), np.array(thresholds), np.array(values))


def isotonic(raw: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool adjacent violators; a row of each class is added at either end so that shares stay inside 0 and 1."""
    order = np.argsort(raw, kind="stable")
    at = np.concatenate([[raw.min() - 1], raw[order], [raw.max() + 1]])
    target = np.concatenate([[0.0], y[order], [1.0]])
    blocks: list[list[float]] = []
    for x, value in zip(at, target):
        blocks.append([value, 1.0, x, x])
        while len(blocks) > 1 and blocks[-2][0] >= blocks[-1][0]:
            mean, size, low, high = blocks.pop()
            last = blocks[-1]
            last[0] = (last[0] * last[1] + mean * size) / (last[1] + size)
            last[1], last[3] = last[1] + size, high
    xs = np.array([v for b in blocks for v in (b[2], b[3])])
    ys = np.array([v for b in blocks for v in (b[0], b[0])])
    return xs, ys


def frame_features(docs: DataFrame, lexicon: dict[str, float], settings: Settings, text: str) -> DataFrame:
    """Adds the array ``features`` to every row."""
    schema = T.StructType([*docs.schema.fields, T.StructField("features", T.ArrayType(T.DoubleType()))])
    shared = docs.sparkSession.sparkContext.broadcast(lexicon)  # at most settings.terms entries

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        marks = WordMarks(shared.value, settings)
        for batch, texts in slices(batches, text):
            rows = [text_features(t.decode("utf-8", "replace"), marks, settings.near) for t in texts]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(rows, pa.list_(pa.float64()))],
                                             names=[f.name for f in schema.fields])

    return docs.mapInArrow(run, schema)


def part_of(row_id: str) -> int:
    """0 to 9 by a hash of the id: below 5 the lexicon, below 8 the trees, above the calibration."""
    return zlib.crc32(f"part:{row_id}".encode()) % 10


def fit(docs: DataFrame, labels: DataFrame, learn: Column, settings: Settings = Settings(), *, label: str = "toxic",
        key: str = "doc_id", text: str = "text") -> ToxicityModel:
    """Learn lexicon, trees and calibration from a bounded sample."""
    sample = labelled_sample(docs, labels, label, learn, settings.bound, key, text)
    lexicon = learn_lexicon(sample, settings)
    got = frame_features(sample.select(ID, TEXT, LABEL), lexicon, settings, TEXT).select(
        ID, LABEL, "features").toArrow()
    kept = sorted((str(i), y, x) for i, y, x in zip(got[ID].to_pylist(), got[LABEL].to_pylist(), got["features"].to_pylist()))
    x = np.array([r[2] for r in kept], float).reshape(len(kept), len(NAMES))
    y = np.array([r[1] for r in kept], float)
    part = np.array([part_of(r[0]) for r in kept], int)
    grown, held = (part >= 5) & (part < 8), part >= 8
    if min(y[grown].sum(), (1 - y[grown]).sum(), y[held].sum(), (1 - y[held]).sum()) < 1:
        share = float((y.sum() + 1) / (len(y) + 2)) if len(y) else 0.5
        flat = Trees(0.0, np.zeros((0, 1), np.int64), np.zeros((0, 1)), np.zeros((0, 2)))
        return ToxicityModel(settings, lexicon, flat, (np.zeros(1), np.array([share])))
    trees = grow(x[grown], y[grown], settings)
    return ToxicityModel(settings, lexicon, trees, isotonic(trees.raw(x[held]), y[held]))


def score(docs: DataFrame, model: ToxicityModel, text: str = "text") -> DataFrame:
    """Adds ``score`` (0 to 1, that of label 1) to every row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kept = docs.drop("score")
    schema = T.StructType([*kept.schema.fields, T.StructField("score", T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        marks = WordMarks(known.lexicon, known.settings)
        for batch, texts in slices(batches, text):
            x = np.array([text_features(t.decode("utf-8", "replace"), marks, known.settings.near) for t in texts])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(known.score(x), pa.float64())],
                                             names=[f.name for f in schema.fields])
        marks.clear()
        let_go()

    return kept.mapInArrow(run, schema)
