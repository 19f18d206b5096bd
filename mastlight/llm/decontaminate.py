"""Benchmark decontamination with a positional inverted index.

The index is a table of shards.  A shard covers some documents (a quarter of a megabyte of text, never part of a document)
and holds, per distinct term, the ascending list of its positions; documents lie apart by more positions than any window
is long, so no match crosses them.  Test items are cut into windows of ten words (a shorter item is one
window); windows are gathered into blocks of bounded size in tasks.  In each shard a window's lists are looked up; a missing term ends it.  The shortest list, of the rarest
term, gives candidate places, and the others' lists, shifted by their offsets, are intersected with them from rare to
frequent.  What is left are exact phrases.  A proximity search keeps places of the rarest term that have all other
terms of the window within a distance.  Shards need no shuffle; the driver hands on the finished blocks of windows, one by one.

Terms are compared by 64-bit hashes of their bytes.  Two different terms share one with a probability of 2**-64, so among
a billion distinct terms of the corpus and a million of the items one is mistaken for another with a probability under 0.0001;
a wrong hit needs that for a term whose neighbours match as well.

Results: NULL and empty texts have no words and no hits.  Items without words have no windows; items with a NULL id
mark words as hit but cannot be listed.  Items of equal text are all listed, repeated items once.  Every row of the
documents comes back, told apart by its key and text.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from mastlight.llm.common import byte_class, hashed_words, let_go, slices
from mastlight.session import passing_tables, written

#: Words are digits, lower-case letters and everything outside ASCII, after A-Z became lower case.
WORD_BYTES = byte_class((0x30, 0x39), (0x61, 0x7A), (0x80, 0xFF))
LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
WINDOW = 10
#: Positions between documents; a distance in a proximity search must stay below.
GAP = 64
#: Bytes of text of a shard; windows that are broadcast together (about 50 bytes each), and those cut from an item at a time.
SHARD_BYTES, BLOCK_WINDOWS, PART = 1 << 18, 1 << 16, 1 << 14


def index(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The index: per shard the documents' keys, word counts and first positions, the terms, and their position lists."""
    schema = T.StructType([
        T.StructField("keys", T.ArrayType(docs.schema[key].dataType)), T.StructField("counts", T.ArrayType(T.LongType())),
        T.StructField("bases", T.BinaryType()), T.StructField("terms", T.BinaryType()),
        T.StructField("begins", T.BinaryType()), T.StructField("positions", T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in slices(batches, "text", SHARD_BYTES):
            words, first, _, _ = hashed_words([t.translate(LOWER) for t in texts], WORD_BYTES)
            counts = np.diff(first)
            bases = first[:-1] + GAP * np.arange(1, len(texts) + 1)
            positions = np.arange(len(words)) + np.repeat(GAP * np.arange(1, len(texts) + 1), counts)
            order = np.argsort(words, kind="stable")
            terms, begins = np.unique(words[order], return_index=True)
            keys = pa.ListArray.from_arrays(pa.array([0, len(texts)], pa.int32()), batch.column(0))
            yield pa.RecordBatch.from_arrays(
                [keys, pa.array([counts], pa.list_(pa.int64())), *[pa.array([x.tobytes()], pa.binary()) for x in (
                    bases.astype(np.int32), terms, np.append(begins, len(words)).astype(np.int32),
                    positions[order].astype(np.int32))]], names=schema.names)
        let_go()

    return docs.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text")).mapInArrow(run, schema)


class Windows:
    """The distinct windows of a block of items: their terms, term numbers (-1 beyond the end), and the items of each."""

    def __init__(self, items: list[np.ndarray], size: int = WINDOW):
        """From the words of items or parts of items; the number of an item is its place in the list."""
        self.terms = np.unique(np.concatenate([*items, np.zeros(0, np.uint64)]))
        rows, owners = [np.zeros((0, size), np.int32)], [np.zeros(0, np.int32)]
        for number, words in enumerate(items):
            if len(words):
                places = np.searchsorted(self.terms, words).astype(np.int32)
                if len(places) < size:
                    places = np.append(places, np.full(size - len(places), -1, np.int32))
                rows.append(np.lib.stride_tricks.sliding_window_view(places, size))
                owners.append(np.full(len(rows[-1]), number, np.int32))
        self.grid, which = np.unique(np.concatenate(rows), axis=0, return_inverse=True)
        self.lengths = (self.grid >= 0).sum(1)
        pairs = np.unique(np.stack([which.reshape(-1).astype(np.int64), np.concatenate(owners)], 1), axis=0)
        self.numbers = pairs[:, 1]
        self.begins = np.searchsorted(pairs[:, 0], np.arange(len(self.grid) + 1))

    def items_of(self, windows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For windows in any order: how many items each has, and these items' numbers one after another."""
        many = np.diff(self.begins)[windows]
        inner = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
        return many, self.numbers[np.repeat(self.begins[windows], many) + inner]


class Shard:
    """Position lists of one shard."""

    def __init__(self, terms: bytes, begins: bytes, positions: bytes):
        self.terms = np.frombuffer(terms, np.uint64)
        self.begins = np.frombuffer(begins, np.int32).astype(np.int64)
        self.positions = np.frombuffer(positions, np.int32).astype(np.int64)
        # Lists one after another, told apart by their term's place: one sorted array to look positions up in.
        self.keyed = (np.repeat(np.arange(len(self.terms)), np.diff(self.begins)) << 32) | self.positions

    def lists(self, windows: Windows) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The windows all of whose terms occur, each cell's list, and its length (a large number beyond the end)."""
        at = np.minimum(np.searchsorted(self.terms, windows.terms), max(len(self.terms) - 1, 0))
        there = self.terms[at] == windows.terms if len(self.terms) else np.zeros(len(at), bool)
        sizes = np.append(np.where(there, np.diff(self.begins)[at] if len(self.terms) else 0, 0), 1 << 40)
        alive = np.flatnonzero((sizes[windows.grid] > 0).all(1)) if len(windows.grid) else np.zeros(0, np.int64)
        return alive, np.append(at, -1)[windows.grid[alive]], sizes[windows.grid[alive]]

    def candidates(self, lists: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Row, and position, of each entry of each row's shortest list; and the cells of each row, rarest first."""
        order = np.argsort(sizes, axis=1, kind="stable")
        rare = order[:, 0]
        many = sizes[np.arange(len(rare)), rare]
        row = np.repeat(np.arange(len(rare)), many)
        inner = np.arange(len(row)) - np.repeat(np.cumsum(many) - many, many)
        return row, self.positions[self.begins[lists[row, rare[row]]] + inner], order

    def holds(self, lists: np.ndarray, positions: np.ndarray) -> np.ndarray:
        """Whether each list holds the position."""
        wanted = (lists << 32) | positions
        at = np.minimum(np.searchsorted(self.keyed, wanted), len(self.keyed) - 1)
        return self.keyed[at] == wanted

    def phrases(self, windows: Windows) -> tuple[np.ndarray, np.ndarray]:
        """Window number and start position of every exact occurrence."""
        alive, lists, sizes = self.lists(windows)
        if not len(alive):
            return alive, alive
        row, position, order = self.candidates(lists, sizes)
        start = position - order[row, 0]
        for step in range(1, order.shape[1]):
            cell = order[row, step]
            beyond = lists[row, cell] < 0
            keep = beyond | self.holds(np.where(beyond, 0, lists[row, cell]), np.maximum(start + cell, 0))
            row, start = row[keep], start[keep]
        return alive[row], start

    def near(self, windows: Windows, distance: int) -> tuple[np.ndarray, np.ndarray]:
        """Window number and position of the rarest term wherever all others lie within the distance."""
        alive, lists, sizes = self.lists(windows)
        if not len(alive):
            return alive, alive
        row, position, order = self.candidates(lists, sizes)
        for step in range(1, order.shape[1]):
            listed = lists[row, order[row, step]]
            low = np.searchsorted(self.keyed, (np.maximum(listed, 0) << 32) | np.maximum(position - distance, 0))
            nearest = self.keyed[np.minimum(low, len(self.keyed) - 1)]
            keep = (listed < 0) | ((nearest >> 32 == listed) & (np.abs((nearest & 0xFFFFFFFF) - position) <= distance))
            row, position = row[keep], position[keep]
        return alive[row], position


def window_blocks(items: DataFrame, key: str, text: str) -> DataFrame:
    """(names, windows): blocks of windows of bounded size, each pickled, with the keys of their items."""
    named = T.ArrayType(items.schema[key].dataType)
    name_type = to_arrow_type(items.schema[key].dataType)

    def parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in slices(batches, "text", SHARD_BYTES):
            words, first, _, _ = hashed_words([t.translate(LOWER) for t in texts], WORD_BYTES)
            owners, cut = [], []
            for i in range(len(texts)):
                own = words[first[i]:first[i + 1]]
                for begin in range(0, max(1, len(own) - WINDOW + 1) if len(own) else 0, PART):
                    owners.append(i)
                    cut.append(own[begin:begin + PART + WINDOW - 1])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(owners, pa.int32())), pa.array([c.tobytes() for c in cut], pa.binary()),
                 pa.array([max(1, len(c) - WINDOW + 1) for c in cut], pa.int64())], names=["name", "words", "n"])

    texts = items.select(F.col(key).alias("name"), F.col(text).cast("string").alias("text")).where("text is not null").distinct()
    cut = written(texts.mapInArrow(parts, T.StructType([
        T.StructField("name", named.elementType), T.StructField("words", T.BinaryType()), T.StructField("n", T.LongType())])), "windows")
    blocks = -(-(cut.agg(F.sum("n")).first()[0] or 0) // BLOCK_WINDOWS)

    def gathered(rows: pa.Table) -> pa.Table:
        windows = Windows([np.frombuffer(w, np.uint64) for w in rows["words"].to_pylist()])
        names = pa.ListArray.from_arrays(pa.array([0, rows.num_rows], pa.int32()), rows["name"].combine_chunks().cast(name_type))
        return pa.Table.from_arrays([names, pa.array([pickle.dumps(windows)], pa.binary())], names=["names", "windows"])

    dealt = cut.withColumn("block", F.pmod(F.xxhash64("words"), F.lit(max(1, blocks))))
    return written(dealt.groupBy("block").applyInArrow(
        gathered, T.StructType([T.StructField("names", named), T.StructField("windows", T.BinaryType())])), "blocks")


def matches(shards: DataFrame, items: DataFrame, *, item_key: str = "item_id", item_text: str = "text",
            distance: int | None = None) -> DataFrame:
    """Every occurrence: key, item, start (in words of the document) and length.

    Exact phrases by default; with ``distance`` (below GAP) the places of a window's rarest term that have all its
    other terms within that distance, with length 1.  Items of each block are looked up in every shard.
    """
    if distance is not None and not 0 < distance < GAP:
        raise ValueError(f"distance must lie between 1 and {GAP - 1}")
    spark = shards.sparkSession
    schema = T.StructType([T.StructField("key", shards.schema["keys"].dataType.elementType),
                           T.StructField("item", items.schema[item_key].dataType), T.StructField("start", T.LongType()),
                           T.StructField("length", T.LongType())])
    item_type = to_arrow_type(schema["item"].dataType)
    out = spark.createDataFrame([], schema)
    for block in window_blocks(items, item_key, item_text).toLocalIterator():  # one block at a time
        shared = spark.sparkContext.broadcast((bytes(block.windows), block.names))

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            windows, names = pickle.loads(shared.value[0]), pa.array(shared.value[1], item_type)
            for batch in batches:
                columns = {name: batch.column(i) for i, name in enumerate(batch.schema.names)}
                for s in range(batch.num_rows):
                    bases = np.frombuffer(columns["bases"][s].as_py(), np.int32).astype(np.int64)
                    shard = Shard(*[columns[c][s].as_py() for c in ("terms", "begins", "positions")])
                    window, place = shard.phrases(windows) if distance is None else shard.near(windows, distance)
                    if not len(window):
                        continue
                    doc = np.searchsorted(bases, place, side="right") - 1
                    length = windows.lengths[window] if distance is None else np.ones(len(window), np.int64)
                    many, item = windows.items_of(window)
                    doc, start, length = (np.repeat(x, many) for x in (doc, place - bases[doc], length))
                    yield pa.RecordBatch.from_arrays(
                        [columns["keys"][s].values.take(pa.array(doc)), names.take(pa.array(item)), pa.array(start),
                         pa.array(length)], names=schema.names)
            let_go()

        out = out.unionByName(shards.select("keys", "bases", "terms", "begins", "positions").mapInArrow(run, schema))
    return out


def covered_words(spans: str) -> Column:
    """Words covered by an array of (start, end) structs, overlaps counted once."""
    return F.aggregate(
        F.array_sort(spans), F.struct(F.lit(0).cast("long").alias("reach"), F.lit(0).cast("long").alias("n")),
        lambda seen, x: F.struct(
            F.greatest(seen["reach"], x["end"]).alias("reach"),
            (seen["n"] + F.greatest(x["end"] - F.greatest(x["start"], seen["reach"]), F.lit(0))).alias("n")),
        lambda seen: seen["n"])


def report(docs: DataFrame, items: DataFrame, *, key: str = "doc_id", text: str = "text", item_key: str = "item_id",
           item_text: str = "text") -> DataFrame:
    """Per row of the documents: key, ``mark`` (a hash of the text), n_words, n_hit, the items found (sorted as strings,
    distinct), n_items and contaminated."""
    own = F.struct(F.col(key).alias("id"), F.xxhash64(F.col(text).cast("string")).alias("mark"))
    shards = written(index(docs.select(own.alias("key"), F.col(text).alias("text")), "key", "text"), "postings")
    totals = shards.select(F.explode(F.arrays_zip("keys", "counts")).alias("r")).select(
        F.col("r.keys.id").alias(key), F.col("r.keys.mark").alias("mark"), F.col("r.counts").alias("n_words"))
    hits = (
        matches(shards, items, item_key=item_key, item_text=item_text)
        .groupBy(F.col("key.id").alias("__id"), F.col("key.mark").alias("__mark"))
        .agg(F.collect_set(F.struct("start", (F.col("start") + F.col("length")).alias("end"))).alias("spans"),
             F.sort_array(F.collect_set(F.col("item").cast("string"))).alias("items"))
        .select("__id", "__mark", covered_words("spans").alias("n_hit"), "items")
    )
    return (
        totals.join(hits, totals[key].eqNullSafe(hits["__id"]) & (totals["mark"] == hits["__mark"]), "left").drop("__id", "__mark")
        .withColumn("n_hit", F.coalesce("n_hit", F.lit(0).cast("long")))
        .withColumn("items", F.coalesce("items", F.array().cast("array<string>")))
        .withColumn("n_items", F.size("items").cast("long")).withColumn("contaminated", F.col("n_hit") > 0)
    )


def clean(docs: DataFrame, items: DataFrame, *, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` in which no window of the items occurs; columns as they are."""
    with passing_tables(docs.sparkSession):
        bad = written(report(docs, items, key=key, text=text).where("contaminated").select(
            F.col(key).alias("__id"), F.col("mark").alias("__mark")).distinct(), "contaminated")
    rows = docs.withColumn("__own", F.xxhash64(F.col(text).cast("string")))
    return rows.join(bad, rows[key].eqNullSafe(bad["__id"]) & (rows["__own"] == bad["__mark"]), "left_anti").drop("__own")
