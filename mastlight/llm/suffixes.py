"""Removal of repeated passages: suffix arrays by two-stage sorting.

A byte goes if it lies in a string of ``length`` bytes that also starts earlier (in a document of a smaller key, or
earlier in its own); what is repeated is judged on the input, not on what is left.

Equal strings must meet without moving the corpus.  A string of 100 bytes has 69 substrings of 32 bytes; the one with
the least hash is its *anchor*, the same wherever the string occurs, and neighbouring strings mostly share it.  So
a document falls into runs of starts with one anchor each, a row of a few numbers per run.  Only runs whose anchor occurs
again go on, with their text, to the task of that anchor (anchors with very many runs are split by the strings
themselves, and of a string with very many starts the earliest is found by a grouped minimum; such a string enters no
task's array).  There, runs of equal text are collapsed, and a suffix array of the rest is built: only suffixes smaller
than their successors are sorted directly, by blocks of eight bytes, the others are induced by scanning the buckets
of first bytes in order.  Starts whose neighbours have ``length`` bytes in common form groups, and all of a group but the
earliest are repeats.  Copies of whole texts are told by their digest before all this.

Results: NULL counts as empty text; texts shorter than ``length`` keep everything.  Keys are integers (NULL comes
first).  Rows that share key and text are one document and have the same result; rows that share the key only are
ordered by the digest of their texts.  Extra columns are not read.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mastlight.llm.common import ODD, _tables, mixed, slices
from mastlight.session import written

LENGTH, ANCHOR = 100, 32
#: Runs of one anchor above which it is split by the strings themselves, and starts of one string above which they
#: are compared with the earliest one instead of being gathered.
HOT_RUNS = 20_000
#: Bytes of text of one suffix array.
ARRAY_BYTES = 1 << 19


def anchored_runs(text: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs of starts that share their anchor: the anchor's hash, the first start, the number of starts."""
    starts = len(text) - LENGTH + 1
    if starts < 1:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    up, down = _tables(1 << max(20, len(text).bit_length()))
    sums = np.zeros(len(text) + 1, np.uint64)
    np.cumsum((text.astype(np.uint64) + np.uint64(1)) * up[: len(text)], out=sums[1:])
    grams = mixed((sums[ANCHOR:] - sums[:-ANCHOR]) * down[: len(text) - ANCHOR + 1])
    bits = np.uint64(len(grams).bit_length())
    packed = (grams >> bits << bits) | np.arange(len(grams), dtype=np.uint64)  # the leftmost of equal ones
    width = LENGTH - ANCHOR + 1
    # Sliding minimum: running minima from both ends of blocks of the window's width.
    full = -(-len(packed) // width) * width
    padded = np.full(full, np.iinfo(np.uint64).max, np.uint64)
    padded[: len(packed)] = packed
    blocks = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, 1).ravel()
    back = np.minimum.accumulate(blocks[:, ::-1], 1)[:, ::-1].ravel()
    least = np.minimum(back[:starts], ahead[width - 1 : width - 1 + starts])
    at = (least & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)
    first = np.flatnonzero(np.concatenate(([True], at[1:] != at[:-1])))
    return grams[at[first]], first, np.diff(np.append(first, starts))


def words_at(text: np.ndarray, size: int) -> np.ndarray:
    """For each position the next ``size`` bytes as one number, in byte order."""
    padded = np.concatenate([text, np.zeros(size, np.uint8)]).astype(np.uint64)
    out = np.zeros(len(text), np.uint64)
    for i in range(size):
        out = (out << np.uint64(8)) | padded[i : i + len(text)]
    return out


def two_stage_array(text: np.ndarray, depth: int = LENGTH) -> np.ndarray:
    """All suffixes of a text in order, as far as their first ``depth`` bytes tell.

    The text ends with a byte 0 that counts as smallest.  First stage: suffixes smaller than their successors are
    sorted.  Second stage: bucket by bucket, each suffix in order puts its predecessor, if that is larger, at the end of
    what its bucket holds so far.
    """
    n = len(text)
    # A suffix is smaller than its successor if its first byte that differs from the next byte is smaller.
    step = np.sign(np.diff(text.astype(np.int16), append=np.int16(-1)))
    step[-1] = 1
    run = np.flatnonzero(step)
    small = step[run[np.searchsorted(run, np.arange(n))]] > 0
    words = words_at(text, 8)
    own = np.flatnonzero(small)
    own = own[np.argsort(words[own], kind="stable")]
    # Refine ties eight bytes at a time; a group is a range of places in the order.
    group = np.concatenate(([0], np.cumsum(words[own][1:] != words[own][:-1])))
    for offset in range(8, depth, 8):
        sizes = np.bincount(group)
        tied = np.flatnonzero(sizes[group] > 1)
        if not len(tied):
            break
        place = own[tied] + offset
        key = np.where(place < n, words[np.minimum(place, n - 1)], 0)
        order = np.lexsort((key, group[tied]))
        own[tied] = own[tied][order]
        key = key[order]
        new = np.zeros(len(own), np.int64)
        later = np.concatenate(([False], (key[1:] != key[:-1]) & (group[tied][1:] == group[tied][:-1])))
        new[tied] = later
        group = np.cumsum(np.concatenate(([0], (group[1:] != group[:-1]).astype(np.int64) | new[1:])))
    first = text[own]
    cuts = np.searchsorted(first, np.arange(257))
    queues: list[list[np.ndarray]] = [[] for _ in range(256)]
    out = []
    for c in np.unique(text):
        induced, last = [], np.concatenate(queues[c]) if queues[c] else np.zeros(0, np.int64)
        while len(last):  # runs of the same byte: predecessors go to the end of this very bucket
            induced.append(last)
            before = last[last > 0] - 1
            last = before[text[before] == c]
        bucket = np.concatenate([*induced, own[cuts[c] : cuts[c + 1]]])
        out.append(bucket)
        before = bucket[bucket > 0] - 1
        before = before[text[before] > c]
        letters = text[before]
        order = np.argsort(letters, kind="stable")
        before, letters = before[order], letters[order]
        edges = np.flatnonzero(np.concatenate(([True], letters[1:] != letters[:-1]))) if len(letters) else []
        for a, b in zip(edges, [*edges[1:], len(letters)]):
            queues[letters[a]].append(before[a:b])
    return np.concatenate(out)


def common_prefixes(text: np.ndarray, order: np.ndarray, depth: int = LENGTH) -> np.ndarray:
    """Bytes that each suffix has in common with the one before it in the order, up to ``depth``, in steps of four."""
    words = words_at(text, 4).astype(np.uint32)
    out = np.zeros(len(order), np.int64)
    alive = np.arange(1, len(order))
    for offset in range(0, depth, 4):
        a, b = order[alive] + offset, order[alive - 1] + offset
        same = (a < len(text)) & (b < len(text))
        same[same] = words[a[same]] == words[b[same]]
        alive = alive[same]
        out[alive] += 4
    return out


def repeats_among(runs: list[bytes], earliest: np.ndarray) -> np.ndarray:
    """For texts of runs, all different, marks by start (one text after another): whether an earlier equal string exists.

    ``earliest`` gives the rank of each start in the order of documents and positions.
    """
    data = np.frombuffer(b"\0".join(runs) + b"\0", np.uint8)
    sizes = np.array([len(r) for r in runs])
    counts = sizes - LENGTH + 1
    base = np.cumsum(sizes + 1) - sizes - 1
    number = np.full(len(data), -1, np.int64)
    starts = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts) + np.repeat(base, counts)
    number[starts] = np.arange(len(starts))
    order = two_stage_array(data)
    order = order[number[order] >= 0]
    group = np.cumsum(common_prefixes(data, order) < LENGTH)
    rank = earliest[number[order]]
    first = np.minimum.reduceat(rank, np.flatnonzero(np.concatenate(([True], group[1:] != group[:-1]))))
    out = np.zeros(len(starts), bool)
    out[number[order]] = rank > first[group - group[0]]
    return out


def _spans(marks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    edges = np.flatnonzero(np.diff(np.concatenate(([0], marks.astype(np.int8), [0]))))
    return edges[0::2], edges[1::2]


def _repeats_of(keys: list, docs: np.ndarray, starts: np.ndarray, texts: list[bytes]) -> Iterator[tuple[int, int, int]]:
    """(doc, first start, starts) of repeats among runs of whole anchors: rows in any order."""
    order = np.lexsort((starts, docs))
    seen: dict[bytes, int] = {}
    kept = []
    for i in order:  # runs of equal text: all but the earliest are repeats throughout
        if texts[i] in seen:
            yield int(docs[i]), int(starts[i]), len(texts[i]) - LENGTH + 1
        else:
            seen[texts[i]] = i
            kept.append(i)
    counts = np.array([len(texts[i]) - LENGTH + 1 for i in kept])
    # Starts rank by document and position; runs of one document do not overlap, so the order of runs gives it.
    marks = repeats_among([texts[i] for i in kept], np.arange(counts.sum()))
    at = 0
    for i, n in zip(kept, counts):
        for a, b in zip(*_spans(marks[at : at + n])):
            yield int(docs[i]), int(starts[i]) + int(a), int(b - a)
        at += n


def _runs(docs: DataFrame) -> DataFrame:
    """(doc, text) to (anchor, doc, start, n)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in slices(batches, "text"):
            ids = batch.column(0).to_numpy()
            parts = [anchored_runs(np.frombuffer(t, np.uint8)) for t in texts]
            sizes = [len(p[0]) for p in parts]
            if sum(sizes):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate([p[0] for p in parts]).view(np.int64)), pa.array(np.repeat(ids, sizes)),
                     pa.array(np.concatenate([p[1] for p in parts]).astype(np.int32)),
                     pa.array(np.concatenate([p[2] for p in parts]).astype(np.int32))], names=["anchor", "doc", "start", "n"])

    return docs.select("doc", "text").mapInArrow(run, "anchor long, doc long, start int, n int")


def _shared_runs(runs: DataFrame) -> DataFrame:
    """Runs whose anchor occurs again; rows of an anchor come together, and no more than a batch is held."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None  # the last row, if the first of its anchor so far
        last = None
        for batch in batches:
            if not batch.num_rows:
                continue
            anchors = batch.column(0).to_numpy()
            same = anchors[1:] == anchors[:-1]
            keep = np.concatenate(([False], same)) | np.concatenate((same, [False]))
            if last is not None and anchors[0] == last:
                keep[0] = True
                if held is not None:
                    yield held
            held = None if keep[-1] else batch.slice(batch.num_rows - 1)
            last = anchors[-1]
            yield batch.filter(pa.array(keep))

    return runs.repartition("anchor").sortWithinPartitions("anchor").mapInArrow(run, runs.schema)


def _run_texts(shared: DataFrame, texts: DataFrame, order: DataFrame) -> tuple[DataFrame, DataFrame | None]:
    """(anchor, doc, start, text): runs with their bytes; and those of hot anchors start by start, named by the string."""
    schema = T.StructType([T.StructField("anchor", T.LongType()), T.StructField("doc", T.LongType()),
                           T.StructField("start", T.IntegerType()), T.StructField("text", T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in slices(batches, "text"):
            for doc, text, runs in zip(batch.column(0).to_pylist(), texts, batch.column(2).to_pylist()):
                anchors, starts, cuts = [], [], []
                for r in runs:
                    if r["hot"]:
                        for s in range(r["start"], r["start"] + r["n"]):
                            cut = text[s : s + LENGTH]
                            anchors.append(int.from_bytes(hashlib.blake2b(cut, digest_size=8).digest(), "big", signed=True))
                            starts.append(s), cuts.append(cut)
                    else:
                        anchors.append(r["anchor"]), starts.append(r["start"])
                        cuts.append(text[r["start"] : r["start"] + r["n"] + LENGTH - 1])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(anchors, pa.int64()), pa.array([doc] * len(cuts), pa.int64()), pa.array(starts, pa.int32()),
                     pa.array(cuts, pa.binary())], names=schema.names)

    hot = shared.groupBy("anchor").agg(F.count("*").alias("k")).where(F.col("k") > HOT_RUNS).select("anchor", F.lit(True).alias("hot"))
    per_doc = written(
        shared.join(hot, "anchor", "left")
        .groupBy("doc").agg(F.collect_list(F.struct("anchor", "start", "n", F.coalesce("hot", F.lit(False)).alias("hot"))).alias("runs"))
        .join(order.select("doc", "mark"), "doc").select("mark", "runs"), "shared-runs")

    def of(hot: bool) -> DataFrame:
        own = per_doc.select("mark", F.filter("runs", lambda r: r["hot"] == F.lit(hot)).alias("runs")).where("size(runs) > 0")
        return texts.join(own, "mark").select("doc", "text", "runs").mapInArrow(run, schema)

    if not per_doc.where(F.exists("runs", lambda r: r["hot"])).limit(1).count():
        return of(False), None
    return of(False), written(of(True), "hot-strings")


def _hot_starts(strings: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Strings that start seldom enough to be gathered; and (doc, start, n) of the others' starts but the earliest."""
    firsts = written(
        strings.groupBy("anchor", "text").agg(F.min(F.struct("doc", "start")).alias("first"), F.count("*").alias("k"))
        .where(F.col("k") > HOT_RUNS).drop("k"), "hot-firsts")
    later = strings.join(firsts, ["anchor", "text"]).where(F.struct("doc", "start") > F.col("first"))
    return (strings.join(firsts, ["anchor", "text"], "left_anti").select(*strings.columns),
            later.select("doc", "start", F.lit(1).alias("n")))


def _earlier_starts(runs: DataFrame) -> DataFrame:
    """(doc, start, n): starts of strings that also start earlier."""
    names = ["doc", "start", "n"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchors: list = []
        docs: list = []
        starts: list = []
        texts: list = []
        held = 0

        def flush(count: int) -> pa.RecordBatch:
            rows = list(_repeats_of(anchors[:count], np.array(docs[:count], np.int64), np.array(starts[:count], np.int64),
                                    texts[:count]))
            del anchors[:count], docs[:count], starts[:count], texts[:count]
            columns = list(zip(*rows)) or [(), (), ()]
            return pa.RecordBatch.from_arrays(
                [pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.int32()), pa.array(columns[2], pa.int32())], names=names)

        for batch in batches:
            for a, d, s, t in zip(*(batch.column(i).to_pylist() for i in range(4))):
                if held > ARRAY_BYTES and a != anchors[-1]:
                    yield flush(len(anchors))
                    held = 0
                anchors.append(a), docs.append(d), starts.append(s), texts.append(t)
                held += len(t)
        if anchors:
            yield flush(len(anchors))

    return runs.repartition("anchor").sortWithinPartitions("anchor").mapInArrow(run, "doc long, start int, n int")


def _texts(rows: DataFrame) -> tuple[DataFrame, DataFrame, str]:
    """The distinct texts of at least ``length`` bytes as a table bucketed by digest (so that they are shuffled once), and
    their places (mark, doc, key) in the order of keys."""
    spark = rows.sparkSession
    order = written(
        rows.where(F.length("text") >= LENGTH).groupBy("mark").agg(F.min(F.struct(F.col("key").isNotNull().alias("has"), "key")).alias("first"))
        .select("mark", "first.key").orderBy(F.asc_nulls_first("key"), "mark")
        .select("mark", "key", F.monotonically_increasing_id().alias("doc")), "text-order")
    name = f"repeats_{uuid.uuid4().hex}"
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    (
        rows.where(F.length("text") >= LENGTH).groupBy("mark").agg(F.first("text").alias("text")).join(order.select("mark", "doc"), "mark")
        .repartition(parts, "mark").write.bucketBy(parts, "mark").saveAsTable(name)
    )
    return spark.table(name), order, name


def _stay(spans: DataFrame, texts: DataFrame, digests: bool) -> DataFrame:
    """(mark, n_removed, n_spans, kept) of every distinct text."""
    kind = T.StringType() if digests else T.BinaryType()
    schema = T.StructType([T.StructField("mark", T.StringType()), T.StructField("n_removed", T.LongType()),
                           T.StructField("n_spans", T.LongType()), T.StructField("kept", kind)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, values in slices(batches, "text"):
            rows = []
            for text, spans in zip(values, batch.column(2).to_pylist()):
                edges = np.zeros(len(text) + 1, np.int64)
                for s in spans or ():
                    edges[s["start"]] += 1
                    edges[s["start"] + s["n"] + LENGTH - 1] -= 1
                gone = np.cumsum(edges)[:-1] > 0
                left = np.frombuffer(text, np.uint8)[~gone].tobytes() if spans else text
                rows.append((int(gone.sum()), len(_spans(gone)[0]), hashlib.sha256(left).hexdigest() if digests else left))
            columns = list(zip(*rows))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.int64()),
                 pa.array(columns[2], pa.string() if digests else pa.binary())], names=schema.names)

    return texts.select("mark", "text").join(spans, "mark", "left").select("mark", "text", "spans").mapInArrow(run, schema)


def remove_repeats(docs: DataFrame, *, key: str = "doc_id", text: str = "text", digests: bool = False) -> DataFrame:
    """Per row: key, n_bytes, n_removed, n_spans (maximal removed stretches), and the bytes that stay: ``kept`` (binary),
    or with ``digests`` their SHA-256 as ``kept_sha256``."""
    spark = docs.sparkSession
    value = F.coalesce(F.col(text).cast("string"), F.lit("")).cast("binary")
    rows = docs.select(F.col(key).cast("long").alias("key"), value.alias("text")).withColumn("mark", F.md5("text"))
    texts, order, name = _texts(rows)
    shared = written(_shared_runs(_runs(texts)), "runs")
    runs, strings = _run_texts(shared, texts, order)
    if strings is None:
        starts = _earlier_starts(runs)
    else:
        seldom, later = _hot_starts(strings)
        starts = _earlier_starts(runs.unionByName(seldom)).unionByName(later)
    spans = written(
        starts.groupBy("doc").agg(F.collect_list(F.struct("start", "n")).alias("spans"))
        .join(order.select("doc", "mark"), "doc").select("mark", "spans"), "repeats")
    first = order.select("mark", F.col("key").alias("first"))
    stay = written(_stay(spans, texts, digests).join(first, "mark"), "stay")
    spark.sql(f"DROP TABLE {name}")
    content = F.sha2("text", 256) if digests else F.col("text")
    nothing = F.sha2(F.lit("").cast("binary"), 256) if digests else F.lit("").cast("binary")
    short = F.length("text") < LENGTH
    plain = rows.select("key", "mark", F.length("text").cast("long").alias("n_bytes"), F.when(short, content).alias("own"))
    joined = plain.join(stay, "mark", "left")
    copy = F.col("n_removed").isNotNull() & ~F.col("key").eqNullSafe(F.col("first"))
    zero = F.lit(0).cast("long")
    return joined.select(
        F.col("key").alias(key), "n_bytes",
        F.when(copy, F.col("n_bytes")).otherwise(F.coalesce("n_removed", zero)).alias("n_removed"),
        F.when(copy, zero + 1).otherwise(F.coalesce("n_spans", zero)).alias("n_spans"),
        F.when(copy, nothing).otherwise(F.coalesce("kept", "own")).alias("kept_sha256" if digests else "kept"))
