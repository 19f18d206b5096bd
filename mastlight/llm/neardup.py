"""Near-duplicate documents by a chosen-path set similarity join.

A document's set holds its distinct shingles of five words.  Documents with equal sets are one *class*; the join runs
between classes.  Several independent trees of nodes are grown: a node chooses some minwise functions, and each of its
members moves to the child named by its minimum under that function, so that similar sets share children and others
part.  A node of few members is compared exhaustively.  A larger one compares all members with one pivot, gives
those linked to it a common tag, and goes on branching; a node whose members all have one tag is done, so large groups
of near copies end after a pivot or two instead of being paired off.  Nodes that are still large at the last depth are
compared exhaustively too: no candidate is capped.

Two sets of similarity s share some child of a node with probability 1 - (1 - s)^branches.  With two branches and two
levels a tree keeps a pair of similarity 0.75 with a probability of 0.912 even where nodes stay large; no two nodes of any
trees share a function, so four trees lose it with 6.0 in 100,000, and more similar pairs far more seldom.  Every link
is confirmed on the full sets.

Results: NULL, empty texts and texts without words have the empty set and no links; fewer than five words make one
shingle.  Every row comes back.  Repeated rows are alike in all columns; rows that share a key and differ in their texts
are documents of their own.  Rows with NULL keys take part, but cannot name a component: it is named by its smallest
other key, and where there is none (or a lone row has a NULL key) the component is NULL; rows with a NULL key are
kept.  Extra columns pass through, but for those named like the added ones, which are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mastlight.llm.common import byte_class, hashed_words, mixed, powers, slices
from mastlight.llm.components import connected_components, each_once
from mastlight.session import passing_tables, remove_folder, written, written_at

#: Words are what lies between blank and U+0009 to U+000D.
WORD_BYTES = byte_class((0, 8), (14, 31), (33, 255))
#: Functions that centrality is estimated from.
CENTRAL = 16
#: Shingles compared at once.
COLUMNS = 4096
LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


@dataclass(frozen=True)
class Settings:
    """``percent``: link sets with 100 * intersection >= percent * union.  ``leaf``: members that a node may have to
    be compared exhaustively.  ``functions``: minwise functions kept per set.  ``block``: members of a large
    node that meet as many others in a task."""

    words: int = 5
    percent: int = 75
    trees: int = 4
    branches: int = 2
    depth: int = 2
    pivots: int = 8
    block: int = 300
    leaf: int = 24
    functions: int = 30
    seed: int = 11

    def __post_init__(self) -> None:
        if self.trees * self.nodes > self.functions:
            raise ValueError("independent trees need a function for each node")

    @property
    def nodes(self) -> int:
        """Nodes of a full tree below its root."""
        return sum(self.branches**d for d in range(1, self.depth + 1))


def function_of(tree: int, node: int, settings: Settings) -> int:
    """The minwise function by which members enter a node (numbered over the tree's levels); each node of each tree has
    its own."""
    order = np.random.default_rng(settings.seed).permutation(settings.functions)
    return int(order[tree * settings.nodes + node - 1])


def shingles(texts: list[bytes], size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the shingles of all texts, and where each text's begin; short texts have one of all their words."""
    words, first, _, _ = hashed_words([t.translate(LOWER) for t in texts], WORD_BYTES)
    counts = np.diff(first)
    many = np.where(counts >= size, counts - size + 1, np.minimum(counts, 1))
    begins = np.concatenate(([0], np.cumsum(many)))
    weights = powers(size + 1, np.uint64(0xD6E8FEB86659FD93))
    n = max(len(words) - size + 1, 0)
    total = np.zeros(n, np.uint64)
    for i in range(size):
        total += words[i : i + n] * weights[size - i]
    total = mixed(total)
    out = np.zeros(begins[-1], np.uint64)
    text = np.repeat(np.arange(len(texts)), many)
    place = np.arange(len(out)) - begins[text] + first[text]
    full = counts[text] >= size
    out[full] = total[place[full]]
    short = np.flatnonzero((counts > 0) & (counts < size))
    value = counts[short].astype(np.uint64)
    for i in range(size - 1):
        more = counts[short] > i
        value[more] = mixed(value[more] * weights[1] + words[first[short[more]] + i])
    out[begins[short]] = value
    return out, begins


def _prints(docs: DataFrame, settings: Settings) -> DataFrame:
    """(id, mark, text) to (id, mark, n, digest, minima): set size, digest of the set (NULL if empty), minima under all
    functions."""
    random = np.random.default_rng(settings.seed)
    odd = random.integers(0, 2**63, settings.functions, np.uint64) * np.uint64(2) + np.uint64(1)
    schema = T.StructType([docs.schema["id"], docs.schema["mark"], T.StructField("n", T.LongType()),
                           T.StructField("digest", T.StringType()), T.StructField("minima", T.ArrayType(T.LongType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in slices(batches, "text"):
            values, begins = shingles(texts, settings.words)
            counts = np.diff(begins)
            order = np.lexsort((values, np.repeat(np.arange(len(texts)), counts)))
            values = values[order]
            new = np.ones(len(values), bool)
            new[1:] = values[1:] != values[:-1]
            new[begins[:-1][counts > 0]] = True
            full = np.flatnonzero(counts > 0)
            if len(full):
                starts = begins[full]
                sizes = np.zeros(len(texts), np.int64)
                sizes[full] = np.add.reduceat(new.astype(np.int64), starts)
                high = np.add.reduceat(np.where(new, mixed(values + np.uint64(1)), np.uint64(0)), starts)
                low = np.add.reduceat(np.where(new, mixed(values ^ odd[0]), np.uint64(0)), starts)
                folded = values ^ (values >> np.uint64(29))
                least = np.stack([np.minimum.reduceat(folded * o, starts) for o in odd], 1).view(np.int64)
            else:
                sizes = np.zeros(len(texts), np.int64)
            digests: list[str | None] = [None] * len(texts)
            minima: list[list[int]] = [[]] * len(texts)
            for row, t in enumerate(full):
                digests[t], minima[t] = f"{sizes[t]:x}-{high[row]:016x}{low[row]:016x}", least[row].tolist()
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(sizes, pa.int64()), pa.array(digests, pa.string()),
                 pa.array(minima, pa.list_(pa.int64()))], names=schema.names)

    return docs.select("id", "mark", "text").mapInArrow(run, schema)


def _sets(texts: DataFrame, settings: Settings) -> DataFrame:
    """(class, text) to (class, set): distinct shingle hashes."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, values in slices(batches, "text"):
            hashes, begins = shingles(values, settings.words)
            rows = [np.unique(hashes[a:b]).view(np.int64) for a, b in zip(begins, begins[1:])]
            offsets = pa.array(np.concatenate(([0], np.cumsum([len(r) for r in rows]))), pa.int32())
            lists = pa.ListArray.from_arrays(offsets, pa.array(np.concatenate(rows) if rows else [], pa.int64()))
            yield pa.RecordBatch.from_arrays([batch.column(0), lists], names=["class", "set"])

    return texts.select("class", "text").mapInArrow(run, "class long, set array<long>")


def _children(tree: Column, node: Column, path: Column, settings: Settings) -> Column:
    """The children of a member of a node: (tree, number in the tree, path).

    ``path`` hashes the minima chosen on the way, so equal paths are the same node; numbers count the nodes of a full
    tree level by level and fix the function that a node's members are split by.
    """
    total = settings.nodes
    table = F.array(*[F.lit(function_of(t, n, settings)) for t in range(settings.trees) for n in range(1, total + 1)])

    def child(j: int) -> Column:
        number = node * settings.branches + 1 + j
        function = F.get(table, (tree * total + number - 1).cast("int"))
        return F.struct(tree.cast("int").alias("tree"), number.cast("int").alias("node"),
                        F.xxhash64(path, number, F.get("minima", function)).alias("path"))

    return F.explode(F.array(*[child(j) for j in range(settings.branches)])).alias("at")


def _alike(n: str, m: str, percent: int) -> Column:
    """Whether two sets of these sizes can be linked."""
    return 100 * F.least(F.col(n), F.col(m)) >= percent * F.greatest(F.col(n), F.col(m))


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) that hold on the full sets."""
    left = sets.select(F.col("class").alias("a"), F.col("set").alias("set_a"))
    right = sets.select(F.col("class").alias("b"), F.col("set").alias("set_b"))
    common = F.size(F.array_intersect("set_a", "set_b"))
    union = F.size("set_a") + F.size("set_b") - common
    return pairs.join(left, "a").join(right, "b").where(100 * common >= percent * union).select("a", "b")


def _leaf_pairs(members: DataFrame, settings: Settings) -> DataFrame:
    """All pairs of a node's members that differ in their tags and whose sizes allow a link."""
    node = members.select("tree", "path", F.col("class").alias("a"), "n", "tag")
    other = members.select("tree", "path", F.col("class").alias("b"), F.col("n").alias("m"), F.col("tag").alias("other"))
    return (
        node.join(other, ["tree", "path"])
        .where((F.col("a") < F.col("b")) & (F.col("tag") != F.col("other")) & _alike("n", "m", settings.percent))
        .select("a", "b")
    )


def _block_links(members: DataFrame, sets: DataFrame, settings: Settings) -> DataFrame:
    """Links between members of large nodes: blocks of members meet block by block, and only links leave a task, each
    once for every node it is found in."""
    blocks = F.ceil(F.col("size") / settings.block).cast("int")
    own = F.pmod(F.xxhash64("class", F.lit(-1)), blocks).cast("int")
    spread = (
        members.select("tree", "path", "class", "tag", own.alias("own"), F.explode(F.sequence(F.lit(0), blocks - 1)).alias("x"))
        .select("tree", "path", "class", "tag", F.least("own", "x").alias("i"), F.greatest("own", "x").alias("j"),
                (F.col("own") == F.least("own", "x")).alias("first"))
        .join(sets, "class")
    )

    def compare(group: pa.Table) -> pa.Table:
        names, tags = group["class"].to_numpy(), group["tag"].to_numpy()
        lists = group["set"].combine_chunks()
        sizes = np.diff(lists.offsets.to_numpy())
        values, inverse, times = np.unique(lists.flatten().to_numpy(), return_inverse=True, return_counts=True)
        shared = times[inverse] > 1  # shingles of one member only join nobody
        column = (np.cumsum(times > 1) - 1)[inverse[shared]]
        row = np.repeat(np.arange(len(names)), sizes)[shared]
        first = np.flatnonzero(group["first"].to_numpy(zero_copy_only=False))
        second = first if group["i"][0].as_py() == group["j"][0].as_py() else np.setdiff1d(np.arange(len(names)), first)
        common = np.zeros((len(first), len(second)), np.float32)
        for begin in range(0, int(column.max(initial=-1)) + 1, COLUMNS):
            part = (column >= begin) & (column < begin + COLUMNS)
            grid = np.zeros((len(names), COLUMNS), np.float32)
            grid[row[part], column[part] - begin] = 1
            common += grid[first] @ grid[second].T
        union = sizes[first][:, None] + sizes[second][None, :] - common
        hit = (100 * common >= settings.percent * union) & (tags[first][:, None] != tags[second][None, :])
        x, y = np.nonzero(hit)
        a, b = names[first[x]], names[second[y]]
        return pa.table({"a": pa.array(np.minimum(a, b), pa.int64()), "b": pa.array(np.maximum(a, b), pa.int64())})

    return spread.groupBy("tree", "path", "i", "j").applyInArrow(compare, "a long, b long")


def with_centrality(classes: DataFrame) -> DataFrame:
    """The classes, written, with ``central``: how many classes share a class's minima, over the last few functions; that
    estimates its similarity to all others summed up, so it is highest for what a group of copies was made from."""
    picked = F.slice("minima", -CENTRAL, CENTRAL)
    own = classes.select("class", F.posexplode(picked).alias("f", "value"))
    shared, shared_at = written_at(own.groupBy("f", "value").agg(F.count("*").alias("k")).where("k > 1"), "shared-minima")
    central = own.join(shared, ["f", "value"], "left").groupBy("class").agg(F.coalesce(F.sum("k"), F.lit(0)).alias("central"))
    found = written(classes.join(central, "class"), "central")
    remove_folder(classes.sparkSession, shared_at)
    return found


def links_between(classes: DataFrame, texts: DataFrame, settings: Settings) -> DataFrame:
    """Links (a, b) between classes (class, n, minima, central, id, mark); ``texts`` (id, mark, text) holds the documents.

    All links that matter for components are found, some more than once; two classes already tied by a common tag need no
    own link.  The many links of a group with its pivots are handed on as one link per class, with its tag.  What a level
    has written is removed once the next level is there.
    """
    spark = classes.sparkSession
    members = (
        classes.select("class", "n", "central", "minima", F.explode(F.sequence(F.lit(0), F.lit(settings.trees - 1))).alias("tree"))
        .select("class", "n", "central", F.col("class").alias("tag"),
                _children(F.col("tree"), F.lit(0), F.xxhash64("tree"), settings))
        .select("class", "n", "central", "tag", "at.*")
    )
    pairs, tied, sets, depth, level_at = [], None, None, 1, None
    while True:
        # What a node holds, summed up before the shuffle and written, so that the join below can split hot nodes.
        # The most central member of each lane is a pivot: a group that meets in many nodes has the same ones there.
        one = F.struct((-F.col("central")).alias("h"), F.col("class").alias("pivot"), F.col("n").alias("m"), F.col("tag").alias("other"))
        lane = F.pmod(F.xxhash64("class", F.lit(depth)), F.lit(settings.pivots))
        stats, stats_at = written_at(
            members.groupBy("tree", "path")
            .agg(F.count("*").alias("size"), F.min("tag").alias("low"), F.max("tag").alias("high"),
                 F.array(*[F.min(F.when(lane == i, one)) for i in range(settings.pivots)]).alias("pivots"))
            .where("size > 1 and low <> high").drop("low", "high"), "node-stats")
        members, members_at = written_at(members.join(stats, ["tree", "path"]).withColumn(
            "pivots", F.when(F.col("size") > settings.leaf, F.col("pivots"))), "node-members")
        remove_folder(spark, stats_at)
        if level_at:
            remove_folder(spark, level_at)
        level_at = members_at
        if sets is None:  # of classes that share a node with another; the rest are done
            open_ = classes.join(members.select("class").distinct(), "class", "left_semi").select("class", "id", "mark")
            whole = texts.join(open_, texts["id"].eqNullSafe(open_["id"]) & (texts["mark"] == open_["mark"])).select("class", "text")
            sets = written(_sets(whole, settings).dropDuplicates(["class"]), "sets")
        met = _leaf_pairs(members.where(F.col("size") <= settings.leaf), settings)
        large = members.where(F.col("size") > settings.leaf)
        crowded = large.limit(1).count() > 0
        if depth >= settings.depth or not crowded:
            pairs.append(met)
            break
        pairs.append(written(met, "leaf-pairs"))  # at most leaf - 1 a class and node; repeats go with those of the other levels
        tried = (
            large.select("class", "n", "tag", F.explode("pivots").alias("p")).select("class", "n", "tag", "p.*")
            .where((F.col("tag") != F.col("other")) & _alike("n", "m", settings.percent))
            .select(F.col("pivot").alias("a"), F.col("class").alias("b")).distinct()
        )
        new = confirmed(tried, sets, settings.percent)
        tags = connected_components(written(each_once(new if tied is None else tied.unionByName(new)), "pivot-links")).withColumnRenamed("id", "class")
        tied = tags.where("class <> component").select(F.col("class").alias("a"), F.col("component").alias("b"))
        members = (
            large.join(tags, "class", "left").withColumn("tag", F.coalesce("component", "class"))
            .join(classes.select("class", "minima"), "class")
            .select("class", "n", "central", "tag", _children(F.col("tree"), F.col("node"), F.col("path"), settings))
            .select("class", "n", "central", "tag", "at.*")
        )
        depth += 1
    # Written, so that the join below knows how few they are before it shuffles any set.
    candidates = written(reduce(DataFrame.unionByName, pairs).distinct(), "candidates")
    found = confirmed(candidates, sets, settings.percent)
    if crowded:
        found = found.unionByName(_block_links(large, sets, settings))
    return found if tied is None else found.unionByName(tied)


def one_of_each(docs: DataFrame, settings: Settings = Settings(), *, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row of each component, as it is: that of the smallest key (NULL last), of equal keys that of the smallest digest of the
    text; and every row without words."""
    whole = docs.select(F.col(key).alias("id"), F.col(text).cast("string").alias("text"), F.struct(*docs.columns).alias("row"))
    found = near_duplicates(whole, settings, key="id").where("kept").select("component", "id", "text", "row")
    order = Window.partitionBy("component").orderBy(F.asc_nulls_last("id"), F.md5("text"))
    grouped = found.where("component IS NOT NULL").withColumn("place", F.row_number().over(order)).where("place = 1")
    return grouped.select("row.*").unionByName(found.where("component IS NULL").select("row.*"))


def near_duplicates(docs: DataFrame, settings: Settings = Settings(), *, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Adds ``n_shingles``, ``component`` (a number, NULL without words), ``component_id`` (its smallest key) and ``kept`` (that
    key's rows, and rows without a key) to every row."""
    mark = F.xxhash64(F.col(text).cast("string"))
    texts = docs.select(F.col(key).alias("id"), mark.alias("mark"), F.col(text).cast("string").alias("text"))
    with passing_tables(docs.sparkSession):
        prints, prints_at = written_at(_prints(texts, settings), "prints")
        # One row a set, with the document that stands for it; hot sets shrink before the shuffle.
        classes, classes_at = written_at(
            prints.where("digest is not null").groupBy("digest")
            .agg(F.min(F.struct(F.col("id").isNull().alias("none"), "id", "mark", "n", "minima")).alias("r"))
            .select("digest", "r.id", "r.mark", "r.n", "r.minima", F.monotonically_increasing_id().alias("class")), "classes")
        # The minima are the widest columns: from here on only the table that the links come from holds them.
        numbered = written(
            prints.select(F.col("id").alias("__id"), F.col("mark").alias("__m"), F.col("n").alias("n_shingles"), "digest"), "numbered")
        remove_folder(docs.sparkSession, prints_at)
        standing = written(classes.select("digest", "id", "class"), "standing")
        central = with_centrality(classes.drop("digest"))
        remove_folder(docs.sparkSession, classes_at)
        labels = connected_components(written(each_once(links_between(central, texts, settings)), "near-links"))
        labelled = standing.join(labels.select(F.col("id").alias("class"), "component"), "class", "left").select(
            "digest", "id", F.coalesce("component", "class").alias("component"))
        names = labelled.groupBy("component").agg(F.min("id").alias("component_id"))
        named = labelled.join(names, "component").select("digest", "component", "component_id")
        marks = written(
            numbered.distinct().join(named, "digest", "left").withColumn("component_id", F.when(F.col("digest").isNull(), F.col("__id")).otherwise(F.col("component_id")))
            .drop("digest"), "near-marks")
    added = ["n_shingles", "component", "component_id", "kept"]
    rows = docs.drop(*[c for c in added if c != key]).withColumn("__mark", mark)
    return (
        rows.join(marks, rows[key].eqNullSafe(marks["__id"]) & (rows["__mark"] == marks["__m"]))
        .withColumn("kept", F.coalesce(F.col(key) == F.col("component_id"), F.lit(True)))
        .drop("__id", "__m", "__mark")
    )
