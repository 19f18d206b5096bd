"""Approximate nearest neighbours: vantage-point trees per shard, with relaxed triangle-inequality pruning.

The nearest rows to a query are those of largest inner product.  A vector x gets one more component, sqrt(M^2 - x^2) with M the
largest norm, and a query a 0: then the rows of largest inner product are the nearest by Euclidean distance, to which the
triangle inequality applies.  A small routing tree of vantage points, fitted on at most ``SAMPLE`` vectors, cuts space
into regions; every vector is indexed, in the region where the tree leads it, and regions of more rows than a shard may
hold are dealt out over several shards.  Each shard has a vantage-point tree of its own: a node keeps a point, and the
least and largest distance from it to the rows inside and outside its median sphere.

A query first searches the shards of its own region, which bounds the distance of its k-th neighbour; it then goes to
those regions only that the bound leaves, carrying it along.  A subtree or region is left out if its least possible
distance times ``factor`` exceeds the distance of the k-th neighbour so far.  Factor one leaves out nothing that can hold a
neighbour, so the search is exact; larger factors save work and may miss some.  Scores are computed on the vectors as given.

Results: vectors that are NULL, empty, zero, or hold NULL or non-finite components take no part, nor do rows with a NULL key.
Vectors meet those of as many components only.  Equal rows (key and vector) count once; a key with different vectors stands
for several candidates, and a query's own key is never its result.  Of equal vectors only the k + 1 smallest keys can
be results, so the others leave first.  Extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mastlight.llm.whitening import by_size
from mastlight.session import written

#: Vectors that the routing tree is fitted on, its regions at most, bytes of vectors in a shard, queries searched together.
SAMPLE, REGIONS, SHARD_BYTES, TOGETHER = 4096, 1024, 4 << 20, 4096
#: Rows of a leaf of a shard's tree.
LEAF = 256
#: How much of the distance of the k-th neighbour counts as rounding.
SLACK = 1e-9
FACTOR = 5.0


def vantage_point(points: np.ndarray, extra: np.ndarray, rng: np.random.Generator) -> int:
    """Of a few points, the one whose distances to others spread most."""
    tried = rng.choice(len(points), min(6, len(points)), replace=False)
    seen = rng.choice(len(points), min(64, len(points)), replace=False)
    spread = [distances(points[seen], extra[seen], points[i], extra[i]).std() for i in tried]
    return int(tried[int(np.argmax(spread))])


def distances(points: np.ndarray, extra: np.ndarray, point: np.ndarray, own: float) -> np.ndarray:
    return np.sqrt(((points - point) ** 2).sum(1) + (extra - own) ** 2)


def added(points: np.ndarray, norm: float) -> np.ndarray:
    """The component that brings every vector to the same norm."""
    return np.sqrt(np.maximum(norm**2 - (points**2).sum(1), 0.0))


@dataclass
class Bounds:
    """Of a subtree: its vantage points' numbers and the least and largest distances of its rows from them."""

    points: list[int]
    low: list[float]
    high: list[float]

    def least(self, to_points: np.ndarray) -> np.ndarray:
        """The least distance that a row of it can have from each query, by the queries' distances to all points."""
        if not self.points:
            return np.zeros(len(to_points))
        d = to_points[:, self.points]
        return np.maximum(np.maximum(d - np.array(self.high), np.array(self.low) - d), 0.0).max(1)


class VantageTree:
    """A vantage-point tree; leaves hold row numbers."""

    def __init__(self, points: np.ndarray, extra: np.ndarray, leaf: int, most_leaves: int = 1 << 30, seed: int = 7):
        self.leaves: list[np.ndarray] = []
        self.bounds: list[Bounds] = []
        self.points: list[np.ndarray] = []
        self.own: list[float] = []
        self.nodes: list[tuple[int, float, int, int]] = []  # point, radius, inside, outside: a node, or ~leaf
        rng = np.random.default_rng(seed)
        # (rows, bounds, parent node, side); the largest part is cut first, so that few leaves are even ones.
        open_ = [(np.arange(len(points)), Bounds([], [], []), -1, 0)]
        while open_:
            at = max(range(len(open_)), key=lambda i: len(open_[i][0]))
            rows, bounds, parent, side = open_.pop(at)
            cut = None
            if len(rows) > leaf and len(open_) + len(self.leaves) + 2 <= most_leaves:
                center = rows[vantage_point(points[rows], extra[rows], rng)]
                d = distances(points[rows], extra[rows], points[center], extra[center])
                radius = float(np.median(d))
                inside = d <= radius
                if inside.all():  # many rows as far as the farthest
                    inside = d < radius
                    radius = float(d[inside].max()) if inside.any() else radius
                cut = inside if inside.any() and not inside.all() else None
            if cut is None:
                self._attach(parent, side, ~len(self.leaves))
                self.leaves.append(rows)
                self.bounds.append(bounds)
                continue
            number = len(self.points)
            self.points.append(points[center])
            self.own.append(float(extra[center]))
            self._attach(parent, side, len(self.nodes))
            self.nodes.append((number, radius, 0, 0))
            for below, part in enumerate((cut, ~cut)):
                inner = Bounds([*bounds.points, number], [*bounds.low, float(d[part].min())], [*bounds.high, float(d[part].max())])
                open_.append((rows[part], inner, len(self.nodes) - 1, below))

    def _attach(self, parent: int, side: int, child: int) -> None:
        if parent >= 0:
            point, radius, inside, outside = self.nodes[parent]
            self.nodes[parent] = (point, radius, child, outside) if side == 0 else (point, radius, inside, child)

    def to_points(self, points: np.ndarray, extra: np.ndarray) -> np.ndarray:
        """Distances to all vantage points, row by point."""
        if not self.points:
            return np.zeros((len(points), 0))
        return np.stack([distances(points, extra, p, o) for p, o in zip(self.points, self.own)], 1)

    def led_to(self, to_points: np.ndarray) -> np.ndarray:
        """The leaf that each row is led to."""
        out = np.zeros(len(to_points), np.int64)
        open_ = [(0, np.arange(len(to_points)))] if self.nodes else []
        while open_:
            node, rows = open_.pop()
            point, radius, inside, outside = self.nodes[node]
            near = to_points[rows, point] <= radius
            for child, own in ((inside, rows[near]), (outside, rows[~near])):
                if child < 0:
                    out[own] = ~child
                elif len(own):
                    open_.append((child, own))
        return out


class Shard:
    """The rows of a shard under a vantage-point tree."""

    def __init__(self, ids: np.ndarray, points: np.ndarray, norm: float, leaf: int = LEAF):
        order = np.argsort(ids, kind="stable")
        self.ids, self.points, self.norm = ids[order], points[order], norm
        self.extra = added(self.points, norm)
        self.tree = VantageTree(self.points, self.extra, leaf)
        self.visited = 0

    def search(self, own: np.ndarray, queries: np.ndarray, floor: np.ndarray, k: int, factor: float
               ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(query, id, score) of each query's k best rows above its floor (the score of its k-th neighbour so far)."""
        tree, far = self.tree, (queries**2).sum(1) + self.norm**2
        to_points = tree.to_points(queries, np.zeros(len(queries)))
        home = tree.led_to(to_points)
        best = np.full((len(queries), k), -np.inf)
        slack = SLACK * np.maximum(far, 1e-300)
        hits: list[tuple[np.ndarray, np.ndarray]] = []

        def bound() -> np.ndarray:
            return np.maximum(best[:, 0], floor)

        def scan(leaf: int, active: np.ndarray) -> None:
            rows = tree.leaves[leaf]
            self.visited += len(rows) * len(active)
            score = queries[active] @ self.points[rows].T
            score[own[active][:, None] == self.ids[rows][None, :]] = -np.inf
            top = np.concatenate([best[active], score], 1)
            best[active] = np.sort(np.partition(top, top.shape[1] - k, 1)[:, -k:], 1)
            q, c = np.nonzero((score >= (bound() - slack)[active][:, None]) & (score > -np.inf))
            hits.append((active[q], rows[c]))

        for leaf in range(len(tree.leaves)):
            active = np.flatnonzero(home == leaf)
            if len(active):
                scan(leaf, active)
        for leaf in range(len(tree.leaves)):
            reach = np.sqrt(np.maximum(far - 2 * bound(), 0.0))  # distance of the k-th neighbour
            active = np.flatnonzero((home != leaf) & ~(tree.bounds[leaf].least(to_points) * factor > reach * (1 + SLACK)))
            if len(active):
                scan(leaf, active)
        if not hits:
            return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
        q, row = (np.concatenate(x) for x in zip(*hits))
        # Scores again, each by itself: equal vectors have equal scores then, wherever they stand.
        score = np.concatenate([(queries[q[i:i + 65536]] * self.points[row[i:i + 65536]]).sum(1) for i in range(0, len(q), 65536)] or [np.zeros(0)])
        keep = score >= (bound() - slack)[q]
        q, row, score = q[keep], row[keep], score[keep]
        order = np.lexsort([self.ids[row], -score, q])
        q, row, score = q[order], row[order], score[order]
        first = np.searchsorted(q, q)
        keep = np.arange(len(q)) - first < k
        return q[keep], self.ids[row[keep]], score[keep]


def _usable(key: str, vector: str) -> Column:
    odd = F.exists(vector, lambda x: x.isNull() | F.isnan(x.cast("double")) | (F.abs(x.cast("double")) == float("inf")))
    return F.col(key).isNotNull() & F.col(vector).isNotNull() & ~odd & F.exists(vector, lambda x: x != 0)


def _plain(vectors: DataFrame, key: str, vector: str) -> DataFrame:
    """Distinct (id, v) of all vectors that take part."""
    whole = F.transform(vector, lambda x: x.cast("double") + F.lit(0.0))
    return vectors.where(_usable(key, vector)).select(F.col(key).cast("long").alias("id"), whole.alias("v")).distinct()


@dataclass(frozen=True)
class Routing:
    """For the vectors of one length: the tree, the largest norm, and for each region its shards and bounds over all rows."""

    tree: VantageTree
    norm: float
    shards: dict[int, int]
    bounds: dict[int, Bounds]


def _sampled_trees(rows: DataFrame) -> dict[int, Routing]:
    """Routing trees fitted on the sample; as many regions as shards are needed, up to a bound."""
    sizes = {r["size"]: (r.rows, float(r.norm)) for r in rows.groupBy(F.size("v").alias("size")).agg(
        F.count("*").alias("rows"), F.max(F.sqrt(F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x))).alias("norm")).collect()}
    sample = rows.orderBy(F.xxhash64("v", "id")).limit(SAMPLE).select("v").toArrow()  # a bounded number of rows
    points = {size: x.astype(float) for size, _, x in by_size(sample["v"])} if sample.num_rows else {}
    out = {}
    for size, (many, norm) in sizes.items():
        own = points.get(size, np.zeros((0, size)))
        regions = max(1, min(REGIONS, -(-many * size * 8 // SHARD_BYTES)))
        norm *= 1 + 1e-12
        out[size] = Routing(VantageTree(own, added(own, norm), 1, regions), norm, {}, {})
    return out


def _routing(rows: DataFrame) -> dict[int, Routing]:
    """The routing of every length with counts and bounds of its regions, taken over all rows."""
    trees = _sampled_trees(rows)
    shared = rows.sparkSession.sparkContext.broadcast(trees)  # the sample bounds it

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[int, int, int], list[float]] = {}
        for batch in batches:
            for size, _, x in by_size(batch.column(0)):
                routing = shared.value[size]
                to_points = routing.tree.to_points(x, added(x, routing.norm))
                region = routing.tree.led_to(to_points)
                for r in np.unique(region).tolist():
                    own = to_points[region == r]
                    for point in [-1, *routing.tree.bounds[r].points]:
                        d = own[:, point] if point >= 0 else np.zeros(len(own))
                        seen = held.setdefault((size, r, point), [np.inf, -np.inf, 0])
                        held[size, r, point] = [min(seen[0], d.min()), max(seen[1], d.max()), seen[2] + len(d)]
        kinds = (pa.int32(), pa.int32(), pa.int32(), pa.float64(), pa.float64(), pa.int64())
        flat = [(*k, *v) for k, v in held.items()]
        yield pa.RecordBatch.from_arrays([pa.array([f[i] for f in flat], kind) for i, kind in enumerate(kinds)],
                                         names=["size", "region", "point", "low", "high", "rows"])

    got = (
        rows.select("v").mapInArrow(partial, "size int, region int, point int, low double, high double, rows long")
        .groupBy("size", "region", "point").agg(F.min("low").alias("low"), F.max("high").alias("high"), F.sum("rows").alias("rows"))
    ).collect()  # regions by depth of the routing tree
    for r in got:
        routing = trees[r["size"]]
        if r.point < 0:
            routing.shards[r.region] = max(1, -(-r.rows * r["size"] * 8 // SHARD_BYTES))
            routing.bounds.setdefault(r.region, Bounds([], [], []))
        else:
            bounds = routing.bounds.setdefault(r.region, Bounds([], [], []))
            bounds.points.append(r.point)
            bounds.low.append(r.low)
            bounds.high.append(r.high)
    return trees


def _placed(rows: DataFrame, routings: dict[int, Routing]) -> DataFrame:
    """(size, region, shard, id, v) of every row."""
    shared = rows.sparkSession.sparkContext.broadcast(routings)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for size, at, x in by_size(batch.column(1)):
                routing = shared.value[size]
                region = routing.tree.led_to(routing.tree.to_points(x, added(x, routing.norm)))
                shards = np.array([routing.shards[r] for r in region.tolist()])
                taken = batch.take(pa.array(at))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([size] * len(at), pa.int32()), pa.array(region, pa.int32()), pa.array(shards, pa.int32()), *taken.columns],
                    names=["size", "region", "shards", "id", "v"])

    placed = rows.select("id", "v").mapInArrow(run, "size int, region int, shards int, id long, v array<double>")
    return placed.withColumn("shard", F.pmod(F.xxhash64("id"), "shards").cast("int")).drop("shards")


def _visits(queries: DataFrame, routings: dict[int, Routing], factor: float, home: bool) -> DataFrame:
    """(size, region, shard, q, id, v, floor): where each query is to be searched; the own region, or all others in reach."""
    shared = queries.sparkSession.sparkContext.broadcast(routings)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for size, at, x in by_size(batch.column(2)):
                if size not in shared.value:
                    continue
                routing = shared.value[size]
                to_points = routing.tree.to_points(x, np.zeros(len(x)))
                led = routing.tree.led_to(to_points)
                floor = batch.column(3).take(pa.array(at)).to_numpy(zero_copy_only=False)
                reach = np.sqrt(np.maximum((x**2).sum(1) + routing.norm**2 - 2 * floor, 0.0))
                for region, shards in routing.shards.items():
                    near = led == region
                    if not home:
                        near = ~near & ~(routing.bounds[region].least(to_points) * factor > reach * (1 + SLACK))
                    rows = np.flatnonzero(near)
                    for shard in range(shards if len(rows) else 0):
                        taken = batch.take(pa.array(at[rows]))
                        same = [pa.array([v] * len(rows), pa.int32()) for v in (size, region, shard)]
                        yield pa.RecordBatch.from_arrays([*same, *taken.columns], names=["size", "region", "shard", "q", "id", "v", "floor"])

    return queries.select("q", "id", "v", "floor").mapInArrow(
        run, "size int, region int, shard int, q long, id long, v array<double>, floor double")


def _searched(placed: DataFrame, visits: DataFrame, norms: dict[int, float], k: int, factor: float) -> DataFrame:
    """(q, vec_id, score): each query's best rows of each shard that it visits."""
    visits = written(visits, "visits")
    where = ["size", "region", "shard"]
    # A shard meets its queries in groups of bounded size.
    groups = visits.groupBy(*where).agg(F.ceil(F.count("*") / TOGETHER).cast("int").alias("groups"))
    queries = visits.join(groups, where).withColumn("part", F.pmod(F.xxhash64("q"), "groups").cast("int"))
    shards = placed.join(groups, where).withColumn("part", F.explode(F.sequence(F.lit(0), F.col("groups") - 1)))

    def run(rows: pa.Table, asked: pa.Table) -> pa.Table:
        schema = pa.schema([("q", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())])
        if not rows.num_rows or not asked.num_rows:
            return schema.empty_table()
        size = rows["size"][0].as_py()
        matrix = lambda t: t["v"].combine_chunks().flatten().to_numpy().reshape(-1, size)
        shard = Shard(rows["id"].to_numpy(), matrix(rows), norms[size])
        q, ids, score = shard.search(asked["id"].to_numpy(), matrix(asked), asked["floor"].to_numpy(), k, factor)
        return pa.Table.from_arrays([pa.array(asked["q"].to_numpy()[q]), pa.array(ids), pa.array(score)], schema=schema)

    keys = [*where, "part"]
    return shards.select(*keys, "id", "v").groupBy(*keys).cogroup(
        queries.select(*keys, "q", "id", "v", "floor").groupBy(*keys)).applyInArrow(run, "q long, vec_id long, score double")


def nearest(vectors: DataFrame, is_query: Column, k: int, *, factor: float = FACTOR, key: str = "vec_id",
            vector: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): the k rows of largest inner product found for each query, best first."""
    if factor < 1:
        raise ValueError("factor must be one (exact) or more")
    copies = Window.partitionBy("v").orderBy("id")
    rows = written(
        _plain(vectors, key, vector).withColumn("copy", F.row_number().over(copies)).where(F.col("copy") <= k + 1).drop("copy"), "vectors")
    routings = _routing(rows)
    placed = written(_placed(rows, routings), "placed")
    norms = {size: r.norm for size, r in routings.items()}
    queries = written(_plain(vectors.where(is_query), key, vector).withColumn("q", F.monotonically_increasing_id()), "queries")
    ranked = Window.partitionBy("q").orderBy(F.desc("score"), "vec_id")

    def best(found: DataFrame) -> DataFrame:
        return found.withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= k)

    lowest = F.lit(float("-inf"))
    first = written(best(_searched(
        placed, _visits(queries.withColumn("floor", lowest), routings, factor, True), norms, k, factor)).drop("rank"), "own-regions")
    floors = first.groupBy("q").agg(F.count("*").alias("many"), F.min("score").alias("least"))
    bounded = queries.join(floors, "q", "left").withColumn("floor", F.when(F.col("many") == k, F.col("least")).otherwise(lowest))
    more = _searched(placed, _visits(bounded, routings, factor, False), norms, k, factor)
    return best(first.unionByName(more)).join(queries.select("q", F.col("id").alias("query_id")), "q").select(
        "query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
