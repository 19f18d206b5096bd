"""Exact top-k inner products with a vector-approximation file.

Components become integers, floor(scale * x).  The approximation file keeps one byte-sized cell number per component.
A scan of the cells alone bounds each vector's inner product with a query from both sides, as a cell fixes its component up to
``width`` values.  Per task and query, only vectors whose upper bound reaches the k-th best lower bound seen there go on;
over all tasks the k-th best lower bound is then final, and what stays above it is read exactly, best bound first in the
ranking that follows.  So the k results are certain, ties included: they go to the smaller key.

Queries come in blocks of a fixed size, each broadcast and looked up in every part of the file.  Equal vectors have equal
scores, so of each group of copies only the k + 1 smallest keys can be results (one may be the query itself); the
rest leave before the scan.

Results: vectors that are NULL, empty, or hold NULL or non-finite components take no part, as queries or candidates.
Vectors meet only those of as many components.  NULL keys take no part.  A key that several rows share stands for
several candidates; rows with a query's own key are never its results, and a repeated query key is answered once
per distinct vector.  Queries without candidates have no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mastlight.session import written

SCALE = 1024
#: Values of a component that share a cell.
WIDTH = 8
#: Queries broadcast together.
BLOCK = 4096


def _integers(vector: str) -> Column:
    return F.transform(vector, lambda x: F.floor(F.lit(float(SCALE)) * x.cast("double")))


def _usable(key: str, vector: str) -> Column:
    odd = F.exists(vector, lambda x: x.isNull() | F.isnan(x.cast("double")) | (F.abs(x.cast("double")) == float("inf")))
    return F.col(key).isNotNull() & F.col(vector).isNotNull() & (F.size(vector) > 0) & ~odd


def approximation_file(vectors: DataFrame, key: str, vector: str, k: int) -> DataFrame:
    """(id, v, cells) of all usable vectors, of each group of copies the k + 1 smallest keys; written."""
    rows = vectors.where(_usable(key, vector)).select(F.col(key).cast("long").alias("id"), _integers(vector).alias("v"))
    first = Window.partitionBy("v").orderBy("id")
    rows = rows.withColumn("r", F.row_number().over(first)).where(F.col("r") <= k + 1).drop("r")
    return written(rows.withColumn("cells", F.transform("v", lambda x: F.floor(x / WIDTH).cast("int"))), "cells")


def _bounds(cells: np.ndarray, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lower bounds (query by vector), and what upper bounds add to them (by query)."""
    low = queries @ (cells * WIDTH).T + ((WIDTH - 1) * np.minimum(queries, 0).sum(1))[:, None]
    return low, (WIDTH - 1) * np.abs(queries).sum(1)


def _scan(shared, k: int):
    """Candidates (query number, id, low, high) of a part of the file, for one block of queries."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        query_ids, by_size = shared.value
        best = {size: np.full((len(rows), k), -np.inf) for size, (rows, _) in by_size.items()}
        kept: list[tuple[np.ndarray, ...]] = []
        held = 0

        def settled() -> tuple[np.ndarray, ...]:
            """What still reaches the k-th best lower bound."""
            q, i, low, high = (np.concatenate(x) for x in zip(*kept))
            limit = np.full(len(query_ids), -np.inf)
            for size, (rows, _) in by_size.items():
                limit[rows] = best[size][:, 0]
            keep = high >= limit[q]
            return q[keep], i[keep], low[keep], high[keep]

        for batch in batches:
            lists = batch.column(1)
            sizes = np.diff(lists.offsets.to_numpy())
            ids = batch.column(0).to_numpy()
            flat, starts = lists.flatten().to_numpy().astype(float), lists.offsets.to_numpy()[:-1] - lists.offsets[0].as_py()
            for size in np.unique(sizes):
                if size not in by_size:
                    continue
                rows, queries = by_size[size]
                at = np.flatnonzero(sizes == size)
                cells = flat[starts[at][:, None] + np.arange(size)]
                low, extra = _bounds(cells, queries)
                low[query_ids[rows][:, None] == ids[at][None, :]] = -np.inf  # a query is not its own result
                top = np.concatenate([best[size], low], 1)
                best[size] = -np.sort(-np.partition(top, top.shape[1] - k, 1)[:, -k:], 1)[:, ::-1] if top.shape[1] > k else top
                q, c = np.nonzero((low + extra[:, None] >= best[size][:, :1]) & np.isfinite(low))
                kept.append((rows[q], ids[at][c], low[q, c], (low + extra[:, None])[q, c]))
                held += len(q)
                if held > 500_000:
                    kept = [settled()]
                    held = len(kept[0][0])
        if kept:
            q, i, low, high = settled()
            yield pa.RecordBatch.from_arrays(
                [pa.array(q.astype(np.int32)), pa.array(i), pa.array(low.astype(np.int64)), pa.array(high.astype(np.int64))],
                names=["q", "id", "low", "high"])

    return run


def exact_topk(vectors: DataFrame, is_query: Column, k: int, *, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): each query's k highest inner products over all other rows."""
    spark = vectors.sparkSession
    file = approximation_file(vectors.select(key, vector), key, vector, k)
    queries = written(
        vectors.where(is_query).where(_usable(key, vector))
        .select(F.col(key).cast("long").alias("query_id"), _integers(vector).alias("w")).distinct()
        .withColumn("q", F.monotonically_increasing_id()), "queries")
    blocks: list[DataFrame] = []
    block: list = []

    def scan() -> None:
        ids = np.array([r.query_id for r in block], np.int64)
        sizes = np.array([len(r.w) for r in block])
        by_size = {int(s): (np.flatnonzero(sizes == s), np.array([r.w for r in block if len(r.w) == s], float)) for s in set(sizes)}
        shared = spark.sparkContext.broadcast((ids, by_size))
        numbers = spark.createDataFrame([(n, int(r.q)) for n, r in enumerate(block)], "q int, number long")
        got = file.select("id", "cells").mapInArrow(_scan(shared, k), "q int, id long, low long, high long")
        blocks.append(got.join(F.broadcast(numbers), "q").select(F.col("number").alias("q"), "id", "low", "high"))

    for row in queries.toLocalIterator():
        block.append(row)
        if len(block) == BLOCK:
            scan()
            block = []
    if block:
        scan()
    if not blocks:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    found = blocks[0]
    for more in blocks[1:]:
        found = found.unionByName(more)
    found = written(found, "candidates")
    # Over all parts, the k-th best lower bound of a query is certain; only what reaches it is read exactly.
    by_low = Window.partitionBy("q").orderBy(F.desc("low"), "id")
    limit = (found.withColumn("r", F.row_number().over(by_low)).where(F.col("r") <= k)
             .groupBy("q").agg(F.min("low").alias("limit"), F.count("*").alias("many")))
    rest = found.join(limit, "q").where((F.col("many") < k) | (F.col("high") >= F.col("limit"))).select("q", "id", "high").distinct()
    exact = rest.join(file.select("id", "v"), "id").join(queries, "q").where(F.size("v") == F.size("w"))
    score = F.aggregate(F.zip_with("v", "w", lambda a, b: a * b), F.lit(0).cast("long"), lambda s, x: s + x)
    scored = exact.select("q", "query_id", F.col("id").alias("vec_id"), score.alias("score"))
    ranked = Window.partitionBy("q").orderBy(F.desc("score"), "vec_id")
    return (
        scored.withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
