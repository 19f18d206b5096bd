"""Embedding whitening by a bidiagonal qd solver.

Entries become integers, floor(scale * entry).  The model is fitted on each distinct vector once.  Number and sums are exact
integers, so rows are centred without rounding before anything is multiplied.  Blocks of centred rows are reduced to
triangles by QR, triangles are stacked and reduced again, sixteen at a time, until one is left: its singular values
and right singular vectors are those of all rows, and the products that would square the condition number are never
formed.  The triangle (dimension by dimension, whatever the number of rows) is brought to bidiagonal form by
Householder reflections.  dqds, the differential quotient-difference transform with shifts, finds all singular values to high
relative accuracy.  A twisted factorisation per singular value, joined where its middle entry is smallest, gives the vector;
vectors of close values are made orthogonal by further steps of inverse iteration with the same factors.  The reflections
take them back, and they whiten the rows: projections over the square root of their eigenvalues.

Results: vectors that are NULL, empty, or hold NULL or non-finite entries leave.  Vectors of different lengths are
whitened apart, each length with its own model.  Rows repeat as they come, with any key, NULL too; extra columns are not read.
Components without variance have no whitened value (NULL); where nothing varies, neither is ``explained`` defined.
Entries beyond 64 bits after scaling count as the largest such number; a deviation beyond 64 bits is NULL.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mastlight.session import written

SCALE = 256
COMPONENTS = 4
#: Triangles that are stacked at a time, and centred rows reduced at a time.
FAN_IN, BLOCK_ROWS = 16, 2048
EPS = np.finfo(float).eps
#: Neighbouring values closer than this share of the largest count as close.
CLOSE = 1e-3
#: Below this share of the largest, a singular value is rounding.
NOTHING = 1e-13


# --- the solver -----------------------------------------------------------------------------------
def reflected(x: np.ndarray) -> tuple[np.ndarray, float]:
    """Unit vector v and number such that (I - 2 v v') x is that number at the first place and 0 elsewhere."""
    norm = float(np.linalg.norm(x))
    v = x.astype(float).copy()
    if norm == 0:
        return v, 0.0
    first = -math.copysign(norm, v[0])
    v[0] -= first
    return v / np.linalg.norm(v), first


def bidiagonal(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Diagonal and superdiagonal of U' A V for a square matrix, and the reflections that make up V."""
    a = matrix.astype(float).copy()
    n = len(a)
    diagonal, above, right = np.zeros(n), np.zeros(max(n - 1, 0)), []
    for i in range(n):
        v, diagonal[i] = reflected(a[i:, i])
        a[i:, i + 1:] -= 2 * np.outer(v, v @ a[i:, i + 1:])
        if i < n - 1:
            w, above[i] = reflected(a[i, i + 1:])
            a[i + 1:, i + 1:] -= 2 * np.outer(a[i + 1:, i + 1:] @ w, w)
            right.append(w)
    return diagonal, above, right


def taken_back(right: list[np.ndarray], z: np.ndarray) -> np.ndarray:
    """V z for the reflections of ``bidiagonal``."""
    out = z.copy()
    for i in reversed(range(len(right))):
        out[i + 1:] -= 2 * right[i] * (right[i] @ out[i + 1:])
    return out


def _dqds_step(q: list[float], e: list[float], shift: float) -> tuple[list[float], list[float], float]:
    """One transform of q, e (squares of a bidiagonal); and the least d on the way, negative if the shift is too large."""
    d, least, new_q, new_e = q[0] - shift, q[0] - shift, [], []
    for i in range(len(e)):
        total = d + e[i]
        if total == 0:  # both are 0: the matrix falls apart here
            new_q.append(0.0)
            new_e.append(0.0)
            d = q[i + 1] - shift
        else:
            share = q[i + 1] / total
            new_q.append(total)
            new_e.append(e[i] * share)
            d = d * share - shift
        least = min(least, d)
        if least < 0 or not math.isfinite(d):
            return new_q, new_e, -1.0
    new_q.append(d)
    return new_q, new_e, least


def dqds(diagonal: np.ndarray, above: np.ndarray) -> np.ndarray:
    """Singular values of an upper bidiagonal matrix, falling."""
    scale = float(max(np.abs(diagonal).max(initial=0), np.abs(above).max(initial=0)))
    if scale == 0:
        return np.zeros(len(diagonal))
    q, e = ((np.abs(diagonal) / scale) ** 2).tolist(), ((np.abs(above) / scale) ** 2).tolist()
    small, shifted, out = (10 * EPS) ** 2, 0.0, []
    q, e, least = _dqds_step(q, e, 0.0)
    trust, steps = 0.5, 0
    while q:
        if len(q) == 1 or e[-1] <= small * (shifted + q[-1]) or e[-1] < 1e-300:
            out.append(shifted + q.pop())
            if e:
                e.pop()
            least, trust = (min(q) if q else 0.0), 0.5
            continue
        # The least d bounds the smallest value from above; a share of it is tried, less of it after a failure.
        for attempt in range(8):
            shift = least * trust if attempt < 7 else 0.0
            new_q, new_e, got = _dqds_step(q, e, shift)
            if got >= 0:
                break
            trust /= 2
        q, e, least, shifted = new_q, new_e, got, shifted + shift
        trust = min(1 - (1 - trust) / 4, 1 - 1e-9)
        # The transform works towards the end: where the large values stand there, turn it round.
        if q[0] < 0.25 * q[-1] and len(q) > 1:
            q, e = q[::-1], e[::-1]
            q, e, least = _dqds_step(q, e, 0.0)
        steps += 1
        if steps > 200 * (len(out) + len(q)):
            raise ArithmeticError("dqds does not converge")
    return scale * np.sqrt(np.sort(np.array(out))[::-1])


class Twisted:
    """B'B - value I, factored from both ends of a bidiagonal matrix and joined at the smallest middle entry."""

    def __init__(self, diagonal: np.ndarray, above: np.ndarray, value: float):
        n, tiny = len(diagonal), np.finfo(float).tiny * 1e20
        q, e, off = diagonal**2, above**2, diagonal[:-1] * above
        self.low, self.up = np.zeros(n - 1), np.zeros(n - 1)
        down, rise = np.zeros(n), np.zeros(n)
        s, p = np.zeros(n), np.zeros(n)
        s[0], p[-1] = -value, q[-1] - value
        for i in range(n - 1):
            down[i] = s[i] + q[i] or tiny
            self.low[i] = off[i] / down[i]
            s[i + 1] = e[i] * s[i] / down[i] - value
        for i in reversed(range(n - 1)):
            rise[i + 1] = e[i] + p[i + 1] or tiny
            self.up[i] = off[i] / rise[i + 1]
            p[i] = p[i + 1] * q[i] / rise[i + 1] - value
        middle = s + p + value
        self.twist = int(np.argmin(np.where(np.isfinite(middle), np.abs(middle), np.inf)))
        self.pivots = np.where(np.arange(n) < self.twist, down, rise)
        self.pivots[self.twist] = middle[self.twist] or tiny

    def spread(self, w: np.ndarray) -> np.ndarray:
        """Solve N'x = w for the twisted factor N."""
        x, r = w.copy(), self.twist
        for i in reversed(range(r)):
            x[i] -= self.low[i] * x[i + 1]
        for i in range(r, len(x) - 1):
            x[i + 1] -= self.up[i] * x[i]
        return x / (np.linalg.norm(x) or 1.0)

    def vector(self) -> np.ndarray:
        unit = np.zeros(len(self.pivots))
        unit[self.twist] = 1.0
        return self.spread(unit)

    def again(self, b: np.ndarray) -> np.ndarray:
        """A step of inverse iteration."""
        y, r = b.copy(), self.twist
        for i in range(1, r):
            y[i] -= self.low[i - 1] * y[i - 1]
        for i in reversed(range(r + 1, len(y) - 1)):
            y[i] -= self.up[i] * y[i + 1]
        if r > 0:
            y[r] -= self.low[r - 1] * y[r - 1]
        if r < len(y) - 1:
            y[r] -= self.up[r] * y[r + 1]
        y /= np.abs(y).max() or 1.0
        w = y / self.pivots
        return self.spread(w / (np.abs(w).max() or 1.0))


def leading_vectors(triangle: np.ndarray, wanted: int) -> tuple[np.ndarray, np.ndarray]:
    """All singular values of a square matrix, falling, and its first right singular vectors as rows."""
    unit = float(np.abs(triangle).max(initial=0)) or 1.0
    diagonal, above, right = bidiagonal(triangle / unit)
    values = dqds(diagonal, above)
    scale = values[0] if len(values) and values[0] > 0 else 1.0
    diagonal, above = diagonal / scale, above / scale
    found: list[np.ndarray] = []
    rng = np.random.default_rng(0)
    for i in range(min(wanted, len(values))):
        factors = Twisted(diagonal, above, float(values[i] / scale) ** 2)
        z = factors.vector()
        near = [found[j] for j in range(i) if values[j] - values[i] <= CLOSE * scale]
        if near or not np.isfinite(z).all():
            basis = np.array(near).reshape(len(near), len(z))
            z = z if np.isfinite(z).all() else rng.normal(size=len(z))
            for attempt in range(6):
                for _ in range(2):
                    z = z - basis.T @ (basis @ z)
                norm = np.linalg.norm(z)
                if norm < 0.1:  # all of it lay in the vectors before: start elsewhere
                    z = rng.normal(size=len(z))
                    continue
                z /= norm
                if attempt >= 2:
                    break
                z = factors.again(z)
            for _ in range(2):
                z = z - basis.T @ (basis @ z)
            z /= np.linalg.norm(z)
        found.append(z)
    return unit * values, np.array([taken_back(right, z) for z in found]).reshape(len(found), len(diagonal))


# --- rows ------------------------------------------------------------------------------------------
def _usable(vector: str) -> Column:
    odd = F.exists(vector, lambda x: x.isNull() | F.isnan(x.cast("double")) | (F.abs(x.cast("double")) == float("inf")))
    return F.col(vector).isNotNull() & (F.size(vector) > 0) & ~odd


def _integers(vector: str) -> Column:
    return F.transform(vector, lambda c: F.floor(F.lit(float(SCALE)) * c.cast("double")))


def by_size(column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """The rows of a list column by length: length, rows, and their entries as a matrix."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    offsets = column.offsets.to_numpy().astype(np.int64)
    flat, offsets = column.flatten().to_numpy(zero_copy_only=False), offsets - offsets[0]
    sizes = np.diff(offsets)
    for size in np.unique(sizes).tolist():
        rows = np.flatnonzero(sizes == size)
        yield size, rows, flat[offsets[rows][:, None] + np.arange(size)]


@dataclass(frozen=True)
class Whitening:
    """The model of vectors of one length: exact number and sums, eigenvalues of the covariance (the first ones), their unit
    vectors as rows, and the trace."""

    n: int
    sums: tuple[int, ...]
    values: np.ndarray
    vectors: np.ndarray
    trace: float

    def deviations(self, x: np.ndarray) -> np.ndarray:
        """n x - S, exact: 64-bit where they fit, else integers of any size."""
        largest = max([abs(int(x.max(initial=0))), abs(int(x.min(initial=0)))])
        if (largest * self.n + max(map(abs, self.sums))) ** 2 * len(self.sums) < 2**63:
            return self.n * x - np.array(self.sums, np.int64)
        return self.n * x.astype(object) - np.array(self.sums, object)

    def whitened(self, deviations: np.ndarray) -> np.ndarray:
        """Row by component; NaN for components without variance."""
        with np.errstate(divide="ignore", invalid="ignore"):
            scaled = np.where(self.values > 0, 1 / np.sqrt(self.values), np.nan)
        return (deviations / self.n).astype(float) @ self.vectors.T * scaled


def _sums(rows: DataFrame) -> dict[int, tuple[int, tuple[int, ...]]]:
    """Number and exact sums of the vectors of each length; summed in the tasks first."""
    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, list] = {}
        for batch in batches:
            for size, _, x in by_size(batch.column(0)):
                exact = x.sum(0) if np.abs(x.astype(float)).max() < 2**40 else x.astype(object).sum(0)
                held = sums.setdefault(size, [0, [0] * size])
                held[0] += len(x)
                held[1] = [a + int(b) for a, b in zip(held[1], exact)]
        flat = [(size, place, str(total), held[0]) for size, held in sums.items() for place, total in enumerate(held[1])]
        yield pa.RecordBatch.from_arrays(
            [pa.array([f[i] for f in flat], kind) for i, kind in enumerate((pa.int32(), pa.int32(), pa.string(), pa.int64()))],
            names=["size", "place", "total", "n"])

    got = (
        rows.select("x").mapInArrow(partial, "size int, place int, total string, n long")
        .groupBy("size", "place").agg(F.sum(F.col("total").cast("decimal(38, 0)")).alias("total"), F.sum("n").alias("n"))
    ).collect()  # a number for each dimension
    out: dict[int, tuple[int, list[int]]] = {}
    for r in got:
        out.setdefault(r["size"], (r.n, [0] * r["size"]))[1][r.place] = int(r.total)
    return {size: (n, tuple(sums)) for size, (n, sums) in out.items()}


def triangle_of(blocks: list[np.ndarray]) -> np.ndarray:
    return np.linalg.qr(np.concatenate(blocks), mode="r")


def _packed(size: list[int], part: list[int], triangles: list[np.ndarray]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(size, pa.int32()), pa.array(part, pa.int64()), pa.array([t.astype("<f8").tobytes() for t in triangles], pa.binary())],
        names=["size", "part", "triangle"])


def _triangles(rows: DataFrame, sums: dict[int, tuple[int, tuple[int, ...]]]) -> dict[int, np.ndarray]:
    """One triangle for each length: blocks of centred rows are reduced in the tasks, then sixteen triangles at a time."""
    shared = rows.sparkSession.sparkContext.broadcast(sums)  # a number for each dimension

    def reduced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[np.ndarray]] = {}
        for batch in batches:
            for size, _, x in by_size(batch.column(0)):
                n, total = shared.value[size]
                centred = (Whitening(n, total, np.zeros(0), np.zeros((0, size)), 0.0).deviations(x) / n).astype(float)
                blocks = held.setdefault(size, [])
                blocks.append(centred)
                if sum(map(len, blocks)) >= BLOCK_ROWS + size:
                    held[size] = [triangle_of(blocks)]
        from pyspark import TaskContext

        for size, blocks in held.items():
            yield _packed([size], [TaskContext.get().partitionId()], [triangle_of(blocks)])

    def stacked(key: tuple, group: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size = key[0].as_py()
        blocks = [np.frombuffer(t, "<f8").reshape(-1, size) for batch in group for t in batch.column(2).to_pylist()]
        yield _packed([size], [key[1].as_py()], [triangle_of(blocks)])

    level = written(rows.select("x").mapInArrow(reduced, "size int, part long, triangle binary"), "triangles")
    while (level.groupBy("size").count().agg(F.max("count")).first()[0] or 0) > 1:
        level = written(
            level.groupBy("size", F.floor(F.col("part") / FAN_IN).alias("above")).applyInArrow(
                stacked, "size int, part long, triangle binary"), "triangles")
    return {r["size"]: np.frombuffer(r.triangle, "<f8").reshape(-1, r["size"]) for r in level.toLocalIterator()}


def fit(vectors: DataFrame, vector: str = "embedding", components: int = COMPONENTS) -> tuple[dict[int, Whitening], DataFrame]:
    """The model of each length, and the table of distinct vectors (x) that it was fitted on."""
    rows = written(vectors.where(_usable(vector)).select(_integers(vector).alias("x")).distinct(), "distinct")
    sums = _sums(rows)
    models = {}
    for size, triangle in _triangles(rows, sums).items():
        n, total = sums[size]
        square = np.zeros((size, size))
        square[: len(triangle)] = triangle  # fewer rows than dimensions: the rest is 0
        values, found = leading_vectors(square, components)
        values = np.where(values > NOTHING * max(values[0], 1e-300), values, 0.0)
        trace = float((triangle**2).sum() / n)
        models[size] = Whitening(n, total, values[: len(found)] ** 2 / n, found, trace)
    return models, rows


def _whitened(rows: DataFrame, models: dict[int, Whitening]) -> DataFrame:
    """(key, size, n, deviation, whitened) of rows (key, x)."""
    shared = rows.sparkSession.sparkContext.broadcast(models)  # components by dimension
    schema = T.StructType([
        T.StructField("key", rows.schema["key"].dataType), T.StructField("size", T.IntegerType()), T.StructField("n", T.LongType()),
        T.StructField("deviation", T.LongType()), T.StructField("whitened", T.ArrayType(T.DoubleType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for size, at, x in by_size(batch.column(1)):
                if size not in shared.value:
                    continue
                model = shared.value[size]
                deviations = model.deviations(x)
                squares = (deviations * deviations).sum(1).tolist()
                white = model.whitened(deviations)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(at)), pa.array([size] * len(at), pa.int32()),
                     pa.array([model.n] * len(at), pa.int64()),
                     pa.array([s if s < 2**63 else None for s in squares], pa.int64()),
                     pa.array([[None if math.isnan(v) else v for v in w] for w in white.tolist()], pa.list_(pa.float64()))],
                    names=schema.names)

    return rows.mapInArrow(run, schema)


def whiten(vectors: DataFrame, models: dict[int, Whitening], key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(key, size, n, deviation, whitened) for each row with a usable vector; ``whitened`` is an array over components."""
    usable = vectors.where(_usable(vector)).select(F.col(key).alias("key"), _integers(vector).alias("x"))
    return _whitened(usable, models).withColumnRenamed("key", key)


def identity_errors(rows: DataFrame, models: dict[int, Whitening]) -> dict[int, float]:
    """For each length, the largest entry of the covariance of the whitened distinct vectors minus the identity."""
    most = max((len(m.values) for m in models.values()), default=0)
    white = _whitened(rows.select(F.lit(0).alias("key"), "x"), models)
    of = lambda i: F.col("whitened")[i]
    terms = [F.abs(F.covar_pop(of(i), of(j)) - float(i == j)).alias(f"e{i}_{j}") for i in range(most) for j in range(i, most)]
    if not terms:
        return {}
    # An array shorter than i, and a component without variance, give NULL, which counts as nothing.
    with_all = white.withColumn("whitened", F.transform(F.sequence(F.lit(1), F.lit(most)), lambda i: F.try_element_at("whitened", i)))
    return {r["size"]: max((v for v in list(r)[1:] if v is not None), default=0.0)
            for r in with_all.groupBy("size").agg(*terms).collect()}  # a row for each length


def whitened_components(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """(key, component, n, deviation, whitened, explained, identity_error): a row for each vector and component."""
    models, rows = fit(vectors, vector, components)
    errors = identity_errors(rows, models)
    known = [(size, i, float(e / m.trace) if m.trace > 0 else None, errors.get(size, 0.0))
             for size, m in models.items() for i, e in enumerate(m.values.tolist())]
    shares = vectors.sparkSession.createDataFrame(known, "size int, place int, explained double, identity_error double")
    spread = whiten(vectors, models, key, vector).select(
        F.col(key), "size", "n", "deviation", F.posexplode("whitened").alias("place", "whitened"))
    return spread.join(F.broadcast(shares), ["size", "place"]).select(  # a few rows a length
        key, (F.col("place") + 1).alias("component"), "n", "deviation", "whitened", "explained", "identity_error")
