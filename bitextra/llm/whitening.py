"""Whitening of embeddings with exact covariances from bit-sliced cross-products.

Entries become integers. A block of rows is laid out as bit planes: one bit per row, a run of
words for every dimension and bit of its values (shifted to start at 0). The cross-product of two
dimensions is the sum over their planes of 2^(a+b) times the bits that both have, so products
and sums are exact. Tasks add up blocks, Spark adds up tasks; the driver gets one number for each
pair of dimensions, centres them as integers and solves for the eigenvectors.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import ArrayType, DoubleType, LongType, StringType, StructField

from .common import add_columns

#: An entry c counts as floor(SCALE * c) + SHIFT.
SCALE, SHIFT = 64, 1_000_000
#: Rows of a block. Rows with an entry beyond WIDE make blocks of their own, with more planes.
BLOCK, WIDE = 8192, 1 << 20
#: Sums travel in digits of this base: their own sums stay far below the limits of a decimal.
BASE = 1 << 32


def usable(df: DataFrame, vector: str) -> DataFrame:
    """Rows whose vector is there, without NULL or non-finite entries."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return df.where(F.col(vector).isNotNull() & F.coalesce(finite, F.lit(False)))


def integers(vectors: np.ndarray) -> np.ndarray:
    """floor(SCALE * c) of every entry, as int64 or, where one does not fit, as Python integers."""
    with np.errstate(over="ignore"):
        scaled = np.floor(vectors * SCALE)
    if not scaled.size or np.abs(scaled).max() < 1 << 62:
        return scaled.astype(np.int64)
    whole = lambda c: math.floor(c * SCALE) if abs(c) < 1e300 else int(c) * SCALE
    return np.array([[whole(c) for c in row] for row in vectors.tolist()], dtype=object).reshape(vectors.shape)


def planes(values: np.ndarray) -> tuple[np.ndarray, list[int], list[int]]:
    """Bit planes of non-negative integers (rows x dimensions): words, and dimension and bit of each."""
    rows, dims = values.shape
    bits = [int(m).bit_length() for m in values.max(axis=0)]
    out = np.zeros((sum(bits), -(-rows // 64) * 8), np.uint8)
    of, at = [], []
    for d in range(dims):
        for b in range(bits[d]):
            plane = np.packbits(((values[:, d] >> b) & 1).astype(bool))
            out[len(of), : len(plane)] = plane
            of.append(d)
            at.append(b)
    return out.view(np.uint64), of, at


def scatter(values: np.ndarray) -> tuple[list[int], dict[tuple[int, int], int]]:
    """Exact sums of every dimension and cross-products of every pair i <= j of a block of integers."""
    rows, dims = values.shape
    low = [int(m) for m in values.min(axis=0)]
    words, of, at = planes(values - np.array(low, dtype=values.dtype))
    wide = max(at, default=0) >= 24
    weights = np.array([1 << b for b in at], dtype=object if wide else np.int64)
    ones = np.bitwise_count(words).sum(axis=1, dtype=np.int64)
    sums, products = [0] * dims, {}
    for d, b, n in zip(of, at, ones.tolist(), strict=True):
        sums[d] += n << b
    starts = np.flatnonzero(np.diff(of, prepend=-1))
    of_start = [of[s] for s in starts]
    for p in range(len(of)):
        common = np.bitwise_count(words[p] & words[p:]).sum(axis=1, dtype=np.int64)
        # a pair of planes of one dimension stands for both orders
        common[1 : int(np.searchsorted(of, of[p], side="right")) - p] *= 2
        weighted = common.astype(object) * weights[p:] if wide else common * weights[p:]
        later = np.searchsorted(starts, p, side="right") - 1
        cuts = np.maximum(starts[later:] - p, 0)
        for d, x in zip(of_start[later:], np.add.reduceat(weighted, cuts).tolist(), strict=True):
            products[of[p], d] = products.get((of[p], d), 0) + (int(x) << at[p])
    full = {}
    for i in range(dims):
        for j in range(i, dims):
            full[i, j] = products.get((i, j), 0) + low[i] * sums[j] + low[j] * sums[i] + rows * low[i] * low[j]
    return [s + rows * m for s, m in zip(sums, low, strict=True)], full


def _gather(batches: Iterator[pa.RecordBatch], dims: int) -> Iterator[pa.RecordBatch]:
    """Sums of a task: (key, digit, value) for the rows, the sums and the products of all dimensions."""
    totals: dict[int, int] = {}
    held: dict[bool, list[np.ndarray]] = {False: [], True: []}

    def add(kind: bool) -> None:
        values = np.concatenate(held[kind])
        held[kind] = []
        for at in range(0, len(values), BLOCK):
            block = values[at : at + BLOCK]
            sums, products = scatter(block)
            totals[0] = totals.get(0, 0) + len(block)
            for i, s in enumerate(sums):
                totals[1 + i] = totals.get(1 + i, 0) + s
            for (i, j), x in products.items():
                key = 1 + dims + i * dims + j
                totals[key] = totals.get(key, 0) + x

    for batch in batches:
        x = integers(matrix(batch.column(0), dims))
        far = (np.abs(x) > WIDE).any(axis=1)
        for kind in (False, True):
            some = x[far == kind]
            if len(some):
                held[kind].append(some if kind else some.astype(np.int64))
                if sum(map(len, held[kind])) >= BLOCK:
                    add(kind)
    for kind in (False, True):
        if held[kind]:
            add(kind)
    rows = []
    for key, x in totals.items():
        digit, sign = 0, -1 if x < 0 else 1
        x = abs(x)
        while x:
            x, low = divmod(x, BASE)
            rows.append((key, digit, sign * low))
            digit += 1
    columns = [pa.array(c, k) for c, k in zip(zip(*rows) if rows else ((), (), ()), (pa.int64(), pa.int32(), pa.int64()))]
    yield pa.RecordBatch.from_arrays(columns, names=["key", "digit", "value"])


def matrix(column: pa.Array, dims: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dims)


class Model:
    """Row count, sums and eigenvectors of the covariance of integers x (shifted by SHIFT)."""

    def __init__(self, n: int, sums: list[int], centred: list[list[int]], most: int) -> None:
        """`centred` is n times the cross-products less the products of sums: n^2 times the covariance."""
        self.n, self.sums, dims = n, sums, len(sums)
        v = np.array([[x / (n * n) for x in row] for row in centred])
        values, vectors = np.linalg.eigh(v)
        values, vectors = values[::-1][:most], vectors[:, ::-1][:, :most]
        trace = sum(centred[i][i] for i in range(dims)) / (n * n)
        # a variance within the rounding of the largest one is none
        real = values > max(values[0], 0.0) * dims * np.finfo(float).eps
        self.explained = [max(float(e), 0.0) / trace if trace > 0 else None for e in values]
        self.real = real.tolist()
        self.vectors = vectors
        self.axes = np.divide(vectors, np.sqrt(np.where(real, values, 1.0)))
        # the covariance of what the axes give, from the exact one
        some = self.axes[:, real]
        left = some.T @ v @ some - np.eye(some.shape[1])
        self.identity_error = float(np.abs(left).max()) if left.size else 0.0


def fit(rows: DataFrame, vector: str, dims: int, most: int) -> Model | None:
    """The model of all rows; None without rows."""
    parts = rows.select(F.col(vector).cast("array<double>")).mapInArrow(lambda b: _gather(b, dims), "key long, digit int, value long")
    # a number for each pair of dimensions
    found = parts.groupBy("key", "digit").agg(F.sum(F.col("value").cast("decimal(38,0)")).alias("value")).collect()
    totals: dict[int, int] = {}
    for r in found:
        totals[r["key"]] = totals.get(r["key"], 0) + int(r["value"]) * BASE ** r["digit"]
    n = totals.get(0, 0)
    if not n:
        return None
    sums = [totals.get(1 + i, 0) for i in range(dims)]
    product = lambda i, j: totals.get(1 + dims + min(i, j) * dims + max(i, j), 0)
    centred = [[n * product(i, j) - sums[i] * sums[j] for j in range(dims)] for i in range(dims)]
    return Model(n, sums, centred, most)


def dimensions(rows: DataFrame, vector: str) -> int:
    """The length that most vectors have, the larger one at ties; 0 without rows."""
    sizes = rows.groupBy(F.size(vector).alias("size")).count()
    top = sizes.orderBy(F.desc("count"), F.desc("size")).limit(1).collect()
    return top[0]["size"] if top else 0


def whiten(df: DataFrame, vector: str = "embedding", most: int = 32) -> tuple[DataFrame, Model | None]:
    """Adds n, deviation, deviation_exact and whitened (array of up to `most` components) to every row that takes part.

    Rows with a NULL vector, or NULL or non-finite entries, are dropped; so are vectors of another
    length than most have. All others make up the fit, repeated rows each for itself, and all
    are returned with their other columns; columns named like new ones are replaced. `deviation`
    is NULL where it exceeds a long; `deviation_exact` has it as text. Components without any
    variance give NULL. Entries of any size count exactly, also where a long could not hold
    them. Without rows the result is empty and there is no model.
    """
    rows = usable(df, vector)
    dims = dimensions(rows, vector)
    rows = rows.where(F.size(vector) == dims)
    model = fit(rows, vector, dims, most) if dims else None
    fields = [
        StructField("n", LongType()),
        StructField("deviation", LongType()),
        StructField("deviation_exact", StringType()),
        StructField("whitened", ArrayType(DoubleType())),
    ]
    if model is None:
        empty = [pa.array([], k) for k in (pa.int64(), pa.int64(), pa.string(), pa.list_(pa.float64()))]
        return add_columns(rows.where(F.lit(False)), fields, lambda: lambda b: empty), None

    def start():
        sums, n = model.sums, model.n
        far = max(map(abs, sums))

        def make(batch: pa.RecordBatch) -> list[pa.Array]:
            x = integers(matrix(batch.column(vector), dims))
            top = n * int(np.abs(x).max(initial=0)) + far
            if x.dtype == object or dims * top * top >= 1 << 63:
                z = n * x.astype(object) - np.array(sums, dtype=object)
                squares = [int(s) for s in (z * z).sum(axis=1)] if len(z) else []
                real = (z / n).astype(np.float64).reshape(-1, dims)
            else:
                z = n * x - np.array(sums, np.int64)
                squares, real = (z * z).sum(axis=1).tolist(), z / n
            white = real @ model.axes
            null = np.broadcast_to(~np.array(model.real), white.shape)
            flat = pa.array(white.ravel(), mask=null.ravel())
            ends = pa.array(np.arange(len(white) + 1, dtype=np.int32) * white.shape[1])
            return [
                pa.array(np.full(len(white), n, np.int64)),
                pa.array([s if s < 1 << 63 else None for s in squares], pa.int64()),
                pa.array([str(s) for s in squares], pa.string()),
                pa.ListArray.from_arrays(ends, flat),
            ]

        return make

    return add_columns(rows, fields, start), model
