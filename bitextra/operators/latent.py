"""Latent semantics and clusters of sparse rows, by passes that send one small sum per task.

Every pass reads the packed rows in the checkpoint folder once as Arrow batches; a task adds up its share, some
rows after the other, and sends one partial table. Tasks are merged to a few per core first, so the partial tables grow with cores, not with rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import ArrayType, BinaryType, DoubleType, IntegerType, StructField, StructType

from .lookup import settled, small_batches
from .mining import PACKED, packed, unpacked
from .preprocessors import preview
from ..functions.hashing import hash_key

STEP = 1 << 17  # an eighth of the numbers that a task holds as a dense block: entries times loadings, or rows times centres
ROWS = 64


def _few_tasks(df: DataFrame) -> DataFrame:
    return df.coalesce(4 * df.sparkSession.sparkContext.defaultParallelism)


def _part(entries: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, feature and weight of every entry of some rows, lists or packed (mining.PACKED); NULL rows have none."""
    if pa.types.is_struct(entries.type):
        both = [entries.field("feature"), entries.field("weight")]
        size = pc.fill_null(pc.binary_length(both[0]), 0).to_numpy(zero_copy_only=False) // 4
        numbers = unpacked(both[0], np.int32), unpacked(both[1], np.float64)
    else:
        size = pc.fill_null(pc.list_value_length(entries), 0).to_numpy(zero_copy_only=False)
        items = entries.flatten()
        numbers = items.field("feature").to_numpy(), items.field("weight").to_numpy()
    return np.repeat(np.arange(len(entries)), size), *numbers


def _sizes(entries: pa.Array) -> np.ndarray:
    size = pc.binary_length(entries.field("feature")) if pa.types.is_struct(entries.type) else pc.list_value_length(entries)
    return pc.fill_null(size, 0).to_numpy(zero_copy_only=False) // (4 if pa.types.is_struct(entries.type) else 1)


def _flat(entries: pa.Array, width: int = 1, most: int = 1 << 62) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]]:
    """(first row, rows, row behind the first, feature, weight of the entries) of at most `most` whole rows, about 8 STEP / width entries, together."""
    ends, lo, step = np.cumsum(_sizes(entries), dtype=np.int64), 0, max(1, 8 * STEP // max(1, width))
    while lo < len(entries):
        hi = max(lo + 1, int(np.searchsorted(ends, (ends[lo - 1] if lo else 0) + step, side="right")))
        hi = min(hi, lo + most)
        yield lo, hi - lo, *_part(entries[lo:hi])
        lo = hi


def pack(rows: DataFrame, key: str) -> DataFrame:
    """(key, entries) with the entries of a row as two byte strings; packed rows stay as they are."""
    if isinstance(rows.schema["entries"].dataType, StructType):
        return rows.select(key, "entries")

    def packing(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            entries, size = batch.column(1), _sizes(batch.column(1))
            _, feature, weight = _part(entries)
            offsets = np.concatenate([[0], np.cumsum(size)])
            both = [packed(offsets, feature.astype(np.int32)), packed(offsets, weight.astype(np.float64))]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.StructArray.from_arrays(both, names=["feature", "weight"])], names=[key, "entries"])

    schema = StructType([StructField(key, rows.schema[key].dataType), StructField("entries", PACKED)])
    return rows.select(key, "entries").mapInArrow(packing, schema)


def _dense(entries: pa.Array, features: int, width: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, features, rows x these features): some rows after the other as a dense block of the features they hold.

    A block has at most ROWS rows, so a matrix product costs an entry at most ROWS times as much as a sparse one would, and in fact far less.
    """
    for lo, n, row, f, w in _flat(entries, width, ROWS):
        held = np.zeros(features, bool)
        held[f] = True
        used = np.flatnonzero(held)
        at = np.zeros(features, np.int64)
        at[used] = np.arange(len(used))
        yield lo, used, np.bincount(row * len(used) + at[f], w, n * len(used)).reshape(n, len(used))


def _gram_times(rows: DataFrame, q: np.ndarray) -> np.ndarray:
    """A'Aq of the sparse rows A; at most one row of sums per feature comes to the driver."""
    size, width = q.shape

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((size, width))
        for batch in batches:
            for _, used, x in _dense(batch.column(0), size, width):
                total[used] += x.T @ (x @ q[used])
        used = np.flatnonzero(total.any(axis=1)).astype(np.int32)
        offsets = np.arange(0, width * len(used) + 1, width, dtype=np.int32)
        sums = pa.ListArray.from_arrays(pa.array(offsets), pa.array(total[used].ravel()))
        yield pa.RecordBatch.from_arrays([pa.array(used), sums], names=["feature", "sums"])

    parts = _few_tasks(rows.select("entries")).mapInArrow(partial, "feature int, sums array<double>")
    summed = parts.groupBy("feature").agg(*[F.sum(F.col("sums")[j]).alias(f"_{j}") for j in range(width)]).toArrow()
    out = np.zeros((size, width))
    if summed.num_rows:
        out[summed.column(0).to_numpy()] = np.column_stack([summed.column(j + 1).to_numpy() for j in range(width)])
    return out


def _moments(rows: DataFrame, features: int) -> tuple[np.ndarray, np.ndarray]:
    """Sums of the weights of each feature and of their squares."""

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((2, features))
        for batch in batches:
            for *_, f, w in _flat(batch.column(0)):
                sums += np.bincount(f, w, features), np.bincount(f, w * w, features)
        used = np.flatnonzero(sums[1])
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int32()), *map(pa.array, sums[:, used])], names=["feature", "a", "b"])

    parts = _few_tasks(rows.select("entries")).mapInArrow(partial, "feature int, a double, b double")
    found = parts.groupBy("feature").agg(F.sum("a").alias("a"), F.sum("b").alias("b")).toArrow()
    out = np.zeros((2, features))
    out[:, found.column(0).to_numpy()] = found.column(1).to_numpy(), found.column(2).to_numpy()
    return out[0], out[1]


def _projected(loadings: np.ndarray) -> Callable[[Column], Column]:
    k = loadings.shape[1]

    @F.arrow_udf(ArrayType(DoubleType()))
    def project(entries: pa.Array) -> pa.Array:
        out = np.zeros((len(entries), k))
        for lo, used, x in _dense(entries, *loadings.shape):
            out[lo : lo + len(x)] = x @ loadings[used]
        return pa.ListArray.from_arrays(pa.array(np.arange(0, k * len(out) + 1, k, dtype=np.int32)), pa.array(out.ravel()))

    return project


def principal_loadings(
    rows: DataFrame, features: int, k: int, passes: int = 12, tolerance: float = 1e-4, extra: int = 10, seed: int = 42
) -> np.ndarray:
    """features x k: right singular vectors of the sparse rows, largest first, by block power iteration.

    `extra` more directions than asked for are iterated from a fixed random start. It ends when the
    sum of the k largest squared singular values grows by less than `tolerance` of itself, after
    `passes` passes at the latest. The largest loading of each vector is positive.
    """
    k = min(k, features)
    width = min(k + extra, features)
    q = np.linalg.qr(np.random.default_rng(seed).standard_normal((features, width)))[0]
    last = 0.0
    for at in range(passes):
        image = _gram_times(rows, q)
        small = q.T @ image
        values, turn = np.linalg.eigh((small + small.T) / 2)
        total = float(values[-k:].sum())
        if total - last <= tolerance * total or at == passes - 1:
            break
        last = total
        q = np.linalg.qr(image)[0]
    loadings = (q @ turn)[:, ::-1][:, :k]
    signs = np.sign(loadings[np.abs(loadings).argmax(axis=0), np.arange(k)])
    return loadings * np.where(signs == 0, 1.0, signs)


def lsa(rows: DataFrame, key: str, features: int = 5000, k: int = 50, passes: int = 12) -> tuple[DataFrame, float]:
    """((key, vector), explained variance ratio): truncated SVD of the sparse rows `entries`.

    Every row has a vector, one without entries (or with NULL) the zero vector. The rows go to the checkpoint
    folder as byte strings of numbers, which every pass and whatever reads the vectors take from there; no
    executor's memory holds them. The driver holds matrices of features x (k + 10) numbers.
    """
    with small_batches(rows.sparkSession):
        rows = settled(pack(rows, key), "sparse-rows")
        loadings = principal_loadings(rows, features, k, passes)
        vectors = rows.select(key, _projected(loadings)(F.col("entries")).alias("vector"))
        kept = vectors.agg(*[F.var_pop(F.col("vector")[j]).alias(f"v{j}") for j in range(loadings.shape[1])]).first()
        n, total = rows.count(), 0.0
        if n:
            first, second = _moments(rows, features)
            total = float((second / n - (first / n) ** 2).sum())
    return vectors, sum(x or 0.0 for x in kept) / total if total else 0.0


# --- clusters ------------------------------------------------------------------------------


@F.arrow_udf(BinaryType())
def _as_bytes(vectors: pa.Array) -> pa.Array:
    size = pc.list_value_length(vectors).to_numpy(zero_copy_only=False)
    return packed(np.concatenate([[0], np.cumsum(size)]), vectors.flatten().to_numpy(zero_copy_only=False))


def _matrix(vectors: pa.Array) -> np.ndarray:
    if pa.types.is_binary(vectors.type):
        return unpacked(vectors, np.float64).reshape(len(vectors), -1) if len(vectors) else np.zeros((0, 0))
    return vectors.flatten().to_numpy(zero_copy_only=False).reshape(len(vectors), -1) if len(vectors) else np.zeros((0, 0))


def _distances(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    both = (x * x).sum(axis=1)[:, None] + (centres * centres).sum(axis=1) - 2 * (x @ centres.T)
    return np.maximum(both, 0.0)


def _draws(ids: np.ndarray, *salt: int) -> np.ndarray:
    """Numbers between 0 and 1 that depend on the id and the salt alone."""
    x = ids.astype(np.int64).view(np.uint64).copy()
    for s in salt:
        x += np.uint64((s + 1) * 0x9E3779B97F4A7C15 & (1 << 64) - 1)
        for shift, by in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
            x = (x ^ (x >> np.uint64(shift))) * np.uint64(by)
        x ^= x >> np.uint64(31)
    return ((x >> np.uint64(11)).astype(np.float64) + 0.5) / (1 << 53)


def _blocks(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    step = max(1, 8 * STEP // max(1, width))
    for batch in batches:
        for lo in range(0, batch.num_rows, step):
            part = batch.slice(lo, step)
            yield part.column(0).to_numpy(), _matrix(part.column(1))


def _seeds(data: DataFrame, starts: int, size: int, seed: int) -> np.ndarray:
    """starts x size x dimensions: k-means++ centres, one pass over the rows per centre for all starts.

    A row is the next centre with odds by its squared distance to the centres so far: the row of
    the largest log(draw) / distance. The first k centres of a start are seeds for k clusters.
    """
    chosen: list[list[np.ndarray]] = [[] for _ in range(starts)]
    for nth in range(size):
        so_far = [np.array(c) for c in chosen]

        def best(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            top: dict[int, tuple[float, list[float]]] = {}
            for ids, x in _blocks(batches, starts * max(1, nth)):  # noqa: B023
                for s, centres in enumerate(so_far):  # noqa: B023
                    far = _distances(x, centres).min(axis=1) if len(centres) else np.ones(len(x))
                    with np.errstate(divide="ignore"):
                        score = np.log(_draws(ids, seed, s, nth)) / far  # noqa: B023
                    at = int(score.argmax())
                    if s not in top or score[at] > top[s][0]:
                        top[s] = (float(score[at]), x[at].tolist())
            picked = [{"start": s, "score": v, "vector": c} for s, (v, c) in top.items()]
            yield pa.RecordBatch.from_pylist(picked, pa.schema({"start": pa.int32(), "score": pa.float64(), "vector": pa.list_(pa.float64())}))

        found = data.mapInArrow(best, "start int, score double, vector array<double>")
        for r in found.groupBy("start").agg(F.max(F.struct("score", "vector"))["vector"].alias("v")).collect():  # one row a start
            chosen[r["start"]].append(np.array(r["v"]))
    return np.array(chosen)


def _assign_all(data: DataFrame, models: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(rows, sums, cost) of every centre of every model, from one pass over the rows."""
    together, sizes = np.concatenate(models), [len(m) for m in models]
    edges, dims = np.cumsum([0, *sizes]), together.shape[1]

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums, cost = np.zeros(len(together), np.int64), np.zeros(together.shape), np.zeros(len(together))
        for _, x in _blocks(batches, len(together)):
            far = _distances(x, together)
            mine = np.zeros(far.shape)
            for a, b in zip(edges, edges[1:]):
                near = a + far[:, a:b].argmin(axis=1)
                mine[np.arange(len(x)), near] = 1.0
            n += mine.sum(axis=0).astype(np.int64)
            sums += mine.T @ x
            cost += (mine * far).sum(axis=0)
        lists = pa.ListArray.from_arrays(pa.array(np.arange(0, dims * len(n) + 1, dims, dtype=np.int32)), pa.array(sums.ravel()))
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(len(n), dtype=np.int32)), pa.array(n), pa.array(cost), lists], names=["centre", "n", "cost", "sums"]
        )

    parts = data.mapInArrow(partial, "centre int, n long, cost double, sums array<double>")
    wide = [F.sum(F.col("sums")[j]).alias(f"_{j}") for j in range(dims)]
    got = parts.groupBy("centre").agg(F.sum("n").alias("n"), F.sum("cost").alias("cost"), *wide).orderBy("centre").toArrow()
    columns = [got.column(j).to_numpy() for j in range(got.num_columns)]
    return columns[1], np.column_stack(columns[3:]), columns[2]


def elbow(costs: list[tuple[int, float]]) -> int:
    """The cluster count at the steepest fall of the cost, counted as position + 2."""
    drops = [b[1] - a[1] for a, b in zip(costs, costs[1:])]
    return drops.index(min(drops)) + 2


def cluster(
    vectors: DataFrame,
    key: str,
    max_clusters: int = 10,
    seed: int = 42,
    starts: int = 10,
    max_iter: int = 300,
    tolerance: float = 1e-4,
) -> tuple[DataFrame, list[tuple[int, float]], int]:
    """((key, cluster), cost per k, chosen k) of K-means over k = 2..max_clusters.

    The best of `starts` runs counts for each k (the first at ties). All runs of all k share their
    passes over the rows: a run leaves when its centres moved, squared and summed, by at most
    `tolerance` of the mean variance of a dimension, or after `max_iter` steps. A centre without rows stays
    where it is. Vectors go to the checkpoint folder once, as bytes, where all passes read them; rows with a NULL vector have no cluster.
    The table must hold a vector.
    """
    whole = vectors.where(F.col("vector").isNotNull())
    with small_batches(vectors.sparkSession):
        whole = settled(whole.select(key, F.xxhash64(F.col(key).cast("string")).alias("_id"), _as_bytes("vector").alias("vector")), "vectors")
    data = _few_tasks(whole.select("_id", "vector"))
    seeds = _seeds(data, starts, max_clusters, seed)
    if seeds.size == 0:
        raise ValueError("no vectors to cluster")
    runs = [(k, s) for k in range(2, max_clusters + 1) for s in range(starts)]
    centres = {(k, s): seeds[s, :k].copy() for k, s in runs}
    n, sums, cost = _assign_all(data, [np.zeros((1, seeds.shape[2]))])
    still = tolerance * max(0.0, float(cost[0] / n[0] - ((sums[0] / n[0]) ** 2).sum())) / seeds.shape[2]
    active = runs
    for _ in range(max_iter):
        n, sums, _cost = _assign_all(data, [centres[r] for r in active])
        lo, moving = 0, []
        for k, s in active:
            mine = slice(lo, lo + k)
            lo += k
            old, held = centres[k, s], n[mine, None] > 0
            new = np.where(held, sums[mine] / np.maximum(n[mine, None], 1), old)
            centres[k, s] = new
            if ((new - old) ** 2).sum() > still:
                moving.append((k, s))
        active = moving
        if not active:
            break
    *_, cost = _assign_all(data, [centres[r] for r in runs])
    ends = np.cumsum([k for k, _ in runs])
    totals = {r: float(cost[e - r[0] : e].sum()) for r, e in zip(runs, ends)}
    best_start = {k: min(range(starts), key=lambda s: totals[k, s]) for k in range(2, max_clusters + 1)}  # noqa: B023
    costs = [(k, totals[k, s]) for k, s in best_start.items()]
    best = elbow(costs) if len(costs) > 1 else max_clusters
    final = centres[best, best_start[best]]

    @F.arrow_udf(IntegerType())
    def assigned(v: pa.Array) -> pa.Array:
        return pa.array(_distances(_matrix(v), final).argmin(axis=1).astype(np.int32) if len(v) else np.zeros(0, np.int32))

    return whole.select(key, assigned(F.col("vector")).alias("cluster")), costs, best


def cluster_samples(df: DataFrame, clusters: DataFrame, key: str, n: int = 5, seed: int = 42) -> DataFrame:
    """n rows per cluster (all, if fewer) with texts cut to 100 characters; an id that repeats is drawn row by row."""
    order = [hash_key(seed, F.col(key)), F.col(key)]
    first = lambda rows, *by: (
        rows.withColumn("_r", F.row_number().over(Window.partitionBy("cluster").orderBy(*by))).where(F.col("_r") <= n).drop("_r")
    )
    picked = first(clusters.groupBy(key).agg(F.min("cluster").alias("cluster")), *order)
    rows = df.join(F.broadcast(picked), key)  # at most n rows per cluster
    return first(rows, *order, F.md5("ka"), F.md5("en")).select(
        "cluster", "domain", preview(F.col("ka")).alias("georgian_text"), preview(F.col("en")).alias("english_text")
    )
