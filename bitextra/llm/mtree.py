"""Exact top-k inner products by best-first search of M-trees.

Inner products become distances: a vector x gets the component sqrt(M^2 - |x|^2), M the largest
norm, a query q gets 0, and |q' - x'|^2 = |q|^2 + M^2 - 2 q.x. Rows go to the nearest of a few
routing vectors and, where one has too many, to one of its shards; each shard is written as a
file of pages. A search opens pages by the best product they can hold. It skips subtrees by
their covering radius, and by the stored distance to the parent before any product is taken.
Floats score where the norms prove every sum below 2^53; elsewhere they only choose the rows that
Python integers score. Vectors of a norm of 2^26 or more have trees of their own, by size.
"""

from __future__ import annotations

import heapq
import io
import math
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from .common import Store, new_folder, settle, shared_uri

LEAF, FAN, ROUTES, DIRECTORY = 256, 8, 64, 20_000
#: Squared norms below this are ordinary: products and distances are exact in floats.
ORDINARY = float(1 << 52)
#: Squared norms from here on are too near to overflow for distances.
VAST = 1e300
LIMB = 63
#: Queries that are written together, those that travel to a shard in one row, and blocks that a task keeps.
BLOCK, PIECE, KEPT = 1024, 64, 8


def slack_of(whole, width: int):
    """What rounding can take from a bound on products, where |q|^2 + M^2 is `whole`.

    Beyond 2^53 a squared distance is off by (width + 8) ulps of `whole`, a distance by the root of it.
    """
    loose = np.where(whole < 2 * ORDINARY, 0.0, 16 * math.sqrt((width + 8) * 2.0**-52))
    return (1e-9 + loose) * whole + 1e-6


def to_limbs(score: int) -> list[int]:
    """A whole number of any size as an array of longs that sorts like it: [0, score] if it is a long."""
    m = 0
    while not -(1 << 63) <= score >> LIMB * m < 1 << 63:
        m += 1
    rest = [score >> LIMB * i & (1 << LIMB) - 1 for i in range(m - 1, -1, -1)]
    return [m if score > 0 else -m, score >> LIMB * m, *rest]


def from_limbs(limbs: list[int]) -> int:
    score = limbs[1]
    for limb in limbs[2:]:
        score = score << LIMB | limb
    return score


def as_float(score: float) -> float:
    try:
        return float(score)
    except OverflowError:
        return math.copysign(math.inf, score)


class MTree:
    """Pages in arrays: nodes (centre, radius, distance to the parent's centre, children) and leaf entries."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, largest: float) -> None:
        self.largest = largest
        flat = vectors if largest < VAST else np.zeros_like(vectors)  # no distances there, all pages are read
        norms = (flat * flat).sum(axis=1)
        points = np.column_stack([flat, np.sqrt(np.maximum(0.0, (largest if largest < VAST else 0.0) - norms))])
        self.centre, self.radius, self.to_parent, self.first, self.last, self.leaf = [], [], [], [], [], []
        self.order: list[np.ndarray] = []
        self.entry_distance: list[np.ndarray] = []
        self._nodes = [(np.arange(len(ids)), points[0], 0.0)] if len(ids) else []
        done, entries = 0, 0
        while done < len(self._nodes):  # breadth first: the children of a node are neighbours
            rows, centre, parent = self._nodes[done]
            far = np.sqrt(((points[rows] - centre) ** 2).sum(axis=1))
            self.centre.append(centre)
            self.radius.append(float(far.max()))
            self.to_parent.append(parent)
            self.leaf.append(len(rows) <= LEAF)
            if len(rows) <= LEAF:
                self.order.append(rows)
                self.entry_distance.append(far)
                self.first.append(entries)
                entries += len(rows)
                self.last.append(entries)
            else:
                self.first.append(len(self._nodes))
                self._nodes += self._cut(rows, points, centre)
                self.last.append(len(self._nodes))
            done += 1
        order = np.concatenate(self.order) if self.order else np.zeros(0, np.int64)
        self.ids, self.vectors, self.points = ids[order], vectors[order], None
        far = np.concatenate(self.entry_distance) if self.order else np.zeros(0)
        self.pages = {
            "centre": np.array(self.centre).reshape(len(self._nodes), -1), "radius": np.array(self.radius), "to_parent": np.array(self.to_parent),
            "first": np.array(self.first, np.int64), "last": np.array(self.last, np.int64), "leaf": np.array(self.leaf, bool),
            "ids": self.ids, "vectors": self.vectors, "entry_distance": far, "largest": np.array([largest]),
        }

    @staticmethod
    def _cut(rows: np.ndarray, points: np.ndarray, centre: np.ndarray) -> list[tuple]:
        """Children around far-apart members; equal points are cut by their order."""
        routes, near = [], np.full(len(rows), np.inf)
        far = ((points[rows] - centre) ** 2).sum(axis=1)
        at = int(far.argmax())
        for _ in range(FAN):
            routes.append(at)
            near = np.minimum(near, ((points[rows] - points[rows[at]]) ** 2).sum(axis=1))
            at = int(near.argmax())
            if near[at] <= 0:
                break
        if len(routes) < 2:
            parts = [(p, points[p[0]]) for p in np.array_split(rows, FAN)]
        else:
            between = np.stack([((points[rows] - points[rows[r]]) ** 2).sum(axis=1) for r in routes])
            nearest = between.argmin(axis=0)
            parts = [(rows[nearest == i], points[rows[r]]) for i, r in enumerate(routes)]
        return [(p, c, float(np.sqrt(((c - centre) ** 2).sum()))) for p, c in parts if len(p)]

    def to_bytes(self) -> bytes:
        out = io.BytesIO()
        np.savez(out, **self.pages)
        return out.getvalue()


class Searcher:
    def __init__(self, data: bytes) -> None:
        with np.load(io.BytesIO(data)) as pages:
            for name in pages.files:
                setattr(self, name, pages[name])
        self.products = 0  # of a query and an entry or centre, for tests

    def search(self, query: np.ndarray, own: int, k: int, least: float) -> list[tuple[int, int]]:
        """The k best (score, id), ids other than `own`, that reach `least`; ties to the smaller id."""
        if not len(self.leaf):
            return []
        with np.errstate(over="ignore"):
            largest, norm = float(self.largest[0]), float(query @ query)
        whole = norm + largest
        best: list[tuple[int, int]] = []  # a heap of (score, -id), worst first
        bound = as_float(least)
        if not whole < VAST:
            self.products += len(self.ids)
            self._offer(best, range(len(self.ids)), query, own, k, least)
            return [(s, -i) for s, i in sorted(best, reverse=True)]
        slack = float(slack_of(whole, len(query)))
        exact = norm * largest < 2.0**105  # any sum of products is at most the product of the norms
        doubt = 0.0 if exact else (len(query) + 8) * 2.0**-52 * math.sqrt(norm) * math.sqrt(largest)
        # best product at a distance of at least d: (whole - d^2) / 2
        away = lambda centre: np.sqrt(np.maximum(0.0, whole - 2 * (centre[:, :-1] @ query)))
        d = float(away(self.centre[:1])[0])
        self.products += 1
        queue = [(-(whole - max(0.0, d - float(self.radius[0])) ** 2) / 2, 0, d)]
        while queue:
            top, node, d = heapq.heappop(queue)
            if -top + slack < bound:
                break
            a, b = int(self.first[node]), int(self.last[node])
            if self.leaf[node]:
                hope = (whole - (d - self.entry_distance[a:b]) ** 2) / 2
                rows = a + np.flatnonzero(hope + slack >= bound)
                if not len(rows):
                    continue
                self.products += len(rows)
                # a page that is read whole is not copied
                scores = (self.vectors[a:b] if len(rows) == b - a else self.vectors[rows]) @ query
                if not exact:
                    others = scores[self.ids[rows] != own]
                    worst = np.partition(others, len(others) - k)[len(others) - k] - doubt if len(others) >= k else -math.inf
                    hopeful = scores + doubt >= max(worst, bound - 1e-15 * abs(bound) if math.isfinite(bound) else bound)
                    self._offer(best, rows[hopeful].tolist(), query, own, k, least)
                    if len(best) == k:
                        bound = max(bound, as_float(best[0][0]))
                    continue
                scores = np.rint(scores)
                for at in np.flatnonzero(scores >= bound).tolist():
                    one = (int(scores[at]), -int(self.ids[rows[at]]))
                    if one[1] == -own or len(best) == k and one <= best[0]:
                        continue
                    heapq.heappush(best, one) if len(best) < k else heapq.heapreplace(best, one)
                    if len(best) == k:
                        bound = max(bound, best[0][0])
            else:
                gap = np.maximum(0.0, np.abs(d - self.to_parent[a:b]) - self.radius[a:b])
                rows = a + np.flatnonzero((whole - gap**2) / 2 + slack >= bound)
                if not len(rows):
                    continue
                self.products += len(rows)
                far = away(self.centre[rows])
                hope = (whole - np.maximum(0.0, far - self.radius[rows]) ** 2) / 2
                for child, h, f in zip(rows.tolist(), hope.tolist(), far.tolist(), strict=True):
                    if h + slack >= bound:
                        heapq.heappush(queue, (-h, child, f))
        return [(s, -i) for s, i in sorted(best, reverse=True)]

    def _offer(self, best: list[tuple[int, int]], rows, query: np.ndarray, own: int, k: int, least: float) -> None:
        """Scores rows with Python integers, exact at any size, and keeps the best."""
        whole = [int(x) for x in query.tolist()]
        for row in rows:
            if self.ids[row] == own:
                continue
            one = (sum(x * int(y) for x, y in zip(whole, self.vectors[row].tolist(), strict=True)), -int(self.ids[row]))
            if one[0] >= least and len(best) < k:
                heapq.heappush(best, one)
            elif one[0] >= least and one > best[0]:
                heapq.heapreplace(best, one)


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    ends, values = column.offsets.to_numpy(), column.values.to_numpy()
    out = np.zeros((len(column), width))
    sizes = np.diff(ends)
    rows = np.repeat(np.arange(len(column)), sizes)
    out[rows, np.arange(ends[0], ends[-1]) - np.repeat(ends[:-1], sizes)] = values[ends[0] : ends[-1]]
    return out


def top_k(
    df: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", k: int = 5, scale: int = 256, every: int = 50, shard_rows: int = 8192
) -> DataFrame:
    """(query_id, rank, vec_id, score): the k best of all other rows for every row whose id is divisible by `every`.

    Components become floor(scale * x); scores are exact integers of any size, and so is their
    order; a score that no long can hold is NULL. Ties go to the smaller id. Vectors that are NULL
    or hold a NULL or non-finite component (once scaled, as doubles) take no part, nor do NULL ids. Vectors of
    different lengths are compared as if filled up with zeros. Rows repeated with id and vector
    are one row; rows of one id with different vectors are all candidates of other ids, and a
    query for each. Fewer than k candidates are all returned.
    """
    spark = df.sparkSession
    scaled = lambda x: F.lit(float(scale)) * x.cast("double")
    # doubles from 2^53 on are whole
    whole = F.transform(F.col(vector), lambda x: F.when(F.abs(scaled(x)) < 2 * ORDINARY, F.floor(scaled(x)).cast("double")).otherwise(scaled(x)))
    fine = F.col(vector).isNotNull() & F.col(vec_id).isNotNull() & F.forall(
        F.col(vector), lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(scaled(x)) < float("inf"))
    )
    square = F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x)
    # 0: ordinary; else a number for each 2^52 of the squared norm
    tier = F.when(square < ORDINARY, 0).otherwise(F.floor(F.least(F.lit(40.0), F.log2(square) / 52)).cast("int"))
    rows = df.where(fine).select(F.col(vec_id).cast("long").alias("id"), whole.alias("v")).distinct()
    rows = settle(rows.withColumn("tier", tier), "vectors")
    ordinary = F.col("tier") == 0
    facts = rows.agg(
        F.count(F.lit(1)).alias("n"), F.count_if(ordinary).alias("o"), F.max(F.when(ordinary, square)).alias("m"), F.max(F.size("v")).alias("w")
    ).first()
    schema = "query_id long, rank int, vec_id long, score long"
    if not facts["n"]:
        return spark.createDataFrame([], schema)
    n, largest, width = facts["n"], float(facts["m"] or 0), facts["w"]
    # of equal vectors only the k + 1 smallest ids can be among the best
    same = Window.partitionBy("v").orderBy("id")
    candidates = rows.withColumn("r", F.row_number().over(same)).where(F.col("r") <= k + 1).drop("r")

    # at most ROUTES routing vectors and ROUTES + DIRECTORY shards, whatever the size of the table
    shard_rows = max(shard_rows, math.ceil(n / DIRECTORY))
    count = max(1, min(ROUTES, math.ceil(facts["o"] / shard_rows)))
    drawn = rows.where(ordinary).orderBy(F.xxhash64("id", F.lit(3)), "id", "v").select("v").limit(count).collect()
    padded = np.zeros((max(1, len(drawn)), width))
    for i, r in enumerate(drawn):
        padded[i, : len(r["v"])] = r["v"]
    routes = np.column_stack([padded, np.sqrt(np.maximum(0.0, largest - (padded**2).sum(axis=1)))])

    def away(points: np.ndarray) -> np.ndarray:
        """Distance of every point to every route."""
        cross = (points**2).sum(axis=1)[:, None] + (routes**2).sum(axis=1) - 2 * points @ routes.T
        return np.sqrt(np.maximum(0.0, cross))

    def route(query: bool):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                tiers = b.column("tier").to_numpy()
                x = _matrix(b.column("v"), width)
                x[tiers > 0] = 0  # their route is their tier
                last = np.zeros(len(x)) if query else np.sqrt(np.maximum(0.0, largest - (x**2).sum(axis=1)))
                far = away(np.column_stack([x, last]))
                best = far.argmin(axis=1)
                far = far[np.arange(len(x)), best]
                best = np.where(tiers > 0, count + tiers - 1, best).astype(np.int64)
                yield pa.RecordBatch.from_arrays([b.column("id"), b.column("v"), pa.array(best), pa.array(far)], names=["id", "v", "route", "far"])

        return run

    routed = settle(candidates.mapInArrow(route(False), "id long, v array<double>, route long, far double"), "routed")
    shards = {r["route"]: math.ceil(r["count"] / shard_rows) for r in routed.groupBy("route").count().collect()}
    salts = F.element_at(F.array(*[F.lit(shards.get(i, 1)) for i in range(count + 40)]), (F.col("route") + 1).cast("int"))
    salt = lambda: F.pmod(F.xxhash64("id", F.lit(4)), salts)
    shard = F.col("route") * DIRECTORY + salt()
    store = Store(shared_uri(spark, new_folder(spark, "mtree")))

    def build(key: tuple, table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        ids = table.column("id").to_numpy()
        x = _matrix(table.column("v").chunk(0), width)
        with np.errstate(over="ignore"):
            top = float((x**2).sum(axis=1).max())
        name = f"{key[0].as_py()}-{uuid.uuid4().hex}.npz"
        store.write(name, MTree(ids, x, largest if top < ORDINARY else top).to_bytes())
        far = max(table.column("far").to_pylist())
        return pa.table({"shard": [key[0].as_py()], "name": [name], "route": [table.column("route")[0].as_py()], "radius": [far], "top": [top]})

    trees = settle(
        routed.withColumn("shard", shard).groupBy("shard").applyInArrow(build, "shard long, name string, route long, radius double, top double"), "trees"
    )
    directory = trees.collect()  # at most ROUTES + DIRECTORY rows, and one for each tier
    names = {r["shard"]: r["name"] for r in directory}

    def answers(rows: Iterator[tuple]) -> pa.RecordBatch:
        """The best of a tree for each (id, part, least, vector, tree)."""
        out = [(q, part, i, to_limbs(score)) for q, part, least, x, tree in rows for score, i in tree.search(x, q, k, least)]
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64())]
        columns = list(zip(*out)) or [[]] * 4
        return pa.RecordBatch.from_arrays([pa.array(c, kind) for c, kind in zip(columns, kinds, strict=True)], names=["query_id", "part", "vec_id", "score"])

    def trees_of():
        """The tree of a shard; the last one is kept, as rows come shard by shard."""
        at, tree = None, None

        def of(shard: int) -> Searcher:
            nonlocal at, tree
            if shard != at:
                at, tree = shard, Searcher(store.read(names[shard]))
            return tree

        return of

    def at_home(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree = trees_of()
        for b in batches:
            x, of = _matrix(b.column("v"), width), [b.column(c).to_pylist() for c in ("id", "part", "shard")]
            yield answers((q, part, -math.inf, x[i], tree(s)) for i, (q, part, s) in enumerate(zip(*of, strict=True)))

    def elsewhere(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree, blocks = trees_of(), {}
        for b in batches:
            for row in b.to_pylist():
                if row["block"] not in blocks:
                    if len(blocks) == KEPT:
                        del blocks[next(iter(blocks))]
                    with pa.ipc.open_stream(store.read(row["block"])) as stream:
                        block = stream.read_all().combine_chunks().to_batches()[0]
                    blocks[row["block"]] = _matrix(block.column("v"), width), *[block.column(c).to_pylist() for c in ("id", "part", "least")]
                x, ids, parts, least = blocks[row["block"]]
                go = row["first"] + np.flatnonzero(np.unpackbits(np.frombuffer(row["go"], np.uint8)))
                bound = lambda i: -math.inf if least[i] is None else from_limbs(least[i])  # noqa: B023, E731
                yield answers((ids[i], parts[i], bound(i), x[i], tree(row["shard"])) for i in go.tolist())  # noqa: B023

    found = "query_id long, part long, vec_id long, score array<long>"
    part = F.xxhash64("v").alias("part")  # tells queries of one id and different vectors apart
    queries = rows.where(F.col("id") % every == 0).mapInArrow(route(True), "id long, v array<double>, route long, far double")
    # the route of a query may have no shard of its own, if all its rows are equal to others
    routes_used = sorted(shards)
    home = F.when(F.col("route").isin(routes_used), F.col("route")).otherwise(F.lit(routes_used[0]))
    queries = settle(queries.withColumn("route", home).withColumn("shard", shard).select("id", "v", "shard", part), "queries")
    # as many tasks as the session has, however few bytes the queries are; the salt parts the queries of a shard
    tasks = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    deal = lambda q, *by: q.repartition(tasks, "shard", F.pmod(F.xxhash64(*by), F.lit(64))).sortWithinPartitions("shard", *by)
    near = settle(deal(queries, "id").mapInArrow(at_home, found), "near")
    kth = near.groupBy("query_id", "part").agg(F.count(F.lit(1)).alias("c"), F.min("score").alias("s"))
    kth = kth.select("query_id", "part", F.when(F.col("c") >= k, F.col("s")).alias("least"))

    def others(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Blocks of queries, written once each; per piece of one and other shard that can reach their k-th products, the queries to try."""
        shard_of = np.array([r["shard"] for r in directory])
        of = np.array([r["route"] for r in directory])
        radius = np.array([r["radius"] for r in directory])
        top = np.sqrt(np.array([r["top"] for r in directory]))

        def reach(b: pa.RecordBatch) -> np.ndarray:
            x = _matrix(b.column("v"), width)
            least = np.array([-np.inf if s is None else as_float(from_limbs(s)) for s in b.column("least").to_pylist()], dtype=np.float64)
            home = b.column("shard").to_numpy()
            with np.errstate(over="ignore", invalid="ignore"):  # what has no distance is searched
                size = (x**2).sum(axis=1)
                norms = (size + largest)[:, None]
                far = away(np.column_stack([x, np.zeros(len(x))]))[:, np.minimum(of, count - 1)]
                hope = (norms - np.maximum(0.0, far - radius) ** 2) / 2 + slack_of(norms, width)
                # a shard of a tier has no route: norms alone
                hope = np.where(of < count, hope, np.sqrt(size)[:, None] * top * (1 + 1e-9) + 1e-6)
                return ~(hope < least[:, None]) & (shard_of[None, :] != home[:, None])

        for whole in batches:
            for start in range(0, whole.num_rows, BLOCK):
                b = whole.slice(start, BLOCK)
                data, name = io.BytesIO(), f"{uuid.uuid4().hex}.arrow"
                with pa.ipc.new_stream(data, b.schema) as stream:
                    stream.write_batch(b)
                store.write(name, data.getvalue())
                for first in range(0, b.num_rows, PIECE):
                    go = reach(b.slice(first, PIECE))
                    to = np.flatnonzero(go.any(axis=0))
                    bits = [np.packbits(go[:, s]).tobytes() for s in to]
                    columns = [pa.array(shard_of[to], pa.int64()), pa.array([name] * len(to), pa.string()), pa.array([first] * len(to), pa.int32())]
                    yield pa.RecordBatch.from_arrays([*columns, pa.array(bits, pa.binary())], names=["shard", "block", "first", "go"])

    kth = kth.withColumnsRenamed({"query_id": "_q", "part": "_p"})
    bounded = queries.join(kth, (F.col("id") == F.col("_q")) & (F.col("part") == F.col("_p")), "left")
    # written before it is dealt: a block counts under the name that its committed task gave it
    rest = settle(bounded.select("id", "v", "shard", "part", "least").mapInArrow(others, "shard long, block string, first int, go binary"), "others")
    far_ones = deal(rest, "block", "first").mapInArrow(elsewhere, found)
    best = Window.partitionBy("query_id", "part").orderBy(F.col("score").desc(), "vec_id")
    out = near.unionByName(far_ones).distinct().withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return out.select("query_id", "rank", "vec_id", F.when(F.col("score")[0] == 0, F.col("score")[1]).alias("score"))
