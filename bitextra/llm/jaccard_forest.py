"""N-gram Jaccard join by a MinHash LSH forest, with exact verification.

A text's set holds the hashes of its runs of five words. Each of `trees` prefix tries sorts the
texts by a label of MinHash values. Matching starts at the full label and shortens the common
prefix until pairs at the threshold meet in some trie with probability `recall`; prefixes nest,
so the tries are cut at that depth and their nodes hold all matches of the longer prefixes.
Every pair that meets is verified on the whole sets, in the first trie where it meets.

No pair leaves a task: a node returns the number of links of each member and the member's root
in the node's own link graph, so output grows with members. Nodes are cut into chunks, and a
large one is met chunk against chunk in separate tasks. Exact copies are one text throughout.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ..operators.lookup import attach
from .common import carried, components, settle

N, CHUNK, COLUMNS = 5, 256, 8192
_U = np.uint64


def depth_for(threshold: float, trees: int, recall: float, deepest: int) -> int:
    """Shortens from the full label until a pair at the threshold is met with the wanted probability."""
    depth = deepest
    while depth > 1 and 1 - (1 - threshold**depth) ** trees < recall:
        depth -= 1
    return depth


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


@lru_cache(1)
def _byte_codes() -> np.ndarray:
    return _mixed(np.arange(1, 257, dtype=_U))


_P = 0x9E3779B97F4A7C15
_powers: dict[str, np.ndarray] = {}


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd number and of its inverse modulo 2^64; they grow with the longest text of a task."""
    if len(_powers.get("up", ())) < n:
        size = max(1 << 16, 1 << (n - 1).bit_length())
        for name, base in (("up", _P), ("down", pow(_P, -1, 1 << 64))):
            _powers[name] = np.concatenate([np.ones(1, _U), np.cumprod(np.full(size - 1, base, _U), dtype=_U)])
    return _powers["up"][:n], _powers["down"][:n]


_BLANK = np.zeros(256, dtype=bool)
_BLANK[[0x20, *range(0x09, 0x0E)]] = True


def shingles(text: str, n: int = N) -> np.ndarray:
    """Sorted 64-bit hashes of the runs of `n` words, lower case; a shorter text is one run."""
    data = np.frombuffer(text.lower().encode(), np.uint8)
    word = ~_BLANK[data]
    if not word.any():
        return np.zeros(0, _U)
    edges = np.flatnonzero(np.diff(np.concatenate([[0], word.view(np.int8), [0]])))
    starts, ends = edges[::2], edges[1::2]
    up, down = _power_tables(len(data))
    sums = np.concatenate([np.zeros(1, _U), np.cumsum(_byte_codes()[data] * up, dtype=_U)])
    words = _mixed((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(_U))
    if len(words) < n:
        words, n = words[None, :], len(words)
        runs = [words[:, i] for i in range(n)]
    else:
        runs = [words[i : len(words) - n + 1 + i] for i in range(n)]
    out = np.zeros(len(runs[0]), _U)
    for r in runs:
        out = _mixed(out * _U(0xD6E8FEB86659FD93) + r)
    return np.unique(out)


@lru_cache(4)
def _multipliers(count: int) -> np.ndarray:
    return _mixed(np.arange(1, count + 1, dtype=_U) * _U(0xA24BAED4963EE407)) | _U(1)


def prefixes(hashes: np.ndarray, trees: int, depth: int) -> np.ndarray:
    """For each trie the node of the text: a hash of the first `depth` MinHash values of its label."""
    a = _multipliers(trees * depth)
    low = np.empty(trees * depth, _U)
    for i in range(0, len(a), 8):  # few rows at once: they stay in the cache
        rotated = hashes[None, :] * a[i : i + 8, None]
        low[i : i + 8] = (rotated ^ (rotated >> _U(32))).min(axis=1)
    key = np.zeros(trees, _U)
    for column in low.reshape(trees, depth).T:
        key = _mixed(key * _U(_P) + column)
    return key


def _verify(ids: list[str], copies: np.ndarray, sets: list[np.ndarray], keys: np.ndarray, sides: np.ndarray, tree: int, threshold: float) -> list[tuple]:
    """(id, links, document links, root) of the members with a link that is first met in this trie."""
    n = len(ids)
    sizes = np.array([len(s) for s in sets], dtype=np.float64)
    wanted = np.triu(np.ones((n, n), bool), 1) if sides.min() == sides.max() else sides[:, None] < sides[None, :]
    for t in range(tree):
        wanted &= keys[:, t][:, None] != keys[:, t][None, :]
    small, large = np.minimum(sizes[:, None], sizes), np.maximum(sizes[:, None], sizes)
    wanted &= small >= threshold * large - 1e-9
    if not wanted.any():
        return []
    codes, at = np.unique(np.concatenate(sets), return_inverse=True)
    rows = np.repeat(np.arange(n), sizes.astype(np.int64))
    shared = np.bincount(at) > 1
    column = np.cumsum(shared) - 1
    keep = shared[at]
    rows, at = rows[keep], column[at[keep]]
    order = np.argsort(at, kind="stable")
    rows, at = rows[order], at[order]
    common = np.zeros((n, n), np.float32)
    for first in range(0, int(shared.sum()), COLUMNS):
        a, b = np.searchsorted(at, [first, first + COLUMNS])
        part = np.zeros((n, min(COLUMNS, int(at[b - 1]) - first + 1)), np.float32)
        part[rows[a:b], at[a:b] - first] = 1
        common += part @ part.T
    linked = wanted & (common >= threshold * (sizes[:, None] + sizes - common) - 1e-6)
    linked |= linked.T
    root = np.arange(n)
    while True:
        low = np.minimum(root, np.where(linked, root[None, :], n).min(axis=1))
        if (low == root).all():
            break
        root = low
    links, documents = linked.sum(axis=1), linked @ copies
    return [(ids[i], int(links[i]), int(documents[i]), ids[root[i]]) for i in np.flatnonzero(links)]


def classes(
    df: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    threshold: float = 0.8,
    trees: int = 24,
    deepest: int = 10,
    recall: float = 0.999,
    chunk: int = CHUNK,
) -> DataFrame:
    """One row per row of `df`: (doc_id, k, class_id, class_key, first, n_links, n_text_links).

    A link is a Jaccard similarity of `threshold` or more between the sets of two documents.
    A class is a connected component of links; `class_id` is its smallest doc_id (NULL if all
    are NULL), `class_key` names it by a text's digest, and `first` marks its row of smallest
    (doc_id, digest), NULL ids last; rows repeated with id and text are all marked. `n_links`
    counts other documents, `n_text_links` different texts. `k` is the text's MD5. A text of
    fewer than five words is one run; texts without words, and NULL, are in no class but their
    own: no key, no link, `first`. Cost: pairs that meet are verified, so it grows with the
    square of the different texts that are alike, not of copies, and no task holds over
    2 * `chunk` sets.
    """
    depth = depth_for(threshold, trees, recall, deepest)

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[str, tuple] = {}
        for b in batches:
            keys, sizes = [], []
            for k, value in zip(b.column("k").to_pylist(), b.column("t").to_pylist(), strict=True):
                if k not in seen:  # copies that follow one another closely are signed once
                    if len(seen) >= 2048:
                        seen.clear()
                    s = shingles(value)
                    seen[k] = (len(s), prefixes(s, trees, depth).view(np.int64) if len(s) else np.zeros(0, np.int64))
                size, key = seen[k]
                sizes.append(size)
                keys.append(key)
            ends = np.cumsum([0, *map(len, keys)]).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(keys) if keys else np.zeros(0, np.int64)))
            yield pa.RecordBatch.from_arrays([b.column("d"), b.column("k"), pa.array(sizes, pa.int64()), lists], names=["d", "k", "size", "keys"])

    x = F.coalesce(F.col(text).cast("string"), F.lit(""))
    rows = df.select(F.col(doc_id).cast("long").alias("d"), F.md5(x).alias("k"), x.alias("t"))
    signed = settle(rows.mapInArrow(sign, "d long, k string, size long, keys array<long>"), "signed")

    # different texts: copies, the row that stands for them, and the nodes they are in
    mine = F.struct(F.col("d").isNull(), "d")
    by_text = signed.where("size > 0").groupBy("k").agg(F.count(F.lit(1)).alias("n"), F.min(mine).alias("m"), F.first("keys").alias("keys"))
    texts = settle(by_text.select("k", "n", F.col("m.d").alias("d"), "keys"), "texts")
    nodes = texts.select("k", F.posexplode("keys").alias("tree", "node"))
    # nodes of the same members are verified once, in the first trie
    same = [F.bit_xor(F.xxhash64("k")).alias("x1"), F.bit_xor(F.xxhash64("k", F.lit(1))).alias("x2")]
    met = nodes.groupBy("tree", "node").agg(F.count(F.lit(1)).alias("m"), *same).where("m > 1")
    met = met.groupBy("m", "x1", "x2").agg(F.min(F.struct("tree", "node")).alias("f"))
    met = met.select("f.*", F.ceil(F.col("m") / chunk).cast("int").alias("chunks"))
    members = settle(nodes.join(met, ["tree", "node"]), "members")

    # the sets of the texts that meet another one, each made once
    wanted = members.select("k").distinct().join(texts.select("k", "d", "n", "keys"), "k")
    wanted = wanted.select(F.col("k").alias("_k"), F.col("d").alias("_d"), "n", "keys")
    found = rows.join(wanted, (F.col("k") == F.col("_k")) & F.col("d").eqNullSafe(F.col("_d")))

    def expand(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, 256):
                some = b.slice(at, 256)
                sets = [shingles(t).view(np.int64) for t in some.column("t").to_pylist()]
                ends = np.cumsum([0, *map(len, sets)]).astype(np.int32)
                column = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(sets)))
                yield pa.RecordBatch.from_arrays([*[some.column(c) for c in ("k", "n", "keys")], column], names=["k", "n", "keys", "shingles"])

    sets = found.select("k", "n", "keys", "t").mapInArrow(expand, "k string, n long, keys array<long>, shingles array<long>")
    sets = settle(sets.dropDuplicates(["k"]), "sets")

    # chunk i of a node meets itself and every later chunk
    mine = F.pmod(F.xxhash64("k", F.lit(2)), F.col("chunks")).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.col("chunks") - 1))
    groups = members.withColumn("i", mine).withColumn("j", other)
    groups = groups.select(
        "k", "tree", "node", F.least("i", "j").alias("a"), F.greatest("i", "j").alias("b"), (F.col("i") > F.col("j")).cast("int").alias("side")
    )
    placed = groups.join(sets, "k")
    placed = placed.repartition("tree", "node", "a", "b").sortWithinPartitions("tree", "node", "a", "b")

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["k", "links", "documents", "root"]
        kinds = [pa.string(), pa.int64(), pa.int64(), pa.string()]
        group, held, out = None, [], []

        def close() -> list[tuple]:
            if len(held) < 2:
                return []
            ids, copies, keys, sets_, sides = zip(*held, strict=True)
            return _verify(list(ids), np.array(copies), list(sets_), np.stack(keys), np.array(sides), group[0], threshold)

        for b in batches:
            where = zip(*[b.column(c).to_pylist() for c in ("tree", "node", "a", "b")], strict=True)
            lists = {c: (b.column(c).offsets.to_numpy(), b.column(c).values.to_numpy()) for c in ("keys", "shingles")}
            ids, copies, sides = (b.column(c).to_pylist() for c in ("k", "n", "side"))
            for r, now in enumerate(where):
                if now != group:
                    out += close()
                    group, held = now, []
                    if len(out) >= 10_000:
                        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), kinds)], names=names)
                        out = []
                own = [v[o[r] : o[r + 1]].copy() for o, v in (lists["keys"], lists["shingles"])]
                held.append((ids[r], copies[r], own[0], own[1].view(_U), sides[r]))
        out += close()
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), kinds)], names=names)

    linked = settle(placed.mapInArrow(verify, "k string, links long, documents long, root string"), "linked")
    counts = linked.groupBy("k").agg(F.sum("links").alias("links"), F.sum("documents").alias("documents"))
    roots = components(linked, "k", "root")

    # by text: what its documents get
    marks = texts.select("k", "n", "d").join(counts, "k", "left").where("n > 1 or links is not null")
    marks = marks.join(roots.withColumnRenamed("node", "k"), "k", "left").withColumn("class_key", F.coalesce("root", "k"))
    first = F.min(F.struct(F.col("d").isNull(), "d", "k"))
    heads = marks.groupBy("class_key").agg(first.alias("h"))
    marks = marks.join(heads.select("class_key", F.col("h.d").alias("class_id"), F.col("h.k").alias("head")), "class_key")
    marks = settle(
        marks.select(
            "k", "n", "class_id", "class_key", "head",
            (F.coalesce("documents", F.lit(0)) + F.col("n") - 1).alias("n_links"), F.coalesce("links", F.lit(0)).alias("n_text_links"),
        ),
        "marks",
    )
    # a text of very many copies is answered by a broadcast whose size is bounded
    out = attach(signed.select("d", "k", "size"), marks, "k", "n", F.xxhash64("d"))
    own = F.col("class_key").isNull()
    return out.select(
        F.col("d").alias(doc_id),
        "k",
        F.when(own, F.col("d")).otherwise(F.col("class_id")).alias("class_id"),
        F.when(own & (F.col("size") > 0), F.col("k")).otherwise(F.col("class_key")).alias("class_key"),
        F.when(own, F.lit(True)).otherwise((F.col("head") == F.col("k")) & F.col("d").eqNullSafe(F.col("class_id"))).alias("first"),
        F.coalesce("n_links", F.lit(0)).alias("n_links"),
        F.coalesce("n_text_links", F.lit(0)).alias("n_text_links"),
    )


def keep_first(df: DataFrame, doc_id: str = "doc_id", text: str = "text", **how) -> DataFrame:
    """One row of every class, and all rows without words; columns as they are, whatever their names.

    NULL texts have no words. Of equal rows in the first place of a class one stays; NULL ids
    come after all others.
    """
    return carried(df, [doc_id, text], lambda rows: _keep_first(rows, doc_id, text, **how))


def _keep_first(df: DataFrame, doc_id: str, text: str, **how) -> DataFrame:
    found = classes(df, doc_id, text, **how)
    rule = found.groupBy(F.col(doc_id).alias("_d"), F.col("k").alias("_k")).agg(
        F.first("first").alias("_first"), (F.count(F.lit(1)) > F.when(F.first("class_key").isNull(), F.lit(1 << 62)).otherwise(1)).alias("_again")
    )
    k = F.md5(F.coalesce(F.col(text).cast("string"), F.lit("")))
    kept = df.withColumn("_key", k).join(rule.where("_first"), (F.col("_key") == F.col("_k")) & F.col(doc_id).cast("long").eqNullSafe(F.col("_d")))
    again = kept.where("_again").dropDuplicates(["_d", "_k"])
    return kept.where("not _again").unionByName(again).select(*df.columns)
