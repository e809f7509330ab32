"""Near duplicates between two tables by fingerprints, by vectors, or by verified word sets.

Each function gives the contents of a target (by digest) that have a partner in a source. Partners
meet in keys that they must share, and a left semi join with the exact condition keeps a content
at its first partner: no pair leaves a task. Equal contents are one before any of it.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from functools import lru_cache
from itertools import combinations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import ArrayType, DoubleType, LongType

from ..functions import text as X
from ..functions.hashing import digest
from .lookup import settled, shuffle_partitions

BITS = 64


def contents(df: DataFrame, columns: list[str], text: Column) -> DataFrame:
    """(_text, _w): digest and words of every different content that has words."""
    some = df.where(X.non_empty(text)).select(digest(*[F.col(c) for c in columns]).alias("_text"), text.alias("_t"))
    return some.groupBy("_text").agg(F.first("_t").alias("_t")).select("_text", X.words(F.col("_t")).alias("_w"))


# --- fingerprints of words -----------------------------------------------------------------


@F.arrow_udf(LongType())
def _simhash(words: pa.Array) -> pa.Array:
    """64 signed sums over the bits of the words' md5, a word as often as it occurs; bit j is set if sum j is positive."""
    coded = words.flatten().dictionary_encode()
    hashes = b"".join(hashlib.md5(w.encode()).digest()[:8] for w in coded.dictionary.to_pylist())
    signs = np.unpackbits(np.frombuffer(hashes, np.uint8).reshape(-1, 8), axis=1).astype(np.int8) * 2 - 1
    at, ends = coded.indices.to_numpy(), np.cumsum(pc.list_value_length(words).to_numpy())
    out = np.zeros(len(words), np.uint64)
    for i, (a, b) in enumerate(zip([0, *ends[:-1].tolist()], ends.tolist(), strict=True)):
        total = np.zeros(BITS, np.int64)
        # a long text in steps, so that the rows of signs stay small
        for lo in range(a, b, 1 << 14):
            total += signs[at[lo : min(b, lo + (1 << 14))]].sum(axis=0, dtype=np.int64)
        out[i] = np.packbits(total > 0).view(">u8")[0]
    return pa.array(out.view(np.int64))


def simhash(words: Column) -> Column:
    """64-bit fingerprint of a word array as a signed long; texts of like words differ in few bits."""
    return _simhash(words)


def hamming(a: Column, b: Column) -> Column:
    return F.bit_count(a.bitwiseXOR(b))


def block_masks(distance: int, blocks: int) -> list[int]:
    """Masks of all choices of `blocks - distance` blocks of the 64 bits: two fingerprints that
    differ in at most `distance` bits agree under one of them."""
    if not 0 <= distance < blocks <= BITS:
        raise ValueError("0 <= distance < blocks <= 64")
    edges = [BITS * i // blocks for i in range(blocks + 1)]
    parts = [(1 << edges[i + 1]) - (1 << edges[i]) for i in range(blocks)]
    masks = [sum(chosen) for chosen in combinations(parts, blocks - distance)]
    return [m - (1 << BITS) if m >> (BITS - 1) else m for m in masks]


def _fingerprint_keys(prints: DataFrame, masks: list[int]) -> DataFrame:
    keys = F.array(*[F.struct(F.lit(i).alias("_table"), F.col("_print").bitwiseAND(F.lit(m)).alias("_key")) for i, m in enumerate(masks)])
    return prints.select("*", F.inline(keys))


def simhash_partners(
    source: DataFrame, target: DataFrame, columns: list[str], text: Column, distance: int = 3, blocks: int = 6
) -> DataFrame:
    """(_text): contents of the target whose fingerprint differs in at most `distance` bits from one of the source.

    Complete for any `blocks`: more blocks mean longer keys, so fewer fingerprints under a key, and
    more keys (`blocks` over `distance`). Texts without words have no fingerprint and no partner.
    """
    masks = block_masks(distance, blocks)
    prints = lambda df: contents(df, columns, text).select("_text", simhash(F.col("_w")).alias("_print"))
    wanted = _fingerprint_keys(prints(source).select("_print").distinct(), masks)
    wanted = wanted.select(F.col("_print").alias("_other"), F.col("_table").alias("_t2"), F.col("_key").alias("_k2"))
    # contents with one fingerprint share its answer
    held = prints(target)
    asked = _fingerprint_keys(held.select("_print").distinct(), masks)
    meets = (F.col("_table") == F.col("_t2")) & (F.col("_key") == F.col("_k2")) & (hamming(F.col("_print"), F.col("_other")) <= distance)
    near = asked.join(wanted, meets, "left_semi").select("_print").distinct()
    return held.join(near, "_print", "left_semi").select("_text")


# --- vectors -------------------------------------------------------------------------------


def cosine(a: Column, b: Column) -> Column:
    """Inner product of two arrays of unit length."""
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)


def hyperplane_tables(threshold: float, bits: int, recall: float) -> int:
    """Tables of `bits`-bit codes in which two vectors at the threshold meet with probability `recall` or more."""
    if not 0 < threshold < 1 or not 0 < recall < 1:
        raise ValueError("threshold and recall lie between 0 and 1")
    agree = (1 - math.acos(threshold) / math.pi) ** bits
    return max(1, math.ceil(math.log(1 - recall) / math.log(1 - agree)))


@lru_cache(4)
def _hyperplanes(dims: int, count: int) -> np.ndarray:
    return np.random.default_rng([dims, count]).standard_normal((dims, count))


def _coder(tables: int, bits: int):
    weights = 1 << np.arange(bits, dtype=np.int64)

    @F.arrow_udf(ArrayType(LongType()))
    def codes(vectors: pa.Array) -> pa.Array:
        sizes = pc.list_value_length(vectors).to_numpy()
        ends = np.cumsum(sizes)
        flat = vectors.flatten().to_numpy()
        out = np.zeros((len(vectors), tables), np.int64)
        for dims in np.unique(sizes):
            at = np.flatnonzero(sizes == dims)
            rows = flat[(ends[at] - dims)[:, None] + np.arange(dims)]
            side = rows @ _hyperplanes(int(dims), tables * bits) > 0
            out[at] = side.reshape(len(at), tables, bits) @ weights
        offsets = pa.array(np.arange(0, tables * len(vectors) + 1, tables, dtype=np.int32))
        return pa.ListArray.from_arrays(offsets, pa.array(out.ravel()))

    return codes


def _directions(df: DataFrame, vector: str) -> DataFrame:
    """(_text, _v): digest of every different vector that has a direction, and its unit vector."""
    values = F.col(vector).cast("array<double>")
    finite = F.forall(values, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    some = df.where(F.coalesce(finite, F.lit(False))).select(vector_digest(vector).alias("_text"), values.alias("_v"))
    some = some.groupBy("_text").agg(F.first("_v").alias("_v"))
    # in one function: as Column expressions, the norm would be computed again for every entry
    return some.where(F.exists("_v", lambda x: x != 0)).select("_text", _units(F.col("_v")).alias("_v"))


@F.arrow_udf(ArrayType(DoubleType()))
def _units(vectors: pa.Array) -> pa.Array:
    """Unit vectors, scaled by the largest entry first, so that squares neither overflow nor vanish."""
    sizes = pc.list_value_length(vectors).to_numpy()
    ends = np.cumsum(sizes)
    flat = vectors.flatten().to_numpy()
    out = np.zeros(len(flat))
    for dims in np.unique(sizes):
        at = (ends[sizes == dims] - dims)[:, None] + np.arange(dims)
        scaled = flat[at] / np.abs(flat[at]).max(axis=1)[:, None]
        # summed in the order of the entries
        out[at] = scaled / np.sqrt(np.cumsum(scaled * scaled, axis=1)[:, -1:])
    return pa.ListArray.from_arrays(pa.array(np.append(0, ends).astype(np.int32)), pa.array(out))


def vector_digest(vector: str) -> Column:
    return F.md5(F.array_join(F.col(vector).cast("array<string>"), ",", "null"))


def vector_partners(
    source: DataFrame, target: DataFrame, vector: str, threshold: float = 0.95, bits: int = 12, recall: float = 0.999
) -> DataFrame:
    """(_text): target vectors (by `vector_digest`) with a cosine of `threshold` or more to a source vector.

    Vectors meet under equal codes of random hyperplanes and are verified exactly; a partner at the
    threshold is missed with probability 1 - `recall`, a closer one more rarely. `bits` should
    grow with the logarithm of the table. NULL vectors, NULL or non-finite entries and zero
    vectors have no partner, nor have vectors of different lengths.
    """
    tables = hyperplane_tables(threshold, bits, recall)
    codes = _coder(tables, bits)
    keyed = lambda df: _directions(df, vector).select("*", F.size("_v").alias("_size"), F.posexplode(codes(F.col("_v"))).alias("_table", "_key"))
    bucket = ["_size", "_table", "_key"]
    wanted, asked = keyed(source), keyed(target)
    # a bucket of many source vectors is cut into parts, all of which its target vectors meet;
    # there are at most vectors * tables / BUCKET such buckets
    large = wanted.groupBy(*bucket).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > BUCKET)
    large = F.broadcast(large.select(*bucket, F.ceil(F.col("_n") / BUCKET).cast("int").alias("_parts")))
    parts = F.coalesce(F.col("_parts"), F.lit(1))
    wanted = wanted.join(large, bucket, "left").withColumn("_part", F.pmod(F.xxhash64("_text"), parts).cast("int"))
    asked = asked.join(large, bucket, "left").withColumn("_part", F.explode(F.sequence(F.lit(0), parts - 1)))
    sides = [df.select(*bucket, "_part", F.lit(side).alias("_side"), "_text", "_v") for side, df in enumerate((wanted, asked))]
    together = sides[0].unionByName(sides[1])
    # a numbered exchange keeps its partitions: rows are few, their work is not
    count = max(source.sparkSession.sparkContext.defaultParallelism, shuffle_partitions(source))
    place = [*bucket, "_part", "_side"]
    sorted_rows = together.repartition(count, *bucket, "_part").sortWithinPartitions(*place)
    return sorted_rows.mapInArrow(_matcher(threshold), "_text string").distinct()


#: Source vectors of a bucket that a task holds at once, and vectors compared with them in one product.
BUCKET, ASKED = 16_384, 1_024
#: Inner products this near the threshold are summed again in the order of `cosine`.
CLOSE = 1e-9


def _matcher(threshold: float):
    """Rows sorted by bucket, source vectors first, to the `_text` of target vectors near one of them.

    Source vectors of one bucket are held as a matrix; target vectors are multiplied with it as they come.
    """

    def near(asked: np.ndarray, held: np.ndarray) -> np.ndarray:
        best = np.zeros(len(asked), bool)
        for lo in range(0, len(asked), ASKED):
            product = asked[lo : lo + ASKED] @ held.T
            best[lo : lo + ASKED] = (product >= threshold + CLOSE).any(axis=1)
            for i, j in np.argwhere(np.abs(product - threshold) < CLOSE):
                if not best[lo + i]:
                    best[lo + i] = np.cumsum(asked[lo + i] * held[j])[-1] >= threshold
        return best

    def match(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bucket, parts, held = None, [], None
        for b in batches:
            if not b.num_rows:
                continue
            keys = np.stack([b.column(c).to_numpy().astype(np.int64) for c in ("_size", "_table", "_key", "_part", "_side")], axis=1)
            edges = np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1
            vectors, texts, hits = b.column("_v"), b.column("_text"), []
            for lo, hi in zip([0, *edges.tolist()], [*edges.tolist(), b.num_rows], strict=True):
                *at, side = keys[lo].tolist()
                if at != bucket:
                    bucket, parts, held = at, [], None
                if side and not parts:
                    continue
                rows = vectors.slice(lo, hi - lo).flatten().to_numpy().reshape(hi - lo, at[0])
                if not side:
                    # copied, so that no batch stays whole behind its few rows
                    parts.append(rows.copy())
                    continue
                held = np.concatenate(parts) if held is None else held
                hits.append(lo + np.flatnonzero(near(rows, held)))
            if hits:
                found = pa.array(np.concatenate(hits))
                yield pa.RecordBatch.from_arrays([pc.unique(texts.take(found))], names=["_text"])

    return match


# --- verified word sets --------------------------------------------------------------------


def word_set(words: Column) -> Column:
    """Different words as sorted 64-bit hashes."""
    return F.sort_array(F.array_distinct(F.transform(words, lambda w: F.xxhash64(w))))


def jaccard(a: Column, b: Column) -> Column:
    common = F.size(F.array_intersect(a, b))
    return common / (F.size(a) + F.size(b) - common)


def verified_partners(source: DataFrame, target: DataFrame, columns: list[str], text: Column, bands, threshold: float) -> DataFrame:
    """(_text): contents of the target that share a band with a source content of Jaccard similarity `threshold` or more.

    `bands` takes a table with words `_w` and the columns to keep, and adds `_bands`, the keys of each row.
    Contents with the same words are one set, which stands for all of them; only sets with a band
    on both sides travel with their words.
    """
    one_of = [df.select(*dict.fromkeys(columns), text.alias("_t"), F.lit(i).alias("_side")) for i, df in enumerate((source, target))]
    both = one_of[0].unionByName(one_of[1]).where(X.non_empty(F.col("_t")))
    both = both.select(digest(*[F.col(c) for c in columns]).alias("_text"), "_t", "_side")
    flags = lambda: [F.max(F.col("_side") == i).alias(f"_in{i}") for i in (0, 1)]
    once = both.groupBy("_text").agg(F.first("_t").alias("_t"), *flags()).withColumn("_w", X.words(F.col("_t"))).drop("_t")
    once = once.withColumn("_set", word_set(F.col("_w")))
    # the digest of a set is its representative; each content is cut into words and signed once
    name = F.md5(F.array_join(F.col("_set").cast("array<string>"), ","))
    signed = bands(once.withColumn("_id", name), ["_text", "_in0", "_in1", "_id", "_set"])
    signed = settled(signed, "word-sets")
    asked_by = signed.where("_in1").select("_text", "_id")
    keys = signed.select("_id", "_in0", "_in1", F.explode("_bands").alias("_band"))
    keys = keys.groupBy("_id", "_band").agg(F.max("_in0").alias("_in0"), F.max("_in1").alias("_in1"))
    # a set that both sides hold is its own partner; others are candidates where a band is on both sides
    own = keys.where(F.col("_in0") & F.col("_in1") & F.lit(threshold <= 1)).select("_id")
    open_keys = keys.where(~(F.col("_in0") & F.col("_in1") & F.lit(threshold <= 1)))
    asked = open_keys.where("_in1").join(keys.where("_in0").select("_band").distinct(), "_band", "left_semi")
    wanted = keys.where("_in0").join(open_keys.where("_in1").select("_band").distinct(), "_band", "left_semi")
    sets = lambda ids: signed.join(ids.select("_id").distinct(), "_id", "left_semi").groupBy("_id").agg(F.first("_set").alias("_set"))
    left = asked.select("_id", "_band").join(sets(asked), "_id")
    right = wanted.select("_id", F.col("_band").alias("_b2")).join(sets(wanted), "_id").select("_b2", F.col("_set").alias("_other"))
    near = left.join(right, (F.col("_band") == F.col("_b2")) & (jaccard(F.col("_set"), F.col("_other")) >= threshold), "left_semi")
    found = own.unionByName(near.select("_id")).distinct()
    return asked_by.join(found, "_id", "left_semi").select("_text")
