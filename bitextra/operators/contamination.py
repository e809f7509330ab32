"""Contamination between splits: rows of a target that also occur, or nearly, in a source."""

from __future__ import annotations

import hashlib
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import ArrayType, LongType

from ..functions import text as X
from ..functions.hashing import digest, joined_digest
from . import near as N
from .lookup import HOT_ROWS, attach, ensure_checkpoint_dir

_PRIME = 2_147_483_647
# Hex digits of md5 that number a word and give each permutation's coefficients. Only words of the two
# texts that are compared can be mistaken for each other, however large the vocabulary: with n different
# words n * n / 2^29 of them on average, so the similarity is off by less than n / 2^28 (10^-4 at 25,000 words).
PERMUTATION_DIGITS = 7


def band_shape(threshold: float, num_perm: int) -> tuple[int, int]:
    """(bands, rows) with the least sum of false positive and false negative probability."""
    steps = 1000

    def area(f, lo: float, hi: float) -> float:
        h = (hi - lo) / steps
        return sum(f(lo + (i + 0.5) * h) for i in range(steps)) * h

    best, shape = float("inf"), (1, 1)
    for b in range(1, num_perm + 1):
        for r in range(1, num_perm // b + 1):
            fp = area(lambda s: 1 - (1 - s**r) ** b, 0.0, threshold)
            if fp >= best:
                continue
            error = fp + area(lambda s: (1 - s**r) ** b, threshold, 1.0)
            if error < best:
                best, shape = error, (b, r)
    return shape


KNOWN_SHAPES = {(0.9, 128): (5, 25)}


def _shape(threshold: float, num_perm: int) -> tuple[int, int]:
    at = (threshold, num_perm)
    if at not in KNOWN_SHAPES:
        KNOWN_SHAPES[at] = band_shape(threshold, num_perm)
    return KNOWN_SHAPES[at]


def coefficients(n: int) -> list[tuple[int, int]]:
    """(a, b) of the n hash permutations h -> (a*h + b) mod p."""
    def part(kind: str, i: int) -> int:
        return int(hashlib.md5(f"{kind}{i}".encode()).hexdigest()[:PERMUTATION_DIGITS], 16)

    return [(part("a", i) + 1, part("b", i)) for i in range(n)]


def _columns(columns: list[str]) -> Column:
    return F.concat_ws(" ", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns])


def _signer(n: int, chunk: int = 1 << 14):
    """Arrow function: the words of a text to the n minima of their permuted hashes; none without words.

    Each distinct word of a batch is hashed once. Texts are then signed in groups of about
    `chunk` words, whose arrays stay in the processor cache. The prime is 2^31 - 1: the
    remainder is a shift, an addition and the lesser of x and x - p as unsigned numbers.
    """
    pairs = [(np.uint64(a), np.uint64(b)) for a, b in coefficients(n)]
    prime, bits = np.uint64(_PRIME), np.uint64(31)

    def word_number(word: str) -> int:
        return int(hashlib.md5(word.encode()).hexdigest()[:PERMUTATION_DIGITS], 16)

    def sign(hashes: np.ndarray, starts: np.ndarray, out: np.ndarray) -> None:
        x, y = np.empty_like(hashes), np.empty_like(hashes)
        for i, (a, b) in enumerate(pairs):
            np.multiply(hashes, a, out=x)
            np.add(x, b, out=x)
            np.bitwise_and(x, prime, out=y)
            np.right_shift(x, bits, out=x)
            np.add(x, y, out=x)
            np.subtract(x, prime, out=y)
            np.minimum(x, y, out=x)
            out[:, i] = np.minimum.reduceat(x, starts)

    @F.arrow_udf(ArrayType(LongType()))
    def minima(words: pa.Array) -> pa.Array:
        coded = words.flatten().dictionary_encode()
        numbers = np.fromiter(map(word_number, coded.dictionary.to_pylist()), dtype=np.uint64, count=len(coded.dictionary))
        hashes = numbers[coded.indices.to_numpy()]
        sizes = pc.list_value_length(words).to_numpy()
        signed = sizes > 0
        ends = np.cumsum(sizes[signed])
        starts = ends - sizes[signed]
        out = np.empty((len(ends), n), dtype=np.uint64)
        lo = 0
        while lo < len(ends):
            hi = max(lo + 1, int(np.searchsorted(ends, starts[lo] + chunk, side="right")))
            sign(hashes[starts[lo] : ends[hi - 1]], starts[lo:hi] - starts[lo], out[lo:hi])
            lo = hi
        offsets = np.concatenate([[0], np.cumsum(signed * n)]).astype(np.int32)
        return pa.ListArray.from_arrays(pa.array(offsets), pa.array(out.ravel().astype(np.int64)))

    return minima


def _bands(signable: DataFrame, keep: list[str], threshold: float, num_perm: int) -> DataFrame:
    """`keep` and the array `_bands` of rows with words `_w`."""
    b, r = _shape(threshold, num_perm)
    signed = signable.select(*keep, _signer(b * r)(F.col("_w")).alias("_s"))
    return signed.select(*keep, _band_keys("_s", b, r).alias("_bands"))


def _band_keys(signature: str, b: int, r: int) -> Column:
    bands = [
        F.concat(F.lit(f"{j}:"), F.md5(F.concat_ws(",", F.slice(signature, j * r + 1, r).cast("array<string>"))))
        for j in range(b)
    ]
    return F.when(F.size(signature) > 0, F.array(*bands)).otherwise(F.array().cast("array<string>"))


def exact_keys(source: DataFrame, target: DataFrame, columns: list[str]) -> DataFrame:
    """(digest, rows of target): target contents that also occur in the source."""
    key = joined_digest(*[F.col(c) for c in columns])
    counted = target.groupBy(key.alias("_exact")).agg(F.count(F.lit(1)).alias("_exact_rows"))
    return counted.join(source.select(key.alias("_exact")).distinct(), "_exact", "left_semi")


def near_texts(source: DataFrame, target: DataFrame, columns: list[str], near: dict) -> DataFrame:
    """(digest): target contents with a near duplicate in the source, by fingerprints or by verified sets of words."""
    algorithm = near.get("algorithm", "minhash")
    if algorithm == "simhash":
        params = near.get("simhash_params", {})
        found = N.simhash_partners(
            source, target, columns, _columns(columns), int(params.get("distance", 3)), int(params.get("blocks", 6))
        )
        return found.withColumnRenamed("_text", "_near")
    params = near.get("minhash_params", {})
    threshold, num_perm = float(params.get("threshold", 0.9)), int(params.get("num_perm", 128))
    bands = lambda sets, keep: _bands(sets, keep, threshold, num_perm)
    found = N.verified_partners(source, target, columns, _columns(columns), bands, threshold)
    return found.withColumnRenamed("_text", "_near")


def near_keys(source: DataFrame, target: DataFrame, columns: list[str], near: dict) -> tuple[Column, DataFrame]:
    """The key of a target row, and (key, rows of target) of the contents with a near duplicate in the source."""
    if near.get("algorithm") == "embeddings":
        params = near.get("embedding_params", {})
        vector = params.get("column", "embedding")
        key = N.vector_digest(vector)
        found = N.vector_partners(
            source, target, vector, float(params.get("threshold", 0.95)), int(params.get("bits", 12)), float(params.get("recall", 0.999))
        ).withColumnRenamed("_text", "_near")
    else:
        key = digest(*[F.col(c) for c in columns])
        found = near_texts(source, target, columns, near)
    counted = target.groupBy(key.alias("_near")).agg(F.count(F.lit(1)).alias("_near_rows"))
    return key, counted.join(found, "_near", "left_semi")


ALGORITHMS = ("minhash", "simhash", "embeddings")


def _methods(methods: dict | None) -> tuple[dict, dict]:
    exact, near = (methods or {}).get("exact_match", {}), (methods or {}).get("near_duplicate", {})
    if near.get("algorithm", "minhash") not in ALGORITHMS:
        raise ValueError(f"unknown near-duplicate algorithm '{near['algorithm']}'; available: {ALGORITHMS}")
    return exact, near


def settles_by_bands(methods: dict | None) -> bool:
    """Whether shared MinHash bands alone decide what is near, so that contents can be signed beforehand."""
    _, near = _methods(methods)
    return near.get("algorithm", "minhash") == "minhash" and not near.get("minhash_params", {}).get("verify", False)


def _settled(small: DataFrame) -> DataFrame:
    ensure_checkpoint_dir(small.sparkSession)
    return small.checkpoint()


def _content(methods: dict | None) -> tuple[Column, Column]:
    """What makes rows equal for the exact and for the near comparison; '' where one is switched off."""
    exact, near = _methods(methods)
    key = lambda part, of: of(*[F.col(c) for c in part.get("columns", ["en", "ka"])]) if part.get("enabled", True) else F.lit("")
    return key(exact, joined_digest), key(near, digest)


def signed_contents(tables: list[DataFrame], methods: dict | None = None, cut_lineage: bool = True) -> DataFrame:
    """(_exact, _near, _bands, _n0, _n1, ...): every different content of all tables, its MinHash bands and its rows in each.

    One pass over the tables and one shuffle of different texts; each is signed once, however many tables hold it.
    """
    _, near = _methods(methods)
    exact_key, near_key = _content(methods)
    signing = near.get("enabled", True)
    text = _columns(near.get("columns", ["en", "ka"])) if signing else F.lit("")
    parts = [
        t.select(exact_key.alias("_exact"), near_key.alias("_near"), text.alias("_t"), F.lit(i).alias("_table")) for i, t in enumerate(tables)
    ]
    counts = [F.count_if(F.col("_table") == i).alias(f"_n{i}") for i in range(len(tables))]
    found = reduce(DataFrame.unionByName, parts).groupBy("_exact", "_near").agg(*counts, F.first("_t").alias("_t"))
    params = near.get("minhash_params", {})
    b, r = _shape(float(params.get("threshold", 0.9)), int(params.get("num_perm", 128)))
    signature = _signer(b * r)(X.words(F.col("_t"))) if signing else F.array().cast("array<bigint>")
    found = found.withColumn("_s", signature).select("_exact", "_near", _band_keys("_s", b, r).alias("_bands"), *[f"_n{i}" for i in range(len(tables))])
    return _settled(found) if cut_lineage else found


def contaminated_contents(
    contents: DataFrame, source: Column, target: Column, methods: dict | None = None, hot_rows: int = HOT_ROWS, cut_lineage: bool = True
) -> DataFrame:
    """(_content, is_exact, is_near, _rows): contents with `target` rows that also occur, or nearly, where `source` counts rows."""
    exact, near = _methods(methods)
    compared = []
    if exact.get("enabled", True):
        compared.append(F.array(F.concat(F.lit("="), F.col("_exact"))))
    if near.get("enabled", True):
        compared.append(F.col("_bands"))
    key = F.explode(F.concat(*compared) if compared else F.array().cast("array<string>"))
    keys = contents.select(F.concat("_exact", "_near").alias("_content"), (source > 0).alias("_theirs"), target.alias("_rows"), key.alias("_key"))
    ours = F.count_if(F.col("_rows") > 0)
    hits = keys.groupBy("_key").agg(F.max("_theirs").alias("_met"), ours.alias("_times")).where("_met AND _times > 0").drop("_met")
    met = attach(keys.where(F.col("_rows") > 0).drop("_theirs"), hits, "_key", "_times", F.col("_content"), hot_rows)
    is_exact = F.col("_key").startswith("=")
    bad = (
        met.where(F.col("_times").isNotNull())
        .groupBy("_content")
        .agg(F.max(is_exact).alias("is_exact"), F.max(~is_exact).alias("is_near"), F.max("_rows").alias("_rows"))
    )
    return _settled(bad) if cut_lineage else bad


def without_contents(rows: DataFrame, bad: DataFrame, methods: dict | None, key: str = "id", hot_rows: int = HOT_ROWS) -> DataFrame:
    """Rows whose content is not among `bad`, by one join."""
    joined = attach(rows.withColumn("_content", F.concat(*_content(methods))), bad.select("_content", "_rows"), "_content", "_rows", F.col(key), hot_rows)
    return joined.where(F.col("_rows").isNull()).select(*rows.columns)


def with_flags(rows: DataFrame, bad: DataFrame, methods: dict | None, key: str = "id", hot_rows: int = HOT_ROWS) -> DataFrame:
    """Rows with `is_exact` and `is_near` of their content, by one join."""
    content = rows.withColumn("_content", F.concat(*_content(methods)))
    joined = attach(content, bad, "_content", "_rows", F.col(key), hot_rows)
    flags = [F.coalesce(c, F.lit(False)).alias(c) for c in ("is_exact", "is_near")]
    return joined.select(*rows.columns, *flags)


def flag_contamination(
    source: DataFrame,
    target: DataFrame,
    methods: dict | None = None,
    key: str = "id",
    hot_rows: int = HOT_ROWS,
    cut_lineage: bool = True,
) -> DataFrame:
    """Target with BOOLEAN `is_exact` and `is_near`.

    Near duplicates are found by `algorithm`: `minhash` (`minhash_params`: threshold, num_perm,
    and verify to ask for the exact Jaccard similarity behind a shared band), `simhash`
    (`simhash_params`: distance, blocks) or `embeddings` (`embedding_params`: column, threshold,
    bits, recall). With `cut_lineage` the matching digests, few beside the rows, are written to the checkpoint folder once; whatever
    is done with the flagged rows then costs a scan and a join with them. Columns named is_exact and
    is_near are replaced.
    """
    exact, near = _methods(methods)
    target = target.drop("is_exact", "is_near")
    if settles_by_bands(methods):
        contents = signed_contents([source, target], methods, cut_lineage)
        bad = contaminated_contents(contents, F.col("_n0"), F.col("_n1"), methods, hot_rows, cut_lineage)
        return with_flags(target, bad, methods, key, hot_rows)
    flagged, columns = target, target.columns
    settle = _settled if cut_lineage else lambda keys: keys
    if exact.get("enabled", True):
        cols = exact.get("columns", ["en", "ka"])
        rows = flagged.withColumn("_exact", joined_digest(*[F.col(c) for c in cols]))
        keys = settle(exact_keys(source, target, cols))
        flagged = attach(rows, keys, "_exact", "_exact_rows", F.col(key), hot_rows)
        flagged = flagged.withColumn("is_exact", F.col("_exact_rows").isNotNull())
    else:
        flagged = flagged.withColumn("is_exact", F.lit(False))
    if near.get("enabled", True):
        content, keys = near_keys(source, target, near.get("columns", ["en", "ka"]), near)
        rows, keys = flagged.withColumn("_near", content), settle(keys)
        flagged = attach(rows, keys, "_near", "_near_rows", F.col(key), hot_rows)
        flagged = flagged.withColumn("is_near", F.col("_near_rows").isNotNull())
    else:
        flagged = flagged.withColumn("is_near", F.lit(False))
    return flagged.select(*columns, "is_exact", "is_near")


def divide_contaminated(flagged: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(clean, contaminated) rows without the flags."""
    bad = F.col("is_exact") | F.col("is_near")
    drop = ("is_exact", "is_near")
    return flagged.where(~bad).drop(*drop), flagged.where(bad).drop(*drop)


def content_stats(contents: DataFrame, source: Column, target: Column, bad: DataFrame, source_name: str, target_name: str) -> DataFrame:
    """The row of `contamination_stats`, from counts of contents."""
    names = ["source_size", "target_size", "exact_matches", "near_duplicates", "total_contaminated"]
    none = F.lit(0).cast("long")
    rows = lambda flag: F.when(flag, F.col("_rows")).otherwise(none)
    sizes = contents.select(*[c.cast("long").alias(n) for c, n in zip((source, target, none, none, none), names)])
    either = F.col("is_exact") | F.col("is_near")
    found = (none, none, rows(F.col("is_exact")), rows(F.col("is_near")), rows(either))
    hits = bad.select(*[c.cast("long").alias(n) for c, n in zip(found, names)])
    summed = sizes.unionByName(hits).agg(*[F.coalesce(F.sum(n), none).alias(n) for n in names])
    return _named(summed, source_name, target_name)


def _named(stats: DataFrame, source_name: str, target_name: str) -> DataFrame:
    rate = F.coalesce(F.try_divide(F.col("total_contaminated"), F.col("target_size")), F.lit(0.0))
    return stats.select(
        F.lit(source_name).alias("source_split"),
        F.lit(target_name).alias("target_split"),
        "*",
        rate.alias("rate"),
    )


def contamination_stats(source: DataFrame, flagged: DataFrame, source_name: str, target_name: str) -> DataFrame:
    """One row: sizes, matches by kind, contaminated rows and their share."""
    counts = source.select(F.lit("s").alias("side"), F.lit(False).alias("is_exact"), F.lit(False).alias("is_near"))
    counts = counts.unionByName(flagged.select(F.lit("t").alias("side"), "is_exact", "is_near"))
    is_target = F.col("side") == "t"
    stats = counts.agg(
        F.count_if(~is_target).alias("source_size"),
        F.count_if(is_target).alias("target_size"),
        F.count_if("is_exact").alias("exact_matches"),
        F.count_if("is_near").alias("near_duplicates"),
        F.count_if(F.col("is_exact") | F.col("is_near")).alias("total_contaminated"),
    )
    return _named(stats, source_name, target_name)


def contamination_report(stats: list[DataFrame]) -> DataFrame:
    """One line per checked pair, the rate as text such as '1.25%'."""
    together = reduce(DataFrame.unionByName, stats)
    return together.withColumn("contamination_rate", F.format_string("%.2f%%", F.col("rate") * 100)).drop("rate")


def contamination_table(report: DataFrame) -> DataFrame:
    """Clean and contaminated rows per checked pair, ready for a stacked chart."""
    return report.select(
        F.concat("source_split", F.lit("→"), "target_split").alias("check"),
        (F.col("target_size") - F.col("total_contaminated")).alias("clean"),
        F.col("total_contaminated").alias("contaminated"),
    )
