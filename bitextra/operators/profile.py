"""Corpus profile: every function gives a small table computed from the whole corpus."""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions import text as X
from ..functions.arrays import ngrams
from ..functions.hashing import digest
from .lookup import settled, small_batches
from .pieces import PIECE, Spans, pieces, raw

LANGS = ("ka", "en")


def _long(df: DataFrame, *keep: str) -> DataFrame:
    """(lang, text): both sides of every row under each other."""
    sides = F.array(*[F.struct(F.lit(c).alias("lang"), F.col(c).alias("text")) for c in LANGS])
    return df.select(*keep, F.inline(sides)).where(F.col("text").isNotNull())


def _top(counts: DataFrame, k: int, by: list[str], item: str) -> DataFrame:
    """The k most frequent items per group; equal counts in item order."""
    w = Window.partitionBy(*by).orderBy(F.desc("count"), F.asc(item))
    return counts.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def most_frequent(counts: DataFrame, size: int, item: str, n: str) -> DataFrame:
    """The `size` most frequent items, equal counts in item order, for sizes in the thousands.

    How many items have each count tells which counts can be among the first `size`; there
    are at most `size` of them. All other items go before the sort, so that its last, single
    task receives little more than the result.
    """
    above = Window.orderBy(F.desc(n)).rowsBetween(Window.unboundedPreceding, -1)
    levels = counts.groupBy(n).agg(F.count(F.lit(1)).alias("_items"))
    levels = levels.withColumn("_before", F.coalesce(F.sum("_items").over(above), F.lit(0)))
    kept = counts.join(F.broadcast(levels.where(F.col("_before") < size).select(n)), n)
    return kept.orderBy(F.desc(n), F.asc(item)).limit(size)


def basic_stats(df: DataFrame) -> DataFrame:
    return df.agg(
        F.count(F.lit(1)).alias("total_samples"),
        F.count_distinct("domain").alias("unique_domains"),
        F.count_distinct("dataset").alias("unique_datasets"),
        F.count_if(F.col("title").isNull()).alias("missing_titles"),
        F.count_if(F.col("ka") == "").alias("empty_georgian"),
        F.count_if(F.col("en") == "").alias("empty_english"),
    )


def with_lengths(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {
            **{f"{c}_char_count": F.length(c) for c in LANGS},
            **{f"{c}_word_count": F.size(X.space_tokens(F.col(c))) for c in LANGS},
        }
    )


def length_stats(df: DataFrame) -> DataFrame:
    """(measure, mean, median, std, min, max) for characters and words of both sides."""
    names = [f"{c}_{m}" for c in LANGS for m in ("char_count", "word_count")]
    stats = {"mean": F.avg, "median": F.median, "std": F.stddev_samp, "min": F.min, "max": F.max}
    one = with_lengths(df).agg(*[fn(n).cast("double").alias(f"{n}_{s}") for n in names for s, fn in stats.items()])
    rows = F.array(
        *[F.struct(F.lit(n).alias("measure"), *[F.col(f"{n}_{s}").alias(s) for s in stats]) for n in names]
    )
    return one.select(F.inline(rows))


def with_ratios(df: DataFrame) -> DataFrame:
    tiny = F.lit(1e-6)
    return with_lengths(df).withColumns(
        {f"{m}_ratio": F.col(f"ka_{m}_count") / (F.col(f"en_{m}_count") + tiny) for m in ("char", "word")}
    )


def histogram(df: DataFrame, value: str, bins: int = 50) -> DataFrame:
    """(bin, low, high, count) of equal-width bins; the last one includes the maximum."""
    v = F.col(value).cast("double")
    ends = df.agg(F.min(v).alias("lo"), F.max(v).alias("hi")).first()  # two numbers
    lo, hi = ends["lo"], ends["hi"]
    if lo is None:
        lo = hi = 0.0
    if lo == hi:  # a single value sits in the middle of a bin of width 1/bins
        lo, hi = lo - 0.5, hi + 0.5
    width = (hi - lo) / bins
    at = F.least(F.floor((v - F.lit(lo)) / F.lit(width)), F.lit(bins - 1)).cast("int")
    counts = df.where(v.isNotNull()).groupBy(at.alias("bin")).agg(F.count(F.lit(1)).alias("count"))
    return counts.select(
        "bin",
        (F.lit(lo) + F.col("bin") * F.lit(width)).alias("low"),
        (F.lit(lo) + (F.col("bin") + 1) * F.lit(width)).alias("high"),
        "count",
    )


# --- characters, words, n-grams ---------------------------------------------------------


def char_counts(df: DataFrame) -> DataFrame:
    """(lang, char, count): a task counts in an array over all code points."""

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = np.zeros((len(LANGS), sys.maxunicode + 1), np.int64)
        for batch in batches:
            for part in pieces(batch.column(1), PIECE):
                lang, text = (c[part] for c in batch.columns)
                for number, name in enumerate(LANGS):
                    data, _ = raw(text.filter(pc.equal(lang, name)))
                    points = np.frombuffer(data.tobytes().decode("utf-8", "replace").encode("utf-32-le"), np.uint32)
                    counts = np.bincount(points)
                    totals[number, : len(counts)] += counts
        number, point = np.nonzero(totals)
        columns = [pa.array([LANGS[i] for i in number], pa.string()), pa.array([chr(x) for x in point], pa.string()), pa.array(totals[number, point])]
        yield pa.RecordBatch.from_arrays(columns, names=["lang", "char", "count"])

    parts = _long(df).mapInArrow(partial, "lang string, char string, count long")
    return parts.groupBy("lang", "char").agg(F.sum("count").alias("count"))


def word_counts(df: DataFrame, *by: str) -> DataFrame:
    tokens = _long(df, *by).select(*by, "lang", F.explode(X.space_tokens(F.col("text"))).alias("word"))
    return tokens.groupBy(*by, "lang", "word").count()


def ngram_counts(df: DataFrame, n: int) -> DataFrame:
    grams = _long(df).select("lang", F.explode(ngrams(X.space_tokens(F.col("text")), n)).alias("ngram"))
    return grams.groupBy("lang", "ngram").count()


#: Places of the hashes of n-grams: 2^20 sums for each language and length. Places whose n-grams are counted at once.
BITS, PLACES, BLOCK = 20, 4096, 1 << 16


def _spans(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, Spans]]:
    """(number of each row's language, n-grams) of batches (lang, text), some rows after the other."""
    for batch in batches:
        for part in pieces(batch.column(1), PIECE):
            lang, text = (c[part] for c in batch.columns)
            number = np.array([LANGS.index(x) for x in lang.to_pylist()], np.int64)
            yield number, Spans(text)


def _place_sums(texts: DataFrame, orders: list[int]) -> np.ndarray:
    """orders x languages x 2^BITS: how many n-grams have each place; 8 MB for each order and language come to the driver."""
    size = len(LANGS) * len(orders) << BITS

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros(size, np.int64)
        for lang, spans in _spans(batches):
            for o, n in enumerate(orders):
                row, starts, ends = spans.of(n)
                np.add.at(sums, (o * len(LANGS) + lang[row] << BITS) + spans.places(starts, ends, BITS), 1)
        for lo in range(0, size, BLOCK):
            some = sums[lo : lo + BLOCK]
            if some.any():
                yield pa.RecordBatch.from_arrays([pa.array([lo], pa.int64()), pa.array([some.tobytes()])], names=["lo", "sums"])

    def added(table: pa.Table) -> pa.Table:
        total = np.zeros(BLOCK, np.int64)
        for some in table.column("sums"):
            total += np.frombuffer(some.as_buffer(), np.int64)
        return pa.table({"lo": table.column("lo").slice(0, 1), "sums": pa.array([total.tobytes()])})

    tasks = texts.coalesce(2 * texts.sparkSession.sparkContext.defaultParallelism)
    found = tasks.mapInArrow(partial, "lo long, sums binary").groupBy("lo").applyInArrow(added, "lo long, sums binary").toArrow()
    out = np.zeros(size, np.int64)
    for lo, some in zip(found.column("lo").to_pylist(), found.column("sums")):
        out[lo : lo + BLOCK] = np.frombuffer(some.as_buffer(), np.int64)
    return out.reshape(len(orders), len(LANGS), -1)


def _counts_at(texts: DataFrame, orders: list[int], wanted: np.ndarray) -> DataFrame:
    """(n, lang, ngram, count) of all n-grams whose places are wanted (orders x languages x 2^BITS truth values)."""
    bits = np.packbits(wanted)

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = np.unpackbits(bits).astype(bool)
        for lang, spans in _spans(batches):
            for o, n in enumerate(orders):
                row, starts, ends = spans.of(n)
                held = np.flatnonzero(wanted[(o * len(LANGS) + lang[row] << BITS) + spans.places(starts, ends, BITS)])
                for number, name in enumerate(LANGS):
                    mine = held[lang[row[held]] == number]
                    coded = spans.texts(starts[mine], ends[mine]).dictionary_encode()
                    size = len(coded.dictionary)
                    count = np.bincount(coded.indices.to_numpy(), minlength=size)
                    columns = [pa.array([n] * size, pa.int32()), pa.array([name] * size, pa.string()), coded.dictionary.cast(pa.string()), pa.array(count)]
                    yield pa.RecordBatch.from_arrays(columns, names=["n", "lang", "ngram", "count"])

    parts = texts.mapInArrow(partial, "n int, lang string, ngram string, count long")
    return parts.groupBy("n", "lang", "ngram").agg(F.sum("count").alias("count"))


def frequent_ngrams(df: DataFrame, orders: list[int], k: int = 50) -> DataFrame:
    """(n, lang, ngram, count) in the checkpoint folder: exact counts of at least the k most frequent n-grams, all that tie included.

    Every n-gram of every text is counted by the place of its hash, all lengths in one pass; a place's sum
    bounds the counts of its n-grams from above. The n-grams of the PLACES largest places are then counted
    one by one. Where the k-th count is not above every place left out, that language and length is counted again, with
    all places that reach the k-th count (all places, if there are fewer than k n-grams so far). Only n-grams that are counted one by one are shuffled.
    """
    texts = _long(df).select("lang", X.strip(F.col("text")).alias("text"))
    with small_batches(df.sparkSession):
        sums = _place_sums(texts, orders)
        places = min(max(PLACES, k), sums.shape[2])
        bounds = np.partition(sums, -places, axis=2)[:, :, -places]  # a sum that so many places reach
        first = sums >= np.maximum(bounds, 1)[:, :, None]
        found = settled(_counts_at(texts, orders, first), "ngrams")
        last = {(r["n"], r["lang"]): r["count"] for r in _top(found, k, ["n", "lang"], "ngram").where(F.col("rank") == k).select("n", "lang", "count").collect()}
        again = np.zeros(first.shape, bool)
        for o, n in enumerate(orders):
            for i, lang in enumerate(LANGS):
                least = last.get((n, lang), 1)
                if (sums[o, i][~first[o, i]] >= least).any():
                    again[o, i] = sums[o, i] >= least
        if again.any():
            # places counted already are not counted twice
            more = _counts_at(texts, orders, again & ~first)
            found = found.unionByName(settled(more, "ngrams"))
    return found


def frequency_totals(counts: DataFrame) -> DataFrame:
    """(lang, distinct items, all occurrences)."""
    return counts.groupBy("lang").agg(
        F.count(F.lit(1)).alias("unique_items"), F.sum("count").cast("long").alias("total_items")
    )


def top_chars(df: DataFrame, k: int = 50) -> DataFrame:
    return _top(char_counts(df), k, ["lang"], "char")


def top_punctuation(df: DataFrame, k: int = 50) -> DataFrame:
    """Those of the top k characters that are neither letters, digits nor whitespace."""
    return top_chars(df, k).where(~F.col("char").rlike(r"[\p{L}\p{N}]") & (X.strip(F.col("char")) != ""))


# Functions of word counts take those of the table as `counts` where several of them share one table.
def top_words(df: DataFrame, k: int = 100, counts: DataFrame | None = None) -> DataFrame:
    return _top(word_counts(df) if counts is None else counts, k, ["lang"], "word")


def top_ngrams(df: DataFrame, n: int, k: int = 50, counts: DataFrame | None = None) -> DataFrame:
    """The k most frequent n-grams per language; `counts` are those of `frequent_ngrams`, if several lengths share them."""
    counts = frequent_ngrams(df, [n], k) if counts is None else counts
    return _top(counts.where(F.col("n") == n).drop("n"), k, ["lang"], "ngram")


def word_lengths(df: DataFrame, counts: DataFrame | None = None) -> DataFrame:
    return (
        (word_counts(df) if counts is None else counts)
        .groupBy("lang", F.length("word").alias("length"))
        .agg(F.sum("count").cast("long").alias("count"))
    )


def word_edges(df: DataFrame, k: int = 20, counts: DataFrame | None = None) -> DataFrame:
    """Most frequent first and last characters of words."""
    edges = F.array(
        F.struct(F.lit("beginning").alias("edge"), F.left("word", F.lit(1)).alias("char")),
        F.struct(F.lit("ending").alias("edge"), F.right("word", F.lit(1)).alias("char")),
    )
    edge_counts = (
        (word_counts(df) if counts is None else counts)
        .where(F.col("word") != "")
        .select("lang", "count", F.inline(edges))
        .groupBy("lang", "edge", "char")
        .agg(F.sum("count").cast("long").alias("count"))
    )
    return _top(edge_counts, k, ["lang", "edge"], "char")


NUMBER_PATTERNS = {
    "single_digits": r"\p{Nd}",
    "two_digits": r"\p{Nd}{2}",
    "three_digits": r"\p{Nd}{3}",
    "four_digits": r"\p{Nd}{4}",
    "long_numbers": r"\p{Nd}{4,}",
}


#: Matches of a pattern in a run of so many digits.
_IN_RUN = {
    "single_digits": lambda size: size,
    "two_digits": lambda size: F.call_function("div", size, F.lit(2)),
    "three_digits": lambda size: F.call_function("div", size, F.lit(3)),
    "four_digits": lambda size: F.call_function("div", size, F.lit(4)),
    "long_numbers": lambda size: (size >= 4).cast("long"),
}


def number_patterns(df: DataFrame) -> DataFrame:
    """How often each digit pattern occurs, matches not overlapping. Runs of digits are found once for all patterns."""
    runs = lambda c: F.coalesce(F.regexp_extract_all(F.col(c), F.lit(r"(\p{Nd}+)"), F.lit(1)), F.array().cast("array<string>"))
    sizes = df.select(F.explode_outer(F.transform(F.concat(*[runs(c) for c in LANGS]), F.length)).alias("size"))
    n = {name: F.coalesce(matches(F.col("size")), F.lit(0)) for name, matches in _IN_RUN.items()}
    one = sizes.agg(*[F.sum(n[name]).cast("long").alias(name) for name in NUMBER_PATTERNS])
    rows = F.array(*[F.struct(F.lit(x).alias("pattern"), F.col(x).alias("count")) for x in NUMBER_PATTERNS])
    return one.select(F.inline(rows))


def longest_words(df: DataFrame, n: int = 50, counts: DataFrame | None = None) -> DataFrame:
    """The n longest distinct words per language, longest and last in byte order first."""
    w = Window.partitionBy("lang").orderBy(F.desc("length"), F.desc("word"))
    counts = word_counts(df) if counts is None else counts
    words = counts.where(F.col("word") != "").select("lang", "word", F.length("word").alias("length"))
    return words.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= n)


def longest_word_stats(df: DataFrame, n: int = 50) -> DataFrame:
    top = longest_words(df, n)
    return top.groupBy("lang").agg(F.max("length").alias("longest"), F.avg("length").alias("avg_length"))


def zipf(df: DataFrame, n: int = 1000, counts: DataFrame | None = None) -> DataFrame:
    """Rank and frequency of the n most frequent words per language."""
    return top_words(df, n, counts).select("lang", "rank", "word", F.col("count").alias("frequency"))


def zipf_slope(df: DataFrame, n: int = 1000) -> DataFrame:
    ranked = zipf(df, n).select("lang", F.log("frequency").alias("_f"), F.log("rank").alias("_r"))
    return ranked.groupBy("lang").agg(F.regr_slope("_f", "_r").alias("slope"))


def word_cloud(df: DataFrame, k: int = 100) -> DataFrame:
    """Word weights per language: counts relative to the most frequent word."""
    top = top_words(df.select("ka", "en"), k)
    most = F.max("count").over(Window.partitionBy("lang"))
    return top.withColumn("weight", F.col("count") / most)


def domain_word_cloud(df: DataFrame, k: int = 50, domains: int = 6, order: str = "id") -> DataFrame:
    """Top words of the domains that come first in `order`."""
    first = df.groupBy("domain").agg(F.min(order).alias("_first")).orderBy("_first", "domain").limit(domains)
    chosen = df.join(F.broadcast(first.select("domain")), "domain")  # at most `domains` rows
    return _top(word_counts(chosen, "domain"), k, ["domain", "lang"], "word")


def sentences(c: Column) -> Column:
    """Cut behind '.', '!' and '?' followed by whitespace."""
    marked = F.regexp_replace(c, rf"([.!?]){X.K.WS}+", "$1\x01")
    return F.split(marked, "\x01")


def sentence_lengths(df: DataFrame) -> DataFrame:
    parts = _long(df).select("lang", F.explode(sentences(X.strip(F.col("text")))).alias("sentence"))
    return parts.select("lang", F.size(X.space_tokens(F.col("sentence"))).alias("words"))


def sentence_stats(df: DataFrame) -> DataFrame:
    return (
        sentence_lengths(df)
        .groupBy("lang")
        .agg(
            F.count(F.lit(1)).alias("sentences"),
            F.avg("words").alias("mean"),
            F.median("words").alias("median"),
            F.max("words").alias("max"),
        )
    )


# --- groups -----------------------------------------------------------------------------


def group_counts(df: DataFrame, by: str) -> DataFrame:
    return df.groupBy(by).count()


def group_summary(df: DataFrame, by: str) -> DataFrame:
    """Number of groups and the largest and smallest one (ties: first name)."""
    return group_counts(df, by).agg(
        F.count(F.lit(1)).alias("n_groups"),
        F.min(F.struct((-F.col("count")).alias("n"), F.col(by).alias("name")))["name"].alias("largest"),
        F.max("count").alias("largest_count"),
        F.min(F.struct(F.col("count").alias("n"), F.col(by).alias("name")))["name"].alias("smallest"),
        F.min("count").alias("smallest_count"),
    )


def distinct_values(df: DataFrame) -> DataFrame:
    """(kind, value): the domains, dataset names and languages present."""
    name = F.split_part(F.col("id"), F.lit("_"), F.lit(1))
    kinds = F.array(
        F.struct(F.lit("domain").alias("kind"), F.col("domain").alias("value")),
        F.struct(F.lit("dataset_name").alias("kind"), name.alias("value")),
        *[F.struct(F.lit("language").alias("kind"), F.lit(c).alias("value")) for c in LANGS],
    )
    found = df.select(F.inline(kinds)).distinct()
    return found.where((F.col("kind") != "dataset_name") | (F.col("value") != ""))


# --- quality ----------------------------------------------------------------------------

SHORT, LONG = 10, 1000


def quality_counts(df: DataFrame) -> DataFrame:
    """Nulls, blanks, duplicates and odd lengths in one row. Distinct counts work on digests."""
    ka, en, n = F.col("ka"), F.col("en"), F.count(F.lit(1))
    keyed = df.select(
        "title", "ka", "en", digest(ka, en).alias("_pair"), digest(ka).alias("_ka"), digest(en).alias("_en")
    )
    return keyed.agg(
        F.count_if(F.col("title").isNull()).alias("null_titles"),
        F.count_if(ka.isNull()).alias("null_georgian"),
        F.count_if(en.isNull()).alias("null_english"),
        F.count_if(ka == "").alias("empty_georgian"),
        F.count_if(en == "").alias("empty_english"),
        (n - F.count_distinct("_pair")).alias("duplicate_pairs"),
        (n - F.count_distinct("_ka")).alias("duplicate_georgian"),
        (n - F.count_distinct("_en")).alias("duplicate_english"),
        F.count_if(F.length(ka) < SHORT).alias("very_short_georgian"),
        F.count_if(F.length(en) < SHORT).alias("very_short_english"),
        F.count_if(F.length(ka) > LONG).alias("very_long_georgian"),
        F.count_if(F.length(en) > LONG).alias("very_long_english"),
    )


ISSUES = [
    ("Null Georgian texts", "null_georgian"),
    ("Null English texts", "null_english"),
    ("Empty Georgian texts", "empty_georgian"),
    ("Empty English texts", "empty_english"),
    ("Duplicate pairs", "duplicate_pairs"),
    ("Very short Georgian (<10 chars)", "very_short_georgian"),
    ("Very short English (<10 chars)", "very_short_english"),
    ("Very long Georgian (>1000 chars)", "very_long_georgian"),
    ("Very long English (>1000 chars)", "very_long_english"),
]


def quality_issues(df: DataFrame) -> DataFrame:
    rows = F.array(*[F.struct(F.lit(i).alias("issue"), F.col(c).alias("count")) for i, c in ISSUES])
    return quality_counts(df).select(F.inline(rows))


def language_purity(detected: DataFrame) -> DataFrame:
    """Share of texts in the expected language and mean confidence, per side.

    Input columns: side, expected, lang, confidence.
    """
    return detected.groupBy("side").agg(
        F.avg((F.col("lang") == F.col("expected")).cast("double")).alias("purity"),
        F.avg("confidence").alias("avg_confidence"),
    )


def top_languages(detected: DataFrame, k: int = 10) -> DataFrame:
    return _top(detected.groupBy("side", "lang").count(), k, ["side"], "lang")
