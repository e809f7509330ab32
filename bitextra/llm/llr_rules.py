"""Quality rules: counts of a text, and the likelihood ratio of its hashed n-grams.

Main path: DataFrame and SQL functions only.

Words and word pairs are hashed into `buckets`. Two multinomials over the buckets are counted
over whole tables: one of the trusted documents (labelled of good quality), one of all
documents. A document's score is the mean over its n-grams of the log of their ratio; it fails
below `threshold`, a fixed number.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from .common import WORD, carried

BLANKS = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"


def let(value: Column, then: Callable[[Column], Column]) -> Column:
    """`then` over a value that is computed once, also where a lambda reads it for every element."""
    return F.get(F.transform(F.array(value), then), F.lit(0))


def word_hashes(text: Column) -> Column:
    return F.transform(F.regexp_extract_all(text, F.lit(WORD), F.lit(0)), lambda w: F.xxhash64(w))


def n_grams(hashes: Column, buckets: int) -> Column:
    """Buckets of words and of pairs of neighbours."""
    bucket = lambda *h: F.pmod(F.xxhash64(*h), F.lit(buckets)).cast("int")

    def both(h: Column) -> Column:
        pairs = F.zip_with(h, F.slice(h, 2, F.size(h)), lambda a, b: bucket(a, b))
        return F.concat(F.transform(h, lambda a: bucket(a)), F.slice(pairs, 1, F.greatest(F.size(h) - 1, F.lit(0))))

    return F.when(F.size(hashes) > 0, let(hashes, both)).otherwise(F.array().cast("array<int>"))


def repeat_words(hashes: Column, width: int = 5) -> Column:
    """Words in windows of `width` words that occur twice or more in the text, each word once."""

    def in_repeats(windows: Column) -> Column:
        at = lambda s, i: F.get(s, i)["g"]
        repeated = lambda s: F.filter(
            s, lambda x, i: x["g"].eqNullSafe(at(s, i - 1)) | x["g"].eqNullSafe(at(s, i + 1))
        )
        numbered = F.transform(windows, lambda g, i: F.struct(g.alias("g"), i.alias("i")))
        starts = let(F.sort_array(numbered), lambda s: F.sort_array(F.transform(repeated(s), lambda x: x["i"])))
        covered = lambda p: F.aggregate(
            F.transform(p, lambda x, i: F.least(F.lit(width), F.coalesce(F.get(p, i + 1) - x, F.lit(width)))),
            F.lit(0),
            lambda n, x: n + x,
        )
        return F.when(F.size(F.array_distinct(windows)) == F.size(windows), F.lit(0)).otherwise(let(starts, covered))

    def in_text(h: Column) -> Column:
        windows = F.transform(
            F.sequence(F.lit(0), F.size(h) - width), lambda i: F.xxhash64(*[F.get(h, i + j) for j in range(width)])
        )
        return let(windows, in_repeats)

    return F.when(F.size(hashes) < width, F.lit(0)).otherwise(let(hashes, in_text)).cast("long")


def duplicate_lines(text: Column) -> Column:
    lines = F.filter(F.split(text, "\n"), lambda line: F.btrim(line, F.lit(BLANKS)) != "")
    return let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long")


def log_ratios(df: DataFrame, labels: DataFrame, doc_id: str, text: str, buckets: int, smoothing: float) -> list[float] | None:
    """Log ratio of each bucket; None without a trusted n-gram. At most `buckets` numbers come to the driver."""
    trusted = labels.where("quality = 1").select(F.col("doc_id").alias("_t")).distinct()
    rows = df.select(F.col(doc_id).alias("_id"), F.coalesce(F.col(text), F.lit("")).alias("_x"))
    # the same join at every size: the labels grow with the documents
    # NULL ids meet no label; a hash of their text spreads them over the tasks
    spread = F.when(F.col("_id").isNull(), F.xxhash64("_x")).otherwise(F.lit(0).cast("long"))
    rows, trusted = rows.withColumn("_n", spread), trusted.withColumn("_m", F.lit(0).cast("long"))
    on = (F.col("_id") == F.col("_t")) & (F.col("_n") == F.col("_m"))
    rows = rows.hint("merge").join(trusted.hint("merge"), on, "left")
    grams = rows.select(
        F.col("_t").isNotNull().cast("long").alias("trusted"), F.explode(n_grams(word_hashes(F.col("_x")), buckets)).alias("bucket")
    )
    counts = grams.groupBy("bucket").agg(F.count(F.lit(1)).alias("raw"), F.sum("trusted").alias("target")).collect()
    raw, target = [0] * buckets, [0] * buckets
    for c in counts:
        raw[c["bucket"]], target[c["bucket"]] = c["raw"], c["target"]
    if not sum(target):
        return None
    from math import log

    base = log((sum(raw) + smoothing * buckets) / (sum(target) + smoothing * buckets))
    return [round(log((t + smoothing) / (r + smoothing)) + base, 5) for t, r in zip(target, raw, strict=True)]


def judge(
    df: DataFrame,
    labels: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    buckets: int = 1 << 14,
    smoothing: float = 1.0,
    threshold: float = -0.15,
) -> DataFrame:
    """Adds to every row: n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, llr, kept.

    `labels` (doc_id, quality) names the trusted documents; NULL ids are none. NULL texts have
    no words. `llr` is the mean log ratio of the text's n-grams, NULL for texts without words or
    where nothing is trusted; `kept` is false if base_failed or llr < threshold. Rows are
    judged each for itself, repeated rows alike. Columns named like new ones are replaced.
    """
    return carried(df, [doc_id, text], lambda rows: _judge(rows, labels, doc_id, text, buckets, smoothing, threshold))


def _judge(df: DataFrame, labels: DataFrame, doc_id: str, text: str, buckets: int, smoothing: float, threshold: float) -> DataFrame:
    ratios = log_ratios(df, labels, doc_id, text, buckets, smoothing)
    x = F.coalesce(F.col(text), F.lit(""))
    new = {
        "_h": word_hashes(x),
        "word_chars": F.length(F.translate(x, BLANKS, "")).cast("long"),
        "n_symbols": (F.length(x) - F.length(F.translate(x, SYMBOLS, ""))).cast("long"),
        "n_dup_lines": duplicate_lines(x),
    }
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "llr", "kept"]
    rows = df.drop(*[n for n in names if n not in (doc_id, text)])
    own = rows.columns
    rows = rows.withColumns(new)
    if ratios is None:
        llr = F.lit(None).cast("double")
    else:
        weights = F.from_json(F.lit(json.dumps(ratios)), "array<double>")
        score = lambda g: F.aggregate(g, F.lit(0.0), lambda s, b: s + F.get(weights, b)) / F.size(g)
        grams = n_grams(F.col("_h"), buckets)
        llr = F.when(F.size("_h") > 0, let(grams, score))
    rows = rows.withColumns(
        {"n_words": F.size("_h").cast("long"), "n_repeat_words": repeat_words(F.col("_h")), "llr": llr}
    )
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    rows = rows.withColumn("base_failed", failed)
    rows = rows.withColumn("kept", ~F.col("base_failed") & (F.coalesce(F.col("llr"), F.lit(0.0)) >= threshold))
    return rows.select(*own, *names)
