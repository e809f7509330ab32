"""Exact, reproducible samples that need neither a global sort nor a task per stratum."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.hashing import hash_key
from .lookup import attach, dense_index, ensure_checkpoint_dir, repeat_rows, row_index

_BUCKET_DIGITS = 4  # rows are drawn in md5 order; 16^4 equal buckets of it
#: Cut-offs are broadcast up to this many strata (some 20 MB), beyond it joined.
FEW_STRATA = 100_000


def _buckets(df: DataFrame, stratum: Column, key: list[str], seed: int | str) -> DataFrame:
    h = hash_key(seed, *[F.col(c) for c in key])
    return df.select(*key, stratum.cast("string").alias("_stratum"), h.alias("_h")).withColumn(
        "_bucket", F.substring("_h", 1, _BUCKET_DIGITS)
    )


def _histogram(narrow: DataFrame) -> DataFrame:
    """(stratum, bucket, rows, rows before it, rows of the stratum); <= 65,536 per stratum."""
    run = Window.partitionBy("_stratum").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    return (
        narrow.groupBy("_stratum", "_bucket")
        .agg(F.count(F.lit(1)).alias("_n"))
        .withColumn("_start", F.coalesce(F.sum("_n").over(run), F.lit(0)))
        .withColumn("_total", F.sum("_n").over(Window.partitionBy("_stratum")))
    )


def _cuts(narrow: DataFrame, quota: Callable[[Column], Column] | DataFrame) -> DataFrame:
    """Where the quota of every stratum is reached: (_stratum, _cut, _keep, _at_cut, _total).

    `narrow` has (_stratum, _h, _bucket); `quota` is a function of a stratum's size or a table
    (_stratum, _wanted). Rows with a hash below `_cut` are all taken, of the
    `_at_cut` rows with that hash `_keep`. Only the bucket in which the quota ends is looked
    into, hash by hash with their counts.
    """
    hist = _histogram(narrow)
    if isinstance(quota, DataFrame):
        hist = hist.join(quota.withColumnRenamed("_wanted", "_quota"), "_stratum")
    else:
        hist = hist.withColumn("_quota", F.least(quota(F.col("_total")), F.col("_total")))
    edges = hist.where((F.col("_start") < F.col("_quota")) & (F.col("_quota") <= F.col("_start") + F.col("_n")))
    edges = edges.select("_stratum", "_bucket", (F.col("_quota") - F.col("_start")).alias("_need"), "_total")
    counts = narrow.join(edges, ["_stratum", "_bucket"]).groupBy("_stratum", "_h", "_need", "_total").agg(F.count(F.lit(1)).alias("_at_cut"))
    upto = Window.partitionBy("_stratum").orderBy("_h").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.withColumn("_keep", F.col("_need") - F.coalesce(F.sum("_at_cut").over(upto), F.lit(0)))
    last = (F.col("_keep") >= 1) & (F.col("_keep") <= F.col("_at_cut"))
    return counts.where(last).select("_stratum", F.col("_h").alias("_cut"), "_keep", "_at_cut", "_total")


def _with_cuts(rows: DataFrame, cuts: DataFrame, strata: str | None) -> DataFrame:
    if strata:
        # one row per stratum, in the checkpoint folder: few of them spare the rows a shuffle
        if cuts.limit(FEW_STRATA + 1).count() <= FEW_STRATA:
            return rows.join(F.broadcast(cuts), "_stratum", "left")
        return attach(rows, cuts, "_stratum", "_total", F.col("_h"))
    # the one cut-off under each first hex digit: a hash join with sixteen rows
    digits = F.explode(F.array(*[F.lit(d) for d in "0123456789abcdef"]))
    sixteen = cuts.select(digits.alias("_digit"), "_cut", "_keep", "_at_cut", "_total")
    return rows.withColumn("_digit", F.substring("_h", 1, 1)).join(F.broadcast(sixteen), "_digit")


def sample_by_hash(
    df: DataFrame,
    quota: Callable[[Column], Column],
    key: list[str],
    seed: int | str,
    strata: str | None = None,
) -> DataFrame:
    """Exactly the first quota(rows of the stratum) rows of every stratum in md5(seed|key) order.

    Per stratum, a histogram over hash buckets finds the bucket where the quota ends, and counts
    per hash inside it the last hash to be taken. The table itself is then filtered against one
    cut-off per stratum and is never sorted. The cut-offs are written to the checkpoint folder.
    Keys may repeat or be NULL: where only some of the rows with the last hash are wanted, an
    md5 of the whole row orders them in the same way, and of equal rows one stands for all.
    """
    stratum = F.col(strata) if strata else F.lit("all")
    stratum = F.coalesce(stratum.cast("string"), F.lit(""))
    ensure_checkpoint_dir(df.sparkSession)
    rows = df.withColumn("_stratum", stratum).withColumn("_h", hash_key(seed, *[F.col(c) for c in key]))
    # one row per stratum
    cuts = _cuts(_buckets(df, stratum, key, seed), quota).checkpoint()
    judged = _with_cuts(rows, cuts, strata)
    whole = F.col("_keep") == F.col("_at_cut")
    kept = judged.where((F.col("_h") < F.col("_cut")) | ((F.col("_h") == F.col("_cut")) & whole)).select(*df.columns)
    some = cuts.where(~whole)
    if some.isEmpty():
        return kept
    # rows of the last key, of which only `_keep` are wanted
    last = judged.where((F.col("_h") == F.col("_cut")) & ~whole).select(*df.columns, "_stratum")
    last = last.withColumn("_h", F.md5(F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"})))
    by_row = last.select("_stratum", "_h", F.substring("_h", 1, _BUCKET_DIGITS).alias("_bucket"))
    wanted = some.select("_stratum", F.col("_keep").alias("_wanted"))
    ends = _cuts(by_row, wanted).checkpoint()
    inner = _with_cuts(last, ends, strata)
    before = inner.where(F.col("_h") < F.col("_cut")).select(*df.columns)
    equal = inner.where(F.col("_h") == F.col("_cut")).groupBy("_stratum").agg(F.first(F.struct(*df.columns)).alias("_row"), F.first("_keep").alias("_keep"))
    copies = repeat_rows(equal.select(*[F.col("_row")[c].alias(c) for c in df.columns], "_keep"), "_keep")
    return kept.unionByName(before).unionByName(copies)


def sample_ranked(df: DataFrame, quota: Callable[[Column], Column], key: list[str], seed: int | str) -> DataFrame:
    """Like sample_by_hash over the whole table, with the 0-based rank of each row as `_rank`."""
    h = hash_key(seed, *[F.col(c) for c in key])
    rows = df.withColumn("_h", h).withColumn("_bucket", F.substring("_h", 1, _BUCKET_DIGITS))
    hist = _histogram(_buckets(df, F.lit("all"), key, seed))
    # <= 65,536 rows by construction
    starts = F.broadcast(hist.select("_bucket", "_start", "_total"))
    placed = rows.join(starts, "_bucket").where(F.col("_start") < quota(F.col("_total")))
    local = F.row_number().over(Window.partitionBy("_bucket").orderBy("_h", *key)) - 1
    ranked = placed.withColumn("_rank", (F.col("_start") + local).cast("long"))
    return ranked.where(F.col("_rank") < quota(F.col("_total"))).select(*df.columns, "_rank")


def percent_of(percentage: float) -> Callable[[Column], Column]:
    return lambda total: F.floor(total * F.lit(float(percentage)) / 100).cast("long")


def exactly(n: int) -> Callable[[Column], Column]:
    return lambda total: F.lit(int(n)).cast("long")


def sample_percentage(
    df: DataFrame, percentage: float, key: list[str], seed: int | str = 42
) -> DataFrame:
    return df if percentage >= 100 else sample_by_hash(df, percent_of(percentage), key, seed)


def sample_rows(df: DataFrame, n: int, key: list[str], seed: int | str = 42) -> DataFrame:
    return sample_by_hash(df, exactly(n), key, seed)


def sample_stratified(
    df: DataFrame,
    percentage: float,
    key: list[str],
    seed: int | str = 42,
    strata: str = "domain",
    min_rows: int = 10,
) -> DataFrame:
    """max(min_rows, percentage) rows of each stratum, at most all of them."""
    if percentage >= 100 or strata not in df.columns:
        return df
    share = percent_of(percentage)
    quota = lambda n: F.greatest(F.lit(min_rows).cast("long"), share(n))
    return sample_by_hash(df, quota, key, seed, strata)


def shuffle_rows(df: DataFrame, key: list[str], seed: int | str = 42) -> DataFrame:
    return df.orderBy(hash_key(seed, *[F.col(c) for c in key]), *key)


def preview_rows(df: DataFrame, n: int, key: list[str], stage: str, seed: int | str = 42) -> DataFrame:
    """A handful of rows for people to look at; n is small (10, 20, 50)."""
    return shuffle_rows(df, key, seed).limit(n).withColumn("stage", F.lit(stage))


def preview_by(df: DataFrame, n: int, key: list[str], by: str, stage: str, seed: int | str = 42) -> DataFrame:
    """At most n rows of every value of `by`; tasks keep n each before anything is shuffled."""
    rank = F.row_number().over(Window.partitionBy(by).orderBy(hash_key(seed, *[F.col(c) for c in key]), *key))
    rows = df.withColumn("_rank", rank).where(F.col("_rank") <= n).drop("_rank")
    return rows.withColumn("stage", F.concat(F.lit(f"{stage}:"), F.coalesce(F.col(by).cast("string"), F.lit(""))))


def first_rows(df: DataFrame, n: int, key: str = "id") -> DataFrame:
    return df.orderBy(key).limit(n)


def indexed(df: DataFrame, order: list[str] | None = None, name: str = "idx") -> DataFrame:
    """Row index in file order where `row_pos` is known, else in the given order."""
    if order is None and "row_pos" in df.columns:
        return dense_index(df, [c for c in ("row_file", "row_pos") if c in df.columns], name=name)
    return row_index(df, order or ["id"], name=name)


def batches(df: DataFrame, columns: list[str], size: int = 32) -> DataFrame:
    """Mini-batches of an indexed table: one row per batch, each column a list in row order."""
    row = F.struct("idx", *columns)
    grouped = (
        df.withColumn("batch", F.floor(F.col("idx") / size).cast("long"))
        .groupBy("batch")
        .agg(F.array_sort(F.collect_list(row)).alias("_rows"))
    )
    return grouped.select(
        "batch", F.size("_rows").alias("batch_size"), *[F.col(f"_rows.{c}").alias(c) for c in columns]
    )
