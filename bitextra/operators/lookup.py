"""Joins and row numbers that stay even when one key holds much of the data."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

# A key with more rows than this is "hot". A table of hot keys has at most
# (rows / HOT_ROWS) entries: 500,000 for 10^11 rows, some 25 MB, so it may be broadcast.
HOT_ROWS = 200_000


def attach(
    rows: DataFrame,
    table: DataFrame,
    key: str,
    rows_per_key: str,
    spread: Column,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Left join `rows` with `table`, which has one row per string `key`.

    `table[rows_per_key]` tells how many of `rows` carry the key. Hot keys are answered by a
    broadcast whose size is bounded (see HOT_ROWS) and leave the shuffle join: their rows get
    a key of their own (`spread`, any string that varies by row) and so spread evenly. All
    other keys have at most `hot_rows` rows each and go through an ordinary join.
    """
    payload = [c for c in table.columns if c != key]
    hot = table.where(F.col(rows_per_key) > hot_rows).select(
        key, *[F.col(c).alias(f"_hot_{c}") for c in payload]
    )
    cold = table.where(F.col(rows_per_key) <= hot_rows).select(
        F.col(key).alias("_cold_key"), *[F.col(c).alias(f"_cold_{c}") for c in payload]
    )
    is_hot = F.col(f"_hot_{rows_per_key}").isNotNull()
    elsewhere = F.concat(F.lit("hot:"), spread.cast("string"))
    joined = (
        rows.join(F.broadcast(hot), key, "left")
        .withColumn("_join_key", F.when(is_hot, elsewhere).otherwise(F.col(key)))
        .join(cold, F.col("_join_key") == F.col("_cold_key"), "left")
    )
    return joined.select(
        *rows.columns,
        *[F.coalesce(F.col(f"_hot_{c}"), F.col(f"_cold_{c}")).alias(c) for c in payload],
    )


def shuffle_partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def spread(df: DataFrame) -> DataFrame:
    """Rows dealt out to all cores when the scan has fewer partitions than there are cores.

    Meant for CPU-heavy text work on small or badly split files; a large scan is left alone.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


#: Copies that one row becomes in one task.
COPIES = 10_000


def repeat_rows(df: DataFrame, count: str, copies: int = COPIES, by: str | None = None) -> DataFrame:
    """Every row `count` times, without the column `count`; rows with a count below 1 or NULL go.

    A count beyond `copies` becomes blocks of copies^2, then of `copies`, which are dealt out to
    all tasks before the last step, so no array holds more than `copies` numbers up to copies^3.
    `by` names a column that tells rows apart; without it, whole rows are read to deal blocks out.
    """
    n, rest = F.col(count), [c for c in df.columns if c != count]
    upto = lambda size: F.explode(F.sequence(F.lit(0).cast("long"), size - 1))
    few = df.where((n >= 1) & (n <= copies)).withColumn("_nth", upto(n))
    many = df.where(n > copies)
    for step in (copies * copies, copies):
        at = upto(F.ceil(F.col(count) / step).cast("long"))
        many = many.withColumn("_block", at).withColumn(count, F.least(F.lit(step), F.col(count) - F.col("_block") * step).cast("long"))
    spot = F.xxhash64(F.col(by) if by else F.to_json(F.struct(*rest)), F.col("_block"))
    dealt = many.repartition(shuffle_partitions(df), spot).withColumn("_nth", upto(F.col(count)))
    return few.select(*rest).unionByName(dealt.select(*rest))


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The session's checkpoint folder; a temporary one only in local mode without a setting."""
    sc = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named is None and sc.getCheckpointDir() is None:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        named = tempfile.mkdtemp(prefix="bitextra-")
        sc.setCheckpointDir(named)
    return named or sc.getCheckpointDir()


#: Bytes of rows that travel to a Python worker together; Spark's own limit is 64 MB, which JVM and worker hold at once.
BATCH = "8m"


@contextmanager
def small_batches(spark: SparkSession) -> Iterator[None]:
    """What is computed meanwhile sends Arrow batches of about BATCH to Python. The session's setting returns afterwards."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(name, None)
    spark.conf.set(name, BATCH)
    try:
        yield
    finally:
        spark.conf.set(name, before) if before is not None else spark.conf.unset(name)


def settled(df: DataFrame, name: str) -> DataFrame:
    """The table written to a new folder beside the checkpoints and read again: computed once for all that reads it."""
    path = f"{ensure_checkpoint_dir(df.sparkSession).rstrip('/')}/bitextra-{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def dense_index(
    df: DataFrame,
    order: list[str],
    group: list[str] | None = None,
    name: str = "idx",
    width: int = 1 << 16,
) -> DataFrame:
    """0-based row number within `group`, ordered by `order`, without a task per group.

    The last column of `order` is an integer and `order` is unique within `group`. Rows fall
    into cells of `width` consecutive integers, so a cell holds at most `width` rows whatever
    the size of its group. A running sum over the cell counts gives each cell its start; it
    reads one number per cell, so a group of 10^10 consecutive rows means 150,000 numbers.
    """
    group = group or []
    *prefix, last = order
    cells = [*group, *prefix, "_cell"]
    rows = df.withColumn("_cell", F.call_function("div", F.col(last), F.lit(width)))
    upto = Window.partitionBy(*group).orderBy(*prefix, "_cell").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        rows.groupBy(*cells)
        .agg(F.count(F.lit(1)).alias("_n"))
        .withColumn("_start", F.coalesce(F.sum("_n").over(upto), F.lit(0)))
        .drop("_n")
    )
    within = Window.partitionBy(*cells).orderBy(last)
    numbered = rows.withColumn("_local", F.row_number().over(within) - 1)
    on = [F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}")) for c in cells]
    cond = on[0]
    for c in on[1:]:
        cond = cond & c
    joined = numbered.alias("a").join(starts.alias("b"), cond, "inner")
    return joined.select(
        *[F.col(f"a.{c}") for c in df.columns], (F.col("b._start") + F.col("a._local")).cast("long").alias(name)
    )


def row_index(
    df: DataFrame, order: list[str], name: str = "idx", group: list[str] | None = None, carry: list[str] | None = None
) -> DataFrame:
    """0-based row number within `group` for an order of any types; NULLs come first.

    Only keys (and `carry`, small columns that travel with them) are sorted: in ranges of about equally
    many rows over group and order together, whose bounds Spark samples, so a long group and a mass of equal
    leading keys spread over many tasks. The ranges are written to the checkpoint folder, which fixes
    them; the place in a range plus the group's rows in the ranges before it is the answer. Other
    columns are joined to the finished numbers. Where rows tie in the whole order, all columns travel instead
    of being joined, and ties are numbered in the order in which they arrive.
    """
    group, carry = group or [], carry or []
    keys = [*group, *order]
    ensure_checkpoint_dir(df.sparkSession)
    narrow = df.select(*dict.fromkeys([*keys, *carry]))
    ranges = narrow.repartitionByRange(shuffle_partitions(df), *keys).sortWithinPartitions(*keys)
    placed = ranges.checkpoint(eager=True).withColumn("_at", F.monotonically_increasing_id())
    placed = placed.withColumn("_part", F.shiftright("_at", 33)).withColumn("_in_part", F.col("_at").bitwiseAND(F.lit((1 << 33) - 1)))
    before = Window.partitionBy(*group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    # a row per range and group in it: at most groups + ranges, of one group at most the ranges
    starts = (
        placed.groupBy(*group, "_part")
        .agg(F.count(F.lit(1)).alias("_n"), F.min("_in_part").alias("_first"))
        .withColumn("_start", F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_first"))
        .drop("_n", "_first")
    )
    by_part = null_safe_join(placed, starts if group else F.broadcast(starts), [*group, "_part"], ["_start"])
    numbered = by_part.select(*narrow.columns, (F.col("_start") + F.col("_in_part")).cast("long").alias(name))
    if set(df.columns) <= set(narrow.columns):
        return numbered.select(*df.columns, name)
    if not placed.groupBy(*keys).count().where("count > 1").isEmpty():
        return row_index(df, order, name, group, df.columns)
    return null_safe_join(df, numbered, keys, [name])


def null_safe_join(left: DataFrame, right: DataFrame, on: list[str], add: list[str], how: str = "inner") -> DataFrame:
    """Left's rows with `add` of right, joined where all of `on` agree, NULL with NULL."""
    cond = reduce(lambda a, b: a & b, [F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}")) for c in on])
    joined = left.alias("a").join(right.alias("b"), cond, how)
    return joined.select(*[F.col(f"a.{c}") for c in left.columns], *[F.col(f"b.{c}") for c in add])
