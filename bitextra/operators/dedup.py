"""Duplicate rows: find them by digest, keep the first of each group."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.hashing import digest
from .lookup import HOT_ROWS, attach, repeat_rows


def _judged(df: DataFrame, columns: list[str], order: str, hot_rows: int, of: list[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """(rows with `_later`, first rows that occur several times with that number as `_ties`).

    A row's place is its `order` and an md5 of all it holds (of the columns `of`, which decide the others). Only digests and places are grouped,
    with map-side partial counts; rows stay where they are and learn the first place of their
    group. Rows that are equal throughout differ in nothing, so of those at the first place one
    stands for all.
    """
    whole = F.md5(F.to_json(F.struct(*(of or df.columns)), {"ignoreNullFields": "false"}))
    rows = df.withColumns({"_digest": digest(*[F.col(c) for c in columns]), "_place": F.struct(F.col(order).alias("_o"), whole.alias("_m"))})
    places = rows.groupBy("_digest", "_place").agg(F.count(F.lit(1)).alias("_n"))
    groups = (
        places.groupBy("_digest")
        .agg(F.sum("_n").alias("_rows"), F.min(F.struct("_place", "_n")).alias("_first"))
        .where("_rows > 1")
        .select("_digest", "_rows", F.col("_first._place").alias("_first"), F.col("_first._n").alias("_ties"))
    )
    marked = attach(rows, groups, "_digest", "_rows", F.col("_place._m"), hot_rows)
    leads = F.col("_place").eqNullSafe(F.col("_first"))
    tied = leads & F.coalesce(F.col("_ties") > 1, F.lit(False))
    plain = marked.where(~tied).withColumn("_later", F.col("_first").isNotNull() & ~leads)
    # column by column, so that those nobody reads stay out of the join
    one = marked.where(tied).groupBy("_digest").agg(*[F.first(c).alias(c) for c in df.columns], F.first("_ties").alias("_ties"))
    return plain.select(*df.columns, "_later"), one.select(*dict.fromkeys([*df.columns, "_digest"]), "_ties")


def mark_duplicates(
    df: DataFrame, columns: list[str], order: str, name: str = "is_duplicate", hot_rows: int = HOT_ROWS, of: list[str] | None = None
) -> DataFrame:
    """Flag every row but the first (in `order`) of each group with equal `columns`.

    `order` need not be unique: other columns decide between equal values, and of rows that are
    equal throughout exactly one is not flagged. Groups of any size, NULLs included. `of` names the
    columns that rows are told apart by, if others only follow from them.
    """
    plain, tied = _judged(df, columns, order, hot_rows, of)
    flag = lambda rows, later: rows.select(*df.columns, later.alias(name))
    copies = repeat_rows(tied.withColumn("_ties", F.col("_ties") - 1), "_ties", by="_digest")
    return flag(plain, F.col("_later")).unionByName(flag(tied, F.lit(False))).unionByName(flag(copies, F.lit(True)))


def drop_duplicates(df: DataFrame, columns: list[str], order: str, hot_rows: int = HOT_ROWS) -> DataFrame:
    """One row of each group with equal `columns`: the first in `order`, as `mark_duplicates` has it."""
    plain, tied = _judged(df, columns, order, hot_rows)
    return plain.where(~F.col("_later")).select(*df.columns).unionByName(tied.select(*df.columns))


def list_duplicates(df: DataFrame, columns: list[str], order: str) -> DataFrame:
    return mark_duplicates(df, columns, order, "_later").where("_later").drop("_later")
