"""The parallel-row contract and the schema checks made while a plan is built."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, functions as F
from pyspark.sql.types import StringType, StructField, StructType

REQUIRED = ["title", "ka", "en", "domain", "id"]

PARALLEL = StructType(
    [
        StructField("title", StringType(), True),
        StructField("ka", StringType(), True),
        StructField("en", StringType(), True),
        StructField("domain", StringType(), True),
        StructField("id", StringType(), True),
    ]
)


class ContractError(ValueError):
    pass


def require_parallel(df: DataFrame, who: str = "input") -> DataFrame:
    missing = [c for c in REQUIRED if c not in df.columns]
    if missing:
        raise ContractError(f"{who}: missing required columns {missing}; required {REQUIRED}")
    return df


def null_counts(df: DataFrame, columns: tuple[str, ...] = ("ka", "en", "id")) -> DataFrame:
    """One row with the number of NULLs in each critical column."""
    return df.agg(*[F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in columns])


def require_same_columns(before: DataFrame, after: DataFrame, who: str) -> DataFrame:
    if set(before.columns) != set(after.columns) or len(before.columns) != len(after.columns):
        raise ContractError(f"{who}: columns changed from {before.columns} to {after.columns}")
    return after.select(*before.columns)


def require_superset(columns: list[str], df: DataFrame, who: str) -> DataFrame:
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ContractError(f"{who}: missing columns {missing}")
    return df


def watch(df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """The table, and the number of its rows as the next action passes over them: no pass of its own."""
    seen = Observation(name)
    return df.observe(seen, F.count(F.lit(1)).alias("rows")), seen


def require_conserved(before: Observation, after: Observation, who: str) -> int:
    """Rows that went in and came out, once the action over both is done; an error if they differ."""
    n, m = (seen.get.get("rows", 0) for seen in (before, after))
    if n != m:
        raise ContractError(f"{who}: {n} rows went in and {m} came out")
    return m
