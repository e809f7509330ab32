"""Parquet sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

INTERNAL = ("row_file", "row_pos")


def write_datasets(df: DataFrame, path: str, suffix: str = "", mode: str = "overwrite") -> None:
    """One folder per dataset, named dataset + suffix.

    `rebalance` lets Spark cut a large dataset into several files and gather a small one in
    one, so neither writes thousands of crumbs nor a single giant.
    """
    named = df.drop(*INTERNAL).withColumn("dataset", F.concat(F.col("dataset"), F.lit(suffix)))
    named.hint("rebalance", "dataset").write.mode(mode).partitionBy("dataset").parquet(path)


def write_splits(splits: dict[str, DataFrame], path: str, mode: str = "overwrite") -> None:
    for name, df in splits.items():
        df.write.mode(mode).parquet(f"{path}/{name}.parquet")


def write_samples(samples: list[DataFrame], path: str) -> None:
    """Preview rows of several stages (column `stage`) as one small table."""
    table = samples[0]
    for s in samples[1:]:
        table = table.unionByName(s, allowMissingColumns=True)
    table.write.mode("overwrite").partitionBy("stage").parquet(path)
