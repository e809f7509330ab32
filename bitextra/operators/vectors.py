"""Embedding vectors: cosine of the two sides of a pair."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def _sum(a: Column) -> Column:
    return F.aggregate(a, F.lit(0.0), lambda acc, x: acc + x)


def dot(a: Column, b: Column) -> Column:
    return _sum(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")))


def cosine(a: Column, b: Column) -> Column:
    return F.try_divide(dot(a, b), F.sqrt(dot(a, a)) * F.sqrt(dot(b, b)))


def add_similarity(df: DataFrame, a: str, b: str, name: str = "similarity_score") -> DataFrame:
    return df.withColumn(name, cosine(F.col(a), F.col(b)))
