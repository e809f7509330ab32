"""Hook for models that score rows in batches."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import DoubleType

Model = Callable[[list[pd.Series]], "pd.Series"]


def score_rows(
    df: DataFrame,
    load_model: Callable[[], Model],
    columns: list[str],
    name: str = "similarity_score",
    batch_size: int = 32,
    on_error: str = "null",
) -> DataFrame:
    """Add a DOUBLE score. The model is loaded once per task and sees `batch_size` rows a time.

    Only `columns` travel to Python. A batch that fails gets NULL scores (`null`), which the
    similarity cleaner reads as its threshold, or stops the job (`fail`).
    """
    if on_error not in ("null", "fail"):
        raise ValueError("on_error must be 'null' or 'fail'")

    def score(chunks: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
        model = load_model()
        for chunk in chunks:
            chunk = chunk if isinstance(chunk, tuple) else (chunk,)  # one column comes bare
            out = []
            for lo in range(0, len(chunk[0]), batch_size):
                part = [s.iloc[lo : lo + batch_size] for s in chunk]
                try:
                    out.append(pd.Series(model(part), dtype="float64").reset_index(drop=True))
                except Exception:
                    if on_error == "fail":
                        raise
                    out.append(pd.Series([None] * len(part[0]), dtype="float64"))
            yield pd.concat(out, ignore_index=True) if out else pd.Series([], dtype="float64")

    score = F.pandas_udf(score, DoubleType())
    return df.withColumn(name, score(*[F.col(c) for c in columns]))


def pair_scorer(load_model: Callable[[], Model], columns: tuple[str, ...] = ("en", "ka"), **options):
    """A scorer for cleaning jobs: rows in, rows with `similarity_score` out."""
    return lambda df: score_rows(df, load_model, list(columns), **options)
