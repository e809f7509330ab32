"""Cleaners: each gives the predicate a row must meet to be kept.

A predicate is a Column that is never NULL; NULL text counts as empty. `s` is the source
side (English) and `t` the target side (Georgian) unless `source` / `target` say otherwise.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import constants as K, text as X
from ..registry import cleaners


def _sides(params: dict) -> tuple[Column, Column]:
    return F.col(params.get("source", "en")), F.col(params.get("target", "ka"))


def _sure(c: Column) -> Column:
    return F.coalesce(c, F.lit(False))


@cleaners("filter_empty_content", "Drop rows whose texts hold nothing but whitespace and punctuation")
def filter_empty_content(params: dict) -> Column:
    s, t = _sides(params)
    return X.has_content(s) & X.has_content(t)


@cleaners("filter_georgian_purity", "Drop rows whose Georgian text holds too many foreign characters")
def filter_georgian_purity(params: dict) -> Column:
    """Kept when len * (1 - threshold) < allowed characters: a higher threshold is looser.

    `letters` replaces the Georgian letter class. With `require_script=False` the rule is
    ceil(len * threshold) <= letters instead.
    """
    _, t = _sides(params)
    letters = params.get("letters", K.GEORGIAN_LETTERS)
    if params.get("require_script", True):
        threshold = float(params.get("threshold", 0.5))
        allowed = X.allowed_length(t, letters + K.PURITY_EXTRAS)
        return _sure(F.length(t) * F.lit(1 - threshold) < allowed)
    threshold = float(params.get("threshold", 0.1))
    enough = F.ceil(F.length(t) * F.lit(threshold)) <= X.allowed_length(t, letters)
    return _sure((t != "") & enough)


@cleaners("filter_shared_latin_characters", "Drop rows with Latin letters in Georgian that English lacks")
def filter_shared_latin_characters(params: dict) -> Column:
    s, t = (F.lower(c) for c in _sides(params))
    script = params.get("script", K.GEORGIAN_BLOCK)
    rest = X.without_trailing_latin(X.without_roman_numerals(t), script)
    latin = F.regexp_replace(rest, "[^A-Za-z]", "")
    return _sure(F.call_function("translate", latin, s, F.lit("")) == "")


@cleaners("filter_length_ratio", "Drop rows whose texts differ too much in length")
def filter_length_ratio(params: dict) -> Column:
    s, t = _sides(params)
    low, high = float(params.get("min_ratio", 0.3)), float(params.get("max_ratio", 3.0))
    ratio = F.try_divide(F.length(s), F.length(t))
    return _sure((F.length(s) > 0) & ratio.between(low, high))


@cleaners("filter_minimum_length", "Drop rows with very short texts")
def filter_minimum_length(params: dict) -> Column:
    s, t = _sides(params)
    long_s = F.length(X.strip(s)) >= int(params.get("min_en_length", 5))
    return _sure(long_s & (F.length(X.strip(t)) >= int(params.get("min_ka_length", 5))))


@cleaners("filter_similarity_threshold", "Drop rows whose texts differ in meaning")
def filter_similarity_threshold(params: dict) -> Column:
    """Needs `similarity_score`, which a scorer or `add_similarity` puts there beforehand.

    A NULL score (the scorer failed) counts as the threshold itself, so the row stays.
    """
    score = F.col(params.get("score", "similarity_score"))
    threshold = F.lit(float(params.get("threshold", 0.5)))
    return F.coalesce(score, threshold) >= threshold


filter_similarity_threshold.needs_score = True


def final_empty_filter(columns: tuple[str, ...] = ("en", "ka")) -> Column:
    """Rows whose texts are all present and not blank."""
    kept = F.lit(True)
    for c in columns:
        kept = kept & X.non_empty(F.col(c))
    return kept


def in_domain(domain: str) -> Column:
    return _sure(F.col("domain") == domain)


def in_dataset(name: str) -> Column:
    return _sure(F.split_part(F.col("id"), F.lit("_"), F.lit(1)) == name)


def split_by(df: DataFrame, keep: Column, reason: str) -> tuple[DataFrame, DataFrame]:
    """(kept, dropped); together they hold every row once. Dropped rows carry the reason."""
    dropped = df.where(~keep).withColumn("_reason", F.lit(reason))
    return df.where(keep), dropped
