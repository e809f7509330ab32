"""Preprocessors: projections that keep rows and columns as they are in number and name."""

from __future__ import annotations

from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import StringType

from ..functions import constants as K, text as X
from ..functions.arrays import let
from ..registry import preprocessors
from .spelling import respell

#: Texts that a Python function gets as strings at once.
ROWS = 256


def on_columns(df: DataFrame, fn: Callable[[Column], Column], columns: str | list[str]) -> DataFrame:
    """Apply a text function to the listed columns that exist."""
    columns = [columns] if isinstance(columns, str) else columns
    return df.withColumns({c: fn(F.col(c)) for c in columns if c in df.columns})


def _both(params: dict) -> list[str]:
    return params.get("columns", ["en", "ka"])


@preprocessors("convert_to_american", "Write British spellings the American way")
def convert_to_american(df: DataFrame, params: dict) -> DataFrame:
    """By rules and, if `dictionary` is given (a mapping, or a Parquet table word, to), by word before them."""
    columns = params.get("columns", ["en"])
    words = params.get("dictionary")
    if words is not None:
        words = df.sparkSession.read.parquet(words) if isinstance(words, str) else words
        df = respell(df, [columns] if isinstance(columns, str) else columns, words)
    return on_columns(df, X.to_american, columns)


@preprocessors("normalize_characters", "Standard dashes, apostrophes and quotation marks")
def normalize_characters(df: DataFrame, params: dict) -> DataFrame:
    return on_columns(df, X.normalize, _both(params))


@preprocessors("remove_extra_whitespaces", "Collapse repeated spaces, newlines and tabs")
def remove_extra_whitespaces(df: DataFrame, params: dict) -> DataFrame:
    return on_columns(df, X.squeeze_spaces, _both(params))


@preprocessors("lowercase_english", "Lower-case the English side")
def lowercase_english(df: DataFrame, params: dict) -> DataFrame:
    return on_columns(df, F.lower, params.get("columns", ["en"]))


@preprocessors("sync_punctuation", "Make both sides end in the same punctuation mark")
def sync_punctuation(df: DataFrame, params: dict) -> DataFrame:
    """`sync` copies a missing mark and settles a difference for `prefer`; `remove_all` drops
    both marks. Other strategy names act as `sync`."""
    marks = params.get("punctuation_marks", K.END_MARKS)
    marks = marks if isinstance(marks, str) else "".join(marks)
    en, ka = F.col("en"), F.col("ka")
    if params.get("strategy", "sync") == "remove_all":
        nothing = F.lit("")
        return df.withColumns({"en": X.with_end_mark(en, nothing, marks), "ka": X.with_end_mark(ka, nothing, marks)})
    prefer_en = params.get("prefer", "en") == "en"

    def settle(s: Column) -> Column:
        """(en, ka) after the side that lost its say took over the other side's mark."""
        em, km = s["em"], s["km"]
        differ = (em != "") & (km != "") & (em != km)
        english_rules = ((em != "") & (km == "")) | (differ & F.lit(prefer_en))
        georgian_rules = ((km != "") & (em == "")) | (differ & F.lit(not prefer_en))
        return F.struct(
            F.when(georgian_rules, X.with_end_mark(s["en"], km, marks)).otherwise(s["en"]).alias("en"),
            F.when(english_rules, X.with_end_mark(s["ka"], em, marks)).otherwise(s["ka"]).alias("ka"),
        )

    # each text enters the expression once, however long the steps before this one are
    marked = let(
        F.struct(en.alias("en"), ka.alias("ka")),
        lambda t: F.struct(
            t["en"].alias("en"),
            t["ka"].alias("ka"),
            X.end_mark(t["en"], marks).alias("em"),
            X.end_mark(t["ka"], marks).alias("km"),
        ),
    )
    synced = df.withColumn("_synced", let(marked, settle))
    return synced.withColumns({"en": F.col("_synced.en"), "ka": F.col("_synced.ka")}).drop("_synced")


@preprocessors("remove_brackets_content", "Remove bracketed remarks, if wanted only in some domains")
def remove_brackets_content(df: DataFrame, params: dict) -> DataFrame:
    kinds = params.get("bracket_types", ["()"])
    domains = list(params.get("domains", []))

    def fn(c: Column) -> Column:
        plain = X.drop_brackets(c, kinds)
        return F.when(F.col("domain").isin(domains), plain).otherwise(c) if domains else plain

    if domains and "domain" not in df.columns:
        raise ValueError("remove_brackets_content: 'domains' needs a 'domain' column")
    return on_columns(df, fn, _both(params))


@preprocessors("fix_encoding_issues", "Repair wrongly decoded characters and drop invisible ones")
def fix_encoding_issues(df: DataFrame, params: dict) -> DataFrame:
    return on_columns(df, X.repair_encoding, _both(params))


@preprocessors("remove_html_tags", "Remove HTML tags and decode entities")
def remove_html_tags(df: DataFrame, params: dict) -> DataFrame:
    return on_columns(df, X.strip_html, _both(params))


def row_function(fn: Callable[[str], str]) -> Callable[[Column], Column]:
    """A Python text function as a Column function, run over Arrow batches; NULL stays NULL.

    For what has no expression. Register the preprocessor that uses it like any other. Only
    ROWS texts of a batch are Python strings at a time.
    """

    def over(texts: pa.Array) -> pa.Array:
        some = lambda at: [t if t is None else fn(t) for t in texts.slice(at, ROWS).to_pylist()]
        return pa.concat_arrays([pa.array(some(at), pa.string()) for at in range(0, max(1, len(texts)), ROWS)])

    return F.arrow_udf(over, StringType())


QUERY_TIME_STEPS = ["normalize_characters", "convert_to_american", "remove_extra_whitespaces", "fix_encoding_issues"]


def prepare_for_inference(df: DataFrame, columns: list[str]) -> DataFrame:
    """The steps every text sent to a trained model goes through; batch and streaming alike."""
    for name in QUERY_TIME_STEPS:
        df = preprocessors.get(name)(df, {"columns": columns})
    return df


def id_parts(id_col: Column) -> Column:
    """STRUCT(dataset_name, metadata, full_id); the id is cut at its first underscore."""
    parts = F.split(id_col, "_", 2)
    return F.struct(
        F.get(parts, F.lit(0)).alias("dataset_name"),
        F.coalesce(F.get(parts, F.lit(1)), F.lit("")).alias("metadata"),
        id_col.alias("full_id"),
    )


def preview(c: Column, n: int = 100) -> Column:
    return F.concat(F.substring(c, 1, n), F.lit("..."))
