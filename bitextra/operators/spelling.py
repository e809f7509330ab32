"""Spelling by a word list: every word of a text is looked up, in one pass over the text."""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from ..functions.hashing import digest
from .lookup import HOT_ROWS, attach

#: A list of this many words goes to every task (some 10 MB); a larger one is joined.
BROADCAST_WORDS = 200_000
#: Words are runs of letters and inner apostrophes; all else stays as it is.
WORD = r"\p{L}+(?:['’]\p{L}+)*"


def recase(word: str, to: str) -> str:
    """`to` in the letter case of `word`: all capitals, first capital, or as listed."""
    if len(word) > 1 and word.isupper():
        return to.upper()
    return to[:1].upper() + to[1:] if word[:1].isupper() else to


def recase_column(word: Column, to: Column) -> Column:
    first = F.left(word, F.lit(1))
    capitals = (F.length(word) > 1) & (F.upper(word) == word) & (F.lower(word) != word)
    raised = F.concat(F.upper(F.left(to, F.lit(1))), F.substr(to, F.lit(2)))
    return F.when(capitals, F.upper(to)).when(first != F.lower(first), raised).otherwise(to)


def _respeller(table: dict[str, str]):
    @F.arrow_udf("string")
    def respell(texts: pa.Array) -> pa.Array:
        import regex

        word, known = regex.compile(WORD), {}

        def change(m: re.Match) -> str:
            w = m[0]
            if w not in known:
                to = table.get(w.lower())
                known[w] = w if to is None else recase(w, to)
            return known[w]

        return pa.array([t if t is None else word.sub(change, t) for t in texts.to_pylist()], pa.string())

    return respell


def _listed(words: DataFrame) -> DataFrame:
    """(word, to): one line a word in lower case, the least replacement if there are several."""
    some = words.select(F.lower(F.col("word").cast("string")).alias("word"), F.col("to").cast("string").alias("to"))
    return some.where("word is not null and to is not null").groupBy("word").agg(F.min("to").alias("to"))


def respell(
    df: DataFrame, columns: list[str], words: DataFrame | dict[str, str], most: int = BROADCAST_WORDS, hot_rows: int = HOT_ROWS
) -> DataFrame:
    """Words of `columns` replaced by a table (word, to), whatever their letter case.

    A table of at most `most` words, which is counted, goes to the tasks: every different word of
    a batch is looked up once. A larger one is joined: the different words of each different
    text meet the table, and only texts in which something changes are joined back. NULL stays
    NULL; replacements are not looked up again.
    """
    columns = [c for c in columns if c in df.columns]
    if isinstance(words, dict):
        if len(words) > most:
            words = df.sparkSession.createDataFrame(list(words.items()), "word string, to string")
        else:
            small = {w.lower(): to for w, to in sorted(words.items(), reverse=True)}
    if isinstance(words, DataFrame):
        listed = _listed(words)
        rows = listed.limit(most + 1).collect()
        if len(rows) > most:
            for c in columns:
                df = _by_join(df, c, listed, hot_rows)
            return df
        small = {r["word"]: r["to"] for r in rows}
    change = _respeller(small)
    return df.withColumns({c: change(F.col(c)) for c in columns})


def _by_join(df: DataFrame, column: str, listed: DataFrame, hot_rows: int) -> DataFrame:
    rows = df.withColumn("_digest", digest(F.col(column)))
    texts = rows.where(F.col(column).isNotNull()).groupBy("_digest").agg(F.first(column).alias("_t"), F.count(F.lit(1)).alias("_rows"))
    found = F.regexp_extract_all("_t", F.lit(WORD), F.lit(0))
    # a word once for each text, so a frequent one has no more rows than there are texts
    held = texts.select("_digest", F.explode(F.array_distinct(F.transform(found, F.lower))).alias("word"))
    hits = held.join(listed, "word").groupBy("_digest").agg(F.map_from_entries(F.collect_list(F.struct("word", "to"))).alias("_map"))
    pieces = F.regexp_extract_all("_t", F.lit(f"{WORD}|[^\\p{{L}}]+|."), F.lit(0))
    put = lambda w: F.coalesce(recase_column(w, F.element_at("_map", F.lower(w))), w)
    changed = texts.join(hits, "_digest").select("_digest", "_rows", F.array_join(F.transform(pieces, put), "").alias("_new"))
    out = attach(rows, changed, "_digest", "_rows", F.col("_digest"), hot_rows)
    return out.select(*[F.coalesce("_new", F.col(c)).alias(c) if c == column else F.col(c) for c in df.columns])
