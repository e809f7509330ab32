"""Registration, the shared `pairs` view, and SQL fragments for the twin queries."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import FloatType, IntegerType, ShortType

from ..functions import constants as K
from ..operators.lookup import dense_index, ensure_checkpoint_dir, shuffle_partitions, spread

Query = Callable[[SparkSession, str], DataFrame]
REGISTERED: dict[str, tuple[Query, str | None]] = {}


def _plain(df: DataFrame) -> DataFrame:
    """INT as BIGINT and FLOAT as DOUBLE, so results compare across engines."""
    wide = {IntegerType: "bigint", ShortType: "bigint", FloatType: "double"}
    casts = {f.name: F.col(f.name).cast(wide[type(f.dataType)]) for f in df.schema if type(f.dataType) in wide}
    return df.withColumns(casts) if casts else df


def query(name: str, sql: str | None = None):
    def add(fn: Query) -> Query:
        if name in REGISTERED:
            raise ValueError(f"query {name} registered twice")
        REGISTERED[name] = (lambda spark, sf_dir: _plain(fn(spark, sf_dir)), sql)
        return fn

    return add


# --- inputs -------------------------------------------------------------------------------


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def texts(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A text table for CPU-heavy work: the test files have one row group, so one task."""
    return spread(table(spark, sf_dir, name))


def pairs(spark: SparkSession, sf_dir: str, positions: bool = False) -> DataFrame:
    """Stand-in for a parallel corpus in which every document takes part.

    The larger side of a source, English or not (English if equal), gives a row for each of its
    documents, with its number as position. Beside the n-th one stands the n-th of the other
    side, which starts again at its end; an empty side is NULL. Only numbers are ranked and
    matched, texts are joined to the finished rows.
    """
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    keys = docs.select("doc_id", "source", F.coalesce(F.col("lang") == "en", F.lit(False)).alias("is_en"))
    sizes = keys.groupBy(F.col("source").alias("_source")).agg(
        F.count_if("is_en").alias("n_en"), F.count_if(~F.col("is_en")).alias("n_other")
    )
    ranked = dense_index(keys, ["doc_id"], ["source", "is_en"], "rn").join(
        sizes, F.col("source").eqNullSafe(F.col("_source"))
    )
    leads = F.col("is_en") == (F.col("n_en") >= F.col("n_other"))
    slot = F.col("rn") % F.nullif(F.least("n_en", "n_other"), F.lit(0))
    leading = ranked.where(leads).select("source", "is_en", F.col("doc_id").alias("row_pos"), slot.alias("slot"))
    others = ranked.where(~leads).select(F.col("source").alias("_source"), F.col("rn").alias("slot"), F.col("doc_id").alias("beside"))
    rows = leading.alias("l").join(
        others.alias("o"), F.col("source").eqNullSafe(F.col("_source")) & (F.col("l.slot") == F.col("o.slot")), "left"
    ).select("source", "is_en", "row_pos", "beside")
    # texts are dealt out by id once, for both sides; only the text beside then moves to its row.
    # CPU-heavy work on texts follows: a numbered exchange keeps its partitions
    cores = spark.sparkContext.defaultParallelism
    dealt = docs.where(F.col("doc_id").isNotNull()).select("doc_id", F.struct("text", "lang").alias("_text"))
    dealt = dealt.repartition(max(cores, shuffle_partitions(docs)), "doc_id")
    text = lambda key, name: dealt.select(F.col("doc_id").alias(key), F.col("_text").alias(name)).hint("merge")
    joined = rows.join(text("beside", "other"), "beside", "left").join(text("row_pos", "lead"), "row_pos")
    ka = F.when(F.col("is_en"), F.col("other")).otherwise(F.col("lead"))
    en = F.when(F.col("is_en"), F.col("lead")).otherwise(F.col("other"))
    return joined.select(
        F.lit(None).cast("string").alias("title"),
        ka["text"].alias("ka"),
        en["text"].alias("en"),
        F.col("source").alias("domain"),
        F.concat(F.coalesce(ka["lang"], F.lit("none")), F.lit("_"), F.col("row_pos").cast("string")).alias("id"),
        *(["row_pos"] if positions else []),
    )


def scratch(spark: SparkSession) -> str:
    """A new folder beside the checkpoints, where all executors can reach it."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/bitextra-{uuid.uuid4().hex}"


# --- SQL fragments ------------------------------------------------------------------------

PAIRS_CTE = """doc_sides AS (SELECT *, coalesce(lang = 'en', false) AS is_en FROM documents),
doc_ranks AS (SELECT *, row_number() OVER (PARTITION BY source, is_en ORDER BY doc_id) - 1 AS rn,
  count(*) FILTER (is_en) OVER (PARTITION BY source) AS n_en, count(*) FILTER (NOT is_en) OVER (PARTITION BY source) AS n_other FROM doc_sides),
doc_leads AS (SELECT *, rn % nullif(least(n_en, n_other), 0) AS slot FROM doc_ranks WHERE is_en = (n_en >= n_other)),
pairs AS (SELECT CAST(NULL AS VARCHAR) AS title, CASE WHEN a.is_en THEN b.text ELSE a.text END AS ka,
  CASE WHEN a.is_en THEN a.text ELSE b.text END AS en, a.source AS domain,
  coalesce(CASE WHEN a.is_en THEN b.lang ELSE a.lang END, 'none') || '_' || CAST(a.doc_id AS VARCHAR) AS id, a.doc_id AS row_pos
  FROM doc_leads a LEFT JOIN doc_ranks b ON b.source IS NOT DISTINCT FROM a.source AND b.is_en <> a.is_en AND b.rn = a.slot)"""

WS = K.WS


def q(s: str) -> str:
    """A SQL string literal."""
    return "'" + s.replace("'", "''") + "'"


def from_pairs(select: str, ctes: str = "") -> str:
    return f"WITH {PAIRS_CTE}{', ' + ctes if ctes else ''} {select}"


def strip(c: str) -> str:
    return f"regexp_replace({c}, {q(f'^{WS}+|{WS}+$')}, '', 'g')"


def sub(c: str, pattern: str, to: str = "") -> str:
    return f"regexp_replace({c}, {q(pattern)}, {q(to)}, 'g')"


def words(c: str) -> str:
    return f"list_filter(regexp_split_to_array({c}, {q(WS + '+')}), lambda w: w <> '')"


def space_tokens(c: str) -> str:
    return f"string_split({strip(c)}, ' ')"


def collapse(c: str) -> str:
    return strip(sub(c, WS + "+", " "))


def u(what: str, key: str = "id", k: str = "'0'", seed: int | str = 42) -> str:
    return (
        f"(CAST(CAST('0x' || substr(md5(concat_ws('|', '{seed}', '{what}', {key}, {k})), 1, 8) AS UBIGINT) AS DOUBLE)"
        " / CAST(4294967296 AS DOUBLE))"
    )


def pick(draw: str, n: str) -> str:
    return f"CAST(floor({draw} * ({n})) AS BIGINT)"


def digest(*cols: str) -> str:
    parts = ", ".join(
        f"CAST(coalesce(length({c}), -1) AS VARCHAR), coalesce({c}, '')" for c in cols
    )
    return f"md5(concat_ws(':', {parts}))"


LONG_CTE = "long AS (SELECT 'ka' AS lang, ka AS text, domain, id FROM pairs UNION ALL SELECT 'en', en, domain, id FROM pairs)"
