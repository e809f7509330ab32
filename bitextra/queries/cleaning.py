from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import constants as K
from ..functions.hashing import uniform
from ..operators import cleaners as C, vectors
from ..plans.clean import clean, cleaning_stats, cleaning_summary, mark_failing_step
from ..plans.spec import load_spec
from .base import from_pairs, pairs, q, query, strip, sub, table, u

# The stand-in corpus has no Georgian: Latin letters with accents take the script's place.
LATIN = r"A-Za-z\x{c0}-\x{ff}"
ACCENTED = r"\x{c0}-\x{ff}"


def _flag(df, keep):
    return df.select("id", keep.alias("keep"))


_CONTENT = q(f"[^{K.WS_SET}{K.EMPTY_IGNORED}]")


@query(
    "filter_empty_content",
    from_pairs(f"SELECT id, regexp_matches(en, {_CONTENT}) AND regexp_matches(ka, {_CONTENT}) AS keep FROM pairs"),
)
def _(spark, sf):
    return _flag(pairs(spark, sf), C.filter_empty_content({}))


_PURE = sub("ka", f"[^{LATIN}{K.PURITY_EXTRAS}]")


@query(
    "filter_purity",
    from_pairs(f"SELECT id, length(ka) * CAST(0.999 AS DOUBLE) < length({_PURE}) AS keep FROM pairs"),
)
def _(spark, sf):
    return _flag(pairs(spark, sf), C.filter_georgian_purity({"threshold": 0.001, "letters": LATIN}))


@query(
    "filter_purity_letter_share",
    from_pairs(
        f"SELECT id, ka <> '' AND ceil(length(ka) * CAST(0.8 AS DOUBLE)) <= length({sub('ka', f'[^{LATIN}]')}) AS keep FROM pairs"
    ),
)
def _(spark, sf):
    rule = {"threshold": 0.8, "letters": LATIN, "require_script": False}
    return _flag(pairs(spark, sf), C.filter_georgian_purity(rule))


_TOKENS = r"regexp_extract_all(lower(ka), '[\p{L}\p{N}_]+|[^\p{L}\p{N}_]+')"
_NO_ROMAN = f"array_to_string(list_filter({_TOKENS}, lambda t: NOT regexp_full_match(t, '{K.ROMAN}')), '')"
_HEAD = rf"regexp_extract(r, '(?s)^(.*[{ACCENTED}])', 1)"
_TAIL = rf"regexp_replace(substr(r, length({_HEAD}) + 1), '{K.WS}*[A-Za-z]+(?:_|([^\p{{L}}\p{{N}}_])|$)', '\1', 'g')"
SHARED_LATIN_SQL = f"""n AS (SELECT *, {strip(_NO_ROMAN)} AS r FROM pairs),
t AS (SELECT *, regexp_replace({_HEAD} || {_TAIL}, '[^A-Za-z]', '', 'g') AS latin FROM n)"""


@query(
    "filter_shared_latin",
    from_pairs("SELECT id, translate(latin, lower(en), '') = '' AS keep FROM t", SHARED_LATIN_SQL),
)
def _(spark, sf):
    return _flag(pairs(spark, sf), C.filter_shared_latin_characters({"script": ACCENTED}))


@query(
    "filter_length_ratio",
    from_pairs(
        "SELECT id, length(en) > 0 AND length(ka) > 0 AND CAST(length(en) AS DOUBLE) / length(ka) BETWEEN "
        "CAST(0.3 AS DOUBLE) AND CAST(3.0 AS DOUBLE) AS keep FROM pairs"
    ),
)
def _(spark, sf):
    return _flag(pairs(spark, sf), C.filter_length_ratio({}))


@query(
    "filter_minimum_length",
    from_pairs(f"SELECT id, length({strip('en')}) >= 40 AND length({strip('ka')}) >= 40 AS keep FROM pairs"),
)
def _(spark, sf):
    return _flag(pairs(spark, sf), C.filter_minimum_length({"min_en_length": 40, "min_ka_length": 40}))


@query("final_empty_filter", from_pairs(f"SELECT id, {strip('en')} <> '' AND {strip('ka')} <> '' AS keep FROM pairs"))
def _(spark, sf):
    return _flag(pairs(spark, sf), C.final_empty_filter())


def embedding_pairs(spark, sf):
    """Vectors 2k and 2k+1 as the two sides of pair k."""
    vec = table(spark, sf, "embeddings").withColumn("k", F.floor(F.col("vec_id") / 2).cast("long"))
    even = vec.where(F.col("vec_id") % 2 == 0).select("k", F.col("embedding").alias("a"))
    odd = vec.where(F.col("vec_id") % 2 == 1).select("k", F.col("embedding").alias("b"))
    return vectors.add_similarity(even.join(odd, "k"), "a", "b")


_DOT = "list_sum(list_transform(list_zip({a}, {b}), lambda p: CAST(p[1] AS DOUBLE) * CAST(p[2] AS DOUBLE)))"
_COS = (
    f"{_DOT.format(a='x.embedding', b='y.embedding')} / (sqrt({_DOT.format(a='x.embedding', b='x.embedding')})"
    f" * sqrt({_DOT.format(a='y.embedding', b='y.embedding')}))"
)
EMBEDDING_SQL = f"""SELECT x.vec_id // 2 AS k, {_COS} AS s FROM embeddings x
JOIN embeddings y ON y.vec_id = x.vec_id + 1 WHERE x.vec_id % 2 = 0"""


@query("cosine_of_pairs", f"SELECT k, round(s, 6) AS similarity FROM ({EMBEDDING_SQL})")
def _(spark, sf):
    return embedding_pairs(spark, sf).select("k", F.round("similarity_score", 6).alias("similarity"))


@query("filter_similarity", f"SELECT k, s >= CAST(0.1 AS DOUBLE) AS keep FROM ({EMBEDDING_SQL})")
def _(spark, sf):
    return embedding_pairs(spark, sf).select("k", C.filter_similarity_threshold({"threshold": 0.1}).alias("keep"))


@query("filter_by_domain", from_pairs("SELECT id, domain FROM pairs WHERE domain = 'src3'"))
def _(spark, sf):
    return pairs(spark, sf).where(C.in_domain("src3")).select("id", "domain")


@query("filter_by_dataset_name", from_pairs("SELECT id FROM pairs WHERE string_split(id, '_')[1] = 'fr'"))
def _(spark, sf):
    return pairs(spark, sf).where(C.in_dataset("fr")).select("id")


@query(
    "kept_and_dropped",
    from_pairs(
        "SELECT id, CASE WHEN length(en) >= 400 THEN NULL ELSE 'short' END AS reason FROM pairs"
    ),
)
def _(spark, sf):
    kept, dropped = C.split_by(pairs(spark, sf), F.length("en") >= 400, "short")
    return (
        kept.select("id", F.lit(None).cast("string").alias("reason"))
        .unionByName(dropped.select("id", F.col("_reason").alias("reason")))
    )


CLEAN_SPEC = {
    "cleaners": [
        {"name": "filter_empty_content", "enabled": True},
        {"name": "filter_minimum_length", "enabled": True, "params": {"min_en_length": 40, "min_ka_length": 40}},
        {"name": "filter_georgian_purity", "enabled": True, "params": {"threshold": 0.001, "letters": LATIN}},
        {"name": "filter_shared_latin_characters", "enabled": False},
        {"name": "filter_length_ratio", "enabled": True, "params": {"min_ratio": 0.3, "max_ratio": 3.0}},
    ]
}
_STEP = f"""CASE WHEN NOT (regexp_matches(en, {_CONTENT}) AND regexp_matches(ka, {_CONTENT})) THEN 0
 WHEN NOT (length({strip('en')}) >= 40 AND length({strip('ka')}) >= 40) THEN 1
 WHEN NOT (length(ka) * CAST(0.999 AS DOUBLE) < length({_PURE})) THEN 2
 WHEN NOT (length(ka) > 0 AND CAST(length(en) AS DOUBLE) / length(ka) BETWEEN CAST(0.3 AS DOUBLE) AND CAST(3.0 AS DOUBLE)) THEN 3
 ELSE 4 END"""
CLEAN_CTE = f"""marked AS (SELECT *, {_STEP} AS step FROM pairs),
rules AS (SELECT * FROM (VALUES (0, 'filter_empty_content'), (1, 'filter_minimum_length'),
 (2, 'filter_georgian_purity'), (3, 'filter_length_ratio')) v(step, cleaner))"""


@query(
    "cleaner_chain",
    from_pairs("SELECT id, en, ka, cleaner AS reason FROM marked LEFT JOIN rules USING (step)", CLEAN_CTE),
)
def _(spark, sf):
    kept, dropped, _ = clean(pairs(spark, sf), CLEAN_SPEC)
    return (
        kept.withColumn("reason", F.lit(None).cast("string"))
        .unionByName(dropped.withColumnRenamed("_reason", "reason"))
        .select("id", "en", "ka", "reason")
    )


_STATS_SQL = """counts AS (SELECT domain AS dataset, step, count(*) AS n FROM marked GROUP BY ALL),
sets AS (SELECT DISTINCT dataset, false AS is_total FROM counts UNION ALL SELECT NULL, true),
stats AS (SELECT s.dataset, s.is_total, r.step, r.cleaner,
  CAST(coalesce(sum(CASE WHEN c.step >= r.step THEN n END), 0) AS BIGINT) AS original,
  CAST(coalesce(sum(CASE WHEN c.step > r.step THEN n END), 0) AS BIGINT) AS cleaned,
  CAST(coalesce(sum(CASE WHEN c.step = r.step THEN n END), 0) AS BIGINT) AS dropped
  FROM sets s CROSS JOIN rules r LEFT JOIN counts c ON s.is_total OR c.dataset = s.dataset
  GROUP BY ALL)"""
_RATE = "round(CASE WHEN original = 0 THEN 0 ELSE CAST(cleaned AS DOUBLE) / original END, 6) AS retention"


def _marked(spark, sf):
    steps = load_spec(CLEAN_SPEC).enabled("cleaners")
    return mark_failing_step(pairs(spark, sf).withColumn("dataset", F.col("domain")), steps), steps


@query(
    "cleaning_stats",
    from_pairs(
        f"SELECT dataset, is_total, step, cleaner, original, cleaned, dropped, {_RATE} FROM stats",
        f"{CLEAN_CTE}, {_STATS_SQL}",
    ),
)
def _(spark, sf):
    marked, steps = _marked(spark, sf)
    return cleaning_stats(marked, steps).withColumn("retention", F.round("retention", 6))


@query(
    "cleaning_summary",
    from_pairs(
        f"""SELECT dataset, is_total, original, cleaned, original - cleaned AS dropped, {_RATE} FROM
        (SELECT dataset, is_total, max(CASE WHEN step = 0 THEN original END) AS original,
         max(CASE WHEN step = 3 THEN cleaned END) AS cleaned FROM stats GROUP BY ALL)""",
        f"{CLEAN_CTE}, {_STATS_SQL}",
    ),
)
def _(spark, sf):
    marked, steps = _marked(spark, sf)
    summary = cleaning_summary(cleaning_stats(marked, steps), len(steps))
    return summary.withColumn("retention", F.round("retention", 6))


@query(
    "cleaner_chain_with_scorer",
    from_pairs(
        f"""SELECT id, CASE WHEN NOT (length({strip('en')}) >= 40 AND length({strip('ka')}) >= 40) THEN 'filter_minimum_length'
        WHEN {u('score')} < CAST(0.5 AS DOUBLE) THEN 'filter_similarity_threshold' END AS reason FROM pairs"""
    ),
)
def _(spark, sf):
    spec = {
        "cleaners": [
            {"name": "filter_minimum_length", "params": {"min_en_length": 40, "min_ka_length": 40}},
            {"name": "filter_similarity_threshold", "params": {"threshold": 0.5}},
        ]
    }
    score = lambda df: df.withColumn("similarity_score", uniform(42, "score", F.col("id")))
    kept, dropped, _ = clean(pairs(spark, sf), spec, score)
    none = F.lit(None).cast("string").alias("reason")
    return kept.select("id", none).unionByName(dropped.select("id", F.col("_reason").alias("reason")))
