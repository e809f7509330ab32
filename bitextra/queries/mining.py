from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import constants as K
from ..operators import latent as L, mining as M, profile as P
from .base import from_pairs, pairs, q, query, table

_STOP = ", ".join(q(w) for w in K.STOP_WORDS)
FEATURES = 5000


def _weights(spark, sf):
    return M.tfidf(pairs(spark, sf), "id", F.concat_ws(" ", "ka", "en"), FEATURES)


_TFIDF = f"""tk AS (SELECT id, unnest(regexp_extract_all(lower(ka || ' ' || en), '{M.TERM}')) AS term FROM pairs),
tf AS (SELECT id, term, count(*) AS tf FROM tk WHERE term NOT IN ({_STOP}) GROUP BY ALL),
st AS (SELECT term, sum(tf) AS n, count(*) AS df FROM tf GROUP BY term ORDER BY n DESC, term LIMIT {FEATURES}),
vo AS (SELECT term, row_number() OVER (ORDER BY n DESC, term) - 1 AS feature,
  ln((1.0::DOUBLE + (SELECT count(*) FROM pairs)) / (df + 1)) + 1 AS idf FROM st),
we AS (SELECT id, term, feature, tf * idf AS w FROM tf JOIN vo USING (term))"""


@query(
    "tfidf",
    from_pairs(
        "SELECT id, term, feature, round(w / sqrt(sum(w * w) OVER (PARTITION BY id)), 6) AS weight FROM we", _TFIDF
    ),
)
def _(spark, sf):
    weights = _weights(spark, sf)
    return weights.withColumn("weight", F.round("weight", 6))


def _vectors(spark, sf):
    rows = M.tfidf_rows(pairs(spark, sf), "id", F.concat_ws(" ", "ka", "en"), FEATURES, pack=True)
    return L.lsa(rows, "id", FEATURES)


@query("latent_semantic_vectors")
def _(spark, sf):
    vectors, ratio = _vectors(spark, sf)
    return vectors.withColumn("explained_variance_ratio", F.lit(ratio))


@query("cluster_samples")
def _(spark, sf):
    vectors, _ = _vectors(spark, sf)
    clusters, _, _ = L.cluster(vectors, "id")
    return L.cluster_samples(pairs(spark, sf), clusters, "id")


def _detected(spark, sf):
    """A model fitted on half of the documents, applied to all of them."""
    docs = table(spark, sf, "documents")
    model = M.language_model(docs.where(F.md5(F.col("doc_id").cast("string")) < "8"))
    return M.detect_language(model, docs)


@query("detect_language")
def _(spark, sf):
    return _detected(spark, sf).select("doc_id", "lang", "detected_lang", F.round("confidence", 6).alias("confidence"))


@query("language_purity")
def _(spark, sf):
    found = _detected(spark, sf).select(
        F.col("source").alias("side"), F.col("lang").alias("expected"), F.col("detected_lang").alias("lang"), "confidence"
    )
    return P.language_purity(found)


@query("top_detected_languages")
def _(spark, sf):
    found = _detected(spark, sf).select(F.col("lang").alias("side"), F.col("detected_lang").alias("lang"))
    return P.top_languages(found)
