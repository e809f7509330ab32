"""Profile and evaluation bundles."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, functions as F

from ..operators import latent as L, mining as M, profile as P
from ..operators.lookup import settled

BUNDLES: dict[str, list[str]] = {
    "basic": ["basic", "lengths", "domains", "datasets", "quality"],
    "text": ["chars", "words", "word_lengths", "bigrams", "trigrams", "fourgrams", "sentences", "edges", "numbers", "longest", "zipf"],
    "quality": ["lengths", "quality"],
}
BUNDLES["complete"] = sorted({*BUNDLES["basic"], *BUNDLES["text"]})

TABLES: dict[str, Callable[..., DataFrame]] = {
    "basic": P.basic_stats,
    "lengths": P.length_stats,
    "domains": lambda df: P.group_counts(df, "domain"),
    "datasets": lambda df: P.group_counts(df, "dataset"),
    "quality": P.quality_issues,
    "chars": P.top_chars,
    "words": P.top_words,
    "word_lengths": P.word_lengths,
    "bigrams": lambda df, **counts: P.top_ngrams(df, 2, **counts),
    "trigrams": lambda df, **counts: P.top_ngrams(df, 3, **counts),
    "fourgrams": lambda df, **counts: P.top_ngrams(df, 4, **counts),
    "sentences": P.sentence_stats,
    "edges": P.word_edges,
    "numbers": P.number_patterns,
    "longest": P.longest_words,
    "zipf": P.zipf,
}

#: Tables of the counts of all words.
OF_WORDS = {"words", "word_lengths", "edges", "longest", "zipf"}
#: Tables of n-grams, with their lengths.
OF_NGRAMS = {"bigrams": 2, "trigrams": 3, "fourgrams": 4}


def _clustering(df: DataFrame, key: str = "id", features: int = 5000, components: int = 50, max_clusters: int = 10) -> dict[str, DataFrame]:
    rows = M.tfidf_rows(df, key, F.concat_ws(" ", "ka", "en"), features, pack=True)
    vectors, explained = L.lsa(rows, key, features, components)
    clusters, costs, best = L.cluster(vectors, key, max_clusters)
    fits = df.sparkSession.createDataFrame(
        [(k, cost, k == best, explained) for k, cost in costs], "k int, cost double, chosen boolean, explained_variance double"
    )
    return {
        "cluster_fits": fits,
        "cluster_sizes": clusters.groupBy("cluster").count(),
        "cluster_samples": L.cluster_samples(df, clusters, key),
    }


def profile(df: DataFrame, kind: str = "complete", **options) -> dict[str, DataFrame]:
    """Named profile tables of a bundle; each is computed when it is read.

    `clustering` fits its models at once. A bundle with several tables of word counts counts words
    first and keeps a row per different word in the checkpoint folder for them; frequent n-grams of all lengths are found together likewise.
    """
    if kind == "clustering":
        return _clustering(df, **options)
    if kind not in BUNDLES:
        raise ValueError(f"unknown profile '{kind}'; available: {', '.join([*BUNDLES, 'clustering'])}")
    names = BUNDLES[kind]
    shared = {}
    if len(OF_WORDS & set(names)) > 1:
        counts = settled(P.word_counts(df), "word-counts")
        shared = {name: {"counts": counts} for name in OF_WORDS}
    lengths = [n for name, n in OF_NGRAMS.items() if name in names]
    if len(lengths) > 1:
        counts = P.frequent_ngrams(df, lengths)
        shared |= {name: {"counts": counts} for name in OF_NGRAMS}
    return {name: TABLES[name](df, **shared.get(name, {})) for name in names}
