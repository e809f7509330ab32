from __future__ import annotations

import pandas as pd
from pyspark.sql import functions as F

from ..functions import constants as K
from ..operators import metrics as M, scoring
from .base import from_pairs, pairs, q, query, sub, words

# Prediction: the reference in lower case without some of its words.
DROPPED = " (of|is|the) "
RULES = [(p, t.replace("$", "\\")) for p, t in M.V13A_RULES]


def _evaluation(spark, sf):
    return pairs(spark, sf).select(
        "id",
        "domain",
        F.split_part("id", F.lit("_"), F.lit(1)).alias("dataset"),
        F.col("ka").alias("source"),
        F.col("en").alias("reference"),
        F.regexp_replace(F.lower("en"), DROPPED, " ").alias("prediction"),
    )


_EVAL = f"""ev AS (SELECT id, domain, string_split(id, '_')[1] AS dataset, ka AS source, en AS reference,
 {sub('lower(en)', DROPPED, ' ')} AS prediction FROM pairs)"""


def tokens_13a(c: str) -> str:
    c = f"replace(replace(replace({c}, '<skipped>', ''), '-' || chr(10), ''), chr(10), ' ')"
    for entity, char in M.V13A_ENTITIES:
        c = f"replace({c}, {q(entity)}, {q(char)})"
    c = f"' ' || {c} || ' '"
    for pattern, to in RULES:
        c = sub(c, pattern, to)
    return words(c)


def chrf_words(c: str) -> str:
    punct = q(K.ASCII_PUNCT)
    return f"""flatten(list_transform({words(c)}, lambda w: CASE WHEN length(w) = 1 THEN [w]
     WHEN contains({punct}, right(w, 1)) THEN [left(w, length(w) - 1), right(w, 1)]
     WHEN contains({punct}, left(w, 1)) THEN [left(w, 1), substr(w, 2)] ELSE [w] END))"""


def chrf_chars(c: str) -> str:
    return f"list_filter(string_split({sub(c, K.WS + '+')}, ''), lambda x: x <> '')"


def counts_cte(families: list[str]) -> str:
    """oc(id, <order>_m, <order>_h, <order>_r) as the operator defines them."""
    token_sql = {"b": tokens_13a, "c": chrf_chars, "w": chrf_words}
    orders = [o for f in families for o in M.FAMILIES[f]]
    ctes, parts = [], []
    for kind in dict.fromkeys(k for k, _ in orders):
        fn = token_sql[kind]
        ctes.append(f"tk_{kind} AS (SELECT id, {fn('prediction')} AS h, {fn('reference')} AS r FROM ev)")
    # tokens as rows, longer n-grams by looking ahead
    for kind in dict.fromkeys(k for k, _ in orders):
        sep = "" if kind == "c" else " "
        top = max(n for k, n in orders if k == kind)
        ctes.append(
            f"""un_{kind} AS (SELECT id, side, i, x[i] AS t FROM (SELECT id, 'h' AS side, h AS x, unnest(range(1, len(h) + 1)) AS i FROM tk_{kind}
            UNION ALL SELECT id, 'r', r, unnest(range(1, len(r) + 1)) FROM tk_{kind}))"""
        )
        ahead = ", ".join(f"lead(t, {j}) OVER (PARTITION BY id, side ORDER BY i) AS t{j}" for j in range(1, top))
        ctes.append(f"ld_{kind} AS (SELECT id, side, t{', ' + ahead if ahead else ''} FROM un_{kind})")
        for n in range(1, top + 1):
            gram = "t" + "".join(f" || '{sep}' || t{j}" for j in range(1, n))
            parts.append(f"SELECT id, '{kind}{n}' AS o, side, {gram} AS g FROM ld_{kind} WHERE {f't{n - 1}' if n > 1 else 't'} IS NOT NULL")
    ctes.append("gr AS (" + " UNION ALL ".join(parts) + ")")
    ctes.append("gc AS (SELECT id, o, g, count(*) FILTER (side = 'h') AS h, count(*) FILTER (side = 'r') AS r FROM gr GROUP BY ALL)")
    sums = []
    for kind, n in orders:
        o = f"{kind}{n}"
        for name, e in (("m", "least(h, r)"), ("h", "h"), ("r", "r")):
            sums.append(f"coalesce(sum({e}) FILTER (o = '{o}'), 0)::BIGINT AS {o}_{name}0")
    ctes.append(f"pr AS (SELECT id, {', '.join(sums)} FROM ev LEFT JOIN gc USING (id) GROUP BY id)")
    cols = []
    for kind, n in orders:
        o = f"{kind}{n}"
        hyp = f"{o}_h0" if kind == "b" else f"CASE WHEN {o}_r0 > 0 THEN {o}_h0 ELSE 0 END"
        cols += [f"{o}_m0 AS {o}_m", f"{hyp} AS {o}_h", f"{o}_r0 AS {o}_r"]
    ctes.append(f"oc AS (SELECT id, {', '.join(cols)} FROM pr)")
    return ", ".join(ctes)


def bleu_sql() -> str:
    terms, zeros, total, some = [], "0", [], []
    for n in range(1, 5):
        m, h = f"b{n}_m", f"b{n}_h"
        zeros = f"({zeros} + CASE WHEN {m} = 0 THEN 1 ELSE 0 END)"
        hd = f"CAST(greatest({h}, 1) AS DOUBLE)"
        terms.append(f"ln(CASE WHEN {m} = 0 THEN 100.0::DOUBLE / (pow(2.0::DOUBLE, {zeros}) * {hd}) ELSE 100.0::DOUBLE * {m} / {hd} END)")
        total.append(f"{h} > 0")
        some.append(f"{m} > 0")
    bp = "CASE WHEN b1_h < b1_r THEN exp(1 - CAST(b1_r AS DOUBLE) / greatest(b1_h, 1)) ELSE 1.0::DOUBLE END"
    return f"CASE WHEN {' AND '.join(total)} AND ({' OR '.join(some)}) THEN {bp} * exp(({' + '.join(terms)}) / 4) ELSE 0.0::DOUBLE END"


def chrf_sql(word_order: int = 2) -> str:
    names = [f"c{n}" for n in range(1, 7)] + [f"w{n}" for n in range(1, word_order + 1)]
    both = {n: f"({n}_h > 0 AND {n}_r > 0)" for n in names}
    used = "(" + " + ".join(f"CASE WHEN {both[n]} THEN 1 ELSE 0 END" for n in names) + ")"
    p = "(" + " + ".join(f"CASE WHEN {both[n]} THEN CAST({n}_m AS DOUBLE) / greatest({n}_h, 1) ELSE 0 END" for n in names) + f") / nullif({used}, 0)"
    r = "(" + " + ".join(f"CASE WHEN {both[n]} THEN CAST({n}_m AS DOUBLE) / greatest({n}_r, 1) ELSE 0 END" for n in names) + f") / nullif({used}, 0)"
    return f"coalesce(500.0::DOUBLE * ({p}) * ({r}) / nullif(4.0::DOUBLE * ({p}) + ({r}), 0), 0.0::DOUBLE)"


def _corpus_cte(families: list[str]) -> str:
    sums = ", ".join(f"CAST(sum({c}) AS BIGINT) AS {c}" for c in M.count_columns(tuple(families)))
    return f"{_EVAL}, {counts_cte(families)}, total AS (SELECT {sums} FROM oc)"


@query("bleu_ngram_counts", from_pairs("SELECT * FROM total", _corpus_cte(["bleu"])))
def _(spark, sf):
    per_row = M.overlap_counts(_evaluation(spark, sf), ["id"], ("bleu",))
    return M.corpus_counts(per_row, ("bleu",))


@query("corpus_bleu", from_pairs(f"SELECT round({bleu_sql()}, 6) AS bleu FROM total", _corpus_cte(["bleu"])))
def _(spark, sf):
    scores = M.corpus_scores(_evaluation(spark, sf), families=("bleu",))
    return scores.select(F.round("bleu", 6).alias("bleu"))


@query("corpus_chrf", from_pairs(f"SELECT round({chrf_sql()}, 6) AS chrf FROM total", _corpus_cte(["chrf"])))
def _(spark, sf):
    scores = M.corpus_scores(_evaluation(spark, sf), families=("chrf",))
    return scores.select(F.round("chrf", 6).alias("chrf"))


_SENT = f"{_EVAL}, {counts_cte(['bleu', 'chrf'])}, sc AS (SELECT id, {bleu_sql()} AS bleu_score, {chrf_sql()} AS chrf_score FROM oc)"


@query("sentence_bleu", from_pairs(f"SELECT id, round({bleu_sql()}, 6) AS bleu_score FROM oc", f"{_EVAL}, {counts_cte(['bleu'])}"))
def _(spark, sf):
    scores = M.sentence_scores(_evaluation(spark, sf), families=("bleu",))
    return scores.withColumn("bleu_score", F.round("bleu_score", 6))


@query("sentence_chrf", from_pairs(f"SELECT id, round({chrf_sql()}, 6) AS chrf_score FROM oc", f"{_EVAL}, {counts_cte(['chrf'])}"))
def _(spark, sf):
    scores = M.sentence_scores(_evaluation(spark, sf), families=("chrf",))
    return scores.withColumn("chrf_score", F.round("chrf_score", 6))


@query(
    "scores_by_dataset_and_domain",
    from_pairs(
        f"SELECT dataset, domain, round({bleu_sql()}, 6) AS bleu, round({chrf_sql()}, 6) AS chrf FROM tot",
        f"{_EVAL}, {counts_cte(['bleu', 'chrf'])}, tot AS (SELECT dataset, domain, "
        + ", ".join(f"CAST(sum({c}) AS BIGINT) AS {c}" for c in M.count_columns(("bleu", "chrf")))
        + " FROM oc JOIN ev USING (id) GROUP BY GROUPING SETS ((dataset, domain), ()))",
    ),
)
def _(spark, sf):
    scores = M.corpus_scores(_evaluation(spark, sf), by=["dataset", "domain"], total=True)
    return scores.withColumns({c: F.round(c, 6) for c in ("bleu", "chrf")})


@query(
    "prediction_table",
    from_pairs(
        """SELECT 500 AS step, id, source, reference, prediction, round(bleu_score, 6) AS bleu_score,
        round(chrf_score, 6) AS chrf_score FROM ev JOIN sc USING (id)""",
        _SENT,
    ),
)
def _(spark, sf):
    done = M.prediction_table(_evaluation(spark, sf), 500)
    return done.withColumns({c: F.round(c, 6) for c in ("bleu_score", "chrf_score")})


_STATS = ", ".join(
    f"round({fn}({m}_score), 6) AS eval_{m}_{s}"
    for m in ("bleu", "chrf")
    for s, fn in (("mean", "avg"), ("std", "stddev_samp"), ("min", "min"), ("max", "max"))
)


@query(
    "prediction_summary",
    from_pairs(
        f"""SELECT count(*) AS eval_samples_count, round(avg(length(prediction)), 6) AS avg_prediction_length,
        round(avg(length(reference)), 6) AS avg_reference_length, round(avg(length(source)), 6) AS avg_source_length, {_STATS}
        FROM ev JOIN sc USING (id)""",
        _SENT,
    ),
)
def _(spark, sf):
    summary = M.prediction_summary(M.prediction_table(_evaluation(spark, sf), 500))
    return summary.withColumns({c: F.round(c, 6) for c, t in summary.dtypes if t == "double"})


@query(
    "combined_evaluation",
    from_pairs(
        f"SELECT round({bleu_sql()}, 6) AS sacrebleu, round({chrf_sql()}, 6) AS chrf FROM total", _corpus_cte(["bleu", "chrf"])
    ),
)
def _(spark, sf):
    scores = M.corpus_scores(_evaluation(spark, sf))
    return scores.select(F.round("bleu", 6).alias("sacrebleu"), F.round("chrf", 6).alias("chrf"))


@query(
    "score_spread",
    from_pairs(
        "SELECT domain, round(coalesce(stddev_pop(length(en)), 0), 6) AS std FROM pairs GROUP BY domain"
    ),
)
def _(spark, sf):
    lengths = pairs(spark, sf).withColumn("n", F.length("en"))
    return lengths.groupBy("domain").agg(F.round(M.population_std("n"), 6).alias("std"))


def _length_model():
    """Stands in for a neural scorer: shorter length over longer length."""

    def score(columns: list[pd.Series]) -> pd.Series:
        a, b = columns[0].str.len(), columns[1].str.len()
        return pd.concat([a, b], axis=1).min(axis=1) / pd.concat([a, b], axis=1).max(axis=1)

    return score


@query(
    "batched_model_scores",
    from_pairs("SELECT id, round(CAST(least(length(en), length(ka)) AS DOUBLE) / greatest(length(en), length(ka)), 6) AS score FROM pairs"),
)
def _(spark, sf):
    scored = scoring.score_rows(pairs(spark, sf), _length_model, ["en", "ka"], name="score")
    return scored.select("id", F.round("score", 6).alias("score"))


def _triple_model():
    """Stands in for a neural metric: prediction length over source length, at most one."""

    def score(columns: list[pd.Series]) -> pd.Series:
        source, prediction, _ = (c.str.len() for c in columns)
        return (prediction / source).clip(upper=1.0)

    return score


@query(
    "model_metric",
    from_pairs(
        """SELECT round(avg(s), 6) AS comet, round(coalesce(stddev_pop(s), 0), 6) AS comet_std FROM (
        SELECT least(CAST(length(prediction) AS DOUBLE) / length(source), 1.0::DOUBLE) AS s FROM ev)""",
        _EVAL,
    ),
)
def _(spark, sf):
    scores = M.model_score(_evaluation(spark, sf), {"load_model": _triple_model})
    return scores.select(F.round("comet", 6).alias("comet"), F.round("comet_std", 6).alias("comet_std"))
