"""Toxicity: gradient-boosted trees over dense features of a text, with isotonic calibration."""

from __future__ import annotations

import math
import re
import string

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import ArrayType, DoubleType, StructField

from .common import add_columns, carried, settle

# Insults in English, German, French and Spanish; an own choice, not a fixed value. Words that mark
# toxic training texts are learned beside it.
INSULTS = """
idiot idiots moron morons stupid loser losers pathetic disgusting trash scum worthless clown clowns
dumb dumbass fool fools imbecile retard retarded jerk bastard bitch asshole pig vermin filth garbage
ugly useless freak creep coward liar hate kill die shut
dumm dummkopf trottel arschloch schwein abschaum versager widerlich wertlos
imbécile crétin connard salaud ordure nul minable dégoûtant débile
imbécil estúpido idiota basura escoria inútil payaso asqueroso perdedor
""".split()
SECOND_PERSON = frozenset(
    "you your yours yourself u ur du dich dir dein deine ihr euch tu toi te ton ta tes vous votre vos tú ti usted tu tus su ustedes".split()
)
LEET = str.maketrans("013457@$!", "oieastasi")
FEATURES = [
    "log_words", "insult_density", "insult_count", "learned_density", "learned_count", "obfuscated_density", "distinct_insults",
    "you_density", "you_near_insult", "capital_rate", "shouted_words", "exclamations", "questions", "punctuation_rate",
    "long_runs", "mixed_words", "star_words", "spaced_letters", "distinct_share",
]

_MIXED = re.compile(r"(?<!\S)[^\W\d_]*(?:[0134578@$!*_.-]+[^\W\d_]+)+[0134578@$!*]*(?!\S)")
_RUN = re.compile(r"([^\W\d_])\1{3,}")
_SPACED = re.compile(r"(?<!\w)(?:\w[ .\-_]){3,}\w(?!\w)")
_SIGNS = re.compile(r"[^\w\s]")
_STRIP = string.punctuation + "«»“”„¡¿…"


def features(text: str, insults: frozenset[str], learned: frozenset[str], near: int = 3) -> list[float]:
    """Rates per word or character of the whole text, in the order of FEATURES."""
    if not text:
        return [0.0] * len(FEATURES)
    raw = text.split()
    words = [w.strip(_STRIP) for w in text.lower().split()]
    n, chars = max(1, len(words)), len(text)
    different = set(words)
    bad, told = different & insults, different & learned
    hits = [i for i, w in enumerate(words) if w in bad] if bad else []
    told_hits = sum(w in told for w in words) if told else 0
    mixed = _MIXED.findall(text.lower())
    hidden = sum(m not in insults and m.translate(LEET).strip(_STRIP) in insults | learned for m in mixed) if mixed else 0
    yous = [i for i, w in enumerate(words) if w in SECOND_PERSON] if different & SECOND_PERSON else []
    beside, at = 0, 0
    for h in hits:
        while at < len(yous) and yous[at] < h - near:
            at += 1
        beside += at < len(yous) and yous[at] <= h + near
    spaced = [re.sub(r"\W|_", "", m).lower() for m in _SPACED.findall(text)] if "." in text or " " in text else []
    shouted = sum(w.isupper() and len(w) > 1 for w in raw)
    return [
        math.log1p(n),
        len(hits) / n,
        math.log1p(len(hits)),
        told_hits / n,
        math.log1p(told_hits),
        hidden / n,
        float(len(bad | told)),
        len(yous) / n,
        beside / max(1, len(hits)),
        sum(map(str.isupper, text)) / chars if not text.islower() else 0.0,
        shouted / n,
        text.count("!") / n,
        text.count("?") / n,
        len(_SIGNS.findall(text)) / chars,
        len(_RUN.findall(text)) / n,
        len(mixed) / n,
        text.count("*") / n,
        sum(s in insults or s in learned for s in spaced) / n,
        len(different) / n,
    ]


def with_features(df: DataFrame, text: str, learned: list[str], column: str = "features") -> DataFrame:
    insults, extra = frozenset(INSULTS), frozenset(learned)

    def make(batch: pa.RecordBatch) -> list[pa.Array]:
        rows = [features(t or "", insults, extra) for t in batch.column(text).to_pylist()]
        values = pa.array(np.array(rows, dtype=np.float64).reshape(-1))
        return [pa.ListArray.from_arrays(pa.array(np.arange(len(rows) + 1, dtype=np.int32) * len(FEATURES)), values)]

    return add_columns(df, [StructField(column, ArrayType(DoubleType()))], lambda: make)


def remainder(doc_id: Column) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 5


def learned_words(texts: DataFrame, least: int = 5) -> list[str]:
    """All words of toxic training texts whose smoothed odds are at least ten to one, each in `least`
    toxic texts or more: the bounded sample of labelled texts bounds them."""
    word = F.explode(F.array_distinct(F.regexp_extract_all(F.lower("text"), F.lit(r"[\p{L}\p{N}@$*]+"), F.lit(0))))
    counts = texts.select("label", word.alias("w")).groupBy("w").agg(F.sum("label").alias("t"), F.count(F.lit(1)).alias("n"))
    totals = texts.agg(F.sum("label").alias("t"), F.count(F.lit(1)).alias("n")).first()
    toxic, clean = totals["t"] or 0, totals["n"] - (totals["t"] or 0)
    odds = ((F.col("t") + 0.5) / (toxic + 1)) / ((F.col("n") - F.col("t") + 0.5) / (clean + 1))
    chosen = counts.where((F.col("t") >= least) & (odds >= 10)).orderBy("w")
    return [r["w"] for r in chosen.collect()]


def score(
    df: DataFrame,
    labels: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    sample: int = 20_000,
    trees: int = 30,
    depth: int = 4,
) -> DataFrame:
    """Adds to every row: held_out, score (0 to 1), predicted (1 if score >= 0.5).

    Learns from `labels` (doc_id, toxic) of documents whose crc32(doc_id as text) mod 5 is not
    0: at most `sample` of them, those with the smallest hashes. Four fifths fit the trees, the
    rest the isotonic calibration. Only the text is read for a score; NULL and empty texts have
    all rates 0 and get their calibrated score; NULL ids are held out. Without labels of both
    kinds every score is the share of toxic labels (0 without any). Repeated rows score alike;
    columns named like new ones are replaced.
    """
    return carried(df, [doc_id, text], lambda rows: _score(rows, labels, doc_id, text, sample, trees, depth))


def _score(df: DataFrame, labels: DataFrame, doc_id: str, text: str, sample: int, trees: int, depth: int) -> DataFrame:
    known = labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & (remainder(F.col("doc_id")) != 0))
    known = known.groupBy(F.col("doc_id").alias("_l")).agg(F.max("toxic").cast("double").alias("label"))
    known = known.withColumn("_h", F.xxhash64("_l")).orderBy("_h", "_l").limit(sample)  # bounded, so it may be broadcast
    rows = df.select(F.col(doc_id).alias("_d"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    train = settle(
        rows.join(F.broadcast(known), F.col("_d") == F.col("_l")).select("text", "label", (F.pmod("_h", F.lit(5)) == 0).alias("calibrate")), "train"
    )
    fit = train.where("not calibrate")
    learned = learned_words(fit)
    table = settle(with_features(train, "text", learned).drop("text"), "features")
    kinds = table.groupBy("calibrate").agg(F.avg("label").alias("share"), F.count(F.lit(1)).alias("n")).collect()
    n = sum(k["n"] for k in kinds)
    rate = sum(k["share"] * k["n"] for k in kinds) / n if n else 0.0
    held = remainder(F.col(doc_id)) == 0
    names = ["held_out", "score", "predicted"]
    out = df.drop(*[c for c in names if c not in (doc_id, text)])
    own = out.columns
    if len(kinds) < 2 or any(k["share"] in (0.0, 1.0) for k in kinds):
        out = out.withColumns({"held_out": held, "score": F.lit(float(rate))})
        return out.withColumn("predicted", (F.col("score") >= 0.5).cast("int")).select(*own, *names)
    parts = max(1, min(8, n // 2000))
    vectors = table.select("label", "calibrate", array_to_vector("features").alias("_v"))
    boosting = GBTClassifier(
        featuresCol="_v", labelCol="label", predictionCol="_y", maxIter=trees, maxDepth=depth, stepSize=0.2, minInstancesPerNode=5,
        subsamplingRate=0.8, seed=17,
    )
    trees_model = boosting.setRawPredictionCol("_r").setProbabilityCol("_p").fit(vectors.where("not calibrate").coalesce(parts))
    raw = lambda d: trees_model.transform(d).withColumn("_raw", vector_to_array("_p")[1])
    isotonic = IsotonicRegression(featuresCol="_raw", labelCol="label", predictionCol="_s").fit(raw(vectors.where("calibrate")).select("_raw", "label"))
    # a straight line from point to point, as the calibration gives it
    scored = with_features(out.withColumn("_t", F.col(text)), "_t", learned, "_f").withColumn("_v", array_to_vector("_f"))
    scored = isotonic.transform(raw(scored))
    calibrated = F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.col("_s")))
    scored = scored.withColumns({"held_out": held, "score": calibrated})
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int")).select(*own, *names)
