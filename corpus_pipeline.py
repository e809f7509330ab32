"""From raw documents to token ids: quality, near duplicates, secrets, mixture, BPE.

`run` writes the result of every stage to the shared folder (spark.checkpoint.dir) and gives
the next stage what it reads from there. All stages but the last return the columns of
`documents`. NULLs, empty texts and tables, repeated rows and clashing names are treated as the
docstrings of the operators say.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from bitextra.llm import bpe, cotraining, credentials, jaccard_forest, mixing
from bitextra.llm.common import carried, settle

#: What the stages read; all other columns travel untouched, whatever their names.
NEEDED = ["doc_id", "text", "lang", "source", "n_chars"]
VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the co-trained classifier does not reject."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    names = [c for c in NEEDED if c in docs.columns]
    judge = lambda rows: cotraining.classify(rows, labels).where("kept").select(*rows.columns)
    return carried(docs, names, judge).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document of every class of near duplicates."""
    return jaccard_forest.keep_first(docs)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with every secret replaced by a mark; n_chars follows the text."""

    def clean(rows: DataFrame) -> DataFrame:
        done = credentials.redact(rows.withColumn("_length", F.length("text")))
        changed = F.length("text") != F.col("_length")
        return done.withColumn("n_chars", F.when(changed, F.length("text")).otherwise(F.col("n_chars"))).select(*rows.columns)

    return carried(docs, NEEDED, clean).select(*docs.columns)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix by source weights: a row for every draw of a document, shard by shard."""
    return carried(docs, NEEDED, lambda rows: mixing.mix(rows).select(*rows.columns)).select(*docs.columns)


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every text, and whether decoding them gives the text again."""
    coded = bpe.encode_and_decode(docs.select("doc_id", "lang", "source", "text"), VOCABULARY, memo=200_000)
    same = F.col("decoded") == F.coalesce(F.col("text"), F.lit(""))
    return coded.select("doc_id", "lang", "source", F.size("ids").cast("long").alias("n_tokens"), same.alias("round_trip"), "ids")


STAGES = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("secrets", secrets),
    ("mixture", mixture),
    ("encoding", encoding),
]

#: The classifier, the hashes of the mixture and BPE are beyond SQL; tests compare with plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = settle(stage(spark, docs, sf_dir), name)
    return docs
