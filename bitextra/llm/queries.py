"""One query for each operator of this subpackage, over its whole table, and SQL where SQL can tell the same rows."""

from __future__ import annotations

import hashlib

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import LongType, StringType, StructField

from . import (
    alignment, bpe, byte_queries, cotraining, credentials, jaccard_forest, llr_rules, mixing, mtree, token_codes, toxicity,
    warc, whitening,
)
from .common import add_columns

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
PIECES = public_tokenizers.path("piece_bpe_32k.model")
END_ID = 2


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_quality_cotraining(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = cotraining.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return scored.select("doc_id", "text_score", "page_score", "score", "kept")


def op2_toxicity_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = toxicity.score(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "labels"))
    return scored.select("doc_id", "held_out", "score", "predicted")


def op3_token_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = token_codes.new_token_folder(spark)
    manifest = token_codes.write_tokens(table(spark, sf_dir, "documents"), VOCABULARY, folder, END_ID)
    return token_codes.read_tokens(manifest, folder, ids=False)


def op4_llr_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = llr_rules.judge(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "labels"))
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "llr"
    )


def op5_warc_zstd(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = warc.new_archive_folder(spark)
    manifest = warc.write_archives(table(spark, sf_dir, "pages"), folder)
    rows = warc.read_archives(manifest, folder, payload=False)
    return rows.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op6_credentials(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = credentials.find_secrets(table(spark, sf_dir, "documents").select("doc_id", "text"), spans="found").drop("text")
    of = lambda *kinds: F.filter("found", lambda s: s["kind"].isin(*kinds))
    listed = lambda spans: F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ","
    )
    return found.select(
        "doc_id",
        *[F.size(of(k)).cast("long").alias(f"n_{k}") for k in credentials.BASE],
        F.sha2(listed(of(*credentials.BASE)), 256).alias("base_sha256"),
        listed(F.col("found")).alias("spans"),
    )


def op7_mixing_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    decided = mixing.decide(table(spark, sf_dir, "documents").select("doc_id", "text", "source"))
    return decided.select("doc_id", "size", "source_size", "target", "taken")


def op8_bpe_queue(spark: SparkSession, sf_dir: str) -> DataFrame:
    def start():
        encode, decode = bpe.encoder(VOCABULARY, "text", 1_200_000), bpe.decoder(VOCABULARY, "ids", 1_200_000)

        def make(batch: pa.RecordBatch) -> list[pa.Array]:
            ids = pa.RecordBatch.from_arrays(encode(batch), names=["ids"])
            counts = pa.array(np.diff(ids.column("ids").offsets.to_numpy()).astype(np.int64))
            return [counts, *sha256s(ids), *decode(ids)]

        return make

    # one Python worker encodes, decodes and digests; ids do not travel
    fields = [StructField("n_tokens", LongType()), StructField("ids_sha256", StringType()), StructField("decoded", StringType())]
    rows = add_columns(table(spark, sf_dir, "documents").select("doc_id", "text"), fields, start)
    return rows.select("doc_id", "n_tokens", "ids_sha256", F.sha2("decoded", 256).alias("decoded_sha256"))


def op9_mtree_top5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mtree.top_k(table(spark, sf_dir, "embeddings"))


def op10_jaccard_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = jaccard_forest.classes(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return rows.select("doc_id", "class_id", "n_links", "n_text_links")


def op11_byte_queries(spark: SparkSession, sf_dir: str) -> DataFrame:
    def start():
        memo, pattern = 1_000_000, public_tokenizers.PATTERN
        encode, decode = byte_queries.encoder(RANKS, pattern, "text", memo), byte_queries.decoder(RANKS, pattern, "ids", memo)
        decimals = [str(i) for i in range(max(byte_queries.read_ranks(RANKS).values()) + 1)]

        def make(batch: pa.RecordBatch) -> list[pa.Array]:
            ids = pa.RecordBatch.from_arrays(encode(batch), names=["ids"])
            ends = ids.column("ids").offsets.to_numpy()
            words = [decimals[i] for i in ids.column("ids").values.to_numpy().tolist()]
            listed = [",".join(words[a:b]).encode() for a, b in zip(ends[:-1].tolist(), ends[1:].tolist())]
            digests = [[hashlib.sha256(x).hexdigest() for x in some] for some in (listed, decode(ids)[0].to_pylist())]
            return [pa.array(np.diff(ends).astype(np.int64)), *[pa.array(d, pa.string()) for d in digests]]

        return make

    # one Python worker encodes, decodes and digests; ids do not travel
    fields = [StructField("n_tokens", LongType()), StructField("ids_sha256", StringType()), StructField("decoded_sha256", StringType())]
    return add_columns(table(spark, sf_dir, "documents").select("doc_id", "text"), fields, start).drop("text")


def op12_bit_sliced_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, model = whitening.whiten(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))
    explained = F.array(*[F.lit(x).cast("double") for x in (model.explained if model else [])]).cast("array<double>")
    return rows.select("vec_id", "n", "deviation", F.posexplode("whitened").alias("at", "whitened")).select(
        "vec_id", (F.col("at") + 1).alias("component"), "n", "deviation", "whitened",
        F.get(explained, F.col("at")).alias("explained"), F.lit(model.identity_error if model else 0.0).alias("identity_error"),
    )


def op13_diagonal_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.align_documents(table(spark, sf_dir, "documents").select("doc_id", "text"), VOCABULARY, PIECES)[0]


def _codes(batch: pa.RecordBatch) -> list[bytes]:
    """Ids of each row as little-endian unsigned 32-bit integers."""
    column = batch.column("ids")
    ends, values = column.offsets.to_numpy(), column.values.to_numpy(zero_copy_only=False).astype("<u4")
    return [values[a:b].tobytes() for a, b in zip(ends[:-1], ends[1:])]


def sha256s(batch: pa.RecordBatch) -> list[pa.Array]:
    return [pa.array([hashlib.sha256(c).hexdigest() for c in _codes(batch)], pa.string())]


QUERIES = {
    f.__name__: f
    for f in (
        op1_quality_cotraining, op2_toxicity_trees, op3_token_codes, op4_llr_rules, op5_warc_zstd,
        op6_credentials, op7_mixing_tree, op8_bpe_queue, op9_mtree_top5, op10_jaccard_forest,
        op11_byte_queries, op12_bit_sliced_whitening, op13_diagonal_alignment,
    )
}

SQL = {
    "op9_mtree_top5": r"""
WITH v AS (
  SELECT DISTINCT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id, CAST(list_inner_product(q.e, c.e) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS n FROM s)
SELECT query_id, CAST(n AS INTEGER) AS rank, vec_id, score FROM r WHERE n <= 5
""",
    "op10_jaccard_forest": r"""
WITH RECURSIVE w AS (
  SELECT doc_id, md5(coalesce(text, '')) AS k,
    list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws
  FROM documents),
s AS (
  SELECT DISTINCT doc_id, unnest(CASE
    WHEN len(ws) >= 5 THEN list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' '))
    WHEN len(ws) > 0 THEN [array_to_string(ws, ' ')] ELSE [] END) AS run
  FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.run = b.run AND a.doc_id <> b.doc_id GROUP BY 1, 2),
l AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 5 * c >= 4 * (x.n + y.n - c)),
reach(a, b) AS (SELECT a, b FROM l UNION SELECT reach.a, l.b FROM reach JOIN l ON reach.b = l.a),
c AS (SELECT a, min(b) AS b FROM reach GROUP BY a),
t AS (SELECT l.a, count(*) AS n_links, count(DISTINCT y.k) FILTER (WHERE y.k <> x.k) AS n_text_links
  FROM l JOIN w x ON x.doc_id = l.a JOIN w y ON y.doc_id = l.b GROUP BY l.a)
SELECT w.doc_id, coalesce(least(c.b, w.doc_id), w.doc_id) AS class_id,
  coalesce(t.n_links, 0) AS n_links, coalesce(t.n_text_links, 0) AS n_text_links
FROM w LEFT JOIN c ON c.a = w.doc_id LEFT JOIN t ON t.a = w.doc_id
""",
}
