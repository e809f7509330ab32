from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from ..plans import clean, load, split as S
from ..schema import null_counts
from ..sources import paths, readers as R, writers as W
from ..streaming.ingest import clean_stream, start_ingest
from .base import from_pairs, pairs, query, scratch, table
from .cleaning import CLEAN_CTE, CLEAN_SPEC, _RATE, _STATS_SQL
from .splitting import _CLEAN, _F1, _SPLITS, _TAGGED, SPLIT_SPEC, _load


@query("read_datasets", "SELECT 'documents' AS dataset, count(*) AS rows, count(*) - 1 AS last_row FROM documents")
def _(spark, sf):
    rows = R.read_datasets(spark, f"{sf}/documents.parquet", positions=True)
    return rows.groupBy("dataset").agg(F.count(F.lit(1)).alias("rows"), F.max("row_pos").alias("last_row"))


def _collection(spark, sf):
    root = scratch(spark)
    base = pairs(spark, sf)
    # v1 holds what is not French, v2 everything
    for version, sides in (("v1", ("de", "rest")), ("v2", ("de", "fr", "rest"))):
        for side in sides:
            prefix = F.substring("id", 1, 2)
            of_side = ~prefix.isin("de", "fr") if side == "rest" else prefix == side
            base.where(of_side).write.parquet(f"{root}/raw/{version}/{side}_part.parquet")
    return paths.Collections(spark, root)


@query(
    "read_collection",
    from_pairs(
        """SELECT 'raw:v1' AS source_artifact, part AS source_file, id FROM parts WHERE part <> 'fr_part'
        UNION ALL SELECT 'raw:latest', part, id FROM parts""",
        "parts AS (SELECT id, CASE WHEN id LIKE 'de%' THEN 'de_part' WHEN id LIKE 'fr%' THEN 'fr_part' ELSE 'rest_part' END AS part FROM pairs)",
    ),
)
def _(spark, sf):
    collections = _collection(spark, sf)
    both = [R.read_collection(collections, ref) for ref in ("raw:v1", "raw:latest")]
    return reduce(DataFrame.unionByName, both).select("source_artifact", "source_file", "id")


@query(
    "read_for_profile",
    from_pairs("SELECT id, 'all' AS source_dataset FROM (SELECT *, row_number() OVER (ORDER BY md5('42|' || id), id) AS r FROM pairs) WHERE r <= 100"),
)
def _(spark, sf):
    root = scratch(spark)
    pairs(spark, sf).write.parquet(f"{root}/all.parquet")
    return R.read_for_profile(spark, root, limit=100).select("id", "source_dataset")


@query("load_parallel", from_pairs("SELECT title, ka, en, domain, id FROM pairs"))
def _(spark, sf):
    root = scratch(spark)
    pairs(spark, sf).drop("title").withColumnRenamed("en", "english").write.parquet(f"{root}/train")
    return R.load_parallel(spark, root, "train", {"english": "en"})


def _mono(docs: DataFrame, text) -> DataFrame:
    return docs.select(
        F.col("doc_id").alias("id"), F.col("source").alias("domain"), F.col("lang").alias("topic"), text.alias("text"), F.col("doc_id").alias("row_pos")
    )


_ALIGNED = """SELECT CAST(NULL AS VARCHAR) AS title, md5(text) AS ka, text AS en, lang AS domain,
 source || '_' || CAST(doc_id AS VARCHAR) AS id FROM documents"""


@query("load_aligned_by_key", _ALIGNED)
def _(spark, sf):
    docs = table(spark, sf, "documents")
    return R.load_aligned(_mono(docs, F.col("text")), _mono(docs, F.md5("text")), "id")


@query("load_aligned_by_position", _ALIGNED)
def _(spark, sf):
    docs = table(spark, sf, "documents")
    return R.load_aligned(_mono(docs, F.col("text")), _mono(docs, F.md5("text")), None)


_NUMBERED = """SELECT CAST(NULL AS VARCHAR) AS title, lang AS ka, text AS en, {domain} AS domain,
 '{prefix}_' || CAST(row_number() OVER (ORDER BY doc_id) - 1 AS VARCHAR) AS id FROM documents"""


@query("load_csv", _NUMBERED.format(domain="source", prefix="custom"))
def _(spark, sf):
    root = scratch(spark)
    rows = table(spark, sf, "documents").orderBy("doc_id")
    named = rows.select(F.col("lang").alias("georgian_text"), F.col("text").alias("english_text"), F.col("source").alias("category"))
    named.write.option("header", True).option("quoteAll", True).option("escape", '"').csv(root)
    return R.load_csv(spark, root)


@query("load_json", _NUMBERED.format(domain="'general'", prefix="docs"))
def _(spark, sf):
    root = scratch(spark)
    rows = table(spark, sf, "documents").orderBy("doc_id")
    rows.select(F.col("lang").alias("ka_text"), F.col("text").alias("en_text")).write.json(root)
    return R.load_json(spark, root, name="docs", multiline=False)


@query(
    "null_counts",
    from_pairs(
        "SELECT count(*) FILTER (ka IS NULL) AS null_ka, count(*) FILTER (en IS NULL) AS null_en, count(*) FILTER (id IS NULL) AS null_id, "
        "count(*) FILTER (title IS NULL) AS null_title FROM pairs"
    ),
)
def _(spark, sf):
    return null_counts(pairs(spark, sf), ("ka", "en", "id", "title"))


@query("write_datasets", from_pairs("SELECT domain || '_cleaned' AS dataset, id, en, ka FROM pairs"))
def _(spark, sf):
    root = scratch(spark)
    W.write_datasets(pairs(spark, sf).withColumn("dataset", F.col("domain")), root, "_cleaned")
    return R.read_datasets(spark, root).select("dataset", "id", "en", "ka")


@query(
    "write_and_read_splits",
    from_pairs("SELECT CASE substr(id, 1, 2) WHEN 'fr' THEN 'train' WHEN 'de' THEN 'valid' ELSE 'test' END AS split, id FROM pairs"),
)
def _(spark, sf):
    root, base = scratch(spark), pairs(spark, sf)
    lang = {"train": "fr", "valid": "de", "test": "es"}
    W.write_splits({s: base.where(F.col("id").startswith(x)) for s, x in lang.items()}, root)
    return R.read_splits(spark, root).select("split", "id")


@query(
    "run_load",
    from_pairs("SELECT 'corpus' AS dataset, count(*) AS rows FROM pairs UNION ALL SELECT 'aligned', count(*) FROM documents"),
)
def _(spark, sf):
    root = scratch(spark)
    pairs(spark, sf).write.parquet(f"{root}/in/train")
    docs = table(spark, sf, "documents")
    _mono(docs, F.col("text")).write.parquet(f"{root}/mono/eng_Latn/devtest")
    _mono(docs, F.md5("text")).write.parquet(f"{root}/mono/kat_Geor/devtest")
    spec = {
        "datasets": [
            {"name": "corpus", "loader_function": "load_en_ka_corpora", "source": f"{root}/in", "split": "train"},
            {"name": "aligned", "loader_function": "load_flores_devtest", "source": f"{root}/mono"},
            {"name": "off", "loader_function": "load_custom_csv", "source": "none", "enabled": False},
        ]
    }
    report = load.run_load(spark, spec, f"{root}/out")
    return R.read_datasets(spark, f"{root}/out").groupBy("dataset").agg(F.count(F.lit(1)).alias("rows")).where(
        F.col("dataset").isin(list(report))
    )


@query(
    "run_cleaning",
    from_pairs(
        f"SELECT dataset, is_total, step, cleaner, original, cleaned, dropped, {_RATE} FROM stats", f"{CLEAN_CTE}, {_STATS_SQL}"
    ),
)
def _(spark, sf):
    stats = clean.run_cleaning(pairs(spark, sf).withColumn("dataset", F.col("domain")), CLEAN_SPEC, scratch(spark))
    return stats.withColumn("retention", F.round("retention", 6))


@query(
    "run_splitting",
    from_pairs(
        """SELECT split, count(*) AS size, count(DISTINCT source_artifact) AS unique_sources, count(DISTINCT domain) AS num_domains,
        round(count(*) * CAST(100 AS DOUBLE) / sum(count(*)) OVER (), 6) AS percentage FROM tagged GROUP BY split""",
        f"{_SPLITS}, {_F1}, {_CLEAN}, {_TAGGED}",
    ),
)
def _(spark, sf):
    root = scratch(spark)
    S.run_splitting(SPLIT_SPEC, _load(spark, sf), root)
    return S.split_stats(R.read_splits(spark, root)).withColumn("percentage", F.round("percentage", 6))


@query(
    "streaming_ingest",
    """WITH s AS (SELECT length(trim(text, chr(32) || chr(10) || chr(9) || chr(13))) >= 200 AS ok, lower(text) AS low, text, lang, row_number() OVER (PARTITION BY lower(text), lang,
      length(trim(text, chr(32) || chr(10) || chr(9) || chr(13))) >= 200 ORDER BY doc_id) AS r FROM documents)
    SELECT CASE WHEN ok THEN 'kept' ELSE 'dropped' END AS status, low AS text, lang, count(*) AS rows FROM s
    WHERE NOT ok OR r = 1 GROUP BY ALL""",
)
def _(spark, sf):
    """The documents as a file stream: short ones dropped, the others once each in lower case."""
    root = scratch(spark)
    rows = table(spark, sf, "documents").select(
        F.lit(None).cast("string").alias("title"),
        F.col("lang").alias("ka"),
        F.col("text").alias("en"),
        F.col("source").alias("domain"),
        F.col("doc_id").cast("string").alias("id"),
        F.timestamp_seconds(F.col("doc_id") % 600 + 1_700_000_000).alias("ts"),
    )
    rows.repartition(4).write.parquet(f"{root}/in")
    stream = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 2).parquet(f"{root}/in")
    spec = {
        "cleaners": [{"name": "filter_minimum_length", "params": {"min_en_length": 200, "min_ka_length": 0}}],
        "preprocessors": [{"name": "lowercase_english"}],
    }
    start_ingest(clean_stream(stream, spec, "ts", "1 day"), f"{root}/out", f"{root}/state").awaitTermination()
    out = spark.read.parquet(f"{root}/out")
    return out.groupBy("status", F.col("en").alias("text"), F.col("ka").alias("lang")).agg(F.count(F.lit(1)).alias("rows"))
