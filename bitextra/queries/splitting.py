from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import contamination as C, dedup
from ..operators.sampling import sample_stratified
from ..plans import split as S
from ..sources.paths import Collections
from ..sources.readers import read_collection
from .base import digest, from_pairs, pairs, query, scratch, texts, words

# --- documents divided into a protected source (a quarter) and a target by md5 of the id ---

SIDES = "src AS (SELECT * FROM documents WHERE md5(CAST(doc_id AS VARCHAR)) < '4'), tgt AS (SELECT * FROM documents WHERE md5(CAST(doc_id AS VARCHAR)) >= '4')"
METHODS = {
    "exact_match": {"columns": ["text", "lang"]},
    "near_duplicate": {"columns": ["text", "lang"], "minhash_params": {"num_perm": 128, "threshold": 0.9}},
}


def _sides(spark, sf):
    docs = texts(spark, sf, "documents").withColumn("_h", F.md5(F.col("doc_id").cast("string")))
    return docs.where(F.col("_h") < "4").drop("_h"), docs.where(F.col("_h") >= "4").drop("_h")


def _flagged(spark, sf, methods=None):
    source, target = _sides(spark, sf)
    return source, C.flag_contamination(source, target, methods or METHODS, key="doc_id")


def joined(cols: list[str], alias: str = "") -> str:
    p = f"{alias}." if alias else ""
    return "md5(concat_ws('|', " + ", ".join(f"coalesce({p}{c}, '')" for c in cols) + "))"


def bands_cte(name: str, src: str, cols: list[str], b: int = 5, r: int = 25) -> str:
    """{name}(d, band) for the distinct contents of src, and its helper tables."""
    text = " || ' ' || ".join(f"coalesce({c}, '')" for c in cols)
    minima = ", ".join(f"min((h * {a} + {c}) % 2147483647) AS m{i}" for i, (a, c) in enumerate(C.coefficients(b * r)))
    bands = ", ".join(
        f"'{j}:' || md5(concat_ws(',', " + ", ".join(f"m{j * r + i}" for i in range(r)) + "))" for j in range(b)
    )
    return f"""{name}_w AS (SELECT DISTINCT {digest(*cols)} AS d, unnest({words(text)}) AS w FROM {src}),
{name}_s AS (SELECT d, {minima} FROM (SELECT d, CAST(CAST('0x' || substr(md5(w), 1, 7) AS UBIGINT) AS BIGINT) AS h FROM {name}_w) GROUP BY d),
{name} AS (SELECT d, unnest([{bands}]) AS band FROM {name}_s)"""


def flags_cte(name: str, src: str, tgt: str, cols: list[str]) -> str:
    return f"""{bands_cte(name + '_a', src, cols)}, {bands_cte(name + '_b', tgt, cols)},
{name} AS (SELECT t.*, {joined(cols, 't')} IN (SELECT {joined(cols)} FROM {src}) AS is_exact,
 {digest(*[f't.{c}' for c in cols])} IN (SELECT d FROM {name}_b WHERE band IN (SELECT band FROM {name}_a)) AS is_near FROM {tgt} t)"""


_FLAGS = flags_cte("flagged", "src", "tgt", ["text", "lang"])


@query(
    "exact_contamination",
    f"WITH {SIDES} SELECT doc_id, {joined(['text', 'lang'], 't')} IN (SELECT {joined(['text', 'lang'])} FROM src) AS is_exact FROM tgt t",
)
def _(spark, sf):
    _, flagged = _flagged(spark, sf, {**METHODS, "near_duplicate": {"enabled": False}})
    return flagged.select("doc_id", "is_exact")


@query("near_duplicate_contamination", f"WITH {SIDES}, {_FLAGS} SELECT doc_id, is_near FROM flagged")
def _(spark, sf):
    _, flagged = _flagged(spark, sf, {**METHODS, "exact_match": {"enabled": False}})
    return flagged.select("doc_id", "is_near")


def _near_only(**near):
    return {"exact_match": {"enabled": False}, "near_duplicate": {**METHODS["near_duplicate"], **near}}


def _prints(name: str, src: str) -> str:
    """{name}(d, p): fingerprint of every different content of src."""
    bits = " + ".join(f"CASE WHEN sum(CASE WHEN (h >> {j}) & 1 = 1 THEN 1 ELSE -1 END) > 0 THEN {1 << j}::HUGEINT ELSE 0 END" for j in range(64))
    return f"""{name}_w AS (SELECT d, unnest({words("coalesce(text, '') || ' ' || coalesce(lang, '')")}) AS w
  FROM (SELECT {digest('text', 'lang')} AS d, any_value(text) AS text, any_value(lang) AS lang FROM {src} GROUP BY 1)),
{name} AS (SELECT d, CAST({bits} AS UBIGINT) AS p FROM (SELECT d, CAST('0x' || substr(md5(w), 1, 16) AS UBIGINT) AS h FROM {name}_w) GROUP BY d)"""


@query(
    "simhash_contamination",
    f"""WITH {SIDES}, {_prints('fs', 'src')}, {_prints('ft', 'tgt')},
    hit AS (SELECT DISTINCT ft.d FROM ft JOIN fs ON bit_count(xor(ft.p, fs.p)) <= 3)
    SELECT doc_id, {digest('t.text', 't.lang')} IN (SELECT d FROM hit) AS is_near FROM tgt t""",
)
def _(spark, sf):
    return _flagged(spark, sf, _near_only(algorithm="simhash"))[1].select("doc_id", "is_near")


@query(
    "verified_contamination",
    f"""WITH {SIDES}, {bands_cte('ba', 'src', ['text', 'lang'])}, {bands_cte('bb', 'tgt', ['text', 'lang'])},
    cand AS (SELECT DISTINCT bb.d AS t, ba.d AS s FROM bb JOIN ba USING (band)),
    both_w AS (SELECT t, s, count(*) AS n FROM cand JOIN bb_w ON bb_w.d = t JOIN ba_w ON ba_w.d = s AND ba_w.w = bb_w.w GROUP BY ALL),
    nt AS (SELECT d, count(*) AS n FROM bb_w GROUP BY d), ns AS (SELECT d, count(*) AS n FROM ba_w GROUP BY d),
    hit AS (SELECT DISTINCT t FROM both_w JOIN nt ON nt.d = t JOIN ns ON ns.d = s
      WHERE CAST(both_w.n AS DOUBLE) / (nt.n + ns.n - both_w.n) >= CAST(0.9 AS DOUBLE))
    SELECT doc_id, {digest('g.text', 'g.lang')} IN (SELECT t FROM hit) AS is_near FROM tgt g""",
)
def _(spark, sf):
    near = _near_only(minhash_params={"num_perm": 128, "threshold": 0.9, "verify": True})
    return _flagged(spark, sf, near)[1].select("doc_id", "is_near")


@query(
    "embedding_contamination",
    """WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS e, md5(CAST(vec_id AS VARCHAR)) < '4' AS protected
      FROM embeddings),
    ok AS (SELECT * FROM v WHERE e IS NOT NULL AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0
      AND len(list_filter(e, lambda x: x <> 0)) > 0),
    hit AS (SELECT DISTINCT t.vec_id FROM ok t JOIN ok s ON s.protected AND NOT t.protected AND len(s.e) = len(t.e)
      AND list_cosine_similarity(t.e, s.e) >= CAST(0.8 AS DOUBLE))
    SELECT vec_id, vec_id IN (SELECT vec_id FROM hit) AS is_near FROM v WHERE NOT protected""",
)
def _(spark, sf):
    rows = texts(spark, sf, "embeddings").withColumn("_h", F.md5(F.col("vec_id").cast("string")))
    source, target = rows.where(F.col("_h") < "4").drop("_h"), rows.where(F.col("_h") >= "4").drop("_h")
    near = _near_only(algorithm="embeddings", embedding_params={"threshold": 0.8, "bits": 10})
    return C.flag_contamination(source, target, near, key="vec_id").select("vec_id", "is_near")


@query("contamination_flags", f"WITH {SIDES}, {_FLAGS} SELECT doc_id, is_exact, is_near FROM flagged")
def _(spark, sf):
    return _flagged(spark, sf)[1].select("doc_id", "is_exact", "is_near")


@query("decontaminated_rows", f"WITH {SIDES}, {_FLAGS} SELECT doc_id, text FROM flagged WHERE NOT is_exact AND NOT is_near")
def _(spark, sf):
    clean, _ = C.divide_contaminated(_flagged(spark, sf)[1])
    return clean.select("doc_id", "text")


_REPORT = """rep AS (SELECT (SELECT count(*) FROM src) AS source_size, count(*) AS target_size,
 count(*) FILTER (is_exact) AS exact_matches, count(*) FILTER (is_near) AS near_duplicates,
 count(*) FILTER (is_exact OR is_near) AS total_contaminated FROM flagged)"""


@query(
    "contamination_report",
    f"""WITH {SIDES}, {_FLAGS}, {_REPORT} SELECT 'protected' AS source_split, 'train' AS target_split, *,
    printf('%.2f%%', CAST(total_contaminated AS DOUBLE) / target_size * 100) AS contamination_rate FROM rep""",
)
def _(spark, sf):
    source, flagged = _flagged(spark, sf)
    return C.contamination_report([C.contamination_stats(source, flagged, "protected", "train")])


@query(
    "contamination_table",
    f"""WITH {SIDES}, {_FLAGS}, {_REPORT} SELECT 'protected→train' AS "check", target_size - total_contaminated AS clean,
    total_contaminated AS contaminated FROM rep""",
)
def _(spark, sf):
    source, flagged = _flagged(spark, sf)
    return C.contamination_table(C.contamination_report([C.contamination_stats(source, flagged, "protected", "train")]))


# --- duplicates within the documents ---


@query("drop_duplicate_texts", "SELECT min(doc_id) AS doc_id, text FROM documents GROUP BY text")
def _(spark, sf):
    docs = texts(spark, sf, "documents").select("doc_id", "text")
    return dedup.drop_duplicates(docs, ["text"], "doc_id")


@query(
    "list_duplicate_texts",
    "SELECT doc_id, text FROM (SELECT *, row_number() OVER (PARTITION BY text ORDER BY doc_id) AS r FROM documents) WHERE r > 1",
)
def _(spark, sf):
    docs = texts(spark, sf, "documents").select("doc_id", "text")
    return dedup.list_duplicates(docs, ["text"], "doc_id")


# --- whole split jobs over the pairs ---

SPLIT_SPEC = {
    "splits": {
        "train": {"sources": [{"artifact": "pairs:v1", "percentage": 80, "seed": 42}]},
        "valid": {"sources": [{"artifact": "pairs:v1", "percentage": 60, "seed": 7}]},
        "test": {"sources": [{"artifact": "held_out:latest", "percentage": 100}]},
    },
    "contamination_check": {
        "enabled": True,
        "check_pairs": [
            {"source": "test", "target": "train", "action": "remove_from_target"},
            {"source": "valid", "target": "train", "action": "warn_only"},
        ],
        "methods": {
            "exact_match": {"enabled": True, "columns": ["en", "ka"]},
            "near_duplicate": {
                "enabled": True,
                "columns": ["en", "ka"],
                "minhash_params": {"num_perm": 128, "threshold": 0.9},
            },
        },
    },
    "settings": {"stratify_by_domain": True, "min_samples_per_domain": 10},
}


def _strat(pct: int, seed: int, name: str, artifact: str = "pairs:v1") -> str:
    return f"""{name} AS (SELECT title, ka, en, domain, id, '{artifact}' AS source_artifact FROM (SELECT *,
 row_number() OVER (PARTITION BY domain ORDER BY md5('{seed}|' || id), id) AS r, count(*) OVER (PARTITION BY domain) AS n FROM pairs)
 WHERE r <= least(n, greatest(10, CAST(floor(n * CAST({pct} AS DOUBLE) / 100) AS BIGINT))))"""


_SPLITS = f"""{_strat(80, 42, 'train')}, {_strat(60, 7, 'valid')},
test AS (SELECT title, ka, en, domain, id, 'held_out:latest' AS source_artifact FROM pairs WHERE id LIKE 'de%')"""
_F1 = flags_cte("f1", "test", "train", ["en", "ka"])
_CLEAN = "train2 AS (SELECT title, ka, en, domain, id, source_artifact FROM f1 WHERE NOT is_exact AND NOT is_near)"
_F2 = flags_cte("f2", "valid", "train2", ["en", "ka"])
_TAGGED = """tagged AS (SELECT *, 'train' AS split FROM train2 UNION ALL SELECT *, 'valid' FROM valid
 UNION ALL SELECT *, 'test' FROM test)"""


def _load(spark, sf):
    """The pairs as stored collections, as a split job finds them."""
    root, base = scratch(spark), pairs(spark, sf)
    base.write.parquet(f"{root}/pairs/v1/all.parquet")
    stored = spark.read.parquet(f"{root}/pairs/v1/all.parquet")
    stored.where(F.col("id").startswith("de")).write.parquet(f"{root}/held_out/v1/all.parquet")
    collections = Collections(spark, root)
    return lambda ref: read_collection(collections, ref)


def _splits(spark, sf):
    built = S.build_splits(SPLIT_SPEC, _load(spark, sf))
    return S.decontaminate(built, SPLIT_SPEC["contamination_check"])


@query("stratified_sample", from_pairs("SELECT id, domain FROM train", _strat(80, 42, "train")))
def _(spark, sf):
    return sample_stratified(pairs(spark, sf), 80, ["id"], 42).select("id", "domain")


@query(
    "build_splits",
    from_pairs(
        "SELECT 'train' AS split, id, source_artifact FROM train UNION ALL SELECT 'valid', id, source_artifact FROM valid "
        "UNION ALL SELECT 'test', id, source_artifact FROM test",
        _SPLITS,
    ),
)
def _(spark, sf):
    return S.tagged(S.build_splits(SPLIT_SPEC, _load(spark, sf))).select("split", "id", "source_artifact")


@query("leak_free_splits", from_pairs("SELECT split, id, en, ka FROM tagged", f"{_SPLITS}, {_F1}, {_CLEAN}, {_TAGGED}"))
def _(spark, sf):
    return S.tagged(_splits(spark, sf)[0]).select("split", "id", "en", "ka")


@query(
    "split_contamination_report",
    from_pairs(
        " UNION ALL ".join(
            f"""SELECT '{s}' AS source_split, 'train' AS target_split, (SELECT count(*) FROM {s}) AS source_size, count(*) AS target_size,
            count(*) FILTER (is_exact) AS exact_matches, count(*) FILTER (is_near) AS near_duplicates,
            count(*) FILTER (is_exact OR is_near) AS total_contaminated,
            printf('%.2f%%', coalesce(CAST(count(*) FILTER (is_exact OR is_near) AS DOUBLE) / count(*), 0) * 100) AS contamination_rate FROM {f}"""
            for s, f in (("test", "f1"), ("valid", "f2"))
        ),
        f"{_SPLITS}, {_F1}, {_CLEAN}, {_F2}",
    ),
)
def _(spark, sf):
    return _splits(spark, sf)[1]


def _tagged_built(spark, sf):
    return S.tagged(S.build_splits(SPLIT_SPEC, _load(spark, sf)))


_BUILT = _SPLITS + ", " + _TAGGED.replace("FROM train2", "FROM train")


@query(
    "split_stats",
    from_pairs(
        """SELECT split, count(*) AS size, count(DISTINCT source_artifact) AS unique_sources, count(DISTINCT domain) AS num_domains,
        round(count(*) * CAST(100 AS DOUBLE) / sum(count(*)) OVER (), 6) AS percentage FROM tagged GROUP BY split""",
        _BUILT,
    ),
)
def _(spark, sf):
    return S.split_stats(_tagged_built(spark, sf)).withColumn("percentage", F.round("percentage", 6))


@query(
    "split_domain_distribution",
    from_pairs(
        """SELECT split, domain, count(*) AS count,
        round(count(*) * CAST(100 AS DOUBLE) / sum(count(*)) OVER (PARTITION BY split), 6) AS percentage FROM tagged GROUP BY split, domain""",
        _BUILT,
    ),
)
def _(spark, sf):
    return S.domain_distribution(_tagged_built(spark, sf)).withColumn("percentage", F.round("percentage", 6))


_COUNTS = "count(*) FILTER (split = 'train') AS train, count(*) FILTER (split = 'valid') AS valid, count(*) FILTER (split = 'test') AS test"


@query(
    "split_domain_pivot",
    from_pairs(f"SELECT domain, {_COUNTS}, count(*) AS total FROM tagged GROUP BY domain ORDER BY total DESC, domain LIMIT 10", _BUILT),
)
def _(spark, sf):
    return S.domain_pivot(_tagged_built(spark, sf), ["train", "valid", "test"])


@query("split_source_pivot", from_pairs(f"SELECT source_artifact, {_COUNTS} FROM tagged GROUP BY source_artifact", _BUILT))
def _(spark, sf):
    return S.source_pivot(_tagged_built(spark, sf), ["train", "valid", "test"])
