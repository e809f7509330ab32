from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import constants as K, text as X
from ..operators import preprocessors as P
from ..operators.sampling import indexed
from ..plans import preprocess as plan
from ..plans.spec import Step, load_spec
from ..registry import preprocessors
from ..operators.spelling import respell
from .base import collapse, from_pairs, pairs, q, query, strip, sub, texts


def _run(name, **params):
    def fn(spark, sf):
        return preprocessors.get(name)(pairs(spark, sf), params).select("id", "en", "ka")

    return fn


def _both(sql_of):
    return from_pairs(f"SELECT id, {sql_of('en')} AS en, {sql_of('ka')} AS ka FROM pairs")


def normalize_sql(c):
    return f"replace(translate({c}, {q(K.NORMALIZE_FROM)}, {q(K.NORMALIZE_TO)}), {q(K.ELLIPSIS)}, '...')"


def squeeze_sql(c):
    return strip(sub(sub(sub(c, " {2,}", " "), "\\n{2,}", "\n"), "\\t+", " "))


def american_sql(c):
    c = collapse(c)
    for pattern, to in X.AMERICAN_RULES:
        c = sub(c, pattern, to.replace("$", "\\"))
    return c


def repair_sql(c):
    for bad, good in K.ENCODING_REPAIRS:
        c = f"replace({c}, {q(bad)}, {q(good)})"
    return collapse(f"translate({c}, {q(K.ZERO_WIDTH)}, '')")


def brackets_sql(c, kinds):
    for kind in kinds:
        c = sub(c, K.BRACKETS[kind])
    return strip(sub(c, " {2,}", " "))


query("normalize_characters", _both(normalize_sql))(_run("normalize_characters"))
query("remove_extra_whitespaces", _both(squeeze_sql))(_run("remove_extra_whitespaces"))
query("convert_to_american", from_pairs(f"SELECT id, {american_sql('en')} AS en, ka FROM pairs"))(
    _run("convert_to_american")
)
# a word list of its own, with the most frequent words of the test tables in it
RESPELLED = {"the": "thee", "thand": "thend", "and": "ande", "colour": "color", "erthe": "erth", "of": "off", "licence": "license"}
_ANY_WORD = r"\p{L}+(?:['’]\p{L}+)*"
_TABLE = "MAP {" + ", ".join(f"{q(a)}: {q(b)}" for a, b in RESPELLED.items()) + "}"


def respelled_sql(c):
    to = f"{_TABLE}[lower(w)]"
    cased = (
        f"CASE WHEN {to} IS NULL THEN w WHEN length(w) > 1 AND upper(w) = w AND lower(w) <> w THEN upper({to}) "
        f"WHEN left(w, 1) <> lower(left(w, 1)) THEN upper(left({to}, 1)) || substr({to}, 2) ELSE {to} END"
    )
    pieces = f"regexp_extract_all({c}, {q(_ANY_WORD + '|[^' + chr(92) + 'p{L}]+|.')})"
    return f"CASE WHEN {c} IS NOT NULL THEN array_to_string(list_transform({pieces}, lambda w: {cased}), '') END"


@query("respell_by_word_list", from_pairs(f"SELECT id, {respelled_sql('en')} AS en, {respelled_sql('ka')} AS ka FROM pairs"))
def _(spark, sf):
    return respell(pairs(spark, sf), ["en", "ka"], RESPELLED).select("id", "en", "ka")


@query("respell_by_join", from_pairs(f"SELECT id, {respelled_sql('en')} AS en FROM pairs"))
def _(spark, sf):
    words = spark.createDataFrame(list(RESPELLED.items()), "word string, to string")
    return respell(pairs(spark, sf), ["en"], words, most=3).select("id", "en")


query("lowercase_english", from_pairs("SELECT id, lower(en) AS en, ka FROM pairs"))(_run("lowercase_english"))
query("fix_encoding_issues", _both(repair_sql))(_run("fix_encoding_issues"))
query("remove_brackets_content", _both(lambda c: brackets_sql(c, ["()", "[]", "{}", "<>"])))(
    _run("remove_brackets_content", bracket_types=["()", "[]", "{}", "<>"])
)
query(
    "preprocess_only_some_domains",
    from_pairs(
        "SELECT id, "
        + ", ".join(
            f"CASE WHEN domain IN ('src1', 'src2') THEN {brackets_sql(c, ['()'])} ELSE {c} END AS {c}" for c in ("en", "ka")
        )
        + " FROM pairs"
    ),
)(_run("remove_brackets_content", domains=["src1", "src2"]))

# --- end punctuation ---

_TRAIL = r"""[\s\x0b\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}'"\x{201d}\x{2019}\x{bb})\]}]"""


def _core(c):
    return sub(c, f"{_TRAIL}+$")


def _mark(c):
    core = _core(c)
    return f"CASE WHEN {core} <> '' AND contains({q(K.END_MARKS)}, right({core}, 1)) THEN right({core}, 1) ELSE '' END"


def _with_mark(c, m, mark):
    body = sub(c, f"{K.WS}+$")
    core = f"c_{c}"
    bare = f"CASE WHEN {m} <> '' THEN left({core}, length({core}) - 1) ELSE {core} END"
    return f"CASE WHEN {c} = '' THEN '' ELSE {bare} || {mark} || substr({body}, length({core}) + 1) END"


_MARKED = f"m AS (SELECT *, {_mark('en')} AS me, {_mark('ka')} AS mk, {_core('en')} AS c_en, {_core('ka')} AS c_ka FROM pairs)"


def _sync_sql(prefer):
    en_rules = f"me <> '' AND (mk = '' OR (me <> mk AND {prefer == 'en'}))"
    ka_rules = f"mk <> '' AND (me = '' OR (me <> mk AND {prefer != 'en'}))"
    return f"""SELECT id, CASE WHEN {ka_rules} THEN {_with_mark('en', 'me', 'mk')} ELSE en END AS en,
    CASE WHEN {en_rules} THEN {_with_mark('ka', 'mk', 'me')} ELSE ka END AS ka FROM m"""


query("sync_punctuation", from_pairs(_sync_sql("en"), _MARKED))(_run("sync_punctuation"))
query("sync_punctuation_prefer_target", from_pairs(_sync_sql("ka"), _MARKED))(_run("sync_punctuation", prefer="ka"))


query(
    "sync_punctuation_remove_all",
    from_pairs(
        f"""SELECT id, {_with_mark('en', 'me', "''")} AS en, {_with_mark('ka', 'mk', "''")} AS ka FROM m""", _MARKED
    ),
)(_run("sync_punctuation", strategy="remove_all"))

# --- HTML ---

_HTML = sub("html", K.HTML_TAG, " ")
for _entity, _char in (("&quot;", '"'), ("&middot;", "·"), ("&copy;", "©"), ("&nbsp;", "\xa0"), ("&lt;", "<"), ("&gt;", ">"), ("&#39;", "'"), ("&amp;", "&")):
    _HTML = f"replace({_HTML}, {q(_entity)}, {q(_char)})"


@query("remove_html_tags", f"SELECT page_id, {collapse(_HTML)} AS text FROM pages")
def _(spark, sf):
    pages = texts(spark, sf, "pages")
    done = preprocessors.get("remove_html_tags")(pages, {"columns": ["html"]})
    return done.select("page_id", F.col("html").alias("text"))


@query("custom_text_function", "SELECT doc_id, replace(text, 'the', 'THE') AS text FROM documents")
def _(spark, sf):
    shout = P.row_function(lambda t: t.replace("the", "THE"))
    return P.on_columns(texts(spark, sf, "documents"), shout, "text").select("doc_id", "text")


# --- chains ---

STEPS = [
    ("normalize_characters", {}),
    ("remove_extra_whitespaces", {}),
    ("lowercase_english", {}),
    ("sync_punctuation", {}),
    ("remove_brackets_content", {}),
    ("fix_encoding_issues", {}),
]
SPEC = {"preprocessors": [{"name": n, "enabled": True, "params": p} for n, p in STEPS]}
_S1 = "s1 AS (SELECT id, domain, row_pos, {en} AS en, {ka} AS ka FROM pairs)".format(
    en=normalize_sql("en"), ka=normalize_sql("ka")
)
_S2 = f"s2 AS (SELECT id, domain, row_pos, {squeeze_sql('en')} AS en, {squeeze_sql('ka')} AS ka FROM s1)"
_S3 = "s3 AS (SELECT id, domain, row_pos, lower(en) AS en, ka FROM s2)"
_M3 = _MARKED.replace("FROM pairs)", "FROM s3)")
_S4 = f"s4 AS ({_sync_sql('en')})"
_S5 = f"s5 AS (SELECT id, {brackets_sql('en', ['()'])} AS en, {brackets_sql('ka', ['()'])} AS ka FROM s4)"
_S6 = f"s6 AS (SELECT id, {repair_sql('en')} AS en, {repair_sql('ka')} AS ka FROM s5)"
CHAIN_CTE = ", ".join([_S1, _S2, _S3, _M3, _S4, _S5, _S6])


def _steps():
    return load_spec(SPEC).enabled("preprocessors")


@query("preprocessor_chain", from_pairs("SELECT id, en, ka FROM s6", CHAIN_CTE))
def _(spark, sf):
    return plan.preprocess(pairs(spark, sf), _steps()).select("id", "en", "ka")


def _changed(a, b):
    return f"count(*) FILTER ({a}.en IS DISTINCT FROM {b}.en OR {a}.ka IS DISTINCT FROM {b}.ka)"


_PARTS = " UNION ALL ".join(
    f"SELECT {i} AS step, '{STEPS[i][0]}' AS preprocessor, count(*) AS rows, {_changed('a', 'b')} AS rows_changed "
    f"FROM {before} a JOIN s{i + 1} b USING (id)"
    for i, before in enumerate(["pairs", "s1", "s2", "s3", "s4", "s5"])
)


@query(
    "preprocess_stats",
    from_pairs(
        f"SELECT step, preprocessor, rows, rows_changed, round(rows_changed * CAST(100 AS DOUBLE) / rows, 6) AS change_percentage FROM ({_PARTS})",
        CHAIN_CTE,
    ),
)
def _(spark, sf):
    stats = plan.preprocess_stats(pairs(spark, sf), _steps())
    return stats.withColumn("change_percentage", F.round("change_percentage", 6))


@query(
    "changed_rows",
    from_pairs(
        f"""SELECT row_pos AS "index", id, domain, en AS en_before, {american_sql('en')} AS en_after, ka AS ka_before,
        ka AS ka_after FROM pairs WHERE en <> {american_sql('en')}"""
    ),
)
def _(spark, sf):
    return plan.changed_rows(pairs(spark, sf, positions=True), Step("convert_to_american"))


@query("prepare_for_inference", f"SELECT doc_id, {repair_sql(squeeze_sql(american_sql(normalize_sql('text'))))} AS text FROM documents")
def _(spark, sf):
    return P.prepare_for_inference(texts(spark, sf, "documents"), ["text"]).select("doc_id", "text")


@query(
    "id_metadata",
    from_pairs(
        "SELECT regexp_extract(id, '^[^_]*') AS dataset_name, regexp_extract(id, '^[^_]*_(.*)$', 1) AS metadata, id AS full_id FROM pairs"
    ),
)
def _(spark, sf):
    return pairs(spark, sf).select(P.id_parts(F.col("id")).alias("p")).select("p.*")


@query(
    "indexed_items",
    from_pairs(
        """SELECT title, ka AS ka_text, en AS en_text, domain, id, row_number() OVER (ORDER BY row_pos) - 1 AS "index",
        regexp_extract(id, '^[^_]*') AS dataset_name FROM pairs"""
    ),
)
def _(spark, sf):
    items = indexed(pairs(spark, sf, positions=True), name="index")
    return items.select(
        "title",
        F.col("ka").alias("ka_text"),
        F.col("en").alias("en_text"),
        "domain",
        "id",
        "index",
        P.id_parts(F.col("id"))["dataset_name"].alias("dataset_name"),
    )


@query("row_index_by_id", from_pairs("SELECT id, row_number() OVER (ORDER BY id) - 1 AS idx FROM pairs"))
def _(spark, sf):
    return indexed(pairs(spark, sf), order=["id"]).select("id", "idx")


@query("text_preview", from_pairs("SELECT id, left(en, 100) || '...' AS preview FROM pairs"))
def _(spark, sf):
    return pairs(spark, sf).select("id", P.preview(F.col("en")).alias("preview"))


# --- duplicates and final cleanup, on raw documents, which hold copies ---

_DOCS = "docs AS (SELECT doc_id, text AS en, lang AS ka FROM documents)"
_FATE = f"""fated AS (SELECT *, CASE WHEN {strip('en')} = '' OR {strip('ka')} = '' THEN 'empty'
 WHEN row_number() OVER (PARTITION BY en, ka ORDER BY doc_id) > 1 THEN 'duplicate' ELSE 'kept' END AS fate FROM docs)"""


def _docs(spark, sf):
    return texts(spark, sf, "documents").select("doc_id", F.col("text").alias("en"), F.col("lang").alias("ka"))


@query("final_cleanup", f"WITH {_DOCS}, {_FATE} SELECT doc_id, en, ka FROM fated WHERE fate = 'kept'")
def _(spark, sf):
    return plan.final_cleanup(_docs(spark, sf), "doc_id")


@query(
    "cleanup_stats",
    f"""WITH {_DOCS}, {_FATE}, n AS (SELECT count(*) AS original_rows, count(*) FILTER (fate = 'kept') AS final_rows,
    count(*) FILTER (fate = 'empty') AS empty_content_removed, count(*) FILTER (fate = 'duplicate') AS duplicates_removed FROM fated)
    SELECT *, original_rows - final_rows AS total_removed,
    round(CAST(empty_content_removed AS DOUBLE) * 100 / original_rows, 6) AS empty_content_percentage,
    round(CAST(duplicates_removed AS DOUBLE) * 100 / (original_rows - empty_content_removed), 6) AS duplicate_percentage,
    round(CAST(original_rows - final_rows AS DOUBLE) * 100 / original_rows, 6) AS total_removal_percentage,
    round(CAST(final_rows AS DOUBLE) / original_rows, 6) AS retention_rate FROM n""",
)
def _(spark, sf):
    stats = plan.cleanup_stats(plan.mark_cleanup(_docs(spark, sf), "doc_id"))
    doubles = [c for c, t in stats.dtypes if t == "double"]
    return stats.withColumns({c: F.round(c, 6) for c in doubles})


