from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import constants as K
from ..operators import augmenters as A
from ..operators.lookup import settled
from ..plans import preprocess as plan
from ..plans.spec import load_spec
from ..registry import augmenters
from .base import from_pairs, pairs, pick, q, query, strip, table, u, words

SHARE = 0.4  # high shares, so that every branch occurs in small tables


def noise_sql(src: str) -> str:
    n, letters = "length(en)", q(A.expand_ranges(["a-z"]))
    w = "synthetic_noise"

    def at(places):
        return pick(u(w, k="'2'"), places)

    letter = f"substr({letters}, {pick(u(w, k=chr(39) + '3' + chr(39)), '26')} + 1, 1)"
    kinds = {
        "delete": f"left(en, {at(n)}) || substr(en, {at(n)} + 2)",
        "insert": f"left(en, {at(n + ' + 1')}) || {letter} || substr(en, {at(n + ' + 1')} + 1)",
        "duplicate": f"left(en, {at(n)}) || substr(en, {at(n)} + 1, 1) || substr(en, {at(n)} + 1)",
        "substitute": f"left(en, {at(n)}) || {letter} || substr(en, {at(n)} + 2)",
        "swap": f"left(en, {at(n + ' - 1')}) || substr(en, {at(n + ' - 1')} + 2, 1) || substr(en, {at(n + ' - 1')} + 1, 1) || substr(en, {at(n + ' - 1')} + 3)",
    }
    one = chr(39) + "1" + chr(39)
    cases = " ".join(
        f"WHEN {i} THEN CASE WHEN {n} > {1 if k in ('delete', 'swap') else 0} THEN {e} ELSE en END"
        for i, (k, e) in enumerate(kinds.items())
    )
    return f"""SELECT title, ka, CASE {pick(u(w, k=one), '5')} {cases} END AS en, domain, id || '_synthetic_noise' AS id, row_pos
    FROM {src} WHERE {u(w)} < CAST({SHARE} AS DOUBLE)"""


def _with(name, positions=False, **params):
    def fn(spark, sf):
        return augmenters.get(name)(pairs(spark, sf, positions), params)

    return fn


OUT = "title, ka, en, domain, id"
query("synthetic_noise", from_pairs(f"SELECT {OUT} FROM ({noise_sql('pairs')})"))(_with("synthetic_noise", percentage=SHARE))

_CONCAT = f"""i AS (SELECT *, row_number() OVER (ORDER BY row_pos) - 1 AS idx FROM pairs),
w AS (SELECT *, list(en) OVER f AS ens, list(ka) OVER f AS kas,
  2 + {pick(u('sentence_concatenation', k="'1'"), '4')} AS n FROM i
  WINDOW f AS (ORDER BY idx ROWS BETWEEN CURRENT ROW AND 4 FOLLOWING))"""


@query(
    "sentence_concatenation",
    from_pairs(
        f"""SELECT domain, id || '_concat' || CAST(len(ens[1:n]) AS VARCHAR) AS id, array_to_string(ens[1:n], ' ') AS en,
        array_to_string(kas[1:n], ' ') AS ka FROM w WHERE {u('sentence_concatenation')} < CAST({SHARE} AS DOUBLE)""",
        _CONCAT,
    ),
)
def _(spark, sf):
    rule = {"percentage": SHARE, "min_n": 2, "max_n": 5}
    made = augmenters.get("sentence_concatenation")(pairs(spark, sf, positions=True), rule)
    return made.select("domain", "id", "en", "ka")


_TEMPLATES = ", ".join(f"({i}, {q(en)}, {q(ka)})" for i, (en, ka) in enumerate(K.NUMBER_TEMPLATES))
_NUMBER = f"""CASE {pick(u('number_copying', 'CAST(i AS VARCHAR)'), '4')}
 WHEN 0 THEN CAST(1 + {pick(u('number_copying', 'CAST(i AS VARCHAR)', "'1'"), '10000')} AS VARCHAR)
 WHEN 1 THEN printf('%.2f', CAST(1 AS DOUBLE) + {u('number_copying', 'CAST(i AS VARCHAR)', "'1'")} * CAST(999 AS DOUBLE))
 WHEN 2 THEN CAST(1000000 + {pick(u('number_copying', 'CAST(i AS VARCHAR)', "'1'"), '999000000')} AS VARCHAR)
 ELSE printf('%.3f', CAST(0.001 AS DOUBLE) + {u('number_copying', 'CAST(i AS VARCHAR)', "'1'")} * CAST(0.998 AS DOUBLE)) END"""


@query(
    "number_copying",
    f"""WITH t AS (SELECT * FROM (VALUES {_TEMPLATES}) v(k, en, ka)),
    n AS (SELECT i, {_NUMBER} AS num, {pick(u('number_copying', 'CAST(i AS VARCHAR)', "'2'"), '15')} AS k
      FROM (SELECT row_number() OVER () - 1 AS i FROM documents))
    SELECT CAST(NULL AS VARCHAR) AS title, replace(ka, '{{number}}', num) AS ka, replace(en, '{{number}}', num) AS en,
    'synthetic' AS domain, 'number_copy_' || CAST(i AS VARCHAR) AS id FROM n JOIN t USING (k)""",
)
def _(spark, sf):
    examples = table(spark, sf, "documents").count()  # one example per document
    return augmenters.get("number_copying")(pairs(spark, sf), {"num_examples": examples})


query(
    "text_copying",
    from_pairs(
        f"""SELECT CAST(NULL AS VARCHAR) AS title, t AS ka, t AS en, 'synthetic_copying' AS domain,
        'georgian_copy_' || CAST(r AS VARCHAR) AS id FROM (
          SELECT {strip('ka')} AS t, row_number() OVER (ORDER BY md5('42|copy|' || id), id) - 1 AS r
          FROM pairs WHERE length({strip('ka')}) > 2)
        WHERE r < (SELECT CAST(floor(count(*) * CAST({SHARE} AS DOUBLE)) AS BIGINT) FROM pairs)"""
    ),
)(_with("georgian_text_copying", percentage=SHARE))


def restructure_ctes(order: str) -> str:
    take = pick(u("restructure_to_longer_texts", "CAST(block AS VARCHAR)"), "3")
    return f"""ri AS (SELECT *, row_number() OVER (ORDER BY {order}) - 1 AS idx FROM pairs),
rb AS (SELECT *, idx // 4 AS block, idx % 4 AS pos FROM ri),
bs AS (SELECT block, count(*) AS size, least(count(*), 2 + {take}) AS drawn FROM rb GROUP BY block HAVING count(*) >= 2),
po AS (SELECT block, 0 AS part, drawn AS n FROM bs UNION ALL SELECT block, 1, size - drawn FROM bs),
us AS (SELECT block, part, least(n, greatest(0, (SELECT floor(count(*) * CAST({SHARE} AS DOUBLE)) FROM pairs) - coalesce(sum(n) OVER (
  ORDER BY part, md5('42|blocks|' || CAST(block AS VARCHAR)), block ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))) AS used FROM po),
chosen AS (SELECT block, sum(used) AS take FROM us WHERE part = 1 OR used >= 2 GROUP BY block),
mk AS (SELECT rb.*, coalesce(pos < take, false) AS member FROM rb LEFT JOIN chosen USING (block)),
restructured AS (SELECT string_agg(en, ' ' ORDER BY idx) AS en, string_agg(ka, ' ' ORDER BY idx) AS ka,
  arg_min(domain, idx) AS domain, arg_min(title, idx) AS title, min(row_pos) FILTER (pos = 0) AS row_pos,
  'restructured_' || array_to_string(list(id ORDER BY idx)[1:3], '_') AS id FROM mk WHERE member GROUP BY block
  UNION ALL SELECT en, ka, domain, title, row_pos, id FROM mk WHERE NOT member)"""


@query("restructure_consecutive", from_pairs("SELECT en, ka, domain, id FROM restructured", restructure_ctes("row_pos")))
def _(spark, sf):
    made = augmenters.get("restructure_to_longer_texts")(
        pairs(spark, sf, positions=True), {"concatenation_ratio": SHARE}
    )
    return made.select("en", "ka", "domain", "id")


@query(
    "restructure_random",
    from_pairs("SELECT en, ka, domain, id FROM restructured", restructure_ctes("md5('42|random|' || id), id")),
)
def _(spark, sf):
    made = augmenters.get("restructure_to_longer_texts")(
        pairs(spark, sf), {"concatenation_ratio": SHARE, "strategy": "random"}
    )
    return made.select("en", "ka", "domain", "id")


def variation_sql(src: str) -> str:
    v = "natural_writing_variations"
    w = words("en")
    at = pick(u(v, k="'2'"), "len(w) - 1")
    swapped = f"CASE WHEN len(w) > 2 THEN list_concat(list_concat(w[1:{at}], [w[{at} + 2], w[{at} + 1]]), w[{at} + 3:]) ELSE w END"
    draw = u(v, k="'w' || CAST(i - 1 AS VARCHAR)")
    kept = (
        f"list_transform(list_filter(range(1, len(w) + 1), lambda i: NOT (lower(w[i]) IN ('a', 'an', 'the') AND {draw} < CAST(0.7 AS DOUBLE))),"
        " lambda i: w[i])"
    )
    informal = "en"
    for formal, short in K.INFORMAL:
        informal = f"regexp_replace({informal}, {q(chr(92) + 'b' + formal + chr(92) + 'b')}, {q(short)}, 'gi')"
    return f"""SELECT title, ka, CASE {pick(u(v, k="'1'"), '3')} WHEN 0 THEN array_to_string({swapped}, ' ')
     WHEN 1 THEN array_to_string({kept}, ' ') ELSE {informal} END AS en, domain, id || '_natural_variation' AS id, row_pos
     FROM (SELECT *, {w} AS w FROM {src}) WHERE {u(v)} < CAST({SHARE} AS DOUBLE)"""


query("natural_writing_variations", from_pairs(f"SELECT {OUT} FROM ({variation_sql('pairs')})"))(
    _with("natural_writing_variations", percentage=SHARE)
)

AUGMENT_SPEC = {
    "augmenters": [
        {"name": "synthetic_noise", "params": {"percentage": SHARE}},
        {"name": "restructure_to_longer_texts", "params": {"concatenation_ratio": SHARE}},
        {"name": "natural_writing_variations", "params": {"percentage": SHARE}},
        {"name": "number_copying", "enabled": False},
    ],
    "settings": {"random_seed": 42},
}
_AUGMENTED = f"""{restructure_ctes('row_pos')}, augmented AS (SELECT en, ka, domain, id FROM restructured
 UNION ALL SELECT en, ka, domain, id FROM ({noise_sql('pairs')})
 UNION ALL SELECT en, ka, domain, id FROM ({variation_sql('restructured')}))"""


def _augmented(spark, sf):
    spec = load_spec(AUGMENT_SPEC)
    base = pairs(spark, sf, positions=True)
    return base, plan.augment(base, spec.enabled("augmenters"), spec.settings)


@query("augment_chain", from_pairs("SELECT en, ka, domain, id FROM augmented", _AUGMENTED))
def _(spark, sf):
    return _augmented(spark, sf)[1].select("en", "ka", "domain", "id")


@query(
    "augmentation_stats",
    from_pairs(
        """SELECT o AS original, f AS final, f - o AS generated, round(CAST(f - o AS DOUBLE) / o, 6) AS augmentation_ratio
        FROM (SELECT (SELECT count(*) FROM pairs) AS o, (SELECT count(*) FROM augmented) AS f)""",
        _AUGMENTED,
    ),
)
def _(spark, sf):
    base, grown = _augmented(spark, sf)
    stats = plan.augmentation_stats(base, grown)
    return stats.withColumn("augmentation_ratio", F.round("augmentation_ratio", 6))


@query("preprocess_and_augment")
def _(spark, sf):
    spec = {
        "preprocessors": [
            {"name": "normalize_characters"},
            {"name": "remove_extra_whitespaces"},
            {"name": "convert_to_american"},
            {"name": "lowercase_english"},
            {"name": "sync_punctuation", "params": {"strategy": "add_missing", "punctuation_marks": ".!?;:"}},
            {"name": "fix_encoding_issues"},
            {"name": "remove_html_tags"},
        ],
        "augmenters": [
            {"name": "synthetic_noise", "params": {"percentage": 0.05}},
            {"name": "sentence_concatenation", "params": {"percentage": 0.1, "min_n": 3, "max_n": 5}},
            {"name": "georgian_text_copying", "params": {"percentage": 0.02}},
            {"name": "natural_writing_variations", "params": {"percentage": 0.01}},
        ],
        "settings": {"random_seed": 42},
    }
    return plan.run_preprocessing(pairs(spark, sf, positions=True), spec)


@query(
    "preprocessing_summary",
    from_pairs(
        f"""SELECT domain AS dataset, GROUPING(domain) = 1 AS is_total, count(*) FILTER (stage = 'in') AS original_rows,
        count(*) FILTER (stage <> 'in') AS augmented_rows, count(*) FILTER (stage = 'kept') AS final_rows,
        round(CAST(count(*) FILTER (stage NOT IN ('in', 'kept')) AS DOUBLE) * 100 / count(*) FILTER (stage <> 'in'), 6) AS cleanup_percentage,
        round(CAST(count(*) FILTER (stage <> 'in') - count(*) FILTER (stage = 'in') AS DOUBLE) / count(*) FILTER (stage = 'in'), 6) AS augmentation_ratio
        FROM (SELECT domain, 'in' AS stage FROM pairs UNION ALL SELECT domain, CASE WHEN {strip('en')} = '' OR {strip('ka')} = '' THEN 'empty'
          WHEN row_number() OVER (PARTITION BY en, ka ORDER BY id) > 1 THEN 'duplicate' ELSE 'kept' END
          FROM (SELECT domain, id, en, ka FROM pairs UNION ALL SELECT domain, id, en, ka FROM ({noise_sql('pairs')})
            UNION ALL SELECT domain, id, en, ka FROM ({variation_sql('pairs')})))
        GROUP BY ROLLUP (domain)"""
    ),
)
def _(spark, sf):
    # written once: the input and each augmenter read it
    base = settled(pairs(spark, sf), "pairs").withColumn("dataset", F.col("domain"))
    steps = [s for s in load_spec(AUGMENT_SPEC).enabled("augmenters") if s.name != "restructure_to_longer_texts"]
    marked = plan.mark_cleanup(plan.augment(base, steps, {"random_seed": 42}), "id")
    summary = plan.preprocessing_summary(base, marked)
    return summary.withColumns({c: F.round(c, 6) for c in ("cleanup_percentage", "augmentation_ratio")})


# --- word order and word replacement, and numbers that the rows themselves hold ---

query(
    "sentence_reversal",
    from_pairs(
        f"""SELECT title, ka, CASE WHEN en IS NOT NULL THEN array_to_string(list_reverse({words('en')}), ' ') END AS en, domain,
        id || '_reversed' AS id FROM pairs WHERE {u('sentence_reversal')} < CAST({SHARE} AS DOUBLE)"""
    ),
)(_with("sentence_reversal", percentage=SHARE))

LEXICON = ["river", "lantern", "copper", "meadow", "signal", "harbor", "velvet"]
_PLACE = "CAST(i - 1 AS VARCHAR)"
query(
    "random_word_replacement",
    from_pairs(
        f"""SELECT title, ka, CASE WHEN en IS NOT NULL THEN array_to_string(list_transform(w, lambda x, i:
        CASE WHEN {u('word_en', k=_PLACE)} < CAST(0.3 AS DOUBLE) THEN {LEXICON}[{pick(u('entry_en', k=_PLACE), str(len(LEXICON)))} + 1] ELSE x END), ' ') END AS en,
        domain, id || '_replaced' AS id FROM (SELECT *, {words('en')} AS w FROM pairs) WHERE {u('random_word_replacement')} < CAST({SHARE} AS DOUBLE)"""
    ),
)(_with("random_word_replacement", percentage=SHARE, word_percentage=0.3, lexicon=LEXICON))

_ENGLISH = "[" + ", ".join(q(en) for en, _ in K.NUMBER_TEMPLATES) + "]"
_GEORGIAN = "[" + ", ".join(q(ka) for _, ka in K.NUMBER_TEMPLATES) + "]"
_WHICH = pick(u("number_copying", k="'2'"), str(len(K.NUMBER_TEMPLATES)))
query(
    "number_copying_from_rows",
    from_pairs(
        f"""SELECT CAST(NULL AS VARCHAR) AS title, replace({_GEORGIAN}[{_WHICH} + 1], '{{number}}', n) AS ka,
        replace({_ENGLISH}[{_WHICH} + 1], '{{number}}', n) AS en, 'synthetic' AS domain, 'number_copy_' || id AS id
        FROM (SELECT id, regexp_extract(en, '[0-9]+(\\.[0-9]+)?', 0) AS n FROM pairs) WHERE n <> ''"""
    ),
)(_with("number_copying", from_rows=True))
