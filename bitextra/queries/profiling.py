from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import profile as P
from ..operators.lookup import settled
from ..plans.evaluate import profile
from .base import LONG_CTE, REGISTERED, WS, digest, from_pairs, pairs, q, query, space_tokens, strip


def _data(spark, sf):
    return pairs(spark, sf).withColumn("dataset", F.split_part("id", F.lit("_"), F.lit(1)))


def _rounded(df, *cols):
    return df.withColumns({c: F.round(c, 6) for c in cols})


def long_sql(select: str, ctes: str = "") -> str:
    return from_pairs(select, LONG_CTE + (", " + ctes if ctes else ""))


def top_sql(counts: str, k: int, by: str, item: str, extra: str = "") -> str:
    return f"""SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY {by} ORDER BY count DESC, {item}) AS rank
    FROM ({counts})) WHERE rank <= {k}{extra}"""


_WORDS = f"w AS (SELECT lang, domain, unnest({space_tokens('text')}) AS word FROM long)"
_WORD_COUNTS = "SELECT lang, word, count(*) AS count FROM w GROUP BY ALL"
_CHARS = "c AS (SELECT lang, unnest(string_split(text, '')) AS char FROM long)"
_CHAR_COUNTS = "SELECT lang, char, count(*) AS count FROM c WHERE char <> '' GROUP BY ALL"


@query(
    "basic_stats",
    from_pairs(
        """SELECT count(*) AS total_samples, count(DISTINCT domain) AS unique_domains,
        count(DISTINCT string_split(id, '_')[1]) AS unique_datasets, count(*) FILTER (title IS NULL) AS missing_titles,
        count(*) FILTER (ka = '') AS empty_georgian, count(*) FILTER (en = '') AS empty_english FROM pairs"""
    ),
)
def _(spark, sf):
    return P.basic_stats(_data(spark, sf))


def _measures(c: str) -> list[tuple[str, str]]:
    return [(f"{c}_char_count", f"length({c})"), (f"{c}_word_count", f"len({space_tokens(c)})")]


@query(
    "length_stats",
    from_pairs(
        " UNION ALL ".join(
            f"""SELECT '{name}' AS measure, round(avg(v), 6) AS mean, round(CAST(median(v) AS DOUBLE), 6) AS median, round(stddev_samp(v), 6) AS std,
            CAST(min(v) AS DOUBLE) AS min, CAST(max(v) AS DOUBLE) AS max FROM (SELECT {e} AS v FROM pairs)"""
            for c in ("ka", "en")
            for name, e in _measures(c)
        )
    ),
)
def _(spark, sf):
    return _rounded(P.length_stats(_data(spark, sf)), "mean", "median", "std")


_RATIO = f"""r AS (SELECT id, length(ka) / (length(en) + CAST(1e-6 AS DOUBLE)) AS char_ratio,
 len({space_tokens('ka')}) / (len({space_tokens('en')}) + CAST(1e-6 AS DOUBLE)) AS word_ratio FROM pairs)"""


@query("length_ratios", from_pairs("SELECT id, round(char_ratio, 6) AS char_ratio, round(word_ratio, 6) AS word_ratio FROM r", _RATIO))
def _(spark, sf):
    return _rounded(P.with_ratios(_data(spark, sf)), "char_ratio", "word_ratio").select("id", "char_ratio", "word_ratio")


def _bins(ratio: str) -> str:
    return f"""SELECT '{ratio}' AS ratio, bin, round(lo + bin * w, 6) AS low, round(lo + (bin + 1) * w, 6) AS high, count(*) AS count FROM (
        SELECT CAST(least(floor(({ratio} - lo) / w), 49) AS BIGINT) AS bin, lo, w FROM r,
        (SELECT min({ratio}) AS lo, (max({ratio}) - min({ratio})) / CAST(50 AS DOUBLE) AS w FROM r)) GROUP BY ALL"""


@query("ratio_histogram", from_pairs(f"{_bins('char_ratio')} UNION ALL {_bins('word_ratio')}", _RATIO))
def _(spark, sf):
    ratios = P.with_ratios(_data(spark, sf))
    both = [_rounded(P.histogram(ratios, c), "low", "high").withColumn("ratio", F.lit(c)) for c in ("char_ratio", "word_ratio")]
    return both[0].unionByName(both[1])


@query("top_characters", long_sql(top_sql(_CHAR_COUNTS, 50, "lang", "char"), _CHARS))
def _(spark, sf):
    return P.top_chars(_data(spark, sf))


@query(
    "top_punctuation",
    long_sql(
        top_sql(_CHAR_COUNTS, 50, "lang", "char", rf" AND NOT regexp_matches(char, '[\p{{L}}\p{{N}}]') AND {strip('char')} <> ''"),
        _CHARS,
    ),
)
def _(spark, sf):
    return P.top_punctuation(_data(spark, sf))


_TOTALS = "SELECT lang, count(*) AS unique_items, CAST(sum(count) AS BIGINT) AS total_items FROM ({}) GROUP BY lang"


@query("character_totals", long_sql(_TOTALS.format(_CHAR_COUNTS), _CHARS))
def _(spark, sf):
    return P.frequency_totals(P.char_counts(_data(spark, sf)))


@query("word_frequencies", long_sql(_WORD_COUNTS, _WORDS))
def _(spark, sf):
    return P.word_counts(_data(spark, sf))


@query("top_words", long_sql(top_sql(_WORD_COUNTS, 100, "lang", "word"), _WORDS))
def _(spark, sf):
    return P.top_words(_data(spark, sf))


@query("word_totals", long_sql(_TOTALS.format(_WORD_COUNTS), _WORDS))
def _(spark, sf):
    return P.frequency_totals(P.word_counts(_data(spark, sf)))


@query("word_lengths", long_sql("SELECT lang, length(word) AS length, count(*) AS count FROM w GROUP BY ALL", _WORDS))
def _(spark, sf):
    return P.word_lengths(_data(spark, sf))


for _by in ("domain", "dataset"):
    _expr = "domain" if _by == "domain" else "string_split(id, '_')[1]"

    @query(f"{_by}_counts", from_pairs(f"SELECT {_expr} AS {_by}, count(*) AS count FROM pairs GROUP BY ALL"))
    def _(spark, sf, by=_by):
        return P.group_counts(_data(spark, sf), by)

    @query(
        f"{_by}_summary",
        from_pairs(
            """SELECT count(*) AS n_groups, (SELECT name FROM g ORDER BY n DESC, name LIMIT 1) AS largest,
            max(n) AS largest_count, (SELECT name FROM g ORDER BY n, name LIMIT 1) AS smallest, min(n) AS smallest_count FROM g""",
            f"g AS (SELECT {_expr} AS name, count(*) AS n FROM pairs GROUP BY ALL)",
        ),
    )
    def _(spark, sf, by=_by):
        return P.group_summary(_data(spark, sf), by)


def _ngrams_cte(n: int) -> str:
    gram = " || ' ' || ".join(f"t[i + {j}]" if j else "t[i]" for j in range(n))
    return f"""g AS (SELECT lang, unnest(list_transform(range(1, greatest(len(t) - {n} + 2, 1)), lambda i: {gram})) AS ngram
    FROM (SELECT lang, {space_tokens('text')} AS t FROM long))"""


_NGRAM_COUNTS = "SELECT lang, ngram, count(*) AS count FROM g GROUP BY ALL"
for _n in (2, 3, 4):

    @query(f"top_ngrams_{_n}", long_sql(top_sql(_NGRAM_COUNTS, 50, "lang", "ngram"), _ngrams_cte(_n)))
    def _(spark, sf, n=_n):
        return P.top_ngrams(_data(spark, sf), n)

    @query(f"ngram_totals_{_n}", long_sql(_TOTALS.format(_NGRAM_COUNTS), _ngrams_cte(_n)))
    def _(spark, sf, n=_n):
        return P.frequency_totals(P.ngram_counts(_data(spark, sf), n))


_MARK = "chr(1)"
_SENTENCES = f"""s AS (SELECT lang, len({space_tokens('sentence')}) AS words FROM (SELECT lang,
 unnest(string_split(regexp_replace({strip('text')}, {q(f'([.!?]){WS}+')}, '\\1' || {_MARK}, 'g'), {_MARK})) AS sentence FROM long))"""


@query(
    "sentence_stats",
    long_sql(
        """SELECT lang, count(*) AS sentences, round(avg(words), 6) AS mean, CAST(median(words) AS DOUBLE) AS median,
        max(words) AS max FROM s GROUP BY lang""",
        _SENTENCES,
    ),
)
def _(spark, sf):
    return _rounded(P.sentence_stats(_data(spark, sf)), "mean")


@query("sentence_length_distribution", long_sql("SELECT lang, words, count(*) AS count FROM s GROUP BY ALL", _SENTENCES))
def _(spark, sf):
    return P.sentence_lengths(_data(spark, sf)).groupBy("lang", "words").count()


_EDGES = """SELECT lang, edge, char, count(*) AS count FROM (SELECT lang, 'beginning' AS edge, left(word, 1) AS char FROM w WHERE word <> ''
 UNION ALL SELECT lang, 'ending', right(word, 1) FROM w WHERE word <> '') GROUP BY ALL"""


@query("word_edges", long_sql(top_sql(_EDGES, 20, "lang, edge", "char"), _WORDS))
def _(spark, sf):
    return P.word_edges(_data(spark, sf))


@query(
    "number_patterns",
    from_pairs(
        " UNION ALL ".join(
            f"""SELECT '{n}' AS pattern, CAST(sum(len(regexp_extract_all(ka, '{p}')) + len(regexp_extract_all(en, '{p}'))) AS BIGINT) AS count
            FROM pairs"""
            for n, p in P.NUMBER_PATTERNS.items()
        )
    ),
)
def _(spark, sf):
    return P.number_patterns(_data(spark, sf))


_LONGEST = """lw AS (SELECT * FROM (SELECT lang, word, length(word) AS length, row_number() OVER (PARTITION BY lang ORDER BY
 length(word) DESC, word DESC) AS rank FROM (SELECT DISTINCT lang, word FROM w WHERE word <> '')) WHERE rank <= 50)"""


@query("longest_words", long_sql("SELECT * FROM lw", f"{_WORDS}, {_LONGEST}"))
def _(spark, sf):
    return P.longest_words(_data(spark, sf))


@query(
    "longest_word_stats",
    long_sql("SELECT lang, max(length) AS longest, round(avg(length), 6) AS avg_length FROM lw GROUP BY lang", f"{_WORDS}, {_LONGEST}"),
)
def _(spark, sf):
    return _rounded(P.longest_word_stats(_data(spark, sf)), "avg_length")


_ZIPF = f"z AS ({top_sql(_WORD_COUNTS, 1000, 'lang', 'word')})"


@query("zipf", long_sql("SELECT lang, rank, word, count AS frequency FROM z", f"{_WORDS}, {_ZIPF}"))
def _(spark, sf):
    return P.zipf(_data(spark, sf))


@query(
    "zipf_slope",
    long_sql("SELECT lang, round(regr_slope(ln(count), ln(rank)), 6) AS slope FROM z GROUP BY lang", f"{_WORDS}, {_ZIPF}"),
)
def _(spark, sf):
    return _rounded(P.zipf_slope(_data(spark, sf)), "slope")


@query(
    "word_cloud",
    long_sql(
        f"""SELECT lang, word, count, rank, round(CAST(count AS DOUBLE) / max(count) OVER (PARTITION BY lang), 6) AS weight
        FROM ({top_sql(_WORD_COUNTS, 100, 'lang', 'word')})""",
        _WORDS,
    ),
)
def _(spark, sf):
    return _rounded(P.word_cloud(_data(spark, sf)), "weight")


_DOMAINS = "(SELECT domain FROM pairs GROUP BY domain ORDER BY min(id), domain LIMIT 6)"


@query(
    "domain_word_cloud",
    long_sql(
        top_sql(
            f"SELECT domain, lang, word, count(*) AS count FROM w WHERE domain IN {_DOMAINS} GROUP BY ALL", 50, "domain, lang", "word"
        ),
        _WORDS,
    ),
)
def _(spark, sf):
    return P.domain_word_cloud(_data(spark, sf))


@query(
    "distinct_values",
    from_pairs(
        """SELECT DISTINCT 'domain' AS kind, domain AS value FROM pairs UNION ALL
        SELECT DISTINCT 'dataset_name', string_split(id, '_')[1] FROM pairs UNION ALL
        SELECT DISTINCT 'language', x FROM (SELECT unnest(['ka', 'en']) AS x FROM pairs)"""
    ),
)
def _(spark, sf):
    return P.distinct_values(_data(spark, sf))


_QUALITY = f"""qc AS (SELECT count(*) FILTER (title IS NULL) AS null_titles, count(*) FILTER (ka IS NULL) AS null_georgian,
 count(*) FILTER (en IS NULL) AS null_english, count(*) FILTER (ka = '') AS empty_georgian, count(*) FILTER (en = '') AS empty_english,
 count(*) - count(DISTINCT {digest('ka', 'en')}) AS duplicate_pairs, count(*) - count(DISTINCT ka) AS duplicate_georgian,
 count(*) - count(DISTINCT en) AS duplicate_english, count(*) FILTER (length(ka) < 10) AS very_short_georgian,
 count(*) FILTER (length(en) < 10) AS very_short_english, count(*) FILTER (length(ka) > 1000) AS very_long_georgian,
 count(*) FILTER (length(en) > 1000) AS very_long_english FROM pairs)"""


@query("quality_counts", from_pairs("SELECT * FROM qc", _QUALITY))
def _(spark, sf):
    return P.quality_counts(_data(spark, sf))


@query(
    "quality_issues",
    from_pairs(
        " UNION ALL ".join(f"""SELECT {q(name)} AS issue, {col} AS "count" FROM qc""" for name, col in P.ISSUES), _QUALITY
    ),
)
def _(spark, sf):
    return P.quality_issues(_data(spark, sf))


#: The query whose SQL gives each table of the complete profile.
_SAME_AS = {
    "basic": "basic_stats",
    "lengths": "length_stats",
    "domains": "domain_counts",
    "datasets": "dataset_counts",
    "quality": "quality_issues",
    "chars": "top_characters",
    "words": "top_words",
    "word_lengths": "word_lengths",
    "bigrams": "top_ngrams_2",
    "trigrams": "top_ngrams_3",
    "fourgrams": "top_ngrams_4",
    "sentences": "sentence_stats",
    "edges": "word_edges",
    "numbers": "number_patterns",
    "longest": "longest_words",
    "zipf": "zipf",
}


@query(
    "profile_row_counts",
    " UNION ALL ".join(f"""SELECT {q(n)} AS "table", count(*) AS count FROM ({REGISTERED[same][1]})""" for n, same in _SAME_AS.items()),
)
def _(spark, sf):
    """How many lines each table of the complete profile has."""
    tables = profile(settled(_data(spark, sf), "pairs"), "complete")
    out = None
    for name, df in tables.items():
        one = df.select(F.lit(name).alias("table")).groupBy("table").count()
        out = one if out is None else out.unionByName(one)
    return out
