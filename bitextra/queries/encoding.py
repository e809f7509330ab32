from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import arrays as A
from ..operators import encoding as E
from .base import LONG_CTE, from_pairs, pairs, q, query, space_tokens, words

SIZE, LENGTH = 32_000, 128

_VOCABULARY = f"""vw AS (SELECT lang, unnest({space_tokens('text')}) AS word FROM long),
vc AS (SELECT word, count(*) AS n FROM vw WHERE word <> '' GROUP BY word),
vocab AS (SELECT word AS token, row_number() OVER (ORDER BY n DESC, word) + 4 AS token_id FROM vc ORDER BY n DESC, word LIMIT {SIZE})"""
_SPECIAL = " ".join(f"WHEN {q(t)} THEN {i}" for t, i in E.SPECIALS.items())


def vocabulary_sql(select: str, ctes: str = "") -> str:
    return from_pairs(select, f"{LONG_CTE}, {_VOCABULARY}" + (", " + ctes if ctes else ""))


def encoded_cte(name: str, column: str, tail: str = "", prefix: str = "") -> str:
    """{name}(id, ids): fixed-length id lists of a column of pairs."""
    text = f"{q(prefix)} || coalesce({column}, '')" if prefix else f"coalesce({column}, '')"
    w = f"list_concat({words(text)}, [{q(tail)}])" if tail else words(text)
    pad = f"list_transform(range(0, {LENGTH}), lambda x: 0)"
    return f"""{name}_t AS (SELECT id, unnest(range(1, len(w) + 1)) AS pos, unnest(w) AS token FROM (SELECT id, ({w})[1:{LENGTH}] AS w FROM pairs)),
{name}_l AS (SELECT id, list(coalesce(token_id, CASE token {_SPECIAL} END, 1) ORDER BY pos) AS l FROM {name}_t LEFT JOIN vocab USING (token) GROUP BY id),
{name} AS (SELECT p.id, list_concat(coalesce(l, CAST([] AS BIGINT[])), {pad})[1:{LENGTH}] AS ids FROM pairs p LEFT JOIN {name}_l USING (id))"""


def joined(c: str) -> str:
    return f"array_to_string({c}, ' ')"


def mask_sql(c: str) -> str:
    return f"list_transform({c}, lambda x: CASE WHEN x <> 0 THEN 1 ELSE 0 END)"


def ignore_sql(c: str) -> str:
    return f"list_transform({c}, lambda x: CASE WHEN x = 0 THEN -100 ELSE x END)"


def _text(df, *names):
    """Arrays as text, which compares across engines."""
    return df.withColumns({n: F.concat_ws(" ", F.col(n).cast("array<string>")) for n in names})


@query("fit_vocabulary", vocabulary_sql("SELECT token, token_id FROM vocab"))
def _(spark, sf):
    return E.fit_vocabulary(pairs(spark, sf), SIZE)


def _encoded(spark, sf, tokenizer="words", **params):
    from ..registry import tokenizers

    params = {"vocabulary_size": SIZE, "max_length": LENGTH, **params}
    return tokenizers.get(tokenizer)(pairs(spark, sf), params)


@query(
    "encode_pairs",
    vocabulary_sql(
        f"SELECT s.id, {joined('s.ids')} AS input_ids, {joined(mask_sql('s.ids'))} AS attention_mask, {joined('t.ids')} AS labels FROM s JOIN t USING (id)",
        encoded_cte("s", "en") + ", " + encoded_cte("t", "ka", prefix="<s> "),
    ),
)
def _(spark, sf):
    return _text(_encoded(spark, sf, target_prefix="<s> "), "input_ids", "attention_mask", "labels")


_PAD = f"list_transform(range(0, {LENGTH}), lambda x: 0)"


def hashed(c: str) -> str:
    ids = f"list_transform({words(c)}, lambda w: CAST(CAST('0x' || substr(md5(w), 1, 8) AS UBIGINT) % 1000 AS BIGINT))"
    return joined(f"list_concat({ids}, {_PAD})[1:{LENGTH}]")


def hashed_mask(c: str) -> str:
    return joined(f"list_concat(list_transform({words(c)}, lambda w: 1), {_PAD})[1:{LENGTH}]")


@query(
    "hash_tokenize",
    from_pairs(
        f"SELECT id, {hashed('en')} AS input_ids, {hashed_mask('en')} AS attention_mask, {hashed('ka')} AS labels FROM pairs"
    ),
)
def _(spark, sf):
    return _text(_encoded(spark, sf, "hash"), "input_ids", "attention_mask", "labels")


@query(
    "tokenize_fields",
    from_pairs(
        "SELECT id, "
        + ", ".join(
            f"{hashed(c)} AS {f}_input_ids, {hashed_mask(c)} AS {f}_attention_mask"
            for f, c in (("title", "coalesce(title, '')"), ("ka", "ka"), ("en", "en"))
        )
        + " FROM pairs"
    ),
)
def _(spark, sf):
    names = [f"{f}_{x}" for f in ("title", "ka", "en") for x in ("input_ids", "attention_mask")]
    return _text(E.hash_encode(pairs(spark, sf), max_length=LENGTH).select("id", *names), *names)


@query(
    "set_language_tag",
    vocabulary_sql(
        f"SELECT id, {joined('CASE WHEN ids[1] <> 0 THEN list_concat([9001], ids[2:]) ELSE ids END')} AS labels FROM t",
        encoded_cte("t", "ka"),
    ),
)
def _(spark, sf):
    done = _encoded(spark, sf, "m2m100_multilingual", target_lang_id=9001)
    return _text(done.select("id", "labels"), "labels")


@query(
    "encoder_decoder_inputs",
    vocabulary_sql(
        f"""SELECT s.id, {joined('s.ids')} AS input_ids, {joined(mask_sql('s.ids'))} AS attention_mask,
        {joined(ignore_sql('t.ids'))} AS labels, {joined(mask_sql('t.ids'))} AS decoder_attention_mask FROM s JOIN t USING (id)""",
        encoded_cte("s", "en", tail="</s>") + ", " + encoded_cte("t", "ka"),
    ),
)
def _(spark, sf):
    done = _encoded(spark, sf, "encoder_decoder")
    return _text(done, "input_ids", "attention_mask", "labels", "decoder_attention_mask")


# Every second row gets a leading BOS, so that both branches of the shift occur.
_BOS = f"""b AS (SELECT id, CASE WHEN md5(id) < '8' THEN list_concat([2], ids)[1:{LENGTH}] ELSE ids END AS ids FROM t),
l AS (SELECT id, ids[1] = 2 AS moves, {ignore_sql('ids')} AS l, {mask_sql('ids')} AS m FROM b),
sh AS (SELECT id, CASE WHEN moves THEN list_concat(l[2:], [-100]) ELSE l END AS l, CASE WHEN moves THEN list_concat(m[2:], [0]) ELSE m END AS m FROM l)"""


@query(
    "shift_for_decoder",
    vocabulary_sql(
        f"""SELECT id, {joined('l')} AS labels, {joined('m')} AS decoder_attention_mask,
        {joined(f'list_transform(list_concat([2], l[1:{LENGTH - 1}]), lambda x: CASE WHEN x = -100 THEN 0 ELSE x END)')} AS decoder_input_ids FROM sh""",
        encoded_cte("t", "ka") + ", " + _BOS,
    ),
)
def _(spark, sf):
    plain = _encoded(spark, sf).select("id", F.col("labels").alias("ids"))
    first = F.when(F.md5("id") < "8", F.slice(F.concat(F.array(F.lit(E.BOS)), "ids"), 1, LENGTH)).otherwise(F.col("ids"))
    rows = plain.withColumn("ids", first).select(
        "id", A.ignore_padding(F.col("ids"), E.PAD).alias("labels"), A.mask(F.col("ids"), E.PAD).alias("decoder_attention_mask")
    )
    return _text(E.shift_for_decoder(rows), "labels", "decoder_attention_mask", "decoder_input_ids")


_FRAMED = f"""f1 AS (SELECT s.id, list_concat([2], s.ids[1:{LENGTH - 1}]) AS ids, list_concat([2], t.ids[1:{LENGTH - 1}]) AS labels FROM s JOIN t USING (id)),
f2 AS (SELECT id, labels, ids, list_max(list_transform(range(1, {LENGTH + 1}), lambda i: CASE WHEN ids[i] <> 0 THEN i ELSE 0 END)) AS last FROM f1)"""


@query(
    "frame_sequences",
    vocabulary_sql(
        f"""SELECT id, {joined('labels')} AS labels, {joined(f'list_transform(range(1, {LENGTH + 1}), lambda i: CASE WHEN i = least(last + 1, {LENGTH}) THEN 3 ELSE ids[i] END)')} AS input_ids FROM f2""",
        encoded_cte("s", "en") + ", " + encoded_cte("t", "ka") + ", " + _FRAMED,
    ),
)
def _(spark, sf):
    done = E.frame_sequences(_encoded(spark, sf).select("id", "input_ids", "labels"))
    return _text(done, "input_ids", "labels")


@query(
    "decode_ids",
    vocabulary_sql(
        f"""SELECT id, coalesce(string_agg(w, ' ' ORDER BY pos), '') AS text FROM (SELECT id, pos, CASE WHEN x = 1 THEN '<unk>' ELSE token END AS w FROM
        (SELECT id, unnest(range(1, {LENGTH + 1})) AS pos, unnest(ids) AS x FROM t) LEFT JOIN vocab ON token_id = x) GROUP BY id""",
        encoded_cte("t", "ka"),
    ),
)
def _(spark, sf):
    corpus = pairs(spark, sf)
    vocabulary = E.fit_vocabulary(corpus, SIZE)
    params = {"vocabulary": vocabulary, "vocabulary_size": SIZE, "max_length": LENGTH}
    encoded = E.words_tokenizer(corpus, params)
    labels = A.ignore_padding(F.col("labels"), E.PAD)
    return E.decode(encoded.select("id", labels.alias("labels")), "labels", vocabulary)
