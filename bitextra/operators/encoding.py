"""Texts as fixed-length id arrays, and back."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import ArrayType, DataType, IntegerType, StringType

from ..functions import arrays as A, text as X
from ..registry import tokenizers
from .lookup import repeat_rows
from .profile import most_frequent, word_counts

PAD, UNK, BOS, EOS, SEP = 0, 1, 2, 3, 4
SPECIALS = {"<pad>": PAD, "<unk>": UNK, "<s>": BOS, "</s>": EOS, "<sep>": SEP}
FIRST_WORD = len(SPECIALS)
# A vocabulary of this size is some 10 MB and may go to every task; larger ones join by shuffle.
BROADCAST_VOCABULARY = 200_000


def fit_vocabulary(df: DataFrame, size: int = 32_000) -> DataFrame:
    """(token, token_id): the `size` most frequent words of both sides behind the special ids."""
    counts = word_counts(df).where(F.col("word") != "").groupBy("word").agg(F.sum("count").alias("n"))
    top = most_frequent(counts, size, "word", "n")
    rank = F.row_number().over(Window.orderBy(F.desc("n"), F.asc("word")))  # over `size` rows
    return top.select(F.col("word").alias("token"), (rank + (FIRST_WORD - 1)).cast("int").alias("token_id"))


def _bounded(vocabulary: DataFrame) -> pa.Table | None:
    """The vocabulary itself if it really has at most BROADCAST_VOCABULARY rows, else None."""
    found = vocabulary.select("token", F.col("token_id").cast("int")).limit(BROADCAST_VOCABULARY + 1).toArrow()
    return found if found.num_rows <= BROADCAST_VOCABULARY else None


def _finder(keys: pa.Array, values: pa.Array, kind: DataType):
    """Arrow function: the entries of a list to their values, NULL where there is none."""

    @F.arrow_udf(ArrayType(kind))
    def find(lists: pa.Array) -> pa.Array:
        entries = lists.flatten()
        at = pc.index_in(entries, value_set=keys.cast(entries.type))
        ends = np.cumsum(pc.list_value_length(lists).to_numpy())
        offsets = pa.array(np.concatenate([[0], ends]).astype(np.int32))
        return pa.ListArray.from_arrays(offsets, values.take(at))

    return find


def _by_join(df: DataFrame, key: str, lists: dict[str, Column], table: DataFrame, on: str, to: str, kind: str) -> DataFrame:
    """Lists looked up in a table of any size, a row for every row of `df`.

    Rows with equal key and lists are one row while entries are joined and regrouped, so a
    key that occurs again does not mix rows; in the end they are as many again.
    """
    packed = F.array(*[F.struct(F.lit(n).alias("_field"), c.alias("_w")) for n, c in lists.items()])
    rows = df.select(key, packed.alias("_t")).withColumn("_d", F.md5(F.to_json("_t")))
    rows = rows.groupBy(key, "_d").agg(F.count(F.lit(1)).alias("_same"), F.first("_t").alias("_t"))
    flat = rows.select(key, "_d", "_same", F.inline("_t"))
    flat = flat.select(key, "_d", "_same", "_field", F.posexplode_outer("_w").alias("_at", on))
    found = flat.join(table.select(on, F.col(to).cast(kind).alias("_v")), on, "left")
    item = F.when(F.col("_at").isNotNull(), F.struct("_at", "_v"))
    grouped = found.groupBy(key, "_d", "_same").agg(
        *[F.array_sort(F.collect_list(F.when(F.col("_field") == n, item))).alias(n) for n in lists]
    )
    each = repeat_rows(grouped, "_same")
    return each.select(key, *[F.col(f"{n}._v").alias(n) for n in lists])


def encode(
    df: DataFrame,
    vocabulary: DataFrame,
    fields: dict[str, Column],
    key: str = "id",
    max_length: int = 128,
    tail: dict[str, str] | None = None,
) -> DataFrame:
    """(key, {field}_ids, {field}_mask): whitespace words looked up, cut, padded, masked.

    One row for every row of `df`, whatever its key. A vocabulary of at most
    BROADCAST_VOCABULARY rows, which is counted, goes to the tasks and words are looked up
    where they are; a larger one is joined. `tail` names a special token to append to a field
    before cutting.
    """
    tail = tail or {}
    lists = {}
    for name, c in fields.items():
        w = X.words(F.coalesce(c.cast("string"), F.lit("")))
        if name in tail:
            w = F.concat(w, F.array(F.lit(tail[name])))
        lists[name] = F.slice(w, 1, max_length)
    small = _bounded(vocabulary)
    specials = pa.array(list(SPECIALS)), pa.array(list(SPECIALS.values()), pa.int32())
    if small is not None:
        # the vocabulary comes first, so its own entry for a special token counts
        words, numbers = (small.column(c).combine_chunks() for c in ("token", "token_id"))
        find = _finder(pa.concat_arrays([words.cast(pa.string()), specials[0]]), pa.concat_arrays([numbers, specials[1]]), IntegerType())
        found = df.select(key, *[find(w).alias(n) for n, w in lists.items()])
    else:
        extra = df.sparkSession.createDataFrame(list(SPECIALS.items()), "token string, token_id int")
        extra = extra.join(vocabulary, "token", "left_anti")
        table = vocabulary.select("token", F.col("token_id").cast("int")).unionByName(extra)
        found = _by_join(df, key, lists, table, "token", "token_id", "int")
    known = lambda n: F.transform(n, lambda x: F.coalesce(x, F.lit(UNK)))
    ids = found.select(key, *[A.pad(known(n), max_length, PAD).alias(f"{n}_ids") for n in fields])
    return ids.select(
        key, *[x for n in fields for x in (f"{n}_ids", A.mask(F.col(f"{n}_ids"), PAD).alias(f"{n}_mask"))]
    )


def decode(encoded: DataFrame, ids: str, vocabulary: DataFrame, key: str = "id") -> DataFrame:
    """(key, text): ids back to words; ignored positions and special ids are left out.

    One row for every row of `encoded`; the vocabulary is used as in `encode`.
    """
    # special ids other than the unknown word have no text
    numbers = F.coalesce(F.col(ids).cast("array<int>"), F.array().cast("array<int>"))
    small = _bounded(vocabulary)
    if small is not None:
        words, known = (small.column(c).combine_chunks() for c in ("token", "token_id"))
        find = _finder(pa.concat_arrays([pa.array([UNK], pa.int32()), known]), pa.concat_arrays([pa.array(["<unk>"]), words.cast(pa.string())]), StringType())
        found = encoded.select(key, find(numbers).alias("_w"))
    else:
        unknown = encoded.sparkSession.createDataFrame([("<unk>", UNK)], "token string, token_id int")
        table = vocabulary.where(F.col("token_id") != UNK).select("token", F.col("token_id").cast("int")).unionByName(unknown)
        found = _by_join(encoded, key, {"_w": numbers}, table, "token_id", "token", "string")
    return found.select(key, F.array_join("_w", " ").alias("text"))


def hash_ids(c: Column, max_length: int = 128, buckets: int = 1000) -> Column:
    """Word ids by hashing: no vocabulary, a pure expression. Empty texts are all padding."""
    number = lambda w: F.conv(F.substring(F.md5(w), 1, 8), 16, 10).cast("long")
    ids = F.transform(X.words(F.coalesce(c, F.lit(""))), lambda w: F.pmod(number(w), F.lit(buckets)).cast("int"))
    return A.pad(ids, max_length, PAD)


def hash_mask(c: Column, max_length: int = 128) -> Column:
    n = F.least(F.size(X.words(F.coalesce(c, F.lit("")))), F.lit(max_length))
    return A.pad(F.array_repeat(F.lit(1), n), max_length, 0)


def hash_encode(df: DataFrame, fields: tuple[str, ...] = ("title", "ka", "en"), max_length: int = 128) -> DataFrame:
    """{field}_input_ids and {field}_attention_mask for every field; NULL counts as ''."""
    return df.withColumns(
        {
            **{f"{f}_input_ids": hash_ids(F.col(f), max_length) for f in fields},
            **{f"{f}_attention_mask": hash_mask(F.col(f), max_length) for f in fields},
        }
    )


@tokenizers("words", "Whole words from a fitted vocabulary")
def words_tokenizer(df: DataFrame, params: dict) -> DataFrame:
    """(id, input_ids, attention_mask, labels) of pairs."""
    size = int(params.get("vocabulary_size", 32_000))
    vocabulary = params.get("vocabulary")
    if vocabulary is None:
        vocabulary = fit_vocabulary(df, size)
    prefix = F.lit(params.get("target_prefix", ""))
    target = F.concat(prefix, F.coalesce(F.col(params.get("target_column", "ka")), F.lit("")))
    done = encode(
        df,
        vocabulary,
        {"s": F.col(params.get("source_column", "en")), "t": target},
        max_length=int(params.get("max_length", 128)),
    )
    return done.select(
        "id", F.col("s_ids").alias("input_ids"), F.col("s_mask").alias("attention_mask"), F.col("t_ids").alias("labels")
    )


@tokenizers("hash", "Hashed words, no vocabulary")
def hash_tokenizer(df: DataFrame, params: dict) -> DataFrame:
    n, buckets = int(params.get("max_length", 128)), int(params.get("buckets", 1000))
    source, target = F.col(params.get("source_column", "en")), F.col(params.get("target_column", "ka"))
    target = F.concat(F.lit(params.get("target_prefix", "")), F.coalesce(target, F.lit("")))
    return df.select(
        "id",
        hash_ids(source, n, buckets).alias("input_ids"),
        hash_mask(source, n).alias("attention_mask"),
        hash_ids(target, n, buckets).alias("labels"),
    )


def _multilingual(df: DataFrame, params: dict) -> DataFrame:
    """Like `words`, with the target language's id (`target_lang_id`) as first label."""
    tag = A.set_language_tag(F.col("labels"), PAD, int(params["target_lang_id"]))
    return words_tokenizer(df, params).withColumn("labels", tag)


for _name in ("m2m100_multilingual", "mbart_multilingual"):
    tokenizers(_name, "Words with a target language tag on the labels")(_multilingual)


@tokenizers("encoder_decoder", "Source with EOS, labels with padding ignored, decoder mask")
def encoder_decoder_tokenizer(df: DataFrame, params: dict) -> DataFrame:
    size = int(params.get("vocabulary_size", 32_000))
    vocabulary = params.get("vocabulary")
    if vocabulary is None:
        vocabulary = fit_vocabulary(df, size)
    done = encode(
        df,
        vocabulary,
        {"s": F.col(params.get("source_column", "en")), "t": F.col(params.get("target_column", "ka"))},
        max_length=int(params.get("max_length", 128)),
        tail={"s": "</s>"},
    )
    return done.select(
        "id",
        F.col("s_ids").alias("input_ids"),
        F.col("s_mask").alias("attention_mask"),
        A.ignore_padding(F.col("t_ids"), PAD).alias("labels"),
        F.col("t_mask").alias("decoder_attention_mask"),
    )


def shift_for_decoder(df: DataFrame, bos: int = BOS, pad: int = PAD) -> DataFrame:
    """Labels that start with BOS move left with their mask; decoder inputs are rebuilt."""
    moves = A.starts_with(F.col("labels"), bos)
    shifted = df.withColumns(
        {
            "labels": F.when(moves, A.shift_left(F.col("labels"), -100)).otherwise(F.col("labels")),
            "decoder_attention_mask": F.when(moves, A.shift_left(F.col("decoder_attention_mask"), 0)).otherwise(
                F.col("decoder_attention_mask")
            ),
        }
    )
    return shifted.withColumn("decoder_input_ids", A.decoder_inputs(F.col("labels"), bos, pad))


def frame_sequences(df: DataFrame, bos: int = BOS, eos: int = EOS, sep: int = SEP, pad: int = PAD) -> DataFrame:
    """Inputs: BOS first, SEP becomes EOS, EOS at the end. Labels: BOS first."""
    ids = A.replace_first(A.ensure_bos(F.col("input_ids"), bos), lambda x: x == sep, eos)
    return df.withColumns(
        {"input_ids": A.ensure_eos(ids, eos, pad), "labels": A.ensure_bos(F.col("labels"), bos)}
    )
