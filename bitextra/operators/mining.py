"""Text mining: TF-IDF and language identification."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window, functions as F
from pyspark.sql.types import ArrayType, BinaryType, DoubleType, IntegerType, StringType, StructField, StructType

from ..functions import constants as K
from .lookup import settled, small_batches
from .pieces import PIECE, pieces, split_words
from .profile import most_frequent

MOST_TERMS = 200_000  # some 10 MB
TERM = r"[\p{L}\p{N}_]{2,}"


BREAK = r"[^\p{L}\p{N}_]+"

ENTRY = StructType().add("term", StringType()).add("feature", IntegerType()).add("weight", DoubleType())
#: The entries of a row as 32-bit integers and doubles, one behind the other.
PACKED = StructType().add("feature", BinaryType()).add("weight", BinaryType())
COUNTED = StructType().add("words", StringType()).add("tf", BinaryType())


def _split(joined: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """Row and word of every word of texts whose words are parted by single spaces."""
    row, words = split_words(joined)
    held = pc.not_equal(words, "")
    return row[held.to_numpy(zero_copy_only=False)], words.filter(held)


def _counted_piece(texts: pa.Array) -> pa.Array:
    row, words = _split(texts)
    coded = words.dictionary_encode()
    known, code = coded.dictionary, coded.indices.to_numpy()
    terms = pc.and_not(pc.greater(pc.utf8_length(known), 1), pc.is_in(known, value_set=pa.array(K.STOP_WORDS, known.type)))
    held = terms.to_numpy(zero_copy_only=False)[code]
    both, tf = np.unique(row[held] * max(1, len(known)) + code[held], return_counts=True)
    offsets = np.searchsorted(both // max(1, len(known)), np.arange(len(texts) + 1)).astype(np.int32)
    joined = pc.binary_join(pa.ListArray.from_arrays(pa.array(offsets), known.take(pa.array(both % max(1, len(known))))), " ")
    return pa.StructArray.from_arrays([joined.cast(pa.string()), packed(offsets, tf.astype(np.int32))], names=["words", "tf"])


def packed(offsets: np.ndarray, numbers: np.ndarray) -> pa.Array:
    """The numbers of each row as bytes; row i holds those from offsets[i] up to offsets[i + 1]."""
    ends = pa.py_buffer((offsets * numbers.itemsize).astype(np.int32))
    return pa.Array.from_buffers(pa.binary(), len(offsets) - 1, [None, ends, pa.py_buffer(np.ascontiguousarray(numbers))])


def unpacked(rows: pa.Array, kind: type) -> np.ndarray:
    """All numbers of such rows, one row's behind the other's."""
    ends = np.frombuffer(rows.buffers()[1], np.int32, len(rows) + 1, rows.offset * 4) if len(rows) else np.zeros(1, np.int32)
    size = np.dtype(kind).itemsize
    data = rows.buffers()[2]
    return np.frombuffer(data, kind, (ends[-1] - ends[0]) // size, ends[0]) if ends[-1] > ends[0] else np.zeros(0, kind)


@F.arrow_udf(COUNTED)
def _counted(texts: pa.Array) -> pa.Array:
    """How often each term occurs in its text: the terms, parted by spaces, and their numbers."""
    parts = [_counted_piece(texts[p]) for p in pieces(texts, PIECE)]
    return pa.concat_arrays(parts) if parts else pa.array([], pa.struct([("words", pa.string()), ("tf", pa.binary())]))


def terms(df: DataFrame, key: str, text) -> DataFrame:
    """(key, terms): how often each lower-cased word of two and more characters occurs in a row, stop words left out."""
    return df.select(key, _counted(F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), BREAK, " ")).alias("terms"))


def _term_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Occurrences and rows of each term, added up for some rows after the other."""
    for batch in batches:
        for part in pieces(batch.column(0), 4 * PIECE):
            words, tf = (c[part] for c in batch.columns)
            coded = _split(words)[1].dictionary_encode()
            code, size = coded.indices.to_numpy(), len(coded.dictionary)
            n = np.bincount(code, unpacked(tf, np.int32), size).astype(np.int64)  # whole numbers below 2^53
            yield pa.RecordBatch.from_arrays([coded.dictionary, pa.array(n), pa.array(np.bincount(code, minlength=size))], names=["term", "n", "df"])


def _weigher(table: pa.Table, shape: str):
    """Function of batches (key, words, tf): the entries of a row with the weights of a row of length 1, in one of three shapes."""
    vocabulary, feature = (table.column(c).combine_chunks() for c in ("term", "feature"))
    idf = table.column("_idf").to_numpy()

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            name = batch.schema.names[0]
            for part in pieces(batch.column(1), PIECE):
                key, words, tf = (c[part] for c in batch.columns)
                row, term = _split(words)
                at = pc.fill_null(pc.index_in(term, value_set=vocabulary.cast(term.type)), -1).to_numpy(zero_copy_only=False)
                known = np.flatnonzero(at >= 0)
                at, row, term = at[known], row[known], term.take(pa.array(known))
                weight = unpacked(tf, np.int32)[known] * idf[at]
                weight /= np.sqrt(np.bincount(row, weight * weight, minlength=len(key)))[row]
                entries = [term, feature.take(pa.array(at)), pa.array(weight)]
                offsets = np.searchsorted(row, np.arange(len(key) + 1)).astype(np.int32)
                if shape == "flat":
                    yield pa.RecordBatch.from_arrays([key.take(pa.array(row)), *entries], names=[name, *ENTRY.names])
                    continue
                if shape == "packed":
                    both = [packed(offsets, entries[1].to_numpy().astype(np.int32)), packed(offsets, weight)]
                    lists = pa.StructArray.from_arrays(both, names=["feature", "weight"])
                else:
                    lists = pa.ListArray.from_arrays(pa.array(offsets), pa.StructArray.from_arrays(entries, names=ENTRY.names))
                yield pa.RecordBatch.from_arrays([key, lists], names=[name, "entries"])

    return weigh


def _weighed(df: DataFrame, key: str, text, features: int, shape: str) -> DataFrame:
    if features > MOST_TERMS:
        raise ValueError(f"at most {MOST_TERMS} features, not {features}")
    with small_batches(df.sparkSession):
        counts = settled(terms(df, key, text), "terms")
        sums = counts.select("terms.words", "terms.tf").mapInArrow(_term_sums, "term string, n long, df long")
        stats = settled(sums.groupBy("term").agg(F.sum("n").alias("_n"), F.sum("df").alias("_df")), "term-counts")
    by_count = [F.desc("_n"), F.asc("term")]
    vocabulary = most_frequent(stats, features, "term", "_n")
    vocabulary = vocabulary.withColumn("feature", F.row_number().over(Window.orderBy(*by_count)) - 1)
    n = counts.count()  # one number
    idf = F.log(F.lit(1.0 + n) / (F.col("_df") + 1)) + 1
    weigh = _weigher(vocabulary.select("term", "feature", idf.alias("_idf")).toArrow(), shape)
    of_row = {"rows": ArrayType(ENTRY), "packed": PACKED}
    kept = [StructField("entries", of_row[shape])] if shape in of_row else ENTRY.fields
    schema = StructType([StructField(key, counts.schema[key].dataType), *kept])
    return counts.select(key, "terms.words", "terms.tf").mapInArrow(weigh, schema)


def tfidf_rows(df: DataFrame, key: str, text, features: int = 5000, pack: bool = False) -> DataFrame:
    """(key, entries of term, feature, weight): tf * (ln((1+N)/(1+df)) + 1), rows of length 1.

    Every row of the table is there, without entries if it holds no term of the vocabulary.
    `pack` gives the entries of a row as two byte strings instead (PACKED), for `latent.lsa`.

    The vocabulary is the `features` most frequent terms, at most MOST_TERMS; this table goes
    to the tasks. Terms are counted and weighed within their rows, once: the counted rows and the counts
    over the corpus go to the checkpoint folder. Only the latter are shuffled. Tasks work on pieces of
    about PIECE bytes, whatever the size of an Arrow batch.
    """
    return _weighed(df, key, text, features, "packed" if pack else "rows")


def tfidf(df: DataFrame, key: str, text, features: int = 5000) -> DataFrame:
    """(key, term, feature, weight): the entries of `tfidf_rows`, a row each."""
    return _weighed(df, key, text, features, "flat")


#: Characters whose grams are counted together; grams whose places a task remembers.
STEP, MEMO = 1 << 17, 1_000_000


def _murmur3(data: bytes, seed: int = 42) -> int:
    """MurmurHash3 (x86, 32 bits), as Spark hashes terms."""
    mask = 0xFFFFFFFF
    mixed = lambda k: ((k * 0xCC9E2D51 & mask) << 15 | (k * 0xCC9E2D51 & mask) >> 17) * 0x1B873593 & mask
    h, whole = seed, len(data) & ~3
    for at in range(0, whole, 4):
        h ^= mixed(int.from_bytes(data[at : at + 4], "little"))
        h = ((h << 13 | h >> 19) & mask) * 5 + 0xE6546B64 & mask
    if whole < len(data):
        h ^= mixed(int.from_bytes(data[whole:], "little"))
    h ^= len(data)
    h = (h ^ h >> 16) * 0x85EBCA6B & mask
    h = (h ^ h >> 13) * 0xC2B2AE35 & mask
    return h ^ h >> 16


class Grams:
    """Places of the character 1- to 3-grams of texts among `features` ones: their hashes, as HashingTF has it."""

    def __init__(self, features: int) -> None:
        self.features = features
        self.memo: dict[int, int] = {}

    def _place(self, key: int) -> int:
        points = [p - 1 for p in (key >> 42, key >> 21 & 0x1FFFFF, key & 0x1FFFFF) if p]
        h = _murmur3(" ".join(map(chr, points)).encode())
        return (h - (1 << 32) if h >> 31 else h) % self.features

    def __call__(self, texts: list[str]) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
        """(from, to, row from there, place) of every gram, for some texts after the other; an empty text has the empty gram."""
        lo = 0
        while lo < len(texts):
            hi, size = lo + 1, len(texts[lo])
            while hi < len(texts) and size + len(texts[hi]) <= STEP:
                size += len(texts[hi])
                hi += 1
            some = texts[lo:hi]
            row = np.repeat(np.arange(hi - lo), [len(t) for t in some])
            one = np.frombuffer("".join(some).encode("utf-32-le"), np.uint32).astype(np.int64) + 1
            two = one[:-1] << 21 | one[1:]
            three = two[:-1] << 21 | one[2:]
            in_two, in_three = row[:-1] == row[1:], row[:-2] == row[2:]
            blank = np.array([i for i, t in enumerate(some) if not t], np.int64)
            coded = pa.array(np.concatenate([one, two[in_two], three[in_three], np.zeros(len(blank), np.int64)])).dictionary_encode()
            if len(self.memo) > MEMO:
                self.memo.clear()
            keys = coded.dictionary.to_pylist()
            for k in keys:
                if k not in self.memo:
                    self.memo[k] = self._place(k)
            places = np.array([self.memo[k] for k in keys], np.int64)[coded.indices.to_numpy()]
            yield lo, hi, np.concatenate([row, row[:-1][in_two], row[:-2][in_three], blank]), places
            lo = hi


@dataclass
class LanguageModel:
    """Multinomial Naive Bayes: log odds of the labels (after them, if there is one, of rows without label) and of grams in them."""

    labels: list[str]
    prior: np.ndarray
    likelihood: np.ndarray

    def scores(self, grams: Grams, texts: list[str]) -> np.ndarray:
        """Best label's number and its probability, a row for each text."""
        out = np.zeros((len(texts), 2))
        for lo, hi, row, place in grams(texts):
            odds = self.prior + np.column_stack([np.bincount(row, c[place], minlength=hi - lo) for c in self.likelihood])
            out[lo:hi, 0] = odds.argmax(axis=1)
            out[lo:hi, 1] = 1 / np.exp(odds - odds.max(axis=1)[:, None]).sum(axis=1)
        return out


def language_model(training: DataFrame, text: str = "text", label: str = "lang", features: int = 1 << 14) -> LanguageModel:
    """Naive Bayes over character 1- to 3-grams, smoothed by one; rows whose text is NULL teach nothing.

    A task adds up its rows' grams; features x labels sums come to the driver.
    """

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams, sums, rows = Grams(features), {}, {}
        for batch in batches:
            kinds, texts = (c.to_pylist() for c in batch.columns)
            for lo, hi, row, place in grams(texts):
                codes = {k: i for i, k in enumerate(dict.fromkeys(kinds[lo:hi]))}
                of = np.array([codes[k] for k in kinds[lo:hi]], np.int64)
                counts = np.bincount(of[row] * features + place, minlength=len(codes) * features).reshape(-1, features)
                for k, i in codes.items():
                    sums[k] = sums.get(k, 0) + counts[i]
                    rows[k] = rows.get(k, 0) + int((of == i).sum())
        for k, counts in sums.items():
            used = np.flatnonzero(counts)
            columns = [pa.array([k] * (len(used) + 1), pa.string()), pa.array([-1, *used], pa.int32()), pa.array([rows[k], *counts[used]], pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=["label", "feature", "n"])

    known = training.where(F.col(text).isNotNull()).select(F.col(label).cast("string"), F.lower(text))
    parts = known.mapInArrow(partial, "label string, feature int, n long")
    found = parts.groupBy("label", "feature").agg(F.sum("n").alias("n")).toArrow()
    kinds, feature, n = (found.column(c).to_pylist() for c in ("label", "feature", "n"))
    labels = sorted({k for k in kinds if k is not None})
    at = {k: i for i, k in enumerate([*labels, *([None] if None in kinds else [])])}
    if not at:
        raise ValueError("no texts to learn languages from")
    sums = np.zeros((len(at), features + 1))
    sums[[at[k] for k in kinds], feature] = n  # the number of rows is the last one
    counts, rows = sums[:, :-1], sums[:, -1]
    prior = np.log(rows + 1) - np.log(rows.sum() + len(at))
    return LanguageModel(labels, prior, np.log(counts + 1) - np.log(counts.sum(axis=1) + features)[:, None])


def detect_language(model: LanguageModel, df: DataFrame, text: str = "text") -> DataFrame:
    """Adds detected_lang and confidence; texts that are NULL or blank are 'unknown' with 0."""

    @F.arrow_udf(ArrayType(DoubleType()))
    def scored(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        grams = Grams(model.likelihood.shape[1])
        for batch in batches:
            found = model.scores(grams, batch.to_pylist())
            yield pa.ListArray.from_arrays(pa.array(np.arange(0, 2 * len(found) + 1, 2, dtype=np.int32)), pa.array(found.ravel()))

    usable = F.coalesce(F.trim(F.col(text)) != "", F.lit(False))
    names = F.array(*[F.lit(x) for x in model.labels]) if model.labels else F.array().cast("array<string>")
    found = df.withColumn("_found", scored(F.lower(F.coalesce(text, F.lit("")))))
    best = F.get(names, F.get("_found", F.lit(0)).cast("int"))
    return found.select(
        *df.columns,
        F.when(usable, best).otherwise(F.lit("unknown")).alias("detected_lang"),
        F.when(usable, F.get("_found", F.lit(1))).otherwise(F.lit(0.0)).alias("confidence"),
    )
