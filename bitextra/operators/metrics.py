"""Translation metrics: BLEU and chrF++ from n-gram overlap counts."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import ArrayType, LongType

from ..functions import constants as K
from ..registry import evaluators
from .lookup import ensure_checkpoint_dir
from .scoring import score_rows

BLEU_ORDER, CHAR_ORDER, WORD_ORDER, BETA = 4, 6, 2, 2
_PUNCT = frozenset(K.ASCII_PUNCT)

# mteval-v13a tokenisation: entities, then punctuation split off (fixed values).
V13A_ENTITIES = [("&quot;", '"'), ("&amp;", "&"), ("&lt;", "<"), ("&gt;", ">")]
V13A_RULES = [
    (r"([\{-~\[-` -&\(-\+:-@/])", " $1 "),
    (r"([^0-9])([\.,])", "$1 $2 "),
    (r"([\.,])([^0-9])", " $1 $2"),
    (r"([0-9])(-)", "$1 $2 "),
]


# A blank set apart by the first rule stays a blank between tokens, so that rule may leave out the most frequent mark.
_RULES = [(re.compile(p.replace("` -&", "`!-&")), t.replace("$", "\\")) for p, t in V13A_RULES]


def tokenize_13a(text: str) -> list[str]:
    text = text.replace("<skipped>", "").replace("-\n", "").replace("\n", " ")
    for entity, char in V13A_ENTITIES if "&" in text else ():
        text = text.replace(entity, char)
    text = f" {text} "
    for pattern, to in _RULES:
        text = pattern.sub(to, text)
    return text.split()


def chrf_words(text: str) -> list[str]:
    """Words with one punctuation mark split from their end or, failing that, their start."""
    out = []
    for w in text.split():
        if len(w) > 1 and w[-1] in _PUNCT:
            out += (w[:-1], w[-1])
        elif len(w) > 1 and w[0] in _PUNCT:
            out += (w[0], w[1:])
        else:
            out.append(w)
    return out


def chrf_chars(text: str) -> str:
    return "".join(text.split())


# metric -> [(kind of token, n)]; kinds: b = 13a tokens, c = characters, w = words
FAMILIES: dict[str, list[tuple[str, int]]] = {
    "bleu": [("b", n) for n in range(1, BLEU_ORDER + 1)],
    "chrf": [("c", n) for n in range(1, CHAR_ORDER + 1)] + [("w", n) for n in range(1, WORD_ORDER + 1)],
}
# str.split cuts at the blanks of constants.WS
TOKENS: dict[str, Callable[[str], list[str] | str]] = {"b": tokenize_13a, "c": chrf_chars, "w": chrf_words}


def _ids(hyp, ref) -> tuple[np.ndarray, np.ndarray]:
    """Token numbers of both sides, from 0 without gaps; a string counts as its characters."""
    if isinstance(hyp, str):
        both = np.frombuffer((hyp + ref).encode("utf-32-le"), dtype=np.uint32)
        top = int(both.max(initial=0))
        if top < 1 << 16:
            there = np.zeros(top + 1, np.bool_)
            there[both] = True
            numbers = (np.cumsum(there) - 1)[both]
        else:
            numbers = np.unique(both, return_inverse=True)[1].astype(np.int64)
    else:
        known: dict = {}
        numbers = np.fromiter((known.setdefault(w, len(known)) for side in (hyp, ref) for w in side), np.int64, len(hyp) + len(ref))
    return numbers[: len(hyp)], numbers[len(hyp) :]


def ngram_overlap(hyp, ref, top: int) -> list[int]:
    """[matches, n-grams of hyp, n-grams of ref] for n = 1..top; exact, no hashing.

    The numbers of `top` tokens fit into 64 bits for all but very rich texts: then one sort of
    the longest n-grams, with the side in the last bit, puts those of every length in order.
    """
    h1, r1 = _ids(hyp, ref)
    bits = (int(max(h1.max(initial=0), r1.max(initial=0))) + 1).bit_length()
    if top * bits > 63:
        return _overlap_by_numbers(h1, r1, top)
    both = np.concatenate([_packed(x, bits, top) << np.uint64(1) | np.uint64(side) for side, x in enumerate((h1, r1))])
    both.sort()
    refs_before, grams, out = np.cumsum(both & np.uint64(1), dtype=np.int64), both >> np.uint64(1), []
    for n in range(1, top + 1):
        matches = 0
        if len(grams):
            gram = grams >> np.uint64(bits * (top - n))
            ends = np.flatnonzero(np.append(gram[1:] != gram[:-1], True))
            refs = np.diff(refs_before[ends], prepend=0)
            # the end of a text cuts n-grams short: their last token is 0
            whole = gram[ends] & np.uint64((1 << bits) - 1) != 0
            matches = int(np.minimum(refs, np.diff(ends, prepend=-1) - refs)[whole].sum())
        out += [matches, max(0, len(h1) - n + 1), max(0, len(r1) - n + 1)]
    return out


def _packed(numbers: np.ndarray, bits: int, top: int) -> np.ndarray:
    """The `top` tokens from each place on in one number, first token highest; 0 stands behind the end."""
    tokens = (numbers + 1).astype(np.uint64)
    out = np.zeros(len(tokens), np.uint64)
    for n in range(min(top, len(tokens))):
        out[: len(tokens) - n] |= tokens[n:] << np.uint64(bits * (top - 1 - n))
    return out


def _overlap_by_numbers(h1: np.ndarray, r1: np.ndarray, top: int) -> list[int]:
    """`ngram_overlap` of any tokens: an n-gram is numbered by its (n-1)-gram's number and its last
    token, so memory stays linear in the text length.
    """
    base = int(max(h1.max(initial=0), r1.max(initial=0))) + 1
    h, r, out = h1, r1, []
    for n in range(1, top + 1):
        if n > 1:
            h, r = h[:-1] * base + h1[n - 1 :], r[:-1] * base + r1[n - 1 :]
        numbers, seen = np.unique(np.concatenate([h, r]), return_inverse=True)
        h, r = seen[: len(h)], seen[len(h) :]
        counts = [np.bincount(x, minlength=len(numbers)) for x in (h, r)]
        out += [int(np.minimum(*counts).sum()), len(h), len(r)]
    return out


def _overlap_function(kinds: dict[str, int]):
    """Arrow function over the texts of both sides, kind by kind."""

    @F.arrow_udf(ArrayType(LongType()))
    def overlap(texts: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for sides in texts:
            rows = zip(*[c.to_pylist() for c in sides])
            counts = [[x for kind, top in kinds.items() for x in ngram_overlap(*map(TOKENS[kind], row), top)] for row in rows]
            yield pa.array(counts, pa.list_(pa.int64()))

    return overlap


def overlap_counts(
    df: DataFrame,
    keys: list[str],
    families: tuple[str, ...] = ("bleu", "chrf"),
    prediction: str = "prediction",
    reference: str = "reference",
) -> DataFrame:
    """Per row: clipped matches (_m), prediction n-grams (_h) and reference n-grams (_r) by order.

    Only the two texts travel to Python, once for all kinds of tokens; the n-grams of a row, many times
    their size, are counted in place over arrays of numbers. They are neither exploded nor shuffled.
    """
    orders = [o for f in families for o in FAMILIES[f]]
    kinds = {k: max(n for kind, n in orders if kind == k) for k, _ in orders}
    sides = [F.coalesce(F.col(c), F.lit("")) for c in (prediction, reference)]
    counted = df.select(*keys, _overlap_function(kinds)(*sides).alias("_n"))
    at = lambda i: F.get("_n", F.lit(i))
    columns = []
    for i, (k, n) in enumerate(orders):
        matches, hyp, ref = at(3 * i), at(3 * i + 1), at(3 * i + 2)
        if k != "b":  # chrF counts n-grams of a prediction only where the reference has any
            hyp = F.when(ref > 0, hyp).otherwise(F.lit(0).cast("long"))
        columns += [matches.alias(f"{k}{n}_m"), hyp.alias(f"{k}{n}_h"), ref.alias(f"{k}{n}_r")]
    return counted.select(*keys, *columns)


def count_columns(families: tuple[str, ...]) -> list[str]:
    return [f"{k}{n}_{x}" for f in families for k, n in FAMILIES[f] for x in ("m", "h", "r")]


def corpus_counts(per_row: DataFrame, families: tuple[str, ...], by: list[str] | None = None) -> DataFrame:
    sums = [F.sum(c).cast("long").alias(c) for c in count_columns(families)]
    return per_row.groupBy(*by).agg(*sums) if by else per_row.agg(*sums)


def bleu_score() -> Column:
    """BLEU in 0..100 from the b* counts; zero matches are smoothed exponentially."""
    logs, zeros = F.lit(0.0), F.lit(0)
    complete, any_match = F.lit(True), F.lit(False)
    for n in range(1, BLEU_ORDER + 1):
        m, h = F.col(f"b{n}_m"), F.col(f"b{n}_h")
        zeros = zeros + F.when(m == 0, 1).otherwise(0)
        precision = F.when(m == 0, F.lit(100.0) / (F.pow(F.lit(2.0), zeros) * F.greatest(h, F.lit(1)))).otherwise(
            F.lit(100.0) * m / F.greatest(h, F.lit(1))
        )
        logs = logs + F.log(precision)
        complete, any_match = complete & (h > 0), any_match | (m > 0)
    hyp, ref = F.col("b1_h"), F.col("b1_r")
    brevity = F.when(hyp < ref, F.exp(1 - ref / F.greatest(hyp, F.lit(1)))).otherwise(F.lit(1.0))
    score = brevity * F.exp(logs / BLEU_ORDER)
    return F.when(complete & any_match, score).otherwise(F.lit(0.0))


def chrf_score(beta: float = BETA, word_order: int = WORD_ORDER) -> Column:
    """chrF++ in 0..100: mean precision and recall over the orders both sides have."""
    p = r = F.lit(0.0)
    used = F.lit(0)
    for name in [f"c{n}" for n in range(1, CHAR_ORDER + 1)] + [f"w{n}" for n in range(1, word_order + 1)]:
        m, h, t = (F.col(f"{name}_{x}") for x in "mhr")
        both = (h > 0) & (t > 0)
        p = p + F.when(both, m / F.greatest(h, F.lit(1))).otherwise(F.lit(0.0))
        r = r + F.when(both, m / F.greatest(t, F.lit(1))).otherwise(F.lit(0.0))
        used = used + F.when(both, 1).otherwise(0)
    p, r = F.try_divide(p, used), F.try_divide(r, used)
    f = F.try_divide(F.lit(100.0 * (1 + beta**2)) * p * r, F.lit(float(beta**2)) * p + r)
    return F.coalesce(f, F.lit(0.0))


SCORES = {"bleu": bleu_score, "chrf": chrf_score}


def sentence_scores(
    df: DataFrame, key: str = "id", families: tuple[str, ...] = ("bleu", "chrf"), **columns: str
) -> DataFrame:
    """(key, bleu_score, chrf_score) for every row."""
    counts = overlap_counts(df, [key], families, **columns)
    return counts.select(key, *[SCORES[f]().alias(f"{f}_score") for f in families])


def corpus_scores(
    df: DataFrame,
    key: str = "id",
    families: tuple[str, ...] = ("bleu", "chrf"),
    by: list[str] | None = None,
    total: bool = False,
    **columns: str,
) -> DataFrame:
    """Corpus scores in one row or, with `by` (such as dataset or domain), one row per group.

    `total` adds a row for the whole corpus, in which `by` is NULL. It is the sum of the groups' counts,
    which go to the checkpoint folder, so n-grams are counted once.
    """
    counts = overlap_counts(df, [key, *(by or [])], families, **columns)
    sums = corpus_counts(counts, families, by)
    if by and total:
        ensure_checkpoint_dir(df.sparkSession)
        sums = sums.checkpoint()
        whole = corpus_counts(sums, families)
        sums = sums.unionByName(whole.select(*[F.lit(None).cast(sums.schema[c].dataType).alias(c) for c in by], *whole.columns))
    return sums.select(*(by or []), *[SCORES[f]().alias(f) for f in families])


@evaluators("sacrebleu", "Corpus BLEU, 13a tokens, exponential smoothing")
def sacrebleu(df: DataFrame, params: dict) -> DataFrame:
    return corpus_scores(df, families=("bleu",)).withColumnRenamed("bleu", "sacrebleu")


@evaluators("chrf", "Corpus chrF++")
def chrf(df: DataFrame, params: dict) -> DataFrame:
    total = corpus_counts(overlap_counts(df, ["id"], ("chrf",)), ("chrf",))
    return total.select(chrf_score(word_order=int(params.get("word_order", WORD_ORDER))).alias("chrf++"))


@evaluators("georgian_comet", "Model score of (source, prediction, reference); needs `load_model`")
def model_score(df: DataFrame, params: dict) -> DataFrame:
    """Mean and population deviation of a neural metric's row scores.

    `load_model` returns a function from [sources, predictions, references] to scores.
    """
    if "load_model" not in params:
        raise ValueError("georgian_comet needs 'load_model'")
    size = int(params.get("batch_size", 16))
    columns = ["source", "prediction", "reference"]
    scored = score_rows(df, params["load_model"], columns, "_score", size, on_error="fail")
    return scored.agg(F.avg("_score").alias("comet"), population_std("_score").alias("comet_std"))


def evaluate(df: DataFrame, configs: list[dict]) -> dict:
    """Run several evaluators over (id, source, reference, prediction).

    Result keys carry the evaluator's name unless they start with it. An evaluator that
    fails is reported under '{name}_error' and the others go on.
    """
    chosen = [(c["name"], evaluators.get(c["name"]), c.get("config") or {}) for c in configs]
    results: dict = {}
    for name, fn, params in chosen:
        try:
            row = fn(df, params).first().asDict()  # one row of metric values
            results.update({k if k.startswith(name) else f"{name}_{k}": v for k, v in row.items()})
        except Exception as e:  # noqa: BLE001
            results[f"{name}_error"] = str(e)
    return results


def prediction_table(df: DataFrame, step: int, key: str = "id") -> DataFrame:
    """(step, id, source, reference, prediction, bleu_score, chrf_score), joined on the id."""
    scored = df.join(sentence_scores(df, key), key)
    return scored.select(F.lit(step).alias("step"), key, "source", "reference", "prediction", "bleu_score", "chrf_score")


def prediction_summary(table: DataFrame, metrics: tuple[str, ...] = ("bleu", "chrf")) -> DataFrame:
    stats = {"mean": F.avg, "std": F.stddev_samp, "min": F.min, "max": F.max}
    return table.agg(
        F.count(F.lit(1)).alias("eval_samples_count"),
        *[F.avg(F.length(c)).alias(f"avg_{c}_length") for c in ("prediction", "reference", "source")],
        *[fn(f"{m}_score").alias(f"eval_{m}_{s}") for m in metrics for s, fn in stats.items()],
    )


def population_std(c: str) -> Column:
    """0 for fewer than two values."""
    return F.coalesce(F.stddev_pop(c), F.lit(0.0))
