"""Array functions over token arrays: n-grams, padding, masks, label shifts."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def let(value: Column, body) -> Column:
    """body(value) with `value` computed once, however often the body mentions it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def ngrams(tokens: Column, n: int, sep: str = " ") -> Column:
    """All n-grams in order, each put together at once from the tokens at its place and behind it."""

    def at(t: Column) -> Column:
        starts = F.slice(t, F.lit(1), F.greatest(F.size(t) - (n - 1), F.lit(0)))
        gram = lambda x, i: F.concat(x, *[y for k in range(1, n) for y in (F.lit(sep), F.get(t, i + k))])
        return F.transform(starts, gram)

    return let(tokens, at)


def pad(ids: Column, length: int, value: int) -> Column:
    """Cut or right-pad to exactly `length` entries."""
    return F.slice(F.concat(ids, F.array_repeat(F.lit(value), length)), 1, length)


def mask(ids: Column, pad_id: int) -> Column:
    return F.transform(ids, lambda x: (x != pad_id).cast("int"))


def put(ids: Column, at: Column, value: int) -> Column:
    """`value` at 0-based position `at`; nothing changes when `at` is outside."""
    both = F.struct(ids.alias("ids"), at.alias("at"))
    return let(both, lambda s: F.transform(s["ids"], lambda x, i: F.when(i == s["at"], F.lit(value)).otherwise(x)))


def replace_first(ids: Column, test, value: int) -> Column:
    """Put `value` in place of the first entry for which `test` holds."""
    return put(ids, F.array_position(F.transform(ids, lambda x: test(x).cast("int")), 1) - 1, value)


def set_language_tag(labels: Column, pad_id: int, tag_id: int) -> Column:
    return replace_first(labels, lambda x: x != pad_id, tag_id)


def ignore_padding(labels: Column, pad_id: int, ignore: int = -100) -> Column:
    return F.transform(labels, lambda x: F.when(x == pad_id, F.lit(ignore)).otherwise(x))


def starts_with(ids: Column, token: int) -> Column:
    return F.coalesce(F.get(ids, F.lit(0)) == token, F.lit(False))


def shift_left(ids: Column, fill: int) -> Column:
    return F.concat(F.slice(ids, F.lit(2), F.greatest(F.size(ids) - 1, F.lit(0))), F.array(F.lit(fill)))


def decoder_inputs(labels: Column, bos_id: int, pad_id: int, ignore: int = -100) -> Column:
    shifted = F.concat(F.array(F.lit(bos_id)), F.slice(labels, F.lit(1), F.size(labels) - 1))
    return F.transform(shifted, lambda x: F.when(x == ignore, F.lit(pad_id)).otherwise(x))


def ensure_bos(ids: Column, bos_id: int) -> Column:
    shifted = F.concat(F.array(F.lit(bos_id)), F.slice(ids, F.lit(1), F.size(ids) - 1))
    return F.when(starts_with(ids, bos_id), ids).otherwise(shifted)


def ensure_eos(ids: Column, eos_id: int, pad_id: int) -> Column:
    """EOS behind the last non-pad entry, or in its place when there is no room left."""
    last = F.array_max(F.transform(ids, lambda x, i: F.when(x != pad_id, i).otherwise(-1)))
    fixed = put(ids, F.least(last + 1, F.size(ids) - 1), eos_id)
    keep = (last < 0) | (F.get(ids, last) == eos_id)
    return F.when(keep, ids).otherwise(fixed)
