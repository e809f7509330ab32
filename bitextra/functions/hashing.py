"""Reproducible draws and digests, built on md5 so that any engine can recompute them."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def hash_key(seed: int | str, *parts: Column) -> Column:
    """md5 over seed and parts: the order in which rows are drawn."""
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *[p.cast("string") for p in parts]))


def uniform(seed: int | str, what: str, key: Column, k: int | Column = 0) -> Column:
    """A draw in [0, 1) fixed by (seed, what, key, k), not by row order or partitioning."""
    k = F.lit(k) if isinstance(k, int) else k
    h = hash_key(seed, F.lit(what), key, k)
    return F.conv(F.substring(h, 1, 8), 16, 10).cast("long").cast("double") / F.lit(4294967296.0)


def pick(u: Column, n: int | Column) -> Column:
    """Index in [0, n) from a uniform draw."""
    n = F.lit(n) if isinstance(n, int) else n
    return F.floor(u * n).cast("int")


def digest(*cols: Column) -> Column:
    """NULL-safe content key: equal digests mean equal column values."""
    parts = []
    for c in cols:
        s = c.cast("string")
        parts += [F.coalesce(F.length(s), F.lit(-1)).cast("string"), F.coalesce(s, F.lit(""))]
    return F.md5(F.concat_ws(":", *parts))


def joined_digest(*cols: Column) -> Column:
    """md5 of the '|'-joined values, the key of exact matching between splits."""
    return F.md5(F.concat_ws("|", *[F.coalesce(c.cast("string"), F.lit("")) for c in cols]))
