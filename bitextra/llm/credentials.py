"""Secrets in texts: plain patterns, and weak parts that count only beside what completes them."""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections import Counter
from math import log2

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

from .common import add_columns

#: Kinds in the order in which spans of one start are listed.
BASE = ("assign", "access", "hex")
KINDS = (*BASE, "identifier", "secret", "endpoint")

_ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII
)
_NAMES = ("password", "passwd", "secret", "token", "apikey", "api_key")
_ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
_HEX = re.compile(r"[0-9a-f]{24,}")
# weak parts: each is common in harmless text
_IDENTIFIER = re.compile(
    r"""(?<![A-Za-z0-9])(?:user(?:_?name)?|login|account|client_?id|access_?(?:key_?)?id|key_?id)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.@-]{3,})""",
    re.IGNORECASE | re.ASCII,
)
_ENDPOINT = re.compile(
    r"\b(?:[a-z][a-z0-9+.-]{1,15}://[^\s\"'<>]{4,}|(?:\d{1,3}\.){3}\d{1,3}:\d{2,5}\b|[a-z0-9-]+(?:\.[a-z0-9-]+)+:\d{2,5}\b)", re.ASCII
)
_OPAQUE = re.compile(r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{16,}(?![A-Za-z0-9+/_=-])")
_BLANK_LINE = re.compile(r"\n[ \t\r]*\n")
#: What completes what: a weak part is reported beside one of these kinds.
PARTNERS = {
    "identifier": ("assign", "hex", "secret"),
    "secret": ("access", "identifier", "endpoint"),
    "endpoint": ("assign", "access", "hex", "secret"),
}

Span = tuple[str, int, int]


def base_spans(text: str) -> list[Span]:
    """Strong patterns, leftmost and not overlapping within a kind; matches that are too short go."""
    low = text.lower()
    found: list[Span] = []
    if any(n in low for n in _NAMES):
        found += [("assign", *m.span()) for m in _ASSIGN.finditer(text) if len(m[2]) >= 6]
    if "AKIA" in text:
        found += [("access", *m.span()) for m in _ACCESS.finditer(text)]
    return found + [("hex", *m.span()) for m in _HEX.finditer(text)]


def opaque(value: str) -> bool:
    """Looks drawn at random: letters of both cases or letters and digits, and much information a character."""
    if not any(c.isdigit() for c in value) or not any(c.isalpha() for c in value):
        return False
    n = len(value)
    return -sum(k / n * log2(k / n) for k in Counter(value).values()) >= 3.2


def weak_spans(text: str) -> list[Span]:
    found: list[Span] = []
    if ":" in text or "=" in text:
        found += [("identifier", *m.span()) for m in _IDENTIFIER.finditer(text)]
        if ":" in text:
            found += [("endpoint", *m.span()) for m in _ENDPOINT.finditer(text)]
    return found + [("secret", *m.span()) for m in _OPAQUE.finditer(text) if opaque(m[0])]


def link(text: str, strong: list[Span], weak: list[Span], reach: int | None = None) -> list[Span]:
    """Weak spans that have a complementary part in the same scope, and within `reach` characters if that is given.

    Scopes are the blocks between blank lines. It is an interval join by sorted starts: a
    weak span meets only the nearest part before and behind it of each partner kind, so its
    cost does not grow with the pairs. A part inside the span itself is no partner, nor is
    one that covers it.
    """
    if not weak:
        return []
    breaks = [m.end() for m in _BLANK_LINE.finditer(text)]
    parts: dict[tuple[str, int], tuple[list[int], list[int]]] = {}
    scope = lambda at: bisect_left(breaks, at + 1)
    for kind, a, b in sorted([*strong, *weak], key=lambda s: s[1]):
        starts, ends = parts.setdefault((kind, scope(a)), ([], []))
        starts.append(a)
        ends.append(b)
    out = []
    for kind, a, b in weak:
        for other in PARTNERS[kind]:
            starts, ends = parts.get((other, scope(a)), ([], []))
            # parts of one kind do not overlap, so ends are in order, too
            before, behind = bisect_right(ends, a), bisect_left(starts, b)
            gaps = [a - y for y in ends[max(0, before - 1) : before]] + [x - b for x in starts[behind : behind + 1]]
            if any(reach is None or gap <= reach for gap in gaps):
                out.append((kind, a, b))
                break
    return out


def find(value: str | None, reach: int | None = None) -> list[dict]:
    """All spans of a text, by start and kind."""
    if not value:
        return []
    strong = base_spans(value)
    weak = weak_spans(value)
    if weak:
        taken = sorted((a, b) for _, a, b in strong)
        ends, top = [], 0
        for _, b in taken:
            top = max(top, b)
            ends.append(top)
        free = []
        for s in weak:
            at = bisect_left(taken, (s[2], 0))
            if not at or ends[at - 1] <= s[1]:
                free.append(s)
        weak = link(value, strong, free, reach)
    found = sorted([*strong, *weak], key=lambda s: (s[1], KINDS.index(s[0]), s[2]))
    return [{"kind": k, "start": a, "end": b} for k, a, b in found]


def find_secrets(df: DataFrame, text: str = "text", spans: str = "spans", reach: int | None = None) -> DataFrame:
    """Adds `spans`: array of (kind, start, end), by start and kind; code points, end exclusive.

    Kinds `assign`, `access` and `hex` are always reported. `identifier`, `secret` and
    `endpoint` are weak and reported only where complementary parts co-occur in a scope (see `link`;
    a caller may ask for partners within `reach` characters only); a
    weak span that overlaps a strong one is left out. NULL and empty texts have no span;
    every row is judged by itself; a column named like `spans` is replaced.
    """

    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
    parts = StructType([StructField("kind", StringType()), StructField("start", LongType()), StructField("end", LongType())])
    start = lambda: lambda b: [pa.array([find(t, reach) for t in b.column(text).to_pylist()], kind)]
    return add_columns(df, [StructField(spans, ArrayType(parts))], start)


def redact(df: DataFrame, text: str = "text", reach: int | None = None, mark: str = "[REDACTED]") -> DataFrame:
    """`text` with every reported span replaced by `mark`; overlapping spans become one mark.

    NULL stays NULL. Rows and other columns stay as they are.
    """
    names = df.columns

    def clean(value: str | None) -> str | None:
        parts, at = [], 0
        for s in find(value, reach):
            if s["end"] <= at:
                continue
            if s["start"] >= at:
                parts += [value[at : s["start"]], mark]
            at = s["end"]
        return "".join([*parts, value[at:]]) if at else value

    def run(batches):
        for b in batches:
            texts = pa.array([clean(t) for t in b.column(text).to_pylist()], pa.string())
            yield pa.RecordBatch.from_arrays([texts if c == text else b.column(c) for c in names], names=names)

    return df.mapInArrow(run, df.schema)
