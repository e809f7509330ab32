"""Byte-level BPE by recursive DuckDB queries inside Spark tasks, for rank files (tiktoken's format).

Every task has a small in-memory database with the merge table (pair of ids, rank of what they
make) and the vocabulary. Words that are new to the task go in as token-position rows; a
recursive query joins neighbours with the merge table and contracts each word's leftmost pair of
the lowest rank until no pair is left. Decoding joins the vocabulary and aggregates in order.
"""

from __future__ import annotations

import base64
from collections.abc import Callable
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql.types import ArrayType, BinaryType, IntegerType, StructField

from .bpe import Memo, chunks
from .common import add_columns

#: Bytes of words, or ids, that one query gets; a single longer word goes alone.
SLICE = 400_000
#: Words of more bytes are cut where no token can reach across, and contracted by `LONG`.
WORD_BYTES = 48
MEMORY = "768MB"

#: One contraction a word and step. A row knows the next token (nx) and its place (np). `k` orders
#: pairs by rank, then place. The first row of a contracted pair goes, the second becomes what
#: they make, and the row before learns of it.
SHORT = """
WITH RECURSIVE s AS (
  SELECT w, p, t, nx, np, true AS live FROM start
  UNION ALL
  (WITH pairs AS MATERIALIZED (
     SELECT w, p, t, nx, np, CAST(rank AS BIGINT) << 32 | p AS k
     FROM s LEFT JOIN merges ON pair = (CAST(t AS BIGINT) << 32 | nx) WHERE live),
   first AS (SELECT w, min(k) AS least, arg_min(np, k) AS second FROM pairs GROUP BY w)
   SELECT w, p, CASE WHEN p = second THEN CAST(least >> 32 AS INTEGER) ELSE t END,
     CASE WHEN np = least & 4294967295 THEN CAST(least >> 32 AS INTEGER) ELSE nx END,
     CASE WHEN np = least & 4294967295 THEN second ELSE np END, least IS NOT NULL
   FROM pairs JOIN first USING (w) WHERE least IS NULL OR k IS DISTINCT FROM least))
SELECT w, list(t ORDER BY p) AS ids FROM s WHERE NOT live GROUP BY w ORDER BY w
"""

#: The same by windows, but a word's leftmost pair of the lowest rank is contracted wherever the same
#: token comes of it, up to the first place where what it makes forms a pair of a lower rank with
#: a neighbour (`risky`): until then, one contraction after the other would choose the same
#: places. Of places that overlap, every second from the left counts.
LONG = """
WITH RECURSIVE s AS (
  SELECT w, p, t, true AS live FROM start
  UNION ALL
  SELECT w, p, CASE WHEN here THEN rank ELSE t END, least IS NOT NULL
  FROM (
    SELECT *, coalesce(lag(here) OVER (PARTITION BY w ORDER BY p), false) AS gone
    FROM (
      SELECT *, coalesce(found AND (n - other) % 2 = 1 AND n <= coalesce(min(CASE WHEN risky THEN n END) OVER (PARTITION BY w), n), false) AS here
      FROM (
        SELECT f.*, found AND least(f.twin, a.rank, b.rank) < f.rank AS risky,
          coalesce(max(CASE WHEN found THEN NULL ELSE n END) OVER (PARTITION BY w ORDER BY p), 0) AS other
        FROM (
          SELECT *, coalesce(rank = least, false) AS found,
            CASE WHEN rank = least THEN CAST(pv AS BIGINT) << 32 | rank END AS left_pair,
            CASE WHEN rank = least THEN CAST(rank AS BIGINT) << 32 | nx2 END AS right_pair
          FROM (
            SELECT *, min(rank) OVER (PARTITION BY w) AS least
            FROM (
              SELECT w, p, t, row_number() OVER o AS n, lag(t) OVER o AS pv, lead(t, 2) OVER o AS nx2, CAST(t AS BIGINT) << 32 | lead(t) OVER o AS pair
              FROM s WHERE live WINDOW o AS (PARTITION BY w ORDER BY p))
            LEFT JOIN merges USING (pair))) AS f
        LEFT JOIN merges AS a ON a.pair = left_pair
        LEFT JOIN merges AS b ON b.pair = right_pair)))
  WHERE NOT gone)
SELECT w, list(t ORDER BY p) AS ids FROM s WHERE NOT live GROUP BY w ORDER BY w
"""

DECODE = "SELECT d, list(s ORDER BY p) AS s FROM tokens JOIN vocabulary USING (id) GROUP BY d ORDER BY d"


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in f if line.strip())}


@lru_cache(1)
def _other_classes() -> dict[int, str]:
    """Characters that tiktoken's tables of Unicode class otherwise than those of the regex module
    (the two follow different versions), each with a character of the class that tiktoken sees."""
    import tiktoken

    text = "".join(map(chr, [*range(0x80, 0xD800), *range(0xE000, 0x33480), *range(0xE0000, 0xE0200)]))
    bytes_ = {bytes([b]): b for b in range(256)}
    seen: dict[str, str] = {}
    own: dict[str, str] = {}
    for kind, example in ((r"\p{L}", "a"), (r"\p{N}", "1"), (r"\s", " ")):
        tokens = tiktoken.Encoding("classes", pat_str=kind, mergeable_ranks=bytes_, special_tokens={})
        seen.update(dict.fromkeys(bytes(tokens.encode_ordinary(text)).decode(), example))
        own.update(dict.fromkeys(regex.findall(kind, text), example))
    return {ord(c): seen.get(c, "!") for c in seen.keys() | own.keys() if seen.get(c) != own.get(c)}


class Codec:
    """The database of a task, and the words it has met."""

    def __init__(self, path: str, pattern: str, memo: int) -> None:
        import duckdb

        self.ranks = read_ranks(path)
        self.pattern, self.odd = regex.compile(pattern), _other_classes()
        self.byte_ids = np.array([self.ranks[bytes([b])] for b in range(256)], np.int32)
        pairs = [(self.ranks[t[:i]], self.ranks[t[i:]], r) for t, r in self.ranks.items() for i in range(1, len(t)) if t[:i] in self.ranks and t[i:] in self.ranks]
        left, right, made = np.array(pairs, np.int64).T
        # the rank of two of what a merge makes, side by side
        made_of = dict(zip((left << 32 | right).tolist(), made.tolist()))
        twin = pa.array([made_of.get(m << 32 | m) for m in made.tolist()], pa.int32())
        self._reach()
        # no folder to spill to: what a query gets is bounded
        self.db = duckdb.connect(config={"threads": 1, "memory_limit": MEMORY, "temp_directory": "", "preserve_insertion_order": False})
        merges = pa.table({"pair": left << 32 | right, "rank": made.astype(np.int32), "twin": twin})
        vocabulary = pa.table({"id": pa.array(self.ranks.values(), pa.int32()), "s": pa.array(self.ranks, pa.binary())})
        for name, rows in (("merges", merges), ("vocabulary", vocabulary)):
            self.db.register("rows", rows)
            self.db.execute(f"CREATE TABLE {name} AS SELECT * FROM rows")
            self.db.unregister("rows")
        self.words = Memo(lambda w: self._contract([w])[0], memo // 2)
        self.pieces = Memo(lambda p: self.new([p if p[0] == "\n" else " " + p])[0], memo)

    def _reach(self) -> None:
        """Two bytes that are a token, and three bytes that stand side by side in one."""
        self.two, self.three = np.zeros(1 << 16, bool), np.zeros(1 << 24, bool)
        for t in self.ranks:
            if len(t) == 2:
                self.two[t[0] << 8 | t[1]] = True
            for i in range(len(t) - 2):
                self.three[t[i] << 16 | t[i + 1] << 8 | t[i + 2]] = True

    def _cut(self, word: bytes) -> list[bytes]:
        """A long word cut where no token can reach across: it would be the two bytes at the cut,
        or hold three that include them."""
        x = np.frombuffer(word, np.uint8).astype(np.int32)
        pairs = x[:-1] << 8 | x[1:]
        three = self.three[pairs[:-1] << 8 | x[2:]]
        tied = self.two[pairs]
        tied[1:] |= three
        tied[:-1] |= three
        ends = [*(np.flatnonzero(~tied) + 1).tolist(), len(word)]
        return [word[a:b] for a, b in zip([0, *ends[:-1]], ends, strict=True)]

    def _query(self, sql: str, words: list[bytes]) -> list[bytes]:
        sizes = np.array([len(w) for w in words])
        at = np.repeat(np.cumsum(sizes) - sizes, sizes)
        tokens = self.byte_ids[np.frombuffer(b"".join(words), np.uint8)]
        places = (np.arange(len(tokens)) - at).astype(np.int32)
        last = np.zeros(len(tokens), bool)
        last[np.cumsum(sizes) - 1] = True
        start = pa.table({
            "w": np.repeat(np.arange(len(words), dtype=np.int32), sizes), "p": places, "t": tokens,
            "nx": pa.array(np.append(tokens[1:], tokens[:1]), mask=last), "np": pa.array(places + np.int32(1), mask=last),
        })
        self.db.register("start", start)
        ids = self.db.sql(sql).to_arrow_table().column("ids").combine_chunks()
        self.db.unregister("start")
        ends, values = ids.offsets.to_numpy(), ids.values.to_numpy(zero_copy_only=False).astype(np.int32)
        return [values[a:b].tobytes() for a, b in zip(ends[:-1], ends[1:], strict=True)]

    def _contract(self, words: list[str]) -> list[bytes]:
        """Ids of words, as native 32-bit integers; a word that is a token is that token."""
        data = [w.encode() for w in words]
        ranks = list(map(self.ranks.get, data))
        out = [b"" if r is None else np.int32(r).tobytes() for r in ranks]
        short = [i for i, r in enumerate(ranks) if r is None and len(data[i]) <= WORD_BYTES]
        for i, ids in zip(short, self._in_slices(SHORT, [data[i] for i in short]), strict=True):
            out[i] = ids
        cut = {i: self._cut(data[i]) for i, r in enumerate(ranks) if r is None and len(data[i]) > WORD_BYTES}
        parts = list(dict.fromkeys(p for ps in cut.values() for p in ps))
        small, large = [p for p in parts if len(p) <= WORD_BYTES], [p for p in parts if len(p) > WORD_BYTES]
        done = dict(zip(small + large, self._in_slices(SHORT, small) + self._in_slices(LONG, large), strict=True))
        for i, ps in cut.items():
            out[i] = b"".join([done[p] for p in ps])
        return out

    def _in_slices(self, sql: str, words: list[bytes]) -> list[bytes]:
        out: list[bytes] = []
        while len(out) < len(words):
            end, size = len(out), 0
            while end < len(words) and (size == 0 or size + len(words[end]) <= SLICE):
                size += len(words[end])
                end += 1
            out += self._query(sql, words[len(out) : end])
        return out

    def _split(self, piece: str) -> list[str]:
        """Matches of the pattern, with characters classed as the library does."""
        plain = piece.translate(self.odd)
        return [piece[m.start() : m.end()] for m in self.pattern.finditer(plain)]

    def new(self, pieces: list[str]) -> list[bytes]:
        """Ids of pieces that are not in the memo: one round of queries for all their new words."""
        split = [self.pattern.findall(p) if p.isascii() else self._split(p) for p in pieces]
        known = self.words
        ids = {w: known.get(w) or known.old.get(w) for ws in split for w in ws}
        missing = [w for w, code in ids.items() if code is None]
        ids.update(zip(missing, self._contract(missing), strict=True))
        for w in missing:
            known.put(w, ids[w])
        return [b"".join([ids[w] for w in ws]) for ws in split]

    def encode_all(self, texts: list[str]) -> list[bytes]:
        """Ids of every text, as native 32-bit integers."""
        cut = [chunks(t) if t else ("", []) for t in texts]
        rows = [rest for _, rest in cut]
        memo = self.pieces
        codes = [list(map(memo.get, row)) for row in rows]
        missing = dict.fromkeys(p for row, code in zip(rows, codes, strict=True) if None in code for p, c in zip(row, code, strict=True) if c is None)
        found = {p: memo.old.get(p) for p in missing}
        asked = [p for p, c in found.items() if c is None]
        # pieces behind the first have lost their leading space
        whole = [first for first, _ in cut] + [p if p[0] == "\n" else " " + p for p in asked]
        new = self.new(whole)
        found.update(zip(asked, new[len(cut) :], strict=True))
        out = [
            first + b"".join(code if None not in code else [found[p] if c is None else c for p, c in zip(row, code, strict=True)])
            for first, row, code in zip(new[: len(cut)], rows, codes, strict=True)
        ]
        for p, c in found.items():
            memo.put(p, c)
        return out

    def decode_all(self, ids: list[np.ndarray]) -> list[bytes]:
        """The bytes of every id list, by ordered aggregation; lists of more than SLICE ids in parts."""
        parts = [(i, x[a : a + SLICE]) for i, x in enumerate(ids) for a in range(0, len(x), SLICE)]
        out: list[list[bytes]] = [[] for _ in ids]
        at = 0
        while at < len(parts):
            end, size = at, 0
            while end < len(parts) and (size == 0 or size + len(parts[end][1]) <= SLICE):
                size += len(parts[end][1])
                end += 1
            some = [x for _, x in parts[at:end]]
            sizes = np.array([len(x) for x in some])
            places = np.arange(size)
            tokens = pa.table({"d": np.repeat(np.arange(len(some), dtype=np.int32), sizes), "p": places, "id": np.concatenate(some).astype(np.int32)})
            self.db.register("tokens", tokens)
            lists = self.db.sql(DECODE).to_arrow_table().column("s").combine_chunks()
            self.db.unregister("tokens")
            # the strings of a list lie side by side in the buffer of all strings
            strings = lists.values
            if len(strings) != size:
                raise ValueError("ids outside the vocabulary")
            wide = np.int64 if pa.types.is_large_binary(strings.type) else np.int32
            ends = np.frombuffer(strings.buffers()[1], wide)[strings.offset : strings.offset + len(strings) + 1][lists.offsets.to_numpy()]
            data = memoryview(strings.buffers()[2]) if strings.buffers()[2] is not None else memoryview(b"")
            for (i, _), a, b in zip(parts[at:end], ends[:-1].tolist(), ends[1:].tolist(), strict=True):
                out[i].append(bytes(data[a:b]))
            at = end
        return [b"".join(x) for x in out]


@lru_cache(1)
def _codec(path: str, pattern: str, memo: int) -> Codec:
    """One codec for all tasks of a worker."""
    return Codec(path, pattern, memo)


def encoder(path: str, pattern: str, text: str, memo: int) -> Callable[[pa.RecordBatch], list[pa.Array]]:
    """The function that encodes a batch, for use in a task."""
    codec = _codec(path, pattern, memo)

    def make(batch: pa.RecordBatch) -> list[pa.Array]:
        codes = codec.encode_all([t or "" for t in batch.column(text).to_pylist()])
        ends = np.cumsum([0, *[len(c) // 4 for c in codes]], dtype=np.int64).astype(np.int32)
        return [pa.ListArray.from_arrays(pa.array(ends), pa.array(np.frombuffer(b"".join(codes), dtype=np.int32)))]

    return make


def decoder(path: str, pattern: str, ids: str, memo: int) -> Callable[[pa.RecordBatch], list[pa.Array]]:
    """The function that decodes a batch, for use in a task."""
    codec = _codec(path, pattern, memo)

    def make(batch: pa.RecordBatch) -> list[pa.Array]:
        column = batch.column(ids)
        ends, values = column.offsets.to_numpy(), column.values.to_numpy(zero_copy_only=False)
        null = column.is_null().to_pylist()
        lists = [values[:0] if n else values[a:b] for a, b, n in zip(ends[:-1], ends[1:], null, strict=True)]
        return [pa.array(codec.decode_all(lists), pa.binary())]

    return make


def encode_documents(df: DataFrame, path: str, pattern: str, text: str = "text", ids: str = "ids", memo: int = 400_000) -> DataFrame:
    """Adds `ids`: the ids of every match of `pattern` in the whole `text`, each encoded for itself.

    NULL and empty texts give an empty list; repeated rows are encoded each for itself; a column
    named like `ids` is replaced and all others stay. Words of any length are encoded. `pattern`
    must keep a single blank between non-blanks apart from what is before it, as
    public_tokenizers.PATTERN does. The memo is bounded by `memo` entries and changes no result.
    """
    return add_columns(df, [StructField(ids, ArrayType(IntegerType(), True))], lambda: encoder(path, pattern, text, memo))


def decode_ids(df: DataFrame, path: str, pattern: str, ids: str = "ids", decoded: str = "decoded", memo: int = 400_000) -> DataFrame:
    """Adds `decoded`: the bytes of `ids` in order, which need not be UTF-8. NULL and empty lists give no bytes;
    an id that is not in the vocabulary is an error."""
    return add_columns(df, [StructField(decoded, BinaryType())], lambda: decoder(path, pattern, ids, memo))
