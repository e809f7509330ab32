"""Byte-level BPE by a priority queue of merge ranks over a doubly linked symbol list."""

from __future__ import annotations

import heapq
import json
import re
from array import array
from collections.abc import Callable
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructField

from .common import add_columns

#: Single blanks between two non-blanks; a pre-token never reaches across them.
_CUT = re.compile(r"(?<=\S)(?=[ \n]\S)")
#: UTF-8 bytes that a text of single spaces and newlines may hold, and those that start other blanks.
_PLAIN = bytes([0x0A, *range(0x20, 0x7F), *range(0x80, 0x100)])
_BLANKS = (b"\xc2\x85", b"\xc2\xa0", b"\xe1\x9a\x80", b"\xe2\x80", b"\xe2\x81\x9f", b"\xe3\x80\x80")
#: A space, an ASCII word and signs that neither join the word nor stand for other characters.
_WORD_AND_SIGNS = re.compile(r" ([A-Za-z]+)([!\"#$%&()*+,\-./:;<=>?@\[\\\]^_`{|}~]+)")
_RUNS = ("  ", " \n", "\n ", "\n\n")


def chunks(text: str) -> tuple[str, list[str]]:
    """The first piece and the rest of a text cut before single blanks between non-blanks.

    Words, numbers and signs hold no blank but a leading space, and a run of blanks is never
    cut here, so every piece is encoded as it would be within the whole text. Of the rest,
    pieces that start with a space are given without it.
    """
    data = text.encode()
    if (
        data.translate(None, _PLAIN)
        or any(r in text for r in _RUNS)
        or text[0] in " \n"
        or text[-1] in " \n"
        or not text.isascii()
        and any(b in data for b in _BLANKS)
    ):
        first, *rest = _CUT.split(text)
        return first, [p[1:] if p[0] == " " else p for p in rest]
    first, *rest = text.replace("\n", " \n").split(" ")
    return first, rest


class Memo(dict):
    """Codes of pieces met before. When full, it starts anew and takes back what is asked for again."""

    def __init__(self, make: Callable[[str], bytes], most: int) -> None:
        super().__init__()
        self.make, self.most, self.old = make, most // 2, {}

    def __missing__(self, piece: str) -> bytes:
        code = self.old.get(piece)
        return self.put(piece, self.make(piece) if code is None else code)

    def put(self, piece: str, code: bytes) -> bytes:
        if len(self) >= self.most:
            self.old = dict(self)
            self.clear()
        self[piece] = code
        return code


class Codec:
    """Encodes and decodes with the vocabulary, merges and added tokens of a tokenizer file."""

    def __init__(self, path: str, memo: int = 400_000) -> None:
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        # the file's own splitter; it also writes bytes as the printable characters of the vocabulary
        self.split = Tokenizer.from_file(path).pre_tokenizer.pre_tokenize_str
        self.vocab: dict[str, int] = spec["model"]["vocab"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        cut = "|".join(re.escape(s) for s in sorted(self.special, key=len, reverse=True))
        self.cut = re.compile(f"({cut})") if cut else None
        size = max([*self.vocab.values(), *self.special.values()], default=-1) + 1
        self.size = size
        pairs = [p.split(" ") if isinstance(p, str) else p for p in spec["model"]["merges"]]
        self.pairs = [self.vocab[a] * size + self.vocab[b] for a, b in pairs]
        self.made = [self.vocab[a + b] for a, b in pairs]
        self.ranks = {p: r for r, p in reversed(list(enumerate(self.pairs)))}
        to_byte = _characters_to_bytes()
        self.byte_ids = [self.vocab[c] for c, _ in sorted(to_byte.items(), key=lambda x: x[1])]
        strings = [b""] * size
        for s, i in [*self.vocab.items(), *self.special.items()]:
            plain = [to_byte.get(c) for c in s]
            strings[i] = s.encode() if None in plain else bytes(plain)
        self.sizes = np.array([len(s) for s in strings], dtype=np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.blob = np.frombuffer(b"".join(strings), dtype=np.uint8)
        self.words: Memo = Memo(self._word, memo // 3)
        self.pieces: Memo = Memo(self._rest, memo)

    def merge(self, ids: list[int]) -> list[int]:
        """Applies merges by lowest rank, then leftmost, until no pair is left.

        `after` and `before` link the living symbols. The queue holds rank and position in one
        integer; an entry is stale if its symbol is dead or no longer starts that pair.
        """
        n, size, rank_of = len(ids), self.size, self.ranks.get
        if n < 2:
            return ids
        queue = []
        for i in range(n - 1):
            rank = rank_of(ids[i] * size + ids[i + 1])
            if rank is not None:
                queue.append(rank << 40 | i)
        if not queue:
            return ids
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        pairs, made, pop, push = self.pairs, self.made, heapq.heappop, heapq.heappush
        heapq.heapify(queue)
        while queue:
            entry = pop(queue)
            rank, i = entry >> 40, entry & 0xFFFFFFFFFF
            j = after[i]
            if j >= n or ids[i] * size + ids[j] != pairs[rank]:
                continue
            ids[i], ids[j] = made[rank], -1
            k = after[i] = after[j]
            if k < n:
                before[k] = i
                rank = rank_of(ids[i] * size + ids[k])
                if rank is not None:
                    push(queue, rank << 40 | i)
            h = before[i]
            if h >= 0:
                rank = rank_of(ids[h] * size + ids[i])
                if rank is not None:
                    push(queue, rank << 40 | h)
        return [x for x in ids if x >= 0]

    def _rest(self, piece: str) -> bytes:
        """A piece after the first, which has lost its leading space."""
        return self._piece(piece if piece[0] == "\n" else " " + piece)

    def _piece(self, piece: str) -> bytes:
        """A piece that is not in the memo; Latin letters need no look at the splitter."""
        if piece[1:].isalpha() and (piece[0] == " " or piece[0].isalpha()) and max(piece) < "\u0250":
            table = self.byte_ids
            return array("i", self.merge([table[b] for b in piece.encode()])).tobytes()
        word = _WORD_AND_SIGNS.fullmatch(piece)
        if word:
            # the word is a piece by itself, mostly met before
            return self.pieces[word[1]] + self.words[word[2]]
        parts = self.cut.split(piece) if self.cut else [piece]
        return b"".join(
            array("i", [self.special[p]]).tobytes() if i % 2 else b"".join([self.words[w] for w, _ in self.split(p)])
            for i, p in enumerate(parts)
            if p
        )

    def _word(self, word: str) -> bytes:
        return array("i", self.merge([self.vocab[c] for c in word])).tobytes()

    def encode(self, text: str) -> bytes:
        """Ids as native 32-bit integers."""
        if not text:
            return b""
        first, rest = chunks(text)
        return self._piece(first) + b"".join(map(self.pieces.__getitem__, rest))

    def decode(self, ids: np.ndarray) -> str:
        """The strings of `ids`, gathered from one table of bytes."""
        if not len(ids):
            return ""
        sizes = self.sizes[ids]
        ends = np.cumsum(sizes)
        at = np.arange(ends[-1]) + np.repeat(self.starts[ids] - ends + sizes, sizes)
        return self.blob[at].tobytes().decode("utf-8", "replace")


def _characters_to_bytes() -> dict[str, int]:
    """Printable Latin-1 characters stand for themselves; all other bytes follow from U+0100 on, in order."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


@lru_cache(2)
def _codec(path: str, memo: int) -> Codec:
    """One codec for all tasks of a worker."""
    return Codec(path, memo)


def encoder(path: str, text: str, memo: int) -> Callable[[pa.RecordBatch], list[pa.Array]]:
    """The function that encodes a batch, for use in a task."""
    codec = _codec(path, memo)

    def make(batch: pa.RecordBatch) -> list[pa.Array]:
        codes = [codec.encode(t or "") for t in batch.column(text).to_pylist()]
        ends = np.cumsum([0, *[len(c) // 4 for c in codes]], dtype=np.int64)
        values = pa.array(np.frombuffer(b"".join(codes), dtype=np.int32))
        return [pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), values)]

    return make


def encode_documents(df: DataFrame, path: str, text: str = "text", ids: str = "ids", memo: int = 400_000) -> DataFrame:
    """Adds `ids`: the BPE ids of the whole `text`, without added special tokens.

    NULL and empty texts give an empty list; repeated rows are encoded each for itself; a
    column named like `ids` is replaced. Strings of added tokens inside a text become their
    ids. The memo of pieces is bounded by `memo` entries and changes no result.
    """
    return add_columns(df, [StructField(ids, ArrayType(IntegerType(), True))], lambda: encoder(path, text, memo))


def decoder(path: str, ids: str, memo: int = 400_000) -> Callable[[pa.RecordBatch], list[pa.Array]]:
    """The function that decodes a batch, for use in a task."""
    codec = _codec(path, memo)

    def make(batch: pa.RecordBatch) -> list[pa.Array]:
        column = batch.column(ids)
        ends, values = column.offsets.to_numpy(), column.values.to_numpy(zero_copy_only=False)
        rows = zip(ends[:-1], ends[1:], column.is_null().to_pylist(), strict=True)
        return [pa.array(["" if null else codec.decode(values[a:b]) for a, b, null in rows], pa.string())]

    return make


def decode_ids(df: DataFrame, path: str, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """Adds `text`: the vocabulary strings of `ids`, joined, special tokens included.

    Bytes that are not UTF-8 become U+FFFD. NULL and empty lists give the empty text.
    """
    return add_columns(df, [StructField(text, StringType())], lambda: decoder(path, ids))


def encode_and_decode(
    df: DataFrame, path: str, text: str = "text", ids: str = "ids", decoded: str = "decoded", memo: int = 400_000
) -> DataFrame:
    """Both columns of `encode_documents` and `decode_ids`, made by one Python worker."""

    def start():
        encode, decode = encoder(path, text, memo), decoder(path, ids, memo)

        def make(batch: pa.RecordBatch) -> list[pa.Array]:
            (codes,) = encode(batch)
            return [codes, *decode(pa.RecordBatch.from_arrays([codes], names=[ids]))]

        return make

    return add_columns(df, [StructField(ids, ArrayType(IntegerType(), True)), StructField(decoded, StringType())], start)
