"""Alignment of two tokenizers over the same text, and how often their tokens go together in a corpus.

Both tokenizers cut the same bytes. Where tokens of both end, a group ends; within a group, tokens
that overlap are linked. Texts align one to one over long stretches, in which the index of the
second tokenizer differs from that of the first by a constant shift: `align` probes such a
stretch in steps that double, and walks only the groups between stretches.

Links are counted per block of documents, summed over the corpus, and given back to the blocks.
"""

from __future__ import annotations

import hashlib
from array import array
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from .bpe import Memo, chunks, _characters_to_bytes
from .common import settle
from .token_codes import LibraryCodec

#: A block is closed when it holds this many different (document, pair) entries.
BLOCK = 4_000_000
#: Documents that are tokenized and aligned at once, and characters at which fewer do.
DOCUMENTS, CHARACTERS = 512, 2_000_000

RESULT = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"


def align(ends_a: list[int] | np.ndarray, ends_b: list[int] | np.ndarray) -> tuple[list[tuple[int, int, int]], np.ndarray, np.ndarray]:
    """Groups and links of two lists of rising end offsets with the same last one.

    Groups come as stretches (i, j, n): n groups that begin at tokens i, i + 1, ... of the first
    and j, j + 1, ... of the second list. Links are two arrays of token numbers.
    """
    ends_a, ends_b = np.asarray(ends_a, np.int64), np.asarray(ends_b, np.int64)
    stretches = _stretches(ends_a.tolist(), ends_b.tolist())
    return stretches, *_links(ends_a, ends_b, *begins(stretches))


def begins(stretches: list[tuple[int, int, int]]) -> tuple[np.ndarray, np.ndarray]:
    """The tokens that groups begin with, in either list."""
    i, j, n = np.fromiter(chain.from_iterable(stretches), np.int64, 3 * len(stretches)).reshape(-1, 3).T
    offset = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    return np.repeat(i, n) + offset, np.repeat(j, n) + offset


def _stretches(ends_a: list[int], ends_b: list[int]) -> list[tuple[int, int, int]]:
    stretches: list[tuple[int, int, int]] = []
    i, j, n = 0, 0, len(ends_a)
    while i < n:
        x, y = ends_a[i], ends_b[j]
        if x == y:
            # one to one at this shift: probe on in doubling steps, then in halving ones
            if i + 1 < n and ends_a[i + 1] != ends_b[j + 1]:
                stretches.append((i, j, 1))
                i += 1
                j += 1
                continue
            run, step = 1, 1
            while step and i + run < n:
                probe = ends_a[i + run : i + run + step]
                if probe == ends_b[j + run : j + run + step]:
                    run += len(probe)
                    step += step
                else:
                    step >>= 1
                    while step:
                        if ends_a[i + run : i + run + step] == ends_b[j + run : j + run + step]:
                            run += step
                        step >>= 1
            stretches.append((i, j, run))
            i += run
            j += run
        else:
            stretches.append((i, j, 1))
            while x != y:
                if x < y:
                    i += 1
                    x = ends_a[i]
                else:
                    j += 1
                    y = ends_b[j]
            # the shift is now j - i
            i += 1
            j += 1
    return stretches


def _links(ends_a: np.ndarray, ends_b: np.ndarray, groups_a: np.ndarray, groups_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Token numbers of all linked pairs, in the order of the text, from the tokens that groups begin with.

    Within a group, the token that ends first gives way to the next of its list, so a group has as many
    links as tokens of both lists less one.
    """
    if not len(groups_a):
        return groups_a, groups_b
    size_a, size_b = np.diff(groups_a, append=len(ends_a)), np.diff(groups_b, append=len(ends_b))
    first = np.cumsum(size_a + size_b - 1) - (size_a + size_b - 1)
    total = len(ends_a) + len(ends_b) - len(groups_a)
    step_a, step_b = np.zeros(total, np.int64), np.zeros(total, np.int64)
    # where a group begins, both lists go on to its first tokens
    step_a[first], step_b[first] = np.diff(groups_a, prepend=0), np.diff(groups_b, prepend=0)
    wide = np.flatnonzero(size_a + size_b > 2)
    # ends inside groups, of both lists together, by group and offset
    inner_a, inner_b = _inside(groups_a[wide], size_a[wide]), _inside(groups_b[wide], size_b[wide])
    ends = np.concatenate([ends_a[inner_a], ends_b[inner_b]])
    order = np.argsort(ends, kind="stable")
    of_a = order < len(inner_a)
    inner = _inside(first[wide], size_a[wide] + size_b[wide] - 1) + 1
    # behind an inner end of A its next token follows, else B's; the first link of the next group counts from there
    step_a[inner], step_b[inner] = of_a, ~of_a
    step_a[first[1:]] -= size_a[:-1] - 1
    step_b[first[1:]] -= size_b[:-1] - 1
    return np.cumsum(step_a), np.cumsum(step_b)


def _inside(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """All numbers from each start on, one fewer than its size."""
    sizes = sizes - 1
    return np.arange(sizes.sum()) + np.repeat(starts - np.cumsum(sizes) + sizes, sizes)


class Tokenizers:
    """Both tokenizers, asked once for every distinct piece of text (see bpe.chunks)."""

    def __init__(self, path_a: str, path_b: str, memo: int) -> None:
        import sentencepiece

        self.a = LibraryCodec(path_a, 0)
        # strings of special tokens are plain text
        self.a.tokenizer.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        to_byte = _characters_to_bytes()
        self.strings_a = [b""] * len(self.a.sizes)
        for token, i in self.a.tokenizer.get_vocab(with_added_tokens=False).items():
            plain = [to_byte.get(c) for c in token]
            self.strings_a[i] = token.encode() if None in plain else bytes(plain)
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.strings_b = [
            bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)
        ]
        self.sizes_a = np.array([len(s) for s in self.strings_a], np.int64)
        self.sizes_b = np.array([len(s) for s in self.strings_b], np.int64)
        self.size_a, self.size_b = len(self.sizes_a), len(self.sizes_b)
        # a text may be cut before blanks if no token of B goes on behind its leading blanks
        inner = [p for i, p in enumerate(pieces) if not (self.b.is_byte(i) or self.b.is_control(i) or self.b.is_unknown(i))]
        self.blank = self.b.piece_to_id("▁")
        self.cuts = pieces[self.blank] == "▁" and not any("\n" in p or "▁" in p.lstrip("▁") for p in inner)
        self.memo: Memo = Memo(lambda p: self._ask([p])[0], memo)
        # decimal ids and what follows them: within a group, at its middle, at its end
        ids_a, ids_b = [str(i) for i in range(self.size_a)], [str(i) for i in range(self.size_b)]
        self.marks = [f"{i}," for i in ids_a] + [f"{i}|" for i in ids_a] + [f"{i}," for i in ids_b] + [f"{i};" for i in ids_b]

    def _checked(self, want: list[bytes], a: list[bytes], b: list[list[int]]) -> list[tuple[bytes, bytes] | None]:
        """Ids of both for each text; None where the bytes of either differ from the text's."""
        packed = [array("I", x).tobytes() for x in b]
        same = [True] * len(want)
        for codes, strings, sizes in ((a, self.strings_a, self.sizes_a), (packed, self.strings_b, self.sizes_b)):
            ids = np.frombuffer(b"".join(codes), np.uint32)
            ends = np.append(0, np.cumsum(sizes[ids]))[np.cumsum([0, *[len(c) // 4 for c in codes]])]
            data = b"".join([strings[i] for i in ids.tolist()])
            if data != b"".join(want) or ends.tolist() != np.cumsum([0, *map(len, want)]).tolist():
                same = [s and data[p:q] == w for s, p, q, w in zip(same, ends[:-1].tolist(), ends[1:].tolist(), want, strict=True)]
        return [pair if s else None for s, pair in zip(same, zip(a, packed, strict=True), strict=True)]

    def _ask(self, pieces: list[str]) -> list[tuple[bytes, bytes] | None]:
        """Codes of pieces behind the first of a text; they have lost their leading space."""
        ids = self.b.encode(pieces, num_threads=1)
        # before a newline, the model's own leading space is a token by itself
        ids = [x[1:] if p[0] == "\n" and x[:1] == [self.blank] else x for p, x in zip(pieces, ids, strict=True)]
        want = [p.encode() if p[0] == "\n" else b" " + p.encode() for p in pieces]
        return self._checked(want, self.a._ask(pieces), ids)

    def _whole(self, texts: list[str]) -> list[tuple[bytes, bytes] | None]:
        """Codes of texts, or of first pieces, each asked for alone."""
        a = self.a.tokenizer.encode_batch_fast([" " + t for t in texts], add_special_tokens=False)
        codes = [array("I", x.ids).tobytes() for x in a]
        checked = self._checked([b" " + t.encode() for t in texts], codes, self.b.encode(texts, num_threads=1))
        return [c if t else None for t, c in zip(texts, checked, strict=True)]

    def encode_all(self, texts: list[str]) -> list[tuple[bytes, bytes] | None]:
        """Ids of both tokenizers as native 32-bit integers; None where the text is empty or its bytes are not kept."""
        if not self.cuts:
            return self._whole(texts)
        cut = [chunks(t) if t else ("", []) for t in texts]
        memo = self.memo
        rows = [list(map(memo.get, rest)) for _, rest in cut]
        new = dict.fromkeys(p for (_, rest), row in zip(cut, rows, strict=True) if None in row for p, c in zip(rest, row, strict=True) if c is None)
        found = {p: memo.old.get(p) for p in new}
        asked = [p for p, c in found.items() if c is None]
        if asked:
            found.update(zip(asked, self._ask(asked), strict=True))
        firsts = self._whole([first for first, _ in cut])
        out = []
        for t, first, (_, rest), row in zip(texts, firsts, cut, rows, strict=True):
            if None in row:
                row = [found[p] if c is None else c for p, c in zip(rest, row, strict=True)]
            if first is None or None in row:
                # some piece is not kept as it is: the text as a whole decides
                out.append(self._whole([t])[0] if t else None)
                continue
            out.append((first[0] + b"".join([a for a, _ in row]), first[1] + b"".join([b for _, b in row])))
        for p, c in found.items():
            if c is not None:
                memo.put(p, c)
        return out


@lru_cache(1)
def _tokenizers(path_a: str, path_b: str, memo: int) -> Tokenizers:
    """One pair of tokenizers for all tasks of a worker."""
    return Tokenizers(path_a, path_b, memo)


def _documents(t: Tokenizers, texts: list[str]) -> dict:
    """Counts and digest of every text, and its different pairs with the times they are linked."""
    codes = [c or (b"", b"") for c in t.encode_all(texts)]
    a = np.frombuffer(b"".join([x for x, _ in codes]), np.uint32)
    b = np.frombuffer(b"".join([x for _, x in codes]), np.uint32)
    starts_a = np.cumsum([0, *[len(x) // 4 for x, _ in codes]])
    starts_b = np.cumsum([0, *[len(x) // 4 for _, x in codes]])
    # all texts in one line: each ends where tokens of both end
    stretches, links_a, links_b = align(np.cumsum(t.sizes_a[a]), np.cumsum(t.sizes_b[b]))
    groups_a, groups_b = begins(stretches)
    # tokens in the order of the digest: A's of a group, then B's
    ends_a, ends_b = np.append(groups_a, len(a))[1:], np.append(groups_b, len(b))[1:]
    order = np.empty(len(a) + len(b), np.int64)
    order[np.arange(len(a)) + np.repeat(groups_b, ends_a - groups_a)] = a
    order[np.arange(len(b)) + np.repeat(ends_a, ends_b - groups_b)] = b.astype(np.int64) + 2 * t.size_a
    order[ends_a + groups_b - 1] += t.size_a
    order[ends_a + ends_b - 1] += t.size_b
    marks, words = t.marks, order.tolist()
    ends = (starts_a + starts_b).tolist()
    digests = [
        hashlib.sha256("".join([marks[x] for x in words[p:q]])[:-1].encode()).hexdigest() if q > p else ""
        for p, q in zip(ends[:-1], ends[1:], strict=True)
    ]
    span = t.size_a * t.size_b
    pairs = a[links_a].astype(np.int64) * t.size_b + b[links_b]
    doc = np.searchsorted(starts_a, links_a, side="right") - 1
    keys, times = np.unique(doc * span + pairs, return_counts=True)
    return {
        "n_a": np.diff(starts_a),
        "n_b": np.diff(starts_b),
        "n_groups": np.diff(np.searchsorted(groups_a, starts_a)),
        "n_links": np.diff(np.searchsorted(links_a, starts_a)),
        "digests": digests,
        "sizes": np.diff(np.searchsorted(keys, np.arange(len(texts) + 1) * span)),
        "pairs": keys % span,
        "times": times,
    }


def _pack(values: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(values.astype(np.int32).tobytes())


def _unpack(data: bytes) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.int32).astype(np.int64)


_BLOCKS = (
    "block long, doc_id array<long>, n_a array<long>, n_b array<long>, n_groups array<long>, n_links array<long>, "
    "digests array<string>, sizes array<int>, steps binary, times binary, pairs array<long>, n_docs array<int>"
)


def _blocks(df: DataFrame, path_a: str, path_b: str, memo: int) -> DataFrame:
    """One row for each block of documents: what is known of each, and the different pairs of the
    block with the number of its documents that hold them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = _tokenizers(path_a, path_b, memo)
        part, n, ids, parts, held = TaskContext.get().partitionId(), 0, [], [], 0

        def close() -> pa.RecordBatch:
            nonlocal n
            n += 1
            joined = {k: np.concatenate([p[k] for p in parts]) for k in parts[0] if k != "digests"}
            pairs, at, n_docs = np.unique(joined["pairs"], return_inverse=True, return_counts=True)
            row = {k: [joined[k]] for k in ("n_a", "n_b", "n_groups", "n_links", "sizes")}
            row |= {"block": [part << 32 | n], "doc_id": [ids], "digests": [[d for p in parts for d in p["digests"]]]}
            row |= {"steps": [_pack(np.diff(at, prepend=0))], "times": [_pack(joined["times"])], "pairs": [pairs], "n_docs": [n_docs.astype(np.int32)]}
            return pa.RecordBatch.from_pydict({k: pa.array(row[k], kind) for k, kind in kinds.items()})

        for b in batches:
            at = 0
            while at < b.num_rows:
                some = b.slice(at, DOCUMENTS)
                texts = [x or "" for x in some.column("t").to_pylist()]
                last = int(np.searchsorted(np.cumsum([len(x) for x in texts]), CHARACTERS)) + 1
                texts = texts[:last]
                done = _documents(t, texts)
                ids += some.column("d").to_pylist()[:last]
                parts.append(done)
                held += len(done["pairs"])
                at += len(texts)
                if held >= BLOCK:
                    yield close()
                    ids, parts, held = [], [], 0
        if ids:
            yield close()

    kinds = {
        "block": pa.int64(), "doc_id": pa.list_(pa.int64()), **{k: pa.list_(pa.int64()) for k in ("n_a", "n_b", "n_groups", "n_links")},
        "digests": pa.list_(pa.string()), "sizes": pa.list_(pa.int32()), "steps": pa.binary(), "times": pa.binary(),
        "pairs": pa.list_(pa.int64()), "n_docs": pa.list_(pa.int32()),
    }
    return settle(df.mapInArrow(run, _BLOCKS), "blocks", "zstd")


def align_documents(
    df: DataFrame, path_a: str, path_b: str, doc_id: str = "doc_id", text: str = "text", memo: int = 700_000
) -> tuple[DataFrame, DataFrame]:
    """Aligns tokenizer A (a byte-level tokenizer file) with B (a piece model) over every whole text.

    The first table has a row per row of `df`: doc_id, n_a, n_b, n_groups, n_links, n_best,
    count_sum, groups_sha256. The second has every linked pair of ids with the number of
    documents that hold it: a, b, n_docs, best (no pair of this A id is in more documents).
    NULL and empty texts, and texts that one of the tokenizers does not keep byte by byte, have
    no tokens: zeros and ''. Repeated rows and ids count each for itself, NULL ids stay NULL;
    other columns are not read. An empty table gives empty tables.
    """
    rows = df.select(F.col(doc_id).cast("long").alias("d"), F.col(text).alias("t"))
    blocks = _blocks(rows, path_a, path_b, memo)
    counts = _counts(blocks, _sizes(path_b))
    # a block asks for each of its pairs once, so no pair has more rows than there are blocks
    asked = blocks.select("block", F.posexplode("pairs").alias("at", "pair"))
    answers = asked.join(counts.select("pair", "n_docs", "best"), "pair").select("block", F.struct("at", "n_docs", "best").alias("x"))
    answers = answers.groupBy("block").agg(F.collect_list("x").alias("x"))
    # blocks without any pair are not among the answers
    known = blocks.select("block", "doc_id", "n_a", "n_b", "n_groups", "n_links", "digests", "sizes", "steps", "times")
    out = known.join(answers, "block", "left").mapInArrow(_finish, RESULT)
    size_b = _sizes(path_b)
    table = counts.select(F.expr(f"pair div {size_b}").cast("int").alias("a"), (F.col("pair") % size_b).cast("int").alias("b"), "n_docs", "best")
    return out, table


def _sizes(path_b: str) -> int:
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=path_b).get_piece_size()


def _counts(blocks: DataFrame, size_b: int) -> DataFrame:
    """Documents of every pair, and whether no other pair of its A id has more."""
    held = blocks.select(F.explode(F.arrays_zip("pairs", "n_docs")).alias("x")).select("x.*")
    counts = held.groupBy(F.col("pairs").alias("pair")).agg(F.sum("n_docs").alias("n_docs"))
    counts = settle(counts.withColumn("a", F.expr(f"pair div {size_b}")), "counts")
    most = counts.groupBy("a").agg(F.max("n_docs").alias("most"))
    # one row per id of A's vocabulary
    joined = counts.join(F.broadcast(most), "a")
    return joined.select("pair", "n_docs", (F.col("n_docs") == F.col("most")).alias("best"))


def _finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of documents from a block and the counts of its pairs."""
    for batch in batches:
        for r in range(batch.num_rows):
            row = {name: batch.column(name).slice(r, 1) for name in batch.schema.names}
            x = row["x"].values if row["x"].null_count == 0 else None
            sizes = row["sizes"].flatten().to_numpy()
            if x is None:
                best = total = np.zeros(len(sizes), np.int64)
            else:
                x = row["x"].flatten()
                counts, is_best = np.zeros(len(x), np.int64), np.zeros(len(x), np.int64)
                at = x.field("at").to_numpy()
                counts[at], is_best[at] = x.field("n_docs").to_numpy(), x.field("best").to_numpy(zero_copy_only=False)
                pairs, times = np.cumsum(_unpack(row["steps"][0].as_py())), _unpack(row["times"][0].as_py())
                ends = np.cumsum(sizes)
                sums = lambda v: np.diff(np.append(0, np.cumsum(v))[np.append(0, ends)])
                best, total = sums(times * is_best[pairs]), sums(times * counts[pairs])
            columns = [row[k].flatten() for k in ("doc_id", "n_a", "n_b", "n_groups", "n_links")]
            columns += [pa.array(best), pa.array(total), row["digests"].flatten()]
            names = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
            whole = pa.RecordBatch.from_arrays(columns, names=names)
            for at in range(0, whole.num_rows, 4096):
                yield whole.slice(at, 4096)
