"""Token ids in files of directly addressable codes: any token is read without decoding a block.

A file holds documents in order. Ids are cut into chunks of `bits` bits, lowest first. Level 0
has the first chunk of every token, level k the k-th chunk of the tokens that go on so far. A
level's bitmap has one bit per chunk, set if the token goes on, and a directory with the count
of set bits before every 512th: the place of a token's chunk in the next level is the rank of
its bit. Layout, little-endian:

    magic "DAC1" | bits u32 | levels u32 | documents u64 | tokens u64 | has_id u8[documents]
    | doc_id i64[documents] | start u64[documents + 1]
    then per level: count u64 | chunk u8 or u16[count] | bitmap u8[...] | directory u64[...]
"""

from __future__ import annotations

import os
import uuid
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from .bpe import Memo, chunks
from .common import Store, new_folder, settle, shared_uri

MAGIC, EVERY = b"DAC1", 512


def pack(ids: np.ndarray, bits: int) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Chunks, continuation bitmap and rank directory of each level."""
    kind = np.uint8 if bits <= 8 else np.uint16
    rest, levels = ids.astype(np.uint32), []
    while True:
        chunk, rest = (rest & ((1 << bits) - 1)).astype(kind), rest >> bits
        on = rest > 0
        bitmap = np.packbits(on, bitorder="little")
        steps = np.add.reduceat(on, np.arange(0, len(on), EVERY), dtype=np.uint64) if len(on) else np.zeros(0, np.uint64)
        levels.append((chunk, bitmap, np.concatenate([np.zeros(1, np.uint64), np.cumsum(steps, dtype=np.uint64)])))
        rest = rest[on]
        if not len(rest):
            return levels


def to_bytes(doc_ids: list[int | None], starts: np.ndarray, ids: np.ndarray, bits: int = 8) -> bytes:
    levels = pack(ids, bits)
    has = np.array([d is not None for d in doc_ids], dtype=np.uint8)
    parts = [
        MAGIC,
        np.array([bits, len(levels)], "<u4").tobytes(),
        np.array([len(doc_ids), len(ids)], "<u8").tobytes(),
        has.tobytes(),
        np.array([d or 0 for d in doc_ids], "<i8").tobytes(),
        starts.astype("<u8").tobytes(),
    ]
    for chunk, bitmap, directory in levels:
        parts += [np.array([len(chunk)], "<u8").tobytes(), chunk.tobytes(), bitmap.tobytes(), directory.astype("<u8").tobytes()]
    return b"".join(parts)


class TokenFile:
    """A file's bytes; `tokens(a, b)` reads any range, `token(i)` any single id, without decoding the rest."""

    def __init__(self, data: bytes) -> None:
        if data[:4] != MAGIC:
            raise ValueError("not a file of directly addressable codes")
        self.at, self.data = 4, data
        self.bits, levels = (int(x) for x in self._take("<u4", 2))
        documents, self.size = (int(x) for x in self._take("<u8", 2))
        has = self._take("u1", documents)
        self.doc_ids = [int(d) if h else None for d, h in zip(self._take("<i8", documents), has, strict=True)]
        self.starts = self._take("<u8", documents + 1).astype(np.int64)
        self.levels = []
        for _ in range(levels):
            n = int(self._take("<u8", 1)[0])
            chunk = self._take("u1" if self.bits <= 8 else "<u2", n)
            self.levels.append((chunk, self._take("u1", (n + 7) // 8), self._take("<u8", (n + EVERY - 1) // EVERY + 1).astype(np.int64)))
        if self.at != len(data):
            raise ValueError(f"{len(data) - self.at} bytes more than the header tells")

    def _take(self, kind: str, n: int) -> np.ndarray:
        out = np.frombuffer(self.data, kind, n, self.at)
        self.at += out.nbytes
        return out

    def _rank(self, level: int, i: int) -> int:
        """Set bits before bit i: the directory's count and those since its last entry."""
        _, bitmap, directory = self.levels[level]
        block = i // EVERY
        since = np.unpackbits(bitmap[block * EVERY // 8 : (i + 7) // 8], bitorder="little")[: i - block * EVERY]
        return int(directory[block]) + int(since.sum())

    def token(self, i: int) -> int:
        return int(self.tokens(i, i + 1)[0])

    def tokens(self, a: int, b: int) -> np.ndarray:
        """Ids a to b (end exclusive); reads only their chunks and bits."""
        out = np.zeros(b - a, dtype=np.uint32)
        going, shift = np.arange(b - a), 0
        for level, (chunk, bitmap, _) in enumerate(self.levels):
            if not len(going):
                break
            out[going] |= chunk[a:b].astype(np.uint32) << np.uint32(shift)
            bits = np.unpackbits(bitmap[a // 8 : (b + 7) // 8], bitorder="little")[a % 8 : a % 8 + b - a]
            going = going[bits > 0]
            if len(going):
                a = self._rank(level, a)
                b, shift = a + len(going), shift + self.bits
        return out


class LibraryCodec:
    """The tokenizers library, asked once for every distinct piece of text (see bpe.chunks)."""

    def __init__(self, path: str, memo: int) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        # bytes of text that each id stands for; characters of the vocabulary stand for a byte each
        sizes = np.zeros(self.tokenizer.get_vocab_size(with_added_tokens=True), np.int64)
        for token, i in self.tokenizer.get_vocab(with_added_tokens=False).items():
            sizes[i] = len(token)
        for i, added in self.tokenizer.get_added_tokens_decoder().items():
            sizes[i] = len(added.content.encode())
        self.sizes = sizes
        self.pieces = Memo(lambda p: self._ask([p])[0], memo)

    def _ask(self, pieces: list[str]) -> list[bytes]:
        """Codes of pieces after the first of a text.

        They are asked for in lines of many pieces, which are encoded as if each were alone;
        a piece's ids are those that stand for its bytes.
        """
        order = sorted(range(len(pieces)), key=lambda i: pieces[i][-1:].isspace())
        whole = [pieces[i] if pieces[i][0] == "\n" else " " + pieces[i] for i in order]
        # the end of a text may end in blanks, which would reach into the next piece
        alone = sum(p[-1].isspace() for p in whole)
        joined = len(whole) - alone
        lines = [whole[i : min(i + 512, joined)] for i in range(0, joined, 512)] + [[p] for p in whole[joined:]]
        out = []
        for line, e in zip(lines, self.tokenizer.encode_batch_fast(["".join(x) for x in lines], add_special_tokens=False), strict=True):
            ids = np.array(e.ids, dtype=np.uint32)
            after = np.cumsum(self.sizes[ids])
            ends = np.searchsorted(after, np.cumsum([len(p.encode()) for p in line])) + 1
            data, at = ids.tobytes(), 0
            for end in (ends * 4).tolist():
                out.append(data[at:end])
                at = end
        return [code for _, code in sorted(zip(order, out, strict=True))] if alone else out

    def encode_all(self, texts: list[str]) -> list[np.ndarray]:
        cut = [chunks(t) if t else ("", []) for t in texts]
        known = self.pieces
        rows = [list(map(known.get, rest)) for _, rest in cut]
        gaps = [[i for i, code in enumerate(row) if code is None] for row in rows]
        new = dict.fromkeys(rest[i] for (_, rest), gap in zip(cut, gaps, strict=True) for i in gap)
        new = {p: known.old.get(p) for p in new}
        asked = [p for p, code in new.items() if code is None]
        new.update(zip(asked, self._ask(asked), strict=True))
        for (_, rest), row, gap in zip(cut, rows, gaps, strict=True):
            for i in gap:
                row[i] = new[rest[i]]
        for p, code in new.items():
            known.put(p, code)
        firsts = self.tokenizer.encode_batch_fast([first for first, _ in cut], add_special_tokens=False)
        return [
            np.concatenate([np.array(f.ids, dtype=np.uint32), np.frombuffer(b"".join(row), np.uint32)])
            for f, row in zip(firsts, rows, strict=True)
        ]


@lru_cache(1)
def _library(path: str, memo: int) -> LibraryCodec:
    return LibraryCodec(path, memo)


def write_tokens(
    df: DataFrame, path: str, folder: str, end_id: int, doc_id: str = "doc_id", text: str = "text", bits: int = 8, memo: int = 1_200_000
) -> DataFrame:
    """Encodes every whole text, appends `end_id`, and writes files in ascending `doc_id` order.

    NULL and empty texts are the end id alone; NULL ids come first; rows of one id are ordered
    by a hash of their text, and repeated rows are all written. Other columns are not read.
    A table without rows writes no file. Returns the manifest, one row per file:
    (part, name, n_docs, n_tokens, bytes). A file is written under a name of its own and only
    then counted in the manifest, so lost or repeated tasks leave nothing that is read.
    """
    rows = df.select(F.col(doc_id).cast("long").alias("d"), F.coalesce(F.col(text), F.lit("")).alias("t"))
    rows = rows.withColumn("h", F.xxhash64("t"))
    # ranges over id and hash: rows of one id need not meet in one task
    dealt = rows.repartitionByRange("d", "h").sortWithinPartitions("d", "h").select("d", "t")
    store = Store(shared_uri(df.sparkSession, folder))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _library(path, memo)
        part, n = TaskContext.get().partitionId(), 0

        def save(doc_ids: list, codes: list[np.ndarray]) -> pa.RecordBatch:
            nonlocal n
            ids = np.concatenate(codes)
            starts = np.cumsum([0, *map(len, codes)])
            data = to_bytes(doc_ids, starts, ids, bits)
            name = f"{part:06d}-{n:06d}-{uuid.uuid4().hex}.dac"
            store.write(name, data)
            n += 1
            return pa.RecordBatch.from_pylist([{"part": part * 1_000_000 + n, "name": name, "n_docs": len(doc_ids), "n_tokens": len(ids), "bytes": len(data)}])

        doc_ids, codes, size = [], [], 0
        for b in batches:
            for at in range(0, b.num_rows, 512):
                some = b.slice(at, 512)
                new = [np.append(c, np.uint32(end_id)) for c in codec.encode_all(some.column("t").to_pylist())]
                doc_ids += some.column("d").to_pylist()
                codes += new
                size += sum(map(len, new))
                if size >= FILE_TOKENS:
                    yield save(doc_ids, codes)
                    doc_ids, codes, size = [], [], 0
        if doc_ids:
            yield save(doc_ids, codes)

    return settle(dealt.mapInArrow(run, "part long, name string, n_docs long, n_tokens long, bytes long"), "manifest")


#: A file is closed when it has this many tokens; no reader holds more than one file.
FILE_TOKENS = 4_000_000


def read_tokens(manifest: DataFrame, folder: str, ids: bool = True) -> DataFrame:
    """Documents of the files a manifest names: (doc_id, start, n_tokens, ids_crc32, ids), in file order.

    `start` counts the ids of all documents before. `ids_crc32` is of the ids as little-endian
    32-bit integers. Sizes are checked against the manifest. Without `ids` the column is left out.
    """
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    # one row per file
    files = manifest.withColumn("base", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)))
    spread = max(1, int(manifest.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    store = Store(shared_uri(manifest.sparkSession, folder))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for row in b.to_pylist():
                data = store.read(row["name"])
                file = TokenFile(data)
                if (len(data), len(file.doc_ids), file.size) != (row["bytes"], row["n_docs"], row["n_tokens"]):
                    raise ValueError(f"{row['name']} is not the file that was written")
                for at in range(0, len(file.doc_ids), 512):
                    doc_ids = file.doc_ids[at : at + 512]
                    ends = file.starts[at : at + len(doc_ids) + 1]
                    values = [file.tokens(int(x), int(y)) for x, y in zip(ends[:-1], ends[1:], strict=True)]
                    columns = [
                        pa.array(doc_ids, pa.int64()),
                        pa.array(ends[:-1] + row["base"]),
                        pa.array(np.diff(ends)),
                        pa.array([zlib.crc32(v.astype("<u4").tobytes()) for v in values], pa.int64()),
                    ]
                    if ids:
                        flat = pa.array(np.concatenate(values).astype(np.int32))
                        columns.append(pa.ListArray.from_arrays(pa.array((ends - ends[0]).astype(np.int32)), flat))
                    yield pa.RecordBatch.from_arrays(columns, names=names)

    names = ["doc_id", "start", "n_tokens", "ids_crc32", *(["ids"] if ids else [])]
    kinds = ["long", "long", "long", "long", "array<int>"]
    return files.repartition(spread).mapInArrow(run, ", ".join(f"{n} {k}" for n, k in zip(names, kinds)))


def new_token_folder(spark) -> str:
    return new_folder(spark, "tokens")
