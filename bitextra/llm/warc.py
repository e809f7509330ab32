"""WARC archives in Zstandard: one frame per record behind a dictionary in a skippable frame."""

from __future__ import annotations

import base64
import hashlib
import re
import struct
import uuid
from collections.abc import Iterator
from datetime import UTC, datetime

import pyarrow as pa
import zstandard as zstd
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from ..operators.lookup import attach
from .common import Store, new_folder, settle, shared_uri

#: Magic number of the skippable frame that holds the dictionary, and of a Zstandard frame.
SKIP, FRAME = 0x184D2A5D, 0xFD2FB528
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: A file is closed at this many bytes of payload; the dictionary learns from so many bytes at its start.
_DATE = re.compile(r"\d{4}-\d\d-\d\dT\d\d:\d\d:\d\d(\.\d{1,9})?Z")
FILE_BYTES, SAMPLE_BYTES, DICTIONARY_BYTES = 32 << 20, 2 << 20, 32 << 10


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_id(page_id: int | None, sha1: str, revisit: bool) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page_id} {sha1} {revisit}')}>"


def now() -> str:
    return datetime.now(UTC).strftime("%Y-%m-%dT%H:%M:%SZ")


def record(
    page_id: int | None, url: str | None, payload: bytes, sha1: str, refers_to: int | None, revisit: bool, date: str | None = None
) -> bytes:
    """A response with its payload, or a revisit that keeps the HTTP header with the full length.

    `date` is that of the capture (WARC-Date); without it, now.
    """
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    head = {
        "WARC-Type": "revisit" if revisit else "response",
        "WARC-Record-ID": record_id(page_id, sha1, revisit),
        "WARC-Date": date or now(),
        "WARC-Target-URI": (url or "").replace("\r", "%0D").replace("\n", "%0A"),
        "X-Page-ID": "" if page_id is None else str(page_id),
        "WARC-Payload-Digest": f"sha1:{sha1}",
        "WARC-Block-Digest": f"sha1:{digest(block)}",
        "Content-Type": "application/http; msgtype=response",
        "Content-Length": str(len(block)),
    }
    if revisit:
        head |= {"WARC-Profile": PROFILE, "WARC-Refers-To": record_id(refers_to, sha1, False), "X-Refers-To-Page-ID": "" if refers_to is None else str(refers_to)}
    lines = "".join(f"{k}: {v}\r\n" for k, v in head.items())
    return b"WARC/1.1\r\n" + lines.encode() + b"\r\n" + block + b"\r\n\r\n"


def learn(samples: list[bytes]) -> zstd.ZstdCompressionDict | None:
    """A dictionary of the first records of a file; None if they are too few or too small."""
    try:
        return zstd.train_dictionary(DICTIONARY_BYTES, samples, k=512, d=8)
    except zstd.ZstdError:
        return None


def archive(records: list[bytes]) -> bytes:
    samples, size = [], 0
    for r in records:
        if size >= SAMPLE_BYTES:
            break
        samples.append(r[:16384])
        size += len(samples[-1])
    words = learn(samples)
    parts = []
    if words is not None:
        packed = zstd.ZstdCompressor(level=9).compress(words.as_bytes())
        parts.append(struct.pack("<II", SKIP, len(packed)) + packed)
    pack = zstd.ZstdCompressor(level=3, dict_data=words, write_checksum=True, write_content_size=True)
    return b"".join([*parts, *[pack.compress(r) for r in records]])


class BadArchive(ValueError):
    pass


def frames(data: bytes) -> Iterator[bytes]:
    """The content of every frame, decoded one by one with the dictionary of the leading frame."""
    words, at = None, 0
    if len(data) >= 8 and struct.unpack_from("<I", data)[0] == SKIP:
        (size,) = struct.unpack_from("<I", data, 4)
        if 8 + size > len(data):
            raise BadArchive("the dictionary frame is cut off")
        raw, at = data[8 : 8 + size], 8 + size
        if raw[:4] == struct.pack("<I", FRAME):  # the dictionary may be compressed itself
            raw = zstd.ZstdDecompressor().decompress(raw, max_output_size=64 << 20)
        words = zstd.ZstdCompressionDict(raw)
    view = memoryview(data)
    unpack = zstd.ZstdDecompressor(dict_data=words)
    while at < len(data):
        if len(data) - at < 4 or struct.unpack_from("<I", data, at)[0] != FRAME:
            raise BadArchive(f"no frame at byte {at}")
        one = unpack.decompressobj()
        # feeds a window that grows: a frame tells its end, and the rest of a window is not the frame's
        out, fed = [], at
        while not one.eof:
            if fed >= len(data):
                raise BadArchive("the last frame is cut off")
            window = view[fed : fed + (1 << 16)]
            out.append(one.decompress(window))
            fed += len(window)
        at = fed - len(one.unused_data)
        yield b"".join(out)


def parse(raw: bytes) -> tuple[dict[str, str], bytes]:
    """Headers by lower-case name and the block, with version, lengths and digests checked."""
    head, gap, rest = raw.partition(b"\r\n\r\n")
    version, *lines = head.decode("utf-8").split("\r\n")
    if not gap or version not in ("WARC/1.0", "WARC/1.1"):
        raise BadArchive(f"not a WARC record: {version[:40]!r}")
    headers = {}
    for line in lines:
        name, colon, value = line.partition(":")
        if not colon or not name or name != name.strip():
            raise BadArchive(f"bad header line {line[:80]!r}")
        headers[name.lower()] = value.strip()
    for name in ("warc-type", "warc-record-id", "warc-date", "content-length"):
        if name not in headers:
            raise BadArchive(f"header {name} is missing")
    if not _DATE.fullmatch(headers["warc-date"]):
        raise BadArchive(f"WARC-Date {headers['warc-date'][:40]!r} is none")
    if not headers["content-length"].isascii() or not headers["content-length"].isdigit():
        raise BadArchive("Content-Length is not a number")
    n = int(headers["content-length"])
    block = rest[:n]
    if len(block) != n or rest[n:] != b"\r\n\r\n":
        raise BadArchive(f"Content-Length {n}, but the record has {len(rest) - 4} bytes")
    if "warc-block-digest" in headers and headers["warc-block-digest"] != f"sha1:{digest(block)}":
        raise BadArchive("the block digest is wrong")
    return headers, block


def read_record(raw: bytes) -> dict:
    """A record's row; the payload of a revisit is not in the archive, its length and digest are."""
    headers, block = parse(raw)
    http, gap, payload = block.partition(b"\r\n\r\n")
    if not gap:
        raise BadArchive("the HTTP header does not end")
    sizes = [x.partition(b":")[2].strip() for x in http.split(b"\r\n") if x.lower().startswith(b"content-length:")]
    if len(sizes) != 1 or not sizes[0].isdigit():
        raise BadArchive("HTTP Content-Length is missing")
    kind, sha1 = headers["warc-type"], headers.get("warc-payload-digest", "").removeprefix("sha1:")
    if kind == "response" and (len(payload) != int(sizes[0]) or digest(payload) != sha1):
        raise BadArchive("the payload does not fit its length or digest")
    if kind == "revisit" and "warc-refers-to" not in headers:
        raise BadArchive("a revisit refers to no record")
    if kind == "revisit" and payload:
        raise BadArchive("a revisit has a payload")
    number = lambda name: int(headers[name]) if headers.get(name) else None
    return {
        "page_id": number("x-page-id"),
        "url": headers.get("warc-target-uri", ""),
        "record_type": kind,
        "payload_bytes": int(sizes[0]),
        "payload_digest": sha1,
        "refers_to": number("x-refers-to-page-id"),
        "payload": payload if kind == "response" else None,
    }


def plan_records(pages: DataFrame, page_id: str, url: str, html: str, least: int) -> DataFrame:
    """Rows to write: (page_id, url, payload, sha1, revisit, refers_to).

    Of rows with equal payloads of `least` bytes or more the one with the smallest page_id is
    the response (NULL ids last, then the smallest url); of rows equal in all of that one is.
    Rows are numbered in a written copy, so the choice does not hang on how it is computed.
    """
    payload = F.coalesce(F.col(html).cast("string"), F.lit("")).cast("binary")
    rows = pages.select(F.col(page_id).cast("long").alias("page_id"), F.col(url).cast("string").alias("url"), payload.alias("payload"))
    rows = settle(
        rows.withColumn("sha1", F.sha1("payload")).withColumn("row", F.expr("uuid()")), "pages", codec="zstd"
    )
    order = F.struct(F.col("page_id").isNull(), "page_id", F.col("url").isNull(), "url", "row")
    narrow = rows.where(F.length("payload") >= least).select("sha1", "page_id", "url", "row")
    firsts = narrow.groupBy("sha1").agg(F.min(order).alias("first"), F.count(F.lit(1)).alias("n"))
    firsts = firsts.where("n > 1").select("sha1", "n", F.col("first.page_id").alias("to"), F.col("first.row").alias("first"))
    # a payload of very many pages is answered by a broadcast whose size is bounded
    marked = attach(narrow, firsts, "sha1", "n", F.col("row"))
    revisits = marked.where("first <> row").select("row", F.col("to").alias("refers_to"), F.lit(True).alias("revisit"))
    return rows.join(revisits, "row", "left").drop("row")


def write_archives(
    pages: DataFrame, folder: str, page_id: str = "page_id", url: str = "url", html: str = "html", least: int = 0
) -> DataFrame:
    """Writes one record per row into .warc.zst files; returns (name, n_records, bytes).

    NULL html is an empty payload, NULL ids and urls are empty headers; repeated rows get a
    record each; other columns are not read. A table without rows writes no file. A file has a
    name of its own and counts only once its task has ended, so lost tasks leave nothing read.
    """
    rows, date = plan_records(pages, page_id, url, html, least), now()
    store = Store(shared_uri(pages.sparkSession, folder))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()

        def save(records: list[bytes]) -> pa.RecordBatch:
            data, name = archive(records), f"{part:06d}-{uuid.uuid4().hex}.warc.zst"
            store.write(name, data)
            return pa.RecordBatch.from_pylist([{"name": name, "n_records": len(records), "bytes": len(data)}])

        records, size = [], 0
        for b in batches:
            for r in b.to_pylist():
                sha1 = base64.b32encode(bytes.fromhex(r["sha1"])).decode()
                records.append(record(r["page_id"], r["url"], r["payload"], sha1, r["refers_to"], bool(r["revisit"]), date))
                size += len(records[-1])
                if size >= FILE_BYTES:
                    yield save(records)
                    records, size = [], 0
        if records:
            yield save(records)

    return settle(rows.mapInArrow(run, "name string, n_records long, bytes long"), "manifest")


def read_archives(manifest: DataFrame, folder: str, payload: bool = True) -> DataFrame:
    """Every record of the named files, checked; raises BadArchive on a wrong header, length or digest."""
    names = ["page_id", "url", "record_type", "payload_bytes", "payload_digest", "refers_to", *(["payload"] if payload else [])]
    kinds = ["long", "string", "string", "long", "string", "long", "binary"]
    types = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.binary()]
    schema = pa.schema(list(zip(names, types)))
    spread = max(1, int(manifest.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    store = Store(shared_uri(manifest.sparkSession, folder))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for file in b.to_pylist():
                data = store.read(file["name"])
                if len(data) != file["bytes"]:
                    raise BadArchive(f"{file['name']} has {len(data)} bytes, not {file['bytes']}")
                rows, n = [], 0
                for raw in frames(data):
                    rows.append(read_record(raw))
                    n += 1
                    if len(rows) == 256:
                        yield pa.RecordBatch.from_pylist(rows, schema=schema)
                        rows = []
                if n != file["n_records"]:
                    raise BadArchive(f"{file['name']} has {n} records, not {file['n_records']}")
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema=schema)

    return manifest.repartition(spread).mapInArrow(run, ", ".join(f"{n} {k}" for n, k in zip(names, kinds)))


def new_archive_folder(spark) -> str:
    return new_folder(spark, "warc")
