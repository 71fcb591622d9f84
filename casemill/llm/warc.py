"""Zstandard WARC archives: written by Spark's text sink, read frame by frame.

An archive starts with a skippable frame that holds a Zstandard dictionary; after it comes one
compressed frame per record. Between frames stands an empty skippable frame, which readers of the
format pass over: it is the line separator given to Spark's text sink, so archives are committed like
any other Spark output and survive lost executors on every file system that Spark writes to.

The reader loads the dictionary from the leading frame, decompresses one frame at a time, and checks
the version line, the header fields, the lengths and the payload digest of each record.
"""

from __future__ import annotations

import base64
import hashlib
import struct
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casemill.llm.common import stage

# Fixed values of the formats.
DICTIONARY_MAGIC, EMPTY_FRAME = 0x184D2A5D, b"\x50\x2a\x4d\x18\x00\x00\x00\x00"
SKIPPABLE_FIRST, FRAME_MAGIC = 0x184D2A50, 0xFD2FB528
VERSION = "WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
CRLF = b"\r\n"

#: Rows that the dictionary is trained on, as an expected number, how much of each, and its size.
TRAIN_PAGES, TRAIN_CHARS, DICTIONARY_BYTES = 200, 4000, 16 << 10


def base32(sha1_hex: str) -> str:
    return base64.b32encode(bytes.fromhex(sha1_hex)).decode()


def record(page_id, url: str, payload: bytes, kind: str, refers_to, size: int, digest: str) -> bytes:
    """One record. A revisit keeps the HTTP header with the payload's length, and no payload."""
    block = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % size
    if kind == "response":
        block += payload
    fields = [
        ("WARC-Type", kind),
        ("WARC-Record-ID", f"<urn:page:{'' if page_id is None else page_id}>"),
        ("WARC-Target-URI", " ".join((url or "").split())),
        ("WARC-Date", "1970-01-01T00:00:00Z"),
        ("WARC-Payload-Digest", f"sha1:{digest}"),
        ("Content-Type", "application/http; msgtype=response"),
        ("Content-Length", str(len(block))),
    ]
    if kind == "revisit":
        fields += [("WARC-Profile", REVISIT_PROFILE), ("WARC-Refers-To", f"<urn:page:{'' if refers_to is None else refers_to}>")]
    head = VERSION.encode() + CRLF + b"".join(f"{k}: {v}".encode() + CRLF for k, v in fields)
    return head + CRLF + block + CRLF + CRLF


def parse(data: bytes) -> dict:
    """Fields of one record and ``problem``: null, or what is wrong with it."""
    out = dict.fromkeys(("page_id", "url", "payload", "payload_bytes", "payload_digest", "record_type", "refers_to", "problem"))
    head, found, rest = data.partition(CRLF + CRLF)
    lines = head.split(CRLF)
    if not found or lines[0] != VERSION.encode():
        return out | {"problem": "version"}
    fields = {}
    for line in lines[1:]:
        name, colon, value = line.decode(errors="replace").partition(":")
        if not colon:
            return out | {"problem": f"field: {name}"}
        fields[name.strip().lower()] = value.strip()
    missing = [f for f in ("warc-type", "warc-record-id", "warc-payload-digest", "content-length") if f not in fields]
    if missing:
        return out | {"problem": f"missing: {missing[0]}"}
    if not fields["content-length"].isdigit() or len(rest) != int(fields["content-length"]) + 4 or not rest.endswith(CRLF + CRLF):
        return out | {"problem": "length"}
    http, found, payload = rest[:-4].partition(CRLF + CRLF)
    sizes = [v.strip() for k, _, v in (x.partition(b":") for x in http.split(CRLF)[1:]) if k.strip().lower() == b"content-length"]
    if not found or len(sizes) != 1 or not sizes[0].isdigit():
        return out | {"problem": "http header"}
    kind, digest = fields["warc-type"], fields["warc-payload-digest"].removeprefix("sha1:")
    number = fields["warc-record-id"].removeprefix("<urn:page:").removesuffix(">")
    refers = fields.get("warc-refers-to", "").removeprefix("<urn:page:").removesuffix(">")
    out |= {
        "page_id": int(number) if number else None, "url": fields.get("warc-target-uri"), "payload": payload,
        "payload_bytes": int(sizes[0]), "payload_digest": digest, "record_type": kind, "refers_to": int(refers) if refers else None,
    }
    if kind == "response" and (len(payload) != out["payload_bytes"] or base32(hashlib.sha1(payload).hexdigest()) != digest):
        return out | {"problem": "payload"}
    if kind == "revisit" and payload:
        return out | {"problem": "payload of a revisit"}
    return out


def frames(archive: bytes) -> Iterator[tuple[bytes, str | None]]:
    """The content of each compressed frame, or what is wrong with it; ends at the first broken frame."""
    decoder, at, view = zstandard.ZstdDecompressor(), 0, memoryview(archive)
    while at < len(archive):
        if len(archive) - at < 8:
            yield b"", "cut off"
            return
        magic, length = struct.unpack_from("<II", archive, at)
        if SKIPPABLE_FIRST <= magic < SKIPPABLE_FIRST + 16:
            if at == 0 and magic == DICTIONARY_MAGIC:
                content = bytes(view[8 : 8 + length])
                if content[:4] == struct.pack("<I", FRAME_MAGIC):
                    content = zstandard.ZstdDecompressor().decompressobj().decompress(content)
                decoder = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(content))
            at += 8 + length
            continue
        one = decoder.decompressobj()
        content, start = [], at
        try:
            while at < len(archive) and not one.eof:
                piece = view[at : at + (1 << 16)]
                content.append(one.decompress(piece))
                at += len(piece)
        except zstandard.ZstdError:
            yield b"", "frame"
            return
        if not one.eof:
            yield b"", "cut off"
            return
        at -= len(one.unused_data)
        if at <= start:
            yield b"", "frame"
            return
        yield b"".join(content), None


def _dictionary(pages: DataFrame) -> bytes:
    """Trained on the first characters of about ``TRAIN_PAGES`` pages; empty if they are too few."""
    total = pages.count()
    share = F.pmod(F.xxhash64("page_id"), F.lit(1 << 30)) / F.lit(float(1 << 30))
    # A bounded sample for a compression dictionary; pages themselves are archived whole.
    sample = pages.filter(share < F.lit(min(1.0, TRAIN_PAGES / max(total, 1)))).select(F.substring("html", 1, TRAIN_CHARS).alias("h"))
    texts = sorted(r["h"].encode() for r in sample.limit(2 * TRAIN_PAGES).collect() if r["h"])
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, texts).as_bytes() if len(texts) >= 16 else b""
    except zstandard.ZstdError:
        return b""


def _writer(dictionary: bytes):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        named = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
        packer = zstandard.ZstdCompressor(level=3, dict_data=named, write_checksum=True)
        first = True
        names = ("page_id", "url", "html", "kind", "refers_to", "size", "sha")
        for batch in batches:
            out = [struct.pack("<II", DICTIONARY_MAGIC, len(dictionary)) + dictionary] if first and dictionary else []
            first = False
            for page_id, url, html, kind, refers_to, size, sha in zip(*(batch.column(c).to_pylist() for c in names), strict=True):
                out.append(packer.compress(record(page_id, url, html.encode(), kind, refers_to, size, base32(sha))))
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["frame"])

    return write


def write_archives(pages: DataFrame, path: str) -> None:
    """Archive all rows of ``pages`` (page_id, url, html) under ``path``, one file per task.

    Of records with equal payloads (null counts as empty), those with the smallest page_id are
    responses and the others revisit it; rows that share id and payload are alike, and a null id is
    never the smallest unless there is no other. Payloads are compared by length and SHA-1: only
    digests are grouped, with partial sums, however many copies a page has. Only repeated digests
    are joined to the pages, by their size.
    """
    written = stage(pages.sparkSession)
    whole = F.coalesce(F.col("html").cast("string"), F.lit(""))
    rows = pages.select("page_id", "url", whole.alias("html"))
    rows = rows.select("*", F.octet_length("html").cast("long").alias("size"), F.sha1(F.col("html").cast("binary")).alias("sha"))
    groups = rows.groupBy("sha", "size").agg(F.count(F.lit(1)).alias("n"), F.min("page_id").alias("first"))
    copied = written.write(groups.filter("n > 1 and first is not null").select(F.col("sha").alias("_sha"), F.col("size").alias("_size"), "first"))
    again = F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))
    kinds = rows.join(copied, (F.col("sha") == F.col("_sha")) & (F.col("size") == F.col("_size")), "left").select(
        "page_id", "url", "html", "size", "sha",
        F.when(again, F.lit("revisit")).otherwise(F.lit("response")).alias("kind"),
        F.when(again, F.col("first")).alias("refers_to"),
    )
    packed = kinds.mapInArrow(_writer(_dictionary(pages)), "frame binary")
    packed.select(F.col("frame").cast("string").alias("value")).write.option("lineSep", EMPTY_FRAME.decode("latin-1")).mode("overwrite").text(path)


def _reader(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kinds = [("page_id", pa.int64()), ("url", pa.string()), ("payload", pa.binary()), ("payload_bytes", pa.int64()),
             ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()), ("problem", pa.string())]
    schema = pa.schema(kinds)
    for batch in batches:
        for archive in batch.column("content"):
            rows: list[dict] = []
            held = 0
            for content, problem in frames(archive.as_py() or b""):
                rows.append(dict.fromkeys(schema.names) | {"problem": problem} if problem else parse(content))
                held += len(content)
                if held > 8 << 20:
                    yield pa.RecordBatch.from_pylist(rows, schema)
                    rows, held = [], 0
            if rows:
                yield pa.RecordBatch.from_pylist(rows, schema)


def read_archives(spark, path: str) -> DataFrame:
    """One row per record: ``page_id, url, payload, payload_bytes, payload_digest, record_type, refers_to, problem``.

    A file is read by one task, so archives should have a bounded size, as ``write_archives`` gives
    them. A broken record is a row with ``problem`` set; after a broken frame the rest of its file is
    given up, and one row says so.
    """
    stage(spark)
    files = spark.read.format("binaryFile").load(path).select("content")
    return files.mapInArrow(
        _reader,
        "page_id long, url string, payload binary, payload_bytes long, payload_digest string, record_type string, refers_to long, problem string",
    )


def archived(pages: DataFrame) -> DataFrame:
    """Write ``pages`` to archives in the shared folder and read them back; fails on a broken record."""
    written = stage(pages.sparkSession)
    path = f"{written.root}/archives"
    write_archives(pages, path)
    rows = read_archives(pages.sparkSession, path)
    checked = F.when(F.col("problem").isNotNull(), F.raise_error(F.concat(F.lit("broken record: "), "problem")).cast("string"))
    return rows.withColumn("record_type", F.coalesce(checked, "record_type")).drop("problem")
