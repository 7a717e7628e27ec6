"""WARC archives compressed with Zstandard: writing with payload revisits, and reading back.

An archive is a skippable frame that holds a dictionary, then one frame per record, each compressed with that
dictionary. Every archive trains its own dictionary on the first records of its task, so nothing passes the driver.
"""

from __future__ import annotations

import base64
import hashlib
import re
import struct
import urllib.parse
import uuid
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rasterloom.llm import files
from rasterloom.llm.shared import BROADCAST_ROWS, DEALT, fresh_path, met, written

#: Fixed values of the formats: the skippable frame for a dictionary, the magic number of a raw dictionary, of a frame.
SKIPPABLE, RAW_DICTIONARY, FRAME = 0x184D2A5D, b"\x37\xa4\x30\xec", b"\x28\xb5\x2f\xfd"
VERSION = b"WARC/1.1"
HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
IDENTICAL = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
SPECIMENS, SPECIMEN_BYTES, DICTIONARY_BYTES = 400, 4_000_000, 32_768

MANIFEST = "path string, records long, bytes long"
RECORDS = "page_id long, url string, record_type string, refers_to long, payload_bytes long, payload_digest string, payload binary"


class BadRecord(ValueError):
    """A record or frame that breaks the format."""


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, revisit: bool, date: str) -> bytes:
    """One record; a revisit carries the head of the response and the digest and length of the whole payload."""
    block = HTTP if revisit else HTTP + payload
    name = lambda p: f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{p}')}>"
    head = {
        "WARC-Type": "revisit" if revisit else "response",
        "WARC-Record-ID": name(page_id),
        "WARC-Date": date,
        "WARC-Target-URI": urllib.parse.quote(url or "about:blank", safe="!#$%&'()*+,/:;=?@[]~-._"),
        "Content-Type": "application/http; msgtype=response",
        "WARC-Payload-Digest": f"sha1:{digest(payload)}",
        "WARC-Block-Digest": f"sha1:{digest(block)}",
        "X-Payload-Length": len(payload),
    }
    if page_id is not None:
        head["X-Page-ID"] = page_id
    if revisit:
        head |= {"WARC-Profile": IDENTICAL, "WARC-Refers-To": name(refers_to), "X-Refers-To-Page": refers_to}
    head["Content-Length"] = len(block)
    return VERSION + b"\r\n" + "".join(f"{k}: {v}\r\n" for k, v in head.items()).encode() + b"\r\n" + block + b"\r\n\r\n"


def parsed(data: bytes) -> dict:
    """The record in ``data``, which must be exactly one whole and valid record."""
    head, sep, rest = data.partition(b"\r\n\r\n")
    lines = head.split(b"\r\n")
    if not sep or lines[0] != VERSION:
        raise BadRecord("not a record of this version")
    fields = {}
    for line in lines[1:]:
        k, colon, v = line.partition(b":")
        if not colon or not re.fullmatch(rb"[!#-'*+\-.0-9A-Z^-z|~]+", k):
            raise BadRecord(f"header line {line[:80]!r}")
        fields[k.decode().lower()] = v.strip().decode()
    for k in ("warc-type", "warc-record-id", "warc-date", "content-length"):
        if k not in fields:
            raise BadRecord(f"no {k}")
    length = int(fields["content-length"])
    if len(rest) != length + 4 or rest[length:] != b"\r\n\r\n":
        raise BadRecord(f"length {len(rest) - 4}, declared {length}")
    block = rest[:length]
    if (d := fields.get("warc-block-digest")) and d != f"sha1:{digest(block)}":
        raise BadRecord("block digest")
    if not block.startswith(b"HTTP/"):
        raise BadRecord("no HTTP head")
    payload = block.partition(b"\r\n\r\n")[2]
    kind = fields["warc-type"]
    said = fields.get("warc-payload-digest", "")
    if kind == "response":
        if said != f"sha1:{digest(payload)}" or int(fields.get("x-payload-length", len(payload))) != len(payload):
            raise BadRecord("payload digest or length")
    elif kind != "revisit" or payload or "warc-refers-to" not in fields:
        raise BadRecord(f"record of type {kind}")
    number = lambda k: int(fields[k]) if k in fields else None
    return {
        "page_id": number("x-page-id"), "url": fields.get("warc-target-uri"), "record_type": kind,
        "refers_to": number("x-refers-to-page"), "payload_bytes": number("x-payload-length"),
        "payload_digest": said.removeprefix("sha1:"), "payload": payload if kind == "response" else None,
    }


class ArchiveWriter:
    """Writes records to one archive; ``close`` gives its row of the manifest."""

    def __init__(self, path: str, specimens: list[bytes], level: int):
        self.path, self.out, self.records, self.size = path, files.writable(path), 0, 0
        dictionary = b""
        if len(specimens) >= 8:
            try:
                dictionary = zstandard.train_dictionary(DICTIONARY_BYTES, specimens).as_bytes()
            except zstandard.ZstdError:  # too little or too uniform for a dictionary
                dictionary = b""
        if dictionary:
            self._put(struct.pack("<II", SKIPPABLE, len(dictionary)) + dictionary)
        given = {"dict_data": zstandard.ZstdCompressionDict(dictionary)} if dictionary else {}
        self.codec = zstandard.ZstdCompressor(level=level, write_checksum=True, write_content_size=True, **given)

    def _put(self, data: bytes) -> None:
        self.out.write(data)
        self.size += len(data)

    def add(self, data: bytes) -> None:
        self._put(self.codec.compress(data))
        self.records += 1

    def close(self) -> dict:
        self.out.close()
        return {"path": self.path, "records": self.records, "bytes": self.size}


def frames(path: str, step: int = 1 << 18) -> Iterator[bytes]:
    """The content of each frame, after the dictionary of the leading skippable frame is loaded."""
    with files.readable(path) as f:
        head = f.read(8)
        dictionary = b""
        if len(head) == 8 and struct.unpack("<I", head[:4])[0] == SKIPPABLE:
            dictionary, head = f.read(n := struct.unpack("<I", head[4:])[0]), b""
            if len(dictionary) != n:
                raise BadRecord("dictionary cut short")
            if dictionary[:4] == FRAME:
                dictionary = zstandard.ZstdDecompressor().decompress(dictionary)
            if dictionary[:4] != RAW_DICTIONARY:
                raise BadRecord("no dictionary in the leading skippable frame")
        codec = zstandard.ZstdDecompressor(**({"dict_data": zstandard.ZstdCompressionDict(dictionary)} if dictionary else {}))
        rest = head
        while rest or (rest := f.read(step)):
            part, got = codec.decompressobj(), []
            try:
                while True:
                    got.append(part.decompress(rest))
                    if part.eof:
                        rest = part.unused_data
                        break
                    if not (rest := f.read(step)):
                        raise BadRecord("frame cut short")
            except zstandard.ZstdError as e:
                raise BadRecord(f"frame: {e}") from e
            yield b"".join(got)


def write_archives(df: DataFrame, path: str, page_id: str = "page_id", url: str = "url", html: str = "html", min_bytes: int = 0, date: str = "2020-01-01T00:00:00Z", level: int = 6, archive_bytes: int = 256_000_000) -> DataFrame:
    """Writes one record per row under ``path`` and returns the manifest (path, records, bytes) of the archives.

    Of the rows whose payloads (html in UTF-8, null: empty) are equal and of at least ``min_bytes``, those with the
    smallest page_id are responses and all others revisits of it; a null page_id is never the smallest unless all of
    them are null, in which case all are responses. A null url becomes about:blank. A task that is run again writes
    under new names, and only what its last run wrote is in the manifest. Other columns are ignored.

    Ids are cast to long; an empty table writes nothing. What is shuffled to find equal payloads is a digest and an id a
    row; payloads stay where they were read, as the list of payloads that occur twice is broadcast. If that has over
    BROADCAST_ROWS rows, rows meet it in a shuffled join in which a payload of many pages is dealt over several tasks.
    """
    rows = df.select(F.col(page_id).cast("long").alias("page_id"), F.col(url).cast("string").alias("url"), F.coalesce(F.col(html), F.lit("")).alias("html"))
    key = F.unhex(F.sha2("html", 256))
    firsts = (
        rows.where(F.octet_length("html") >= min_bytes).select(key.alias("key"), "page_id")
        .groupBy("key").agg(F.min("page_id").alias("first"), F.count("*").alias("n")).where("n > 1")
    )
    firsts = written(firsts, "warc-firsts")
    if firsts.count() <= BROADCAST_ROWS:
        joined = rows.join(F.broadcast(firsts.withColumnRenamed("key", "_key")), key == F.col("_key"), "left")
    else:
        keyed = rows.withColumn("key", key)
        many = firsts.where(F.col("n") > DEALT).select("key", F.ceil(F.col("n") / DEALT).cast("int").alias("parts"))
        single = keyed.select("page_id", "url", "html", "key").join(firsts, "key", "left_anti").withColumns({"first": F.lit(None).cast("long"), "n": F.lit(1).cast("long")})
        joined = met(keyed, firsts, ["key"], ["page_id", "url"], F.broadcast(many) if many.count() <= BROADCAST_ROWS else many).unionByName(single)
    revisit = F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))
    joined = joined.select("page_id", "url", "html", revisit.alias("revisit"), F.col("first").alias("refers_to"))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        writer, waiting, weight = None, [], 0
        done = []

        def open_writer():
            return ArchiveWriter(f"{path}/{uuid.uuid4().hex}.warc.zst", [x for x in waiting if len(x) < 200_000], level)

        for batch in batches:
            for r in batch.to_pylist():
                data = record(r["page_id"], r["url"], r["html"].encode(), r["refers_to"], r["revisit"], date)
                if writer is None:
                    waiting.append(data)
                    weight += len(data)
                    if len(waiting) >= SPECIMENS or weight >= SPECIMEN_BYTES:
                        writer = open_writer()
                        for x in waiting:
                            writer.add(x)
                        waiting, weight = [], 0
                else:
                    writer.add(data)
                if writer is not None and writer.size >= archive_bytes:
                    done.append(writer.close())
                    writer = None
        if waiting:
            writer = open_writer()
            for x in waiting:
                writer.add(x)
        if writer is not None:
            done.append(writer.close())
        yield pa.RecordBatch.from_pylist(done, schema=pa.schema([("path", pa.string()), ("records", pa.int64()), ("bytes", pa.int64())]))

    return written(joined.mapInArrow(write, MANIFEST), "warc-manifest")


def read_archives(manifest: DataFrame, payloads: bool = True) -> DataFrame:
    """One row per record of the archives in ``manifest`` (column path): page_id, url, record_type, refers_to,
    payload_bytes, payload_digest and, unless ``payloads`` is false, payload (null for a revisit).

    Rows alike in everything are records of their own, and an archive of no records gives none. Headers, lengths and
    digests of each record are checked; a record that fails, or an archive that holds another
    number of them than the manifest says, ends the job with BadRecord. A task reads one archive as a stream.
    """
    schema = RECORDS if payloads else RECORDS.removesuffix(", payload binary")
    kinds = [("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("payload", pa.binary())]
    arrow = pa.schema(kinds if payloads else kinds[:-1])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for archive in batch.to_pylist():
                rows, weight, seen = [], 0, 0
                for data in frames(archive["path"]):
                    row = parsed(data)
                    if not payloads:
                        row.pop("payload")
                    rows.append(row)
                    weight, seen = weight + (len(data) if payloads else 300), seen + 1
                    if weight > 16_000_000:
                        yield pa.RecordBatch.from_pylist(rows, schema=arrow)
                        rows, weight = [], 0
                if seen != archive["records"]:
                    raise BadRecord(f"{archive['path']}: {seen} records, {archive['records']} in the manifest")
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema=arrow)

    archives = manifest.select("path", "records")
    return archives.repartition(max(1, archives.count()), "path").mapInArrow(read, schema)


def archive_folder(df: DataFrame) -> str:
    return fresh_path(df.sparkSession, "warc")
