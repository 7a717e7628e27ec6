"""Media columns: payloads kept as 8-bit mono WAV members of ZIP archives, behind a data source of Spark.

``df.write.format("media_archive")`` stores (doc_id, n_bytes, payload) and ``spark.read.format("media_archive")``
streams them back. The reader plans byte ranges over each archive's directory: the driver knows only paths and sizes, a
task reads the directory at the end of its archive and takes the members whose offset lies in its range. Members are
read one by one at their offset, checked against length and CRC, and retried alone; so is the directory.
"""

from __future__ import annotations

import hashlib
import io
import json
import struct
import time
import uuid
import wave
import zipfile
import zlib
from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage

from rasterloom.llm import files

SCHEMA = "doc_id long, n_bytes long, media binary"
ARROW = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("media", pa.binary())])
BLOCK = 64
BATCH_BYTES = 16_000_000
MANIFEST = "_archives.json"


def padded(data: bytes) -> bytes:
    """``data`` with bytes 0 up to a positive multiple of 64."""
    n = max(1, -(-len(data) // BLOCK)) * BLOCK
    return data + bytes(n - len(data))


def to_wav(payload: bytes, rate: int = 8000) -> bytes:
    out = io.BytesIO()
    with wave.open(out, "wb") as w:
        w.setnchannels(1)
        w.setsampwidth(1)
        w.setframerate(rate)
        w.writeframes(payload)
    return out.getvalue()


def from_wav(media: bytes) -> bytes:
    with wave.open(io.BytesIO(media), "rb") as w:
        if (w.getnchannels(), w.getsampwidth()) != (1, 1):
            raise ValueError("not 8-bit mono")
        return w.readframes(w.getnframes())


def feature(payload: bytes) -> str:
    """Loudness, zero crossings and brightness of the samples as text; a function of the bytes alone."""
    x = np.frombuffer(payload, np.uint8).astype(np.float64) - 128
    rms = np.sqrt(np.mean(x * x))
    crossings = np.mean(np.signbit(x[1:]) != np.signbit(x[:-1]))
    frames = x.reshape(-1, BLOCK)
    power = np.zeros(BLOCK // 2 + 1)
    for i in range(0, len(frames), 4096):
        power += np.square(np.abs(np.fft.rfft(frames[i : i + 4096], axis=1))).sum(0)
    centroid = float(np.dot(power, np.arange(len(power))) / max(power.sum(), 1e-9))
    return f"rms={rms:.4f};crossings={crossings:.4f};centroid={centroid:.4f}"


class Damaged(OSError):
    """A member whose bytes aren't what the directory says."""


def retried(what, tries: int = 4, wait: float = 0.2):
    """The result of ``what``, which opens what it reads; called anew if that fails."""
    for left in reversed(range(tries)):
        try:
            return what()
        except (OSError, EOFError, zlib.error, struct.error, zipfile.BadZipFile):
            if not left:
                raise
            time.sleep(wait)
    raise AssertionError


def member(path: str, offset: int, packed: int, size: int, crc: int, method: int, tries: int = 4, wait: float = 0.2) -> bytes:
    """One member by its offset, read anew from a fresh handle if that fails."""

    def once() -> bytes:
        with files.readable(path) as f:
            return member_of(f, offset, packed, size, crc, method)

    return retried(once, tries, wait)


@lru_cache(4)
def directory(path: str) -> list[tuple[int, tuple[int, int, int, int], bytes]]:
    """(offset, (packed, size, crc, method), comment) of an archive's members by offset; a worker that is given several
    ranges of an archive reads its directory once."""

    def once() -> list:
        with files.readable(path) as f, zipfile.ZipFile(f) as pack:
            return sorted((i.header_offset, (i.compress_size, i.file_size, i.CRC, i.compress_type), i.comment) for i in pack.infolist())

    return retried(once)


def member_of(f, offset: int, packed: int, size: int, crc: int, method: int) -> bytes:
    f.seek(offset)
    head = f.read(30)
    if head[:4] != b"PK\x03\x04":
        raise Damaged(f"no member at {offset}")
    f.seek(sum(struct.unpack("<HH", head[26:30])), 1)
    data = f.read(packed)
    if method == zipfile.ZIP_DEFLATED:
        data = zlib.decompressobj(-15).decompress(data)
    if len(data) != size or zlib.crc32(data) != crc:
        raise Damaged(f"member at {offset}: {len(data)} of {size} bytes")
    return data


@dataclass
class Archives(WriterCommitMessage):
    made: list


@dataclass
class Range(InputPartition):
    path: str
    lo: int
    hi: int

    def __post_init__(self):
        super().__init__(self.path)


class MediaSource(DataSource):
    """Options: path (folder of a store that pyarrow opens), range_bytes, archive_bytes, level."""

    @classmethod
    def name(cls) -> str:
        return "media_archive"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return MediaReader(self.options["path"], int(self.options.get("range_bytes", 16_000_000)))

    def writer(self, schema, overwrite: bool) -> DataSourceArrowWriter:
        return MediaWriter(self.options["path"], int(self.options.get("archive_bytes", 256_000_000)), int(self.options.get("level", 3)))


class MediaWriter(DataSourceArrowWriter):
    """Each task writes archives under names of its own; ``commit`` lists those of the tasks that count."""

    def __init__(self, path: str, archive_bytes: int, level: int):
        self.path, self.archive_bytes, self.level = path.rstrip("/"), archive_bytes, level

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Archives:
        made, out, pack, n = [], None, None, 0

        def close():
            pack.close()
            made.append([name, out.tell()])
            out.close()

        for batch in iterator:
            for r in batch.to_pylist():
                if pack is None:
                    name = f"{uuid.uuid4().hex}.zip"
                    out = files.writable(f"{self.path}/{name}")
                    pack = zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED, compresslevel=self.level)
                info = zipfile.ZipInfo(f"{n}.wav")
                info.compress_type = zipfile.ZIP_DEFLATED
                info.comment = json.dumps([r["doc_id"], r["n_bytes"]]).encode()
                pack.writestr(info, r["media"], compresslevel=self.level)
                n += 1
                if out.tell() > self.archive_bytes:
                    close()
                    pack = None
        if pack is not None:
            close()
        return Archives(made)

    def commit(self, messages) -> None:
        listed = [x for m in messages if m is not None for x in m.made]
        with files.writable(f"{self.path}/{MANIFEST}") as f:
            f.write(json.dumps(listed).encode())

    def abort(self, messages) -> None:
        for m in messages:
            for name, _ in m.made if m is not None else ():
                files.delete(f"{self.path}/{name}")


class MediaReader(DataSourceReader):
    def __init__(self, path: str, range_bytes: int):
        self.path, self.range_bytes = path.rstrip("/"), range_bytes

    def partitions(self) -> list[Range]:
        with files.readable(f"{self.path}/{MANIFEST}") as f:
            listed = json.loads(f.read())
        ranges = [Range(f"{self.path}/{name}", lo, min(lo + self.range_bytes, size)) for name, size in listed for lo in range(0, size, self.range_bytes)]
        return ranges or [Range("", 0, 0)]

    def read(self, partition: Range) -> Iterator[pa.RecordBatch]:
        if not partition.path:
            return
        listed = directory(partition.path)
        own = listed[bisect_left(listed, (partition.lo,)) : bisect_left(listed, (partition.hi,))]
        rows, weight, f = [], 0, None
        try:
            for offset, known, comment in own:
                try:
                    f = f or files.readable(partition.path)
                    media = member_of(f, offset, *known)
                except (OSError, zlib.error, struct.error):  # this member alone, from fresh handles; the next opens anew
                    if f is not None:
                        f.close()
                        f = None
                    media = member(partition.path, offset, *known)
                doc_id, n_bytes = json.loads(comment)
                rows.append({"doc_id": doc_id, "n_bytes": n_bytes, "media": media})
                weight += len(media)
                if weight > BATCH_BYTES:
                    yield pa.RecordBatch.from_pylist(rows, schema=ARROW)
                    rows, weight = [], 0
        finally:
            if f is not None:
                f.close()
        if rows:
            yield pa.RecordBatch.from_pylist(rows, schema=ARROW)


def store_media(df: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text") -> None:
    """Writes the padded UTF-8 bytes of every whole text (null: empty) as a WAV member under ``path``.

    One member per row, repeated rows included; a null doc_id is kept as null; other columns are ignored. An empty
    table writes a manifest of no archives.
    """
    df.sparkSession.dataSource.register(MediaSource)

    @F.arrow_udf("binary")
    def wav(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for part in texts:
            yield pa.array([to_wav(padded((t or "").encode())) for t in part.to_pylist()], pa.binary())

    rows = df.select(F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(F.octet_length(F.col(text)), F.lit(0)).cast("long").alias("n_bytes"), wav(F.col(text)).alias("media"))
    rows.write.format("media_archive").option("path", path).mode("append").save()


def read_media(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, n_bytes and media of every member under ``path``."""
    spark.dataSource.register(MediaSource)
    return spark.read.format("media_archive").option("path", path).load()


FEATURES = "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string"
_ARROW_FEATURES = pa.schema([(n, pa.string() if t == "string" else pa.int64()) for n, t in (x.split() for x in FEATURES.split(", "))])


def media_features(media: DataFrame) -> DataFrame:
    """Digests and features of the stored payloads, computed from the bytes that were read back.

    One row per member, a null doc_id and repeated rows included; equal payloads get equal values; no member, no row. A
    payload whose length does not fit n_bytes ends the job with Damaged.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for r in batch.to_pylist():
                payload = from_wav(r["media"])
                if len(payload) != max(1, -(-r["n_bytes"] // BLOCK)) * BLOCK:
                    raise Damaged(f"payload of {len(payload)} bytes for {r['n_bytes']}")
                rows.append({
                    "doc_id": r["doc_id"], "n_bytes": r["n_bytes"], "payload_bytes": len(payload), "payload_sha256": hashlib.sha256(payload).hexdigest(),
                    "tail_crc32": zlib.crc32(payload[-BLOCK:]), "media_bytes": len(r["media"]), "media_sha256": hashlib.sha256(r["media"]).hexdigest(), "feature": feature(payload),
                })
            yield pa.RecordBatch.from_pylist(rows, schema=_ARROW_FEATURES)

    return media.select("doc_id", "n_bytes", "media").mapInArrow(run, FEATURES)
