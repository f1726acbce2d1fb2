"""Media columns: texts as grayscale images in ZIP archives, read back through a Spark data source.

The archives are plain ZIP files (stored members), written by the tasks into the shared folder; a manifest,
committed by Spark, names the archives of the attempts that counted. The data source plans byte ranges over
the archives; a task reads the directory of its archive, takes the members whose headers start in its range,
and streams their payloads in Arrow batches. A member that fails is read again by itself, from its offset.
"""

from __future__ import annotations

import hashlib
import struct
import time
import uuid
import zipfile
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from cantor.llm.common import open_uri, portions

#: Bytes of a row of the image, and so the unit that payloads are padded to.
ROW = 576
PAD = b"\xff"
PNG = b"\x89PNG\r\n\x1a\n"
MEMBERS = "archive string, member string, offset long, doc_id long, media binary, error string"
FEATURES = "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string"
MANIFEST = "archive string, size long, members long"


def to_payload(text: str) -> bytes:
    data = text.encode("utf-8", "surrogatepass")
    return data.ljust(max(ROW, -(-len(data) // ROW) * ROW), PAD)


def _chunk(kind: bytes, data: bytes) -> bytes:
    return struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))


def encode_png(payload: bytes, n_bytes: int) -> bytes:
    """An 8-bit grayscale PNG of ROW columns; a text chunk keeps the unpadded length."""
    rows = np.frombuffer(payload, np.uint8).reshape(-1, ROW)
    raw = np.concatenate([np.zeros((len(rows), 1), np.uint8), rows], axis=1).tobytes()
    return PNG + _chunk(b"IHDR", struct.pack(">IIBBBBB", ROW, len(rows), 8, 0, 0, 0, 0)) + _chunk(b"tEXt", b"n_bytes\x00%d" % n_bytes) + _chunk(b"IDAT", zlib.compress(raw, 6)) + _chunk(b"IEND", b"")


def decode_png(data: bytes) -> tuple[bytes, int]:
    """The samples and the unpadded length; raises ValueError where a checksum or the form is wrong."""
    if data[:8] != PNG:
        raise ValueError("not a PNG")
    at, n_bytes, idat, height = 8, 0, [], 0
    while at < len(data):
        (size,) = struct.unpack_from(">I", data, at)
        kind, body = data[at + 4 : at + 8], data[at + 8 : at + 8 + size]
        if zlib.crc32(kind + body) != struct.unpack_from(">I", data, at + 8 + size)[0]:
            raise ValueError("PNG chunk checksum")
        if kind == b"IHDR":
            _, height = struct.unpack_from(">II", body)
        elif kind == b"tEXt":
            n_bytes = int(body.partition(b"\x00")[2])
        elif kind == b"IDAT":
            idat.append(body)
        at += 12 + size
    rows = np.frombuffer(zlib.decompress(b"".join(idat)), np.uint8).reshape(height, ROW + 1)
    return rows[:, 1:].tobytes(), n_bytes


def write_archives(docs: DataFrame, root: str, archive_bytes: int = 256 << 20) -> str:
    """Stores each row of ``docs`` (doc_id, text; a null text is empty) as an image; returns the manifest's path.

    Archives are named by attempt, so a task that runs again never writes into another's file, and archives
    of lost attempts are in no manifest.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        archive, handle, uri, n, done = None, None, "", 0, []

        def close() -> None:
            nonlocal archive
            archive.close()
            size = handle.tell()
            handle.close()
            done.append((uri, size, n))
            archive = None

        for batch in portions(batches):
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if archive is None:
                    uri = f"{root}/archives/{uuid.uuid4().hex}.zip"
                    fs, path = open_uri(uri)
                    fs.create_dir(path.rpartition("/")[0], recursive=True)
                    handle, n = fs.open_output_stream(path), 0
                    archive = zipfile.ZipFile(_Tell(handle), "w", zipfile.ZIP_STORED)
                payload = to_payload(text or "")
                image = encode_png(payload, len((text or "").encode("utf-8", "surrogatepass")))
                archive.writestr(zipfile.ZipInfo(f"{n}-{'null' if doc_id is None else doc_id}.png"), image)
                n += 1
                if handle.tell() >= archive_bytes:
                    close()
        if archive is not None:
            close()
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*done, strict=True)], names=["archive", "size", "members"])

    docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, MANIFEST).write.mode("overwrite").parquet(f"{root}/manifest")
    return f"{root}/manifest"


class _Tell:
    """A stream that can't seek, for zipfile's writer."""

    def __init__(self, out):
        self._out = out

    def write(self, data) -> int:
        self._out.write(data)
        return len(data)

    def flush(self) -> None:
        self._out.flush()


class Range(InputPartition):
    def __init__(self, archive: str, lo: int, hi: int):
        super().__init__((archive, lo, hi))
        self.archive, self.lo, self.hi = archive, lo, hi


class MediaArchiveReader(DataSourceReader):
    """Options: path (the manifest), range_bytes, batch_bytes, retries."""

    def __init__(self, options: dict[str, str]):
        self.manifest = options["path"]
        self.range_bytes = int(options.get("range_bytes", 32 << 20))
        self.batch_bytes = int(options.get("batch_bytes", 4 << 20))
        self.retries = int(options.get("retries", 3))

    def partitions(self) -> list[InputPartition]:
        fs, path = open_uri(self.manifest)
        table = pq.read_table(path, filesystem=fs, columns=["archive", "size"])
        out = [Range(a, lo, min(size, lo + self.range_bytes)) for a, size in zip(table.column(0).to_pylist(), table.column(1).to_pylist(), strict=True) for lo in range(0, size, self.range_bytes)]
        return out or [Range("", 0, 0)]

    @staticmethod
    def _sliced(block: bytes, base: int, info: zipfile.ZipInfo) -> bytes | None:
        """The member's payload from a block that begins at ``base``, if it is there unharmed."""
        at = info.header_offset - base
        if len(block) < at + 30:
            return None
        name, extra = struct.unpack_from("<HH", block, at + 26)
        data = block[at + 30 + name + extra : at + 30 + name + extra + info.compress_size]
        return data if len(data) == info.compress_size and zlib.crc32(data) == info.CRC else None

    def _member(self, fs, path: str, info: zipfile.ZipInfo, source) -> bytes:
        """The member's payload, from its own offset: skips the local header and checks the checksum."""
        last: Exception | None = None
        for attempt in range(self.retries + 1):
            try:
                if attempt:
                    time.sleep(0.1 * 2**attempt)
                    source = fs.open_input_file(path)
                source.seek(info.header_offset)
                name, extra = struct.unpack_from("<HH", source.read(30), 26)
                source.seek(info.header_offset + 30 + name + extra)
                data = source.read(info.compress_size)
                if len(data) != info.compress_size or zlib.crc32(data) != info.CRC:
                    raise ValueError("member checksum")
                return data
            except (OSError, ValueError, struct.error) as error:
                last = error
        raise ValueError(f"{info.filename} at {info.header_offset}: {last}")

    def read(self, partition: Range) -> Iterator[pa.RecordBatch]:
        if not partition.archive:
            return
        names = [x.split()[0] for x in MEMBERS.split(", ")]
        kinds = (pa.string(), pa.string(), pa.int64(), pa.int64(), pa.binary(), pa.string())
        fs, path = open_uri(partition.archive)
        with fs.open_input_file(path) as source:
            archive = zipfile.ZipFile(source)
            members = sorted(archive.infolist(), key=lambda i: i.header_offset)
            inside = [i for i in members if partition.lo <= i.header_offset < partition.hi]
            rows: list[tuple] = []
            held = base = 0
            block = b""
            if inside:
                # one read for the whole range; what doesn't hold in it is read again by its offset
                base = inside[0].header_offset
                source.seek(base)
                block = source.read(min([i.header_offset for i in members if i.header_offset > inside[-1].header_offset], default=archive.start_dir) - base)
            for info in inside:
                ident = info.filename.partition("-")[2].removesuffix(".png")
                try:
                    data, error = self._sliced(block, base, info) or self._member(fs, path, info, source), None
                except ValueError as problem:
                    data, error = None, str(problem)
                rows.append((partition.archive, info.filename, info.header_offset, None if ident == "null" else int(ident), data, error))
                held += len(data or b"")
                if held >= self.batch_bytes:
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)
                    rows, held = [], 0
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)


class MediaArchiveSource(DataSource):
    """``spark.read.format("media_archive").load(manifest)``: a row per member, its bytes as a column.

    A member that stays unreadable after its retries is a row with a null media and its error.
    """

    @classmethod
    def name(cls) -> str:
        return "media_archive"

    def schema(self) -> str:
        return MEMBERS

    def reader(self, schema) -> DataSourceReader:
        return MediaArchiveReader(dict(self.options))


def read_archives(spark: SparkSession, manifest: str, **options: object) -> DataFrame:
    spark.dataSource.register(MediaArchiveSource)
    reader = spark.read.format("media_archive")
    for key, value in options.items():
        reader = reader.option(key, str(value))
    return reader.load(manifest)


def media_features(media: DataFrame) -> DataFrame:
    """Digests and features (size, mean, spread, entropy of the samples) of stored images: columns of FEATURES.

    An unreadable member fails the query: results stay whole.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string())
        for batch in portions(batches):
            rows = []
            for doc_id, data, error in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if error:
                    raise ValueError(error)
                payload, n_bytes = decode_png(data)
                counts = np.bincount(np.frombuffer(payload, np.uint8), minlength=256)
                share = counts[counts > 0] / len(payload)
                mean = float(counts @ np.arange(256)) / len(payload)
                spread = (float(counts @ np.square(np.arange(256, dtype=np.int64))) / len(payload) - mean**2) ** 0.5
                feature = f"{ROW}x{len(payload) // ROW};mean={mean:.4f};sd={spread:.4f};entropy={-float(share @ np.log2(share)) + 0.0:.4f}"
                rows.append((doc_id, n_bytes, len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-32:]), len(data), hashlib.sha256(data).hexdigest(), feature))
            columns = list(zip(*rows, strict=True)) or [()] * 8
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=[x.split()[0] for x in FEATURES.split(", ")])

    return media.select("doc_id", "media", "error").mapInArrow(run, FEATURES)
