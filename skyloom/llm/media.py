"""Media columns from archives (operator 6): a Spark data source over directories of ZIP archives.

``write_archives`` stores payloads losslessly as 8-bit greyscale PNG members of ZIP archives in the shared
folder. ``ArchiveSource`` (format ``archive_members``) reads them: the planner lists a directory and cuts each
archive into byte ranges, so what the driver holds grows with archives, not members; a task takes the members
whose headers lie in its range from the archive's own directory and streams them as Arrow batches of bounded
size. A member that can't be read or fails its checksum is tried again by itself, at its offset, with a fresh
handle; after the last try the read fails, or (``onError=null``) the row has no payload and names the error.

Archives are written under a temporary name and moved, and their names follow from the partition and the order
in it, so a task that runs again replaces its own files with equal ones.

Edge cases: a null or empty text is one frame of padding; a null id stays null; repeated rows are members
each; an empty table gives no rows; other columns are ignored; a text that fills the padding exactly gets none.
"""

from __future__ import annotations

import hashlib
import io
import struct
import time
import uuid
import zipfile
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from skyloom.session import materialise, new_folder

#: Bytes of a frame and width of the image; padding byte, which no UTF-8 text holds.
FRAME, PAD = 576, b"\xff"
ARCHIVE_BYTES = 32_000_000
MEMBERS = (
    "archive string, offset long, name string, size long, payload binary, tries int, error string"
)
_NAMES = [x.split()[0] for x in MEMBERS.split(", ")]
_KINDS = [pa.string(), pa.int64(), pa.string(), pa.int64(), pa.binary(), pa.int32(), pa.string()]
_SIGNATURE = b"\x89PNG\r\n\x1a\n"


def frames(text: str | None) -> bytes:
    """UTF-8 bytes, padded to a positive multiple of ``FRAME``."""
    raw = (text or "").encode()
    return raw + PAD * (-len(raw) % FRAME or (0 if raw else FRAME))


def png(samples: bytes, width: int = FRAME) -> bytes:
    """8-bit greyscale image whose rows are ``width`` samples."""
    chunk = lambda kind, data: struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))
    rows = np.frombuffer(samples, np.uint8).reshape(-1, width)
    scan = np.zeros((len(rows), width + 1), np.uint8)  # filter 0 before each row
    scan[:, 1:] = rows
    head = struct.pack(">IIBBBBB", width, len(rows), 8, 0, 0, 0, 0)
    return _SIGNATURE + chunk(b"IHDR", head) + chunk(b"IDAT", zlib.compress(scan.tobytes(), 4)) + chunk(b"IEND", b"")


def png_samples(image: bytes) -> bytes:
    """Samples of an image that ``png`` wrote; checks signature, chunk checksums and format."""
    if image[:8] != _SIGNATURE:
        raise ValueError("not a PNG image")
    at, data, head = 8, [], None
    while at < len(image):
        (size,), kind = struct.unpack(">I", image[at : at + 4]), image[at + 4 : at + 8]
        body = image[at + 8 : at + 8 + size]
        if struct.pack(">I", zlib.crc32(kind + body)) != image[at + 8 + size : at + 12 + size]:
            raise ValueError("chunk checksum")
        if kind == b"IHDR":
            head = struct.unpack(">IIBBBBB", body)
        elif kind == b"IDAT":
            data.append(body)
        at += 12 + size
    width, height, *form = head
    scan = np.frombuffer(zlib.decompress(b"".join(data)), np.uint8).reshape(height, width + 1)
    if form[:2] != [8, 0] or scan[:, 0].any():
        raise ValueError("only unfiltered 8-bit greyscale")
    return scan[:, 1:].tobytes()


def write_archives(members: DataFrame, folder: str, encode=png, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Write ``members(name string, payload binary)`` as ZIP archives under ``folder``; returns the written manifest."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = pafs.FileSystem.from_uri(folder)
        store.create_dir(root, recursive=True)
        part, made = TaskContext.get().partitionId(), 0
        buffer, archive, count = io.BytesIO(), None, 0

        def close() -> pa.RecordBatch:
            archive.close()
            name = f"{root}/part-{part:06d}-{made:05d}.zip"
            draft = f"{root}/.{uuid.uuid4().hex}"
            with store.open_output_stream(draft) as out:
                out.write(buffer.getvalue())
            store.move(draft, name)
            return pa.RecordBatch.from_arrays([pa.array([name]), pa.array([count]), pa.array([buffer.tell()])], ["archive", "members", "bytes"])

        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                piece = batch.slice(at, 64)
                for name, payload in zip(piece.column(0).to_pylist(), piece.column(1).to_pylist(), strict=True):
                    if archive is None:
                        buffer, count = io.BytesIO(), 0
                        archive = zipfile.ZipFile(buffer, "w", zipfile.ZIP_STORED)
                    archive.writestr(zipfile.ZipInfo(f"{count}/{name}"), encode(payload))
                    count += 1
                    if buffer.tell() >= archive_bytes:
                        yield close()
                        archive, made = None, made + 1
        if archive is not None:
            yield close()

    return materialise(members.select("name", "payload").mapInArrow(run, "archive string, members long, bytes long"), "media-manifest")


class ByteRange(InputPartition):
    """Members of one archive whose headers start in [lo, hi)."""

    def __init__(self, archive: str, lo: int, hi: int) -> None:
        super().__init__(None)
        self.archive, self.lo, self.hi = archive, lo, hi


class ArchiveReader(DataSourceReader):
    def __init__(self, options: dict[str, str]) -> None:
        self.folder = options["path"]
        self.split = int(options.get("splitBytes", 16_000_000))
        self.tries = int(options.get("tries", 4))
        self.wait_s = float(options.get("waitSeconds", 0.2))
        self.batch_bytes = int(options.get("batchBytes", 4_000_000))
        self.null = options.get("onError", "fail") == "null"

    def partitions(self) -> list[ByteRange]:
        store, root = pafs.FileSystem.from_uri(self.folder)
        found = [f for f in store.get_file_info(pafs.FileSelector(root, recursive=True)) if f.is_file and f.base_name.endswith(".zip")]
        ranges = [ByteRange(f.path, lo, lo + self.split) for f in sorted(found, key=lambda f: f.path) for lo in range(0, f.size, self.split)]
        return ranges or [ByteRange("", 0, 0)]

    def _member(self, store, handle, partition: ByteRange, info: zipfile.ZipInfo):
        """(handle, payload, tries, error) of one member, read at its offset."""
        error = ""
        for tries in range(1, self.tries + 1):
            try:
                if handle is None:
                    handle = store.open_input_file(partition.archive)
                handle.seek(info.header_offset)
                head = handle.read(30)
                if head[:4] != b"PK\x03\x04":
                    raise ValueError("no member header")
                names, extra = struct.unpack("<HH", head[26:30])
                handle.seek(info.header_offset + 30 + names + extra)
                body = handle.read(info.compress_size)
                payload = body if info.compress_type == zipfile.ZIP_STORED else zlib.decompress(body, -15)
                if zlib.crc32(payload) != info.CRC:
                    raise ValueError("member checksum")
                return handle, payload, tries, None
            except (OSError, ValueError, zlib.error) as e:
                error = f"{type(e).__name__}: {e}"
                handle = None
                if tries < self.tries:
                    time.sleep(self.wait_s * 2 ** (tries - 1))
        if not self.null:
            raise OSError(f"{partition.archive} at {info.header_offset}: {error}")
        return None, None, self.tries, error

    def read(self, partition: ByteRange) -> Iterator[pa.RecordBatch]:
        if not partition.archive:
            return
        store, _ = pafs.FileSystem.from_uri(self.folder)
        with store.open_input_file(partition.archive) as f, zipfile.ZipFile(f) as z:
            members = [i for i in z.infolist() if partition.lo <= i.header_offset < partition.hi]
        handle, rows, size = None, [], 0
        for info in members:
            handle, payload, tries, error = self._member(store, handle, partition, info)
            rows.append((partition.archive, info.header_offset, info.filename, info.file_size, payload, tries, error))
            size += info.file_size
            if size >= self.batch_bytes or len(rows) >= 512:
                yield self._batch(rows)
                rows, size = [], 0
        if rows:
            yield self._batch(rows)

    @staticmethod
    def _batch(rows: list[tuple]) -> pa.RecordBatch:
        columns = zip(*rows, strict=True)
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, _KINDS, strict=True)], _NAMES)


class ArchiveSource(DataSource):
    """``spark.read.format("archive_members").load(folder)``; returns ``MEMBERS``.

    Options: ``splitBytes``, ``tries``, ``waitSeconds`` (doubled each time), ``batchBytes``, ``onError`` (fail or null).
    The folder is any place that ``pyarrow.fs`` opens by URI.
    """

    @classmethod
    def name(cls) -> str:
        return "archive_members"

    def schema(self) -> str:
        return MEMBERS

    def reader(self, schema) -> ArchiveReader:
        return ArchiveReader(self.options)


def read_archives(spark, folder: str, **options) -> DataFrame:
    """Members of all archives under ``folder``: ``MEMBERS``."""
    spark.dataSource.register(ArchiveSource)
    return spark.read.format("archive_members").options(**options).load(folder)


def features(samples: bytes) -> str:
    """Frames, mean, deviation, entropy in bits and share of rises of the samples."""
    x = np.frombuffer(samples, np.uint8)
    share = np.bincount(x, minlength=256) / len(x)
    entropy = -(share[share > 0] * np.log2(share[share > 0])).sum()
    rises = (x[1:] > x[:-1]).mean()
    return f"frames={len(x) // FRAME};mean={x.mean():.3f};std={x.std():.3f};entropy={entropy:.4f};rises={rises:.4f}"


def media_columns(members: DataFrame) -> DataFrame:
    """Digests and features of ``members(name, payload)`` that hold PNG images; the id is the name's last part."""
    schema = "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string"
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for k in range(batch.num_rows):
                name, image = batch.column(0)[k].as_py(), batch.column(1)[k].as_py()
                doc = name.rpartition("/")[2]
                samples = png_samples(image)
                raw = samples.rstrip(PAD)
                rows.append((int(doc) if doc else None, len(raw), len(samples), hashlib.sha256(samples).hexdigest(), zlib.crc32(samples[-32:]), len(image), hashlib.sha256(image).hexdigest(), features(samples)))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], [f.split()[0] for f in schema.split(", ")])

    return members.select("name", "payload").mapInArrow(run, schema)


def _payloads(docs: DataFrame) -> DataFrame:
    """(name, payload) of each text, natively: UTF-8 bytes, padded to a positive multiple of ``FRAME``."""
    raw = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    pad = F.when(F.octet_length(raw) == 0, FRAME).otherwise(F.pmod(-F.octet_length(raw), F.lit(FRAME)))
    return docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("name"), F.concat(raw, F.unhex(F.repeat(F.lit("FF"), pad))).alias("payload"))


def op6_media_columns(spark, sf_dir: str) -> DataFrame:
    """All documents as images in archives, read back through the data source."""
    folder = new_folder(spark, "media")
    if ":" not in folder:
        folder = f"file://{folder}"
    write_archives(_payloads(spark.read.parquet(f"{sf_dir}/documents.parquet")), folder)
    return media_columns(read_archives(spark, folder))
