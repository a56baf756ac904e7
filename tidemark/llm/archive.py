"""Seekable Zstandard bundles of WARC records: writing with revisits, and reading back by record id."""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.durable import durable, shared_folder

# Fixed values of the seekable format: skippable frame, footer, one entry per frame of two 32-bit sizes
_SKIPPABLE, _SEEKABLE, _ENTRY = 0x184D2A5E, 0x8F92EAB1, struct.Struct("<II")
_HEAD, _FOOT = struct.Struct("<II"), struct.Struct("<IBI")
# Bytes of records that a task reads back
_READ_BYTES = 1 << 24
_NAMES = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")
_INDEX = "page_id long, bundle string, frame int, start int, length int"
_RECORD = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"


def record_id(page_id: int | None, url: str | None = None, payload: bytes = b"") -> str:
    """The record's name: by its page_id, or without one by what it holds."""
    name = f"page:{page_id}" if page_id is not None else f"nameless:{digest(payload)}:{url or ''}"
    return f"<urn:uuid:{uuid.uuid5(_NAMES, name)}>"


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def warc_record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, date: str) -> bytes:
    """One WARC/1.1 record; a revisit names the record with the same payload and has no payload of its own."""
    fields = [
        ("WARC-Type", "response" if refers_to is None else "revisit"),
        ("WARC-Record-ID", record_id(page_id, url, payload)),
        ("WARC-Date", date),
        ("WARC-Target-URI", (url or "").replace("\r", "%0D").replace("\n", "%0A")),
        ("WARC-Payload-Digest", f"sha1:{digest(payload)}"),
        *([] if page_id is None else [("X-Page-ID", str(page_id))]),
        ("X-Payload-Length", str(len(payload))),
        ("Content-Type", "text/html"),
    ]
    if refers_to is not None:
        fields += [
            ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"),
            ("WARC-Refers-To", record_id(refers_to)),
            ("X-Refers-To-Page-ID", str(refers_to)),
        ]
    body = payload if refers_to is None else b""
    fields.append(("Content-Length", str(len(body))))
    head = "".join(f"{name}: {value}\r\n" for name, value in fields)
    return b"WARC/1.1\r\n" + head.encode() + b"\r\n" + body + b"\r\n\r\n"


def parse_record(record: bytes) -> tuple[dict[str, str], bytes]:
    head, _, rest = record.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")[1:]
    fields = dict(line.split(": ", 1) for line in lines)
    return fields, rest[: int(fields["Content-Length"])]


class BundleWriter:
    """Records in frames of about ``frame_bytes``, then a skippable frame with the sizes of all frames."""

    def __init__(self, out, frame_bytes: int, level: int):
        self.out, self.frame_bytes = out, frame_bytes
        self.pack = zstandard.ZstdCompressor(level=level).compress
        self.sizes: list[tuple[int, int]] = []
        self.waiting: list[bytes] = []
        self.filled = self.total = 0

    def add(self, record: bytes) -> tuple[int, int]:
        """The record's frame and its place in the frame's content."""
        if self.filled and self.filled + len(record) > self.frame_bytes:
            self.flush()
        at = (len(self.sizes), self.filled)
        self.waiting.append(record)
        self.filled += len(record)
        return at

    def flush(self) -> None:
        if self.waiting:
            packed = self.pack(b"".join(self.waiting))
            self.out.write(packed)
            self.sizes.append((len(packed), self.filled))
            self.total += len(packed)
            self.waiting, self.filled = [], 0

    def close(self) -> None:
        self.flush()
        table = b"".join(_ENTRY.pack(*size) for size in self.sizes)
        self.out.write(_HEAD.pack(_SKIPPABLE, len(table) + _FOOT.size) + table)
        self.out.write(_FOOT.pack(len(self.sizes), 0, _SEEKABLE))
        self.out.close()


class BundleReader:
    """Frames of a bundle by number, found through the seek table at its end."""

    def __init__(self, file):
        self.file = file
        size = file.size()
        file.seek(size - _FOOT.size)
        frames, _, magic = _FOOT.unpack(file.read(_FOOT.size))
        if magic != _SEEKABLE:
            raise ValueError("no seek table at the end of the bundle")
        file.seek(size - _FOOT.size - frames * _ENTRY.size)
        self.sizes = list(_ENTRY.iter_unpack(file.read(frames * _ENTRY.size)))
        self.starts = [0]
        for packed, _ in self.sizes:
            self.starts.append(self.starts[-1] + packed)
        self.unpack = zstandard.ZstdDecompressor().decompress

    def frame(self, number: int) -> bytes:
        self.file.seek(self.starts[number])
        packed, full = self.sizes[number]
        return self.unpack(self.file.read(packed), max_output_size=full)


def _with_referred(pages: DataFrame, least_bytes: int) -> DataFrame:
    """page_id, url, html and refers_to, the response that a page's record revisits.

    Texts join by page_id. Rows without one join by their payload; any page with the payload that has an id is larger.
    """
    wide = pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("html"))
    payload = F.col("html").cast("binary")
    facts = wide.select("page_id", F.sha1(payload).alias("_sha1"), F.octet_length(payload).alias("_bytes"))
    known = durable(facts.filter((F.col("_bytes") >= least_bytes) & F.col("page_id").isNotNull()))
    largest = durable(known.groupBy("_sha1").agg(F.max("page_id").alias("refers_to"), F.count(F.lit(1)).alias("_n")))
    shared = largest.filter("_n > 1").drop("_n")
    revisits = known.join(shared, "_sha1").filter("page_id < refers_to").select("page_id", "refers_to").distinct()
    nameless = wide.filter("page_id IS NULL").withColumn("_sha1", F.sha1(payload)).join(largest.drop("_n"), "_sha1", "left")
    return wide.filter("page_id IS NOT NULL").join(revisits, "page_id", "left").unionByName(nameless.drop("_sha1"))


def write_bundles(
    pages: DataFrame,
    folder: str,
    least_bytes: int = 0,
    frame_bytes: int = 1 << 18,
    bundle_bytes: int = 1 << 28,
    level: int = 3,
    date: str = "2000-01-01T00:00:00Z",
) -> DataFrame:
    """Write a record per page into bundles in ``folder`` and return their index: page_id, bundle, frame, start, length.

    Of equal payloads of at least ``least_bytes`` bytes the record with the largest page_id is the response. Each task
    writes the bundles of its partition under names made of the partition's number, first to a name of its own attempt,
    then renamed: a task that is run again replaces what it wrote with the same content. The index is stored before
    it is used, so bundles are written once. ``folder`` is opened by its URI on the executors; it must be shared.
    """
    ready = _with_referred(pages, least_bytes)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, root = pa.fs.FileSystem.from_uri(folder)
        task = TaskContext.get()
        writer = place = None
        numbers = 0

        def finish() -> None:
            writer.close()
            files.move(place + f".{task.taskAttemptId()}", place)

        for batch in batches:
            rows = []
            for page in batch.to_pylist():
                record = warc_record(page["page_id"], page["url"], page["html"].encode(), page["refers_to"], date)
                if writer is None:
                    place = f"{root}/bundle-{task.partitionId():06d}-{numbers:04d}.warc.zst"
                    writer = BundleWriter(files.open_output_stream(place + f".{task.taskAttemptId()}"), frame_bytes, level)
                frame, start = writer.add(record)
                rows.append((page["page_id"], place.rpartition("/")[2], frame, start, len(record)))
                if writer.total >= bundle_bytes:
                    finish()
                    writer, numbers = None, numbers + 1
            columns = zip(*rows, strict=True) if rows else [[]] * 5
            kinds = (pa.int64(), pa.string(), pa.int32(), pa.int32(), pa.int32())
            names = ["page_id", "bundle", "frame", "start", "length"]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)
        if writer is not None:
            finish()

    return durable(ready.mapInArrow(write, _INDEX))


def read_records(index: DataFrame, folder: str) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to of the indexed records, from the bundles.

    The index rows of a frame are brought together, and a task opens a bundle once for all its frames. A response's
    figures come from its payload; a revisit's are those that its record states of the payload it refers to.
    """
    # As many tasks as the records' bytes ask for: the index is small, and sized by itself it would be a single task.
    size = index.agg(F.sum("length")).first()[0] or 0
    parts = max(1, -(-size // _READ_BYTES))
    dealt = index.repartition(parts, "bundle", "frame").sortWithinPartitions("bundle", "frame", "start")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, root = pa.fs.FileSystem.from_uri(folder)
        name = number = reader = content = None
        for batch in batches:
            rows = []
            for at in batch.to_pylist():
                if at["bundle"] != name:
                    name, number = at["bundle"], None
                    reader = BundleReader(files.open_input_file(f"{root}/{name}"))
                if at["frame"] != number:
                    number = at["frame"]
                    content = reader.frame(number)
                fields, payload = parse_record(content[at["start"] : at["start"] + at["length"]])
                stated = fields["WARC-Payload-Digest"].removeprefix("sha1:")
                if fields["WARC-Type"] == "response":
                    if digest(payload) != stated:
                        raise ValueError(f"{name}, frame {number}: payload and digest differ")
                    length, of = len(payload), None
                else:
                    length, of = int(fields["X-Payload-Length"]), int(fields["X-Refers-To-Page-ID"])
                page_id = int(fields["X-Page-ID"]) if "X-Page-ID" in fields else None
                rows.append((page_id, length, stated, fields["WARC-Type"], of))
            kinds = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64())
            names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
            columns = zip(*rows, strict=True) if rows else [[]] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)

    return dealt.mapInArrow(read, _RECORD)


def archive_pages(pages: DataFrame, folder: str | None = None) -> DataFrame:
    """Write every page to bundles and read all of them back (``read_records``).

    A null html is an empty payload. Rows without a page_id are written without one, as revisits of the largest page_id of
    their payload or else as responses; repeated rows are responses each when their id is the largest of their payload, else
    revisits each; texts may have any length below 2 GiB; an empty table writes nothing. ``folder`` defaults to a new one in the session's shared folder.
    """
    folder = folder or shared_folder(pages.sparkSession, "warc")
    if "://" not in folder:
        folder = f"file://{folder.removeprefix('file:')}"
    return read_records(write_bundles(pages, folder), folder)
