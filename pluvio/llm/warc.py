"""WARC records in seekable Zstandard bundles.

Records are grouped into independent Zstandard frames of about ``FRAME`` bytes.
A bundle ends with a skippable frame that holds the seek table (compressed and
plain size of every frame, as in the public seekable format), so a reader finds
any frame from the last bytes of the file. The index maps every record to its
bundle, frame and offset inside the plain frame; reading one record costs the
footer and one frame.

Every task streams its rows into bundles of its own under the folder given,
which all executors must share, and hands back index rows only after a bundle is
closed. Bundle names are never reused: what a lost or repeated task leaves
behind is in no index and is never read.

Of records with equal payloads of at least ``least`` bytes, the one with the
largest id is a response and the others are revisits of it. Rows that repeat
that id are responses too. A row without id is a response and nothing refers to
it. A null payload is empty. Ids may repeat: the index has a line for each row.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pluvio.llm.common import col

FRAME = 256 << 10
BUNDLE = 32 << 20
LEAST = 1000
# Fixed values of the seekable format and of WARC.
SKIPPABLE, SEEKABLE = 0x184D2A5E, 0x8F92EAB1
DATE = "2024-01-01T00:00:00Z"
HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
INDEX = "page_id bigint, bundle string, frame bigint, start bigint, size bigint"


def _store(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path.replace("s3a://", "s3://")) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)


def record_id(page_id: int | None) -> str:
    named = uuid.uuid4() if page_id is None else uuid.uuid5(uuid.NAMESPACE_URL, f"page:{page_id}")
    return f"<urn:uuid:{named}>"


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """One WARC record; a revisit holds the HTTP header only."""
    kind = "response" if refers_to is None else "revisit"
    block = HTTP + payload if refers_to is None else HTTP
    fields = [("WARC-Type", kind), ("WARC-Record-ID", record_id(page_id)), ("WARC-Date", DATE)]
    if url is not None:
        fields.append(("WARC-Target-URI", "".join(c if c.isprintable() and c != " " else "".join(f"%{b:02X}" for b in c.encode("utf-8", "replace")) for c in url)))
    if page_id is not None:
        fields.append(("X-Page-ID", str(page_id)))
    fields.append(("WARC-Payload-Digest", "sha1:" + base64.b32encode(bytes.fromhex(digest)).decode()))
    if refers_to is not None:
        fields += [("WARC-Refers-To", record_id(refers_to)), ("X-Refers-To-Page-ID", str(refers_to)), ("WARC-Profile", PROFILE), ("X-Payload-Length", str(len(payload)))]
    fields += [("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(block)))]
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields) + "\r\n"
    return head.encode("utf-8") + block + b"\r\n\r\n"


def parse(data: bytes | memoryview) -> dict:
    """The fields of the record that ``data`` holds, and its payload."""
    raw = bytes(data)
    head, _, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode("utf-8").split("\r\n")
    if lines[0] != "WARC/1.1":
        raise ValueError("no WARC record here")
    fields = dict(line.split(": ", 1) for line in lines[1:])
    block = rest[: int(fields["Content-Length"])]
    if rest[len(block) :] != b"\r\n\r\n":
        raise ValueError("a WARC record does not end where its length says")
    return fields | {"payload": block.partition(b"\r\n\r\n")[2]}


class BundleWriter:
    """Streams records into one bundle; ``close`` appends the seek table."""

    def __init__(self, folder: str):
        self.path = f"{folder.rstrip('/')}/{uuid.uuid4().hex}.warc.zst"
        store, place = _store(self.path)
        store.create_dir(place.rpartition("/")[0], recursive=True)
        self.out = store.open_output_stream(place, compression=None)
        self.sizes: list[tuple[int, int]] = []
        self.records: list[bytes] = []
        self.filled = self.total = 0
        self.press = zstandard.ZstdCompressor(level=3)

    def add(self, data: bytes) -> tuple[str, int, int, int]:
        place = (self.path, len(self.sizes), self.filled, len(data))
        self.records.append(data)
        self.filled += len(data)
        self.total += len(data)
        if self.filled >= FRAME:
            self.flush()
        return place

    def flush(self) -> None:
        if self.records:
            frame = self.press.compress(b"".join(self.records))
            self.out.write(frame)
            self.sizes.append((len(frame), self.filled))
            self.records, self.filled = [], 0

    def close(self) -> None:
        self.flush()
        entries = b"".join(struct.pack("<II", *sizes) for sizes in self.sizes)
        footer = entries + struct.pack("<IBI", len(self.sizes), 0, SEEKABLE)
        self.out.write(struct.pack("<II", SKIPPABLE, len(footer)) + footer)
        self.out.close()


class BundleReader:
    """Reads records of one bundle by frame and offset."""

    def __init__(self, path: str):
        store, place = _store(path)
        self.file = store.open_input_file(place)
        size = self.file.size()
        count, _, magic = struct.unpack("<IBI", self.file.read_at(9, size - 9))
        if magic != SEEKABLE:
            raise ValueError(f"{path} has no seek table")
        table = self.file.read_at(8 * count, size - 9 - 8 * count)
        self.frames, start = [], 0
        for packed, plain in struct.iter_unpack("<II", table):
            self.frames.append((start, packed, plain))
            start += packed
        self.open_frame, self.plain = -1, b""

    def read(self, frame: int, start: int, size: int) -> dict:
        if frame != self.open_frame:
            at, packed, plain = self.frames[frame]
            self.plain = zstandard.ZstdDecompressor().decompress(self.file.read_at(packed, at), max_output_size=plain)
            self.open_frame = frame
        return parse(memoryview(self.plain)[start : start + size])


def planned(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html", least: int = LEAST) -> DataFrame:
    """Every row's payload, digest and, for a revisit, the id it refers to.

    Copies are counted per digest before anything is shuffled, and only digests
    that several rows share are joined back. A digest with a third of all rows
    is split by the skew join.
    """
    payload = F.coalesce(col(payload_col), F.lit("")).cast("binary")
    rows = pages.select(col(id_col).cast("bigint").alias("page_id"), col(url_col).cast("string").alias("url"), payload.alias("payload"))
    rows = rows.withColumn("digest", F.sha1("payload")).withColumn("same", F.when(F.octet_length("payload") >= least, F.sha2("payload", 256)))
    shared = rows.where("same is not null").groupBy("same").agg(F.count(F.lit(1)).alias("n"), F.max("page_id").alias("kept")).where("n > 1").select("same", "kept")
    joined = rows.join(shared, "same", "left")
    return joined.select("page_id", "url", "payload", "digest", F.when(F.col("page_id") < F.col("kept"), F.col("kept")).alias("refers_to"))


def write(rows: DataFrame, folder: str) -> DataFrame:
    """Writes ``planned`` rows as bundles; returns the index. Keep the index: each evaluation writes anew."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        writer, lines = None, []

        def closed() -> pa.RecordBatch:
            writer.close()
            return pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(zip(*lines), [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.int64()])], ["page_id", "bundle", "frame", "start", "size"])

        for batch in batches:
            for i in range(batch.num_rows):
                page_id, url, payload, digest, refers_to = (c[i].as_py() for c in batch.columns)
                writer = writer or BundleWriter(folder)
                lines.append((page_id, *writer.add(record(page_id, url, payload, digest, refers_to))))
                if writer.total >= BUNDLE:
                    yield closed()
                    writer, lines = None, []
        if writer:
            yield closed()

    return rows.mapInArrow(run, INDEX)


READ = "page_id bigint, record_id string, url string, record_type string, payload_digest string, payload_bytes bigint, refers_to bigint, payload binary"


def read(index: DataFrame, tasks: int) -> DataFrame:
    """The records behind index lines, each task reading whole bundles in order."""

    def one(reader: BundleReader, frame: int, start: int, size: int) -> tuple:
        got = reader.read(frame, start, size)
        digest = base64.b32decode(got["WARC-Payload-Digest"].removeprefix("sha1:")).hex()
        response = got["WARC-Type"] == "response"
        if response and hashlib.sha1(got["payload"]).hexdigest() != digest:
            raise ValueError(f"payload of {got['WARC-Record-ID']} does not match its digest")
        number = lambda name: int(got[name]) if name in got else None
        length = len(got["payload"]) if response else number("X-Payload-Length")
        return number("X-Page-ID"), got["WARC-Record-ID"], got.get("WARC-Target-URI"), got["WARC-Type"], digest, length, number("X-Refers-To-Page-ID"), got["payload"] if response else None

    types = [pa.int64(), pa.string(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.binary()]
    names = [part.split()[0] for part in READ.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        path, reader = None, None
        for batch in batches:
            made = []
            for line in batch.to_pylist():
                if line["bundle"] != path:
                    path, reader = line["bundle"], BundleReader(line["bundle"])
                made.append(one(reader, line["frame"], line["start"], line["size"]))
                if len(made) == 256:
                    yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(zip(*made), types)], names)
                    made = []
            if made:
                yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(zip(*made), types)], names)

    placed = index.repartition(max(1, tasks), "bundle").sortWithinPartitions("bundle", "frame", "start")
    return placed.mapInArrow(run, READ)
