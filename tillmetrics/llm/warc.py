"""WARC archives as seekable Zstandard bundles.

Records are grouped into frames that are compressed on their own. A bundle is such
frames one after the other and, as its footer, a skippable frame with the seek table:
the compressed and the plain size of every frame, as zstd's seekable format lays them
out, so any zstd reader unpacks a bundle. An index maps each record's identifier to its
bundle, its frame and its place within the frame; one record is read by two reads, of
the seek table and of one frame.

Records with equal payloads of ``REVISIT_BYTES`` or more are stored once, by the record
with the largest key; the others become revisit records that refer to it.

Each attempt of a task writes bundles of its own name, and only those that the index
lists count, so a lost executor or a repeated task leaves at most unused files.

Defined results: a null payload is an empty one. Rows with equal keys are separate
records; if they share the largest key of equal payloads, each is a response. A record
with a null key never stands for others; if all equal payloads have null keys, each is
a response. An empty table gives an empty index. Only the named columns are read.
"""

from __future__ import annotations

import hashlib
import struct
import uuid
from collections.abc import Iterator

import pandas as pd
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillmetrics.llm.tables import stored
from tillmetrics.session import shared_folder

REVISIT_BYTES = 1000
FRAME_BYTES = 1 << 20  # plain bytes after which a frame is closed
BUNDLE_BYTES = 64 << 20  # compressed bytes after which a bundle is closed
READ_BYTES = 32 << 20  # compressed bytes that a task reads back
LEVEL = 3

# Fixed values of zstd's seekable format.
SKIPPABLE_MAGIC = 0x184D2A5E
SEEKABLE_MAGIC = 0x8F92EAB1
FOOTER = "<IBI"  # number of frames, descriptor, magic
ENTRY = "<II"  # compressed size, plain size
SKIP = "<II"  # magic, size of what follows

INDEX_SCHEMA = (
    "key bigint, bundle string, frame int, frame_at bigint, frame_bytes bigint, record_at bigint, record_bytes bigint"
)
RECORD_SCHEMA = (
    "key bigint, record_type string, refers_to bigint, payload_bytes bigint, payload_digest string, "
    "target_uri string, payload binary"
)
_RECORD = ["key", "record_type", "refers_to", "payload_bytes", "payload_digest", "target_uri", "payload"]


def record_id(key: int | None) -> str:
    return f"<urn:key:{'' if key is None else key}>"


def _key_of(name: str) -> int | None:
    digits = name.removeprefix("<urn:key:").removesuffix(">")
    return int(digits) if digits else None


def encode_record(
    key: int | None, kind: str, refers_to: int | None, size: int, digest: str, uri: str | None, payload: bytes
) -> bytes:
    """One WARC/1.1 record. A revisit has no payload but says how long it was."""
    uri = (uri or "").replace("\r", "%0D").replace("\n", "%0A")
    head = [
        "WARC/1.1",
        f"WARC-Type: {kind}",
        f"WARC-Record-ID: {record_id(key)}",
        "WARC-Date: 1970-01-01T00:00:00Z",
        f"WARC-Payload-Digest: sha1:{digest}",
        f"X-Payload-Length: {size}",
        "Content-Type: text/html",
    ]
    if uri:
        head.append(f"WARC-Target-URI: {uri}")
    if kind == "revisit":
        head.append("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
        head.append(f"WARC-Refers-To: {record_id(refers_to)}")
        payload = b""
    head.append(f"Content-Length: {len(payload)}")
    return "\r\n".join(head).encode("utf-8", "replace") + b"\r\n\r\n" + payload + b"\r\n\r\n"


def decode_record(data: bytes | memoryview, at: int = 0) -> tuple[tuple, int]:
    """The record at ``at``, as RECORD_SCHEMA has it, and the place behind it."""
    data = bytes(data) if not isinstance(data, bytes) else data
    stop = data.index(b"\r\n\r\n", at)
    lines = data[at:stop].decode("utf-8").split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError(f"no WARC record at byte {at}")
    head = dict(line.split(": ", 1) for line in lines[1:])
    size = int(head["Content-Length"])
    payload = data[stop + 4 : stop + 4 + size]
    if len(payload) != size or data[stop + 4 + size : stop + 8 + size] != b"\r\n\r\n":
        raise ValueError(f"cut off record at byte {at}")
    digest = head["WARC-Payload-Digest"].removeprefix("sha1:")
    kind = head["WARC-Type"]
    if kind != "revisit" and hashlib.sha1(payload).hexdigest() != digest:
        raise ValueError(f"record {head['WARC-Record-ID']} does not have its digest")
    refers = head.get("WARC-Refers-To")
    record = (
        _key_of(head["WARC-Record-ID"]),
        kind,
        _key_of(refers) if refers else None,
        int(head["X-Payload-Length"]),
        digest,
        head.get("WARC-Target-URI"),
        payload,
    )
    return record, stop + 8 + size


def seek_table(sizes: list[tuple[int, int]]) -> bytes:
    body = b"".join(struct.pack(ENTRY, *s) for s in sizes) + struct.pack(FOOTER, len(sizes), 0, SEEKABLE_MAGIC)
    return struct.pack(SKIP, SKIPPABLE_MAGIC, len(body)) + body


def read_seek_table(tail: bytes) -> list[tuple[int, int]]:
    """Compressed and plain sizes of the frames, from a bundle's last bytes."""
    n, descriptor, magic = struct.unpack(FOOTER, tail[-struct.calcsize(FOOTER) :])
    if magic != SEEKABLE_MAGIC or descriptor:
        raise ValueError("no seek table")
    body = tail[-struct.calcsize(FOOTER) - n * struct.calcsize(ENTRY) : -struct.calcsize(FOOTER)]
    return list(struct.iter_unpack(ENTRY, body))


class _Bundle:
    """A bundle being written, with the index rows of what it holds so far."""

    def __init__(self, folder: str):
        from pyarrow import fs

        self.path = f"{folder}/{uuid.uuid4().hex}.warc.zst"
        system, place = fs.FileSystem.from_uri(self.path)
        system.create_dir(place.rsplit("/", 1)[0], recursive=True)
        self.out = system.open_output_stream(place, compression=None)
        self.pack = zstandard.ZstdCompressor(level=LEVEL)
        self.sizes: list[tuple[int, int]] = []
        self.at = 0
        self.frame: list[bytes] = []
        self.filled = 0
        self.open: list[tuple] = []  # key, place, size of the frame's records
        self.rows: list[tuple] = []

    def add(self, key: int | None, record: bytes) -> None:
        self.open.append((key, self.filled, len(record)))
        self.frame.append(record)
        self.filled += len(record)
        if self.filled >= FRAME_BYTES:
            self.close_frame()

    def close_frame(self) -> None:
        if not self.frame:
            return
        packed = self.pack.compress(b"".join(self.frame))
        self.out.write(packed)
        n = len(self.sizes)
        self.rows += [(k, self.path, n, self.at, len(packed), p, size) for k, p, size in self.open]
        self.sizes.append((len(packed), self.filled))
        self.at += len(packed)
        self.frame, self.filled, self.open = [], 0, []

    def finish(self) -> list[tuple]:
        self.close_frame()
        self.out.write(seek_table(self.sizes))
        self.out.close()
        return self.rows


def _frame_of(rows: list[tuple], names: list[str]) -> pd.DataFrame:
    columns = dict(zip(names, zip(*rows))) if rows else {n: [] for n in names}
    for c in {"key", "refers_to"} & set(names):
        columns[c] = pd.array(columns[c], dtype="Int64")
    return pd.DataFrame(columns)


def _as_uri(spark: SparkSession, folder: str) -> str:
    """The folder with its scheme: that of the default file system, where it names none."""
    place = spark._jvm.org.apache.hadoop.fs.Path(folder)
    system = place.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    uri = system.makeQualified(place).toString()
    if uri.startswith("file:/") and not uri.startswith("file:///"):
        uri = "file://" + uri.removeprefix("file:")
    return "s3://" + uri.removeprefix("s3a://") if uri.startswith("s3a://") else uri  # as pyarrow calls it


def with_roles(records: DataFrame, least: int = REVISIT_BYTES) -> DataFrame:
    """Records (key, target_uri, payload) with length, digest, and which refer to which."""
    sized = records.select(
        "key",
        "target_uri",
        F.coalesce(F.col("payload").cast("binary"), F.lit(b"")).alias("payload"),
    ).withColumns({"payload_bytes": F.octet_length("payload").cast("bigint"), "payload_digest": F.sha1("payload")})
    same = ["payload_digest", "payload_bytes"]
    large = sized.filter(F.col("payload_bytes") >= least)
    # One short row per payload; copies are counted before the shuffle, so a page that is
    # copied a million times is one row per task there.
    first = large.groupBy(*same).agg(F.max("key").alias("first"), F.count("*").alias("copies"))
    first = first.filter("copies > 1").drop("copies")
    # Spark may split a payload that many rows share over several tasks of this join.
    joined = sized.join(first, same, "left")
    revisit = F.col("first").isNotNull() & ~F.col("key").eqNullSafe(F.col("first"))
    return joined.select(
        "key",
        F.when(revisit, "revisit").otherwise("response").alias("record_type"),
        F.when(revisit, F.col("first")).alias("refers_to"),
        "payload_bytes",
        "payload_digest",
        "target_uri",
        F.when(~revisit, F.col("payload")).alias("payload"),
    )


def write_bundles(records: DataFrame, folder: str) -> DataFrame:
    """Write records (as ``with_roles`` has them) below ``folder``; returns the stored index."""
    target = _as_uri(records.sparkSession, folder)

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = INDEX_SCHEMA.replace(",", "").split()[::2]
        bundle = None
        for batch in batches:
            for row in zip(*(batch[c].astype(object).where(batch[c].notna(), None) for c in _RECORD)):
                key, kind, refers, size, digest, uri, payload = row
                key, refers = (None if k is None else int(k) for k in (key, refers))
                bundle = bundle or _Bundle(target)
                bundle.add(key, encode_record(key, kind, refers, int(size), digest, uri, payload or b""))
                if bundle.at >= BUNDLE_BYTES:
                    yield _frame_of(bundle.finish(), names)
                    bundle = None
        if bundle:
            yield _frame_of(bundle.finish(), names)

    keys = {c: F.col(c).cast("string") for c in ("key", "refers_to")}  # pandas has no exact null integers
    return stored(records.select(*_RECORD).withColumns(keys).mapInPandas(pack, INDEX_SCHEMA), "warc-index")


def read_bundles(spark: SparkSession, index: DataFrame) -> DataFrame:
    """Every record of the bundles that an index lists, each checked against its digest."""
    from pyarrow import fs

    frames = index.select("bundle", "frame", "frame_at", "frame_bytes").distinct()
    # The index is short whatever the archive is: tasks are as many as the frames' bytes ask for.
    whole = frames.agg(F.sum("frame_bytes")).first()[0] or 0
    frames = frames.repartitionByRange(max(1, -(-whole // READ_BYTES)), "bundle", "frame_at")

    def unpack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for path, part in batch.groupby("bundle"):
                system, place = fs.FileSystem.from_uri(path)
                with system.open_input_file(place) as file:
                    sizes = _sizes_of(file)
                    for n, at, size in zip(part["frame"], part["frame_at"], part["frame_bytes"]):
                        data, plain = _frame(file, int(at), int(size)), sizes[n][1]
                        if sizes[n][0] != size or len(data) != plain:
                            raise ValueError(f"seek table and index differ on {path}, frame {n}")
                        rows, at = [], 0
                        while at < len(data):
                            row, at = decode_record(data, at)
                            rows.append(row)
                        yield _frame_of(rows, _RECORD)

    return frames.mapInPandas(unpack, RECORD_SCHEMA)


def read_records(index: DataFrame, keys: DataFrame) -> DataFrame:
    """The records of some keys, each by one read of its frame."""
    from pyarrow import fs

    places = index.join(keys.select("key").distinct(), "key", "left_semi")

    def look_up(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for (path, at, size), part in batch.groupby(["bundle", "frame_at", "frame_bytes"]):
                system, place = fs.FileSystem.from_uri(path)
                with system.open_input_file(place) as file:
                    data = _frame(file, int(at), int(size))
                rows = [decode_record(data, int(p))[0] for p in part["record_at"]]
                yield _frame_of(rows, _RECORD)

    return places.mapInPandas(look_up, RECORD_SCHEMA)


def _sizes_of(file) -> list[tuple[int, int]]:
    end = file.size()
    file.seek(end - struct.calcsize(FOOTER))
    n = struct.unpack(FOOTER, file.read(struct.calcsize(FOOTER)))[0]
    size = struct.calcsize(FOOTER) + n * struct.calcsize(ENTRY)
    file.seek(end - size)
    return read_seek_table(file.read(size))


def _frame(file, at: int, size: int) -> bytes:
    file.seek(at)
    return zstandard.ZstdDecompressor().decompressobj().decompress(file.read(size))


def archive(records: DataFrame, folder: str | None = None) -> DataFrame:
    """Write records (key, target_uri, payload) as bundles; returns their index."""
    folder = folder or shared_folder(records.sparkSession, "warc")
    return write_bundles(with_roles(records), folder)
