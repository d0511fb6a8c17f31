"""WARC archives in seekable Zstandard bundles: written, indexed, and read back by record.

Records are grouped into frames that decompress on their own. A bundle is a file of frames
that ends with the seek table of the Zstandard seekable format, a skippable frame, so any
Zstandard reader reads the bundle as one stream of records. The index maps a record's id to
its bundle, its frame, and its offset in the frame's content.

Records with equal payloads of at least ``min_revisit`` bytes are written once, as a response;
the others revisit it. A null payload counts as empty. Rows that repeat an id with different
payloads are records of their own.
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
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cataloom.storage import materialize, scratch_path

# Fixed values of the Zstandard seekable format.
SKIPPABLE_MAGIC, SEEKABLE_MAGIC = 0x184D2A5E, 0x8F92EAB1
# Fixed values of WARC 1.1.
VERSION = "WARC/1.1"
SAME_PAYLOAD = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

FRAME_BYTES, BUNDLE_BYTES = 256 << 10, 32 << 20
DATE = "1970-01-01T00:00:00Z"  # pages have no date of capture
FULL_LENGTH = "X-Full-Payload-Length"  # of a revisit, whose block has no payload


def record_uri(name: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, name)}>"


def digest_header(payload_sha1: bytes) -> str:
    return "sha1:" + base64.b32encode(payload_sha1).decode()


def _clean(value: str) -> str:
    return " ".join(value.split())


def record(
    id_: str, url: str | None, payload: bytes, sha1: bytes, refers_to: str | None
) -> bytes:
    """One WARC record; with ``refers_to`` a revisit without payload."""
    kind = "response" if refers_to is None else "revisit"
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n"
    block = http.encode() + (payload if refers_to is None else b"")
    lines = [
        VERSION,
        f"WARC-Type: {kind}",
        f"WARC-Record-ID: {record_uri(id_)}",
        f"WARC-Date: {DATE}",
        f"WARC-Target-URI: {_clean(url or '') or 'about:blank'}",
        f"WARC-Payload-Digest: {digest_header(sha1)}",
        "Content-Type: application/http; msgtype=response",
        f"X-Page-ID: {id_}",
    ]
    if refers_to is not None:
        lines += [
            f"WARC-Profile: {SAME_PAYLOAD}",
            f"WARC-Refers-To: {record_uri(refers_to)}",
            f"X-Refers-To-Page-ID: {refers_to}",
            f"{FULL_LENGTH}: {len(payload)}",
        ]
    lines.append(f"Content-Length: {len(block)}")
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse(content: bytes, at: int = 0) -> tuple[dict[str, str], bytes, int]:
    """Header fields (lower-case names), block, and where the next record starts."""
    end = content.index(b"\r\n\r\n", at)
    first, *lines = content[at:end].decode().split("\r\n")
    if not first.startswith("WARC/"):
        raise ValueError(f"no record at offset {at}")
    fields = {k.strip().lower(): v.strip() for k, v in (x.split(":", 1) for x in lines)}
    begin = end + 4
    size = int(fields["content-length"])
    return fields, content[begin : begin + size], begin + size + 4


def payload_of(block: bytes) -> bytes:
    return block[block.index(b"\r\n\r\n") + 4 :]


class Bundle:
    """Frames of one file in the making."""

    def __init__(self) -> None:
        self._compress = zstandard.ZstdCompressor(level=3, write_checksum=True)
        self.data, self._table, self._frame = bytearray(), [], bytearray()

    def add(self, content: bytes) -> tuple[int, int]:
        """Frame of the record and offset in the frame's content."""
        if self._frame and len(self._frame) + len(content) > FRAME_BYTES:
            self._close_frame()
        place = len(self._table), len(self._frame)
        self._frame += content
        return place

    def _close_frame(self) -> None:
        packed = self._compress.compress(bytes(self._frame))
        self._table.append((len(packed), len(self._frame)))
        self.data += packed
        self._frame.clear()

    def full(self) -> bool:
        return len(self.data) >= BUNDLE_BYTES

    def close(self) -> bytes:
        if self._frame:
            self._close_frame()
        table = b"".join(struct.pack("<II", *entry) for entry in self._table)
        footer = struct.pack("<IBI", len(self._table), 0, SEEKABLE_MAGIC)
        head = struct.pack("<II", SKIPPABLE_MAGIC, len(table) + len(footer))
        return bytes(self.data) + head + table + footer


class Reader:
    """Frames of a finished bundle by their number. Only the seek table and the frames asked
    for are read from the file, which must allow random access."""

    def __init__(self, file: pa.NativeFile):
        size = file.size()
        if size < 9:
            raise ValueError("no seek table")
        frames, flags, magic = struct.unpack("<IBI", file.read_at(9, size - 9))
        if magic != SEEKABLE_MAGIC:
            raise ValueError("no seek table")
        width = 12 if flags & 0x80 else 8
        table = file.read_at(frames * width, size - 9 - frames * width)
        self._file, self._spans, begin = file, [], 0
        for i in range(frames):
            packed, content = struct.unpack_from("<II", table, i * width)
            self._spans.append((begin, packed, content))
            begin += packed
        self._open = zstandard.ZstdDecompressor()

    def __len__(self) -> int:
        return len(self._spans)

    def frame(self, number: int) -> bytes:
        begin, packed, size = self._spans[number]
        part = self._file.read_at(packed, begin)
        return self._open.decompress(part, max_output_size=max(size, 1))


def with_originals(
    pages: DataFrame, id_col: str, url_col: str, payload_col: str, min_revisit: int
) -> DataFrame:
    """id, url, payload, sha1, and of which page the record is a revisit (null: a response).

    Of equal payloads the largest id is the response; a null id is not, unless all are null.
    """
    payload = F.coalesce(F.col(payload_col).cast("binary"), F.lit(b"").cast("binary"))
    rows = pages.select(
        F.col(id_col).alias("id"), F.col(url_col).cast("string").alias("url"), payload.alias("payload")
    ).withColumn("sha1", F.unhex(F.sha1("payload")))
    large = rows.where(F.octet_length("payload") >= min_revisit)
    kept = materialize(
        large.groupBy("sha1").agg(F.max("id").alias("kept"), F.count("*").alias("n")).where("n > 1"),
        "repeated-payloads",
    ).select("sha1", "kept")
    # A payload that a third of all pages have is the skewed side of a join of two shuffles,
    # which adaptive execution splits.
    return rows.join(kept, "sha1", "left").select(
        "id",
        "url",
        "payload",
        "sha1",
        F.when(F.col("kept").isNotNull() & ~F.col("id").eqNullSafe(F.col("kept")), F.col("kept")).alias(
            "refers_to"
        ),
    )


def write(
    pages: DataFrame,
    path: str,
    id_col: str = "page_id",
    url_col: str = "url",
    payload_col: str = "html",
    min_revisit: int = 1000,
) -> DataFrame:
    """Write bundles below ``path``, a folder all executors reach, and return the index: id,
    bundle (file name), frame, offset.

    Each task writes files of its own, first under another name, so that a repeated task leaves
    whole files only; the index names those of the task that counted.
    """
    rows = with_originals(pages, id_col, url_col, payload_col, min_revisit)
    index = T.StructType(
        [rows.schema["id"], *T.StructType.fromDDL("bundle string, frame int, offset bigint")]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        store, folder = fs.FileSystem.from_uri(path)
        stem = f"{context.partitionId():06d}-{context.attemptNumber()}-{uuid.uuid4().hex[:8]}"
        bundle, number, places, ids = Bundle(), 0, [], []

        def finish() -> pa.RecordBatch:
            name = f"{stem}-{number:04d}.warc.zst"
            with store.open_output_stream(f"{folder}/{name}.part") as out:
                out.write(bundle.close())
            store.move(f"{folder}/{name}.part", f"{folder}/{name}")
            frames, offsets = zip(*places, strict=True)
            return pa.RecordBatch.from_arrays(
                [
                    pa.concat_arrays(ids),
                    pa.array([name] * len(places), pa.string()),
                    pa.array(frames, pa.int32()),
                    pa.array(offsets, pa.int64()),
                ],
                names=index.names,
            )

        for batch in batches:
            for i in range(batch.num_rows):
                id_, url, payload, sha1, refers = (c[i].as_py() for c in batch.columns)
                if not places:
                    store.create_dir(folder, recursive=True)
                refers = None if refers is None else str(refers)
                places.append(bundle.add(record(str(id_), url, payload, sha1, refers)))
                ids.append(batch.column(0).slice(i, 1))
                if bundle.full():
                    yield finish()
                    bundle, number, places, ids = Bundle(), number + 1, [], []
        if places:
            yield finish()

    return materialize(rows.mapInArrow(run, index), "warc-index")


READ = (
    "page string, record_type string, target_uri string, refers_to string, "
    "payload_bytes bigint, payload_digest string, payload binary"
)


def read(path: str, index: DataFrame, payloads: bool = True) -> DataFrame:
    """Every indexed record out of the bundles below ``path``: id, type, URI, the page a revisit
    refers to, size and bare hexadecimal SHA-1 of the full payload, and the payload stored.

    A task opens the bundles that the index sends to it and reads each frame it needs once. There
    are as many tasks as bundles, which are of bounded size, however little of the index that is. A
    digest or id that is not the one announced is an error.
    """
    bundles = max(1, index.select("bundle").distinct().count())
    wanted = index.repartition(bundles, "bundle").groupBy("bundle").agg(
        F.collect_list(F.struct("frame", "offset", F.col("id").cast("string").alias("id"))).alias(
            "records"
        )
    )  # at most the records of one bundle
    schema = pa.schema(
        [
            *((n, pa.string()) for n in ("page", "record_type", "target_uri", "refers_to")),
            ("payload_bytes", pa.int64()),
            ("payload_digest", pa.string()),
            ("payload", pa.binary()),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, folder = fs.FileSystem.from_uri(path)
        for batch in batches:
            for name, records in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                with store.open_input_file(f"{folder}/{name}") as file:
                    yield from rows_of(Reader(file), records)

    def rows_of(reader: Reader, records: list[dict]) -> Iterator[pa.RecordBatch]:
        frame, content, rows = -1, b"", []
        for x in sorted(records, key=lambda x: (x["frame"], x["offset"])):
            if x["frame"] != frame:
                frame = x["frame"]
                content = reader.frame(frame)
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema)
                rows = []
            rows.append(_row(content, x["offset"], x["id"], payloads))
        yield pa.RecordBatch.from_pylist(rows, schema)

    return wanted.mapInArrow(run, READ)


def _row(content: bytes, offset: int, id_: str | None, payloads: bool) -> dict:
    fields, block, _ = parse(content, offset)
    payload = payload_of(block)
    announced = base64.b32decode(fields["warc-payload-digest"].removeprefix("sha1:")).hex()
    revisit = fields["warc-type"] == "revisit"
    if fields["x-page-id"] != str(id_):
        raise ValueError(f"the index has {id_} where the archive has {fields['x-page-id']}")
    if not revisit and hashlib.sha1(payload).hexdigest() != announced:
        raise ValueError(f"the payload of {id_} is not the one announced")
    return {
        "page": fields["x-page-id"],
        "record_type": fields["warc-type"],
        "target_uri": fields["warc-target-uri"],
        "refers_to": fields.get("x-refers-to-page-id"),
        "payload_bytes": int(fields[FULL_LENGTH.lower()]) if revisit else len(payload),
        "payload_digest": announced,
        "payload": payload if payloads else None,
    }


def archive(
    pages: DataFrame,
    path: str | None = None,
    id_col: str = "page_id",
    url_col: str = "url",
    payload_col: str = "html",
    min_revisit: int = 1000,
    payloads: bool = True,
) -> DataFrame:
    """Write all pages to bundles and read every record back. An empty table has no bundles."""
    spark = pages.sparkSession
    path = path or scratch_path(spark, "warc")
    index = write(pages, path, id_col, url_col, payload_col, min_revisit)
    if not index.head(1):
        return spark.createDataFrame([], T.StructType.fromDDL(READ))
    return read(path, index, payloads)
