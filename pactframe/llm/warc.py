"""WARC archives in seekable Zstandard bundles.

A bundle is a file of independent Zstandard frames, each holding one group of WARC records, and a last, skippable frame
with the seek table: compressed and plain size of every frame. Joined, the plain frames are an ordinary WARC file. A
record is found by bundle, frame, and offset and length inside the plain frame, so one frame is read to get it.

`write_bundles` writes the files into a shared folder and returns that index; `read_bundles` reads the files back, whole,
and `read_records` reads only the frames that hold wanted records. A task that runs again writes files of its own, and only
those of the attempt that succeeded are in the index: files left by a lost executor are never read.

Equal payloads of at least `MIN_REVISIT` bytes are stored once: the record with the largest id is the response, the
others are revisits that refer to it and carry the length and digest of the full payload.

Defined results: a null payload is an empty one; a null id is the smallest, and its record has no number in its name;
rows with the same payload and the same largest id are all responses; an empty table gives no files and an empty index;
columns beyond page_id, url and html are ignored; a null url is left out of the record.
"""

from __future__ import annotations

import base64
import hashlib
import struct
from collections.abc import Iterable, Iterator

import pyarrow as pa
import zstandard
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pactframe.llm.common import rows, stage, staged_path

MIN_REVISIT = 1000
#: A frame is closed at so many plain bytes, a bundle at so many plain bytes.
FRAME_BYTES, BUNDLE_BYTES = 256 << 10, 32 << 20
LEVEL = 3
# Fixed values of the seekable format and of WARC.
SKIPPABLE, SEEKABLE = 0x184D2A5E, 0x8F92EAB1
DATE = "1970-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

#: More tasks than this are not worth their start; each then reads several bundles.
MOST_TASKS = 100_000
INDEX = "page_id long, bundle string, frame int, offset long, length long"
RECORD = "page_id long, url string, record_type string, payload_bytes long, payload_digest string, refers_to long, payload binary"


def record_name(page_id: int | None) -> str:
    return "urn:page:" if page_id is None else f"urn:page:{page_id}"


def page_number(name: str | None) -> int | None:
    number = (name or "").rpartition(":")[2]
    return int(number) if number else None


def build_record(page_id: int | None, url: str | None, payload: bytes, digest: str, revisit: bool, refers_to: int | None) -> bytes:
    """One WARC record; a revisit has no block."""
    body = b"" if revisit else payload
    head = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: <{record_name(page_id)}>",
        f"WARC-Date: {DATE}",
        f"WARC-Payload-Digest: sha1:{base64.b32encode(bytes.fromhex(digest)).decode()}",
        f"X-Payload-Length: {len(payload)}",
    ]
    if url is not None:
        head.append(f"WARC-Target-URI: {' '.join(url.split())}")
    if revisit:
        head += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: <{record_name(refers_to)}>"]
    head += ["Content-Type: text/html; charset=utf-8", f"Content-Length: {len(body)}", "", ""]
    return "\r\n".join(head).encode("utf-8", "surrogatepass") + body + b"\r\n\r\n"


def parse_records(data: bytes) -> Iterator[tuple]:
    """Rows of `RECORD` from joined WARC records; the digest of a response is taken from its payload and compared."""
    at = 0
    while at < len(data):
        end = data.index(b"\r\n\r\n", at)
        lines = data[at:end].decode("utf-8", "surrogatepass").split("\r\n")
        field = dict(line.split(": ", 1) if ": " in line else (line.rstrip(":"), "") for line in lines[1:])
        start, size = end + 4, int(field["Content-Length"])
        payload = data[start : start + size]
        kind = field["WARC-Type"]
        digest = base64.b32decode(field["WARC-Payload-Digest"].removeprefix("sha1:")).hex()
        if kind == "response" and hashlib.sha1(payload).hexdigest() != digest:
            raise ValueError(f"damaged payload in record {field['WARC-Record-ID']}")
        length = size if kind == "response" else int(field["X-Payload-Length"])
        refers = page_number(field["WARC-Refers-To"].strip("<>")) if kind == "revisit" else None
        number = page_number(field["WARC-Record-ID"].strip("<>"))
        yield number, field.get("WARC-Target-URI"), kind, length, digest, refers, payload if kind == "response" else None
        at = start + size + 4


class Bundle:
    """A bundle under construction in memory, of bounded size."""

    def __init__(self, level: int = LEVEL):
        self.packer = zstandard.ZstdCompressor(level=level, write_checksum=True)
        self.frames: list[tuple[int, int]] = []
        self.body: list[bytes] = []
        self.open: list[bytes] = []
        self.open_bytes = self.plain_bytes = 0

    def add(self, record: bytes) -> tuple[int, int, int]:
        """Frame, offset in it and length of the record."""
        if self.open and self.open_bytes + len(record) > FRAME_BYTES:
            self.close_frame()
        spot = len(self.frames), self.open_bytes, len(record)
        self.open.append(record)
        self.open_bytes += len(record)
        self.plain_bytes += len(record)
        return spot

    def close_frame(self) -> None:
        packed = self.packer.compress(b"".join(self.open))
        self.body.append(packed)
        self.frames.append((len(packed), self.open_bytes))
        self.open, self.open_bytes = [], 0

    def finish(self) -> bytes:
        if self.open:
            self.close_frame()
        table = b"".join(struct.pack("<II", *f) for f in self.frames)
        table += struct.pack("<IBI", len(self.frames), 0, SEEKABLE)
        return b"".join(self.body) + struct.pack("<II", SKIPPABLE, len(table)) + table


def seek_table(file: pa.NativeFile) -> list[tuple[int, int, int]]:
    """Start, compressed and plain size of each frame, from the footer."""
    size = file.size()
    file.seek(size - 9)
    n, _, magic = struct.unpack("<IBI", file.read(9))
    if magic != SEEKABLE:
        raise ValueError("no seek table")
    file.seek(size - 9 - 8 * n)
    pairs = list(struct.iter_unpack("<II", file.read(8 * n)))
    starts = [0]
    for packed, _ in pairs:
        starts.append(starts[-1] + packed)
    return [(s, *p) for s, p in zip(starts, pairs, strict=False)]


def read_frames(folder: str, name: str, wanted: Iterable[int] | None = None) -> Iterator[tuple[int, bytes]]:
    """Plain frames of a bundle, or only the wanted ones: (number, bytes)."""
    store, root = fs.FileSystem.from_uri(folder)
    with store.open_input_file(f"{root}/{name}") as file:
        table = seek_table(file)
        for k in range(len(table)) if wanted is None else sorted(set(wanted)):
            start, packed, plain = table[k]
            file.seek(start)
            yield k, zstandard.ZstdDecompressor().decompress(file.read(packed), max_output_size=plain)


def as_uri(folder: str) -> str:
    return folder if "://" in folder else folder.replace("file:", "file://", 1) if folder.startswith("file:") else f"file://{folder}"


def with_revisits(pages: DataFrame, min_bytes: int = MIN_REVISIT) -> DataFrame:
    """page_id, url, html, digest, refers_to (null for responses): the largest id of each digest is found on narrow rows."""
    own = pages.select(F.col("page_id").cast("long"), "url", F.coalesce("html", F.lit("")).alias("html"))
    own = own.withColumn("digest", F.sha1(F.col("html").cast("binary")))
    groups = own.filter(F.octet_length("html") >= min_bytes).groupBy("digest").agg(
        F.max("page_id").alias("last_id"), F.count(F.lit(1)).alias("n")
    )
    repeated = stage(groups.filter("n > 1").select("digest", "last_id"), "warc-repeated")
    joined = own.join(repeated, "digest", "left")
    refers = F.when(F.col("last_id").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("last_id")), F.col("last_id"))
    return joined.select("page_id", "url", "html", "digest", refers.alias("refers_to"))


def write_bundles(pages: DataFrame, folder: str, min_bytes: int = MIN_REVISIT, bundle_bytes: int = BUNDLE_BYTES) -> DataFrame:
    """Write all pages as bundles into a shared folder; returns the index (page_id, bundle, frame, offset, length)."""
    uri = as_uri(folder)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = fs.FileSystem.from_uri(uri)
        store.create_dir(root, recursive=True)
        task, number, spots = TaskContext.get(), 0, []
        bundle = Bundle()

        def flush() -> pa.RecordBatch:
            name = f"part-{task.partitionId():07d}-{task.taskAttemptId()}-{number:05d}.warc.zst"
            with store.open_output_stream(f"{root}/{name}", compression=None) as out:
                out.write(bundle.finish())
            ids, frames, offsets, lengths = zip(*spots, strict=True)
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64())
            ids, frames, offsets, lengths = (pa.array(c, k) for c, k in zip((ids, frames, offsets, lengths), kinds, strict=True))
            names = pa.array([name] * len(ids), pa.string())
            return pa.RecordBatch.from_arrays([ids, names, frames, offsets, lengths], ["page_id", "bundle", "frame", "offset", "length"])

        for batch in rows(batches):
            for page_id, url, html, digest, refers_to in zip(*(batch.column(k).to_pylist() for k in range(5)), strict=True):
                payload = html.encode("utf-8", "surrogatepass")
                record = build_record(page_id, url, payload, digest, refers_to is not None, refers_to)
                spots.append((page_id, *bundle.add(record)))
                if bundle.plain_bytes >= bundle_bytes:
                    yield flush()
                    bundle, spots, number = Bundle(), [], number + 1
        if spots:
            yield flush()

    return stage(with_revisits(pages, min_bytes).mapInArrow(write, INDEX), "warc-index")


def to_batch(found: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.binary())
    names = [x.split()[0] for x in RECORD.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*found, strict=True), kinds, strict=True)], names)


def dealt_bundles(rows: DataFrame, index: DataFrame, *keys: str) -> DataFrame:
    """Rows dealt by `keys` to as many tasks as the index has bundles: names are few bytes, what they name is not, so that
    the number of tasks must not follow the size of these rows."""
    n = index.select("bundle").distinct().count()
    return rows.repartition(max(1, min(n, MOST_TASKS)), *keys)


def read_bundles(index: DataFrame, folder: str) -> DataFrame:
    """Every record of every bundle named in the index: about a task per bundle, one frame in memory at a time."""
    uri = as_uri(folder)
    bundles = index.select("bundle").distinct()

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name in batch.column(0).to_pylist():
                for _, data in read_frames(uri, name):
                    if found := list(parse_records(data)):
                        yield to_batch(found)

    return dealt_bundles(bundles, index, "bundle").mapInArrow(read, RECORD)


def read_records(index: DataFrame, folder: str) -> DataFrame:
    """Only the records in the (filtered) index; of each bundle only the frames that hold one of them."""
    uri = as_uri(folder)
    frames = index.groupBy("bundle", "frame").agg(F.sort_array(F.collect_list(F.struct("offset", "length"))).alias("spots"))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, frame, spots in zip(*(batch.column(k).to_pylist() for k in range(3)), strict=True):
                for _, data in read_frames(uri, name, [frame]):
                    cut = b"".join(data[s["offset"] : s["offset"] + s["length"]] for s in spots)
                    yield to_batch(list(parse_records(cut)))

    return dealt_bundles(frames, index, "bundle", "frame").mapInArrow(read, RECORD)


def archive_round_trip(spark: SparkSession, pages: DataFrame) -> DataFrame:
    """Write all pages below the shared folder, read the archives back: page_id, lengths, digests, types, references."""
    folder = staged_path(spark, "warc")
    index = write_bundles(pages, folder)
    return read_bundles(index, folder).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


WARC_SQL = """
WITH p AS (SELECT page_id, octet_length(encode(coalesce(html, ''))) AS n, sha1(coalesce(html, '')) AS digest FROM pages),
g AS (SELECT *, max(page_id) OVER (PARTITION BY digest) AS last_id FROM p)
SELECT page_id, n::BIGINT AS payload_bytes, digest AS payload_digest,
       CASE WHEN n >= 1000 AND page_id IS DISTINCT FROM last_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN n >= 1000 AND page_id IS DISTINCT FROM last_id THEN last_id END AS refers_to
FROM g
"""
