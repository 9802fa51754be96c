"""WARC archives as seekable Zstandard bundles.

Each task writes one bundle: WARC/1.1 records grouped into independent Zstandard frames, and at
the end a skippable frame with the seek table (compressed and raw size of every frame), as the
public seekable format lays it down. Any Zstandard tool can read the bundle as a whole; with the
seek table one record costs one frame. The index maps a record identifier to its bundle, frame and
offset within the raw frame.

Equal payloads: their SHA-1 digests are grouped first (ids and digests only, with partial
aggregation, so thousands of copies never meet in one task). The smallest id becomes the response,
all others are revisit records that refer to it and carry no payload. Then the pages are shuffled
once, by id, and written.

Bundles lie in the shared folder; a bundle's name is new for every attempt and only attempts that
Spark accepts are in the index, so a lost executor leaves at most a file that nothing names.

Edge cases: a null html is an empty payload; empty payloads are equal to one another; a null
page_id comes after all others when the response is chosen; of rows that repeat an id and payload
the first is as above and the others revisit it; an empty table gives no bundle and no rows; other
columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardgrid.llm.shared import make_folder, open_file, stored, work_path, write_file

# Fixed values of the seekable format and of WARC.
SKIPPABLE_MAGIC = 0x184D2A5E
SEEKABLE_MAGIC = 0x8F92EAB1
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "2000-01-01T00:00:00Z"  # pages have no date; one value keeps archives reproducible

FRAME_BYTES = 256 << 10
LEVEL = 3
URN = "urn:wardgrid:page:"
INDEX_SCHEMA = "record_id string, page_id long, bundle string, frame int, offset int, length int"


def digest_text(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode().rstrip("=")


def record_urn(page_id: int | None, digest: str, repeat: int = 0) -> str:
    return f"{URN}{'null' if page_id is None else page_id}:{digest}:{repeat}"


def urn_page(urn: str) -> int | None:
    text = urn.removeprefix("<").removeprefix(URN).split(":")[0]
    return None if text == "null" else int(text)


def _header_value(text: str) -> str:
    return " ".join((text or "").split())


def build_record(urn: str, url: str | None, payload: bytes, digest: str, refers_to: str | None) -> bytes:
    """A response record, or with refers_to a revisit record (HTTP header without the payload)."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if refers_to else http + payload
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if refers_to else 'response'}",
        f"WARC-Record-ID: <{urn}>",
        f"WARC-Date: {DATE}",
        f"WARC-Payload-Digest: sha1:{digest}",
    ]
    if _header_value(url):
        lines.append(f"WARC-Target-URI: {_header_value(url)}")
    if refers_to:
        lines += [f"WARC-Refers-To: <{refers_to}>", f"WARC-Profile: {REVISIT_PROFILE}"]
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse_records(raw: bytes, at: int = 0) -> Iterator[tuple[int, dict[str, str], bytes]]:
    """(offset, headers, block) of each record from `at` on."""
    while at < len(raw):
        end = raw.index(b"\r\n\r\n", at)
        version, *lines = raw[at:end].decode().split("\r\n")
        if not version.startswith("WARC/"):
            raise ValueError(f"no WARC record at {at}")
        headers = dict(line.split(": ", 1) for line in lines)
        start = end + 4
        stop = start + int(headers["Content-Length"])
        yield at, headers, raw[start:stop]
        at = stop + 4


def http_payload(block: bytes) -> tuple[int, bytes]:
    """(payload length as the HTTP header tells it, payload as far as it is in the block)."""
    head, _, payload = block.partition(b"\r\n\r\n")
    length = next(int(x.split(b":")[1]) for x in head.split(b"\r\n") if x.lower().startswith(b"content-length"))
    return length, payload


class BundleWriter:
    """Collects records into frames and writes them with the seek table."""

    def __init__(self, uri: str, frame_bytes: int = FRAME_BYTES) -> None:
        from wardgrid.llm.shared import file_system

        store, path = file_system(uri)
        self.out, self.frame_bytes = store.open_output_stream(path, compression=None), frame_bytes
        self.sizes: list[tuple[int, int]] = []
        self.parts: list[bytes] = []
        self.raw = 0

    def add(self, record: bytes) -> tuple[int, int]:
        """(frame, offset in the raw frame) of the record."""
        if self.raw >= self.frame_bytes:
            self._flush()
        place = len(self.sizes), self.raw
        self.parts.append(record)
        self.raw += len(record)
        return place

    def _flush(self) -> None:
        packed = zstandard.ZstdCompressor(level=LEVEL, write_content_size=True).compress(b"".join(self.parts))
        self.out.write(packed)
        self.sizes.append((len(packed), self.raw))
        self.parts, self.raw = [], 0

    def close(self) -> None:
        if self.parts:
            self._flush()
        table = b"".join(struct.pack("<II", *size) for size in self.sizes)
        body = table + struct.pack("<IBI", len(self.sizes), 0, SEEKABLE_MAGIC)
        self.out.write(struct.pack("<II", SKIPPABLE_MAGIC, len(body)) + body)
        self.out.close()


def seek_table(source) -> list[tuple[int, int, int]]:
    """(file offset, compressed size, raw size) of each frame of an open bundle."""
    source.seek(source.size() - 9)
    frames, _, magic = struct.unpack("<IBI", source.read(9))
    if magic != SEEKABLE_MAGIC:
        raise ValueError("no seek table")
    source.seek(source.size() - 9 - 8 * frames)
    sizes = struct.unpack(f"<{2 * frames}I", source.read(8 * frames))
    out, at = [], 0
    for packed, raw in zip(sizes[::2], sizes[1::2], strict=True):
        out.append((at, packed, raw))
        at += packed
    return out


def read_frame(source, frame: tuple[int, int, int]) -> bytes:
    at, packed, raw = frame
    source.seek(at)
    return zstandard.ZstdDecompressor().decompress(source.read(packed), max_output_size=max(1, raw))


def read_record(bundle: str, frame: int, offset: int) -> tuple[dict[str, str], bytes]:
    """(headers, block) of one record, as the index names it: reads one frame."""
    with open_file(bundle) as source:
        raw = read_frame(source, seek_table(source)[frame])
    _, headers, block = next(parse_records(raw, offset))
    return headers, block


def _writer(folder: str, frame_bytes: int):
    """Rows of one id and payload come together; the row that tells where the response is comes first."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        writer, bundle, key, copy_of, repeat = None, "", None, None, 0
        for batch in batches:
            rows = []
            columns = [batch.column(c) for c in ("page_id", "sha1", "kind", "copy_of", "url", "payload")]
            for i in range(len(batch)):
                page_id, sha1, kind, other, url, payload = (c[i].as_py() for c in columns)
                if (page_id, sha1) != key:
                    key, repeat, copy_of = (page_id, sha1), 0, None
                if kind == 0:
                    copy_of = (other,)
                    continue
                if writer is None:
                    bundle = f"{folder}/{uuid.uuid4().hex}.warc.zst"
                    writer = BundleWriter(bundle, frame_bytes)
                digest = digest_text(payload)
                urn = record_urn(page_id, digest, repeat)
                revisits = copy_of and (copy_of[0] != page_id or repeat)
                refers = record_urn(copy_of[0], digest) if revisits else None
                record = build_record(urn, url, payload, digest, refers)
                rows.append((urn, page_id, bundle, *writer.add(record), len(record)))
                repeat += 1
            names = ["record_id", "page_id", "bundle", "frame", "offset", "length"]
            kinds = [pa.string(), pa.int64(), pa.string(), pa.int32(), pa.int32(), pa.int32()]
            found = list(zip(*rows, strict=True)) or [[] for _ in names]
            yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(found, kinds, strict=True)], names=names)
        if writer:
            writer.close()

    return write


def write_archives(
    spark: SparkSession, pages: DataFrame, folder: str | None = None, min_bytes: int = 0, frame_bytes: int = FRAME_BYTES
) -> DataFrame:
    """Writes pages (page_id, url, html) as bundles below folder; returns the stored index.

    Payloads shorter than min_bytes are never stored as revisits.
    """
    folder = folder or work_path(spark, "warc")
    make_folder(folder)
    records = pages.select("page_id", "url", F.coalesce(F.col("html"), F.lit("")).cast("binary").alias("payload"))
    records = records.withColumn("sha1", F.sha1("payload"))
    digests = records.filter(F.length("payload") >= min_bytes).select("page_id", "sha1")
    first = digests.groupBy("sha1").agg(F.min("page_id").alias("copy_of"), F.count("*").alias("rows")).filter("rows > 1")
    copies = digests.distinct().join(first, "sha1").select("page_id", "sha1", F.lit(0).alias("kind"), "copy_of")
    marked = records.withColumn("kind", F.lit(1)).unionByName(copies, allowMissingColumns=True)
    written = (
        marked.repartition("page_id", "sha1")
        .sortWithinPartitions("page_id", "sha1", "kind")
        .mapInArrow(_writer(folder, frame_bytes), INDEX_SCHEMA)
    )
    return stored(spark, written, "warc-index")


def _read_bundles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for bundle in batch.column("bundle").to_pylist():
            with open_file(bundle) as source:
                for number, frame in enumerate(seek_table(source)):
                    rows = []
                    for offset, headers, block in parse_records(read_frame(source, frame)):
                        length, payload = http_payload(block)
                        kind, digest = headers["WARC-Type"], headers["WARC-Payload-Digest"].removeprefix("sha1:")
                        refers = headers.get("WARC-Refers-To")
                        if kind == "response":
                            if len(payload) != length or digest_text(payload) != digest:
                                raise ValueError(f"damaged record in {bundle}, frame {number}, offset {offset}")
                        rows.append(
                            (
                                urn_page(headers["WARC-Record-ID"]),
                                headers.get("WARC-Target-URI"),
                                length,
                                digest,
                                kind,
                                urn_page(refers) if refers else None,
                            )
                        )
                    kinds = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64()]
                    names = ["page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to"]
                    found = zip(*rows, strict=True)
                    yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(found, kinds, strict=True)], names=names)


def read_archives(index: DataFrame) -> DataFrame:
    """page_id, url, payload_bytes, payload_digest, record_type, refers_to, read from the bundles.

    Every response's payload is checked against its digest; a damaged record fails the read.
    """
    bundles = index.select("bundle").distinct()
    # One bundle a task; a plain count keeps Spark from merging tasks whose rows look small.
    bundles = bundles.repartition(max(1, bundles.count()))
    return bundles.mapInArrow(
        _read_bundles,
        "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long",
    )


def archive_pages(spark: SparkSession, pages: DataFrame, **parameters) -> DataFrame:
    """Writes the archives and reads them back."""
    index = write_archives(spark, pages, **parameters)
    return read_archives(index).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


#: Checks op1 in DuckDB; base 32 takes five hexadecimal digits as four letters.
ARCHIVE_SQL = """
WITH hashed AS (
  SELECT page_id, CAST(strlen(COALESCE(html, '')) AS BIGINT) AS payload_bytes, sha1(COALESCE(html, '')) AS h FROM pages
), marked AS (
  SELECT *, MIN(page_id) OVER (PARTITION BY h) AS first_id FROM hashed
)
SELECT page_id, payload_bytes,
       array_to_string([substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
         1 + ((CAST('0x' || substr(h, 1 + 5 * CAST(i // 4 AS INT), 5) AS INT) >> CAST(15 - 5 * (i % 4) AS INT)) & 31), 1)
         FOR i IN range(32)], '') AS payload_digest,
       CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id = first_id THEN NULL ELSE first_id END AS refers_to
FROM marked
"""
