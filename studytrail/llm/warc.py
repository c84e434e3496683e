"""WARC archives of dictionary-compressed records.

An archive begins with a skippable frame that holds a Zstandard dictionary trained from its
own first records; then every record is one frame compressed with it, so single records can
be read and readers need nothing but the archive. Records are WARC/1.1: the first of equal
payloads is a ``response``, the others are ``revisit`` records that name it.
"""

from __future__ import annotations

import hashlib
import struct
import uuid
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from studytrail.llm.common import kept, open_new, scratch, whole

# Fixed numbers and names of the formats.
DICTIONARY_FRAME, FRAME = 0x184D2A5D, 0xFD2FB528
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
# Payloads below this many bytes are stored again rather than referred to.
REVISIT_BYTES = 100
DICTIONARY_BYTES = 32 << 10
# Payload bytes an archive's dictionary is trained from: its first records.
SAMPLE_BYTES = 2 << 20
ARCHIVE_BYTES = 64 << 20
LEVEL = 3
DATE = "2020-01-01T00:00:00Z"


@dataclass
class Record:
    """One record: headers (names as written) and the content block."""

    headers: dict[str, str]
    block: bytes = b""

    def to_bytes(self) -> bytes:
        lines = [f"{name}: {_one_line(value)}" for name, value in self.headers.items()]
        head = "\r\n".join(["WARC/1.1", *lines, f"Content-Length: {len(self.block)}", "", ""])
        return head.encode("utf-8", "surrogatepass") + self.block + b"\r\n\r\n"

    @classmethod
    def from_bytes(cls, data: bytes) -> Record:
        head, _, rest = data.partition(b"\r\n\r\n")
        version, *lines = head.decode("utf-8", "surrogatepass").split("\r\n")
        if not version.startswith("WARC/"):
            raise ValueError("not a WARC record")
        headers = dict(line.split(": ", 1) for line in lines)
        size = int(headers.pop("Content-Length"))
        if rest[size:] != b"\r\n\r\n":
            raise ValueError("record is cut")
        return cls(headers, rest[:size])

    def payload(self) -> tuple[dict[str, str], bytes]:
        """HTTP headers of the block and what follows them."""
        head, _, body = self.block.partition(b"\r\n\r\n")
        return dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:]), body


def _one_line(value: str) -> str:
    """Header values hold no line ends; a URL's are percent-encoded."""
    return value.replace("\r", "%0D").replace("\n", "%0A")


def _name(page_id: int | None) -> str:
    return f"<urn:page:{page_id}>" if page_id is not None else f"<urn:uuid:{uuid.uuid4()}>"


def record_of(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None) -> Record:
    """The record of a page: its payload, or a reference to the page that holds it."""
    headers = {
        "WARC-Type": "response" if refers_to is None else "revisit",
        "WARC-Record-ID": _name(page_id),
        "WARC-Target-URI": url or "",
        "WARC-Date": DATE,
        "WARC-Payload-Digest": f"sha256:{digest}",
        "Content-Type": "application/http; msgtype=response",
    }
    if refers_to is not None:
        headers |= {"WARC-Profile": PROFILE, "WARC-Refers-To": _name(refers_to)}
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n"
    return Record(headers, http.encode() + (payload if refers_to is None else b""))


def train(samples: list[bytes], size: int = DICTIONARY_BYTES) -> zstandard.ZstdCompressionDict | None:
    """A dictionary from records; None where they are too few or too short to train one."""
    if len(samples) < 8 or sum(map(len, samples)) < 4 * 1024:
        return None
    try:
        return zstandard.train_dictionary(min(size, sum(map(len, samples)) // 8), samples, k=256, d=8)
    except zstandard.ZstdError:
        return None


@dataclass
class ArchiveWriter:
    """One archive, written in one pass; the first ``sample_bytes`` wait for the dictionary."""

    stream: object
    sample_bytes: int = SAMPLE_BYTES
    waiting: list[bytes] = field(default_factory=list)
    waiting_bytes: int = 0
    compressor: zstandard.ZstdCompressor | None = None
    n_records: int = 0
    n_bytes: int = 0

    def add(self, record: Record) -> None:
        data = record.to_bytes()
        self.n_records += 1
        if self.compressor is not None:
            self._put(self.compressor.compress(data))
            return
        self.waiting.append(data)
        self.waiting_bytes += len(data)
        if self.waiting_bytes >= self.sample_bytes:
            self._begin()

    def _put(self, data: bytes) -> None:
        self.stream.write(data)
        self.n_bytes += len(data)

    def _begin(self) -> None:
        dictionary = train([d[: 64 << 10] for d in self.waiting])
        if dictionary is None:
            self.compressor = zstandard.ZstdCompressor(level=LEVEL)
        else:
            packed = zstandard.ZstdCompressor(level=19).compress(dictionary.as_bytes())
            self._put(struct.pack("<II", DICTIONARY_FRAME, len(packed)) + packed)
            dictionary.precompute_compress(level=LEVEL)
            self.compressor = zstandard.ZstdCompressor(level=LEVEL, dict_data=dictionary)
        for data in self.waiting:
            self._put(self.compressor.compress(data))
        self.waiting = []

    def close(self) -> None:
        if self.compressor is None:
            self._begin()
        self.stream.close()


def read_archive(data: bytes) -> Iterator[Record]:
    """The records of an archive's bytes, one frame at a time."""
    at, decompressor = 0, zstandard.ZstdDecompressor()
    view = memoryview(data)
    if len(data) >= 8 and struct.unpack_from("<I", data)[0] == DICTIONARY_FRAME:
        size = struct.unpack_from("<I", data, 4)[0]
        packed = data[8 : 8 + size]
        # The frame may hold the dictionary as it is or compressed.
        raw = decompressor.decompress(packed) if packed[:4] == struct.pack("<I", FRAME) else packed
        decompressor = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(raw))
        at = 8 + size
    while at < len(data):
        frame, parts = decompressor.decompressobj(), []
        # Feed until the frame ends; what is left over belongs to the next one.
        while not frame.eof:
            if at >= len(data):
                raise ValueError("archive is cut")
            parts.append(frame.decompress(view[at : at + (1 << 14)]))
            at += 1 << 14
        at = min(at, len(data)) - len(frame.unused_data)
        yield Record.from_bytes(b"".join(parts))


MANIFEST = "path string, n_records long, n_bytes long"


def with_originals(pages: DataFrame, least: int = REVISIT_BYTES) -> DataFrame:
    """(page_id, url, html, digest, refers_to): the page that holds an equal payload, null for
    the page itself, for short payloads and for payloads that occur once."""
    rows = pages.select(F.col("page_id").cast("bigint").alias("page_id"), "url", whole("html").alias("html"))
    rows = rows.withColumn("digest", F.sha2("html", 256))
    long = rows.filter(F.octet_length("html") >= least)
    copies = long.groupBy(F.col("digest").alias("__digest")).agg(
        F.min("page_id").alias("__first"), F.count(F.lit(1)).alias("__n")
    ).filter("__n > 1").drop("__n")
    joined = rows.join(copies, rows["digest"] == copies["__digest"], "left")
    other = F.coalesce(F.col("__first") != F.col("page_id"), F.col("__first").isNotNull())
    return joined.select("page_id", "url", "html", "digest", F.when(other, F.col("__first")).alias("refers_to"))


def write_archives(
    pages: DataFrame, folder: str, archive_bytes: int = ARCHIVE_BYTES, sample_bytes: int = SAMPLE_BYTES
) -> DataFrame:
    """Write a record per row of ``pages`` under ``folder``; returns the manifest of archives.

    Every attempt of a task writes names of its own, and the manifest names those of the
    attempts that counted."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        writer, path = None, ""

        def closed() -> pa.RecordBatch:
            writer.close()
            columns = [pa.array([path]), pa.array([writer.n_records], pa.int64()), pa.array([writer.n_bytes], pa.int64())]
            return pa.RecordBatch.from_arrays(columns, names=["path", "n_records", "n_bytes"])

        for batch in batches:
            for page_id, url, html, digest, refers_to in zip(*batch.columns):
                if writer is None:
                    path = f"{folder}/pages-{uuid.uuid4().hex}.warc.zst"
                    writer = ArchiveWriter(open_new(path), sample_bytes)
                payload = html.as_py().encode("utf-8", "surrogatepass")
                writer.add(record_of(page_id.as_py(), url.as_py(), payload, digest.as_py(), refers_to.as_py()))
                if writer.n_bytes >= archive_bytes:
                    yield closed()
                    writer = None
        if writer is not None:
            yield closed()

    return with_originals(pages).mapInArrow(write, MANIFEST)


RECORD_SCHEMA = (
    "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, payload binary"
)


def read_archives(manifest: DataFrame) -> DataFrame:
    """The records of the manifest's archives; ``payload`` is null for revisits."""
    spark = manifest.sparkSession
    some = manifest.select(F.regexp_extract("path", r"^(.*)/[^/]+$", 1).alias("f")).limit(1).collect()
    if not some:
        return spark.createDataFrame([], RECORD_SCHEMA)
    names = manifest.select(F.regexp_extract("path", r"[^/]+$", 0).alias("name"))
    if manifest.count() <= 100_000:
        names = F.broadcast(names)
    files = spark.read.format("binaryFile").load(some[0]["f"])
    counted = files.select(F.regexp_extract("path", r"[^/]+$", 0).alias("name"), "content").join(names, "name", "left_semi")

    def number(name: str | None) -> int | None:
        return int(name[10:-1]) if name and name.startswith("<urn:page:") else None

    def rows(record: Record) -> tuple:
        http, body = record.payload()
        headers = record.headers
        kind, digest = headers["WARC-Type"], headers["WARC-Payload-Digest"].removeprefix("sha256:")
        if kind == "response" and hashlib.sha256(body).hexdigest() != digest:
            raise ValueError(f"payload digest of {headers['WARC-Record-ID']} differs")
        return (
            number(headers["WARC-Record-ID"]), headers["WARC-Target-URI"], int(http["Content-Length"]),
            digest, kind, number(headers.get("WARC-Refers-To")),
            body if kind == "response" else None,
        )

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary()]
        names = ["page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to", "payload"]

        def packed(found: list[tuple]) -> pa.RecordBatch:
            columns = list(zip(*found)) or [[]] * len(names)
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=names)

        for batch in batches:
            for data in batch.column(0):
                found, size = [], 0
                for record in read_archive(data.as_py()):
                    found.append(rows(record))
                    size += len(record.block)
                    if size > 16 << 20:
                        yield packed(found)
                        found, size = [], 0
                yield packed(found)

    return counted.select("content").mapInArrow(read, RECORD_SCHEMA)


def archived(pages: DataFrame, folder: str | None = None, **sizes: int) -> DataFrame:
    """Write all pages to archives and read these back: a row per input row with page_id, url,
    payload_bytes, payload_digest, record_type, refers_to, payload.

    Of equal payloads of 100 bytes or more the page with the smallest page_id is the response
    and the others revisit it; shorter ones are all responses. A null html is an empty payload
    and a null url an empty one. A page without page_id is read back without one; if a
    payload is known from such pages only, all of them are responses. Rows that repeat the
    smallest page_id are each a response. An empty table gives no rows. Other columns are not
    read."""
    folder = folder or scratch(pages.sparkSession, "archives")
    return read_archives(kept(write_archives(pages, folder, **sizes), "archives-manifest"))
