"""Token ids as independent Zstandard frames with a trailing seek table.

A file holds documents in ascending doc_id order: their ids as little-endian uint32, cut into
frames of whole documents (a longer document has a frame of its own). Each frame is complete
in itself, so a reader decompresses only the frames of the documents it wants. The file ends
with two skippable frames: an index of documents (doc_id, number of ids), and the seek table
of the public seekable format, with an xxHash checksum of every frame's content.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from studytrail.llm.common import kept, open_new, scratch
from studytrail.llm.tokens import END_ID, encoder

# Fixed numbers of the format: skippable frames, seek table footer.
SKIPPABLE, SEEK_FRAME, SEEK_MAGIC = 0x184D2A50, 0x184D2A5E, 0x8F92EAB1
CHECKSUMS = 0x80
FRAME_IDS = 1 << 16
FILE_IDS = 1 << 23
LEVEL = 1
# Files whose starts are sent to every task; beyond this they are joined by a shuffle.
SMALL = 100_000

MANIFEST = "path string, part int, number int, first_id long, n_docs long, n_ids long"


class FrameWriter:
    """One file, written in one pass."""

    def __init__(self, stream, frame_ids: int = FRAME_IDS):
        self.stream = stream
        self.frame_ids = frame_ids
        self.compressor = zstandard.ZstdCompressor(level=LEVEL, write_checksum=False)
        self.pending: list[bytes] = []
        self.pending_ids = 0
        self.entries: list[bytes] = []
        self.index: list[tuple[bool, int, int]] = []
        self.n_ids = 0

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        if self.pending and self.pending_ids + len(ids) > self.frame_ids:
            self._frame()
        self.pending.append(ids.tobytes())
        self.pending_ids += len(ids)
        self.n_ids += len(ids)
        self.index.append((doc_id is not None, doc_id or 0, len(ids)))

    def _frame(self) -> None:
        content = b"".join(self.pending)
        frame = self.compressor.compress(content)
        self.stream.write(frame)
        check = xxhash.xxh64_intdigest(content) & 0xFFFFFFFF
        self.entries.append(struct.pack("<III", len(frame), len(content), check))
        self.pending, self.pending_ids = [], 0

    def close(self) -> None:
        if self.pending:
            self._frame()
        index = zstandard.ZstdCompressor(level=LEVEL).compress(b"".join(struct.pack("<?qq", *row) for row in self.index))
        # The index is one more frame to a reader that knows the seek table alone.
        self.stream.write(struct.pack("<II", SKIPPABLE, len(index)) + index)
        self.entries.append(struct.pack("<III", len(index) + 8, 0, xxhash.xxh64_intdigest(b"") & 0xFFFFFFFF))
        body = b"".join(self.entries) + struct.pack("<IBI", len(self.entries), CHECKSUMS, SEEK_MAGIC)
        self.stream.write(struct.pack("<II", SEEK_FRAME, len(body)) + body)
        self.stream.close()


@dataclass
class FrameReader:
    """Documents of a file's bytes, frame by frame."""

    data: bytes

    def __post_init__(self) -> None:
        count, flags, magic = struct.unpack("<IBI", self.data[-9:])
        if magic != SEEK_MAGIC or flags != CHECKSUMS:
            raise ValueError("no seek table with checksums")
        table = self.data[-9 - 12 * count : -9]
        if struct.unpack("<II", self.data[-17 - 12 * count : -9 - 12 * count]) != (SEEK_FRAME, 12 * count + 9):
            raise ValueError("broken seek table")
        entries = np.frombuffer(table, "<u4").reshape(-1, 3)
        self.sizes = entries[:, 1].astype(np.int64)
        self.checks = entries[:, 2]
        self.offsets = np.concatenate([[0], np.cumsum(entries[:, 0].astype(np.int64))])
        at, end = int(self.offsets[-2]), int(self.offsets[-1])
        raw = zstandard.ZstdDecompressor().decompress(self.data[at + 8 : end])
        self.index = np.frombuffer(raw, np.dtype([("named", "?"), ("doc_id", "<i8"), ("n", "<i8")]))
        self.ends = np.cumsum(self.index["n"])
        self.frame_ends = np.cumsum(self.sizes) // 4
        self.held: tuple[int, np.ndarray] = (-1, np.empty(0, "<u4"))

    def frame(self, number: int) -> np.ndarray:
        if self.held[0] != number:
            part = self.data[self.offsets[number] : self.offsets[number + 1]]
            content = zstandard.ZstdDecompressor().decompress(part, max_output_size=int(self.sizes[number]))
            if xxhash.xxh64_intdigest(content) & 0xFFFFFFFF != self.checks[number]:
                raise ValueError(f"checksum of frame {number} differs")
            self.held = (number, np.frombuffer(content, "<u4"))
        return self.held[1]

    def __len__(self) -> int:
        return len(self.index)

    def document(self, place: int) -> tuple[int | None, np.ndarray]:
        """doc_id and ids of the document at a place; only its frame is decompressed."""
        row, end = self.index[place], int(self.ends[place])
        start = end - int(row["n"])
        number = int(np.searchsorted(self.frame_ends, start, "right"))
        before = int(self.frame_ends[number - 1]) if number else 0
        ids = self.frame(number)[start - before : end - before]
        return (int(row["doc_id"]) if row["named"] else None), ids

    def documents(self) -> Iterator[tuple[int | None, np.ndarray]]:
        """All documents in order, frame by frame."""
        place, at = 0, 0
        sizes = self.index["n"].tolist()
        named, ids = self.index["named"].tolist(), self.index["doc_id"].tolist()
        for number, end in enumerate(self.frame_ends.tolist()):
            before, content = at, self.frame(number) if end > at else None
            while at < end:
                yield (ids[place] if named[place] else None), content[at - before : at - before + sizes[place]]
                at += sizes[place]
                place += 1

    def find(self, doc_id: int) -> list[np.ndarray]:
        """Ids of every document with this doc_id."""
        places = np.nonzero(self.index["named"] & (self.index["doc_id"] == doc_id))[0]
        return [self.document(int(p))[1] for p in places]


def write_tokens(
    docs: DataFrame, folder: str, vocabulary: str, end_id: int = END_ID, frame_ids: int = FRAME_IDS, file_ids: int = FILE_IDS
) -> DataFrame:
    """Write all documents under ``folder``; returns the manifest of files, in order of (part,
    number). Rows are dealt in ranges of doc_id (null first), so files follow each other.

    A file's name is new for every attempt of a task; files that no manifest row names are
    leftovers of lost attempts, and readers do not see them."""
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    dealt = rows.repartitionByRange("doc_id").sortWithinPartitions("doc_id", F.xxhash64("text"))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        known, part = encoder(vocabulary), TaskContext.get().partitionId()
        writer, path, first, number = None, "", None, 0

        def closed() -> pa.RecordBatch:
            writer.close()
            row = [[path], [part], [number], [first], [len(writer.index)], [writer.n_ids]]
            types = [pa.string(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
            names = ["path", "part", "number", "first_id", "n_docs", "n_ids"]
            return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(row, types)], names=names)

        for batch in batches:
            for doc_id, ids in zip(batch.column(0).to_pylist(), known.encode(batch.column(1))):
                ids = np.append(ids, np.uint32(end_id)).astype("<u4")
                if writer is not None and writer.n_ids + len(ids) > file_ids:
                    yield closed()
                    writer, number = None, number + 1
                if writer is None:
                    path = f"{folder}/tokens-{part:05d}-{number:05d}-{uuid.uuid4().hex}.zst"
                    writer, first = FrameWriter(open_new(path), frame_ids), doc_id
                writer.add(doc_id, ids)
        if writer is not None:
            yield closed()

    return dealt.mapInArrow(write, MANIFEST)


def starts(manifest: DataFrame) -> DataFrame:
    """The manifest with ``start``: ids in all files before. It has a row per 8 million ids, so
    sums within parts and then over parts keep every window small."""
    inside = Window.partitionBy("part").orderBy("number").rowsBetween(Window.unboundedPreceding, -1)
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = manifest.groupBy("part").agg(F.sum("n_ids").alias("n")).select(
        "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before")
    )
    own = F.coalesce(F.sum("n_ids").over(inside), F.lit(0))
    return manifest.withColumn("own", own).join(parts, "part").withColumn("start", F.col("own") + F.col("before"))


def read_tokens(manifest: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, read from the files."""
    spark = manifest.sparkSession
    named = starts(manifest).select(F.regexp_extract("path", r"[^/]+$", 0).alias("name"), "start")
    folder = manifest.select(F.regexp_extract("path", r"^(.*)/[^/]+$", 1).alias("f")).limit(1).collect()
    schema = "doc_id long, start long, n_tokens long, ids_crc32 long"
    if not folder:
        return spark.createDataFrame([], schema)
    files = spark.read.format("binaryFile").load(folder[0]["f"])
    if manifest.count() <= SMALL:
        named = F.broadcast(named)
    contents = files.select(F.regexp_extract("path", r"[^/]+$", 0).alias("name"), "content").join(named, "name")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for data, start in zip(batch.column(0), batch.column(1).to_pylist()):
                reader = FrameReader(data.as_py())
                rows = []
                for doc_id, ids in reader.documents():
                    rows.append((doc_id, start, len(ids), zlib.crc32(ids)))
                    start += len(ids)
                columns = [pa.array(c, pa.int64()) for c in (zip(*rows) if rows else [[]] * 4)]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "start", "n_tokens", "ids_crc32"])

    return contents.select("content", "start").mapInArrow(read, schema)


def token_files(docs: DataFrame, vocabulary: str, folder: str | None = None, **sizes: int) -> DataFrame:
    """Write the ids of all documents and read them back: doc_id, start (ids of all documents
    before it), n_tokens (with the end id), ids_crc32.

    One row per input row. A null or empty text has the end id alone. Rows without doc_id come
    first; rows that repeat a doc_id follow each other in the order of their texts' hashes, and
    exact repeats are written each. An empty table gives no rows. Other columns are not read."""
    folder = folder or scratch(docs.sparkSession, "tokens")
    return read_tokens(kept(write_tokens(docs, folder, vocabulary, **sizes), "tokens-manifest"))
