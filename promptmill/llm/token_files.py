"""Token ids in binary files that give single documents back without reading the rest.

A file is a row of independent zstandard frames of little-endian unsigned 32-bit
ids. A document lies in one frame; small documents share frames. Behind them come
two skippable frames: the document index, then a seek table in the public
zstandard seekable layout with the sizes and a checksum of every frame. Any
zstandard tool decompresses the whole file; a reader that wants a few documents
reads the tail, then only their frames.
"""

from __future__ import annotations

import os
import struct
import uuid
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.fs
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from promptmill.llm.piece_table import PieceTable
from promptmill.llm.pieces import PieceEncoder
from promptmill.llm.shared import broadcast_file, ready, slices, worker_state
from promptmill.workspace import fresh_dir, materialize

# Fixed values of the zstandard frame and seekable formats.
SKIPPABLE_INDEX = 0x184D2A50
SKIPPABLE_SEEK_TABLE = 0x184D2A5E
SEEKABLE_MAGIC = 0x8F92EAB1
HAS_CHECKSUMS = 0x80

#: Bytes of ids after which a frame is closed.
FRAME_BYTES = 256 << 10
LEVEL = 3
#: Bytes of text encoded at once.
PART_BYTES = 4 << 20
MANIFEST = "shard int, file string, n_docs bigint, n_tokens bigint, n_frames bigint, first_id bigint, last_id bigint"


class TokenFileWriter:
    """Writes one file; documents come in the order they are to lie in. Keeps 21 bytes a document until closed."""

    def __init__(self, stream, frame_bytes: int = FRAME_BYTES):
        self.stream, self.frame_bytes = stream, frame_bytes
        self.compressor = zstandard.ZstdCompressor(level=LEVEL)
        self.pending: list[bytes] = []
        self.pending_bytes = 0
        self.seek: list[tuple[int, int, int]] = []
        self.ids: list[int | None] = []
        self.lengths: list[int] = []
        self.frames: list[int] = []

    def add(self, doc_id: int | None, ids: bytes) -> None:
        if self.pending and self.pending_bytes + len(ids) > self.frame_bytes:
            self._close_frame()
        self.ids.append(doc_id)
        self.lengths.append(len(ids) // 4)
        self.frames.append(len(self.seek))
        self.pending.append(ids)
        self.pending_bytes += len(ids)

    def _close_frame(self) -> None:
        plain = b"".join(self.pending)
        packed = self.compressor.compress(plain)
        self.stream.write(packed)
        self.seek.append((len(packed), len(plain), xxhash.xxh64_intdigest(plain) & 0xFFFFFFFF))
        self.pending, self.pending_bytes = [], 0

    def close(self) -> None:
        if self.pending:
            self._close_frame()
        count = len(self.ids)
        index = b"".join(
            (
                struct.pack("<Q", count),
                np.array([0 if i is None else i for i in self.ids], "<i8").tobytes(),
                np.array([i is None for i in self.ids], "u1").tobytes(),
                np.array(self.lengths, "<u8").tobytes(),
                np.array(self.frames, "<u4").tobytes(),
            )
        )
        self.stream.write(struct.pack("<II", SKIPPABLE_INDEX, len(index)) + index)
        entries = [*self.seek, (len(index) + 8, 0, xxhash.xxh64_intdigest(index) & 0xFFFFFFFF)]
        table = b"".join(struct.pack("<III", *entry) for entry in entries)
        footer = struct.pack("<IBI", len(entries), HAS_CHECKSUMS, SEEKABLE_MAGIC)
        self.stream.write(struct.pack("<II", SKIPPABLE_SEEK_TABLE, len(table) + len(footer)) + table + footer)


class TokenFileReader:
    """Reads the tail of a seekable stream, then any documents by decompressing their frames alone."""

    def __init__(self, stream, size: int):
        self.stream = stream
        footer = self._at(size - 9, 9)
        count, flags, magic = struct.unpack("<IBI", footer)
        if magic != SEEKABLE_MAGIC or not flags & HAS_CHECKSUMS:
            raise ValueError("no seek table with checksums at the end of the file")
        table = np.frombuffer(self._at(size - 9 - 12 * count, 12 * count), "<u4").reshape(count, 3).astype(np.int64)
        self.sizes, self.checksums = table[:, 1], table[:, 2]
        self.packed = table[:, 0]
        self.offsets = np.cumsum(self.packed) - self.packed
        index = self._at(int(self.offsets[-1]) + 8, int(self.packed[-1]) - 8)
        self._verify(index, count - 1)
        n = struct.unpack_from("<Q", index)[0]
        self.ids = np.frombuffer(index, "<i8", n, 8)
        self.null = np.frombuffer(index, "u1", n, 8 + 8 * n).astype(bool)
        self.lengths = np.frombuffer(index, "<u8", n, 8 + 9 * n).astype(np.int64)
        self.frames = np.frombuffer(index, "<u4", n, 8 + 17 * n).astype(np.int64)
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.decompressor = zstandard.ZstdDecompressor()

    def _at(self, offset: int, length: int) -> bytes:
        self.stream.seek(offset)
        data = self.stream.read(length)
        if len(data) != length:
            raise ValueError(f"{length} bytes wanted at {offset}, {len(data)} there")
        return data

    def _verify(self, plain: bytes, frame: int) -> None:
        if xxhash.xxh64_intdigest(plain) & 0xFFFFFFFF != self.checksums[frame]:
            raise ValueError(f"checksum of frame {frame} does not match")

    def documents(self, wanted: np.ndarray | None = None) -> Iterator[tuple[np.ndarray, list[bytes]]]:
        """(rows of the index, their id bytes), frame by frame; ``wanted`` is a mask over the index."""
        rows = np.arange(len(self.ids)) if wanted is None else np.flatnonzero(wanted)
        for part in np.split(rows, np.flatnonzero(np.diff(self.frames[rows])) + 1) if len(rows) else ():
            frame = int(self.frames[part[0]])
            packed = self._at(int(self.offsets[frame]), int(self.packed[frame]))
            plain = self.decompressor.decompress(packed, max_output_size=max(1, int(self.sizes[frame])))
            self._verify(plain, frame)
            base = self.starts[np.searchsorted(self.frames, frame)]
            begin = (self.starts[part] - base) * 4
            end = begin + self.lengths[part] * 4
            yield part, [plain[b:e] for b, e in zip(begin.tolist(), end.tolist())]


def write_token_files(
    docs: DataFrame, tokenizer: str, path: str, end_id: int | None = 0, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Encode whole texts and write their ids below ``path`` in ascending ``key`` order; returns the manifest.

    The manifest has one row per file (``shard`` numbers them in key order). A
    null text counts as empty and still gets ``end_id``. Null keys come first,
    rows of one key in the order of their texts' hashes and texts; repeated rows
    are written as often as they occur. Other columns are not read. An empty
    table gives an empty manifest and no file.

    Rows are range-partitioned by key and text hash, so that one key with many
    texts is spread; a task encodes and writes what it got, slice by slice. A
    file has a name of its own for every attempt and only the manifest, itself
    written to the shared folder, says which ones count: lost executors leave
    unnamed files behind and nothing else.
    """
    spark = ready(docs.sparkSession)
    held = broadcast_file(spark, tokenizer)
    ordered = (
        docs.select(F.col(key).cast("bigint").alias("key"), F.col(text).alias("text"))
        .repartitionByRange(F.col("key").asc_nulls_first(), F.xxhash64("text"))
        .sortWithinPartitions(F.col("key").asc_nulls_first(), F.xxhash64("text"), "text")
    )
    end = b"" if end_id is None else struct.pack("<I", end_id)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = _encoder(held)
        writer, first, last = None, None, None
        for batch in slices(batches, "text", PART_BYTES):
            keys = batch.column("key").to_pylist()
            if writer is None:
                shard = TaskContext.get().partitionId()
                name = f"{path}/tokens-{shard:06d}-{uuid.uuid4().hex}.zst"
                system, inner = pyarrow.fs.FileSystem.from_uri(name)
                system.create_dir(os.path.dirname(inner), recursive=True)
                stream = system.open_output_stream(inner, compression=None)
                writer = TokenFileWriter(stream)
            for doc_id, ids in zip(keys, encode(batch.column("text"))):
                writer.add(doc_id, ids + end)
                if doc_id is not None:
                    first, last = doc_id if first is None else first, doc_id
        if writer is not None:
            writer.close()
            stream.close()
            row = [shard, name, len(writer.ids), sum(writer.lengths), len(writer.seek), first, last]
            kinds = [pa.int32(), pa.string(), *[pa.int64()] * 5]
            yield pa.RecordBatch.from_arrays(
                [pa.array([value], kind) for value, kind in zip(row, kinds)],
                names=[field.split()[0] for field in MANIFEST.split(", ")],
            )

    return materialize(ordered.mapInArrow(run, MANIFEST), "token-files")


def _encoder(held) -> PieceTable:
    """One encoder per worker process and tokenizer file."""
    return worker_state(("ids", hash(held.value)), lambda: _table(held.value.decode()))


def _table(tokenizer_json: str) -> PieceTable:
    others = PieceEncoder(tokenizer_json, _to_bytes, b"".join, measure_runs=_bytes_of_runs)
    return PieceTable(tokenizer_json, others)


def _to_bytes(encoding) -> bytes:
    return np.array(encoding.ids, "<u4").tobytes()


def _bytes_of_runs(ids: np.ndarray, begins: list[int], ends: list[int]) -> list[bytes]:
    packed = ids.astype("<u4", copy=False).tobytes()
    return [packed[4 * b: 4 * e] for b, e in zip(begins, ends)]


def read_token_files(manifest: DataFrame, doc_ids: Sequence[int] | None = None) -> DataFrame:
    """doc_id, start (ids of all documents before it) and ids (little-endian unsigned 32-bit, as binary).

    With ``doc_ids`` only files whose range holds one of them are opened and only
    those documents' frames are decompressed. Every frame read is checked against
    its checksum. The running total over files handles one small row per file.
    """
    spark = ready(manifest.sparkSession)
    starts = F.sum("n_tokens").over(Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1))
    files = manifest.select("shard", "file", F.coalesce(starts, F.lit(0)).alias("base"), "first_id", "last_id")
    wanted = None
    if doc_ids is not None:
        wanted = np.array(sorted(set(doc_ids)), np.int64)
        near = spark.createDataFrame([(int(i),) for i in wanted], "wanted bigint")
        files = files.join(near, F.col("wanted").between(F.col("first_id"), F.col("last_id")), "left_semi")
    n = max(1, manifest.count())
    files = files.repartitionByRange(n, "shard").select("file", "base")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                system, inner = pyarrow.fs.FileSystem.from_uri(row["file"])
                size = system.get_file_info(inner).size
                with system.open_input_file(inner) as stream:
                    reader = TokenFileReader(stream, size)
                    mask = None if wanted is None else np.isin(reader.ids, wanted) & ~reader.null
                    for part, ids in reader.documents(mask):
                        yield pa.RecordBatch.from_arrays(
                            [
                                pa.array(reader.ids[part], pa.int64(), mask=reader.null[part]),
                                pa.array(reader.starts[part] + row["base"], pa.int64()),
                                pa.array(ids, pa.binary()),
                            ],
                            names=["doc_id", "start", "ids"],
                        )

    return files.mapInArrow(run, "doc_id bigint, start bigint, ids binary")


def token_file_digest(docs: DataFrame, tokenizer: str, path: str | None = None) -> DataFrame:
    """Write ``docs`` to token files, read them back, and give each document's place and checksum."""
    manifest = write_token_files(docs, tokenizer, path or fresh_dir(docs.sparkSession, "tokens"))
    return read_token_files(manifest).select(
        "doc_id",
        "start",
        (F.octet_length("ids") / 4).cast("bigint").alias("n_tokens"),
        F.crc32("ids").alias("ids_crc32"),
    )
