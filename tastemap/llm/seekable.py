"""Token ids in files of independent zstandard frames with a trailing seek table.

A file is a sequence of zstandard frames, each with the ids of one document (of a
very long one: several frames in a row) as little-endian unsigned integers, of 16
bits if all ids of the vocabulary fit, else of 32; then a skippable frame with the
documents of the file and that width; then a skippable frame with
the seek table: compressed size, size and checksum of each frame. Any zstandard
reader decompresses the file as a whole, and a reader that knows the seek table
decompresses only the documents it is asked for.
"""

import io
import struct
import uuid
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
import zstandard
from pyarrow import fs
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from tastemap.llm.shared import ship_code
from tastemap.llm.tokens import encoder
from tastemap.sources.durable import durable, scratch_path

# Ids in a frame at most; a longer document takes several frames.
FRAME_IDS = 1 << 20
LEVEL = 3
# Fixed values of the seekable format: skippable frames, and the end of the table.
SEEK_FRAME, DOCUMENT_FRAME, SEEK_END = 0x184D2A5E, 0x184D2A50, 0x8F92EAB1
CHECKSUMS = 0x80

FRAME_SCHEMA = "doc_id long, row long, part int, n_ids long, checksum long, frame binary"
FILE_SCHEMA = "path string, doc_id long, row long, n_ids long"
READ_SCHEMA = "doc_id long, start long, n_tokens long, ids_crc32 long, path string, frame long"


def write_tokens(docs: DataFrame, tokenizer: str, end_id: int, folder: str | None = None,
                 id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encode whole texts and write token files in ascending order of the integer id.

    ``end_id`` follows each document; a null or empty text has that id alone. Rows
    with a null id come first, rows with equal ids in any order, each with its own
    ids; other columns are not read. Returns one row per file: ``path``, the
    first ``doc_id`` and ``row``, ``n_ids``, and ``start``, the ids in all files
    before it. Files named there are complete: a task that is lost or repeated
    leaves a file that no row names. No rows give no files.

    Texts are encoded where they are read; only compressed frames are shuffled.
    """
    ship_code(docs.sparkSession)
    folder = folder or scratch_path(docs.sparkSession, "tokens")
    ids_used = max(encoder(tokenizer).tokenizer.get_vocab_size(), end_id + 1)
    width = "<u2" if ids_used <= 1 << 16 else "<u4"
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"),
                        F.monotonically_increasing_id().alias("row"),
                        F.col(text_col).cast("binary").alias("text"))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode_texts, packer = encoder(tokenizer).encode, zstandard.ZstdCompressor(level=LEVEL)
        end = np.array([end_id], "<u4").tobytes()
        for batch in batches:
            for some in _slices(batch):
                texts = [t + end for t in encode_texts(some.column("text").to_pylist())]
                yield _frames(some, texts, packer, width)

    # Written out, since the range bounds below are sampled in a run of their own.
    frames = durable(texts.mapInArrow(encode, FRAME_SCHEMA))
    in_order = (frames.repartitionByRange("doc_id", "row")
                .sortWithinPartitions("doc_id", "row", "part"))
    files = durable(in_order.mapInArrow(lambda batches: _write_file(batches, folder, width), FILE_SCHEMA))
    before = Window.orderBy("doc_id", "row").rowsBetween(Window.unboundedPreceding, -1)
    return files.withColumn("start", F.coalesce(F.sum("n_ids").over(before), F.lit(0)))


def read_tokens(files: DataFrame) -> DataFrame:
    """Read token files back, checksums included, one task per file.

    One row per document: ``doc_id``, ``start`` (ids of all documents before it),
    ``n_tokens``, ``ids_crc32`` of all its ids, ``path`` and ``frame``, the first
    of its frames. ``files`` is what :func:`write_tokens` returned.
    """
    ship_code(files.sparkSession)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, start in zip(batch.column("path").to_pylist(),
                                   batch.column("start").to_pylist()):
                with TokenFile(path) as file:
                    yield from file.digests(start)

    # As many tasks as files: their rows are too small to be dealt out by size.
    return files.repartition(max(1, files.count()), "path").mapInArrow(read, READ_SCHEMA)


def _slices(batch: pa.RecordBatch, rows: int = 256) -> Iterator[pa.RecordBatch]:
    for first in range(0, batch.num_rows, rows):
        yield batch.slice(first, rows)


def _frames(batch: pa.RecordBatch, ids: list[bytes], packer, width: str) -> pa.RecordBatch:
    columns = [[] for _ in range(6)]
    for doc, row, data in zip(batch.column("doc_id").to_pylist(),
                              batch.column("row").to_pylist(), ids):
        for part, first in enumerate(range(0, len(data), 4 * FRAME_IDS)):
            some = np.frombuffer(data[first:first + 4 * FRAME_IDS], "<u4").astype(width)
            raw = some.tobytes()
            values = (doc, row, part, len(some), xxh64_intdigest(raw) & 0xFFFFFFFF,
                      packer.compress(raw))
            for column, value in zip(columns, values):
                column.append(value)
    types = (pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary())
    return pa.record_batch([pa.array(c, t) for c, t in zip(columns, types)],
                           ["doc_id", "row", "part", "n_ids", "checksum", "frame"])


def _filesystem(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path)


def _write_file(batches: Iterator[pa.RecordBatch], folder: str,
                width: str) -> Iterator[pa.RecordBatch]:
    """One file of the sorted frames of a task, under a name of its own."""
    path, out, first = f"{folder}/{uuid.uuid4().hex}.zst", None, None
    sizes, documents = [], []
    for batch in batches:
        for doc, row, part, n, checksum, frame in zip(*(c.to_pylist() for c in batch.columns)):
            if out is None:
                store, place = _filesystem(folder)
                store.create_dir(place, recursive=True)
                name = path.rsplit("/", 1)[1]
                out = store.open_output_stream(f"{place}/{name}", compression=None)
                first = (doc, row)
            if part == 0:
                documents.append([doc, len(sizes), 0])
            documents[-1][2] += n
            sizes.append((len(frame), np.dtype(width).itemsize * n, checksum))
            out.write(frame)
    if out is None:
        return
    with out:
        out.write(_document_frame(documents, width))
        out.write(_seek_frame(sizes))
    total = sum(d[2] for d in documents)
    yield pa.record_batch([pa.array([path]), pa.array([first[0]], pa.int64()),
                           pa.array([first[1]], pa.int64()), pa.array([total], pa.int64())],
                          ["path", "doc_id", "row", "n_ids"])


def _document_frame(documents: list, width: str) -> bytes:
    """Id, first frame and ids of each document as an Arrow table, its size after it."""
    columns = list(zip(*documents))
    found = pa.table([pa.array(c, pa.int64()) for c in columns], ["doc_id", "frame", "n_ids"])
    found = found.replace_schema_metadata({"width": width})
    sink = io.BytesIO()
    with pa.ipc.new_stream(sink, found.schema) as writer:
        writer.write_table(found)
    body = sink.getvalue()
    return struct.pack("<II", DOCUMENT_FRAME, len(body) + 8) + body + struct.pack("<Q", len(body))


def _seek_frame(sizes: list) -> bytes:
    entries = np.array(sizes, "<u4").tobytes()
    end = struct.pack("<IBI", len(sizes), CHECKSUMS, SEEK_END)
    return struct.pack("<II", SEEK_FRAME, len(entries) + len(end)) + entries + end


class TokenFile:
    """Random access to one token file."""

    def __init__(self, path: str):
        store, place = _filesystem(path)
        self.path, self.file = path, store.open_input_file(place)
        size = self.file.size()
        frames, flags, magic = struct.unpack("<IBI", self.file.read_at(9, size - 9))
        if magic != SEEK_END or flags != CHECKSUMS:
            raise ValueError(f"{path} has no seek table with checksums")
        table = size - 9 - 12 * frames
        self.sizes = np.frombuffer(self.file.read_at(12 * frames, table), "<u4").reshape(-1, 3)
        self.offsets = np.concatenate([[0], np.cumsum(self.sizes[:, 0], dtype=np.int64)])
        (length,) = struct.unpack("<Q", self.file.read_at(8, table - 16))
        body = self.file.read_at(length, table - 16 - length)
        self.documents = pa.ipc.open_stream(body).read_all()
        self.width = self.documents.schema.metadata[b"width"].decode()
        self.unpacker = zstandard.ZstdDecompressor()

    def __enter__(self):
        return self

    def __exit__(self, *problem):
        self.file.close()

    def frame(self, number: int) -> bytes:
        """The bytes of one frame; a wrong checksum is an error."""
        packed, size, checksum = map(int, self.sizes[number])
        data = self.file.read_at(packed, int(self.offsets[number]))
        raw = self.unpacker.decompress(data, max_output_size=size)
        if len(raw) != size or xxh64_intdigest(raw) & 0xFFFFFFFF != checksum:
            raise ValueError(f"frame {number} of {self.path} is damaged")
        return raw

    def ids(self, place: int) -> np.ndarray:
        """Ids of the document at ``place`` in the file, from its own frames only."""
        frames = self.documents.column("frame")
        first = frames[place].as_py()
        last = frames[place + 1].as_py() if place + 1 < len(frames) else len(self.sizes)
        raw = b"".join(map(self.frame, range(first, last)))
        return np.frombuffer(raw, self.width).astype("<u4")

    def digests(self, start: int, rows: int = 10_000) -> Iterator[pa.RecordBatch]:
        n = self.documents.column("n_ids").to_numpy()
        starts = start + np.concatenate([[0], np.cumsum(n)[:-1]])
        for first in range(0, len(n), rows):
            places = range(first, min(first + rows, len(n)))
            some = self.documents.slice(first, rows).combine_chunks()
            crcs = [crc32(self.ids(place)) for place in places]
            yield pa.record_batch(
                [some.column("doc_id").chunk(0), pa.array(starts[first:first + rows]),
                 some.column("n_ids").chunk(0), pa.array(crcs, pa.int64()),
                 pa.array([self.path] * len(places)), some.column("frame").chunk(0)],
                ["doc_id", "start", "n_tokens", "ids_crc32", "path", "frame"])
