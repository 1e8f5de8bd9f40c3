"""Token ids in a binary file format: independent zstandard frames, a seek table, checksums.

A file holds the ids of consecutive documents as little-endian unsigned 32-bit numbers, in frames
that end with a document, each compressed on its own. Two skippable frames follow, which any zstandard reader
passes over: an index of the documents, and the seek table of the public seekable format, whose entries
are each frame's compressed and decompressed size and the low 32 bits of the XXH64 of its content. A reader
takes the table from the file's end and decompresses just the frames that hold what it wants.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tributary.llm.bpe import encoder
from tributary.llm.files import make_folder, opened
from tributary.llm.wordhash import text_chunks
from tributary.session import fresh_folder, kept_table

# Fixed values of the zstandard seekable format, and a skippable frame of our own for the index.
SKIPPABLE_TABLE, SKIPPABLE_INDEX, SEEKABLE_MAGIC, HAS_CHECKSUM = 0x184D2A5E, 0x184D2A5D, 0x8F92EAB1, 0x80
NO_ID = 1  # flag of a document without an id
MANIFEST = "path string, first_id long, sort_place long, n_documents long, n_tokens long"
DOCUMENTS = "doc_id long, start long, n_tokens long, ids_crc32 long"


class TokenFileWriter:
    """Writes one file; documents are buffered up to a frame, so memory follows the longest document."""

    def __init__(self, out, frame_bytes: int = 1 << 18, level: int = 1) -> None:
        self._out, self._frame_bytes = out, frame_bytes
        self._compressor = zstandard.ZstdCompressor(level=level, write_content_size=True)
        self._buffer: list[bytes] = []
        self._held = 0
        self._frames: list[tuple[int, int, int]] = []
        self._index: list[tuple[int, int, int, int]] = []  # id, flags, frame, tokens
        self.tokens = 0

    def add(self, doc_id: int | None, ids: bytes) -> None:
        self._index.append((doc_id or 0, NO_ID if doc_id is None else 0, len(self._frames), len(ids) // 4))
        self._buffer.append(ids)
        self._held += len(ids)
        self.tokens += len(ids) // 4
        if self._held >= self._frame_bytes:
            self._end_frame()

    def _end_frame(self) -> None:
        content = b"".join(self._buffer)
        packed = self._compressor.compress(content)
        self._out.write(packed)
        self._frames.append((len(packed), len(content), xxhash.xxh64_intdigest(content) & 0xFFFFFFFF))
        self._buffer, self._held = [], 0

    def close(self) -> int:
        """Ends the file; returns its number of documents."""
        if self._buffer:
            self._end_frame()
        index = self._compressor.compress(np.array(self._index, dtype="<i8").reshape(-1, 4).tobytes())
        self._out.write(struct.pack("<II", SKIPPABLE_INDEX, len(index)) + index)
        table = b"".join(struct.pack("<III", *f) for f in self._frames)
        footer = struct.pack("<IBI", len(self._frames), HAS_CHECKSUM, SEEKABLE_MAGIC)
        self._out.write(struct.pack("<II", SKIPPABLE_TABLE, len(table) + len(footer)) + table + footer)
        return len(self._index)


class TokenFileReader:
    """Reads documents of one file by their place in it; each frame's checksum is verified."""

    def __init__(self, source) -> None:
        self._in = source
        size = source.size()
        frames, flags, magic = struct.unpack("<IBI", source.read_at(9, size - 9))
        if magic != SEEKABLE_MAGIC or not flags & HAS_CHECKSUM:
            raise ValueError("no seek table with checksums at the end of the file")
        table_at = size - 9 - 12 * frames
        head, length = struct.unpack("<II", source.read_at(8, table_at - 8))
        if head != SKIPPABLE_TABLE or length != 12 * frames + 9:
            raise ValueError("the seek table is damaged")
        self.frames = np.frombuffer(source.read_at(12 * frames, table_at), dtype="<u4").reshape(-1, 3)
        self._starts = np.concatenate(([0], np.cumsum(self.frames[:, 0], dtype=np.int64)))
        index_at = int(self._starts[-1])
        head, length = struct.unpack("<II", source.read_at(8, index_at))
        if head != SKIPPABLE_INDEX:
            raise ValueError("the index of documents is missing")
        index = zstandard.ZstdDecompressor().decompress(source.read_at(length, index_at + 8))
        self.index = np.frombuffer(index, dtype="<i8").reshape(-1, 4)
        self._loaded, self._content = -1, b""
        begins = np.concatenate(([0], np.cumsum(self.index[:, 3])))
        self.starts = begins[:-1]
        first = np.searchsorted(self.index[:, 2], np.arange(frames))
        self._frame_starts = begins[first] if frames else begins[:0]

    def __len__(self) -> int:
        return len(self.index)

    def ids(self, place: int) -> bytes:
        frame = int(self.index[place, 2])
        if frame != self._loaded:
            packed = self._in.read_at(int(self.frames[frame, 0]), int(self._starts[frame]))
            content = zstandard.ZstdDecompressor().decompress(packed)
            if len(content) != self.frames[frame, 1] or xxhash.xxh64_intdigest(content) & 0xFFFFFFFF != self.frames[frame, 2]:
                raise ValueError(f"frame {frame} does not match its checksum")
            self._loaded, self._content = frame, content
        start = 4 * int(self.starts[place] - self._frame_starts[frame])
        return self._content[start : start + 4 * int(self.index[place, 3])]


def write_token_files(
    df: DataFrame, folder: str, tokenizer: str, end_id: int = 0, text: str = "text", doc_id: str = "doc_id", frame_bytes: int = 1 << 18
) -> DataFrame:
    """The ids of every document, each with ``end_id`` after it, in files below ``folder``.

    Documents are dealt out by range of id and sorted, so the files taken in the order of their
    first ids hold them ascending (null ids first, equal ids by text). One file per task. A file's name is new in every
    attempt, and the manifest returned (path, first_id, sort_place, n_documents, n_tokens; a kept
    table) names those of successful tasks only. Null text counts as empty and is the end id alone.
    """
    make_folder(folder)
    end = int(end_id).to_bytes(4, "little")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        encode, out, writer, first = encoder(tokenizer), None, None, None
        path = f"{folder}/{uuid.uuid4().hex}.tok.zst"
        for batch, texts in text_chunks(batches, "text"):
            if writer is None:
                system, inner = opened(path)
                out = system.open_output_stream(inner, compression=None)
                writer, first = TokenFileWriter(out, frame_bytes), batch.column("doc_id")[0].as_py()
            for key, ids in zip(batch.column("doc_id").to_pylist(), encode([t.decode() for t in texts])):
                writer.add(key, ids + end)
        if writer is not None:
            documents = writer.close()
            out.close()
            row = [path, first, TaskContext.get().partitionId(), documents, writer.tokens]
            types = (pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.int64())
            names = ["path", "first_id", "sort_place", "n_documents", "n_tokens"]
            yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, types)], names=names)

    rows = df.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    order = [F.col("doc_id").asc_nulls_first(), F.xxhash64("text"), F.col("text")]
    placed = rows.repartitionByRange(*order[:2]).sortWithinPartitions(*order)
    return kept_table(placed.mapInArrow(write, MANIFEST), "token-manifest")


def read_token_files(manifest: DataFrame, wanted: Sequence[int] | None = None) -> DataFrame:
    """Documents read back from the files: doc_id, start, n_tokens, ids_crc32.

    ``start`` counts the ids of all documents before, over all files. With ``wanted`` ids, only the
    frames that hold these documents are decompressed.
    """
    chosen = None if wanted is None else set(wanted)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, before in zip(batch.column("path").to_pylist(), batch.column("before").to_pylist()):
                system, inner = opened(path)
                with system.open_input_file(inner) as source:
                    reader = TokenFileReader(source)
                    out = []
                    for place in range(len(reader)):
                        key = None if reader.index[place, 1] & NO_ID else int(reader.index[place, 0])
                        if chosen is None or key in chosen:
                            ids = reader.ids(place)
                            out.append((key, before + int(reader.starts[place]), len(ids) // 4, zlib.crc32(ids)))
                    if out:
                        types = (pa.int64(),) * 4
                        names = [c.split()[0] for c in DOCUMENTS.split(", ")]
                        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names=names)

    before = Window.orderBy("sort_place").rowsBetween(Window.unboundedPreceding, -1)
    starts = manifest.select("path", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)).cast("long").alias("before"))
    width = int(manifest.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return starts.repartition(width).mapInArrow(read, DOCUMENTS)


def token_files_round_trip(df: DataFrame, tokenizer: str, end_id: int = 0) -> DataFrame:
    """``df`` written and read back through files in a new folder of the shared work folder."""
    return read_token_files(write_token_files(df, fresh_folder(df.sparkSession, "tokens"), tokenizer, end_id))
