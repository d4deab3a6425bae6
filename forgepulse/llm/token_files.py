"""Token ids in binary files of patched frame-of-reference blocks.

A file holds documents in order. Its ids are cut into blocks of 128: from each the block's minimum is
subtracted, the differences are packed at the width that holds a chosen percentile of them, and those
that need more bits are stored apart in the block's exception list. An index of block starts lets a
reader decode any range of ids alone.

    file    "PFOR" version | blocks ... | block starts | documents | footer
    block   minimum u32, width u8, exceptions u8, packed 2*width u64,
            exception positions u8 ..., exception differences u32 ...

Tasks write files of bounded size under names of their own, and the table of written files is what
counts: a task that runs twice leaves a file that no table names. Documents follow each other by
doc_id, NULL last, equal ids by their text; a NULL text is empty; an empty table gives no file.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from forgepulse.llm.support import new_folder, row_slices, settle
from forgepulse.llm.tokens import encoder
from forgepulse.session import file_system

END_ID = 1
BLOCK = 128
#: Share of a block's differences that the packed width holds.
PERCENTILE = 0.9
#: Ids after which a file ends, with the document that reaches them.
FILE_IDS = 4_000_000
#: Blocks that are encoded or decoded at once.
BLOCKS_AT_ONCE = 4096

_MAGIC = b"PFOR\x01\x00\x00\x00"
_FOOTER = struct.Struct("<QQQQ8s")  # ids, blocks, documents, where the block starts are
_HEAD = 6


def _packed(differences: np.ndarray, width: int) -> np.ndarray:
    """Rows of 128 differences as rows of 2 * width unsigned 64-bit words."""
    lanes = np.ascontiguousarray(differences.T.astype(np.uint64))
    words = np.zeros((2 * width, len(differences)), np.uint64)
    for i in range(BLOCK):
        word, shift = divmod(i * width, 64)
        words[word] |= lanes[i] << np.uint64(shift)
        if shift + width > 64:
            words[word + 1] |= lanes[i] >> np.uint64(64 - shift)
    return np.ascontiguousarray(words.T)


def _unpacked(words: np.ndarray, width: int) -> np.ndarray:
    columns = np.ascontiguousarray(words.T)
    lanes = np.empty((BLOCK, len(words)), np.uint32)
    mask = np.uint64((1 << width) - 1)
    for i in range(BLOCK):
        word, shift = divmod(i * width, 64)
        value = columns[word] >> np.uint64(shift)
        if shift + width > 64:
            value |= columns[word + 1] << np.uint64(64 - shift)
        lanes[i] = value & mask
    return lanes.T


def _bytes_at(starts: np.ndarray, count: int) -> np.ndarray:
    return starts[:, None] + np.arange(count)


def encode_blocks(ids: np.ndarray, percentile: float = PERCENTILE) -> tuple[bytes, np.ndarray]:
    """Blocks of unsigned 32-bit ids, the last filled up with its last id, and where each begins."""
    if not len(ids):
        return b"", np.empty(0, np.uint64)
    blocks = np.pad(ids, (0, -len(ids) % BLOCK), mode="edge").reshape(-1, BLOCK)
    least = blocks.min(axis=1)
    differences = blocks - least[:, None]
    rank = min(BLOCK - 1, int(percentile * BLOCK))
    held = np.partition(differences, rank, axis=1)[:, rank]
    width = np.where(held, np.floor(np.log2(np.maximum(held, 1))) + 1, 0).astype(np.int64)
    outlier = differences.astype(np.uint64) >> width.astype(np.uint64)[:, None] != 0
    outliers = outlier.sum(axis=1)
    sizes = _HEAD + 16 * width + 5 * outliers
    starts = np.cumsum(sizes) - sizes
    out = np.zeros(int(sizes.sum()), np.uint8)
    out[_bytes_at(starts, 4)] = least.astype("<u4").view(np.uint8).reshape(-1, 4)
    out[starts + 4], out[starts + 5] = width, outliers
    inside = np.where(outlier, 0, differences)
    for w in np.unique(width[width > 0]).tolist():
        of = np.nonzero(width == w)[0]
        words = _packed(inside[of], w).astype("<u8").view(np.uint8).reshape(len(of), 16 * w)
        out[_bytes_at(starts[of] + _HEAD, 16 * w)] = words
    row, position = np.nonzero(outlier)
    if len(row):
        nth = np.arange(len(row)) - (np.cumsum(outliers) - outliers)[row]
        lists = starts + _HEAD + 16 * width
        out[lists[row] + nth] = position
        values = differences[row, position].astype("<u4").view(np.uint8).reshape(-1, 4)
        out[_bytes_at((lists + outliers)[row] + 4 * nth, 4)] = values
    return out.tobytes(), starts.astype(np.uint64)


def decode_blocks(data: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Ids of the blocks that begin at ``starts`` in the bytes ``data``, with the last one's filling."""
    starts = starts.astype(np.int64)
    least = data[_bytes_at(starts, 4)].copy().view("<u4").reshape(-1)
    width, outliers = data[starts + 4].astype(np.int64), data[starts + 5].astype(np.int64)
    differences = np.zeros((len(starts), BLOCK), np.uint32)
    for w in np.unique(width[width > 0]).tolist():
        of = np.nonzero(width == w)[0]
        words = data[_bytes_at(starts[of] + _HEAD, 16 * w)].copy().view("<u8").reshape(len(of), 2 * w)
        differences[of] = _unpacked(words, w)
    row = np.repeat(np.arange(len(starts)), outliers)
    if len(row):
        nth = np.arange(len(row)) - (np.cumsum(outliers) - outliers)[row]
        lists = starts + _HEAD + 16 * width
        position = data[lists[row] + nth]
        values = data[_bytes_at((lists + outliers)[row] + 4 * nth, 4)].copy().view("<u4").reshape(-1)
        differences[row, position] = values
    return (differences + least[:, None]).reshape(-1)


def write_file(stream, ids: np.ndarray, doc_ids: list[int | None], lengths: list[int]) -> None:
    stream.write(_MAGIC)
    place, starts, step = len(_MAGIC), [], BLOCK * BLOCKS_AT_ONCE
    for begin in range(0, len(ids), step):
        data, inner = encode_blocks(ids[begin: begin + step])
        stream.write(data)
        starts.append(inner + np.uint64(place))
        place += len(data)
    index = np.concatenate(starts) if starts else np.empty(0, np.uint64)
    stream.write(index.astype("<u8").tobytes())
    known = np.array([d is not None for d in doc_ids], np.uint8)
    stream.write(np.array([d or 0 for d in doc_ids], "<i8").tobytes())
    stream.write(known.tobytes())
    stream.write(np.array(lengths, "<u8").tobytes())
    stream.write(_FOOTER.pack(len(ids), len(index), len(doc_ids), place, _MAGIC))


class TokenFile:
    """A written file: its documents, and any range of its ids."""

    def __init__(self, data: bytes):
        self.data = np.frombuffer(data, np.uint8)
        self.ids, blocks, docs, index, magic = _FOOTER.unpack_from(data, len(data) - _FOOTER.size)
        if magic != _MAGIC or data[: len(_MAGIC)] != _MAGIC:
            raise ValueError("not a file of token blocks")
        self.starts = np.frombuffer(data, "<u8", blocks, index)
        at = index + 8 * blocks
        doc_ids, known = np.frombuffer(data, "<i8", docs, at), np.frombuffer(data, "u1", docs, at + 8 * docs)
        self.doc_ids = [d if k else None for d, k in zip(doc_ids.tolist(), known.tolist())]
        self.lengths = np.frombuffer(data, "<u8", docs, at + 9 * docs).astype(np.int64)

    def read(self, start: int, end: int) -> np.ndarray:
        """Ids from ``start`` up to ``end``; only their blocks are decoded."""
        first = start // BLOCK
        ids = decode_blocks(self.data, self.starts[first: -(-end // BLOCK)])
        return ids[start - first * BLOCK: end - first * BLOCK]

    def documents(self) -> Iterator[tuple[int | None, int, np.ndarray]]:
        """(doc_id, start in the file, ids) of each document, decoding many blocks at a time."""
        ends = np.cumsum(self.lengths)
        low = high = 0
        held = np.empty(0, np.uint32)
        for doc_id, end, length in zip(self.doc_ids, ends.tolist(), self.lengths.tolist()):
            start = end - length
            if end > high:
                low, high = start, min(self.ids, max(end, start + BLOCK * BLOCKS_AT_ONCE))
                held = self.read(low, high)
            yield doc_id, start, held[start - low: end - low]


def write_token_files(
    docs: DataFrame, folder: str, tokenizer: str, end_id: int = END_ID, file_ids: int = FILE_IDS
) -> DataFrame:
    """Writes the ids of (doc_id, text) in order of doc_id; the table of files: part, number, path,
    documents, ids. Documents are dealt out by ranges of doc_id, so a file holds one range."""
    end = np.array([end_id], "<u4").tobytes()

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, part, number = encoder(tokenizer).ids, TaskContext.get().partitionId(), 0
        files, base = file_system(folder)
        doc_ids: list[int | None] = []
        lengths: list[int] = []
        parts: list[bytes] = []

        def finish() -> pa.RecordBatch:
            ids = np.frombuffer(b"".join(parts), "<u4")
            name = f"part-{part:06d}-{number:04d}-{uuid.uuid4().hex}.pfor"
            files.create_dir(base, recursive=True)
            with files.open_output_stream(f"{base}/{name}") as stream:
                write_file(stream, ids, doc_ids, lengths)
            row = {"part": part, "number": number, "path": f"{folder}/{name}",
                   "documents": len(doc_ids), "ids": len(ids)}
            return pa.RecordBatch.from_pylist([row])

        held = 0
        for batch in row_slices(batches):
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                data = encode(text) + end
                doc_ids.append(doc_id)
                lengths.append(len(data) // 4)
                parts.append(data)
                held += len(data) // 4
                if held >= file_ids:
                    yield finish()
                    number, held = number + 1, 0
                    doc_ids, lengths, parts = [], [], []
        if doc_ids:
            yield finish()

    by_id = F.col("doc_id").asc_nulls_last()
    return (
        docs.select("doc_id", "text").repartitionByRange(by_id)
        .sortWithinPartitions(by_id, F.xxhash64("text"))
        .mapInArrow(write, "part long, number long, path string, documents long, ids long")
    )


def read_token_files(manifest: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of each document in the files of a written manifest."""
    earlier = Window.orderBy("part", "number").rowsBetween(Window.unboundedPreceding, -1)
    placed = manifest.select(
        "path", F.coalesce(F.sum("ids").over(earlier), F.lit(0)).alias("first")
    )

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, first in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                files, name = file_system(path)
                with files.open_input_stream(name) as stream:
                    content = TokenFile(stream.read())
                rows = [
                    (doc_id, first + start, len(ids), zlib.crc32(np.ascontiguousarray(ids, "<u4")))
                    for doc_id, start, ids in content.documents()
                ]
                names = ["doc_id", "start", "n_tokens", "ids_crc32"]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(column, pa.int64()) for column in zip(*rows)], names
                )

    files = max(1, manifest.count())
    schema = "doc_id long, start long, n_tokens long, ids_crc32 long"
    return placed.repartition(files).mapInArrow(read, schema)


def round_trip(docs: DataFrame, tokenizer: str, folder: str | None = None) -> DataFrame:
    """Writes all documents and reads the files back."""
    folder = folder or new_folder(docs.sparkSession, "token-files")
    return read_token_files(settle(write_token_files(docs, folder, tokenizer), "token-manifest"))
