"""JSON arrays that fill a file, over any number of lines and of any size.

A text source reads a file of this form either in lines, which are no JSON, or whole. Here tasks read files
in chunks and cut the array at its own commas: a chunk and the element that is open at its end are all that
is held. Elements are not parsed, so whether each is JSON is for Spark to say.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from forgepulse.session import file_system

#: Bytes that are read at once, and characters of a batch of elements, roughly.
CHUNK_BYTES, BATCH_BYTES = 1 << 20, 8 << 20
#: Bytes of a row of text that is kept unread.
PIECE_BYTES = 16 << 20

# What a file is: one array to its end; an array that breaks off; no array, or one with more behind it.
ARRAY, TORN, OTHER = "array", "torn", "other"

_QUOTE, _BACKSLASH, _COMMA, _OPEN, _CLOSE = b'"\\,[]'
_STEP = np.zeros(256, np.int8)
_STEP[list(b"[{")], _STEP[list(b"]}")] = 1, -1
_MARK = np.zeros(256, bool)
_MARK[list(b"[]{},")] = True
_BLANK, _BOM = b" \t\r\n", b"\xef\xbb\xbf"


class ArraySplitter:
    """Cuts the elements out of a text that is fed to it in chunks, wherever these end."""

    def __init__(self) -> None:
        self.kind: str | None = None  # None: blank so far; TORN until the array has ended
        self._lead = b""  # of a byte-order mark
        self._open: list[bytes] = []  # the element that has begun
        self._quoted, self._escaped, self._depth, self._count, self._closed = 0, 0, 0, 0, False

    def feed(self, chunk: bytes) -> list[bytes]:
        """Elements that end in this chunk, blanks around them stripped."""
        if self.kind is None:
            chunk, self._lead = self._lead + chunk, b""
            if len(chunk) < len(_BOM) and _BOM.startswith(chunk):
                self._lead = chunk
                return []
            chunk = chunk.removeprefix(_BOM).lstrip(_BLANK)
            if not chunk:
                return []
            self.kind = TORN if chunk[0] == _OPEN else OTHER
        if self.kind == OTHER:
            return []
        if self._closed:
            if chunk.strip(_BLANK):
                self.kind = OTHER
            return []
        data = np.frombuffer(chunk, np.uint8)
        outside, quotes = self._outside_strings(data)
        marks = np.flatnonzero(_MARK[data] & outside)
        depth = self._depth + np.cumsum(_STEP[data[marks]])
        ends = marks[((data[marks] == _COMMA) & (depth == 1)) | ((_STEP[data[marks]] < 0) & (depth <= 0))]
        begin, found = 0, []
        if not self._depth:
            begin = 1  # behind the bracket of the array
        for end in ends.tolist():
            self._open.append(chunk[begin:end])
            element = b"".join(self._open).strip(_BLANK)
            self._open, begin = [], end + 1
            last = data[end] != _COMMA
            if not element and not (last and not self._count):
                return self._broken()
            if element:
                found.append(element)
                self._count += 1
            if last:
                if data[end] != _CLOSE:
                    return self._broken()
                self._closed = True
                self.kind = OTHER if chunk[begin:].strip(_BLANK) else ARRAY
                return found
        self._open.append(chunk[begin:])
        self._depth = int(depth[-1]) if len(depth) else self._depth
        self._quoted = quotes
        return found

    def _broken(self) -> list[bytes]:
        self.kind, self._closed, self._open = TORN, True, []
        self.feed = lambda chunk: []  # type: ignore[method-assign]
        return []

    def _outside_strings(self, data: np.ndarray) -> tuple[np.ndarray, int]:
        """Which bytes are outside strings, and whether one is open at the end (1) or not (0)."""
        quote = data == _QUOTE
        slashes = np.flatnonzero(data == _BACKSLASH)
        if len(slashes) or self._escaped:
            first = np.ones(len(slashes), bool)
            first[1:] = np.diff(slashes) > 1
            begin = slashes[first]
            length = np.diff(np.append(np.flatnonzero(first), len(slashes)))
            if self._escaped and len(data):  # a run that ended the last chunk, odd so far
                if len(begin) and begin[0] == 0:
                    length[0] += 1
                    begin = begin.copy()
                    begin[0] = -1
                else:
                    quote[0] = False
            behind = (begin + length)[length % 2 == 1]
            quote[behind[behind < len(data)]] = False
            self._escaped = int((behind == len(data)).any())
        inside = (np.cumsum(quote) + self._quoted) & 1
        return inside == 0, int(inside[-1]) if len(inside) else self._quoted


def _chunks(path: str) -> Iterator[bytes]:
    files, name = file_system(path)
    with files.open_input_stream(name) as stream:
        while chunk := stream.read(CHUNK_BYTES):
            yield chunk


def _text(parts: list[bytes]) -> pa.Array:
    return pa.array([p.decode("utf-8", "replace") for p in parts], pa.string())


def array_elements(files: DataFrame) -> DataFrame:
    """(file, value, kind) of the files (file, path): a row with the ``value`` of each element and no
    ``kind``, and behind them a row with the ``kind`` of the file, ``array``, ``torn`` or ``other``.

    Elements of a file that turns out not to be an array count for nothing.
    """

    def split(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows(file: str, parts: list[bytes], kind: str | None = None) -> pa.RecordBatch:
            values = pa.nulls(1, pa.string()) if kind else _text(parts)
            count = len(values)
            return pa.RecordBatch.from_arrays(
                [pa.array([file] * count, pa.string()), values, pa.array([kind] * count, pa.string())], ["file", "value", "kind"]
            )

        for batch in batches:
            for file, path in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                splitter, held, size = ArraySplitter(), [], 0
                for chunk in _chunks(path):
                    found = splitter.feed(chunk)
                    held += found
                    size += sum(map(len, found))
                    if splitter.kind == OTHER:
                        held = []
                        break
                    if size >= BATCH_BYTES:
                        yield rows(file, held)
                        held, size = [], 0
                if held:
                    yield rows(file, held)
                yield rows(file, [], splitter.kind or OTHER)

    return _dealt(files).mapInArrow(split, "file STRING, value STRING, kind STRING")


def text_pieces(files: DataFrame) -> DataFrame:
    """(file, piece, value): the whole text of the files (file, path), in pieces of bounded size that
    add up to it."""

    def read(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file, path in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                number, rest = 0, b""
                for chunk in _chunks(path):
                    rest += chunk
                    while len(rest) >= PIECE_BYTES + 4:
                        end = PIECE_BYTES
                        while rest[end] & 0xC0 == 0x80:  # not inside a character
                            end -= 1
                        yield _piece(file, number, rest[:end])
                        number, rest = number + 1, rest[end:]
                if rest or not number:
                    yield _piece(file, number, rest)

    return _dealt(files).mapInArrow(read, "file STRING, piece INT, value STRING")


def _piece(file: str, number: int, text: bytes) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([file]), pa.array([number], pa.int32()), _text([text])], ["file", "piece", "value"]
    )


def _dealt(files: DataFrame) -> DataFrame:
    """Files, one by one, over the tasks: adaptive execution would merge such small rows into one."""
    tasks = int(files.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return files.select("file", "path").repartition(tasks, F.xxhash64("path"))
