"""Packing documents into fixed-length token sequences.

First-fit decreasing, run independently in randomised groups of documents: within a group, pieces are
placed from the longest to the shortest into the first sequence with room, which a tournament tree of
the remaining capacities finds in a logarithmic number of steps. Groups hold a bounded number of
pieces however large the input is, so the work is spread evenly and each group is one small task.

Documents longer than a sequence are cut into full sequences and a rest. A NULL or empty text is the
end id alone; equal rows are packed each on its own; a NULL id is kept. An empty table packs to none.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from forgepulse.llm.support import row_slices, settle
from forgepulse.llm.tokens import encoder

CAPACITY = 2048
END_ID = 1
#: Mean number of pieces that are packed together.
GROUP_PIECES = 8192
#: Pieces of one document that stay in one group.
DOCUMENT_PIECES = 1024

PIECE = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"


def token_pieces(
    docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = END_ID,
    with_ids: bool = False,
) -> DataFrame:
    """Pieces of at most ``capacity`` ids of every whole text of (doc_id, text), with a ``salt``.

    ``with_ids`` adds the ids themselves as little-endian unsigned 32-bit integers.
    """
    end = np.array([end_id], "<u4").tobytes()
    schema = PIECE + ", salt long" + (", ids binary" if with_ids else "")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, task, row = encoder(tokenizer).ids, TaskContext.get().partitionId(), 0
        for batch in row_slices(batches):
            rows = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                ids, row = encode(text) + end, row + 1
                total = len(ids) // 4
                for number, start in enumerate(range(0, total, capacity)):
                    part = ids[4 * start: 4 * (start + capacity)]
                    # Equal rows in one place differ by their number, so copies are spread as well.
                    seed = f"{doc_id}/{task}/{row}/{number // DOCUMENT_PIECES}".encode()
                    salt = zlib.crc32(seed) << 20 | zlib.crc32(seed, 1) >> 12
                    rows.append((doc_id, start, len(part) // 4, zlib.crc32(part), total, salt, part))
            columns = list(zip(*rows))[: 7 if with_ids else 6]
            kinds = [pa.int64()] * 6 + [pa.binary()]
            names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "salt", "ids"]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds)], names[: len(columns)]
            )

    return docs.select("doc_id", "text").mapInArrow(cut, schema)


class TournamentTree:
    """Remaining capacities of sequences; each inner node knows the most room below it."""

    def __init__(self, bins: int, capacity: int):
        self.leaves = 1 << max(0, bins - 1).bit_length()
        self.room = [capacity] * (2 * self.leaves)

    def place(self, length: int) -> int:
        """Takes ``length`` from the first sequence that has as much room; returns its number."""
        room, node = self.room, 1
        while node < self.leaves:
            node *= 2
            if room[node] < length:
                node += 1
        found = node - self.leaves
        room[node] -= length
        while node > 1:
            node //= 2
            most = max(room[2 * node], room[2 * node + 1])
            if room[node] == most:
                break
            room[node] = most
        return found


def first_fit_decreasing(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Sequence and offset of each length; lengths must fall and be at most ``capacity``."""
    tree = TournamentTree(len(lengths), capacity)
    used = [0] * len(lengths)
    sequence, offset = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    for i, length in enumerate(lengths.tolist()):
        found = tree.place(length)
        sequence[i], offset[i] = found, used[found]
        used[found] += length
    return sequence, offset


def pack(pieces: DataFrame, capacity: int = CAPACITY, group_pieces: int = GROUP_PIECES) -> DataFrame:
    """Adds sequence_id and offset to the rows of ``token_pieces``, which are written once."""
    written = settle(pieces, "pieces")
    groups = max(1, round(written.count() / group_pieces))
    with_ids = "ids" in written.columns

    def pack_group(key: tuple[pa.Scalar], group: pa.Table) -> pa.Table:
        group = group.sort_by([
            ("length", "descending"), ("doc_id", "ascending"), ("start", "ascending"),
            ("ids_crc32", "ascending"),
        ])
        lengths = group.column("length").to_numpy()
        sequence, offset = first_fit_decreasing(lengths, capacity)
        ids = (key[0].as_py() << 32) + sequence
        return (
            group.drop_columns(["group"])
            .append_column("sequence_id", pa.array(ids, pa.int64()))
            .append_column("offset", pa.array(offset, pa.int64()))
        )

    schema = PIECE + (", ids binary" if with_ids else "") + ", sequence_id long, offset long"
    return (
        written.withColumn("group", F.col("salt") % groups).drop("salt")
        .groupBy("group").applyInArrow(pack_group, schema)
    )


def sequences(packed: DataFrame, capacity: int = CAPACITY, pad_id: int = 0) -> DataFrame:
    """(sequence_id, length, ids): whole sequences from pieces with ids, padded to ``capacity``."""
    pad = np.array([pad_id], "<u4").tobytes()
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    joined = F.aggregate(parts, F.lit(b""), lambda whole, part: F.concat(whole, part["ids"]))
    filled = packed.groupBy("sequence_id").agg(F.sum("length").alias("length"), joined.alias("ids"))
    padding = F.expr(f"unhex(repeat('{pad.hex()}', cast({capacity} - length as int)))")
    return filled.withColumn("ids", F.concat("ids", padding))
