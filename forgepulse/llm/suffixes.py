"""Removal of repeated byte strings with a sorted array of suffixes.

Every byte of a document that lies in a string of ``length`` bytes which also starts earlier (in a
document with a smaller id, or earlier in the same one) is removed; overlaps count and strings are
judged on the input. Matches never cross documents.

A full suffix array has an entry for each byte. Most of them can be spared: give every string of
``length`` bytes the least hash among its shorter strings of ``gram`` bytes as leading token. Equal
strings have equal tokens, and neighbouring strings mostly share theirs, so a document falls into
runs of strings with one token, and each run is one suffix of the sparse array, followed by a token
for all the bytes its strings cover.

1. Runs are sorted by (leading token, following token, place). A run with both tokens of the one
   before it repeats that run: all its strings start earlier. A run that shares the leading token only
   may hold some repeated strings.
2. Strings of the runs left open stand for themselves as suffixes with two tokens, one for each half
   (96 bits). Sorted by (tokens, place), a suffix equal to the one before it starts earlier too.

Both sorts partition by range with sampled splitters over the whole key, place included, so even a
string that a third of all documents share is spread over buckets; buckets sort locally by multikey
quicksort. In step 2 the last suffix of a bucket is compared with the first of the next. In step 1
runs whose leading token a neighbouring bucket may hold too are simply left open for step 2.

A NULL text is empty. A very long one is hashed in stretches that overlap by a string; a run that a
stretch breaks off is two runs, which share their leading token and are left open for step 2. A task
holds such a text and its removed spans, but nothing else that grows with it. Documents with equal ids, NULL ids last, are taken one after the other in the
order in which they are written down first. Short documents keep all bytes. Empty tables are fine.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from forgepulse.llm.support import Scratch, row_slices

LENGTH = 100
#: Bytes of the strings whose least hash is the leading token.
GRAM = 50
#: Bytes of text that are hashed at once; a longer text is taken in stretches whose strings begin in
#: so many of its bytes.
BYTES_AT_ONCE = 1 << 18
#: Segments that multikey quicksort hands to a plain sort.
SMALL = 4096

_BASE = 0x9E3779B97F4A7C15
_NO_ID = 2**63 - 1


def _inverse(odd: int) -> int:
    """Inverse modulo 2^64, by Newton's steps."""
    x = odd
    for _ in range(6):
        x = x * (2 - odd * x) % 2**64
    return x


@lru_cache(maxsize=2)
def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    def of(base: int) -> np.ndarray:
        row = np.full(size, base, np.uint64)
        row[0] = 1
        return np.cumprod(row, dtype=np.uint64)

    return of(_BASE), of(_inverse(_BASE))


def _mixed(x: np.ndarray) -> np.ndarray:
    half, odd = np.uint64(32), np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> half)) * odd
    x = (x ^ (x >> half)) * odd
    return x ^ (x >> half)


class HashedBytes:
    """Hash of any stretch of a buffer, equal for equal bytes wherever they stand."""

    symbols = np.random.default_rng(20).integers(0, 2**64, 256, dtype=np.uint64)

    def __init__(self, data: bytes):
        values = np.frombuffer(data, np.uint8)
        # Sizes are rounded up so that few tables of powers are ever made.
        up, self.down = _powers(1 << max(18, len(values).bit_length()))
        self.sums = np.zeros(len(values) + 1, np.uint64)
        np.cumsum(self.symbols[values] * up[: len(values)], out=self.sums[1:])

    def stretch(self, start, end) -> np.ndarray:
        return _mixed((self.sums[end] - self.sums[start]) * self.down[start])

    def all_of(self, length: int) -> np.ndarray:
        """Hashes of the stretches of ``length`` bytes at each start."""
        count = max(0, len(self.sums) - length)
        return _mixed((self.sums[length: length + count] - self.sums[:count]) * self.down[:count])


def _least_within(values: np.ndarray, width: int) -> np.ndarray:
    """Least of each ``width`` values in a row."""
    reach = 1
    while 2 * reach <= width:
        values, reach = np.minimum(values[:-reach], values[reach:]), 2 * reach
    return np.minimum(values[: len(values) - width + reach], values[width - reach:])


def stretches(text: bytes, length: int, size: int) -> Iterator[tuple[int, bytes]]:
    """(begin, bytes) of parts of a text in which each of its strings begins and ends once."""
    for begin in range(0, len(text) - length + 1, size):
        yield begin, text[begin: begin + size + length - 1]


def runs(texts: list[bytes], length: int = LENGTH, gram: int = GRAM):
    """(document, start, strings, leading token, following token, open) of all runs of some texts.

    ``open`` marks runs whose leading token stands at two places, as only these may repeat a string
    within themselves.
    """
    sizes = np.array([len(t) for t in texts], np.int64)
    data, width = b"".join(texts), length - gram + 1
    if len(data) < length:
        return tuple(np.empty(0, np.int64) for _ in range(6))
    hashed = HashedBytes(data)
    grams = hashed.all_of(gram)
    least = _least_within(grams, width)
    document = np.repeat(np.arange(len(texts)), sizes)[: len(least)]
    inside = np.arange(len(least)) + length <= np.cumsum(sizes)[document]
    new = np.ones(len(least), bool)
    new[1:] = (least[1:] != least[:-1]) | (document[1:] != document[:-1]) | ~inside[:-1]
    bounds = np.nonzero(new | ~inside)[0]
    starts = np.nonzero(new & inside)[0]
    ends = np.append(bounds, len(least))[np.searchsorted(bounds, starts, side="right")]
    strings, lead = ends - starts, least[starts]
    follow = hashed.stretch(starts, ends - 1 + length) + strings.astype(np.uint64) * np.uint64(_BASE)
    # Two equal strings in a run: the first place of the token in the earlier one begins a string of
    # the run, and its last place in the later one ends another. So only such places are counted.
    place = np.zeros(len(grams), bool)
    for shift in (0, width - 1):
        place[np.nonzero(inside & (grams[shift: shift + len(least)] == least))[0] + shift] = True
    places = np.nonzero(place)[0]
    low = np.searchsorted(places, starts)
    near = np.searchsorted(places, ends - 1 + width) - low
    run = np.repeat(np.arange(len(starts)), near)
    at = places[np.arange(len(run)) - (np.cumsum(near) - near - low)[run]]
    open_ = np.bincount(run, grams[at] == lead[run], minlength=len(starts)) > 1
    begin = starts - (np.cumsum(sizes) - sizes)[document[starts]]
    return document[starts], begin, strings, lead, follow, open_


def multikey_quicksort(columns: list[np.ndarray]) -> np.ndarray:
    """Order of rows by their keys, column by column.

    Rows are parted three ways by a pivot in one column; the equal part goes on with the next column.
    """
    order = np.arange(len(columns[0]))
    stack = [(0, len(order), 0)]
    while stack:
        low, high, depth = stack.pop()
        if high - low < 2 or depth == len(columns):
            continue
        rows = order[low:high]
        if high - low <= SMALL:
            order[low:high] = rows[np.lexsort([c[rows] for c in columns[depth:][::-1]])]
            continue
        values = columns[depth][rows]
        pivot = np.partition(values[:: max(1, len(values) // 63)][:63], 31)[31]
        less, more = values < pivot, values > pivot
        same = ~(less | more)
        first, middle = low + np.count_nonzero(less), low + np.count_nonzero(~more)
        order[low:high] = np.concatenate([rows[less], rows[same], rows[more]])
        stack += (low, first, depth), (first, middle, depth + 1), (middle, high, depth)
    return order


def _buckets(
    judge: Callable[[list[np.ndarray]], dict[str, np.ndarray]], keys: list[str], schema: str
):
    """mapInArrow over buckets: the rows of one, sorted by ``keys``, go to ``judge``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [b for b in batches if b.num_rows]
        if not held:
            return
        rows = pa.Table.from_batches(held)
        held.clear()
        columns = [rows.column(k).to_numpy() for k in keys]
        del rows
        order = multikey_quicksort(columns)
        for i, column in enumerate(columns):
            columns[i] = column[order]
        del order
        yield from pa.table(judge(columns)).to_batches(max_chunksize=1 << 16)

    return lambda df: df.select(*keys).mapInArrow(run, schema)


def _judge_runs(columns: list[np.ndarray]) -> dict[str, np.ndarray]:
    lead, follow, _, number, start, strings, open_ = columns
    new_lead = np.ones(len(lead), bool)
    new_lead[1:] = lead[1:] != lead[:-1]
    first = new_lead.copy()
    first[1:] |= follow[1:] != follow[:-1]
    group = np.cumsum(new_lead) - 1
    shared = np.bincount(group, first)[group] > 1
    at_edge = (group == 0) | (group == group[-1])
    undecided = first & (shared | at_edge | (open_ != 0))
    kept = np.nonzero(~first | undecided)[0]
    return {
        "number": number[kept], "place": columns[2][kept], "start": start[kept],
        "strings": strings[kept], "repeated": ~first[kept],
    }


def _judge_strings(columns: list[np.ndarray]) -> dict[str, np.ndarray]:
    left, right, _, number, start = columns
    repeated = np.zeros(len(left), bool)
    repeated[1:] = (left[1:] == left[:-1]) & (right[1:] == right[:-1])
    # Besides repeated strings: the first suffix of the bucket and its last, for the next bucket.
    keep = repeated.copy()
    keep[0] = keep[-1] = True
    at = np.nonzero(keep)[0]
    bucket = np.full(len(at), TaskContext.get().partitionId(), np.int64)
    edge = np.zeros(len(at), np.int8)
    edge[0] += 1
    edge[-1] += 2
    token = lambda c: np.where(edge > 0, c[at], c.dtype.type(0))
    return {
        "number": number[at], "start": start[at], "repeated": repeated[at], "edge": edge,
        "bucket": bucket, "left": token(left), "right": token(right),
    }


def _compressed(docs: DataFrame) -> DataFrame:
    """(doc_id, place, number, packed): texts as they are kept and shuffled, numbered."""
    import zstandard

    def compress(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = zstandard.ZstdCompressor(level=1).compress
        for batch in row_slices(batches):
            packed = [pack((t or "").encode()) for t in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(packed, pa.binary())],
                ["doc_id", "number", "packed"],
            )

    numbered = docs.select("doc_id", F.monotonically_increasing_id().alias("number"), "text")
    return numbered.mapInArrow(compress, "doc_id long, number long, packed binary").select(
        "doc_id", F.coalesce("doc_id", F.lit(_NO_ID)).alias("place"), "number", "packed"
    )


def _runs_of(texts: DataFrame, length: int, gram: int, at_once: int) -> DataFrame:
    names = ["lead", "follow", "place", "number", "start", "strings", "open"]

    def found(held: list[bytes], place: list[int], number: list[int], begin: list[int]) -> pa.RecordBatch:
        part, start, strings, lead, follow, open_ = runs(held, length, gram)
        columns = [lead.view(np.int64), follow.view(np.int64), np.array(place)[part], np.array(number)[part],
                   np.array(begin)[part] + start, strings, open_.astype(np.int64)]
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        unpack = zstandard.ZstdDecompressor().decompress
        for batch in row_slices(batches):
            held, of, size = [], [], 0
            for place, number, packed in zip(*[batch.column(i) for i in range(3)]):
                for begin, part in stretches(unpack(packed.as_buffer()), length, at_once):
                    held.append(part)
                    of.append((place.as_py(), number.as_py(), begin))
                    size += len(part)
                    if size >= at_once:
                        yield found(held, *map(list, zip(*of)))
                        held, of, size = [], [], 0
            if held:
                yield found(held, *map(list, zip(*of)))

    schema = ", ".join(f"{n} long" for n in names)
    return texts.select("place", "number", "packed").mapInArrow(cut, schema)


def _strings_of(texts: DataFrame, undecided: DataFrame, length: int, at_once: int) -> DataFrame:
    names = ["left", "right", "place", "number", "start"]
    of_document = undecided.groupBy("number").agg(F.collect_list(F.struct("start", "strings")).alias("runs"))

    def spell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        unpack = zstandard.ZstdDecompressor().decompress
        for batch in row_slices(batches):
            place, number = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            for i, packed in enumerate(batch.column(2)):
                open_runs = batch.column(3).slice(i, 1).flatten()
                first, count = open_runs.field(0).to_numpy(), open_runs.field(1).to_numpy()
                # The strings of a run begin in one stretch, where the run was found.
                for begin, part in stretches(unpack(packed.as_buffer()), length, at_once):
                    here = (first >= begin) & (first < begin + at_once)
                    if not here.any():
                        continue
                    hashed, some = HashedBytes(part), count[here]
                    start = np.repeat(first[here] - begin, some) + (
                        np.arange(some.sum()) - np.repeat(np.cumsum(some) - some, some)
                    )
                    middle = start + length // 2
                    columns = [
                        hashed.stretch(start, middle).view(np.int64),
                        (hashed.stretch(middle, start + length) >> np.uint64(32)).astype(np.int32),
                        np.full(len(start), place[i]), np.full(len(start), number[i]), start + begin,
                    ]
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names)

    schema = "left long, right int, place long, number long, start long"
    return (
        texts.join(of_document, "number").select("place", "number", "packed", "runs")
        .mapInArrow(spell, schema)
    )


def _repeated_at_edges(judged: DataFrame) -> DataFrame:
    """First suffixes of buckets that equal the last of the bucket before; two rows a bucket."""
    before = Window.orderBy("bucket", F.col("edge") != 1)
    edges = judged.where("edge > 0").withColumn("opens", F.col("edge").bitwiseAND(F.lit(1)) > 0)
    last = F.lag(F.struct("left", "right")).over(before)
    return edges.withColumn("last", last).where(
        F.col("opens") & (F.col("last") == F.struct("left", "right"))
    )


def repeated_spans(
    texts: DataFrame, scratch: Scratch, length: int, gram: int, at_once: int = BYTES_AT_ONCE
) -> DataFrame:
    """(number, start, end): strings of the numbered texts that start earlier too, joined in runs."""
    keys = ["lead", "follow", "place", "number", "start", "strings", "open"]
    judge = _buckets(
        _judge_runs, keys, "number long, place long, start long, strings long, repeated boolean"
    )
    sparse = _runs_of(texts, length, gram, at_once).repartitionByRange(*keys[:5])
    judged, _ = scratch.write(judge(sparse))
    whole = judged.where("repeated").select(
        "number", "start", (F.col("start") + F.col("strings") - 1 + length).alias("end")
    )
    keys = ["left", "right", "place", "number", "start"]
    judge = _buckets(
        _judge_strings, keys,
        "number long, start long, repeated boolean, edge byte, bucket long, left long, right int",
    )
    dense = _strings_of(texts, judged.where("not repeated"), length, at_once).repartitionByRange(*keys)
    strings, _ = scratch.write(judge(dense))
    single = strings.where("repeated").select("number", "start").unionAll(
        _repeated_at_edges(strings).select("number", "start")
    )
    return whole.unionAll(single.select("number", "start", (F.col("start") + length).alias("end")))


def joined_spans(start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The same stretches with those that overlap or touch as one, in order."""
    order = np.argsort(start, kind="stable")
    start, end = start[order], np.maximum.accumulate(end[order])
    first = np.nonzero(np.append(True, start[1:] > end[:-1])[: len(start)])[0]
    return start[first], end[np.append(first[1:], len(start))[: len(first)] - 1]


def without_repeats(
    docs: DataFrame, length: int = LENGTH, gram: int = GRAM, at_once: int = BYTES_AT_ONCE
) -> DataFrame:
    """(doc_id, n_bytes, spans, kept) of every row of (doc_id, text): the removed stretches of its
    bytes, and the bytes that are left."""
    scratch = Scratch(docs.sparkSession, "suffixes")
    texts, _ = scratch.write(_compressed(docs))
    spans = repeated_spans(texts, scratch, length, gram, at_once)
    of_document = spans.groupBy("number").agg(F.collect_list(F.struct("start", "end")).alias("spans"))
    span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        unpack = zstandard.ZstdDecompressor().decompress
        for batch in row_slices(batches):
            sizes, removed, kept = [], [], []
            for i, packed in enumerate(batch.column(1)):
                text = unpack(packed.as_buffer())
                found = batch.column(2).slice(i, 1).flatten()
                starts, ends = np.empty(0, np.int64), np.empty(0, np.int64)
                if len(found):
                    starts, ends = joined_spans(found.field(0).to_numpy(), found.field(1).to_numpy())
                starts, ends = starts.tolist(), ends.tolist()
                sizes.append(len(text))
                removed.append([{"start": a, "end": b} for a, b in zip(starts, ends)])
                kept.append(b"".join(
                    text[a:b] for a, b in zip([0, *ends], [*starts, len(text)])
                ))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array(removed, span),
                 pa.array(kept, pa.binary())], ["doc_id", "n_bytes", "spans", "kept"],
            )

    return texts.join(of_document, "number", "left").select("doc_id", "packed", "spans").mapInArrow(
        cut, "doc_id long, n_bytes long, spans array<struct<start: bigint, end: bigint>>, kept binary"
    )
