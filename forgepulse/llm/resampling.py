"""Importance resampling towards a target distribution.

Documents and target texts are bags of n-grams of words, hashed into buckets. A bucket's gain is the
log ratio of its smoothed shares in the target and in the documents; a document's weight is the mean
gain over its n-grams. Weights with Gumbel noise, drawn from a hash of the document's id, rank the
documents: taking the highest scores is sampling without replacement in proportion to exp(weight).

N-grams are interned batch by batch in open-addressed numpy tables: the XXH64 of an n-gram picks the
slot, its bytes are verified against those of the slot's owner, and a clash goes on to the next slot.
A slot stores its bucket and its count. Counting adds up the slots; weighing gathers the gain of each
occurrence through its slot. N-grams of different byte lengths are never equal, so each length of a
batch has a table of its own and all comparisons are of whole machine words.

A word is a run of digits, of the letters a-z after A-Z were lower-cased, and of anything beyond
ASCII. A NULL or empty text has no words and weight 0; very long texts are whole, but are at home in
the memory of one task, about 40 times the size of the longest text. Documents with one id, NULL included, share their noise;
ties go to the smaller id, NULL last, and among equal ids to any one. Empty tables give empty results,
and an empty target makes all gains those of its smoothing. Only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from forgepulse.llm.support import Scratch, row_slices
from forgepulse.operators.numbering import numbered

BUCKETS, SMOOTHING, SEED = 10_000, 1, 2024
#: Share of the documents with at least so many words that is drawn.
PERCENT, LEAST_WORDS = 10, 20
#: Bytes of n-grams that are compared at once.
TABLE_BYTES = 1 << 23

# The primes of XXH64.
_P1, _P2, _P3 = 11400714785074694791, 14029467366897019727, 1609587929392839161
_P4, _P5 = 9650029242287828579, 2870177450012600261

_BYTES = np.arange(256)
_LOWER = np.where((_BYTES >= 65) & (_BYTES <= 90), _BYTES + 32, _BYTES).astype(np.uint8)
_IN_WORD = (_BYTES >= 128) | ((_BYTES >= 48) & (_BYTES <= 57)) | ((_BYTES >= 97) & (_BYTES <= 122))


@dataclass
class Grams:
    """N-grams of some texts: byte ranges of a buffer of words, each word followed by one blank."""

    data: np.ndarray
    start: np.ndarray
    length: np.ndarray
    text: np.ndarray
    words: np.ndarray  # of each text


def grams_of(texts: pa.Array, most: int) -> Grams:
    """Runs of 1 to ``most`` consecutive words of each text."""
    column = pc.cast(texts, pa.large_binary())
    ends = np.frombuffer(column.buffers()[1], np.int64)[column.offset: column.offset + len(column) + 1]
    held = column.buffers()[2]
    data = np.frombuffer(held, np.uint8)[ends[0]: ends[-1]] if held else np.zeros(0, np.uint8)
    ends = ends - ends[0]
    data = _LOWER[data]
    inside = _IN_WORD[data]
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    some = ends[:-1] < ends[1:]
    first[ends[:-1][some]] = inside[ends[:-1][some]]  # no word goes on in the next text
    last[ends[1:][some] - 1] = inside[ends[1:][some] - 1]
    starts = np.flatnonzero(first)
    sizes = np.flatnonzero(last) + 1 - starts
    text = np.searchsorted(ends, starts, "right") - 1
    at = np.cumsum(sizes + 1) - (sizes + 1)
    packed = np.full(int((sizes + 1).sum()) + 8, 32, np.uint8)
    letters = np.ones(len(packed), bool)
    letters[at + sizes], letters[len(packed) - 8:] = False, False
    packed[letters] = data[inside]
    found = [(at, sizes, text)]
    for n in range(2, most + 1):
        whole = np.flatnonzero(text[n - 1:] == text[: len(text) - n + 1])
        found.append((at[whole], (at + sizes)[whole + n - 1] - at[whole], text[whole]))
    start, length, owner = (np.concatenate(parts) for parts in zip(*found))
    return Grams(packed, start, length, owner, np.bincount(text, minlength=len(column)))


def _turned(x: np.ndarray, by: int) -> np.ndarray:
    return (x << np.uint64(by)) | (x >> np.uint64(64 - by))


def xxh64(lanes: np.ndarray, length: int) -> np.ndarray:
    """XXH64 with seed 0 of byte strings of one length, given as rows of little-endian 64-bit lanes
    filled up with zeros."""
    if length >= 32:
        rows = lanes.view(np.uint8).reshape(len(lanes), -1)[:, :length]
        return np.array([xxhash.xxh64_intdigest(r.tobytes()) for r in rows], np.uint64)
    p1, p2, p3, p4, p5 = (np.uint64(p) for p in (_P1, _P2, _P3, _P4, _P5))
    out = np.full(len(lanes), np.uint64((_P5 + length) % 2**64))
    for k in range(length // 8):
        out = _turned(out ^ (_turned(lanes[:, k] * p2, 31) * p1), 27) * p1 + p4
    rest = lanes[:, length // 8] if length % 8 else None
    left = length % 8
    if left >= 4:
        out = _turned(out ^ ((rest & np.uint64(0xFFFFFFFF)) * p1), 23) * p2 + p3
        rest, left = rest >> np.uint64(32), left - 4
    for _ in range(left):
        out = _turned(out ^ ((rest & np.uint64(255)) * p5), 11) * p1
        rest = rest >> np.uint64(8)
    out = (out ^ (out >> np.uint64(33))) * p2
    out = (out ^ (out >> np.uint64(29))) * p3
    return out ^ (out >> np.uint64(32))


def interned(lanes: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Slot of each string in an open-addressed table, and the string that owns each slot (-1: none).

    All strings try their slots at once: those before a free slot claim it, one of them gets it, and
    whoever then stands before an owner of the same hash and the same bytes has found its slot.
    """
    size = 1 << max(1, (2 * len(hashes) - 1).bit_length())
    owner = np.full(size, -1, np.int64)
    slot = (hashes & np.uint64(size - 1)).astype(np.int64)
    waiting = np.arange(len(hashes))
    while len(waiting):
        claims = waiting[owner[slot[waiting]] < 0]
        owner[slot[claims]] = claims
        held = owner[slot[waiting]]
        same = hashes[held] == hashes[waiting]
        same[same] = (lanes[held[same]] == lanes[waiting[same]]).all(axis=1)
        waiting = waiting[~same]
        slot[waiting] = (slot[waiting] + 1) & (size - 1)
    return slot, owner


def _tables(grams: Grams, buckets: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """For each table: its occurrences (positions in ``grams``) with their slots, and the buckets and
    counts that its slots store."""
    order = np.argsort(grams.length, kind="stable")
    sizes = grams.length[order]
    turns = np.flatnonzero(np.diff(sizes)) + 1
    for low, high in zip([0, *turns], [*turns, len(order)]):
        if low == high:
            continue
        length = int(sizes[low])
        lanes = -(-length // 8)
        step = max(1, TABLE_BYTES // (8 * lanes))
        padded = np.concatenate([grams.data, np.zeros(8 * lanes, np.uint8)])
        views = np.lib.stride_tricks.sliding_window_view(padded, 8 * lanes)
        for begin in range(low, high, step):
            some = order[begin: min(begin + step, high)]
            rows = views[grams.start[some]]
            rows[:, length:] = 0
            keys = rows.view("<u8")
            slot, owner = interned(keys, xxh64(keys, length))
            used = np.flatnonzero(owner >= 0)
            bucket, count = np.zeros(len(owner), np.int64), np.bincount(slot, minlength=len(owner))
            # crc32 reads the bytes themselves: each distinct n-gram once.
            bucket[used] = [zlib.crc32(rows[o, :length]) % buckets for o in owner[used]]
            yield some, slot, bucket, count


def bucket_counts(texts: DataFrame, order: int = 1, buckets: int = BUCKETS) -> DataFrame:
    """(bucket, n) of all n-grams of the column ``text``, buckets that occur. A task sends a row for
    each bucket at most."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in row_slices(batches):
            for _, _, bucket, n in _tables(grams_of(batch.column(0), order), buckets):
                total += np.bincount(bucket, n, minlength=buckets).astype(np.int64)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], ["bucket", "n"])

    data = F.coalesce("text", F.lit("")).cast("binary").alias("data")
    counted = texts.select(data).mapInArrow(count, "bucket long, n long")
    return counted.groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(docs: DataFrame, target: DataFrame, order: int = 1, buckets: int = BUCKETS) -> list[int]:
    """Gain of each bucket, in thousandths: one number a bucket reaches the driver."""
    spark = docs.sparkSession
    own, wanted = (
        Scratch(spark, "bucket-counts").write(bucket_counts(t, order, buckets))[0] for t in (docs, target)
    )
    sums = [t.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n")).first()["n"] for t in (own, wanted)]
    both = (
        spark.range(buckets).withColumnRenamed("id", "bucket")
        .join(own.withColumnRenamed("n", "s"), "bucket", "left")
        .join(wanted.withColumnRenamed("n", "t"), "bucket", "left")
    )
    smooth = SMOOTHING * buckets
    s, t = (F.coalesce(c, F.lit(0)).cast("double") + SMOOTHING for c in (F.col("s"), F.col("t")))
    ratio = t * F.lit(float(sums[0] + smooth)) / (s * F.lit(float(sums[1] + smooth)))
    rows = both.select("bucket", F.floor(F.log(ratio) * 1000).alias("gain")).collect()
    return [r["gain"] for r in sorted(rows, key=lambda r: r["bucket"])]


def weights(docs: DataFrame, gain: list[int], order: int = 1) -> DataFrame:
    """(doc_id, n_words, n_features, weight) of each document: the floored mean gain of its n-grams."""
    table = np.array(gain, np.int64)

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in row_slices(batches):
            grams = grams_of(batch.column(1), order)
            each = np.zeros(len(grams.start), np.int64)
            for some, slot, bucket, _ in _tables(grams, len(table)):
                each[some] = table[bucket][slot]
            n = np.bincount(grams.text, minlength=batch.num_rows)
            total = np.zeros(batch.num_rows, np.int64)
            np.add.at(total, grams.text, each)
            weight = total // np.maximum(n, 1)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(x, pa.int64()) for x in (grams.words, n, weight))],
                ["doc_id", "n_words", "n_features", "weight"],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    data = F.coalesce("text", F.lit("")).cast("binary").alias("data")
    return docs.select("doc_id", data).mapInArrow(
        weigh, f"doc_id {kind}, n_words long, n_features long, weight long"
    )


def noise(seed: int = SEED):
    """Gumbel noise of a document in thousandths, from 32 bits of a hash of its id."""
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    drawn = F.conv(F.substring(F.sha2(name, 256), 1, 8), 16, 10).cast("double")
    return F.floor(-F.log(-F.log((drawn + 0.5) / F.lit(4294967296.0))) * 1000)


def resample(
    docs: DataFrame, target: DataFrame, percent: int = PERCENT, least_words: int = LEAST_WORDS,
    order: int = 1, buckets: int = BUCKETS, seed: int = SEED,
) -> DataFrame:
    """(doc_id, n_features, weight, score, rank) of every document; those with a rank are drawn.

    Of the documents with at least ``least_words`` words, ``percent`` in a hundred with the highest
    scores are drawn, ranked from 1 by falling score. Join with the documents on ``doc_id`` for texts.
    """
    scratch = Scratch(docs.sparkSession, "resampling")
    weighed = weights(docs, gains(docs, target, order, buckets), order)
    scored, _ = scratch.write(
        weighed.withColumn("score", F.col("weight") + noise(seed)).withColumn("row", F.monotonically_increasing_id())
    )
    long_enough = F.col("n_words") >= least_words
    most = percent * scored.where(long_enough).count() // 100
    falling = [F.col("score").desc(), F.col("doc_id").asc_nulls_last(), F.col("row")]
    placed = numbered(scored.where(long_enough), falling, "place")
    place = F.when(F.col("place") < most, F.col("place") + 1).alias("rank")
    names = ["doc_id", "n_features", "weight", "score"]
    return placed.select(*names, place).unionAll(
        scored.where(~long_enough).select(*names, F.lit(None).cast("long"))
    )
