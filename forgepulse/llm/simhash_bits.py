"""Near-duplicate documents by 64-bit SimHash and bit-sliced comparison.

A fingerprint's bit is the majority of that bit over the hashes of all word shingles. Documents link
when their fingerprints differ in at most ``radius`` bits, and links are followed to components.

Equal fingerprints are one class from the start, so thousands of copies cost one row. Classes that
may be near each other agree in some bands of their bits: with ``radius`` + ``spare`` bands, any two
agree in at least ``spare`` of them, and each choice of ``spare`` bands is a table of buckets. Few wide
bands make few tables, many narrow choices small buckets; the number of classes decides, and any
choice finds every pair.

Within a bucket the fingerprints stand in bit planes, one bit of 64 fingerprints to a machine word.
Shifting the planes by s compares each row with the s-th after it; carry-save counters add up the
differing bits of 64 pairs at a time, and words whose pairs have all exceeded the radius (or are
connected already) are abandoned. Buckets larger than a block are split by hash and compared block by
block, so no task holds an unbounded bucket. A task returns a spanning forest of what it connects.

A NULL or empty text has no words and the fingerprint zero, which links like any other. Equal rows
link. A NULL id never names a component unless all ids in it are NULL. Empty tables give empty results.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from forgepulse.llm.support import Scratch, components, row_slices

SHINGLE_WORDS = 3
RADIUS = 3
SEED = 42
#: Largest bucket that is compared in one piece, and mean bucket from which bands are refined.
BLOCK_ROWS = 2048
MEAN_BUCKET = 256
#: Planes that are counted before words are abandoned.
PLANES_AT_ONCE = 8


def _votes(hashes: np.ndarray) -> np.ndarray:
    """How many of the hashes have each bit, the highest bit first."""
    bits = np.unpackbits(hashes.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)
    sums = np.add.reduceat(bits, np.arange(0, len(bits), 255), axis=0, dtype=np.uint8)
    return sums.sum(axis=0, dtype=np.int64)


def fingerprint(text: str | None, shingle_words: int = SHINGLE_WORDS) -> int:
    """Majority bits of the XXH64 of all shingles of ``shingle_words`` words, as a signed number."""
    from xxhash import xxh64_intdigest

    words = (text or "").encode().lower().split()  # of bytes: ASCII letters and white space only
    if not words:
        return 0
    votes, count, step = np.zeros(64, np.int64), max(1, len(words) - shingle_words + 1), 1 << 16
    for begin in range(0, count, step):
        some = words[begin: min(begin + step, count) + shingle_words - 1]
        runs = zip(*[some[i:] for i in range(min(shingle_words, len(some)))])
        hashes = np.array([xxh64_intdigest(b" ".join(run), SEED) for run in runs], np.uint64)
        votes += _votes(hashes)
    return int(np.packbits(2 * votes > count).view(">i8")[0])


def with_fingerprints(docs: DataFrame, shingle_words: int = SHINGLE_WORDS) -> DataFrame:
    """The columns of ``docs``, of which one is text, and ``fingerprint`` as BIGINT."""
    text_at = docs.columns.index("text")

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in row_slices(batches):
            marks = [fingerprint(t, shingle_words) for t in batch.column(text_at).to_pylist()]
            columns = [*batch.columns, pa.array(marks, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, [*batch.schema.names, "fingerprint"])

    schema = docs.select("*", F.lit(0).cast("long").alias("fingerprint")).schema
    return docs.mapInArrow(add, schema)


class BitPlanes:
    """Fingerprints in vertical layout: word w of plane p holds bit p of rows 64 w to 64 w + 63."""

    def __init__(self, marks: np.ndarray):
        self.rows = len(marks)
        padded = np.zeros(-(-max(self.rows, 1) // 64) * 64 + 64, "<u8")
        padded[: self.rows] = marks
        bits = np.unpackbits(padded.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        columns = np.ascontiguousarray(bits.T)
        self.planes = np.packbits(columns, axis=1, bitorder="little").view("<u8")

    def near(self, shift: int, lanes: np.ndarray, radius: int) -> np.ndarray:
        """Rows r, of those in the bit mask ``lanes``, within ``radius`` bits of row r + shift."""
        word = np.nonzero(lanes)[0]
        alive, skip, bits = lanes[word], shift // 64, np.uint64(shift % 64)
        width = max(1, radius.bit_length())
        # Counters start so that passing the radius overflows them.
        start = (1 << width) - 1 - radius
        counters = [np.full(len(word), -(start >> i & 1) & (2**64 - 1), np.uint64) for i in range(width)]
        for first in range(0, len(self.planes), PLANES_AT_ONCE):
            if not len(word):
                break
            own = self.planes[first: first + PLANES_AT_ONCE]
            low = np.minimum(word + skip, own.shape[1] - 1)
            other = own[:, low]
            if bits:
                high = np.minimum(word + skip + 1, own.shape[1] - 1)
                other = other >> bits | own[:, high] << (np.uint64(64) - bits)
            for carry in own[:, word] ^ other:
                for i, counter in enumerate(counters):
                    counters[i], carry = counter ^ carry, counter & carry
                alive = alive & ~carry
            kept = alive != 0
            if not kept.all():
                word, alive = word[kept], alive[kept]
                counters = [c[kept] for c in counters]
        lanes_of = np.unpackbits(alive.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        at, bit = np.nonzero(lanes_of)
        return word[at] * 64 + bit


def _mask(lanes: np.ndarray) -> np.ndarray:
    full = np.zeros(-(-len(lanes) // 64) * 64, np.uint8)
    full[: len(lanes)] = lanes
    return np.packbits(full, bitorder="little").view("<u8")


def spanning_links(marks: np.ndarray, ends: np.ndarray, radius: int) -> list[tuple[int, int]]:
    """Links that connect, within runs of rows, all that is linked by at most ``radius`` bits.

    Rows of a run stand together; ``ends`` has the end of each row's run.
    """
    rows = len(marks)
    planes, parent, here = BitPlanes(marks), np.arange(rows), np.arange(rows)
    links, longest = [], int((ends - here).max(initial=1))
    active = here
    for shift in range(1, longest):
        active = active[active + shift < ends[active]]
        if not len(active):
            break
        lanes = np.zeros(rows, bool)
        lanes[active[parent[active] != parent[active + shift]]] = True
        found = planes.near(shift, _mask(lanes), radius).tolist()
        if not found:
            continue
        for row in found:
            a, b = row, row + shift
            while parent[a] != a:
                a = parent[a]
            while parent[b] != b:
                b = parent[b]
            if a != b:
                parent[max(a, b)] = min(a, b)
                links.append((row, row + shift))
        while (parent[parent] != parent).any():
            parent = parent[parent]
    return links


def band_tables(classes: int, radius: int = RADIUS) -> list[int]:
    """Bit masks of the tables, so chosen that a mean bucket of random fingerprints is small."""
    for spare in range(1, 64 - radius):
        bands = radius + spare
        edges = [64 * i // bands for i in range(bands + 1)]
        masks = [(1 << edges[i + 1]) - (1 << edges[i]) for i in range(bands)]
        tables = [sum(choice) for choice in combinations(masks, spare)]
        if classes <= MEAN_BUCKET * 2.0 ** min(m.bit_count() for m in tables):
            return tables
    raise ValueError("more fingerprints than a table of 64 bits can hold")


def near_links(marks: DataFrame, radius: int = RADIUS) -> DataFrame:
    """Links (a, b) that connect all of the distinct BIGINTs ``mark`` within ``radius`` bits."""
    tables = band_tables(marks.count(), radius)
    signed = [m - (1 << 64) if m >> 63 else m for m in tables]
    masks = F.array(*[F.lit(m).cast("long") for m in signed])
    keyed = marks.select("mark", F.posexplode(masks).alias("band", "mask")).select(
        "mark", "band", F.col("mark").bitwiseAND(F.col("mask")).alias("key")
    )
    large = keyed.groupBy("band", "key").count().where(F.col("count") > BLOCK_ROWS).select(
        "band", "key", F.ceil(F.col("count") / BLOCK_ROWS).cast("int").alias("blocks")
    )
    # A row of a split bucket meets every block of it, in the pair of its own and that block.
    own = F.pmod(F.xxhash64("mark"), F.col("blocks")).cast("int")
    dealt = keyed.join(large, ["band", "key"], "left").select(
        "mark", "band", "key", own.alias("own"),
        F.explode(F.sequence(F.lit(0), F.coalesce(F.col("blocks"), F.lit(1)) - 1)).alias("other"),
    ).select(
        "band", "key", "mark",
        F.coalesce(F.least("own", "other"), F.lit(0)).alias("i"),
        F.coalesce(F.greatest("own", "other"), F.lit(0)).alias("j"),
    )

    def links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            held.append(batch)
            if sum(b.num_rows for b in held) >= 8 * BLOCK_ROWS:
                done, rest = _whole_runs(pa.Table.from_batches(held))
                held = rest.to_batches()
                if done.num_rows:
                    yield _links_of(done, radius)
        if held:
            yield _links_of(pa.Table.from_batches(held), radius)

    keys = ["band", "key", "i", "j"]
    return (
        dealt.repartition(*keys).sortWithinPartitions(*keys).select(*keys, "mark")
        .mapInArrow(links, "a long, b long")
    )


def _run_numbers(rows: pa.Table) -> np.ndarray:
    """Number of the run of equal keys that each row belongs to."""
    keys = np.stack([rows.column(i).to_numpy().astype(np.int64) for i in range(4)])
    new = np.ones(rows.num_rows, bool)
    new[1:] = (keys[:, 1:] != keys[:, :-1]).any(axis=0)
    return np.cumsum(new) - 1


def _whole_runs(rows: pa.Table) -> tuple[pa.Table, pa.Table]:
    """All runs but the last, which may go on, and the last."""
    run = _run_numbers(rows)
    cut = int(np.searchsorted(run, run[-1]))
    return rows.slice(0, cut), rows.slice(cut)


def _links_of(rows: pa.Table, radius: int) -> pa.RecordBatch:
    run, marks = _run_numbers(rows), rows.column("mark").to_numpy()
    ends = np.cumsum(np.bincount(run))[run]
    found = np.array(spanning_links(marks.view(np.uint64), ends, radius), np.int64).reshape(-1, 2)
    return pa.RecordBatch.from_arrays(
        [pa.array(marks[found[:, 0]]), pa.array(marks[found[:, 1]])], ["a", "b"]
    )


def near_classes(marked: DataFrame, scratch: Scratch, radius: int = RADIUS) -> DataFrame:
    """(fingerprint, component) from rows with ``fingerprint``: component is the least one reached."""
    marks, _ = scratch.write(marked.select(F.col("fingerprint").alias("mark")).distinct())
    links, _ = scratch.write(near_links(marks, radius))
    reached = components(links, "simhash-components")
    return marks.join(reached, marks["mark"] == reached["node"], "left").select(
        F.col("mark").alias("fingerprint"), F.coalesce("component", "mark").alias("component")
    )


def near_duplicates(
    docs: DataFrame, shingle_words: int = SHINGLE_WORDS, radius: int = RADIUS
) -> DataFrame:
    """(doc_id, fingerprint in hexadecimal, component_id) for every row of (doc_id, text)."""
    scratch = Scratch(docs.sparkSession, "simhash")
    marked = with_fingerprints(docs.select("doc_id", "text"), shingle_words)
    marked, _ = scratch.write(marked.select("doc_id", "fingerprint"))
    classes, _ = scratch.write(near_classes(marked, scratch, radius))
    least = marked.groupBy("fingerprint").agg(F.min("doc_id").alias("least"))
    named = classes.join(least, "fingerprint")
    named = named.groupBy("component").agg(F.min("least").alias("component_id")).join(
        classes, "component"
    )
    named, _ = scratch.write(named.select("fingerprint", "component_id"))
    return marked.join(named, "fingerprint").select(
        "doc_id", F.lpad(F.lower(F.hex("fingerprint")), 16, "0").alias("fingerprint"), "component_id"
    )


def without_near_duplicates(
    docs: DataFrame, shingle_words: int = SHINGLE_WORDS, radius: int = RADIUS
) -> DataFrame:
    """One row of each component: that of the least doc_id, NULL last, the first of equal ones."""
    scratch = Scratch(docs.sparkSession, "simhash-keep")
    numbered = docs.select(
        F.struct("*").alias("row"), "doc_id", "text", F.monotonically_increasing_id().alias("number")
    )
    # The numbers are written with the rows, so later reads agree on them.
    marked, _ = scratch.write(with_fingerprints(numbered, shingle_words).drop("text"))
    classes, _ = scratch.write(near_classes(marked.select("fingerprint"), scratch, radius))
    narrow = marked.select("doc_id", "number", "fingerprint")
    rank = F.struct(F.col("doc_id").isNull().alias("unknown"), "doc_id", "number")
    first = narrow.groupBy("fingerprint").agg(F.min(rank).alias("first"))
    kept = classes.join(first, "fingerprint").groupBy("component").agg(F.min("first").alias("first"))
    kept, _ = scratch.write(kept.select(F.col("first.number").alias("number")))
    # Nearly as many numbers as documents: merged at every size, never broadcast.
    return marked.join(kept.hint("merge"), "number", "left_semi").select("row.*")
