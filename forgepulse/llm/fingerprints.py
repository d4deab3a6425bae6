"""Document fingerprints: SimHash over weighted terms, in DataFrame operations only.

Terms are pairs of neighbouring words; a term weighs as often as it occurs. Each of its hash bits
votes with that weight, for 1 or against it, and the signs of the sums are the fingerprint's 128 bits.
Votes are counted below the document's row, so a shuffle carries one row a document and not its terms.

Fingerprints within a Hamming radius are found with permuted block tables: of radius + 1 blocks, two
such fingerprints agree in at least one, so each table leads with one block and is joined on it alone.

A NULL or empty text has one empty term. Equal texts have equal fingerprints. Neighbours in order of
doc_id are found without a global sort: rows are dealt into ranges of ids, and the first row of each
range is added as a guest to the range before it. Ids that are NULL come last in falling order; rows
with equal ids follow each other by a hash of their text. Empty tables give empty results.
"""

from __future__ import annotations

from math import isqrt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from forgepulse.llm.support import Scratch

BITS = 128
RADIUS = 3
_HALF = 32
_LEAST_ID = -(2**63)


def _terms(text: Column) -> Column:
    """Pairs (word, next word) of a text; the last word is paired with NULL."""
    words = F.split(F.coalesce(text, F.lit("")), r"\s+")
    return F.arrays_zip(words.alias("w"), F.slice(words, F.lit(2), F.size(words)).alias("next"))


def _hashes() -> tuple[Column, Column]:
    return F.xxhash64("first", "second"), F.xxhash64("first", "second", F.lit(1))


def _votes() -> list[Column]:
    """Weights for each bit. A sum holds those of two bits, as no document has 2^32 terms."""
    sums = []
    for name in ("high", "low"):
        for bit in range(_HALF):
            pair = F.shiftrightunsigned(name, bit).bitwiseAND(F.lit((1 << _HALF) + 1))
            sums.append(F.sum(pair).alias(f"{name}{bit}"))
    return sums


def _signs(name: str) -> Column:
    """64 bits from the sums: a bit is 1 where its votes for 1 outweigh those against."""
    word = F.lit(0).cast("long")
    for bit in range(_HALF):
        sums = F.col(f"{name}{bit}")
        for shift, votes in (
            (bit, sums.bitwiseAND(F.lit((1 << _HALF) - 1))),
            (bit + _HALF, F.shiftrightunsigned(sums, _HALF)),
        ):
            value = 1 << shift
            value -= (1 << 64) if shift == 63 else 0
            word = word.bitwiseOR(F.when(2 * votes > F.col("weight"), F.lit(value)).otherwise(F.lit(0)).cast("long"))
    return word


def fingerprints(texts: DataFrame, keys: list[str], text: str) -> DataFrame:
    """``keys`` and ``mark``, the fingerprint (high, low) of ``text``; the keys must name a row."""
    term = texts.select(*keys, F.inline(_terms(F.col(text))).alias("first", "second"))
    high, low = _hashes()
    counted = term.select(*keys, high.alias("high"), low.alias("low")).groupBy(*keys).agg(
        F.count(F.lit(1)).alias("weight"), *_votes()
    )
    return counted.select(*keys, F.struct(_signs("high").alias("high"), _signs("low").alias("low")).alias("mark"))


def distance(a: Column, b: Column) -> Column:
    return F.bit_count(a["high"].bitwiseXOR(b["high"])) + F.bit_count(a["low"].bitwiseXOR(b["low"]))


def likeness(a: Column, b: Column) -> Column:
    """Share of equal bits, from 0 to 1."""
    return 1 - distance(a, b) / F.lit(float(BITS))


def hexadecimal(mark: Column) -> Column:
    return F.lower(F.concat(F.lpad(F.hex(mark["high"]), 16, "0"), F.lpad(F.hex(mark["low"]), 16, "0")))


def _blocks(mark: Column, radius: int) -> Column:
    """(table, block) for each of radius + 1 blocks of the bits."""
    edges = [BITS * i // (radius + 1) for i in range(radius + 2)]
    blocks = []
    for number, (low, high) in enumerate(zip(edges, edges[1:])):
        parts = []
        for name, base in (("low", 0), ("high", 64)):
            some = range(max(low - base, 0), min(high - base, 64))
            if len(some):
                mask = sum(1 << i for i in some)
                mask -= (1 << 64) if mask >> 63 else 0
                parts.append(mark[name].bitwiseAND(F.lit(mask).cast("long")))
        block = F.array(*parts, *[F.lit(0).cast("long")] * (2 - len(parts)))
        blocks.append(F.struct(F.lit(number).alias("table"), block.alias("block")))
    return F.array(*blocks)


def near(marks: DataFrame, queries: DataFrame, radius: int = RADIUS) -> DataFrame:
    """(mark, near): for each distinct query the rows of ``marks`` (mark, rows) within the radius.

    Both sides have distinct marks, so copies are compared once. A pair counts in the first table
    whose block it shares.
    """
    asked = queries.select("mark").distinct().select(
        F.col("mark").alias("asked"), F.inline(_blocks(F.col("mark"), radius))
    )
    held = marks.select("mark", "rows", F.inline(_blocks(F.col("mark"), radius)))
    own, other = _blocks(F.col("asked"), radius), _blocks(F.col("mark"), radius)
    earlier = F.lit(False)
    for number in range(radius):
        same = (F.col("table") > number) & (F.get(own, F.lit(number)) == F.get(other, F.lit(number)))
        earlier = earlier | same
    pairs = asked.join(held, ["table", "block"]).where(
        (distance(F.col("asked"), F.col("mark")) <= radius) & ~earlier
    )
    return pairs.groupBy("asked").agg(F.sum("rows").alias("near")).withColumnRenamed("asked", "mark")


def _range_of(key: Column, splitters: list[int]) -> Column:
    """How many of the sorted splitters are at most ``key``, looked up in two steps."""
    if not splitters:
        return F.lit(0)
    step = isqrt(len(splitters)) + 1
    groups = [splitters[i: i + step] for i in range(0, len(splitters), step)]
    longs = lambda values: F.array(*[F.lit(v).cast("long") for v in values])
    group = F.size(F.filter(longs([g[0] for g in groups[1:]] or [2**63 - 1]), lambda s: s <= key))
    group = F.least(group, F.lit(len(groups) - 1))
    inner = F.get(F.array(*[longs(g) for g in groups]), group)
    return group * step + F.size(F.filter(inner, lambda s: s <= key))


def with_next(docs: DataFrame, ranges: int | None = None) -> DataFrame:
    """(range, nth, guest, doc_id, text, next_text): rows in falling order of doc_id with the text
    that follows, after the last one that of the first.

    The texts are shuffled once. Rows marked as guests stand in a range only to be next to its last
    row; they have no next text of their own. The driver sees two numbers for each range.
    """
    ranges = ranges or int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    key = F.coalesce(F.col("doc_id"), F.lit(_LEAST_ID))
    shares = F.array(*[F.lit(i / ranges) for i in range(1, max(2, ranges))])
    found = docs.agg(F.percentile_approx(key, shares, 10 * ranges).alias("splitters")).first()
    splitters = sorted(set(found["splitters"] or []))
    own = _range_of(key, splitters).cast("long")
    greatest = docs.select(own.alias("range"), key.alias("key")).groupBy("range").agg(
        F.max("key").alias("first")
    )
    # In falling order, the first row of a range follows the last row of the next higher range with
    # rows, and the first row of all follows the last row of the lowest one.
    heads = sorted((r["range"], r["first"]) for r in greatest.collect())
    first, host = [None] * (len(splitters) + 1), [None] * (len(splitters) + 1)
    for (number, head), (above, _) in zip(heads, heads[1:] + heads[:1]):
        first[number], host[number] = head, above
    longs = lambda values: F.array(*[F.lit(v).cast("long") for v in values])
    is_head = F.get(longs(first), F.col("own").cast("int")) == F.col("key")
    stays = F.struct(F.col("own").alias("range"), F.lit(False).alias("guest"))
    visits = F.struct(F.get(longs(host), F.col("own").cast("int")).alias("range"), F.lit(True).alias("guest"))
    dealt = docs.select(
        "doc_id", "text", key.alias("key"), F.xxhash64("text").alias("tie"), own.alias("own")
    ).select(
        "doc_id", "text", "key", "tie",
        F.inline(F.when(is_head, F.array(stays, visits)).otherwise(F.array(stays))),
    )
    order = Window.partitionBy("range").orderBy("guest", F.col("key").desc(), "tie", "text")
    return dealt.select(
        "range", F.row_number().over(order).alias("nth"), "guest", "doc_id", "text",
        F.lead(F.coalesce("text", F.lit(""))).over(order).alias("next_text"),
    )


def edited(text: Column, next_text: Column) -> Column:
    """The text with its last half replaced by the beginning of the next one."""
    text = F.coalesce(text, F.lit(""))
    half = F.floor(F.char_length(text) / 2).cast("int")
    return F.concat(F.substring(text, F.lit(1), F.char_length(text) - half), F.substring(next_text, F.lit(1), half))


def compare_with_edits(docs: DataFrame, radius: int = RADIUS, query_every: int = 100) -> DataFrame:
    """For every row of (doc_id, text): n_chars, edited_sha256, the fingerprints of the text and of its
    edited form, their likeness, the likeness to the next document, and, for ids divisible by
    ``query_every``, how many other documents are within ``radius`` bits."""
    scratch = Scratch(docs.sparkSession, "fingerprints")
    placed = with_next(docs.select("doc_id", "text"))
    text, after = F.col("text"), edited(F.col("text"), F.col("next_text"))
    both = placed.select(
        "range", "nth", "guest", "doc_id", F.char_length(F.coalesce(text, F.lit(""))).cast("long").alias("n_chars"),
        text, F.when(~F.col("guest"), after).alias("after"),
    ).withColumn("edited_sha256", F.sha2(F.col("after").cast("binary"), 256))
    row = ["range", "nth", "guest", "doc_id", "n_chars", "edited_sha256"]
    forms = F.array(
        F.struct(F.lit(False).alias("changed"), text.alias("form")),
        F.struct(F.lit(True).alias("changed"), F.col("after").alias("form")),
    )
    forms = both.select(*row, F.inline(forms)).where(~(F.col("guest") & F.col("changed")))
    marked, _ = scratch.write(fingerprints(forms, [*row, "changed"], "form"))

    order = Window.partitionBy("range").orderBy("nth")
    rows = marked.groupBy(*row).agg(
        F.max(F.when(~F.col("changed"), F.col("mark"))).alias("mark"),
        F.max(F.when(F.col("changed"), F.col("mark"))).alias("edited"),
    ).withColumn("next", F.lead("mark").over(order)).where(~F.col("guest"))
    rows, _ = scratch.write(rows)
    classes = rows.groupBy("mark").agg(F.count(F.lit(1)).alias("rows"))
    is_query = F.coalesce(F.col("doc_id") % query_every == 0, F.lit(False))
    found = near(classes, rows.where(is_query), radius)
    return rows.join(found, "mark", "left").select(
        "doc_id", "n_chars", "edited_sha256", hexadecimal(F.col("mark")).alias("fingerprint"),
        hexadecimal(F.col("edited")).alias("edited_fingerprint"),
        likeness(F.col("mark"), F.col("edited")).alias("near_edited"),
        likeness(F.col("mark"), F.col("next")).alias("near_next"),
        F.when(is_query, F.col("near") - 1).alias("n_near"),
    )
