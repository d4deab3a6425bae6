"""Mixing sources to target weights along a time-varying curriculum.

A source takes part with a weight that changes linearly over the run. Integrated over time the
weights give the source's cumulative demand for words; a copy of a document that begins at a given
cumulative word of its source is trained on when the demand reaches that word, so the inverse of the
integral is its position. Sorting all copies by position by range yields the training order.

Rows: a document of unknown size counts as empty, an empty one takes no place, a NULL source is a
source of its own, and equal rows are separate documents. An empty table mixes to an empty table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Weights of the sources by rank, repeating.
WEIGHTS = (5, 2, 1)
#: A document is taken at most so many times.
MOST_COPIES = 3
#: Weight at the start and at the end of the run by rank, repeating, relative to the source's mean.
SCHEDULE = ((1.5, 0.5), (1.0, 1.0), (0.5, 1.5))
#: Hexadecimal digits of the order key by which a source is dealt into buckets; a bucket of a
#: source is what one task sorts, so a hot source is split 4096 times.
BUCKET_DIGITS = 3

WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: str | Column) -> Column:
    """Words of a text between ASCII white space; NULL has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(per_source: DataFrame, weights=WEIGHTS, most=MOST_COPIES) -> DataFrame:
    """Words that each source is to give: (source_key, source_size, rank, target).

    All words are shared out by weight; a source that would be above ``most`` times its size stops
    there and the others share the rest. In the order of size by weight the stopped sources come
    first, so one pass finds the share of the others. The table has a row for each source.
    """
    by_key = Window.orderBy("source_key")
    by_need = Window.orderBy(F.col("source_size") / F.col("weight"), "source_key")
    before = by_need.rowsBetween(Window.unboundedPreceding, -1)
    ahead = by_need.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    everything = Window.partitionBy()
    weight = F.element_at(
        F.array(*map(F.lit, weights)), (F.col("rank") % len(weights) + 1).cast("int")
    )
    cap = F.col("source_size") * most
    ranked = (
        per_source.withColumn("rank", F.row_number().over(by_key) - 1)
        .withColumn("weight", weight.cast("long"))
        .withColumn("rest", F.sum("source_size").over(everything)
                    - F.coalesce(F.sum(cap).over(before), F.lit(0)))
        .withColumn("weights", F.sum("weight").over(ahead))
        .withColumn("free", cap * F.col("weights") > F.col("weight") * F.col("rest"))
        .withColumn("place", F.row_number().over(by_need))
    )
    first_free = F.min_by(F.struct("rest", "weights", "place"), F.when(F.col("free"), F.col("place")))
    share = ranked.withColumn("first", first_free.over(everything))
    shared = (F.col("weight") * F.col("first.rest")).cast("double") / F.col("first.weights")
    target = F.when(F.col("place") >= F.col("first.place"), shared).otherwise(cap.cast("double"))
    return share.select("source_key", "source_size", "rank", target.alias("target"))


def _position(share: Column, start: Column, end: Column) -> Column:
    """Time at which the demand with weights from ``start`` to ``end`` reaches ``share``."""
    a = (end - start) / (end + start)
    root = F.sqrt((1 - a) * (1 - a) + 4 * a * share)
    return F.when(F.abs(a) < 1e-9, share).otherwise((root - (1 - a)) / (2 * a))


def mix(
    sized: DataFrame, size: str, source: str, order_key: Column,
    weights=WEIGHTS, most=MOST_COPIES, schedule=SCHEDULE,
) -> DataFrame:
    """``row`` (all columns of the input), source_size, target, taken and the copies of each row.

    ``order_key`` is a hexadecimal text that spreads the rows; within a source, rows are laid out by
    it, round after round, up to the target. A copy has its round, its words and its position from 0
    to 1. No task sees more than a bucket of a source, and no row beside the order key is sorted
    globally: bucket totals are added up first.
    """
    key = F.coalesce(F.concat(F.lit("="), F.col(source)), F.lit("~"))
    keyed = sized.select(
        F.struct("*").alias("row"), key.alias("source_key"), F.col(size).alias("words"),
        order_key.alias("order_key"),
    ).withColumn("bucket", F.substring("order_key", 1, BUCKET_DIGITS))
    totals = keyed.groupBy("source_key", "bucket").agg(F.sum("words").alias("bucket_words"))
    per_source = totals.groupBy("source_key").agg(F.sum("bucket_words").alias("source_size"))
    earlier = Window.partitionBy("source_key").orderBy("bucket").rowsBetween(
        Window.unboundedPreceding, -1
    )
    starts = totals.select(
        "source_key", "bucket",
        F.coalesce(F.sum("bucket_words").over(earlier), F.lit(0)).alias("bucket_start"),
    ).join(targets(per_source, weights, most), "source_key")

    inside = Window.partitionBy("source_key", "bucket").orderBy("order_key", "words").rowsBetween(
        Window.unboundedPreceding, -1
    )
    begin = F.col("bucket_start") + F.coalesce(F.sum("words").over(inside), F.lit(0))
    placed = keyed.join(starts, ["source_key", "bucket"]).withColumn("begin", begin)

    ramp = F.element_at(
        F.array(*[F.struct(F.lit(float(a)).alias("start"), F.lit(float(b)).alias("end"))
                  for a, b in schedule]),
        (F.col("rank") % len(schedule) + 1).cast("int"),
    )
    limit = F.floor(F.least(F.col("target"), F.col("source_size") * most))

    def copy(turn: int) -> Column:
        first = F.col("begin") + turn * F.col("source_size")
        words = F.greatest(F.lit(0), F.least(F.col("words"), limit - first)).cast("long")
        position = _position(first / F.col("target"), ramp["start"], ramp["end"])
        return F.struct(
            F.lit(turn).alias("round"), words.alias("words"), position.alias("position")
        )

    copies = F.filter(F.array(*[copy(t) for t in range(most)]), lambda c: c["words"] > 0)
    return placed.withColumn("copies", copies).select(
        "row", "source_size", "target",
        F.aggregate("copies", F.lit(0).cast("long"), lambda n, c: n + c["words"]).alias("taken"),
        "copies", "order_key",
    )


def in_training_order(mixed: DataFrame) -> DataFrame:
    """Rows of ``mix`` sorted by range by the position of their first copy; rows not taken last."""
    first = F.get("copies", F.lit(0))["position"]
    order = [F.col("position").asc_nulls_last(), F.col("order_key")]
    return (
        mixed.withColumn("position", first).repartitionByRange(*order).sortWithinPartitions(*order)
    )


def copies_in_training_order(mixed: DataFrame) -> DataFrame:
    """One row per copy, sorted by range by position: the order in which they are trained on."""
    order = ["position", "order_key"]
    return (
        mixed.select("row", "order_key", F.inline("copies"))
        .repartitionByRange(*order).sortWithinPartitions(*order)
    )


def mixed_documents(docs: DataFrame, order_key: Column) -> DataFrame:
    """The columns of ``docs``, a row for each copy that the mix takes, in training order; copies are
    whole documents, so a source's words meet its target to within one document."""
    sized = docs.select(
        F.struct("*").alias("doc"), "source", word_count("text").alias("size"), order_key.alias("key")
    )
    copies = copies_in_training_order(mix(sized, "size", "source", F.col("key")))
    return copies.select("row.doc.*")


def id_key(doc_id: str | Column = "doc_id") -> Column:
    """Order key of a row from its id, the same in every run."""
    text = F.coalesce(F.col(doc_id).cast("string") if isinstance(doc_id, str) else doc_id, F.lit(""))
    return F.md5(F.concat(F.lit("mix:"), text).cast("binary"))
