"""Which days may hold an event, from bitmaps of the ids that each day holds.

An id is a bit: numeric ids, which feeds count up, are that number modulo ``PLACES``, so a day's ids lie
close together and take a bit each; other ids are a hash, in places of their own. Bits come in buckets
of 32,768. A set bit means that the day may hold the id, a clear one that it does not: days are
ruled out for good, and what is left is decided by the ids themselves.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Places of bits. Ids that are no sequence fill up to 65,536 buckets of 4 KB a day, mostly zeros.
PLACES = 2**31

SCHEMA = "bucket BIGINT, bits BINARY, event_date DATE"


def _place(event_id: str) -> Column:
    """From 1 for numbers, from -1 down for anything else."""
    number = F.col(event_id).try_cast("bigint")
    return F.coalesce(
        1 + F.pmod(number, F.lit(PLACES)), -1 - F.pmod(F.xxhash64(event_id), F.lit(PLACES))
    )


def id_bits(rows: DataFrame, day: str = "event_date") -> DataFrame:
    """(bucket, bits, day) of the ``event_id`` of rows."""
    place = _place("event_id")
    return rows.where(F.col("event_id").isNotNull()).groupBy(
        F.bitmap_bucket_number(place).alias("bucket"), day
    ).agg(F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("bits")).select("bucket", "bits", day)


def may_be_held(ids: DataFrame, held: DataFrame, day: str = "event_date") -> DataFrame:
    """(event_id, day): other days than its own on which an id of (event_id, day) may be held.

    Only buckets within the range of the ids are read; a bitmap meets the ids of its bucket, and a
    bucket that many days and ids share is a skewed join, which adaptive execution splits.
    """
    place = _place("event_id")
    asked = ids.select(
        "event_id", F.col(day).alias("own"), F.bitmap_bucket_number(place).alias("bucket"),
        F.bitmap_bit_position(place).alias("position"),
    )
    low, high = asked.agg(F.min("bucket"), F.max("bucket")).first()
    if low is None:
        return ids.select("event_id", day).limit(0)
    near = held.where(F.col("bucket").between(low, high))
    byte = F.substring("bits", (F.col("position") / 8).cast("int") + 1, F.lit(1))
    bit = F.getbit(F.conv(F.hex(byte), 16, 10).cast("int"), (F.col("position") % 8).cast("int"))
    return (
        asked.join(near, "bucket").where((bit == 1) & (F.col(day) != F.col("own")))
        .select("event_id", day).distinct()
    )
