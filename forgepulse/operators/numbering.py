"""Places of rows in a total order, without a window over all of them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from forgepulse.session import settle

#: ``monotonically_increasing_id`` holds the partition above this bit and the place in it below.
_PLACE_BITS = 33


def numbered(df: DataFrame, order: Sequence[Column], name: str = "number") -> DataFrame:
    """``df`` with the place of each row in ``order``, from 0, as BIGINT ``name``.

    Rows are dealt into ranges of the order and sorted there; a row's number is its place in its
    range behind the rows of the ranges before it. Only the sizes of the ranges, as many as shuffle
    partitions, reach the driver. End ``order`` with a column that tells all rows apart: rows that
    tie cannot be split between ranges, and a repeated run would order them anew.
    """
    spark, columns = df.sparkSession, df.columns
    dealt = df.repartitionByRange(*order).sortWithinPartitions(*order)
    placed = settle(dealt.withColumn("__at", F.monotonically_increasing_id()), "numbered")
    placed = placed.withColumn("__range", F.shiftright("__at", _PLACE_BITS))
    sizes = sorted(
        (r["__range"], r["n"]) for r in placed.groupBy("__range").agg(F.count(F.lit(1)).alias("n")).collect()
    )
    before, offsets = 0, []
    for number, size in sizes:
        offsets.append((number, before - (number << _PLACE_BITS)))
        before += size
    shift = spark.createDataFrame(offsets, "__range BIGINT, __shift BIGINT")
    return placed.join(F.broadcast(shift), "__range").select(
        *columns, (F.col("__at") + F.col("__shift")).alias(name)
    )
