from __future__ import annotations

import random

from pyspark.sql import functions as F

from forgepulse.operators import id_bitmaps
from forgepulse.operators.id_bitmaps import id_bits, may_be_held

SCHEMA = "event_id STRING, event_date STRING"


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).withColumn("event_date", F.to_date("event_date"))


def test_no_day_that_holds_an_id_is_ruled_out(spark):
    rng = random.Random(3)
    def ids(count):
        return [rng.choice([str(rng.randrange(-50, 10**5)), str(rng.randrange(2**62, 2**64)), f"id-{rng.randrange(500)}"]) for _ in range(count)]

    held = [(i, f"2024-01-{rng.randrange(1, 6):02d}") for i in ids(3000)] + [("", "2024-01-01"), (None, "2024-01-02")]
    new = [(i, f"2024-01-{rng.randrange(3, 9):02d}") for i in ids(1000)] + [("", "2024-01-02"), (None, "2024-01-03")]
    found = {(r[0], str(r[1])) for r in may_be_held(frame(spark, new), id_bits(frame(spark, held))).collect()}
    want = {(i, d) for i, d in held for j, e in new if i is not None and i == j and d != e}
    assert want <= found
    assert len(found - want) < 30  # numbers beyond 2^31 fold onto others


def test_a_sequence_takes_a_bit_an_id_and_names_its_days_exactly(spark):
    held = spark.range(1, 400_001).selectExpr("cast(id AS STRING) AS event_id", "date_add(DATE'2024-01-01', cast(id / 100000 AS INT)) AS event_date")
    bits = id_bits(held)
    assert bits.count() <= 13 + 4
    new = spark.range(250_000, 250_010).unionAll(spark.range(900_000, 900_010)).selectExpr("cast(id AS STRING) AS event_id", "DATE'2024-02-01' AS event_date")
    found = sorted((r[0], str(r[1])) for r in may_be_held(new, bits).collect())
    assert found == [(str(n), "2024-01-03") for n in range(250_000, 250_010)]


def test_nothing_new_and_nothing_held(spark):
    empty = spark.createDataFrame([], "event_id STRING, event_date DATE")
    none = spark.createDataFrame([], id_bitmaps.SCHEMA)
    assert may_be_held(empty, none).count() == 0
    assert may_be_held(frame(spark, [("1", "2024-01-01")]), none).count() == 0
    assert id_bits(empty).count() == 0
