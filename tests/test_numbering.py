from __future__ import annotations

from pyspark.sql import functions as F

from forgepulse.operators.numbering import numbered
from tests.helpers import plan_of


def test_places_follow_the_order_over_several_ranges(spark):
    rows = spark.range(20_000).select(F.pmod(F.xxhash64("id"), F.lit(50)).alias("key"), "id", F.lit("x").alias("other"))
    found = numbered(rows, [F.col("key").desc(), F.col("id")], "place")
    want = sorted(((r["key"], r["id"]) for r in rows.collect()), key=lambda r: (-r[0], r[1]))
    assert [(r["key"], r["id"]) for r in found.orderBy("place").collect()] == want
    assert [r["place"] for r in found.orderBy("place").collect()] == list(range(20_000))
    assert found.columns == ["key", "id", "other", "place"]
    assert "SinglePartition" not in plan_of(found) and "Window" not in plan_of(found)


def test_nothing_to_number(spark):
    assert numbered(spark.createDataFrame([], "a INT"), [F.col("a")]).count() == 0


def test_nulls_take_the_place_that_the_order_gives_them(spark):
    rows = spark.createDataFrame([(None,), (2,), (1,)], "a INT")
    found = numbered(rows, [F.col("a").asc_nulls_last()]).collect()
    assert {r["a"]: r["number"] for r in found} == {1: 0, 2: 1, None: 2}
