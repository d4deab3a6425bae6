from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from forgepulse.operators import quality as Q
from forgepulse.plans import models
from tests.helpers import staged


def results(spark, events):
    stg = staged(spark, events)
    top = models.top_contributors(models.contributor_stats(stg))
    return Q.model_results(stg, models.daily_activity(stg), top, models.event_trends(stg))


def test_clean_rows_pass_all_checks(spark):
    found = Q.gate(results(spark, [{"at": "2024-01-01 00:00:00"}]))
    assert found.count() == 12 and found.agg(F.sum("failures")).first()[0] == 0


def test_gate_names_what_failed(spark):
    events = [
        {"id": "1", "at": "2024-01-01 00:00:00"}, {"id": "1", "at": None}, {"id": None, "actor": None},
    ]
    with pytest.raises(Q.QualityError) as error:
        Q.gate(results(spark, events))
    message = str(error.value)
    assert "unique(stg_events.event_id)=1" in message
    assert "not_null(stg_events.event_id)=1" in message
    assert "not_null(event_trends.event_hour)=1" in message
    assert "not_null(top_contributors.contributor)=1" in message


def test_results_of_the_other_checks(spark):
    frame = spark.createDataFrame([("a", 1), ("b", 1), ("c", 2), (None, 2)], "k STRING, d INT")
    assert Q.accepted_result(frame, "m", "k", ["a"]).first()["failures"] == 2
    assert Q.accepted_result(frame, "m", "k", ["a", "b", "c"]).first()["failures"] == 0
    parents = spark.createDataFrame([("a",)], "p STRING")
    assert Q.relationship_result(frame, "m", "k", parents, "p").first()["failures"] == 2
    assert Q.row_count_result(frame, "m", "d", 2).first()["failures"] == 0
    assert Q.row_count_result(frame, "m", "d", 3).first()["failures"] == 2
    assert Q.row_count_result(frame.limit(0), "m", "d").first()["failures"] == 1


def test_unique_ignores_nulls(spark):
    frame = spark.createDataFrame([("a",), ("a",), ("b",), (None,), (None,)], "k STRING")
    assert [tuple(r) for r in Q.duplicate_keys(frame, "k").collect()] == [("a", 2)]


def test_accepted_values(spark):
    frame = spark.createDataFrame([("a",), ("c",), ("c",), (None,)], "k STRING")
    assert [tuple(r) for r in Q.unexpected_values(frame, "k", ["a", "b"]).collect()] == [("c", 2)]


def test_orphans(spark):
    child = spark.createDataFrame([(1,), (2,), (2,), (None,)], "c BIGINT")
    parent = spark.createDataFrame([(1,), (1,), (None,)], "p BIGINT")
    assert [tuple(r) for r in Q.orphans(child, "c", parent, "p").collect()] == [(2, 2)]


def test_row_counts(spark):
    frame = spark.createDataFrame([("x",), ("x",), ("y",)], "d STRING")
    found = {r["d"]: r["passed"] for r in Q.row_counts(frame, "d", 2).collect()}
    assert found == {"x": True, "y": False}


def test_require_rows(spark):
    assert Q.require_rows(spark.range(3)).first()["event_count"] == 3
    with pytest.raises(Exception, match="no events extracted"):
        Q.require_rows(spark.range(0)).collect()
