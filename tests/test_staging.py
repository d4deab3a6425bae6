"""Casting rules of the staging relation, on records in flight and on a stored raw table.

Over a stored table Spark moves the casts into the scan; both must behave alike.
"""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from forgepulse.operators.staging import stg_events, wrong_types
from forgepulse.operators.validation import valid_records
from forgepulse.session import settle
from tests.helpers import by_key, feed_event, raw

ACTOR = {"id": "x", "login": "l", "url": "u"}


@pytest.fixture(params=["in flight", "stored"])
def source(request, spark):
    def build(events):
        frame = raw(spark, events)
        return settle(frame, "raw") if request.param == "stored" else frame

    return build


def test_values_and_types(source):
    event = feed_event(
        5, _extracted_at="2024-01-06T00:00:00Z", _source_repo="org/r", created_at="2024-01-05T10:00:00.25Z"
    )
    frame = stg_events(source([event]))
    row = frame.first()
    assert len(frame.columns) == 15
    assert (row["event_id"], row["actor_id"], row["repo_id"]) == ("5", 7, 3)
    assert row["event_timestamp"] == dt.datetime(2024, 1, 5, 10, 0, 0, 250_000)
    assert row["extracted_at"] == dt.datetime(2024, 1, 6)
    assert (row["push_commit_count"], row["is_star_event"], row["source_repo"]) == (2, 0, "org/r")
    assert frame.selectExpr("to_json(payload)").first()[0] == '{"size":2}'


def test_missing_and_null_are_null(source):
    row = stg_events(source([{"id": None, "type": "WatchEvent"}, ])).first()
    assert row["event_id"] is None and row["actor_id"] is None and row["payload"] is None
    assert row["is_star_event"] == 1
    assert stg_events(source([{}])).first()["is_star_event"] == 0


def test_payload_is_read_only_for_its_event_type(source):
    events = [
        feed_event(1, payload={"size": 4, "action": "opened"}),
        feed_event(2, type="IssuesEvent", payload={"size": "not a number", "action": "closed"}),
        feed_event(3, type="PullRequestEvent", payload={"size": 1, "action": "reopened"}),
    ]
    found = by_key(stg_events(source(events)), "event_id")
    assert [found[i]["push_commit_count"] for i in "123"] == [4, None, None]
    assert [found[i]["issue_action"] for i in "123"] == [None, "closed", None]
    assert [found[i]["pr_action"] for i in "123"] == [None, None, "reopened"]


@pytest.mark.parametrize(
    "event", [feed_event(2, payload={"size": "many"}), feed_event(2, _extracted_at="soon"),
              feed_event(2, actor=ACTOR), feed_event(2, created_at="soon")],
)
def test_wrong_types_abort_or_become_null(source, event):
    frame = source([feed_event(1), event])
    assert stg_events(frame, strict=False).count() == 2
    assert stg_events(frame, strict=False).where("event_id = '2'").drop("payload").first()
    with pytest.raises(Exception, match="is not a (bigint|timestamp_ntz)"):
        stg_events(frame).drop("payload").collect()


def test_invalid_records_cannot_abort_a_run(source):
    events = [feed_event(1), feed_event(2, actor=ACTOR), feed_event(3, created_at="soon")]
    kept = stg_events(valid_records(source(events)), strict=False)
    assert [r["event_id"] for r in kept.collect()] == ["1"]
    assert kept.where("event_timestamp > TIMESTAMP_NTZ '2020-01-01'").where("actor_id = 7").count() == 1


def test_wrong_types_are_counted_per_column(source):
    events = [
        feed_event(1),
        feed_event(2, payload={"size": "many"}, _extracted_at="soon"),
        feed_event(3, type="IssuesEvent", payload={"size": "many"}),
        feed_event(4, type=None, payload={"size": "many"}),
        feed_event(5, actor=ACTOR, payload={"size": None}),
    ]
    flags = wrong_types()
    counts = source(events).agg(*[F.count_if(c).alias(n) for n, c in flags.items()]).first()
    assert counts.asDict() == {
        "actor_id": 1, "repo_id": 0, "event_timestamp": 0, "extracted_at": 1, "push_commit_count": 1
    }
