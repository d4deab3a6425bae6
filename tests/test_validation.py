from __future__ import annotations

import pytest

from forgepulse.operators.validation import (
    REASONS, valid_records, validation_summary, with_reasons,
)
from tests.helpers import feed_event, raw

ACTOR = {"id": 7, "login": "ann", "url": "u"}
REPO = {"id": 3, "name": "n", "url": "u"}

VALID = [
    feed_event(),
    feed_event(actor={**ACTOR, "display_login": "Ann"}),
    feed_event(actor={**ACTOR, "display_login": None}),
    feed_event(actor={**ACTOR, "id": "12"}),
    feed_event(unknown={"a": 1}, payload=None),
    feed_event(created_at="2024-01-05T10:00:00+02:00"),
]
INVALID = [
    (feed_event(id=None), ["id"]),
    (feed_event(id=5), ["id"]),
    (feed_event(type=None), ["type"]),
    (feed_event(type=["PushEvent"]), ["type"]),
    (feed_event(created_at=None), ["created_at"]),
    (feed_event(created_at="soon"), ["created_at"]),
    (feed_event(actor=None), ["actor.id", "actor.login", "actor.url"]),
    (feed_event(actor="ann"), ["actor.id", "actor.login", "actor.url"]),
    (feed_event(actor={**ACTOR, "id": "x"}), ["actor.id"]),
    (feed_event(actor={**ACTOR, "login": 5}), ["actor.login"]),
    (feed_event(actor={**ACTOR, "display_login": 5}), ["actor.display_login"]),
    (feed_event(actor={**ACTOR, "display_login": {"a": 1}}), ["actor.display_login"]),
    (feed_event(repo={"id": None, "name": "n"}), ["repo.id", "repo.url"]),
    (feed_event(repo={**REPO, "name": None}), ["repo.name"]),
    ("[1]", [r for r in REASONS if r != "actor.display_login"]),
    ("null", [r for r in REASONS if r != "actor.display_login"]),
]


@pytest.fixture(scope="module")
def checked(spark):
    return with_reasons(raw(spark, VALID + [e for e, _ in INVALID])).collect()


def test_valid_records_have_no_reasons(checked):
    assert [r["reasons"] for r in checked[: len(VALID)]] == [[]] * len(VALID)


def test_every_broken_rule_is_named(checked):
    assert [r["reasons"] for r in checked[len(VALID):]] == [reasons for _, reasons in INVALID]


def test_filter_keeps_records_unchanged(spark):
    everything = raw(spark, VALID + [e for e, _ in INVALID])
    kept = valid_records(everything)
    assert kept.columns == everything.columns
    text = kept.selectExpr("to_json(raw_data) AS t").collect()
    assert len(text) == len(VALID) and any('"unknown":{"a":1}' in r["t"] for r in text)


def test_summary_counts_rules_and_records(spark):
    found = {r["reason"]: r["records"] for r in validation_summary(
        raw(spark, VALID + [e for e, _ in INVALID])).collect()}
    assert found["valid"] == len(VALID) and found["any"] == len(INVALID)
    assert found["repo.url"] == 3
    assert set(found) == {*REASONS, "any", "valid"}
