"""The models against plain Python on random events with missing values in every field."""

from __future__ import annotations

import datetime as dt
import random
from collections import defaultdict

import pytest

from forgepulse import schemas as S
from forgepulse.plans import insights, models
from tests.helpers import by_key, staged

KINDS = [*S.EVENT_TYPES, "GollumEvent", None]


def random_events(seed: int) -> list[dict]:
    rng = random.Random(seed)
    start = dt.datetime(2023, 12, 25)
    events = []
    for _ in range(600):
        kind = rng.choice(KINDS)
        at = start + dt.timedelta(minutes=rng.randint(0, 60 * 24 * 40))
        events.append(
            {
                "type": kind,
                # One repository holds half of all events.
                "repo": rng.choice(["hot", "hot", "hot", "a", "b", None]),
                "actor": rng.choice([None, *[f"u{min(i, 9)}" for i in range(14)]]),
                "at": None if rng.random() < 0.05 else str(at),
                "size": rng.choice([None, 0, 1, 5]) if kind == S.PUSH else None,
            }
        )
    return events


def groups(events, key):
    found = defaultdict(list)
    for event in events:
        found[key(event)].append(event)
    return found


def moment(event):
    return dt.datetime.fromisoformat(event["at"]) if event["at"] else None


def day(event):
    return moment(event).date() if event["at"] else None


def hour(event):
    return moment(event).replace(minute=0) if event["at"] else None



def commits(events):
    """Unknown sizes are skipped; a group of nothing but unknown sizes has no sum."""
    known = [e["size"] if e["type"] == S.PUSH else 0 for e in events]
    known = [size for size in known if size is not None]
    return sum(known) if known else None


def kind_count(events, kind):
    return sum(e["type"] == kind for e in events)


def people(events):
    return len({e["actor"] for e in events} - {None})


@pytest.fixture(scope="module", params=[1, 2])
def case(request, spark):
    events = random_events(request.param)
    return events, staged(spark, events).cache()


def test_daily_activity(case):
    events, stg = case
    found = by_key(models.daily_activity(stg), "repo_name", "activity_date")
    expected = groups(events, lambda e: (e["repo"], day(e)))
    assert set(found) == set(expected)
    for repo in {r for r, _ in expected}:
        dates = sorted((d for r, d in expected if r == repo), key=lambda d: (d is None, d or dt.date.min))
        for i, date in enumerate(dates):
            rows, row = expected[repo, date], found[repo, date]
            recent = [len(expected[repo, d]) for d in dates[max(0, i - 6): i + 1]]
            assert row["total_activity"] == len(rows)
            assert row["unique_contributors"] == people(rows)
            assert row["total_commits"] == commits(rows)
            assert row["push_events"] == kind_count(rows, S.PUSH)
            assert row["issue_events"] == kind_count(rows, S.ISSUES)
            assert row["pr_events"] == kind_count(rows, S.PULL_REQUEST)
            assert row["star_events"] == kind_count(rows, S.WATCH)
            assert row["fork_events"] == kind_count(rows, S.FORK)
            assert row["week_avg"] == pytest.approx(sum(recent) / len(recent))


@pytest.mark.parametrize("k", [1, 4, 20])
def test_top_contributors(case, k):
    events, stg = case
    stats = models.contributor_stats(stg)
    found = by_key(models.top_contributors(stats, k), "contributor", "repo_name")
    pairs = groups(events, lambda e: (e["actor"], e["repo"]))
    expected = {}
    for (actor, repo), rows in pairs.items():
        rank = 1 + sum(len(o) > len(rows) for (_, r), o in pairs.items() if r == repo)
        if rank <= k:
            expected[actor, repo] = (rows, rank)
    assert set(found) == set(expected)
    for key, (rows, rank) in expected.items():
        row, times = found[key], [moment(e) for e in rows if e["at"]]
        assert (row["contributor_rank"], row["total_events"]) == (rank, len(rows))
        assert row["event_types_used"] == len({e["type"] for e in rows} - {None})
        assert (row["first_commit"], row["final_commit"]) == (min(times), max(times))
        assert row["active_days"] == (max(times).date() - min(times).date()).days
        done = commits(rows)
        points = 5 * kind_count(rows, S.PULL_REQUEST) + kind_count(rows, S.ISSUES)
        assert row["commit_count"] == done
        assert row["contribution_score"] == (None if done is None else 2 * done + points)


def test_event_trends(case):
    events, stg = case
    found = by_key(models.event_trends(stg), "repo_name", "event_type", "event_hour")
    expected = groups(events, lambda e: (e["repo"], e["type"], hour(e)))
    assert set(found) == set(expected)
    for repo, kind in {(r, t) for r, t, _ in expected}:
        hours = [h for r, t, h in expected if (r, t) == (repo, kind)]
        hours.sort(key=lambda h: (h is None, h or dt.datetime.min))
        before = None
        for h in hours:
            rows, row = expected[repo, kind, h], found[repo, kind, h]
            assert (row["event_count"], row["unique_users"]) == (len(rows), people(rows))
            assert row["prev_hour_count"] == before
            assert row["over_hour_change"] == (None if before is None else len(rows) - before)
            before = len(rows)


def test_retention(case):
    events, stg = case
    found = by_key(insights.retention(stg), "repo_name", "week_start")
    active = {
        (e["repo"], day(e) - dt.timedelta(days=day(e).weekday()), e["actor"])
        for e in events if e["at"] and e["actor"]
    }
    assert set(found) == {(repo, week) for repo, week, _ in active}
    for (repo, week), row in found.items():
        here = {a for r, w, a in active if (r, w) == (repo, week)}
        back = {a for a in here if (repo, week + dt.timedelta(days=7), a) in active}
        assert (row["contributors"], row["retained"]) == (len(here), len(back))
        assert row["retention_rate"] == pytest.approx(len(back) / len(here))


def test_daily_rank(case):
    events, stg = case
    found = by_key(insights.daily_rank(models.daily_activity(stg)), "repo_name", "activity_date")
    counts = {key: len(rows) for key, rows in groups(events, lambda e: (e["repo"], day(e))).items()}
    assert set(found) == set(counts)
    for (repo, date), n in counts.items():
        ahead = sum(m > n for (_, d), m in counts.items() if d == date)
        assert found[repo, date]["daily_rank"] == 1 + ahead


def test_engagement_totals(case):
    events, stg = case
    found = by_key(insights.engagement(stg), "repo_name", "activity_date")
    for (repo, date), row in found.items():
        until = [e for e in events if e["repo"] == repo and (
            date is None or (e["at"] and day(e) <= date))]
        assert row["total_stars"] == kind_count(until, S.WATCH)
        assert row["total_forks"] == kind_count(until, S.FORK)


@pytest.mark.parametrize("first", ["1969-01-01", "2023-05-01"])
def test_retention_over_years(spark, first):
    """Weeks on both sides of every block boundary, before and after the epoch."""
    rng = random.Random(5)
    start = dt.datetime.fromisoformat(first)
    events = [
        {"actor": f"u{rng.randint(1, 4)}", "at": str(start + dt.timedelta(days=rng.randint(0, 800)))}
        for _ in range(500)
    ]
    found = by_key(insights.retention(staged(spark, events)), "week_start")
    active = {(day(e) - dt.timedelta(days=day(e).weekday()), e["actor"]) for e in events}
    assert set(found) == {week for week, _ in active} and len(found) > 100
    for week, row in found.items():
        here = {a for w, a in active if w == week}
        back = {a for a in here if (week + dt.timedelta(days=7), a) in active}
        assert (row["contributors"], row["retained"]) == (len(here), len(back))
