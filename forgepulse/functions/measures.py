"""Aggregate expressions over the staging relation."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from forgepulse import schemas as S


def rows() -> Column:
    return F.count(F.lit(1))


def events_of(event_type: str) -> Column:
    """Number of events of one type; 0, never NULL, on a non-empty group."""
    return F.count_if(F.col("event_type") == event_type)


#: Registers of a sketch as a power of two; the standard error is 1.04 / sqrt(2^12), about 1.6 %.
SKETCH_BITS = 12


def people(approximate: bool = False, login: str = "actor_login") -> Column:
    """Distinct people, NULL not counted: exact, or as a sketch estimates them."""
    return sketched(sketch(login)) if approximate else F.count_distinct(login)


def sketch(login: str = "actor_login") -> Column:
    """Sketch of distinct people, to be stored and united; NULL if there are none."""
    return F.hll_sketch_agg(login, SKETCH_BITS)


def sketched(held: Column) -> Column:
    return F.coalesce(F.hll_sketch_estimate(held), F.lit(0)).cast("bigint")


def commits() -> Column:
    """Commits pushed. Pushes without a size count as unknown, so a group that holds nothing
    but such pushes has NULL commits, not 0."""
    return F.sum(
        F.when(F.col("event_type") == S.PUSH, F.col("push_commit_count")).otherwise(0)
    )


def contribution_score(weights: dict[str, int]) -> Column:
    """Weighted sum over already aggregated counters; NULL commits make the score NULL."""
    score = F.lit(0).cast("bigint")
    for counter, points in weights.items():
        score = score + F.col(counter) * F.lit(points)
    return score


def day_of(moment: str = "event_timestamp") -> Column:
    return F.to_date(F.col(moment))


def hour_of(moment: str = "event_timestamp") -> Column:
    """Start of the hour. ``date_trunc`` would go through the session time zone and move hours
    that its clock changes skip; this stays on the zone-less wall clock."""
    return F.to_date(F.col(moment)).cast("timestamp_ntz") + F.make_dt_interval(
        hours=F.hour(F.col(moment))
    )


def period_of(period: str, moment: str = "event_timestamp") -> Column:
    """First day of the week, month, quarter or year."""
    if period not in ("week", "month", "quarter", "year"):
        raise ValueError(f"unknown period {period!r}")
    return F.trunc(F.to_date(F.col(moment)), period)


def day_boundaries(first: str, last: str) -> Column:
    """Midnights crossed between two timestamps: 23:00 to 01:00 is one day."""
    return F.date_diff(F.to_date(F.col(last)), F.to_date(F.col(first))).cast("bigint")


def percent_change(now: Column, before: Column) -> Column:
    return F.try_divide((now - before).cast("double"), before.cast("double")) * 100
