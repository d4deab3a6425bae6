"""Daily aggregates that the models are put together from.

Each holds one day's share of a model: counts of a repository and day, of a repository, type and hour,
and of a contributor, repository and day; a sketch of the people of a repository and day; and the ids of
the day as bits. A run computes them for the days that it changes only; the models add them up and put
their windows on the sums, so they never go back to events.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from forgepulse import schemas as S
from forgepulse.functions import measures as M
from forgepulse.operators import id_bitmaps
from forgepulse.plans import insights, models
from forgepulse.plans.versions import DAY

DAILY = (
    "repo_name STRING, total_activity BIGINT, unique_contributors BIGINT, push_events BIGINT, "
    "total_commits BIGINT, issue_events BIGINT, pr_events BIGINT, star_events BIGINT, "
    f"fork_events BIGINT, {DAY} DATE"
)
HOURLY = (
    "repo_name STRING, event_type STRING, event_hour TIMESTAMP_NTZ, event_count BIGINT, "
    f"unique_users BIGINT, {DAY} DATE"
)
CONTRIBUTORS = (
    "contributor STRING, repo_name STRING, total_events BIGINT, event_types ARRAY<STRING>, "
    "push_count BIGINT, commit_count BIGINT, issue_count BIGINT, pr_count BIGINT, "
    f"first_commit TIMESTAMP_NTZ, final_commit TIMESTAMP_NTZ, {DAY} DATE"
)
PEOPLE = f"repo_name STRING, people BINARY, {DAY} DATE"
SCHEMAS = {
    "daily_counts": DAILY, "hourly_counts": HOURLY, "contributor_counts": CONTRIBUTORS,
    "daily_people": PEOPLE, "event_ids": id_bitmaps.SCHEMA,
}


def all_of(stg: DataFrame) -> dict[str, DataFrame]:
    """The aggregates of staged days by the name of their table."""
    return {
        "daily_counts": daily_counts(stg), "hourly_counts": hourly_counts(stg),
        "contributor_counts": contributor_counts(stg), "daily_people": daily_people(stg),
        "event_ids": id_bitmaps.id_bits(stg, DAY),
    }


def daily_counts(stg: DataFrame) -> DataFrame:
    return models.daily_counts(stg).withColumnRenamed("activity_date", DAY)


def daily_people(stg: DataFrame) -> DataFrame:
    """A sketch of the people of each repository and day. Each person is taken once before, so that what
    is shuffled are names first and one sketch a group then."""
    once = stg.select("repo_name", M.day_of().alias(DAY), "actor_login").distinct()
    return once.groupBy("repo_name", DAY).agg(M.sketch().alias("people")).select("repo_name", "people", DAY)


def hourly_counts(stg: DataFrame) -> DataFrame:
    return models.hourly_counts(stg).withColumn(DAY, F.to_date("event_hour"))


def contributor_counts(stg: DataFrame) -> DataFrame:
    return stg.groupBy(
        F.col("actor_login").alias("contributor"), "repo_name", M.day_of().alias(DAY)
    ).agg(
        M.rows().alias("total_events"), F.collect_set("event_type").alias("event_types"),
        M.events_of(S.PUSH).alias("push_count"), M.commits().alias("commit_count"),
        M.events_of(S.ISSUES).alias("issue_count"), M.events_of(S.PULL_REQUEST).alias("pr_count"),
        F.min("event_timestamp").alias("first_commit"), F.max("event_timestamp").alias("final_commit"),
    )


def daily_activity(counts: DataFrame) -> DataFrame:
    return models.with_week_avg(counts.withColumnRenamed(DAY, "activity_date"))


def days_of_activity(counts: DataFrame, changed: Sequence[dt.date]) -> DataFrame:
    """(event_date) of the rows of ``daily_activity`` that changed days reach: their own, and the rows
    whose frame of seven holds such a day or would have held one that is gone."""
    return _reached(counts, changed, ["repo_name"], F.col(DAY), S.ROLLING_ROWS - 1)


def event_trends(counts: DataFrame) -> DataFrame:
    return models.with_hour_change(counts.drop(DAY))


def days_of_trends(counts: DataFrame, changed: Sequence[dt.date]) -> DataFrame:
    """(event_date) of the rows of ``event_trends`` that changed days reach: their own, and the next hour
    of each repository and type."""
    return _reached(counts, changed, ["repo_name", "event_type"], F.col("event_hour"), 1)


def _reached(
    counts: DataFrame, changed: Sequence[dt.date], by: Sequence[str], moment: Column, rows: int
) -> DataFrame:
    """Days of the rows behind which, up to ``rows`` rows back, there is a changed day."""
    back = F.lag(DAY, rows).over(Window.partitionBy(*by).orderBy(moment.asc_nulls_last()))
    slim = counts.select(DAY, back.alias("back"))
    days = F.array(*[F.lit(day) for day in changed]).cast("array<date>")
    reached = F.exists(days, lambda day: (day <= F.col(DAY)) & (F.col("back").isNull() | (day >= F.col("back"))))
    return slim.where(reached).select(DAY).distinct()


def retention(counts: DataFrame) -> DataFrame:
    """From the days of contributors instead of their events."""
    return insights.retention(_active(counts))


def contributor_growth(
    counts: DataFrame, sketches: DataFrame, period: str = "month", approximate: bool = False
) -> DataFrame:
    """From the days of contributors, or with ``approximate`` from the sketches of days, united."""
    if not approximate:
        return insights.contributor_growth(_active(counts), period)
    start = M.period_of(period, DAY).alias("period_start")
    united = sketches.groupBy("repo_name", start).agg(F.hll_union_agg("people").alias("people"))
    return insights.with_growth(united.select(
        "repo_name", "period_start", M.sketched(F.col("people")).alias("contributors")
    ))


def _active(counts: DataFrame) -> DataFrame:
    """One row a contributor, repository and day, in the terms of staging."""
    moment = F.col(DAY).cast("timestamp_ntz").alias("event_timestamp")
    return counts.select("repo_name", F.col("contributor").alias("actor_login"), moment)


def leading_contributors(counts: DataFrame, k: int = S.TOP_K) -> DataFrame:
    """Contributors with rank at most ``k``: ranks from the narrow totals, all else for these alone."""
    totals = counts.groupBy("contributor", "repo_name").agg(F.sum("total_events").alias("total_events"))
    ranked = models.of_pairs(counts, models.leading_pairs(totals, k), "contributor")
    stats = contributor_stats(ranked, ["contributor_rank"])
    return stats.select(*[c for c in stats.columns if c != "contributor_rank"], "contributor_rank")


def contributor_stats(counts: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """All pairs. Types are counted as distinct (pair, type) rows, not gathered, so a contributor of
    many days costs a partial aggregate. ``keep``: columns that all rows of a pair share."""
    types = (
        counts.select("contributor", "repo_name", F.explode("event_types").alias("event_type"))
        .distinct().groupBy("contributor", "repo_name").agg(M.rows().alias("event_types_used"))
    )
    pairs = counts.groupBy("contributor", "repo_name", *keep).agg(
        F.sum("total_events").alias("total_events"), F.sum("push_count").alias("push_count"),
        F.sum("commit_count").alias("commit_count"), F.sum("issue_count").alias("issue_count"),
        F.sum("pr_count").alias("pr_count"), F.min("first_commit").alias("first_commit"),
        F.max("final_commit").alias("final_commit"),
    )
    same = pairs["contributor"].eqNullSafe(types["contributor"]) & pairs["repo_name"].eqNullSafe(
        types["repo_name"]
    )
    joined = pairs.join(types, same, "left").select(
        pairs["contributor"], pairs["repo_name"], "total_events",
        F.coalesce("event_types_used", F.lit(0).cast("bigint")).alias("event_types_used"),
        "push_count", "commit_count", "issue_count", "pr_count", "first_commit", "final_commit", *keep,
    )
    return models.with_score(joined)

