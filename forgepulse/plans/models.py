"""The three analytical models over the staging relation.

Every one aggregates first, on keys finer than the repository, and puts windows on the small
result. The raw events of a hot repository are therefore never in one task: partial aggregates
leave the map side keyed by (repository, day or hour, contributor).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from forgepulse import schemas as S
from forgepulse.functions import measures as M
from forgepulse.operators.ranking import rank_within
from forgepulse.session import settle


def daily_activity(
    stg: DataFrame, rolling_rows: int = S.ROLLING_ROWS, approximate: bool = False
) -> DataFrame:
    """Repository x day. ``week_avg`` is the mean over the last seven days *with activity*. With
    ``approximate`` contributors are counted by sketches (see ``measures.people``)."""
    return with_week_avg(daily_counts(stg, approximate), rolling_rows)


def daily_counts(stg: DataFrame, approximate: bool = False) -> DataFrame:
    return stg.groupBy("repo_name", M.day_of().alias("activity_date")).agg(
        M.rows().alias("total_activity"),
        M.people(approximate).alias("unique_contributors"),
        M.events_of(S.PUSH).alias("push_events"),
        M.commits().alias("total_commits"),
        M.events_of(S.ISSUES).alias("issue_events"),
        M.events_of(S.PULL_REQUEST).alias("pr_events"),
        F.sum("is_star_event").alias("star_events"),
        M.events_of(S.FORK).alias("fork_events"),
    )


def with_week_avg(daily: DataFrame, rolling_rows: int = S.ROLLING_ROWS) -> DataFrame:
    # One row per day and repository: the window holds days, not events.
    recent = (
        Window.partitionBy("repo_name")
        .orderBy(F.col("activity_date").asc_nulls_last())
        .rowsBetween(1 - rolling_rows, Window.currentRow)
    )
    return daily.withColumn("week_avg", F.avg("total_activity").over(recent))


def contributor_stats(
    stg: DataFrame, weights: dict[str, int] | None = None, keep: Sequence[str] = ()
) -> DataFrame:
    """Contributor x repository, all pairs, with the weighted score. ``keep``: columns that all rows of a
    pair share."""
    pairs = stg.groupBy(F.col("actor_login").alias("contributor"), "repo_name", *keep).agg(
        M.rows().alias("total_events"),
        F.count_distinct("event_type").alias("event_types_used"),
        M.events_of(S.PUSH).alias("push_count"),
        M.commits().alias("commit_count"),
        M.events_of(S.ISSUES).alias("issue_count"),
        M.events_of(S.PULL_REQUEST).alias("pr_count"),
        F.min("event_timestamp").alias("first_commit"),
        F.max("event_timestamp").alias("final_commit"),
    )
    return with_score(pairs, weights)


def with_score(pairs: DataFrame, weights: dict[str, int] | None = None) -> DataFrame:
    return pairs.withColumn(
        "active_days", M.day_boundaries("first_commit", "final_commit")
    ).withColumn("contribution_score", M.contribution_score(weights or S.SCORE_WEIGHTS))


def top_contributors(stats: DataFrame, k: int = S.TOP_K) -> DataFrame:
    """Contributors whose rank by event count within the repository is at most ``k``.

    Ties share a rank, so a repository can have more than ``k`` rows. ``stats`` is read twice
    (see ``rank_within``): pass the written ``contributor_stats``.
    """
    return rank_within(stats, ["repo_name"], "total_events", "contributor_rank", k)


def leading_contributors(stg: DataFrame, k: int = S.TOP_K, weights: dict[str, int] | None = None) -> DataFrame:
    """The same rows as ``top_contributors``, straight from staging.

    Ranks need only the number of events of each pair. These are counted first, in one narrow shuffle
    that the histogram and the ranked pairs share; everything else is then added up for the leading
    pairs alone. They are written, so that their measured size decides how they are joined.
    """
    totals = stg.groupBy(F.col("actor_login").alias("contributor"), "repo_name").agg(
        M.rows().alias("total_events")
    )
    pairs = settle(leading_pairs(totals, k), "leading-pairs")
    stats = contributor_stats(of_pairs(stg, pairs, "actor_login"), weights, ["contributor_rank"])
    return stats.select(*[c for c in stats.columns if c != "contributor_rank"], "contributor_rank")


def leading_pairs(totals: DataFrame, k: int) -> DataFrame:
    """(contributor, repo_name, contributor_rank) of pairs with rank at most ``k``."""
    ranked = rank_within(totals, ["repo_name"], "total_events", "contributor_rank", k)
    return ranked.select("contributor", "repo_name", "contributor_rank")


def of_pairs(rows: DataFrame, pairs: DataFrame, person: str) -> DataFrame:
    """Rows of some (contributor, repo_name), with what else is known of these."""
    own = pairs.withColumnRenamed("repo_name", "__repo").withColumnRenamed("contributor", "__person")
    same = rows[person].eqNullSafe(own["__person"]) & rows["repo_name"].eqNullSafe(own["__repo"])
    return rows.join(own, same).drop("__person", "__repo")


def event_trends(stg: DataFrame, approximate: bool = False) -> DataFrame:
    """Repository x type x hour, compared with the previous hour *that has events*."""
    return with_hour_change(hourly_counts(stg, approximate))


def hourly_counts(stg: DataFrame, approximate: bool = False) -> DataFrame:
    return stg.groupBy("repo_name", "event_type", M.hour_of().alias("event_hour")).agg(
        M.rows().alias("event_count"),
        M.people(approximate).alias("unique_users"),
    )


def with_hour_change(hourly: DataFrame) -> DataFrame:
    by_hour = Window.partitionBy("repo_name", "event_type").orderBy(
        F.col("event_hour").asc_nulls_last()
    )
    return hourly.withColumn(
        "prev_hour_count", F.lag("event_count").over(by_hour)
    ).withColumn("over_hour_change", F.col("event_count") - F.col("prev_hour_count"))


# Result orders. Models stay unordered relations; readers that want the order apply it once.
def daily_order() -> list[Column]:
    return [F.col("repo_name").asc_nulls_last(), F.col("activity_date").asc_nulls_last()]


def contributor_order() -> list[Column]:
    return [F.col("repo_name").asc_nulls_last(), F.col("contribution_score").desc_nulls_first()]


def trend_order() -> list[Column]:
    return [
        F.col("repo_name").asc_nulls_last(),
        F.col("event_type").asc_nulls_last(),
        F.col("event_hour").desc_nulls_first(),
    ]
