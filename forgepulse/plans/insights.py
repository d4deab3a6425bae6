"""Advertised metrics that go beyond the three models."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from forgepulse import schemas as S
from forgepulse.functions import measures as M
from forgepulse.operators.ranking import rank_within


def daily_rank(daily: DataFrame) -> DataFrame:
    """Rank of every repository within each day by activity. ``daily`` is read twice."""
    slim = daily.select("activity_date", "repo_name", "total_activity")
    return rank_within(slim, ["activity_date"], "total_activity", "daily_rank")


def commit_velocity(stg: DataFrame) -> DataFrame:
    """Commits per repository and day, and the change since the previous active day."""
    daily = stg.groupBy("repo_name", M.day_of().alias("activity_date")).agg(
        M.commits().alias("commits")
    )
    by_day = Window.partitionBy("repo_name").orderBy(F.col("activity_date").asc_nulls_last())
    return daily.withColumn("prev_commits", F.lag("commits").over(by_day)).withColumn(
        "commit_change", F.col("commits") - F.col("prev_commits")
    )


def issue_pr_trends(stg: DataFrame) -> DataFrame:
    """Issue and pull-request events per repository, day and action."""
    return (
        stg.where(F.col("event_type").isin(S.ISSUES, S.PULL_REQUEST))
        .groupBy(
            "repo_name",
            M.day_of().alias("activity_date"),
            F.when(F.col("event_type") == S.ISSUES, "issue").otherwise("pull_request").alias("kind"),
            F.coalesce("issue_action", "pr_action").alias("action"),
        )
        .agg(M.rows().alias("events"))
    )


def engagement(stg: DataFrame) -> DataFrame:
    """Stars and forks per repository and day with running totals."""
    daily = stg.groupBy("repo_name", M.day_of().alias("activity_date")).agg(
        F.sum("is_star_event").alias("stars"), M.events_of(S.FORK).alias("forks")
    )
    so_far = (
        Window.partitionBy("repo_name")
        .orderBy(F.col("activity_date").asc_nulls_last())
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return daily.withColumn("total_stars", F.sum("stars").over(so_far)).withColumn(
        "total_forks", F.sum("forks").over(so_far)
    )


_FIRST_MONDAY = dt.date(1970, 1, 5)
_BLOCK = 32  # weeks per block


def retention(stg: DataFrame) -> DataFrame:
    """Per repository and week: contributors, and how many are active again the week after.

    Without a self-join, and with one large shuffle. A contributor's weeks are bits of a number
    per block of 32 weeks, collected by ``bit_or`` with map-side combine; bit 32 says that the next
    block starts with an active week. A week is followed up when the next bit is set.
    """
    week_no = F.floor(F.date_diff(M.day_of(), F.lit(_FIRST_MONDAY)) / 7).cast("int")
    seen = stg.where(
        F.col("actor_login").isNotNull() & F.col("event_timestamp").isNotNull()
    ).select("repo_name", "actor_login", week_no.alias("week_no"))
    # Arithmetic shift and mask divide by 32 with a remainder of 0..31 before 1970 as well.
    block = F.shiftright("week_no", 5)
    position = F.col("week_no").bitwiseAND(_BLOCK - 1)
    own = F.struct(block.alias("block"), F.expr("shiftleft(1L, week_no & 31)").alias("bits"))
    to_previous = F.struct((block - 1).alias("block"), F.lit(1 << _BLOCK).alias("bits"))
    marks = F.when(position == 0, F.array(own, to_previous)).otherwise(F.array(own))
    blocks = (
        seen.select("repo_name", "actor_login", F.inline(marks))
        .groupBy("repo_name", "actor_login", "block")
        .agg(F.bit_or("bits").alias("bits"))
    )
    active = F.filter(
        F.sequence(F.lit(0), F.lit(_BLOCK - 1)), lambda i: F.getbit(F.col("bits"), i) == 1
    )
    weeks = blocks.select("repo_name", "block", "bits", F.explode(active).alias("position"))
    days = (F.col("block") * _BLOCK + F.col("position")) * 7
    return (
        weeks.groupBy("repo_name", F.date_add(F.lit(_FIRST_MONDAY), days).alias("week_start"))
        .agg(
            M.rows().alias("contributors"),
            F.count_if(F.getbit(F.col("bits"), F.col("position") + 1) == 1).alias("retained"),
        )
        .withColumn("retention_rate", F.col("retained") / F.col("contributors"))
    )


def contributor_growth(stg: DataFrame, period: str = "month", approximate: bool = False) -> DataFrame:
    """Distinct contributors per repository and period, and the change in percent since the
    previous active period. With ``approximate`` they are counted by sketches."""
    return with_growth(stg.groupBy(
        "repo_name", M.period_of(period).alias("period_start")
    ).agg(M.people(approximate).alias("contributors")))


def with_growth(periods: DataFrame) -> DataFrame:
    by_period = Window.partitionBy("repo_name").orderBy(F.col("period_start").asc_nulls_last())
    return periods.withColumn(
        "prev_contributors", F.lag("contributors").over(by_period)
    ).withColumn(
        "growth_pct", M.percent_change(F.col("contributors"), F.col("prev_contributors"))
    )
