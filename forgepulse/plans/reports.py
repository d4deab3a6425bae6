"""Documented analytical queries over the models."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from forgepulse import schemas as S
from forgepulse.functions.measures import percent_change
from forgepulse.plans import models


def _utc_now() -> Column:
    return F.convert_timezone(None, F.lit("UTC"), F.localtimestamp())


def _day(as_of: dt.date | None) -> Column:
    return F.to_date(_utc_now()) if as_of is None else F.lit(as_of)


def _moment(as_of: dt.datetime | None) -> Column:
    return _utc_now() if as_of is None else F.lit(as_of.isoformat(" ")).cast("timestamp_ntz")


def repo_health(
    daily: DataFrame, repo: str, as_of: dt.date | None = None, days: int = S.HEALTH_DAYS
) -> DataFrame:
    """Recent days of one repository with the deviation from the rolling mean, newest first.

    The repository filter reaches the scan; the date filter stays above the window, because days
    before the report still belong to the mean of its first days.
    """
    return (
        daily.where(
            (F.col("repo_name") == repo)
            & (F.col("activity_date") >= F.date_sub(_day(as_of), days))
        )
        .select(
            "repo_name", "activity_date", "total_activity", "unique_contributors", "week_avg",
            percent_change(F.col("total_activity"), F.col("week_avg")).alias("pct_above_avg"),
        )
        .orderBy(F.col("activity_date").desc())
    )


def top_contributors_report(stats: DataFrame, repo: str, k: int = S.REPORT_K) -> DataFrame:
    """Leaders of one repository by weighted score, from ``contributor_stats``.

    The repository is chosen before contributors are ranked, so only its rows are read, counted and
    sorted; ranking reads them twice.
    """
    top = models.top_contributors(stats.where(F.col("repo_name") == repo), k)
    return top.select(
        "contributor", "repo_name", "commit_count", "pr_count", "contribution_score",
        "contributor_rank",
    ).orderBy(F.col("contribution_score").desc_nulls_first())


def trend_anomalies(
    trends: DataFrame,
    as_of: dt.datetime | None = None,
    threshold: int = S.ANOMALY_THRESHOLD,
    hours: int = S.ANOMALY_HOURS,
) -> DataFrame:
    """Hourly jumps beyond ``threshold`` in the last ``hours``, largest first."""
    jump = F.abs("over_hour_change")
    since = _moment(as_of) - F.make_dt_interval(hours=F.lit(hours))
    return (
        trends.where((jump > threshold) & (F.col("event_hour") >= since))
        .select("repo_name", "event_type", "event_hour", "event_count", "over_hour_change")
        .orderBy(jump.desc())
    )
