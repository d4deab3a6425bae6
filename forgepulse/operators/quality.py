"""Data-quality checks. Each gives failing rows, or one result row per check for the gate."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

RESULT = "check_name STRING, model STRING, column_name STRING, failures BIGINT"


class QualityError(ValueError):
    """Raised by the gates when a run must not be published."""


def duplicate_keys(df: DataFrame, key: str) -> DataFrame:
    """Keys that occur more than once; NULLs are not counted. Copies of one key combine on the
    map side."""
    return (
        df.where(F.col(key).isNotNull())
        .groupBy(key)
        .agg(F.count(F.lit(1)).alias("copies"))
        .where(F.col("copies") > 1)
    )


def unique_result(df: DataFrame, model: str, key: str) -> DataFrame:
    return duplicate_keys(df, key).agg(F.count(F.lit(1)).alias("failures")).select(
        F.lit("unique").alias("check_name"), F.lit(model).alias("model"),
        F.lit(key).alias("column_name"), "failures",
    )


def not_null_result(df: DataFrame, model: str, columns: Sequence[str]) -> DataFrame:
    """One row per column; all columns are counted in one pass."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(f"n{i}") for i, c in enumerate(columns)])
    pairs = [part for i, c in enumerate(columns) for part in (F.lit(c), F.col(f"n{i}"))]
    return counts.select(
        F.lit("not_null").alias("check_name"), F.lit(model).alias("model"),
        F.stack(F.lit(len(columns)), *pairs).alias("column_name", "failures"),
    )


def unexpected_values(df: DataFrame, column: str, accepted: Sequence[str]) -> DataFrame:
    """Values outside the accepted set, with their row counts; NULLs are left to not_null."""
    return (
        df.where(~F.col(column).isin(*accepted))
        .groupBy(column)
        .agg(F.count(F.lit(1)).alias("events"))
    )


def orphans(child: DataFrame, child_key: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """Child keys without a parent, with their row counts.

    Both sides collapse to one row per key before the anti-join, so a hot key cannot skew it.
    """
    keys = (
        child.where(F.col(child_key).isNotNull())
        .groupBy(child_key)
        .agg(F.count(F.lit(1)).alias("events"))
    )
    parents = parent.select(F.col(parent_key).alias("__parent")).distinct()
    return keys.join(parents, keys[child_key] == parents["__parent"], "left_anti")


def row_counts(df: DataFrame, by: str, at_least: int) -> DataFrame:
    """Rows per batch or day against a lower bound."""
    return df.groupBy(by).agg(F.count(F.lit(1)).alias("events")).select(
        by, "events", F.lit(at_least).cast("bigint").alias("at_least"),
        (F.col("events") >= at_least).alias("passed"),
    )


def require_rows(df: DataFrame) -> DataFrame:
    """One row with the event count; the query fails when there is none."""
    counted = df.agg(F.count(F.lit(1)).alias("event_count"))
    passed = F.assert_true(F.col("event_count") > 0, F.lit("no events extracted")).isNull()
    return counted.select("event_count", passed.alias("passed"))


def accepted_result(df: DataFrame, model: str, column: str, accepted: Sequence) -> DataFrame:
    """How many rows have a value outside the accepted set."""
    return unexpected_values(df, column, accepted).agg(
        F.coalesce(F.sum("events"), F.lit(0)).alias("failures")
    ).select(
        F.lit("accepted_values").alias("check_name"), F.lit(model).alias("model"),
        F.lit(column).alias("column_name"), "failures",
    )


def relationship_result(
    child: DataFrame, model: str, child_key: str, parent: DataFrame, parent_key: str
) -> DataFrame:
    """How many child keys have no parent."""
    return orphans(child, child_key, parent, parent_key).agg(
        F.count(F.lit(1)).alias("failures")
    ).select(
        F.lit("relationships").alias("check_name"), F.lit(model).alias("model"),
        F.lit(child_key).alias("column_name"), "failures",
    )


def row_count_result(df: DataFrame, model: str, by: str, at_least: int = 1) -> DataFrame:
    """One failure for each batch below the bound, and one if there is none at all."""
    counted = row_counts(df, by, at_least).agg(
        (F.count_if(~F.col("passed")) + F.when(F.count(F.lit(1)) == 0, 1).otherwise(0)).alias("failures")
    )
    return counted.select(
        F.lit("row_count").alias("check_name"), F.lit(model).alias("model"),
        F.lit(by).alias("column_name"), "failures",
    )


def model_results(
    staged: DataFrame, daily: DataFrame, top: DataFrame, trends: DataFrame
) -> DataFrame:
    """The declared column checks of all four relations."""
    results = [
        unique_result(staged, "stg_events", "event_id"),
        not_null_result(
            staged, "stg_events", ["event_id", "event_type", "repo_name", "event_timestamp"]
        ),
        accepted_result(staged, "stg_events", "is_star_event", (0, 1)),
        not_null_result(daily, "daily_activity", ["repo_name", "activity_date"]),
        row_count_result(daily, "daily_activity", "activity_date"),
        not_null_result(top, "top_contributors", ["contributor"]),
        relationship_result(top, "top_contributors", "repo_name", daily, "repo_name"),
        not_null_result(trends, "event_trends", ["event_hour"]),
    ]
    return reduce(DataFrame.unionAll, results)


def gate(results: DataFrame) -> DataFrame:
    """Run the checks (one row each) and fail on any failure; returns what was found."""
    found = results.collect()
    failed = [r for r in found if r["failures"]]
    if failed:
        listed = ", ".join(
            f"{r['check_name']}({r['model']}.{r['column_name']})={r['failures']}" for r in failed
        )
        raise QualityError(f"data checks failed: {listed}")
    return results.sparkSession.createDataFrame(found, RESULT)
