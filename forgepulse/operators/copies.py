"""Keep one copy of every event that overlapping pulls delivered more than once."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# After the pull time, all other columns make the choice repeatable on a retry.
_TIE_BREAKERS = (
    "event_timestamp", "event_type", "repo_name", "actor_login", "source_repo", "actor_id", "repo_id",
    "push_commit_count", "issue_action", "pr_action",
)


def copy_order(columns: Sequence[str]) -> list[Column]:
    """Order of the copies of an event: the one that stays comes first."""
    order = [F.col("extracted_at").desc_nulls_last()]
    if "loaded_at" in columns:
        order.append(F.col("loaded_at").desc_nulls_last())
    order += [F.col(c).asc_nulls_last() for c in _TIE_BREAKERS if c in columns]
    if "payload" in columns:
        order.append(F.xxhash64(F.to_json("payload")).asc_nulls_last())
    return order


def latest_copy(
    staged: DataFrame, key: str = "event_id", null_keys: bool = True, within: Sequence[str] = ()
) -> DataFrame:
    """The copy with the latest ``extracted_at`` per ``key``; rows without a key all stay.

    ``row_number() = 1`` plans a group limit in front of the shuffle, so each map task forwards
    at most one row per key: an event that makes up a third of the input costs one row per task
    behind it. Rows without a key are no copies of each other and skip the shuffle; finding them
    is a second scan, which ``null_keys=False`` saves for validated rows, where none exist. (Should
    one exist after all, it stays and fails the not-null check.)

    ``within`` names columns that all copies of an event share. The window is partitioned by them as
    well, so rows that are clustered by some of them already are not shuffled again.
    """
    window = Window.partitionBy(*within, key).orderBy(*copy_order(staged.columns))
    keyed = staged.where(F.col(key).isNotNull()) if null_keys else staged
    latest = keyed.withColumn("__copy", F.row_number().over(window)).where(F.col("__copy") == 1).drop("__copy")
    return latest.unionAll(staged.where(F.col(key).isNull())) if null_keys else latest
