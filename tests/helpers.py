"""Small hand-written inputs."""

from __future__ import annotations

import contextlib
import io
import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

STAGED = (
    "event_id STRING, event_type STRING, actor_id BIGINT, actor_login STRING, repo_id BIGINT, "
    "repo_name STRING, event_timestamp TIMESTAMP_NTZ, extracted_at TIMESTAMP_NTZ, "
    "source_repo STRING, push_commit_count BIGINT, issue_action STRING, pr_action STRING, "
    "is_star_event INT"
)


def staged(spark: SparkSession, events: list[dict]) -> DataFrame:
    """Staging rows from dicts; id, repo and star flag are filled in."""
    rows = []
    for number, event in enumerate(events):
        kind = event.get("type", "PushEvent")
        rows.append(
            (
                event.get("id", str(number)), kind, event.get("actor_id"), event.get("actor", "ann"),
                event.get("repo_id"), event.get("repo", "r"), event.get("at"), event.get("pulled"),
                event.get("source"), event.get("size"), event.get("issue"), event.get("pr"),
                int(kind == "WatchEvent"),
            )
        )
    text = STAGED.replace("TIMESTAMP_NTZ", "STRING")
    frame = spark.createDataFrame(rows, text)
    for column in ("event_timestamp", "extracted_at"):
        frame = frame.withColumn(column, F.col(column).cast("timestamp_ntz"))
    return frame


def feed_event(number: int = 1, **changes) -> dict:
    """A valid feed event; ``changes`` replace top-level fields, None removes one."""
    event = {
        "id": str(number),
        "type": "PushEvent",
        "actor": {"id": 7, "login": "ann", "url": "https://feed.example/u/7"},
        "repo": {"id": 3, "name": "org/r", "url": "https://feed.example/r/3"},
        "created_at": "2024-01-05T10:00:00Z",
        "payload": {"size": 2},
    }
    for key, value in changes.items():
        if value is None:
            event.pop(key, None)
        else:
            event[key] = value
    return event


def raw(spark: SparkSession, events: list) -> DataFrame:
    lines = [(json.dumps(e) if not isinstance(e, str) else e,) for e in events]
    return spark.createDataFrame(lines, "line STRING").select(
        F.parse_json("line").alias("raw_data"), F.current_timestamp().alias("loaded_at")
    )


def records(spark: SparkSession, events: list[tuple[str, dict | str]]) -> DataFrame:
    """(day, event) pairs as records for the landing zone."""
    rows = [(day, e if isinstance(e, str) else json.dumps(e)) for day, e in events]
    return spark.createDataFrame(rows, "landing_date STRING, record STRING").withColumn(
        "landing_date", F.to_date("landing_date")
    )


def plan_of(df: DataFrame) -> str:
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain("formatted")
    return out.getvalue()


def by_key(df: DataFrame, *keys: str) -> dict:
    return {tuple(row[k] for k in keys) if len(keys) > 1 else row[keys[0]]: row for row in df.collect()}
