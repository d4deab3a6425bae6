"""Declared schemas and fixed values. Schemas are never inferred from data."""

from __future__ import annotations

# Event types that the models name.
PUSH = "PushEvent"
ISSUES = "IssuesEvent"
PULL_REQUEST = "PullRequestEvent"
WATCH = "WatchEvent"
FORK = "ForkEvent"
EVENT_TYPES = (PUSH, ISSUES, PULL_REQUEST, WATCH, FORK)

# Points per commit, pull request and issue event in the contribution score.
SCORE_WEIGHTS = {"commit_count": 2, "pr_count": 5, "issue_count": 1}

# Leaderboard size, rolling-mean length in rows, report defaults.
TOP_K = 20
ROLLING_ROWS = 7
REPORT_K = 10
HEALTH_DAYS = 30
ANOMALY_THRESHOLD = 50
ANOMALY_HOURS = 24

# Landing zone: text files below year=YYYY/month=MM/day=DD.
LANDING_PARTITIONS = ("year", "month", "day")
LANDING_SCHEMA = "value STRING, year INT, month INT, day INT"

# Raw table: one semi-structured record per event, with lineage; unreadable text beside it.
RAW_SCHEMA = (
    "raw_data VARIANT, file_name STRING, loaded_at TIMESTAMP, "
    "load_id STRING, year INT, month INT, day INT"
)
RAW_TABLE_SCHEMA = (
    "raw_data VARIANT, raw_text STRING, file_name STRING, loaded_at TIMESTAMP, "
    "of_load STRING, load_id STRING, readable BOOLEAN, year INT, month INT, day INT"
)
# Loads: a row per committed load, or per load that has moved to another folder; and a row per file of a
# load, committed or not.
LOADS_SCHEMA = "load_id STRING, rows_loaded BIGINT, rows_quarantined BIGINT, folder STRING"
LOADED_FILES_SCHEMA = "load_id STRING, path STRING, length BIGINT"

# Staging relation: column, path in the record, type. Ids are BIGINT because feeds issue ids
# beyond 2^31; timestamps are the wall clock of the feed (UTC).
STAGED_FIELDS = (
    ("event_id", "$.id", "string"),
    ("event_type", "$.type", "string"),
    ("actor_id", "$.actor.id", "bigint"),
    ("actor_login", "$.actor.login", "string"),
    ("repo_id", "$.repo.id", "bigint"),
    ("repo_name", "$.repo.name", "string"),
    ("event_timestamp", "$.created_at", "timestamp_ntz"),
    ("extracted_at", "$._extracted_at", "timestamp_ntz"),
    ("source_repo", "$._source_repo", "string"),
    ("payload", "$.payload", "variant"),
)
STAGED_SCHEMA = (
    "event_id STRING, event_type STRING, actor_id BIGINT, actor_login STRING, repo_id BIGINT, "
    "repo_name STRING, event_timestamp TIMESTAMP_NTZ, extracted_at TIMESTAMP_NTZ, "
    "source_repo STRING, payload VARIANT, push_commit_count BIGINT, issue_action STRING, "
    "pr_action STRING, is_star_event INT, loaded_at TIMESTAMP, event_date DATE"
)
# Column, the only event type that carries it, path, type.
STAGED_BY_TYPE = (
    ("push_commit_count", PUSH, "$.payload.size", "bigint"),
    ("issue_action", ISSUES, "$.payload.action", "string"),
    ("pr_action", PULL_REQUEST, "$.payload.action", "string"),
)
