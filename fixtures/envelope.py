"""Feed events derived from the ``events`` table, whole table, one feed event per row.

With ``k`` = ``props.k``: repository ``k % 7``, push size ``k % 10`` (absent when 0), issue and
pull-request action ``k % 3``. The dirty variant breaks the records of single ``k`` values.
"""

from __future__ import annotations

from types import SimpleNamespace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from forgepulse import schemas as S
from forgepulse.functions.records import iso_utc
from forgepulse.sources.landing import stamp, to_records

# Event type of the table -> event type of the feed.
TYPE_OF = {
    "purchase": "PushEvent",
    "error": "IssuesEvent",
    "click": "PullRequestEvent",
    "view": "WatchEvent",
    "signup": "ForkEvent",
}
ACTIONS = ("opened", "closed", "reopened")

# What the dirty variant breaks, by k. 83 and 93 stay valid: numeric text, unknown extra field.
NO_LOGIN, BAD_TIME, NUMERIC_ID, NO_TYPE, TEXT_ACTOR_ID = 3, 13, 23, 33, 43
NO_REPO_NAME, NO_URLS, NO_ACTOR, NUMERIC_TEXT_ACTOR_ID, EXTRA_FIELD = 53, 63, 73, 83, 93
TEXT_REPO_ID, NUMERIC_DISPLAY_LOGIN = 27, 37

BASE_URL = "https://feed.example"


#: Rows of ``events`` whose records a task makes, roughly: 50 MB of text.
ROWS_PER_TASK = 100_000


def source_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _with_k(spark.read.parquet(f"{sf_dir}/events.parquet"))


def _with_k(events: DataFrame) -> DataFrame:
    return events.withColumn("k", F.variant_get(F.parse_json("props"), "$.k", "bigint"))


def dealt_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ``events`` table, without ``k`` yet, in tasks of about equal numbers of rows, by time. However many
    row groups the table has, and in whatever order, tasks then share the making of text, and each meets few
    days, hence few files."""
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    tasks = -(-events.count() // ROWS_PER_TASK)
    return events.repartitionByRange(tasks, "ts", "event_id") if tasks > 1 else events


def _leaves() -> SimpleNamespace:
    """Values of one clean feed event as expressions over the ``events`` table."""
    k, user = F.col("k"), F.col("user_id").cast("string")
    repo = (k % 7).cast("string")
    types = F.create_map(*[F.lit(x) for pair in TYPE_OF.items() for x in pair])
    action = F.array(*[F.lit(a) for a in ACTIONS])[(k % 3).cast("int")]
    return SimpleNamespace(
        event_id=F.col("event_id").cast("string"),
        event_type=types[F.col("event_type")],
        actor_id=F.col("user_id"),
        login=F.concat(F.lit("user_"), user),
        actor_url=F.concat(F.lit(f"{BASE_URL}/u/"), user),
        repo_id=k % 7,
        repo_name=F.concat(F.lit("org/repo_"), repo),
        repo_url=F.concat(F.lit(f"{BASE_URL}/r/"), repo),
        size=F.when((F.col("event_type") == "purchase") & (k % 10 != 0), k % 10),
        issue_action=F.when(F.col("event_type") == "error", action),
        pr_action=F.when(F.col("event_type") == "click", action),
    )


def _pull(events: DataFrame) -> Column:
    """Days between an event and the pull that delivered it."""
    return F.col("delay") if "delay" in events.columns else F.lit(0)


def _pulled_at(delay: Column) -> Column:
    return F.date_add(F.to_date("ts"), delay + 1).cast("timestamp_ntz")


def feed_events(events: DataFrame, dirty: bool = False) -> DataFrame:
    """``event`` struct, ``landing_date``; stamped with the next midnight as pull time, or
    ``delay`` days later where the input has that column."""

    def unless(broken_at: int, value: Column, otherwise: Column | None = None) -> Column:
        if not dirty:
            return value
        kept = F.when(F.col("k") != broken_at, value)
        return kept if otherwise is None else kept.otherwise(otherwise)

    leaf = _leaves()
    event_id, actor_id, repo_id = leaf.event_id, leaf.actor_id, leaf.repo_id
    if dirty:  # as variants, to give one field two JSON types
        event_id = unless(NUMERIC_ID, event_id.cast("variant"), F.col("event_id").cast("variant"))
        actor_id = (
            F.when(F.col("k") == TEXT_ACTOR_ID, F.lit("abc").cast("variant"))
            .when(F.col("k") == NUMERIC_TEXT_ACTOR_ID, actor_id.cast("string").cast("variant"))
            .otherwise(actor_id.cast("variant"))
        )
        repo_id = F.when(F.col("k") == TEXT_REPO_ID, F.lit("abc").cast("variant")).otherwise(
            repo_id.cast("variant")
        )
    actor = [
        actor_id.alias("id"),
        unless(NO_LOGIN, leaf.login).alias("login"),
        unless(NO_URLS, leaf.actor_url).alias("url"),
    ]
    if dirty:
        actor.append(F.when(F.col("k") == NUMERIC_DISPLAY_LOGIN, F.lit(5)).alias("display_login"))
    actor = F.struct(*actor)
    repo = F.struct(
        repo_id.alias("id"),
        unless(NO_REPO_NAME, leaf.repo_name).alias("name"),
        unless(NO_URLS, leaf.repo_url).alias("url"),
    )
    action = F.coalesce(leaf.issue_action, leaf.pr_action)
    fields = [
        event_id.alias("id"),
        unless(NO_TYPE, leaf.event_type).alias("type"),
        unless(NO_ACTOR, actor).alias("actor"),
        repo.alias("repo"),
        unless(BAD_TIME, iso_utc(F.col("ts")), F.lit("not-a-date")).alias("created_at"),
        F.struct(leaf.size.alias("size"), action.alias("action")).alias("payload"),
    ]
    if dirty:
        fields.append(F.when(F.col("k") == EXTRA_FIELD, F.lit("kept")).alias("unknown_field"))
    delay = _pull(events)
    shaped = events.select(
        F.struct(*fields).alias("event"),
        F.date_add(F.to_date("ts"), delay).alias("landing_date"),
        _pulled_at(delay).alias("pulled"), "ts", "k",
    )
    return stamp(shaped, F.col("pulled"), leaf.repo_name).drop("pulled")


def staged_events(events: DataFrame) -> DataFrame:
    """The staging relation of the clean feed as typed columns, without JSON in between: what a
    written staging table holds. Columns a query does not use are pruned down to the scan."""
    leaf = _leaves()
    typed = events.select(
        leaf.event_id.alias("event_id"),
        leaf.event_type.alias("event_type"),
        leaf.actor_id.alias("actor_id"),
        leaf.login.alias("actor_login"),
        leaf.repo_id.alias("repo_id"),
        leaf.repo_name.alias("repo_name"),
        F.col("ts").alias("event_timestamp"),
        _pulled_at(_pull(events)).alias("extracted_at"),
        leaf.repo_name.alias("source_repo"),
        leaf.size.alias("push_commit_count"),
        leaf.issue_action.alias("issue_action"),
        leaf.pr_action.alias("pr_action"),
    )
    star = F.when(F.col("event_type") == S.WATCH, 1).otherwise(0)
    return typed.withColumn("is_star_event", star)


def feed_records(events: DataFrame, dirty: bool = False) -> DataFrame:
    """``record`` JSON text with ``landing_date``, ``ts``, ``k``."""
    return to_records(feed_events(events, dirty))


def raw_events(events: DataFrame, dirty: bool = False) -> DataFrame:
    """The raw relation without a landing zone in between: the JSON text is parsed in flight."""
    return parse_records(feed_records(events, dirty))


def parsed_once(record: Column) -> Column:
    """A generator that yields ``record`` unchanged, one row for one row.

    The optimizer copies the expression behind a column into every filter and projection above
    it. A parser must not be copied, as each copy parses the text again; nothing is copied
    through a generator.
    """
    return F.explode(F.array(record))


def parse_records(records: DataFrame) -> DataFrame:
    return records.select(
        parsed_once(F.parse_json("record")).alias("raw_data"),
        F.current_timestamp().alias("loaded_at"),
    )


def overlapping_records(events: DataFrame, dirty: bool = False) -> DataFrame:
    """Two pulls per day: every event from 18:00 on comes again with the next day's pull, one
    day later, as copies with a later ``_extracted_at``."""
    pulls = F.when(F.hour("ts") >= 18, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    pulled = events.withColumn("delay", F.explode(pulls))
    # Found last, ``k`` is only parsed for the days that a filter leaves.
    return feed_records(pulled if "k" in events.columns else _with_k(pulled), dirty)
