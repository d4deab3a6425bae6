
from __future__ import annotations

import datetime as dt
import os
from collections.abc import Callable
from functools import reduce
from importlib.util import find_spec

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fixtures import envelope
from fixtures.oracle import ORACLE
from forgepulse import schemas as S
from forgepulse.functions import measures as M
from forgepulse.functions.measures import day_of
from forgepulse.operators import quality
from forgepulse.operators.staging import stg_events
from forgepulse.operators.validation import valid_records, validation_summary
from forgepulse.plans import build, insights, models, partials, reports
from forgepulse.plans import versions as V
from forgepulse.session import new_folder, settle
from forgepulse.sources import landing, raw_table
from forgepulse.streaming.incremental import incremental_load

Query = Callable[[SparkSession, str], DataFrame]

AS_OF = dt.datetime(2024, 1, 31)
REPO = "org/repo_1"


def _feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return envelope.source_events(spark, sf_dir)


def _raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw relation of the clean feed: events -> JSON text -> variant."""
    return envelope.raw_events(_feed(spark, sf_dir))


def _pulls(spark: SparkSession, sf_dir: str, dirty: bool = False) -> DataFrame:
    """Records of overlapping pulls, as the builds take them up."""
    return envelope.overlapping_records(envelope.dealt_events(spark, sf_dir), dirty)


def _staged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed staging relation, the input of the models; ``feed_*`` queries, ingest and the full build
    go through the JSON text instead."""
    return envelope.staged_events(_feed(spark, sf_dir))


def q_stg_payload(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stg_events(_raw(spark, sf_dir)).select("event_id", F.to_json("payload").alias("payload"))


def _comparable(staged: DataFrame) -> DataFrame:
    """Without the variant, which has no order or hash, and the load time."""
    return staged.drop("payload", "loaded_at")


# Models ------------------------------------------------------------------------------------


def q_stg_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _comparable(stg_events(_raw(spark, sf_dir)))


def q_feed_daily_activity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole way from JSON text to the model in one plan."""
    staged = stg_events(_raw(spark, sf_dir))
    return models.daily_activity(staged).orderBy(*models.daily_order())


def q_daily_activity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return models.daily_activity(_staged(spark, sf_dir)).orderBy(*models.daily_order())


def q_top_contributors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return models.leading_contributors(_staged(spark, sf_dir)).orderBy(*models.contributor_order())


def q_event_trends(spark: SparkSession, sf_dir: str) -> DataFrame:
    return models.event_trends(_staged(spark, sf_dir)).orderBy(*models.trend_order())


# Reports and metrics -----------------------------------------------------------------------


def q_repo_health(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.repo_health(models.daily_activity(_staged(spark, sf_dir)), REPO, AS_OF.date())


def q_repo_health_now(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Up to the current date, far enough back to meet the data."""
    return reports.repo_health(models.daily_activity(_staged(spark, sf_dir)), REPO, days=36_500)


def q_top_contributors_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.top_contributors_report(models.contributor_stats(_staged(spark, sf_dir)), REPO)


def q_trend_anomalies(spark: SparkSession, sf_dir: str) -> DataFrame:
    # The default threshold of 50 finds nothing in data this small.
    return reports.trend_anomalies(
        models.event_trends(_staged(spark, sf_dir)), AS_OF, threshold=1
    )


def q_daily_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    daily = models.daily_activity(_staged(spark, sf_dir))
    slim = daily.select("activity_date", "repo_name", "total_activity")
    return insights.daily_rank(settle(slim, "daily"))


def q_commit_velocity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return insights.commit_velocity(_staged(spark, sf_dir))


def q_issue_pr_trends(spark: SparkSession, sf_dir: str) -> DataFrame:
    return insights.issue_pr_trends(_staged(spark, sf_dir))


def q_engagement(spark: SparkSession, sf_dir: str) -> DataFrame:
    return insights.engagement(_staged(spark, sf_dir))


def q_retention(spark: SparkSession, sf_dir: str) -> DataFrame:
    return insights.retention(_staged(spark, sf_dir))


def q_contributor_growth(spark: SparkSession, sf_dir: str) -> DataFrame:
    return insights.contributor_growth(_staged(spark, sf_dir), period="week")


# Validation and data quality ---------------------------------------------------------------


def _dirty_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return envelope.raw_events(_feed(spark, sf_dir), dirty=True)


def q_validate_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stg_events(valid_records(_dirty_raw(spark, sf_dir)), strict=False).select(
        "event_id", "event_type", "actor_id", "actor_login", "repo_name", "event_timestamp"
    )


def q_validated_dump(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_folder(spark, "validated")
    landing.write_valid_dump(valid_records(_dirty_raw(spark, sf_dir)), path)
    dumped = spark.read.text(path).select(F.parse_json("value").alias("r"))
    return dumped.groupBy(F.variant_get("r", "$.type", "string").alias("event_type")).agg(
        F.count(F.lit(1)).alias("events"),
        F.count(F.variant_get("r", "$.unknown_field", "string")).alias("with_unknown_field"),
    )


def q_validate_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return validation_summary(_dirty_raw(spark, sf_dir))


def _overlapping(spark: SparkSession, sf_dir: str) -> DataFrame:
    return envelope.parse_records(envelope.overlapping_records(_feed(spark, sf_dir)))


def q_dq_unique(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.duplicate_keys(stg_events(_overlapping(spark, sf_dir)), "event_id")


def q_dq_not_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    staged = stg_events(_dirty_raw(spark, sf_dir), strict=False).drop("payload")
    staged = settle(staged, "dirty_staged")
    top = models.top_contributors(settle(models.contributor_stats(staged), "dirty_stats"))
    results = quality.model_results(
        staged, models.daily_activity(staged), top, models.event_trends(staged)
    )
    return results.where(F.col("check_name") == "not_null")


def q_dq_accepted_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Types with a column of their own in the staging relation; forks are reported.
    accepted = (S.PUSH, S.ISSUES, S.PULL_REQUEST, S.WATCH)
    return quality.unexpected_values(_staged(spark, sf_dir), "event_type", accepted)


def q_dq_relationships(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = spark.read.parquet(f"{sf_dir}/customer.parquet")
    return quality.orphans(customers, "c_custkey", _staged(spark, sf_dir), "actor_id")


def q_dq_row_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    daily = _staged(spark, sf_dir).select(day_of().alias("activity_date"))
    return quality.row_counts(daily, "activity_date", at_least=300)


def q_gate_nonempty(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.require_rows(_raw(spark, sf_dir))


def q_gate_dq(spark: SparkSession, sf_dir: str) -> DataFrame:
    staged = settle(stg_events(_raw(spark, sf_dir)).drop("payload"), "staged")
    top = models.top_contributors(settle(models.contributor_stats(staged), "stats"))
    return quality.gate(
        quality.model_results(
            staged, models.daily_activity(staged), top, models.event_trends(staged)
        )
    )


# Ingest ------------------------------------------------------------------------------------


def _land(spark: SparkSession, records: DataFrame, layout: str = "lines") -> str:
    path = new_folder(spark, "landing")
    landing.write_landing(records, path, layout)
    return path


def _damaged(records: DataFrame, at: int = 13) -> DataFrame:
    """Records of one k value lose their end, as if a transfer broke off."""
    cut = F.expr("left(record, length(record) - 7)")
    return records.withColumn("record", F.when(F.col("k") == at, cut).otherwise(F.col("record")))


def _loaded(spark: SparkSession, path: str, layout: str = "lines") -> str:
    """Raw table with the whole landing zone as one load."""
    raw_path = new_folder(spark, "raw")
    parsed = landing.parse_landing(landing.scan_landing(spark, path, layout))
    raw_table.append_load(parsed, raw_path, "load-1")
    return raw_path


def q_ingest_landing(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _land(spark, envelope.feed_records(_feed(spark, sf_dir)), "array")
    raw = raw_table.read_raw(spark, _loaded(spark, path, "array"))
    staged = stg_events(raw, keep=[*S.LANDING_PARTITIONS, "file_name"])
    own = F.format_string("/year=%d/month=%02d/day=%02d/", *S.LANDING_PARTITIONS)
    return _comparable(
        staged.withColumn("in_own_folder", F.contains("file_name", own))
        .withColumn("has_load_time", F.col("loaded_at").isNotNull()).drop("file_name")
    )


def q_ingest_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _land(spark, _damaged(envelope.feed_records(_feed(spark, sf_dir))))
    raw_path, day = _loaded(spark, path), list(S.LANDING_PARTITIONS)
    both = raw_table.read_raw(spark, raw_path).select(*day, F.lit(1).alias("ok")).unionAll(
        raw_table.read_quarantine(spark, raw_path).select(*day, F.lit(0))
    )
    return both.groupBy(*day).agg(
        F.count_if(F.col("ok") == 1).alias("loaded"),
        F.count_if(F.col("ok") == 0).alias("quarantined"),
    )


def q_ingest_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _land(spark, _damaged(envelope.feed_records(_feed(spark, sf_dir))))
    parsed = landing.parse_landing(landing.scan_landing(spark, path))
    counts = raw_table.append_load(parsed, new_folder(spark, "raw"), "load-1")
    return raw_table.counts_frame(spark, [counts])


def q_ingest_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three runs over a growing landing zone: three days, nothing new, all other days."""
    records = envelope.feed_records(_feed(spark, sf_dir))
    first_days = F.col("landing_date") <= F.lit(dt.date(2024, 1, 3))
    path, raw_path = new_folder(spark, "landing"), new_folder(spark, "raw")
    run_of: dict[str, int] = {}
    for run, arrivals in ((1, records.where(first_days)), (2, None), (3, records.where(~first_days))):
        if arrivals is not None:
            landing.write_landing(arrivals, path)
        loads = incremental_load(spark, path, raw_path, max_files_per_load=100)
        run_of.update({load.load_id: run for load in loads})
    runs = F.create_map(*[F.lit(x) for pair in run_of.items() for x in pair])
    return (
        raw_table.read_raw(spark, raw_path)
        .groupBy(runs[F.col("load_id")].alias("run"), F.make_date("year", "month", "day").alias("landing_date"))
        .agg(F.count(F.lit(1)).alias("events"))
    )


def q_ingest_arrays(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files that are one array over several lines each, loaded without being told so."""
    records = envelope.feed_records(_feed(spark, sf_dir))
    path, raw_path = new_folder(spark, "landing"), new_folder(spark, "raw")
    landing.write_landing(records.withColumn("record", F.concat(F.lit("\n  "), "record")), path, "array")
    incremental_load(spark, path, raw_path)
    staged = stg_events(raw_table.read_raw(spark, raw_path), keep=["file_name"])
    kept = raw_table.read_quarantine(spark, raw_path).select(
        F.make_date(*S.LANDING_PARTITIONS).alias("landing_date"), F.lit(None).cast("bigint").alias("actor_id"),
        F.lit(1).alias("unread"),
    )
    day = F.make_date(*[
        F.regexp_extract("file_name", f"/{part}=([0-9]+)/", 1).cast("int") for part in S.LANDING_PARTITIONS
    ])
    both = staged.select(day.alias("landing_date"), "actor_id", F.lit(0).alias("unread")).unionAll(kept)
    return both.groupBy("landing_date").agg(
        F.count_if(F.col("unread") == 0).alias("events"), F.sum("actor_id").alias("actor_id_sum"),
        F.sum("unread").alias("quarantined"),
    )


def q_ingest_compacted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Many small loads, put together by landing day: the same rows in one file a day, or full ones."""
    path, raw_path = _land(spark, envelope.feed_records(_feed(spark, sf_dir))), new_folder(spark, "raw")
    incremental_load(spark, path, raw_path, "lines", max_files_per_load=25)
    folder = raw_table.compact_loads(spark, raw_path)
    raw_table.remove_moved(spark, raw_path)
    files = spark.read.format("binaryFile").load(f"{raw_path}/load_id={folder}").select("path", "length")
    day = F.make_date(*[
        F.regexp_extract("path", f"/{part}=([0-9]+)/", 1).cast("int") for part in S.LANDING_PARTITIONS
    ])
    sizes = files.groupBy(day.alias("landing_date")).agg(
        (M.rows() <= 1 + F.sum("length") / (64 * 2**20)).alias("packed")
    )
    events = stg_events(raw_table.read_raw(spark, raw_path), keep=list(S.LANDING_PARTITIONS))
    return events.groupBy(F.make_date(*S.LANDING_PARTITIONS).alias("landing_date")).agg(
        M.rows().alias("events"), F.count_distinct("event_id").alias("event_ids")
    ).join(sizes, "landing_date")


def q_ingest_accounting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What became of every landed record of dirty, damaged, overlapping pulls, by landing day."""
    records = _pulls(spark, sf_dir, dirty=True)
    path, root = _land(spark, _damaged(records, at=17)), new_folder(spark, "build")
    build.run_build(spark, path, root)
    raw_path, day = f"{root}/raw_events", F.make_date(*S.LANDING_PARTITIONS)
    raw, rejects = raw_table.read_raw(spark, raw_path), build.read_rejects(spark, root)
    quarantined = raw_table.read_quarantine(spark, raw_path)
    staged = V.read_days(spark, root, build.STAGING, S.STAGED_SCHEMA, V.read_state(spark, root))
    of_pull = F.date_sub(F.to_date("extracted_at"), 1)
    outcomes = [
        (raw.unionByName(quarantined, allowMissingColumns=True), day, F.lit("landed")),
        (quarantined, day, F.lit("quarantined")),
        (rejects, day, F.concat(F.lit("rejected:"), F.get("reasons", F.lit(0)))),
        (staged, of_pull, F.lit("staged")),
    ]
    parts = [
        rows.groupBy(d.alias("landing_date"), name.alias("outcome")).agg(M.rows().alias("records"))
        for rows, d, name in outcomes
    ]
    valid = valid_records(raw).groupBy(day.alias("landing_date")).agg(M.rows().alias("valid"))
    kept = parts[-1].select("landing_date", F.col("records").alias("kept"))
    copies = valid.join(kept, "landing_date", "left").select(
        "landing_date", F.lit("copies").alias("outcome"),
        (F.col("valid") - F.coalesce("kept", F.lit(0))).alias("records"),
    )
    return reduce(DataFrame.unionAll, [*parts, copies.where(F.col("records") > 0)])


def q_ingest_read_back(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every landed file by its own path."""
    path = _land(spark, envelope.feed_records(_feed(spark, sf_dir)), "array")
    files = [r["path"] for r in landing.list_files(spark, path).select("path").collect()]
    return _comparable(stg_events(landing.read_back(spark, path, files, "array")))


def q_ingest_pruned(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _land(spark, envelope.feed_records(_feed(spark, sf_dir)))
    text = landing.scan_landing(spark, path).where(
        (F.col("year") == 2024) & (F.col("month") == 1) & F.col("day").between(10, 12)
    )
    return _comparable(stg_events(landing.readable(landing.parse_landing(text))))


def q_ingest_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two landing zones, one per half of the month, read as one bag of events."""
    records = envelope.feed_records(_feed(spark, sf_dir))
    first_half = F.col("landing_date") < F.lit(dt.date(2024, 1, 16))
    paths = [_land(spark, records.where(first_half)), _land(spark, records.where(~first_half))]
    return (
        stg_events(landing.read_landing(spark, paths))
        .groupBy("source_repo", "event_type")
        .agg(F.count(F.lit(1)).alias("events"), F.sum("actor_id").alias("actor_id_sum"))
    )


def q_ingest_stamp(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stg_events(_raw(spark, sf_dir)).select("event_id", "extracted_at", "source_repo")


def q_ingest_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _comparable(build.staging_of(_overlapping(spark, sf_dir)))


def q_landing_inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _land(spark, envelope.feed_records(_feed(spark, sf_dir)))
    return landing.landing_inventory(spark, path).groupBy("landing_date").agg(
        F.sum("bytes").alias("bytes")
    )


def q_full_build(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _land(spark, _pulls(spark, sf_dir))
    return build.run_build(spark, path, new_folder(spark, "build"))


def q_build_materialized(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The models as tables, as another session reads them."""
    path = _land(spark, _pulls(spark, sf_dir))
    build.run_build(spark, path, new_folder(spark, "build"), materialize=True)
    return spark.newSession().table("daily_activity")


def _built_in_three_runs(spark: SparkSession, records: DataFrame) -> str:
    path, root = new_folder(spark, "landing"), new_folder(spark, "build")
    day = F.dayofmonth("landing_date")
    for arrivals in (day <= 10, (day > 10) & (day <= 12), day > 12):
        landing.write_landing(records.where(arrivals), path)
        build.run_build(spark, path, root)
    return root


def q_build_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The three models after three arrivals, one row per row of a model."""
    records = _pulls(spark, sf_dir)
    tables = build.open_build(spark, _built_in_three_runs(spark, records))
    daily = tables["daily_activity"].select(
        F.lit("daily_activity").alias("model"), "repo_name", F.col("activity_date").cast("string").alias("key"),
        F.col("total_activity").alias("events"), F.col("unique_contributors").alias("people"),
        F.col("week_avg").alias("value"),
    )
    trends = tables["event_trends"].select(
        F.lit("event_trends"), "repo_name",
        F.concat_ws(" ", "event_type", F.date_format("event_hour", "yyyy-MM-dd HH")), "event_count",
        "unique_users", F.col("over_hour_change").cast("double"),
    )
    top = tables["top_contributors"].select(
        F.lit("top_contributors"), "repo_name", "contributor", "total_events", "event_types_used",
        F.col("contribution_score").cast("double"),
    )
    return daily.unionAll(trends).unionAll(top)


def q_build_insights(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Retention and growth after three arrivals, from daily aggregates; growth also as sketches see it."""
    records = _pulls(spark, sf_dir)
    root = _built_in_three_runs(spark, records)
    read = build.aggregates_of(spark, root, V.read_state(spark, root))
    counts, sketches = read["contributor_counts"], read["daily_people"]
    kept = partials.retention(counts).select(
        F.lit("retention").alias("metric"), "repo_name", "week_start", "contributors", F.col("retained").alias("other"),
        F.lit(True).alias("estimate_is_near"),
    )
    near = partials.contributor_growth(counts, sketches, "week", approximate=True).select(
        "repo_name", "period_start", F.col("contributors").alias("estimate")
    )
    grown = partials.contributor_growth(counts, sketches, "week").join(near, ["repo_name", "period_start"], "left")
    error = F.abs(F.col("estimate") - F.col("contributors"))
    return kept.unionAll(grown.select(
        F.lit("growth"), "repo_name", "period_start", "contributors", "prev_contributors",
        F.coalesce(error <= F.greatest(F.lit(1), F.col("contributors") * 0.065), F.lit(False)),
    ))


# Contract ----------------------------------------------------------------------------------


def entry(spark: SparkSession) -> DataFrame:
    """Flagship: from feed JSON to daily repository activity with its rolling mean."""
    return q_feed_daily_activity(spark, os.environ.get("ENTRY_SF_DIR", "/root/testdata/sf0.001"))


def _is_there(module: str) -> bool:
    found = find_spec(module)
    return found is not None and found.origin is not None  # an emptied folder has no origin


def _pipeline_parts() -> list[tuple[dict[str, Query], dict[str, str]]]:
    """Queries and DuckDB counterparts of the training-data operators and of their pipeline, as far
    as these are there; errors inside them are not swallowed."""
    parts: list[tuple[dict[str, Query], dict[str, str]]] = []
    if _is_there("forgepulse.llm"):
        from forgepulse.llm import queries as llm

        parts.append((llm.QUERIES, llm.ORACLE))
        if _is_there("corpus_pipeline"):
            import corpus_pipeline

            oracle = corpus_pipeline.ORACLE_SQL
            parts.append(({"pipeline": corpus_pipeline.run}, {"pipeline": oracle} if oracle else {}))
    return parts


def queries() -> dict[str, Query]:
    """Every registered query by name."""
    own = {
        name.removeprefix("q_"): function
        for name, function in globals().items()
        if name.startswith("q_")
    }
    for added, _ in _pipeline_parts():
        own.update(added)
    return own


def oracle_sql() -> dict[str, str]:
    """DuckDB counterparts of the queries that SQL expresses."""
    own = dict(ORACLE)
    for _, added in _pipeline_parts():
        own.update(added)
    return own
