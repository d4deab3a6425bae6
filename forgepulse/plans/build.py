"""The whole run: landing zone -> raw -> staging -> models -> checks -> published state.

A run stages the loads that the published state does not hold yet, writes the days that they change,
checks what it wrote, and only then publishes. A run that fails leaves the state, its files and the
views on them as they were; the next run takes up its loads again. Runs may overlap: the one that
publishes second starts again from the state that the first has left.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from forgepulse import schemas as S
from forgepulse.functions import measures as M
from forgepulse.operators import quality
from forgepulse.operators.copies import latest_copy
from forgepulse.operators.id_bitmaps import may_be_held
from forgepulse.operators.staging import stg_events
from forgepulse.operators.validation import REASONS, all_reasons_of, untypable, valid_records
from forgepulse.plans import materialized, partials
from forgepulse.plans import versions as V
from forgepulse.session import settle
from forgepulse.sources import raw_table
from forgepulse.sources.raw_table import read_raw
from forgepulse.streaming.incremental import FILES_PER_LOAD, incremental_load

#: Rows of a day in one staging file, roughly.
FILE_ROWS = 2_000_000
STAGING = "stg_events"


@dataclass
class Staged:
    """What a run did to staging."""

    touched: list[dt.date] = field(default_factory=list)
    filled: list[dt.date] = field(default_factory=list)
    rejected: dict[str, int] = field(default_factory=dict)


def staging_of(raw: DataFrame) -> DataFrame:
    """Validated, typed, one row per event. Values of the wrong type in fields that validation
    does not cover are NULL."""
    return latest_copy(stg_events(valid_records(raw), strict=False), null_keys=False)


def all_reasons() -> list[str]:
    return [*REASONS, *[f"type:{name}" for name in untypable()]]


def checked_records(raw: DataFrame, counts: Observation) -> DataFrame:
    """Records in one pass: staging columns and the day of those that can be staged; the others, with
    ``rejected`` set, whole and with the reasons. How many broke each rule, and how many broke any, is
    counted while the rows pass."""
    bad = F.size("reasons") > 0
    # Values and reasons come from one projection over the scan, which then reads their paths typed: behind the
    # counters, or behind another projection, each value would be looked up in the whole record.
    typed = stg_events(raw, strict=False, keep=[*_REJECTED, all_reasons_of().alias("reasons")])
    checked = typed.observe(
        counts,
        F.count_if(bad).alias("any"),
        *[F.count_if(F.array_contains("reasons", r)).alias(r) for r in all_reasons()],
    )
    whole = (*_REJECTED, "reasons")
    return checked.select(
        *[c for c in checked.columns if c not in whole], *[F.when(bad, F.col(c)).alias(c) for c in whole],
        bad.alias("rejected"), M.day_of().alias(V.DAY),
    )


#: What a rejected record keeps beside its load time.
_REJECTED = ("raw_data", "file_name", "load_id", *S.LANDING_PARTITIONS)


def _moved(spark: SparkSession, new: DataFrame, root: str, state: V.State) -> DataFrame:
    """(event_id, event_date) of copies that lose to a copy of another day: in the new rows or in the
    days held so far. Of these, only days that may hold a new event by their bitmaps are read, and of
    them only the keys of new events."""
    keys = [c for c in new.columns if c != "payload"]
    fresh = new.select(*keys)
    ids = fresh.select("event_id", V.DAY).distinct()
    bits = V.read_days(spark, root, "event_ids", partials.SCHEMAS["event_ids"], state)
    held = settle(may_be_held(ids, bits, V.DAY), "ids-held")
    apart = (
        ids.unionAll(held).groupBy("event_id")
        .agg(F.min(V.DAY).alias("low"), F.max(V.DAY).alias("high"))
        .where(F.col("low") != F.col("high")).select("event_id")
    )
    several = settle(apart, "ids-on-several-days")
    if several.isEmpty():
        return several.withColumn(V.DAY, F.lit(None).cast("date"))
    days = [r[V.DAY] for r in held.select(V.DAY).distinct().collect()]
    old = V.read_days(spark, root, STAGING, S.STAGED_SCHEMA, state, days).select(*keys)
    both = fresh.unionAll(old).join(several, "event_id", "left_semi")
    best = latest_copy(both, null_keys=False).select("event_id", F.col(V.DAY).alias("best"))
    return settle(
        both.select("event_id", V.DAY).distinct().join(best, "event_id")
        .where(F.col(V.DAY) != F.col("best")).select("event_id", V.DAY),
        "moved-copies",
    )


def update_staging(
    spark: SparkSession, raw: DataFrame, root: str, run: str, state: V.State
) -> Staged:
    """Write the days of staging that ``raw`` changes, one copy per event, as days of ``run``.

    The records are parsed and checked once, while their typed rows, and rejected ones whole, are written. Wide rows
    are then shuffled once, by day and a share of the event ids, deduplicated there and written from there.
    Copies of an event that disagree on its day are found by bitmaps and keys alone; then the days of the
    copies that lose are written again as well.
    """
    counts, done = Observation("records"), Staged()
    checked = settle(checked_records(raw, counts), "checked-records", ["rejected"])
    found = counts.get
    done.rejected = {r: found[r] for r in all_reasons() if found.get(r)}
    done.rejected["any"] = found.get("any", 0)
    if done.rejected["any"]:
        rejects = checked.where("rejected").select(*_REJECTED, "loaded_at", "reasons", F.lit(run).alias("run"))
        rejects.write.mode("append").parquet(f"{root}/rejects")
    new = checked.where("NOT rejected").drop(*_REJECTED, "reasons", "rejected")
    arrived = {r[V.DAY]: r["n"] for r in new.groupBy(V.DAY).agg(M.rows().alias("n")).collect()}
    moved = _moved(spark, new, root, state)
    left = [r[V.DAY] for r in moved.select(V.DAY).distinct().collect()]
    done.touched = sorted({*arrived, *left})
    old = V.read_days(spark, root, STAGING, S.STAGED_SCHEMA, state, done.touched)
    rows = old.unionByName(new)
    if left:
        rows = rows.join(moved, ["event_id", V.DAY], "left_anti")
    total = old.count() + sum(arrived.values())
    shares = max(1, -(-total // (FILE_ROWS * max(1, len(done.touched)))))
    share = F.pmod(F.xxhash64("event_id"), F.lit(shares)).alias("share")
    dealt = rows.select("*", share).repartition(V.DAY, "share")
    kept = latest_copy(dealt, null_keys=False, within=(V.DAY, "share")).drop("share")
    V.write_days(kept, root, STAGING, run, ["repo_name"])
    written = spark.read.schema(S.STAGED_SCHEMA).parquet(V.folder(root, STAGING, run))
    done.filled = sorted(r[V.DAY] for r in written.select(V.DAY).distinct().collect())
    return done


def build_partials(staged: DataFrame, root: str, run: str) -> None:
    """Write the daily aggregates of the staged days.

    They do not depend on each other and are submitted together: executors that the last tasks of
    one leave idle work on the next.
    """
    jobs = partials.all_of(staged)
    with ThreadPoolExecutor(len(jobs)) as pool:
        running = [
            pool.submit(V.write_days, made.hint("rebalance", V.DAY), root, name, run)
            for name, made in jobs.items()
        ]
    for job in running:
        job.result()


def aggregates_of(spark: SparkSession, root: str, state: V.State) -> dict[str, DataFrame]:
    return {
        name: V.read_days(spark, root, name, schema, state) for name, schema in partials.SCHEMAS.items()
    }


def tables_of(
    spark: SparkSession, root: str, state: V.State, k: int = S.TOP_K
) -> dict[str, DataFrame]:
    """Staging and the models as of a state. Models are added up from the daily aggregates when they
    are read: a filter on the repository reaches their scans."""
    read = aggregates_of(spark, root, state)
    stats = partials.contributor_stats(read["contributor_counts"])
    return {
        STAGING: V.read_days(spark, root, STAGING, S.STAGED_SCHEMA, state).drop(V.DAY),
        "daily_activity": partials.daily_activity(read["daily_counts"]),
        "contributor_stats": stats,
        "top_contributors": partials.leading_contributors(read["contributor_counts"], k),
        "event_trends": partials.event_trends(read["hourly_counts"]),
        "retention": partials.retention(read["contributor_counts"]),
        "contributor_growth": partials.contributor_growth(read["contributor_counts"], read["daily_people"]),
    }


def changed_results(spark: SparkSession, root: str, run: str, state: V.State) -> DataFrame:
    """The declared checks over what a run wrote, not over all that is held."""
    days = [d for d, r in state.days.get(STAGING, {}).items() if r == run]
    staged = V.read_days(spark, root, STAGING, S.STAGED_SCHEMA, state, days)
    part = {
        name: V.read_days(spark, root, name, schema, state, days)
        for name, schema in partials.SCHEMAS.items()
    }
    daily = part["daily_counts"].withColumnRenamed(V.DAY, "activity_date")
    return quality.model_results(staged, daily, part["contributor_counts"], part["hourly_counts"])


def publish(df: DataFrame, name: str, path: str | None = None) -> DataFrame:
    """Offer a table under ``name``: a view, or with ``path`` a table of the catalog whose files are
    written there first, so that readers of the table before keep theirs."""
    if path:
        catalog = df.sparkSession.catalog
        stored = f"{catalog.currentDatabase()}.{name}"  # a view of that name would hide the table
        df.write.mode("overwrite").option("path", path).saveAsTable(stored)
        catalog.dropTempView(name)
        return df.sparkSession.table(stored)
    df.createOrReplaceTempView(name)
    return df


def open_build(
    spark: SparkSession, root: str, k: int = S.TOP_K, materialize: bool = False
) -> dict[str, DataFrame]:
    """Publish the last state of a build, of this session or any other: as views, or with
    ``materialize`` staging and the three models as tables of the catalog, which other sessions see."""
    if materialize:
        materialized.update(spark, root, k)
    tables = tables_of(spark, root, V.read_state(spark, root), k)
    for name, table in tables.items():
        if materialize and name in materialized.TABLES:
            tables[name] = materialized.table(spark, name)
        else:
            publish(table, name)
    return tables


def run_build(
    spark: SparkSession,
    landing: str,
    root: str,
    layout: str = "auto",
    k: int = S.TOP_K,
    rebuild: bool = False,
    compact: bool = False,
    strict: bool = False,
    materialize: bool = False,
    max_files_per_load: int = FILES_PER_LOAD,
    days: Sequence[dt.date] | None = None,
) -> DataFrame:
    """Load new files, stage the days that they change, aggregate and check these, publish; returns
    rows per stage.

    Records that break a rule or hold values of the wrong type are rejected: counted by reason, and
    kept whole in ``rejects``. With ``strict`` any rejected record fails the run before it publishes.
    A run without new events fails. ``rebuild`` stages all loads again. ``days`` limits the listing of
    the landing zone (see ``incremental_load``); ``compact`` is for a first load of many days;
    ``materialize`` keeps tables of the catalog instead of views (see ``forgepulse.plans.materialized``).
    """
    raw_path = f"{root}/raw_events"
    incremental_load(spark, landing, raw_path, layout, max_files_per_load, days, compact)
    attempts = 0
    while (result := _stage_pending(spark, root, rebuild, strict, attempts > 0)) is None:
        attempts += 1  # another run has published: start again from its state
    loads, staged, checks = result
    return stage_counts(spark, loads, staged, open_build(spark, root, k, materialize), checks)


def _stage_pending(
    spark: SparkSession, root: str, rebuild: bool, strict: bool, again: bool
) -> tuple[list, Staged, int] | None:
    """Stage the loads that the published state does not hold, and publish; None if another run has
    published first. Nothing of what this run wrote is seen then."""
    raw_path, run, tables = f"{root}/raw_events", V.new_run(), [STAGING, *partials.SCHEMAS]
    published = V.read_state(spark, root)
    before = V.State(published.number) if rebuild else published
    committed = raw_table.loads(spark, raw_path)
    if not rebuild:
        committed = committed.join(V.staged_loads(spark, root), "load_id", "left_anti")
    loads = [
        raw_table.LoadCounts(r["load_id"], r["rows_loaded"], r["rows_quarantined"])
        for r in committed.select("load_id", "rows_loaded", "rows_quarantined").collect()
    ]
    if not sum(c.rows_loaded for c in loads):
        if again:  # the other run has staged all that this one had
            return [], Staged(rejected={"any": 0}), 0
        raise quality.QualityError("no events extracted")
    pending = [c.load_id for c in loads]
    staged = update_staging(spark, read_raw(spark, raw_path, pending), root, run, before)
    if strict and staged.rejected["any"]:
        raise quality.QualityError(f"rejected records: {staged.rejected}")
    checks = 0
    if staged.filled:
        after = before.with_run(run, tables, staged.touched, staged.filled)
        written = V.read_days(spark, root, STAGING, S.STAGED_SCHEMA, after, staged.filled)
        build_partials(written, root, run)
        checks = quality.gate(changed_results(spark, root, run, after)).count()
    elif not before.number:
        raise quality.QualityError(f"no record can be staged: {staged.rejected}")
    held = published.days.get(STAGING, {}) if rebuild else ()  # days that a rebuild no longer has
    touched = sorted({*staged.touched, *held})
    done = V.publish_run(spark, root, published, run, tables, touched, staged.filled, pending)
    return (loads, staged, checks) if done else None


def stage_counts(
    spark: SparkSession, loads: list, staged: Staged, tables: dict[str, DataFrame], checks: int
) -> DataFrame:
    """Rows per stage of one run."""
    known = [
        ("rows_loaded", sum(c.rows_loaded for c in loads)),
        ("rows_quarantined", sum(c.rows_quarantined for c in loads)),
        ("rows_rejected", staged.rejected["any"]),
        *[(f"rejected:{r}", n) for r, n in staged.rejected.items() if r != "any"],
        ("checks_passed", checks),
    ]
    counted = spark.createDataFrame(known, "stage STRING, records BIGINT")
    for name in (STAGING, "daily_activity", "top_contributors", "event_trends"):
        rows = tables[name].agg(M.rows().alias("records"))
        counted = counted.unionAll(rows.select(F.lit(name).alias("stage"), "records"))
    return counted


def read_rejects(spark: SparkSession, root: str) -> DataFrame:
    """Records that published runs have rejected, whole, with their reasons."""
    schema = f"{S.RAW_SCHEMA}, reasons ARRAY<STRING>, run STRING"
    rejects = raw_table.read_if_there(spark, schema, f"{root}/rejects")
    return rejects.join(V.published_runs(spark, root), "run", "left_semi")
