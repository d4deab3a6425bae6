from __future__ import annotations

import datetime as dt
import json
from pathlib import Path
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from fixtures.envelope import overlapping_records, source_events, staged_events
from forgepulse import schemas as S
from forgepulse.operators import quality
from forgepulse.operators.copies import latest_copy
from forgepulse.operators.quality import QualityError
from forgepulse.plans import build, insights, materialized, models, partials
from forgepulse.plans import versions as V
from forgepulse.session import new_folder, settle, shared_folder, shuffle_conf
from forgepulse.sources import landing
from tests.helpers import feed_event, plan_of, records, staged

SF_DIR = "/root/testdata/sf0.001"
SCHEMAS = {"stg_events": S.STAGED_SCHEMA, **partials.SCHEMAS}


def same(left, right) -> bool:
    left = left.select(*right.columns)
    return left.exceptAll(right).isEmpty() and right.exceptAll(left).isEmpty()


def counts_of(result) -> dict[str, int]:
    return {r["stage"]: r["records"] for r in result.collect()}


def land(spark, folder, events, name="l"):
    landing.write_landing(records(spark, events), folder(name))


def staged_rows(spark, folder, name="out"):
    return V.read_days(spark, folder(name), build.STAGING, S.STAGED_SCHEMA, V.read_state(spark, folder(name)))


def test_whole_run_equals_the_models_on_typed_rows(spark, folder):
    events = source_events(spark, SF_DIR)
    landing.write_landing(overlapping_records(events), folder("l"))
    counts = counts_of(build.run_build(spark, folder("l"), folder("out")))
    assert counts["rows_loaded"] > counts["stg_events"] == 1000
    assert counts["checks_passed"] == 12 and counts["rows_rejected"] == 0
    typed = staged_events(events)
    assert same(spark.table("daily_activity"), models.daily_activity(typed))
    assert same(spark.table("event_trends"), models.event_trends(typed))
    stats = models.contributor_stats(typed)
    assert same(spark.table("contributor_stats"), stats)
    assert same(spark.table("top_contributors"), models.top_contributors(stats))


def test_second_run_adds_new_files(spark, folder):
    land(spark, folder, [("2024-01-05", feed_event(1))])
    build.run_build(spark, folder("l"), folder("out"))
    land(spark, folder, [("2024-01-06", feed_event(1)), ("2024-01-06", feed_event(2))])
    counts = counts_of(build.run_build(spark, folder("l"), folder("out")))
    assert counts["rows_loaded"] == 2 and counts["stg_events"] == 2


def test_merging_day_by_day_equals_one_build(spark, folder):
    """Overlapping pulls arrive in four runs; the tables must equal a build from all files at once."""
    everything = overlapping_records(source_events(spark, SF_DIR)).cache()
    for first, last in ((1, 5), (6, 6), (7, 20), (21, 31)):
        part = everything.where(
            f"day(landing_date) BETWEEN {first} AND {last} AND month(landing_date) = 1"
            + (" OR month(landing_date) = 2" if last == 31 else "")
        )
        landing.write_landing(part, folder("l"))
        build.run_build(spark, folder("l"), folder("out"))
    landing.write_landing(everything, folder("all"))
    build.run_build(spark, folder("all"), folder("once"))
    columns = [c for c in staged_rows(spark, folder).columns if c not in ("payload", "loaded_at")]
    merged = staged_rows(spark, folder).select(*columns)
    assert merged.count() == 1000 and same(merged, staged_rows(spark, folder, "once").select(*columns))
    parts, whole = [
        build.tables_of(spark, folder(o), V.read_state(spark, folder(o))) for o in ("out", "once")
    ]
    for name in ("daily_activity", "event_trends", "top_contributors"):
        assert same(parts[name], whole[name])


def test_a_run_writes_and_reads_only_days_with_new_events(spark, folder):
    days = [(f"2024-01-{d:02d}", feed_event(d, created_at=f"2024-01-{d:02d}T01:00:00Z")) for d in (1, 2, 3)]
    land(spark, folder, days)
    build.run_build(spark, folder("l"), folder("out"))
    before = V.read_state(spark, folder("out"))
    land(spark, folder, [("2024-01-09", feed_event(9, created_at="2024-01-02T05:00:00Z"))])
    build.run_build(spark, folder("l"), folder("out"))
    after = V.read_state(spark, folder("out"))
    for name in ("stg_events", "daily_counts", "hourly_counts", "contributor_counts"):
        changed = {d for d, r in after.days[name].items() if before.days[name][d] != r}
        assert changed == {dt.date(2024, 1, 2)}
        (run,) = {r for r in after.days[name].values()} - set(before.days[name].values())
        written = {p.name for p in Path(V.folder(folder("out"), name, run)).glob("event_date=*")}
        assert written == {"event_date=2024-01-02"}
        read = V.read_days(spark, folder("out"), name, SCHEMAS[name], after, [dt.date(2024, 1, 2)])
        assert {Path(f).parent.name for f in read.inputFiles()} == {"event_date=2024-01-02"}
    assert sorted(r["event_id"] for r in staged_rows(spark, folder).collect()) == ["1", "2", "3", "9"]


def test_runs_that_hold_no_day_are_pruned(spark, folder):
    for number in (1, 2):  # the second replaces the only day of the first
        land(spark, folder, [("2024-01-05", feed_event(number))])
        build.run_build(spark, folder("l"), folder("out"))
    names = [build.STAGING, *partials.SCHEMAS]
    assert len(V.prune(spark, folder("out"), names)) == len(names)
    assert V.prune(spark, folder("out"), names) == []
    assert build.open_build(spark, folder("out"))["stg_events"].count() == 2


def test_a_run_that_breaks_off_leaves_everything_as_it_was(spark, folder, monkeypatch):
    land(spark, folder, [("2024-01-05", feed_event(1))])
    build.run_build(spark, folder("l"), folder("out"))
    land(spark, folder, [("2024-01-06", feed_event(2))])

    def die(*arguments):
        raise RuntimeError("driver lost")

    for step in ("build_partials", "changed_results"):
        with monkeypatch.context() as broken:
            broken.setattr(build, step, die)
            with pytest.raises(RuntimeError, match="driver lost"):
                build.run_build(spark, folder("l"), folder("out"))
        assert spark.table("stg_events").count() == 1
    counts = counts_of(build.run_build(spark, folder("l"), folder("out")))
    assert (counts["rows_loaded"], counts["stg_events"]) == (1, 2)


def test_a_failing_check_leaves_the_last_good_run_readable(spark, folder, monkeypatch):
    land(spark, folder, [("2024-01-05", feed_event(1))])
    build.run_build(spark, folder("l"), folder("out"))
    before = {p: p.stat().st_mtime_ns for p in Path(folder("out")).rglob("part-*") if "raw_events" not in str(p)}
    land(spark, folder, [("2024-01-05", feed_event(2)), ("2024-01-06", feed_event(3))])

    def not_unique(spark, root, run, state):
        staged = V.read_days(spark, root, build.STAGING, S.STAGED_SCHEMA, state)
        return quality.unique_result(staged.unionAll(staged), "stg_events", "event_id")

    with monkeypatch.context() as broken:
        broken.setattr(build, "changed_results", not_unique)
        with pytest.raises(QualityError, match="unique"):
            build.run_build(spark, folder("l"), folder("out"))
    assert [r["event_id"] for r in spark.table("stg_events").collect()] == ["1"]
    assert spark.table("daily_activity").count() == 1
    assert all(p.stat().st_mtime_ns == time for p, time in before.items())
    build.run_build(spark, folder("l"), folder("out"))
    assert spark.table("stg_events").count() == 3


def test_files_without_valid_events_change_nothing(spark, folder):
    with pytest.raises(QualityError, match="no record can be staged"):
        land(spark, folder, [("2024-01-05", feed_event(1, type=None))])
        build.run_build(spark, folder("l"), folder("out"))
    for event in (feed_event(2), feed_event(3, type=None)):
        land(spark, folder, [("2024-01-05", event)])
        build.run_build(spark, folder("l"), folder("out"))
    assert [r["event_id"] for r in staged_rows(spark, folder).collect()] == ["2"]
    assert build.read_rejects(spark, folder("out")).count() == 2


@pytest.mark.parametrize("rebuild", [False, True])
def test_copies_that_disagree_on_the_day(spark, folder, rebuild):
    """The latest pull wins, whether its copy came with a later run or all are staged at once."""
    land(spark, folder, [("2024-01-05", feed_event(1)), ("2024-01-05", feed_event(2))])
    build.run_build(spark, folder("l"), folder("out"))
    moved = feed_event(1, created_at="2024-01-09T00:00:00Z", _extracted_at="2024-01-09T12:00:00Z")
    land(spark, folder, [("2024-01-09", moved)])
    build.run_build(spark, folder("l"), folder("out"), rebuild=rebuild)
    found = {r["event_id"]: str(r["event_date"]) for r in staged_rows(spark, folder).collect()}
    assert found == {"1": "2024-01-09", "2": "2024-01-05"}
    old = feed_event(2, created_at="2024-01-01T00:00:00Z", _extracted_at="2023-01-01T12:00:00Z")
    stamped = feed_event(2, _extracted_at="2024-01-10T12:00:00Z")
    land(spark, folder, [("2024-01-10", old), ("2024-01-10", stamped)])
    build.run_build(spark, folder("l"), folder("out"), rebuild=rebuild)
    found = sorted((r["event_id"], str(r["event_date"])) for r in staged_rows(spark, folder).collect())
    assert found == [("1", "2024-01-09"), ("2", "2024-01-05")]
    assert spark.table("daily_activity").agg(F.sum("total_activity")).first()[0] == 2


def test_rebuild_from_raw(spark, folder):
    land(spark, folder, [("2024-01-05", feed_event(1))])
    build.run_build(spark, folder("l"), folder("out"))
    counts = counts_of(build.run_build(spark, folder("l"), folder("out"), rebuild=True))
    assert (counts["rows_loaded"], counts["stg_events"]) == (1, 1)


def test_run_without_events_fails(spark, folder):
    land(spark, folder, [("2024-01-05", "{")])
    with pytest.raises(QualityError, match="no events extracted"):
        build.run_build(spark, folder("l"), folder("out"))
    land(spark, folder, [("2024-01-05", feed_event(1))])
    build.run_build(spark, folder("l"), folder("out"))
    with pytest.raises(QualityError, match="no events extracted"):
        build.run_build(spark, folder("l"), folder("out"))


def test_rejected_records_are_counted_and_kept(spark, folder):
    actor = {"id": "not a number", "login": "x", "url": "u"}
    events = [feed_event(1), feed_event(2, actor=None), feed_event(3, actor=actor), feed_event(4, created_at="x"),
              feed_event(5, payload={"size": "many"}), 17]
    land(spark, folder, [("2024-01-05", json.dumps(e)) for e in events])
    counts = counts_of(build.run_build(spark, folder("l"), folder("out")))
    assert (counts["rows_loaded"], counts["stg_events"], counts["rows_rejected"]) == (6, 1, 5)
    assert counts["rejected:actor.id"] == 3 and counts["rejected:created_at"] == 2
    assert counts["rejected:type:push_commit_count"] == 1
    kept = build.read_rejects(spark, folder("out"))
    assert sorted(r[0] for r in kept.select(F.size("reasons")).collect())[:3] == [1, 1, 1]
    ids = kept.select(F.expr("try_variant_get(raw_data, '$.id', 'string')")).collect()
    assert {r[0] for r in ids} == {"2", "3", "4", "5", None}


def test_a_strict_run_fails_on_any_rejected_record(spark, folder):
    land(spark, folder, [("2024-01-05", feed_event(1)), ("2024-01-05", feed_event(2, payload={"size": "many"}))])
    with pytest.raises(QualityError, match="push_commit_count"):
        build.run_build(spark, folder("l"), folder("out"), strict=True)
    assert V.read_state(spark, folder("out")).number == 0
    build.run_build(spark, folder("l"), folder("out"))
    assert [r["push_commit_count"] for r in spark.table("stg_events").collect()] == [2]


def test_arrays_as_feeds_write_them_reach_the_models(spark, folder):
    day = Path(folder("l"), "year=2024", "month=01", "day=05")
    day.mkdir(parents=True)
    (day / "one.json").write_text(json.dumps([feed_event(1), feed_event(2)]))
    (day / "two.json").write_text(json.dumps([feed_event(3)], indent=4))
    counts = counts_of(build.run_build(spark, folder("l"), folder("out")))
    assert (counts["rows_loaded"], counts["stg_events"], counts["rows_quarantined"]) == (3, 3, 0)


def test_tables_of_the_catalog_are_seen_by_other_sessions(spark, folder):
    land(spark, folder, [("2024-01-05", feed_event(1))])
    build.run_build(spark, folder("l"), folder("out"), materialize=True)
    assert spark.newSession().table("stg_events").count() == spark.newSession().table("daily_activity").count() == 1
    land(spark, folder, [("2024-01-06", feed_event(2))])
    build.run_build(spark, folder("l"), folder("out"), materialize=True)
    assert spark.newSession().table("stg_events").count() == 2
    assert same(spark.newSession().table("contributor_stats"), build.tables_of(spark, folder("out"), V.read_state(spark, folder("out")))["contributor_stats"])
    for name in ("stg_events", "daily_activity", "contributor_stats", "top_contributors", "event_trends"):
        spark.sql(f"DROP TABLE {name}")
    tables = build.open_build(spark.newSession(), folder("out"))
    assert tables["event_trends"].first()["event_count"] == 2


def drop_tables(spark):
    for name in materialized.TABLES:
        spark.sql(f"DROP TABLE IF EXISTS {spark.catalog.currentDatabase()}.{name}")


def files_of_days(folder):
    published = Path(folder("out"), "published")
    return {p: p.stat().st_mtime_ns for p in published.rglob("part-*") if "=" in p.parent.name}


def test_tables_of_days_are_replaced_day_by_day(spark, folder):
    drop_tables(spark)

    def at(number, day, hour=1, **changes):
        return day, feed_event(number, created_at=f"{day}T{hour:02d}:00:00Z", **changes)

    def build_with(*events):
        land(spark, folder, events)
        before = files_of_days(folder)
        build.run_build(spark, folder("l"), folder("out"), materialize=True)
        after = files_of_days(folder)
        written = {(p.parts[-3], p.parent.name.split("=")[1]) for p, time in after.items() if before.get(p) != time}
        want = build.tables_of(spark, folder("out"), V.read_state(spark, folder("out")))
        for name in materialized.TABLES:
            held = materialized.table(spark.newSession(), name)
            drop = [c for c in ("payload",) if c in held.columns]
            assert same(held.drop(*drop), want[name].drop(*drop)), name
        return written

    days = [f"2024-01-{d:02d}" for d in range(1, 15)]
    build_with(*[at(n, day) for n, day in enumerate(days)])
    # A day at the end: nothing else is written.
    assert build_with(at(100, "2024-01-20")) == {(t, "2024-01-20") for t in ("stg_events", "daily_activity", "event_trends")}
    # A day in the middle: the frames of the six rows behind it, and the next hour.
    assert build_with(at(101, "2024-01-03", hour=5)) == {
        ("stg_events", "2024-01-03"), ("event_trends", "2024-01-03"), ("event_trends", "2024-01-04"),
        *[("daily_activity", f"2024-01-{d:02d}") for d in range(3, 10)],
    }
    # An event that was alone on its day moves to another: that day goes from all tables.
    moved = build_with(at(9, "2024-01-20", hour=7, _extracted_at="2024-02-01T00:00:00Z"))
    assert ("daily_activity", "2024-01-11") in moved and ("stg_events", "2024-01-11") not in moved
    assert not any("=2024-01-10" in str(p) for p in files_of_days(folder))
    drop_tables(spark)


def test_totals_keep_two_folders_at_most(spark, folder):
    drop_tables(spark)
    for number in range(3):
        land(spark, folder, [("2024-01-05", feed_event(number))])
        build.run_build(spark, folder("l"), folder("out"), materialize=True)
    for name in ("contributor_stats", "top_contributors"):
        assert len(list(Path(folder("out"), "published", name).iterdir())) == 2
    assert spark.newSession().table("top_contributors").first()["total_events"] == 3
    drop_tables(spark)


def overlapping(spark, folder, monkeypatch, meanwhile):
    """Run a build; when its first attempt has staged its rows, ``meanwhile`` happens."""
    step, done = build.build_partials, []

    def then(*arguments):
        if not done:
            done.append(True)
            meanwhile()
        return step(*arguments)

    with monkeypatch.context() as patched:
        patched.setattr(build, "build_partials", then)
        return counts_of(build.run_build(spark, folder("l"), folder("out")))


def test_two_runs_from_one_state_lose_no_load(spark, folder, monkeypatch):
    land(spark, folder, [("2024-01-05", feed_event(1))])
    build.run_build(spark, folder("l"), folder("out"))
    land(spark, folder, [("2024-01-05", feed_event(2))])

    def other_feed():
        late = feed_event(2, created_at="2024-01-07T00:00:00Z", _extracted_at="2024-01-08T00:00:00Z")
        land(spark, folder, [("2024-01-05", feed_event(3)), ("2024-01-07", late)], "m")
        # Only its own load: the other run's is committed, but must not be staged here.
        pending = build.raw_table.loads
        with monkeypatch.context() as patched:
            known = [r["load_id"] for r in pending(spark, folder("out") + "/raw_events").collect()]
            patched.setattr(build.raw_table, "loads", lambda *a: pending(*a).where(~F.col("load_id").isin(known)))
            patched.setattr(build.incremental_load.__globals__["raw_table"], "last_commit", lambda *a: len(known))
            build.run_build(spark, folder("m"), folder("out"))

    counts = overlapping(spark, folder, monkeypatch, other_feed)
    assert counts["rows_loaded"] == 1 and counts["stg_events"] == 3
    found = {r["event_id"]: str(r["event_date"]) for r in staged_rows(spark, folder).collect()}
    assert found == {"1": "2024-01-05", "2": "2024-01-07", "3": "2024-01-05"}
    staged_now = {r["load_id"] for r in V.staged_loads(spark, folder("out")).collect()}
    assert staged_now == set(build.raw_table.load_ids(spark, folder("out") + "/raw_events")) and len(staged_now) == 3
    assert V.read_state(spark, folder("out")).number == 3


def test_a_run_whose_loads_another_has_staged_ends_well(spark, folder, monkeypatch):
    land(spark, folder, [("2024-01-05", feed_event(1)), ("2024-01-06", feed_event(2, type=None))])

    def whole_run():  # finds no new file, but the loads that this run has committed
        build.run_build(spark, folder("l"), folder("out"))

    counts = overlapping(spark, folder, monkeypatch, whole_run)
    assert (counts["rows_loaded"], counts["stg_events"]) == (0, 1)
    assert build.read_rejects(spark, folder("out")).count() == 1
    assert V.read_state(spark, folder("out")).number == 1


def test_what_a_run_publishes_does_not_grow_with_the_runs(spark, folder):
    for number in range(3):
        land(spark, folder, [(f"2024-01-{number + 1:02d}", feed_event(number, created_at=f"2024-01-{number + 1:02d}T00:00:00Z"))])
        build.run_build(spark, folder("l"), folder("out"))
    sizes = [p.stat().st_size for p in sorted(Path(folder("out"), "_states").glob("0*.json"))]
    assert len(sizes) == 3 and len(set(sizes)) == 1
    runs = [len(list(Path(folder("out"), t).glob("run=*/event_date=*"))) for t in SCHEMAS]
    assert set(runs) == {3}


def test_an_increment_without_old_copies_opens_no_old_day(spark, folder):
    days = [(f"2024-01-{d:02d}", feed_event(d, created_at=f"2024-01-{d:02d}T01:00:00Z")) for d in (1, 2, 3)]
    land(spark, folder, days)
    build.run_build(spark, folder("l"), folder("out"))
    hidden = Path(folder("out"), "stg_events").rename(Path(folder("out"), "hidden"))
    land(spark, folder, [("2024-01-09", feed_event(9, created_at="2024-01-09T05:00:00Z"))])
    raw = f"{folder('out')}/raw_events"
    build.incremental_load(spark, folder("l"), raw)
    loads, staged_now, _ = build._stage_pending(spark, folder("out"), False, False, False)
    assert staged_now.touched == staged_now.filled == [dt.date(2024, 1, 9)]
    for run in hidden.iterdir():
        run.rename(Path(folder("out"), "stg_events", run.name))
    assert build.open_build(spark, folder("out"))["stg_events"].count() == 4


def test_retention_and_growth_from_aggregates(spark, folder):
    events = source_events(spark, SF_DIR)
    landing.write_landing(overlapping_records(events), folder("l"))
    build.run_build(spark, folder("l"), folder("out"))
    typed = staged_events(events)
    assert same(spark.table("retention"), insights.retention(typed))
    assert same(spark.table("contributor_growth"), insights.contributor_growth(typed))
    read = build.aggregates_of(spark, folder("out"), V.read_state(spark, folder("out")))
    for table in ("retention", "contributor_growth"):
        files = build.tables_of(spark, folder("out"), V.read_state(spark, folder("out")))[table].inputFiles()
        assert files and all("/contributor_counts/" in f for f in files)
    weeks = partials.contributor_growth(read["contributor_counts"], read["daily_people"], "week", approximate=True)
    exact = {(r[0], r[1]): r[2] for r in insights.contributor_growth(typed, "week").select("repo_name", "period_start", "contributors").collect()}
    near = {(r[0], r[1]): r[2] for r in weeks.select("repo_name", "period_start", "contributors").collect()}
    assert set(near) == set(exact) and all(abs(near[k] - n) <= max(1, 0.05 * n) for k, n in exact.items())


def test_sketched_people_are_within_their_error(spark):
    people = spark.range(60_000).selectExpr(
        "concat('u', id % 30000) AS actor_login", "'r' AS repo_name", "'PushEvent' AS event_type", "1L AS push_commit_count", "0 AS is_star_event",
        "cast(timestampadd(MINUTE, cast(id AS INT), TIMESTAMP '2024-01-01 00:00:00') AS TIMESTAMP_NTZ) AS event_timestamp",
    )
    error = 4 * 1.04 / 2**6  # four standard errors of 2^12 registers
    sketches = partials.daily_people(people)
    (whole,) = partials.contributor_growth(people, sketches, "year", approximate=True).collect()
    assert abs(whole["contributors"] / 30_000 - 1) < error
    exact = {r["activity_date"]: r["unique_contributors"] for r in models.daily_activity(people).collect()}
    near = {r["activity_date"]: r["unique_contributors"] for r in models.daily_activity(people, approximate=True).collect()}
    assert set(near) == set(exact) and all(abs(near[d] / n - 1) < error for d, n in exact.items())
    hours = models.event_trends(people, approximate=True)
    assert hours.schema == models.event_trends(people).schema
    nobody = people.limit(3).withColumn("actor_login", F.lit(None).cast("string"))
    assert models.daily_activity(nobody, approximate=True).first()["unique_contributors"] == 0


def test_records_are_parsed_once_rejected_or_not(spark, folder):
    """One write checks and types all records; what it rejected is read from there."""
    from pyspark.sql import Observation

    events = [feed_event(1), feed_event(2, actor=None)]
    land(spark, folder, [("2024-01-05", e) for e in events])
    raw = landing.read_landing(spark, folder("l")).withColumn("load_id", F.lit("x"))
    plan = plan_of(build.checked_records(raw, Observation("plan")))
    assert plan.count("Scan text") == 1 + plan.count("(1) Scan text")
    done = build.update_staging(spark, raw, folder("out"), "run", V.State())
    assert done.rejected["any"] == 1 and len(done.filled) == 1


def test_wide_rows_are_shuffled_once(spark, folder):
    frame = staged(spark, [{"at": "2024-01-01 00:00:00"}]).withColumn("event_date", F.to_date("event_timestamp"))
    share = F.pmod(F.xxhash64("event_id"), F.lit(4))
    dealt = settle(frame, "staged").withColumn("share", share).repartition("event_date", "share")
    kept = latest_copy(dealt, null_keys=False, within=("event_date", "share"))
    plan = plan_of(kept.sortWithinPartitions("event_date", "repo_name"))
    assert plan.count("+- Exchange (") == 1


def test_publish_as_view_and_as_table(spark, folder):
    frame = spark.range(3)
    build.publish(frame, "some_view")
    assert spark.table("some_view").count() == 3
    stored = build.publish(frame, "some_table", folder("t"))
    assert stored.count() == spark.newSession().table("some_table").count() == 3
    spark.sql("DROP TABLE some_table")


def test_shuffle_partitions_follow_the_size():
    assert shuffle_conf(1) == {"spark.sql.shuffle.partitions": "200"}
    assert shuffle_conf(10 * 2**40) == {"spark.sql.shuffle.partitions": "81920"}


def test_intermediates_go_to_the_configured_folder(spark):
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        assert shared_folder(spark) == configured.rstrip("/")
    assert new_folder(spark, "x") != new_folder(spark, "x")
    assert new_folder(spark, "x").startswith(shared_folder(spark))


def fake_session(master: str):
    context = SimpleNamespace(master=master, applicationId=f"app-{master}", getCheckpointDir=lambda: None)
    return SimpleNamespace(conf={}, sparkContext=context)


def test_only_a_local_session_may_do_without_a_shared_folder():
    assert shared_folder(fake_session("local[2]")) == shared_folder(fake_session("local[2]"))
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_folder(fake_session("yarn"))


def test_a_failing_aggregate_fails_the_build(spark, folder):
    with pytest.raises(Exception, match="no_such_column|UNRESOLVED_COLUMN"):
        build.build_partials(spark.range(1).withColumnRenamed("id", "no_such_column"), folder("out"), "r")


def test_intermediates_are_deleted_at_the_end(spark):
    import forgepulse.session as session

    settle(spark.range(3), "some")
    (path,) = [p for p in session._written if "/some-" in p]
    assert Path(path.removeprefix("file:").replace("//", "/")).is_dir()
    session.remove(path)
    assert not Path(path.removeprefix("file:").replace("//", "/")).exists()
