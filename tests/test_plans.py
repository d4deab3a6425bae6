"""The plans that the design relies on."""

from __future__ import annotations

import threading

from pyspark.sql import Observation

import __spark_entry__ as suite
from fixtures import envelope
from forgepulse.operators.copies import latest_copy
from forgepulse.operators.staging import stg_events
from forgepulse.plans import build, insights, materialized, models, reports
from forgepulse.session import settle
from forgepulse.sources import landing
from tests.helpers import feed_event, plan_of, raw, records, staged

import datetime as dt

SF_DIR = "/root/testdata/sf0.001"
EVENT = [{"at": "2024-01-01 00:00:00"}]


def exchanges(plan: str) -> int:
    return plan.count("+- Exchange (")


def test_models_run_in_the_jvm_without_joins(spark):
    table = settle(staged(spark, EVENT), "staged")
    for model in (models.daily_activity, models.event_trends, models.contributor_stats,
                  insights.retention, insights.engagement, insights.contributor_growth):
        plan = plan_of(model(table))
        assert "Python" not in plan and "ArrowEval" not in plan
        assert "Join" not in plan and "Expand" not in plan


def test_first_shuffle_of_a_model_is_keyed_below_the_repository(spark):
    plan = plan_of(models.daily_activity(settle(staged(spark, EVENT), "staged")))
    assert "partial_count(1)" in plan
    assert exchanges(plan) == 3  # distinct step, group step, window over days


def test_retention_shuffles_twice(spark):
    plan = plan_of(insights.retention(settle(staged(spark, EVENT), "staged")))
    assert exchanges(plan) == 2


def test_rank_limits_groups_before_the_shuffle(spark):
    stats = settle(models.contributor_stats(staged(spark, EVENT)), "stats")
    plan = plan_of(models.top_contributors(stats))
    assert plan.count("WindowGroupLimit") >= 2
    assert "ReadSchema: struct<repo_name:string,total_events:bigint>" in plan


def test_copies_are_limited_before_the_shuffle(spark):
    table = settle(staged(spark, EVENT), "staged")
    plan = plan_of(latest_copy(table, null_keys=False))
    assert "Partial" in plan and "WindowGroupLimit" in plan
    assert exchanges(plan) == 1


def test_repository_filter_reaches_the_scan(spark):
    table = settle(staged(spark, EVENT), "staged")
    report = reports.repo_health(models.daily_activity(table), "r", dt.date(2024, 1, 2))
    plan = plan_of(report)
    assert "EqualTo(repo_name,r)" in plan
    assert "push_commit_count" not in plan.split("ReadSchema:")[1].splitlines()[0]


def test_leaders_of_one_repository_read_only_its_rows(spark):
    stats = settle(models.contributor_stats(staged(spark, EVENT)), "stats")
    plan = plan_of(reports.top_contributors_report(stats, "r"))
    scans = plan.split("PushedFilters: ")[1:]
    assert len(scans) == 2 and all("EqualTo(repo_name,r)" in scan.splitlines()[0] for scan in scans)


def test_raw_scan_reads_only_the_paths_in_use(spark):
    table = settle(raw(spark, [feed_event()]), "raw")
    plan = plan_of(stg_events(table, strict=False).select("repo_name", "push_commit_count"))
    assert "ReadSchema: struct<raw_data:struct<0:string,1:string,2:bigint>>" in plan
    # The strict form looks at the size once more, but never at the whole record.
    plan = plan_of(stg_events(table).select("repo_name", "push_commit_count"))
    read = plan.split("ReadSchema: ")[1].splitlines()[0]
    assert read == "struct<raw_data:struct<0:string,1:string,2:bigint,3:variant,4:string>>"


def test_landing_is_parsed_once(spark, folder):
    landing.write_landing(records(spark, [("2024-01-01", feed_event())]), folder("l"))
    parsed = landing.read_landing(spark, folder("l"))
    plan = plan_of(stg_events(parsed).where("repo_name = 'org/r' AND event_type = 'PushEvent'"))
    body = plan.split("== Physical Plan ==")[1]
    parsing = [line for line in body.splitlines() if "from_json" in line]
    assert sum(line.count("from_json(") for line in parsing) == 2  # one for arrays, one for single values


def test_flagship_scan_reads_only_needed_columns(spark):
    plan = plan_of(suite.queries()["event_trends"](spark, SF_DIR))
    assert "ReadSchema: struct<ts:timestamp_ntz,user_id:bigint,event_type:string,props:string>" in plan


def test_checked_records_are_read_by_typed_paths(spark, folder):
    parsed = raw(spark, [feed_event(1), feed_event(2, type=None), feed_event(3, payload={"size": "x"})])
    settled = settle(parsed.selectExpr(
        "raw_data", "'f' AS file_name", "loaded_at", "'l' AS load_id", "2024 AS year", "1 AS month", "5 AS day"
    ), "raw")
    checked = build.checked_records(settled, Observation("paths"))
    assert "variant_get" not in plan_of(checked)  # no value is looked up in the record behind the scan
    rows = {r["event_id"]: r for r in checked.selectExpr("*", "to_json(raw_data) AS text").collect()}
    assert [rows[i]["reasons"] for i in "123"] == [None, ["type"], ["type:push_commit_count"]]
    assert [rows[i]["rejected"] for i in "123"] == [False, True, True]
    assert rows["1"]["text"] is None and '"id":"2"' in rows["2"]["text"]


def test_pulls_are_made_in_several_tasks_of_few_days(spark, folder, monkeypatch):
    monkeypatch.setattr(envelope, "ROWS_PER_TASK", 100)
    whole = spark.read.parquet(f"{SF_DIR}/events.parquet")
    dealt = envelope.dealt_events(spark, SF_DIR)
    assert dealt.exceptAll(whole).isEmpty() and whole.exceptAll(dealt).isEmpty()
    landing.write_landing(suite._pulls(spark, SF_DIR), folder("l"))
    files = landing.list_files(spark, folder("l")).count()
    assert 31 < files <= 31 + 3 * 10  # one table of one row group, before one file a day


def test_first_tables_are_written_side_by_side(spark, folder, monkeypatch):
    landing.write_landing(records(spark, [("2024-01-05", feed_event())]), folder("l"))
    build.run_build(spark, folder("l"), folder("out"))
    all_there = threading.Barrier(len(materialized.TABLES))
    monkeypatch.setattr(materialized, "_update", lambda *_: all_there.wait(timeout=20))
    materialized.update(spark, folder("out"))
