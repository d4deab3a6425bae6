from __future__ import annotations

import datetime as dt
import json
import os
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from forgepulse.operators.copies import latest_copy
from forgepulse.operators.numbering import numbered
from forgepulse.operators.staging import stg_events
from forgepulse.sources import arrays, landing, raw_table
from forgepulse.streaming.incremental import in_loads, incremental_load
from tests.helpers import feed_event, plan_of, records, staged


def run(spark, folder, **options):
    return incremental_load(spark, folder("l"), folder("raw"), **options)


def land(spark, folder, numbers, day="2024-01-05", layout="lines"):
    events = [(day, feed_event(n)) for n in numbers]
    landing.write_landing(records(spark, events), folder("l"), layout)


def put(folder, name: str, text: str, day: str = "day=05"):
    target = Path(folder("l"), "year=2024", "month=01", day)
    target.mkdir(parents=True, exist_ok=True)
    (target / name).write_text(text)
    return target / name


def loaded(spark, folder) -> list[str]:
    raw = raw_table.read_raw(spark, folder("raw"))
    return sorted(r[0] for r in stg_events(raw).select("event_id").collect())


def test_only_new_files_are_loaded(spark, folder):
    land(spark, folder, range(5))
    assert [c.rows_loaded for c in run(spark, folder)] == [5]
    assert run(spark, folder) == []
    land(spark, folder, range(5, 7), day="2024-01-06")
    land(spark, folder, [7])  # another file for a day that is loaded already
    assert sum(c.rows_loaded for c in run(spark, folder)) == 3
    assert loaded(spark, folder) == [str(n) for n in range(8)]


def test_a_file_with_an_old_time_is_new_all_the_same(spark, folder):
    put(folder, "a.json", json.dumps(feed_event(1)))
    run(spark, folder)
    os.utime(put(folder, "b.json", json.dumps(feed_event(2))), (0, 0))
    assert [c.rows_loaded for c in run(spark, folder)] == [1]
    put(folder, "c.json", json.dumps(feed_event(3)))
    run(spark, folder)
    assert loaded(spark, folder) == ["1", "2", "3"]


def test_two_feeds_into_one_raw_table(spark, folder):
    for name, number in (("one", 1), ("two", 2)):
        landing.write_landing(records(spark, [("2024-01-05", feed_event(number))]), folder(name))
        incremental_load(spark, folder(name), folder("raw"))
    assert loaded(spark, folder) == ["1", "2"]


def test_progress_that_is_lost_overwrites_nothing(spark, folder):
    """Without the table of loads everything is loaded again under other ids, as copies."""
    land(spark, folder, [1])
    run(spark, folder)
    kept = raw_table.load_ids(spark, folder("raw"))
    os.rename(folder("raw") + "/_loads", folder("raw") + "/_lost")
    land(spark, folder, [2], day="2024-01-06")
    run(spark, folder)
    assert not set(kept) & set(raw_table.load_ids(spark, folder("raw")))
    assert loaded(spark, folder) == ["1", "2"]
    assert Path(folder("raw"), f"load_id={kept[0]}").is_dir()


@pytest.mark.parametrize("layout", ["auto", "lines"])
def test_an_array_file_under_the_default_layout(spark, folder, layout):
    put(folder, "a.json", json.dumps([feed_event(1), feed_event(2)]))
    assert [(c.rows_loaded, c.rows_quarantined) for c in run(spark, folder, layout=layout)] == [(2, 0)]
    assert loaded(spark, folder) == ["1", "2"]


def test_arrays_over_several_lines_are_told_from_broken_lines(spark, folder):
    put(folder, "a.json", json.dumps([feed_event(1), feed_event(2)], indent=2))
    put(folder, "b.json", json.dumps(feed_event(3)) + "\n[broken\n" + json.dumps(feed_event(4)))
    put(folder, "c with space.json", json.dumps([feed_event(5)], indent=1))
    assert [(c.rows_loaded, c.rows_quarantined) for c in run(spark, folder)] == [(5, 1)]
    assert loaded(spark, folder) == ["1", "2", "3", "4", "5"]
    assert [r["raw_text"] for r in raw_table.read_quarantine(spark, folder("raw")).collect()] == ["[broken"]
    assert run(spark, folder) == []


def test_arrays_of_any_size_load_wholly_and_broken_ones_are_kept_whole(spark, folder, monkeypatch):
    """The limit that once kept large files from being read as arrays is far below these sizes here."""
    monkeypatch.setattr(arrays, "CHUNK_BYTES", 500)
    monkeypatch.setattr(arrays, "PIECE_BYTES", 2000)
    whole = json.dumps([feed_event(n, text='a "quoted" ] \\ é') for n in range(300)], indent=2)
    torn = json.dumps([feed_event(n) for n in range(300, 340)], indent=2)[:-200]
    # A line of it is a whole event: that must not count.
    lines = "[\n" + json.dumps(feed_event(400)) + ",\n" + json.dumps(feed_event(401)) + "\n,"
    odd = "[\n" + json.dumps(feed_event(500)) + ",\n{broken: }\n]"
    for name, text in (("w.json", whole), ("t%41#.json", torn), ("l.json", lines), ("o.json", odd)):
        put(folder, name, text)
    (counts,) = run(spark, folder)
    assert loaded(spark, folder) == sorted(str(n) for n in range(300))
    kept = raw_table.read_quarantine(spark, folder("raw")).collect()
    assert counts.rows_loaded == 300 and counts.rows_quarantined == len(kept) > 5
    texts = {}
    for row in kept:
        texts.setdefault(row["file_name"].rsplit("/", 1)[1], []).append(row["raw_text"])
    assert sorted(map(len, texts.values()))[:2] == [1, 1]
    assert texts["l.json"] == [lines] and texts["o.json"] == [odd]
    assert sorted("".join(texts["t%2541%23.json"])) == sorted(torn)
    assert run(spark, folder) == []


def test_the_array_layout_reads_in_chunks_too(spark, folder, monkeypatch):
    monkeypatch.setattr(arrays, "CHUNK_BYTES", 100)
    put(folder, "a b.json", json.dumps([feed_event(n) for n in range(20)], indent=1))
    put(folder, "b.json", json.dumps(feed_event(30)))
    put(folder, "c.json", "")
    (counts,) = run(spark, folder, layout="array")
    assert (counts.rows_loaded, counts.rows_quarantined) == (20, 1)
    assert raw_table.read_raw(spark, folder("raw")).select("file_name").distinct().first()[0].endswith("/a%20b.json")


def test_200_000_new_files_are_numbered_in_several_tasks(spark, tmp_path):
    listed = spark.range(200_000).selectExpr(
        "concat('file:/landing/year=2024/month=01/day=', lpad(id % 28 + 1, 2, '0'), '/', xxhash64(id), '.json') AS path",
        "id AS length", "2024 AS year", "1 AS month", "cast(id % 28 + 1 AS INT) AS day",
    )
    known = listed.where("length % 10 = 0").select("path", "length")
    pending, count = in_loads(listed, known, 7_000)
    assert count == -(-180_000 // 7_000)
    sizes = {r["load"]: r["count"] for r in pending.groupBy("load").count().collect()}
    assert sizes == {n: 7_000 if n < count - 1 else 180_000 % 7_000 for n in range(count)}
    days = pending.groupBy("load").agg(F.min("day").alias("low"), F.max("day").alias("high")).orderBy("load").collect()
    assert all(a["high"] <= b["low"] for a, b in zip(days, days[1:]))
    placed = numbered(listed, [F.col("day"), F.col("path")], "place")
    plan = plan_of(placed)
    assert "SinglePartition" not in plan and "Window" not in plan
    assert len({f for f in placed.inputFiles() if f.endswith(".parquet")}) > 1
    assert "PartitionFilters: [isnotnull(load" in plan_of(pending.where("load = 3"))


def test_runs_that_overlap_load_each_file_once(spark, folder, monkeypatch):
    """While the first run writes its load, a second one loads a part of the same files and commits."""
    land(spark, folder, [1, 2], day="2024-01-05")
    land(spark, folder, [3], day="2024-01-06")
    write, others = raw_table.write_rows, []

    def overlapped(*arguments):
        if not others:
            others.append(True)
            others.extend(run(spark, folder, days=[dt.date(2024, 1, 6)]))
        return write(*arguments)

    monkeypatch.setattr(raw_table, "write_rows", overlapped)
    own = run(spark, folder)
    assert [c.rows_loaded for c in own] == [2] and [c.rows_loaded for c in others[1:]] == [1]
    assert raw_table.read_raw(spark, folder("raw")).count() == 3
    assert loaded(spark, folder) == ["1", "2", "3"]
    assert raw_table.loaded_files(spark, folder("raw")).groupBy("path").count().where("count > 1").isEmpty()
    assert run(spark, folder) == []


def test_only_some_days_are_listed(spark, folder):
    for day in (5, 6, 7):
        land(spark, folder, [day], day=f"2024-01-{day:02d}")
    run(spark, folder, days=[dt.date(2024, 1, 6), dt.date(2024, 1, 9)])
    assert loaded(spark, folder) == ["6"]
    run(spark, folder)
    assert loaded(spark, folder) == ["5", "6", "7"]


def test_equals_batch_load_in_both_layouts(spark, folder):
    for layout in landing.LAYOUTS:
        at = lambda name, layout=layout: folder(f"{layout}-{name}")
        land(spark, at, range(20), layout=layout)
        run(spark, at, layout=layout)
        read = stg_events(raw_table.read_raw(spark, at("raw"))).select("event_id", "repo_id")
        batch = stg_events(landing.read_landing(spark, at("l"), layout)).select("event_id", "repo_id")
        assert read.exceptAll(batch).isEmpty() and batch.exceptAll(read).isEmpty()
    with pytest.raises(ValueError, match="layout"):
        run(spark, folder, layout="other")


def test_small_loads_cover_everything(spark, folder):
    for day in ("2024-01-05", "2024-01-06", "2024-01-07"):
        land(spark, folder, [int(day[-2:])], day)
    counts = run(spark, folder, max_files_per_load=1)
    assert len(counts) >= 3 and sum(c.rows_loaded for c in counts) == 3
    assert len({c.load_id for c in counts}) == len(counts)


def test_unreadable_text_goes_to_quarantine(spark, folder):
    landing.write_landing(
        records(spark, [("2024-01-05", "{"), ("2024-01-05", feed_event(1))]), folder("l")
    )
    assert [(c.rows_loaded, c.rows_quarantined) for c in run(spark, folder)] == [(1, 1)]
    assert raw_table.read_quarantine(spark, folder("raw")).first()["raw_text"] == "{"


def test_a_load_that_broke_off_is_repeated_and_counts_once(spark, folder, monkeypatch):
    land(spark, folder, range(4))

    def die(*arguments):
        raise RuntimeError("driver lost")

    with monkeypatch.context() as broken:
        broken.setattr(raw_table, "commit_load", die)
        with pytest.raises(RuntimeError, match="driver lost"):
            run(spark, folder)
    assert [c.rows_loaded for c in run(spark, folder)] == [4]
    assert raw_table.read_raw(spark, folder("raw")).count() == 4


def test_latest_copy_wins_and_missing_ids_stay(spark):
    frame = staged(
        spark,
        [
            {"id": "1", "pulled": "2024-01-01 00:00:00", "source": "old"},
            {"id": "1", "pulled": "2024-01-02 00:00:00", "source": "new"},
            {"id": "1", "pulled": None, "source": "unstamped"},
            {"id": "2", "pulled": None, "source": "only"},
            {"id": None, "source": "x"},
            {"id": None, "source": "x"},
        ],
    )
    kept = sorted((r["event_id"] or "", r["source_repo"]) for r in latest_copy(frame).collect())
    assert kept == [("", "x"), ("", "x"), ("1", "new"), ("2", "only")]
    assert latest_copy(frame, null_keys=False).count() == 2 + 1  # the missing ids as one group


def test_copies_that_differ_in_one_column_only(spark):
    """Whatever the order of the rows, the same copy stays."""
    base = {"id": "1", "pulled": "2024-01-01 00:00:00", "at": "2024-01-01 00:00:00"}
    for column in ("size", "actor_id", "repo_id"):
        rows = [{**base, column: value} for value in (3, 1, 2)]
        found = {str(latest_copy(staged(spark, some)).first()) for some in (rows, rows[::-1], rows[1:] + rows[:1])}
        assert len(found) == 1
    for column in ("issue", "pr"):
        rows = [{**base, column: value} for value in ("closed", "opened")]
        assert len({str(latest_copy(staged(spark, some)).first()) for some in (rows, rows[::-1])}) == 1


def test_one_event_as_a_third_of_the_input(spark):
    hot = spark.range(60_000).selectExpr(
        "CASE WHEN id % 3 = 0 THEN 'hot' ELSE cast(id AS STRING) END AS event_id",
        "timestampadd(SECOND, cast(id AS INT), TIMESTAMP_NTZ '2024-01-01 00:00:00') AS extracted_at",
        "cast(id AS STRING) AS source_repo",
    )
    kept = latest_copy(hot)
    assert kept.count() == 40_001
    assert kept.where("event_id = 'hot'").first()["source_repo"] == "59997"
