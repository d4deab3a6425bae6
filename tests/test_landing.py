from __future__ import annotations

import datetime as dt
import json
from pathlib import Path

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from forgepulse.operators.staging import stg_events
from forgepulse.sources import landing, raw_table
from forgepulse.streaming.incremental import incremental_load
from tests.helpers import feed_event, plan_of, records


def ids(parsed) -> list[str]:
    return sorted(r[0] for r in stg_events(parsed).select("event_id").collect())


def put(path: str, text: str, day: str = "year=2024/month=01/day=05", name: str = "x.json"):
    target = Path(path) / day
    target.mkdir(parents=True, exist_ok=True)
    (target / name).write_text(text)


@pytest.mark.parametrize("layout", landing.LAYOUTS)
def test_round_trip(spark, folder, layout):
    events = [("2024-01-05", feed_event(i)) for i in range(10)]
    events += [("2024-01-06", feed_event(i)) for i in range(10, 13)]
    landing.write_landing(records(spark, events), folder("l"), layout)
    landing.write_landing(records(spark, [("2024-01-05", feed_event(13))]), folder("l"), layout)
    found = landing.read_landing(spark, folder("l"), layout)
    assert ids(found) == sorted(str(i) for i in range(14))
    days = found.groupBy("year", "month", "day").count().collect()
    assert {(r["year"], r["month"], r["day"], r["count"]) for r in days} == {
        (2024, 1, 5, 11), (2024, 1, 6, 3)
    }
    names = [r[0] for r in found.select("file_name").distinct().collect()]
    assert all("/year=2024/month=01/day=0" in n for n in names)
    assert found.where("loaded_at IS NULL").isEmpty()


def test_array_files_are_json_arrays_of_bounded_size(spark, folder):
    events = [("2024-01-05", feed_event(i)) for i in range(25)]
    landing.write_landing(
        records(spark, events).coalesce(1), folder("l"), "array", max_records_per_file=10
    )
    files = list(Path(folder("l")).rglob("part-*"))
    sizes = sorted(len(json.loads(f.read_text())) for f in files)
    assert sizes == [5, 10, 10]


def test_packer_bounds_what_a_task_holds():
    days = [("2024", "01", f"{d:02d}") for d in range(1, 9)]
    rows = [(*days[i % 8], "x" * 10) for i in range(400)]
    batch = pa.RecordBatch.from_pydict(
        {n: [r[i] for r in rows] for i, n in enumerate(("year", "month", "day", "record"))}
    )
    for max_records in (1000, 2):
        out = list(landing._array_packer(max_records, max_chars=200)([batch, batch.slice(0, 0), batch]))
        texts = [t for b in out for t in b.column("value").to_pylist()]
        assert sum(t.count("x" * 10) for t in texts) == 800
        assert max(len(t) for t in texts) < 300
        assert max(t.count("x" * 10) for t in texts) <= max_records
    in_day: dict = {}
    for b in out:
        for text, day in zip(b.column("value").to_pylist(), b.column("day").to_pylist()):
            in_day[day] = in_day.get(day, 0) + text.count("x" * 10)
    assert in_day == {f"{d:02d}": 100 for d in range(1, 9)}


@pytest.mark.parametrize(
    "text",
    [
        '[{"id":"1"},{"id":',  # broken off
        '[{"id":"1"},{"id":oops},{"id":"3"}]',
        '[{"id":"1"}][{"id":"2"}]',  # a parser would stop after the first array
        '[{"id":"1"}] and more',
        '[{"id":"1"}],"x":[{"id":"2"}]',  # closes the array that it is parsed in
        '[{"id":"1"}],"records":[{"id":"2"}]',
        '[{"id":"1"}],["x"]',
        '{"id":"1"},{"id":"2"}',
        '{"id":"1"}] [',
    ],
)
def test_unreadable_file_is_kept_whole_and_others_load(spark, folder, text):
    put(folder("l"), text, name="bad.json")
    put(folder("l"), json.dumps([feed_event(1), feed_event(2)], indent=2), name="good.json")
    parsed = landing.parse_landing(landing.scan_landing(spark, folder("l"), "array"))
    assert ids(landing.readable(parsed)) == ["1", "2"]
    bad = landing.unreadable(parsed).collect()
    assert [r["raw_text"] for r in bad] == [text]
    assert bad[0]["file_name"].endswith("bad.json") and bad[0]["day"] == 5


def test_single_object_empty_array_and_blank_files(spark, folder):
    put(folder("l"), json.dumps(feed_event(1)), name="object.json")
    put(folder("l"), "[]", name="empty.json")
    put(folder("l"), " \n", name="blank.json")
    parsed = landing.parse_landing(landing.scan_landing(spark, folder("l"), "array"))
    assert ids(landing.readable(parsed)) == ["1"]
    assert landing.unreadable(parsed).isEmpty()


def test_bad_lines_do_not_hide_good_ones(spark, folder):
    good = [json.dumps(feed_event(i)) for i in (1, 2)]
    bad = ['{"id":', good[1] + good[0], good[1] + "," + good[0], good[0] + "] ["]
    put(folder("l"), "\n".join([good[0], *bad[:2], "", *bad[2:]]) + "\n")
    parsed = landing.parse_landing(landing.scan_landing(spark, folder("l")))
    assert ids(landing.readable(parsed)) == ["1"]
    assert sorted(r["raw_text"] for r in landing.unreadable(parsed).collect()) == sorted(bad)


def test_a_line_may_hold_an_array(spark, folder):
    put(folder("l"), json.dumps([feed_event(1), feed_event(2)]) + "\n[]\n" + json.dumps(feed_event(3)))
    parsed = landing.parse_landing(landing.scan_landing(spark, folder("l")))
    assert ids(landing.readable(parsed)) == ["1", "2", "3"] and landing.unreadable(parsed).isEmpty()


def test_wide_ids_and_json_types(spark, folder):
    wide = feed_event(1, repo={"id": 3_000_000_000, "name": "n", "url": "u"}, extra=[1, {"a": None}])
    landing.write_landing(records(spark, [("2024-01-05", wide)]), folder("l"))
    found = landing.read_landing(spark, folder("l"))
    assert stg_events(found).first()["repo_id"] == 3_000_000_000
    assert json.loads(found.select(F.to_json("raw_data")).first()[0]) == wide


def test_date_filter_prunes_files(spark, folder):
    events = [(f"2024-01-{d:02d}", feed_event(d)) for d in range(1, 10)]
    landing.write_landing(records(spark, events), folder("l"))
    found = landing.readable(
        landing.parse_landing(landing.scan_landing(spark, folder("l")).where("day BETWEEN 3 AND 4"))
    )
    assert ids(found) == ["3", "4"]
    assert "PartitionFilters: [isnotnull(day" in plan_of(found).replace("\n", "")


def test_days_are_listed_alone(spark, folder):
    events = [(f"2023-12-{d}", feed_event(d)) for d in (30, 31)]
    events += [(f"2024-01-{d:02d}", feed_event(d)) for d in (1, 2, 4)]
    landing.write_landing(records(spark, events), folder("l"))
    text = landing.scan_days(spark, folder("l"), dt.date(2023, 12, 31), dt.date(2024, 1, 3))
    found = landing.readable(landing.parse_landing(text))
    assert ids(found) == ["1", "2", "31"]  # a day without a folder is no error
    assert len(text.inputFiles()) == 3
    assert {(r["year"], r["month"], r["day"]) for r in found.collect()} == {
        (2023, 12, 31), (2024, 1, 1), (2024, 1, 2)
    }


def test_one_file_reads_back(spark, folder):
    put(folder("l"), json.dumps([feed_event(1)]), name="a.json")
    put(folder("l"), json.dumps([feed_event(2)]), name="b.json")
    file = f"{folder('l')}/year=2024/month=01/day=05/b.json"
    found = landing.read_back(spark, folder("l"), file, "array")
    assert ids(found) == ["2"]
    assert (found.first()["month"], found.first()["day"]) == (1, 5)


def test_files_are_listed_by_day(spark, folder):
    events = [(f"2024-01-{d:02d}", feed_event(d)) for d in (1, 2, 4)]
    landing.write_landing(records(spark, events), folder("l"))
    assert landing.list_files(spark, folder("l")).count() == 3
    two = landing.list_files(spark, folder("l"), [dt.date(2024, 1, 2), dt.date(2024, 1, 3)])
    assert [(r["month"], r["day"]) for r in two.collect()] == [(1, 2)]


def test_listing_in_tasks_equals_that_of_the_file_source(spark, folder):
    events = [(f"2024-{m:02d}-{d:02d}", feed_event(d)) for m in (1, 2) for d in range(1, 13)]
    landing.write_landing(records(spark, events), folder("l"))
    day = Path(folder("l"), "year=2024", "month=01", "day=03")
    for name in ("a b%41#é?.json", "_hidden.json", ".hidden.json", "below/c.json", "_below/d.json"):
        (day / name).parent.mkdir(exist_ok=True)
        (day / name).write_text("{}")
    for root in (folder("l"), "file:" + folder("l")):
        found = landing.list_files(spark, root)
        want = landing._listed_by_spark(spark, folder("l"), None)
        assert sorted(map(tuple, found.collect())) == sorted(map(tuple, want.collect()))
        assert found.rdd.getNumPartitions() > 1
    some = [dt.date(2024, 1, 3), dt.date(2024, 2, 1), dt.date(2024, 3, 1)]
    assert landing.list_files(spark, folder("l"), some).count() == landing._listed_by_spark(spark, folder("l"), some[:2]).count() == 4
    assert landing.list_files(spark, folder("none")).count() == 0


def test_a_flat_landing_zone_is_listed(spark, folder):
    Path(folder("l")).mkdir()
    Path(folder("l"), "x.json").write_text("{}")
    (row,) = landing.list_files(spark, folder("l")).collect()
    assert (row["length"], row["year"], row["day"]) == (2, None, None)


def test_two_landing_zones(spark, folder):
    for name in ("a", "b"):
        landing.write_landing(records(spark, [("2024-01-05", feed_event(1))]), folder(name))
    assert ids(landing.read_landing(spark, [folder("a"), folder("b")])) == ["1", "1"]


def test_stamp_adds_provenance(spark):
    events = spark.createDataFrame([("1", "2024-01-05 06:00:00")], "id STRING, t STRING").select(
        F.struct("id").alias("event"), F.col("t").cast("timestamp_ntz").alias("t")
    )
    stamped = landing.to_records(landing.stamp(events, F.col("t"), F.lit("org/r")))
    assert json.loads(stamped.first()["record"]) == {
        "id": "1", "_extracted_at": "2024-01-05T06:00:00Z", "_source_repo": "org/r"
    }


def test_inventory_lists_files_with_sizes(spark, folder):
    put(folder("l"), "[1]", name="a.json")
    put(folder("l"), "[12345]", day="year=2024/month=01/day=06", name="b.json")
    found = landing.landing_inventory(spark, folder("l")).collect()
    assert sorted((r["path"].rsplit("/", 1)[1], r["bytes"]) for r in found) == [
        ("a.json", 3), ("b.json", 7)
    ]


def load(spark, folder, load_id=None):
    parsed = landing.parse_landing(landing.scan_landing(spark, folder("l")))
    return raw_table.append_load(parsed, folder("raw"), load_id)


def test_loads_append_and_committed_ids_are_refused(spark, folder):
    events = [("2024-01-05", feed_event(1)), ("2024-01-06", feed_event(2)), ("2024-01-06", "{")]
    landing.write_landing(records(spark, events), folder("l"))
    assert load(spark, folder, "a") == raw_table.LoadCounts("a", 2, 1)
    with pytest.raises(ValueError, match="committed already"):
        load(spark, folder, "a")
    assert raw_table.read_raw(spark, folder("raw")).count() == 2
    load(spark, folder)  # another load adds
    raw = raw_table.read_raw(spark, folder("raw"))
    assert raw.count() == 4
    assert raw.schema.simpleString().startswith("struct<raw_data:variant,file_name:string")
    assert raw_table.read_quarantine(spark, folder("raw")).count() == 2
    pruned = plan_of(raw.where("day = 6")).replace("\n", "").split("PartitionFilters: ")[1]
    assert "isnotnull(day" in pruned.split("]")[0] and "readable" in pruned.split("]")[0]


def test_what_is_not_committed_is_not_read(spark, folder):
    landing.write_landing(records(spark, [("2024-01-05", feed_event(1))]), folder("l"))
    parsed = landing.parse_landing(landing.scan_landing(spark, folder("l")))
    counts = raw_table.write_rows(parsed, folder("raw"), "broken-off")
    assert raw_table.read_raw(spark, folder("raw")).isEmpty()
    raw_table.commit_load(spark, folder("raw"), counts)
    assert raw_table.read_raw(spark, folder("raw")).count() == 1


def test_a_load_parses_its_text_once(spark, folder):
    """Readable and unreadable rows leave in one pass: the plan of the writing has one parser a branch."""
    landing.write_landing(records(spark, [("2024-01-05", "{"), ("2024-01-05", feed_event(1))]), folder("l"))
    parsed = landing.parse_landing(landing.scan_landing(spark, folder("l")))
    kept = parsed.where(F.col("raw_data").isNotNull() | landing.is_unreadable())
    lines = plan_of(kept).split("== Physical Plan ==")[1].splitlines()
    assert sum(line.count("from_json(") for line in lines) == 2  # arrays, single values


@pytest.mark.parametrize("layout", landing.LAYOUTS)
def test_compact_writes_few_files_and_the_same_rows(spark, folder, layout):
    events = [(f"2024-01-{1 + i % 4:02d}", feed_event(i)) for i in range(200)] + [("2024-01-01", "{")]
    frame = records(spark, events).repartition(8)
    if layout == "array":
        frame = frame.where("record <> '{'")
    landing.write_landing(frame, folder("l"), layout, compact=True)
    assert len(list(Path(folder("l")).rglob("part-*"))) == 4
    parsed = landing.parse_landing(landing.scan_landing(spark, folder("l"), layout))
    counts = raw_table.append_load(parsed.repartition(8), folder("raw"), "a", compact=True)
    assert (counts.rows_loaded, counts.rows_quarantined) == (200, int(layout == "lines"))
    good = Path(folder("raw"), "load_id=a", "readable=true")
    assert len(list(good.rglob("part-*"))) == 4
    assert ids(raw_table.read_raw(spark, folder("raw"))) == sorted(str(i) for i in range(200))


def test_dump_keeps_records_as_they_are(spark, folder):
    from tests.helpers import raw

    event = feed_event(1, unknown={"nested": [1, 2]})
    landing.write_valid_dump(raw(spark, [event]), folder("dump"))
    assert [json.loads(r["value"]) for r in spark.read.text(folder("dump")).collect()] == [event]


def test_small_loads_are_put_together(spark, folder):
    for number in range(6):
        days = [("2024-01-05", feed_event(number)), (f"2024-01-{6 + number % 2:02d}", feed_event(10 + number)), ("2024-01-05", "{")]
        landing.write_landing(records(spark, days), folder("l"))
        incremental_load(spark, folder("l"), folder("raw"))
    raw = folder("raw")

    def state():
        rows = raw_table.read_raw(spark, raw).selectExpr("load_id", "file_name", "day", "variant_get(raw_data, '$.id', 'string')")
        bad = raw_table.read_quarantine(spark, raw).select("load_id", "file_name", "raw_text")
        counted = raw_table.loads(spark, raw).select("load_id", "rows_loaded", "rows_quarantined", "number")
        return [sorted(map(tuple, t.collect())) for t in (rows, bad, counted)]

    before, some = state(), raw_table.load_ids(spark, raw)[:2]
    first = raw_table.compact_loads(spark, raw, some)
    assert state() == before
    one = raw_table.read_raw(spark, raw, some[:1])
    assert {r["load_id"] for r in one.collect()} == {some[0]} and one.count() == 2
    landing.write_landing(records(spark, [("2024-01-05", feed_event(50))]), folder("l"))
    incremental_load(spark, folder("l"), folder("raw"))
    before = state()
    second = raw_table.compact_loads(spark, raw)
    assert state() == before and raw_table.compact_loads(spark, raw) is None
    files = [p.parts[-5:-1] for p in Path(raw, f"load_id={second}").rglob("part-*")]
    assert len(files) == len(set(files)) == 3 + 1  # days with events, and one with unreadable text
    gone = raw_table.remove_moved(spark, raw)
    assert first in gone and len(gone) == 8 and state() == before
    assert [p.name for p in Path(raw).glob("load_id=*")] == [f"load_id={second}"]
    assert incremental_load(spark, folder("l"), raw) == []


def test_compactions_that_overlap_move_loads_once(spark, folder, monkeypatch):
    for number in range(3):
        landing.write_landing(records(spark, [("2024-01-05", feed_event(number))]), folder("l"))
        incremental_load(spark, folder("l"), folder("raw"))
    step, other = raw_table.commit, []

    def overlapped(*arguments):
        if not other:
            other.append(None)
            other.append(raw_table.compact_loads(spark, folder("raw")))
        return step(*arguments)

    with monkeypatch.context() as patched:
        patched.setattr(raw_table, "commit", overlapped)
        assert raw_table.compact_loads(spark, folder("raw")) is None
    assert {r["folder"] for r in raw_table.loads(spark, folder("raw")).collect()} == {other[1]}
    assert raw_table.read_raw(spark, folder("raw")).count() == 3
