"""The landing zone: event files below ``year=YYYY/month=MM/day=DD``.

Two layouts. ``array``: every file is one JSON array of events, the form feeds deliver; such a
file cannot be split, so writers bound its size. ``lines``: one event per line, or one array per
line, splittable, the form for bulk loads. Files get unique names and are only ever added.
"""

from __future__ import annotations

import datetime as dt
import re
from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from forgepulse import schemas as S
from forgepulse.functions.records import iso_utc, text_records
from forgepulse.session import file_system, local_path

LAYOUTS = ("array", "lines")
#: Files of a listing in one batch.
LISTED_AT_ONCE = 10_000
#: Names that file sources pass over.
_HIDDEN = re.compile(r"/[_.]")


def stamp(events: DataFrame, extracted_at: Column, source_repo: Column) -> DataFrame:
    """Add provenance to a struct column ``event`` before it is serialized: pull time (UTC wall
    clock) and the repository whose feed was pulled."""
    return events.withColumn(
        "event",
        F.col("event")
        .withField("_extracted_at", iso_utc(extracted_at))
        .withField("_source_repo", source_repo),
    )


def to_records(events: DataFrame) -> DataFrame:
    """Serialize ``event`` to JSON text in ``record``; NULL fields are left out."""
    text = F.to_json(F.col("event"), {"ignoreNullFields": "true"})
    return events.withColumn("record", text).drop("event")


def union_feeds(feeds: Sequence[DataFrame]) -> DataFrame:
    """All events of several feeds; duplicates stay."""
    total = feeds[0]
    for feed in feeds[1:]:
        total = total.unionByName(feed, allowMissingColumns=True)
    return total


def _array_packer(max_records: int, max_chars: int):
    """Join the records of one task into JSON arrays, per day, without a shuffle.

    No array exceeds ``max_records`` records. Records are held up to about ``max_chars`` and then
    written out, so memory is bounded however many days and records a task sees.
    """

    def arrays_of(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        rows = pa.Table.from_batches(held)
        rows = rows.sort_by([(name, "ascending") for name in S.LANDING_PARTITIONS]).combine_chunks()
        days = [rows.column(name).to_numpy() for name in S.LANDING_PARTITIONS]
        new = np.ones(rows.num_rows, bool)
        new[1:] = np.logical_or.reduce([day[1:] != day[:-1] for day in days])
        place = np.arange(rows.num_rows)
        in_day = place - np.maximum.accumulate(np.where(new, place, 0))
        starts = np.nonzero(in_day % max_records == 0)[0]
        records = rows.column("record").chunk(0)
        lists = pa.ListArray.from_arrays(
            pa.array(np.append(starts, rows.num_rows), pa.int32()), records
        )
        text = pc.binary_join_element_wise("[", pc.binary_join(lists, ","), "]", "")
        found = [rows.column(name).chunk(0).take(pa.array(starts)) for name in S.LANDING_PARTITIONS]
        return pa.RecordBatch.from_arrays([text, *found], ["value", *S.LANDING_PARTITIONS])

    def pack(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        room = max_chars
        for batch in batches:
            chars = np.cumsum(pc.utf8_length(batch.column("record")).to_numpy())
            start = 0
            while start < batch.num_rows:
                before = chars[start - 1] if start else 0
                end = max(start + (not held), int(np.searchsorted(chars, before + room, "right")))
                held.append(batch.slice(start, end - start))
                room -= int(chars[end - 1] - before) if end > start else 0
                start = end
                if start < batch.num_rows:
                    yield arrays_of([b for b in held if b.num_rows])
                    held, room = [], max_chars
        if held:
            yield arrays_of(held)

    return pack


def write_landing(
    records: DataFrame,
    path: str,
    layout: str = "lines",
    max_records_per_file: int = 10_000,
    max_chars_per_task: int = 64_000_000,
    compact: bool = False,
) -> None:
    """Append ``records`` (``record STRING``, ``landing_date DATE``) to the landing zone.

    Map-only in both layouts: no day is gathered in one task. ``compact`` is for bulk loads whose
    tasks each hold many days: it brings days together first, hot ones in several tasks, and so
    avoids a small file per task and day.
    """
    if layout not in LAYOUTS:
        raise ValueError(f"layout must be one of {LAYOUTS}")
    if compact:
        records = records.hint("rebalance", F.col("landing_date"))
    dated = records.select(
        "record",
        F.date_format("landing_date", "yyyy").alias("year"),
        F.date_format("landing_date", "MM").alias("month"),
        F.date_format("landing_date", "dd").alias("day"),
    )
    if layout == "lines":
        lines = dated.withColumnRenamed("record", "value")
        writer = lines.write
    else:
        arrays = dated.mapInArrow(
            _array_packer(max_records_per_file, max_chars_per_task),
            "value STRING, year STRING, month STRING, day STRING",
        )
        writer = arrays.write.option("maxRecordsPerFile", 1)
    writer.mode("append").partitionBy(*S.LANDING_PARTITIONS).text(path)


def scan_landing(
    spark: SparkSession, paths: str | Sequence[str], layout: str = "lines"
) -> DataFrame:
    """Text of the files of one or more landing zones with lineage and partition columns; nothing
    is parsed yet, so a filter on year/month/day prunes files in each of them."""
    roots = [paths] if isinstance(paths, str) else list(paths)
    return union_feeds([_scan(spark, root, root, layout) for root in roots])


def scan_days(
    spark: SparkSession, root: str, first: dt.date, last: dt.date, layout: str = "lines"
) -> DataFrame:
    """Like ``scan_landing`` for the days ``first`` to ``last``. A filter prunes files after the
    whole zone has been listed; this lists only the folders of these days."""
    days = [first + dt.timedelta(days=n) for n in range((last - first).days + 1)]
    folders = ",".join(day.strftime("year=%Y/month=%m/day=%d") for day in days)
    return _scan(spark, root, f"{root}/{{{folders}}}", layout)


def read_back(
    spark: SparkSession, root: str, files: str | Sequence[str], layout: str = "lines"
) -> DataFrame:
    """Events of single landed files; ``root`` is the landing zone that their paths belong to."""
    return readable(parse_landing(scan_files(spark, root, files, layout)))


def scan_files(
    spark: SparkSession, root: str, files: str | Sequence[str], layout: str = "lines"
) -> DataFrame:
    """Text of single files of a landing zone; nothing else is listed."""
    return _scan(spark, root, files, layout)


def _scan(spark: SparkSession, root: str, path: str | Sequence[str], layout: str) -> DataFrame:
    reader = spark.read.schema(S.LANDING_SCHEMA).option("basePath", root)
    return with_lineage(reader.text(path, wholetext=layout == "array"))


def list_files(
    spark: SparkSession, root: str, days: Sequence[dt.date] | None = None
) -> DataFrame:
    """(path, length, year, month, day) of landed files, of all days or of some: then only the
    folders of these days are listed. Contents are not read.

    Tasks list the folders of single days; the driver only walks down to these, so it holds days and
    never files. Stores that Arrow cannot list are listed by Spark's own reader, through the driver.
    """
    try:
        files, base = file_system(root)
    except (pa.ArrowInvalid, pa.ArrowNotImplementedError):
        return _listed_by_spark(spark, root, days)
    folders = _folders(files, base, days)
    tasks = min(len(folders), int(spark.conf.get("spark.sql.shuffle.partitions")))
    listed = spark.createDataFrame(folders, "folder STRING, whole BOOLEAN").repartition(max(1, tasks), "folder")
    # Paths as Spark writes them in file sources.
    scheme = re.match(r"[^/:]+://[^/]*", root)
    prefix = scheme.group(0) + ("" if base.startswith("/") else "/") if scheme and not local_path(root) else "file:"

    def files_of(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, _ = file_system(root)
        for batch in batches:
            for folder, whole in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                found = store.get_file_info(fs.FileSelector(folder, allow_not_found=True, recursive=whole))
                found = [f for f in found if f.is_file and not _HIDDEN.search("/" + f.path[len(base):])]
                for start in range(0, len(found), LISTED_AT_ONCE):
                    some = found[start: start + LISTED_AT_ONCE]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([prefix + f.path for f in some]), pa.array([f.size for f in some], pa.int64())],
                        ["path", "length"],
                    )

    part = [
        F.regexp_extract("path", f"/{name}=([0-9]+)/", 1).try_cast("int").alias(name) for name in S.LANDING_PARTITIONS
    ]
    return listed.mapInArrow(files_of, "path STRING, length BIGINT").select("path", "length", *part)


def _folders(files: fs.FileSystem, base: str, days: Sequence[dt.date] | None) -> list[tuple[str, bool]]:
    """Folders to list: those of days with all that is below them, those above without."""
    if days is not None:
        return [(f"{base}/{d.strftime('year=%Y/month=%m/day=%d')}", True) for d in days]
    level, found = [base], []
    for _ in S.LANDING_PARTITIONS:
        found += [(folder, False) for folder in level]
        level = [
            f.path for folder in level
            for f in files.get_file_info(fs.FileSelector(folder, allow_not_found=True))
            if f.type == fs.FileType.Directory and not _HIDDEN.search("/" + f.base_name)
        ]
    return found + [(folder, True) for folder in level]


def _listed_by_spark(spark: SparkSession, root: str, days: Sequence[dt.date] | None) -> DataFrame:
    where = root
    if days is not None:
        where = f"{root}/{{{','.join(d.strftime('year=%Y/month=%m/day=%d') for d in days)}}}"
    files = spark.read.format("binaryFile").option("basePath", root).load(where)
    partitions = [
        (F.col(c) if c in files.columns else F.lit(None)).cast("int").alias(c)
        for c in S.LANDING_PARTITIONS
    ]
    return files.select("path", "length", *partitions)


def with_lineage(text: DataFrame) -> DataFrame:
    return text.select(
        "value",
        F.col("_metadata.file_path").alias("file_name"),
        F.current_timestamp().alias("loaded_at"),
        *S.LANDING_PARTITIONS,
    )


def parse_landing(text: DataFrame) -> DataFrame:
    """One row per event: ``raw_data VARIANT``. A line, or a file read whole, may hold one event or an
    array of them. Text that is not JSON gives one row with NULL ``raw_data`` and the whole text in
    ``raw_text``; blank files and lines give none. Split the result with ``readable`` and
    ``unreadable``."""
    keep = ("file_name", "loaded_at", *S.LANDING_PARTITIONS)
    found = F.col("records")
    # Only unreadable text travels on with its row; readable text is dropped here.
    opened = (
        text.where(F.regexp_like("value", F.lit(r"\S")))
        .withColumn("records", text_records(F.col("value")))
        .select("records", F.when(found.isNull(), F.col("value")).alias("raw_text"), *keep)
    )
    # The outer form keeps a row for unreadable text. It also keeps one for an empty array, with
    # neither record nor text, which both filters below drop; but for the inner form the optimizer
    # adds a size filter under the generator, and that would parse every text twice.
    return opened.select(F.explode_outer("records").alias("raw_data"), "raw_text", *keep)


def readable(parsed: DataFrame) -> DataFrame:
    return parsed.where(F.col("raw_data").isNotNull()).drop("raw_text")


def is_unreadable() -> Column:
    return F.col("raw_data").isNull() & F.col("raw_text").isNotNull()


def unreadable(parsed: DataFrame) -> DataFrame:
    return parsed.where(is_unreadable()).select(
        "raw_text", F.lit("malformed json").alias("reason"),
        *[c for c in parsed.columns if c not in ("raw_data", "raw_text")],
    )


def read_landing(
    spark: SparkSession, paths: str | Sequence[str], layout: str = "lines"
) -> DataFrame:
    """Readable events of the landing zone, one row per event."""
    return readable(parse_landing(scan_landing(spark, paths, layout)))


def landing_inventory(spark: SparkSession, path: str) -> DataFrame:
    """Landed files with landing day, byte size and time; contents are not read."""
    files = spark.read.format("binaryFile").option("basePath", path).load(path)
    return files.select(
        "path", F.col("length").alias("bytes"), "modificationTime",
        F.make_date(*[F.col(c).cast("int") for c in S.LANDING_PARTITIONS]).alias("landing_date"),
    )


def write_valid_dump(valid: DataFrame, path: str) -> None:
    """Validated events as JSON lines with all their fields, known or not."""
    valid.select(F.to_json("raw_data").alias("value")).write.mode("append").text(path)
