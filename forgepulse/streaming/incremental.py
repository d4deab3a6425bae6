"""Load only landing files that no earlier run has loaded."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from urllib.parse import quote, unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from forgepulse import schemas as S
from forgepulse.operators.numbering import numbered
from forgepulse.session import new_folder, settle
from forgepulse.sources import arrays, raw_table
from forgepulse.sources.landing import list_files, parse_landing, scan_files
from forgepulse.sources.raw_table import LoadCounts

#: Files of one load; their paths are what the driver holds.
FILES_PER_LOAD = 10_000
LAYOUTS = ("auto", "lines", "array")


def incremental_load(
    spark: SparkSession,
    landing: str,
    raw_path: str,
    layout: str = "auto",
    max_files_per_load: int = FILES_PER_LOAD,
    days: Sequence[dt.date] | None = None,
    compact: bool = False,
) -> list[LoadCounts]:
    """Load all files that no committed load holds, in loads of bounded size.

    New files are those of the listing whose path and length no load names; their age does not matter.
    With ``days`` only the folders of these days are listed, so a run need not list a zone that has
    grown for years. Nothing is dropped as late, and copies of an event are resolved when the staging
    relation is built. Runs may overlap: a load that finds some of its files committed by another run
    is given up and repeated with the others.

    ``layout``: ``lines``, each an event or an array of events, or ``array``, one array a file over any
    number of lines, as the files were written. ``auto`` reads lines; a file that turns out to begin as an
    array over several lines is then read as one array. Files of any size are read in bounded memory. An array
    that breaks off, or holds an element that is not JSON, goes to the quarantine whole.
    """
    if layout not in LAYOUTS:
        raise ValueError(f"layout must be one of {LAYOUTS}")
    seen = raw_table.last_commit(spark, raw_path)
    known = raw_table.loaded_files(spark, raw_path).select("path", "length")
    pending, count = in_loads(list_files(spark, landing, days), known, max_files_per_load)
    done = []
    for number in range(count):
        files = pending.where(F.col("load") == number).select("path", "length", *S.LANDING_PARTITIONS)
        done += _load(spark, landing, raw_path, files, layout, compact, seen)
    return done


def in_loads(listed: DataFrame, known: DataFrame, max_files_per_load: int) -> tuple[DataFrame, int]:
    """The listed files that are not ``known`` with the number of their load, by day and path, as a
    written table that each load reads its own part of; and how many loads there are."""
    new = listed.join(known, ["path", "length"], "left_anti")
    order = [F.col(c).asc_nulls_first() for c in (*S.LANDING_PARTITIONS, "path", "length")]
    placed = numbered(new, order, "place").withColumn("load", F.floor(F.col("place") / max_files_per_load))
    folder = new_folder(listed.sparkSession, "new-files")
    placed.drop("place").write.partitionBy("load").parquet(folder)
    pending = listed.sparkSession.read.schema(placed.drop("place").schema).parquet(folder)
    last = pending.agg(F.max("load")).first()[0]
    return pending, 0 if last is None else last + 1


def _load(
    spark: SparkSession, landing: str, raw_path: str, files: DataFrame, layout: str, compact: bool, seen: int
) -> list[LoadCounts]:
    """One load, or none if other runs have committed all of its files meanwhile."""
    by_path = {r["path"]: r for r in files.collect()}
    if not by_path:
        return []
    if layout == "array":
        named = [(as_file_name(p), p, *[r[c] for c in S.LANDING_PARTITIONS]) for p, r in by_path.items()]
        whole = _arrays(spark, named, others_too=True)
        counts = raw_table.write_rows(whole, raw_path, raw_table.new_load_id(), compact)
    else:
        parsed = parse_landing(scan_files(spark, landing, list(by_path), "lines"))
        counts = raw_table.write_rows(parsed, raw_path, raw_table.new_load_id(), compact)
        if layout == "auto" and counts.rows_quarantined:
            counts = _with_arrays(spark, raw_path, counts, by_path, compact)
    if raw_table.commit_load(spark, raw_path, counts, files, seen):
        return [counts]
    later = raw_table.last_commit(spark, raw_path)
    left = files.join(raw_table.loaded_files(spark, raw_path), ["path", "length"], "left_anti")
    return _load(spark, landing, raw_path, settle(left, "files-left"), layout, compact, later)


def _with_arrays(
    spark: SparkSession, raw_path: str, counts: LoadCounts, by_path: dict, compact: bool
) -> LoadCounts:
    """The load once more, files that begin as one array over several lines read as that. The first
    writing stays uncommitted."""
    bad = raw_table.read_quarantine(spark, raw_path, [counts.load_id])
    opens = F.regexp_like(F.col("raw_text"), F.lit(r"^\s*\["))
    names = [r["file_name"] for r in bad.where(opens).select("file_name").distinct().collect()]
    listed = {_parts(path)[2]: path for path in by_path}
    named = [
        (n, path := listed[unquote(_parts(n)[2])], *[by_path[path][c] for c in S.LANDING_PARTITIONS]) for n in names
    ]
    if not named:
        return counts
    whole = _arrays(spark, named)
    if whole.isEmpty():
        return counts
    found = whole.select(F.col("file_name").alias("array_file")).distinct()
    by_line = raw_table.rows_of_loads(spark, raw_path, [counts.load_id]).drop("load_id", "readable")
    rest = by_line.join(found, F.col("file_name") == F.col("array_file"), "left_anti")
    return raw_table.write_rows(
        rest.unionByName(whole), raw_path, raw_table.new_load_id(), compact
    )


def _arrays(spark: SparkSession, named: list[tuple], others_too: bool = False) -> DataFrame:
    """Rows as ``parse_landing`` gives them of the files (file name, path, year, month, day) that are one
    array: its elements, or the whole text, in pieces, where it breaks off or an element is not JSON.
    Files that are no array have no rows, or with ``others_too`` are read like broken ones."""
    kinds = ", ".join(f"{c} INT" for c in S.LANDING_PARTITIONS)
    files = spark.createDataFrame(named, f"file STRING, path STRING, {kinds}")
    parsed = F.when(F.col("kind").isNull(), F.try_parse_json("value"))
    read = settle(arrays.array_elements(files).select("file", "kind", parsed.alias("raw_data")), "array-elements")
    state = read.groupBy("file").agg(
        F.max("kind").alias("kind"), F.count_if(F.col("kind").isNull() & F.col("raw_data").isNull()).alias("bad"),
    )
    good = (F.col("kind") == arrays.ARRAY) & (F.col("bad") == 0)
    told = settle(
        files.join(state, "file").withColumn("good", good).where(F.lit(others_too) | (F.col("kind") != arrays.OTHER)),
        "array-files",
    )
    lineage = [F.col("file").alias("file_name"), F.current_timestamp().alias("loaded_at"), *S.LANDING_PARTITIONS]
    elements = read.where(F.col("kind").isNull()).select("file", "raw_data").join(
        told.where("good").select("file", *S.LANDING_PARTITIONS), "file"
    )
    torn = told.where("not good")
    texts = arrays.text_pieces(torn).join(torn.select("file", *S.LANDING_PARTITIONS), "file")
    return elements.select("raw_data", F.lit(None).cast("string").alias("raw_text"), *lineage).unionAll(
        texts.where(F.regexp_like("value", F.lit(r"\S"))).select(
            F.lit(None).cast("variant"), F.col("value"), *lineage
        )
    )


def as_file_name(path: str) -> str:
    """A listed path as scans name its file: as a URI, with percent signs."""
    scheme, authority, name = _parts(path)
    return f"{scheme}://{authority}{quote(name, safe=_PLAIN)}"


#: What a URI's path shows as it is.
_PLAIN = "/!$&'()*+,;=:@~-._"


def _parts(path: str) -> tuple[str, str, str]:
    scheme, rest = path.split(":", 1)
    if not rest.startswith("//"):
        return scheme, "", rest
    authority, _, name = rest[2:].partition("/")
    return scheme, authority, f"/{name}"
