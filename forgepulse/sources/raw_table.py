"""The raw table: one VARIANT per event in Parquet, partitioned by load and landing day.

A load writes the folder ``load_id=<id>``, the list of its files, and then commits by a row in the log of
loads beside it. Only committed loads are read: what a broken attempt left behind is never seen, and its
repetition is a load of its own. Load ids are unique, so two feeds, or one feed whose progress was reset,
cannot overwrite each other. Commits are numbered: of two runs that load the same new files at the same
time, the second to commit is refused and loads only what is still missing.

Many small loads leave many small files. Compaction writes the rows of loads that were committed together
again, by landing day, to one folder, and commits that these loads are there now; a load stays what it was
to its readers, and the folders that it was in can be deleted when no one reads them any more.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from forgepulse import schemas as S
from forgepulse.session import remove
from forgepulse.sources.commits import commit, read_commits
from forgepulse.sources.landing import is_unreadable

# File sources pass over names that begin with an underscore.
_LOADS, _FILES = "_loads", "_files"


@dataclass(frozen=True)
class LoadCounts:
    load_id: str
    rows_loaded: int
    rows_quarantined: int


def new_load_id(name: str = "load") -> str:
    return f"{name}-{uuid.uuid4().hex}"


def write_rows(
    parsed: DataFrame, raw_path: str, load_id: str, compact: bool = False
) -> LoadCounts:
    """Write one load without committing it: readable events and unreadable text in one pass.

    A load of a few days is map-only. With many small files of many days every task would write a
    small file per day; ``compact`` then gathers days first, and adaptive execution splits hot ones.
    """
    counts = Observation(f"load {load_id}")
    kept = parsed.where(F.col("raw_data").isNotNull() | is_unreadable()).withColumn(
        "readable", F.col("raw_data").isNotNull()
    )
    days = [F.col(c) for c in S.LANDING_PARTITIONS]
    source = kept.hint("rebalance", *days) if compact else kept
    observed = source.observe(
        counts, F.count_if("readable").alias("good"), F.count_if(~F.col("readable")).alias("bad")
    )
    writer = observed.write.mode("overwrite").option("partitionOverwriteMode", "static")
    writer.partitionBy("readable", *S.LANDING_PARTITIONS).parquet(f"{raw_path}/load_id={load_id}")
    return LoadCounts(load_id, counts.get.get("good", 0), counts.get.get("bad", 0))


def commit_load(
    spark: SparkSession, raw_path: str, counts: LoadCounts, files: DataFrame | None = None, seen: int | None = None
) -> bool:
    """Make a written load visible, together with the files (path, length) that it holds.

    ``seen``: the last commit when these files were found to be new. False, and nothing is visible, if a
    later commit holds any of them.
    """
    if has_load(spark, raw_path, counts.load_id):
        raise ValueError(f"load {counts.load_id} is committed already")
    if files is not None:
        own = f"{raw_path}/{_FILES}/load_id={counts.load_id}"
        files.select("path", "length").write.mode("overwrite").parquet(own)
        files = spark.read.schema("path STRING, length BIGINT").parquet(own)
    number = last_commit(spark, raw_path) if seen is None else seen
    row = {
        "load_id": counts.load_id, "rows_loaded": counts.rows_loaded, "rows_quarantined": counts.rows_quarantined,
    }
    while not commit(spark, f"{raw_path}/{_LOADS}", number + 1, [row]):
        number = last_commit(spark, raw_path)
        if files is not None and seen is not None:
            later = loaded_files(spark, raw_path, after=seen)
            if not files.join(later, ["path", "length"], "left_semi").isEmpty():
                return False
    return True


def append_load(
    parsed: DataFrame, raw_path: str, load_id: str | None = None, compact: bool = False
) -> LoadCounts:
    """Add one load and commit it. An id that is committed already is refused."""
    spark, load_id = parsed.sparkSession, load_id or new_load_id()
    if has_load(spark, raw_path, load_id):
        raise ValueError(f"load {load_id} is committed already")
    counts = write_rows(parsed, raw_path, load_id, compact)
    commit_load(spark, raw_path, counts)
    return counts


def loads(spark: SparkSession, raw_path: str) -> DataFrame:
    """Committed loads with their counts, the ``number`` of their commit and the folder that holds their
    rows; none before the first."""
    moved = F.when(F.col("folder").isNotNull(), F.col("number"))
    return read_commits(spark, f"{raw_path}/{_LOADS}", S.LOADS_SCHEMA).groupBy("load_id").agg(
        F.max("rows_loaded").alias("rows_loaded"), F.max("rows_quarantined").alias("rows_quarantined"),
        F.min("number").alias("number"), F.coalesce(F.max_by("folder", moved), "load_id").alias("folder"),
    )


def last_commit(spark: SparkSession, raw_path: str) -> int:
    rows = read_commits(spark, f"{raw_path}/{_LOADS}", S.LOADS_SCHEMA)
    return rows.agg(F.max("number")).first()[0] or 0


def loaded_files(spark: SparkSession, raw_path: str, after: int = 0) -> DataFrame:
    """(load_id, path, length) of the files that committed loads hold, or those after a commit."""
    files = read_if_there(spark, S.LOADED_FILES_SCHEMA, f"{raw_path}/{_FILES}")
    committed = loads(spark, raw_path).where(F.col("number") > after).select("load_id")
    return files.join(committed, "load_id", "left_semi")


def read_if_there(spark: SparkSession, schema: str, path: str) -> DataFrame:
    """A Parquet table; without rows, and created so, while nothing is written at its path."""
    spark.createDataFrame([], schema).write.mode("ignore").parquet(path)
    return spark.read.schema(schema).parquet(path)


def load_ids(spark: SparkSession, raw_path: str) -> list[str]:
    """Committed loads, as many as there were runs."""
    return [r["load_id"] for r in loads(spark, raw_path).select("load_id").collect()]


def has_load(spark: SparkSession, raw_path: str, load_id: str) -> bool:
    return not loads(spark, raw_path).where(F.col("load_id") == load_id).isEmpty()


def rows_of_loads(
    spark: SparkSession, raw_path: str, only: Sequence[str] | None = None
) -> DataFrame:
    """Rows of all committed loads, or of some, committed or not, readable or not, as they are stored."""
    place = {r["load_id"]: r["folder"] for r in loads(spark, raw_path).select("load_id", "folder").collect()}
    ids = list(place) if only is None else list(only)
    schema = S.RAW_TABLE_SCHEMA
    if not ids:
        return spark.createDataFrame([], schema).drop("of_load")
    reader = spark.read.schema(schema).option("basePath", raw_path)
    folders = sorted({place.get(i, i) for i in ids})
    rows = reader.parquet(*[f"{raw_path}/load_id={f}" for f in folders])
    rows = rows.withColumn("load_id", F.coalesce("of_load", "load_id")).drop("of_load")
    shared = any(place.get(i, i) != i for i in ids) and only is not None
    return rows.where(F.col("load_id").isin(ids)) if shared else rows


def compact_loads(spark: SparkSession, raw_path: str, only: Sequence[str] | None = None) -> str | None:
    """Write the rows of all committed loads, or of some, together to one folder, and return its name;
    None if there are no two folders to put together, or if another compaction has moved one of them.

    Rows of a landing day come together, and adaptive execution packs days into files by size: small
    ones into one, large ones into several of the advisory partition size. Loads that are committed
    meanwhile do not disturb it, and are not part of it.
    """
    seen = last_commit(spark, raw_path)
    held = loads(spark, raw_path)
    held = held if only is None else held.where(F.col("load_id").isin(list(only)))
    place = {r["load_id"]: r["folder"] for r in held.select("load_id", "folder").collect()}
    if len(set(place.values())) < 2:
        return None
    folder, days = new_load_id("compacted"), [F.col(c) for c in S.LANDING_PARTITIONS]
    rows = rows_of_loads(spark, raw_path, list(place)).withColumnRenamed("load_id", "of_load")
    writer = rows.hint("rebalance", F.col("readable"), *days).write.partitionBy("readable", *S.LANDING_PARTITIONS)
    writer.parquet(f"{raw_path}/load_id={folder}")
    number, moves = seen, [{"load_id": i, "folder": folder} for i in place]
    while not commit(spark, f"{raw_path}/{_LOADS}", number + 1, moves):
        number = last_commit(spark, raw_path)
        now = {r["load_id"]: r["folder"] for r in loads(spark, raw_path).select("load_id", "folder").collect()}
        if any(now[i] != f for i, f in place.items()):
            return None
    return folder


def remove_moved(spark: SparkSession, raw_path: str) -> list[str]:
    """Delete the folders of loads that a compaction has moved. Not while someone still reads them."""
    held = loads(spark, raw_path).where(F.col("folder") != F.col("load_id")).select("load_id", "folder").collect()
    current = {r["folder"] for r in held}
    once = read_commits(spark, f"{raw_path}/{_LOADS}", S.LOADS_SCHEMA).where(F.col("folder").isNotNull())
    earlier = {r["folder"] for r in once.select("folder").distinct().collect()} - current
    gone = sorted({r["load_id"] for r in held} | earlier)
    for folder in gone:
        remove(f"{raw_path}/load_id={folder}")
    return gone


def read_raw(
    spark: SparkSession, raw_path: str, only: Sequence[str] | None = None
) -> DataFrame:
    """Readable events of all committed loads, or of some."""
    return rows_of_loads(spark, raw_path, only).where("readable").drop("raw_text", "readable")


def read_quarantine(
    spark: SparkSession, raw_path: str, only: Sequence[str] | None = None
) -> DataFrame:
    """Unreadable text of all committed loads, or of some, kept whole."""
    return rows_of_loads(spark, raw_path, only).where("NOT readable").select(
        "raw_text", F.lit("malformed json").alias("reason"), "file_name", "loaded_at", "load_id",
        *S.LANDING_PARTITIONS,
    )


def counts_frame(spark: SparkSession, counts: list[LoadCounts]) -> DataFrame:
    """Run metrics as a relation, one row per load."""
    rows = [(c.load_id, c.rows_loaded, c.rows_quarantined) for c in counts]
    return spark.createDataFrame(
        rows, "load_id STRING, rows_loaded BIGINT, rows_quarantined BIGINT"
    )
