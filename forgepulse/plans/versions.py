"""Tables of days that runs replace, and the log that says which run holds each day.

A run writes the days that it changes to folders of its own, ``<table>/run=<id>/event_date=<day>``, and is
published by one numbered commit that names these days and nothing else. The run of a day is that of the
last commit that names it. Until its commit, and if the run fails, readers see what was before; days that
a run does not change are neither read nor written by it.

Runs may overlap. A run commits under the number after the state that it started from; if another run has
that number, it is told so and nothing of it is seen (see ``forgepulse.sources.commits``).
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from forgepulse.session import file_system
from forgepulse.sources.commits import commit, read_commits

DAY = "event_date"
_LOG = "_states"
_SCHEMA = "table STRING, event_date DATE, run STRING, load_id STRING"


@dataclass(frozen=True)
class State:
    """What readers see: the last commit, and for each table the run that holds each day."""

    number: int = 0
    days: Mapping[str, Mapping[dt.date | None, str]] = field(default_factory=dict)

    def with_run(self, run: str, tables: Sequence[str], touched: Sequence, filled: Sequence) -> State:
        """The state after ``run`` has written the ``touched`` days of some tables; those that are not
        ``filled`` have lost their last row."""
        days = {name: dict(held) for name, held in self.days.items()}
        for name in tables:
            own = days.setdefault(name, {})
            for day in touched:
                own.pop(day, None)
            own.update({day: run for day in filled})
        return State(self.number + 1, days)


def new_run() -> str:
    return uuid.uuid4().hex


def _log(spark: SparkSession, root: str) -> DataFrame:
    return read_commits(spark, f"{root}/{_LOG}", _SCHEMA)


def read_state(spark: SparkSession, root: str) -> State:
    """The last published state: as many rows as its tables have days."""
    # Rows without a table, of loads and runs, are one group that only tells the last number.
    last = _log(spark, root).groupBy("table", DAY).agg(
        F.max_by("run", "number").alias("run"), F.max("number").alias("number")
    )
    days: dict[str, dict] = {}
    number = 0
    for row in last.collect():
        number = max(number, row["number"] or 0)
        if row["table"] is not None and row["run"] is not None:
            days.setdefault(row["table"], {})[row[DAY]] = row["run"]
    return State(number, days)


def publish_run(
    spark: SparkSession, root: str, before: State, run: str, tables: Sequence[str],
    touched: Sequence, filled: Sequence, loads: Sequence[str],
) -> bool:
    """Commit what a run has changed since the state ``before``: the run that holds each touched day now,
    none for those that lost their last row, and the loads that it staged. False if another run has
    published meanwhile."""
    filled = set(filled)
    rows = [
        {"table": name, DAY: day and day.isoformat(), "run": run if day in filled else None}
        for name in tables for day in touched
    ]
    rows += [{"load_id": load} for load in loads] + [{"run": run}]
    return commit(spark, f"{root}/{_LOG}", before.number + 1, rows)


def staged_loads(spark: SparkSession, root: str) -> DataFrame:
    """(load_id) of the loads that published runs have staged."""
    return _log(spark, root).where(F.col("load_id").isNotNull()).select("load_id").distinct()


def published_runs(spark: SparkSession, root: str) -> DataFrame:
    """(run) of the runs that were published."""
    own = F.col("table").isNull() & F.col("load_id").isNull() & F.col("run").isNotNull()
    return _log(spark, root).where(own).select("run").distinct()


def days_changed_since(spark: SparkSession, root: str, name: str, number: int) -> list:
    """Days of a table that commits after ``number`` have named."""
    rows = _log(spark, root).where((F.col("number") > number) & (F.col("table") == name))
    return [r[DAY] for r in rows.select(DAY).distinct().collect()]


def folder(root: str, name: str, run: str) -> str:
    return f"{root}/{name}/run={run}"


def prune(spark: SparkSession, root: str, names: Sequence[str]) -> list[str]:
    """Delete the folders of runs that hold no day of the last state: replaced days' and broken runs'.

    Not while a run is under way, and not while someone reads an earlier state.
    """
    from pyarrow import fs

    state, gone = read_state(spark, root), []
    for name in names:
        held = set(state.days.get(name, {}).values())
        files, path = file_system(f"{root}/{name}")
        for entry in files.get_file_info(fs.FileSelector(path, allow_not_found=True)):
            run = entry.base_name.removeprefix("run=")
            if entry.base_name != run and run not in held:
                files.delete_dir(entry.path)
                gone.append(f"{name}/{entry.base_name}")
    return gone


def write_days(df: DataFrame, root: str, name: str, run: str, sort: Sequence[str] = ()) -> None:
    """Write the rows of ``df`` as days of ``run``. Rows must be clustered by day already, or few."""
    rows = df.sortWithinPartitions(DAY, *sort) if sort else df
    writer = rows.write.mode("overwrite").option("partitionOverwriteMode", "static")
    writer.partitionBy(DAY).parquet(folder(root, name, run))


def read_days(
    spark: SparkSession, root: str, name: str, schema: str, state: State, only: Sequence | None = None
) -> DataFrame:
    """Rows of a table, of all its days or of some; the folders of other days are not listed."""
    held = state.days.get(name, {})
    wanted = held if only is None else {day: held[day] for day in set(only) if day in held}
    paths = [
        f"{folder(root, name, run)}/{DAY}={day or '__HIVE_DEFAULT_PARTITION__'}" for day, run in wanted.items()
    ]
    if not paths:
        return spark.createDataFrame([], schema)
    reader = spark.read.schema(f"{schema}, run STRING").option("basePath", f"{root}/{name}")
    return reader.parquet(*sorted(paths)).drop("run")
