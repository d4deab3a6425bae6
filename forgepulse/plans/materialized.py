"""Staging and the models as tables of the catalog, brought up to the published state day by day.

Tables of days are partitioned by day. A run overwrites the days that have changed since the state that a
table holds, and the days behind them that windows reach: for the rolling mean those of the next six rows of a
repository, for trends that of its next hour. No other day is written; readers of other days are not
disturbed, those of a day that is being replaced may have to read again. Totals of contributors have no days:
they are written whole, to a folder of their own, and the folder before the last is deleted.

The state that a table holds is a property of it. Whoever brings tables up to date looks for a later state
at the end, so of two at the same time the last to finish leaves the last state.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from forgepulse import schemas as S
from forgepulse.plans import partials
from forgepulse.plans import versions as V
from forgepulse.session import remove

_STAGING = "stg_events"
#: Table -> its column of days; None: totals.
TABLES = {
    _STAGING: V.DAY, "daily_activity": "activity_date", "event_trends": V.DAY,
    "contributor_stats": None, "top_contributors": None,
}
_STATE, _ROOT, _FOLDERS = "forgepulse.state", "forgepulse.root", "forgepulse.folders"


def table(spark: SparkSession, name: str) -> DataFrame:
    """A materialized table in the columns of its model."""
    held = spark.table(_stored(spark, name))
    return held.drop(V.DAY) if TABLES[name] == V.DAY else held


def update(spark: SparkSession, root: str, k: int = S.TOP_K) -> None:
    """Bring all tables up to the last published state."""
    state = V.read_state(spark, root)
    while True:
        # Tables that are written for the first time are submitted together, so that executors that one leaves
        # idle work on the next; replacing days changes a setting of the session, so that is one at a time.
        first = [name for name in TABLES if _properties(spark, name).get(_ROOT) != root]
        with ThreadPoolExecutor(len(TABLES)) as pool:
            running = [pool.submit(_update, spark, root, name, state, k) for name in first]
        for job in running:
            job.result()
        for name in TABLES:
            if name not in first:
                _update(spark, root, name, state, k)
        last = V.read_state(spark, root)
        if last.number == state.number:
            return
        state = last


def _update(spark: SparkSession, root: str, name: str, state: V.State, k: int) -> None:
    known = _properties(spark, name)
    ours = known.get(_ROOT) == root
    held = int(known[_STATE]) if ours else 0
    if ours and held >= state.number:
        return
    if TABLES[name] is None:
        _write_totals(spark, root, name, state, k, known if ours else {})
        return
    rows, reached = _days_table(spark, root, name, state)
    changed = V.days_changed_since(spark, root, _STAGING, held)
    if not ours:
        path = f"{root}/published/{name}"
        rows.write.mode("overwrite").partitionBy(TABLES[name]).option("path", path).saveAsTable(_stored(spark, name))
    elif changed:
        days = {*changed, *reached(changed)}
        kept = set(state.days.get(_STAGING, {}))
        own = rows.where(F.col(TABLES[name]).isin(sorted(days & kept)))
        _replace_days(own, _stored(spark, name))
        for day in days - kept:  # its last event has moved to another day
            remove(f"{root}/published/{name}/{TABLES[name]}={day}")
    _finish(spark, name, {_STATE: state.number, _ROOT: root})


def _replace_days(rows: DataFrame, stored: str) -> None:
    """Replace the days of a table that ``rows`` has; the writer has no option for it, only the session."""
    conf, name = rows.sparkSession.conf, "spark.sql.sources.partitionOverwriteMode"
    before = conf.get(name)
    conf.set(name, "dynamic")
    try:
        rows.write.mode("overwrite").insertInto(stored)
    finally:
        conf.set(name, before)


def _days_table(
    spark: SparkSession, root: str, name: str, state: V.State
) -> tuple[DataFrame, Callable[[Sequence], list]]:
    """Rows of a table, its days last, and the days that changed ones reach."""
    if name == _STAGING:
        return V.read_days(spark, root, name, S.STAGED_SCHEMA, state), lambda changed: []
    source, model, reach = {
        "daily_activity": ("daily_counts", partials.daily_activity, partials.days_of_activity),
        "event_trends": ("hourly_counts", partials.event_trends, partials.days_of_trends),
    }[name]
    counts = V.read_days(spark, root, source, partials.SCHEMAS[source], state)
    rows, day = model(counts), TABLES[name]
    if day == V.DAY:
        rows = rows.withColumn(day, F.to_date("event_hour"))
    ordered = rows.select(*[c for c in rows.columns if c != day], day)
    return ordered.hint("rebalance", day), lambda changed: [r[V.DAY] for r in reach(counts, changed).collect()]


def _write_totals(spark: SparkSession, root: str, name: str, state: V.State, k: int, known: dict) -> None:
    counts = V.read_days(spark, root, "contributor_counts", partials.SCHEMAS["contributor_counts"], state)
    rows = partials.contributor_stats(counts) if name == "contributor_stats" else partials.leading_contributors(counts, k)
    path = f"{root}/published/{name}/{V.new_run()}"
    rows.write.mode("overwrite").option("path", path).saveAsTable(_stored(spark, name))
    *older, last = known.get(_FOLDERS, path).split(" ")  # readers may still be at the last one
    for folder in older:
        remove(folder)
    folders = path if last == path else f"{last} {path}"
    _finish(spark, name, {_STATE: state.number, _ROOT: root, _FOLDERS: folders})


def _stored(spark: SparkSession, name: str) -> str:
    """With its database: a view of that name would hide the table."""
    return f"{spark.catalog.currentDatabase()}.{name}"


def _properties(spark: SparkSession, name: str) -> dict[str, str]:
    if not spark.catalog.tableExists(_stored(spark, name)):
        return {}
    return {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {_stored(spark, name)}").collect()}


def _finish(spark: SparkSession, name: str, properties: dict) -> None:
    pairs = ", ".join(f"'{key}' = '{value}'" for key, value in properties.items())
    spark.sql(f"ALTER TABLE {_stored(spark, name)} SET TBLPROPERTIES ({pairs})")
    spark.catalog.refreshTable(_stored(spark, name))
    spark.catalog.dropTempView(name)
