"""Flatten raw records into the typed staging relation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from forgepulse import schemas as S
from forgepulse.functions.records import can_fail, field, is_wrong_type


def stg_events(
    raw: DataFrame, strict: bool = True, keep: Sequence[str | Column] = ()
) -> DataFrame:
    """One row per raw record, 15 typed columns, followed by the ``keep`` columns of ``raw``.

    ``raw`` needs ``raw_data VARIANT`` and ``loaded_at``. One map-only projection with literal
    paths: over a raw table in Parquet the scan then reads just the shredded columns of the paths
    that a query uses, already typed, and no variant is put together.

    With ``strict`` a value of the wrong type aborts the query. Spark may evaluate a filter on such
    a column before other filters, so do not rely on one filter to keep bad values from another:
    behind ``valid_records`` use the lenient form and count ``wrong_types``.
    """
    fixed = [field("raw_data", path, kind, strict).alias(name) for name, path, kind in S.STAGED_FIELDS]
    event_type = field("raw_data", "$.type", "string", strict)
    by_type = [
        F.when(event_type == only, field("raw_data", path, kind, strict)).alias(name)
        for name, only, path, kind in S.STAGED_BY_TYPE
    ]
    star = F.when(event_type == S.WATCH, 1).otherwise(0).alias("is_star_event")
    return raw.select(*fixed, *by_type, star, "loaded_at", *keep)


def wrong_types() -> dict[str, Column]:
    """Staging column -> whether its value has the wrong type, for columns where that can be."""
    found = {
        name: is_wrong_type("raw_data", path, kind)
        for name, path, kind in S.STAGED_FIELDS
        if can_fail(kind)
    }
    event_type = field("raw_data", "$.type", "string")
    for name, only, path, kind in S.STAGED_BY_TYPE:
        if can_fail(kind):
            wrong = (event_type == only) & is_wrong_type("raw_data", path, kind)
            found[name] = F.coalesce(wrong, F.lit(False))
    return found
