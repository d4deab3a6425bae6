"""Record validation: which records satisfy the event schema, and why the others do not.

Rules (reason -> what must hold):
  id, type            JSON strings
  created_at          JSON string that parses as a timestamp
  actor.id, repo.id   present and convertible to an integer (numeric text is accepted)
  actor.login, actor.url, repo.name, repo.url   JSON strings
  actor.display_login absent, null or a JSON string
Unknown fields are accepted and kept; ``payload`` is not checked.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from forgepulse.functions.records import castable, json_type
from forgepulse.operators.staging import wrong_types

_INTEGER = ("actor.id", "repo.id")
_TIMESTAMP = ("created_at",)
_NULLABLE_TEXT = ("actor.display_login",)
REASONS = (
    "id", "type", "created_at", "actor.id", "actor.login", "actor.display_login", "actor.url",
    "repo.id", "repo.name", "repo.url",
)


def _holds(reason: str) -> Column:
    path = f"$.{reason}"
    if reason in _INTEGER:
        return castable("raw_data", path, "bigint")
    if reason in _NULLABLE_TEXT:
        return json_type("raw_data", path).isin("STRING", "VOID")
    text = json_type("raw_data", path) == "STRING"
    if reason in _TIMESTAMP:
        return text & castable("raw_data", path, "timestamp_ntz")
    return text


def is_valid() -> Column:
    """True when every rule holds; stops at the first broken rule."""
    return reduce(lambda left, right: left & right, [_holds(reason) for reason in REASONS])


def with_reasons(raw: DataFrame) -> DataFrame:
    """Add ``reasons``: the rules a record breaks, an empty array for a valid one."""
    broken = [F.when(~_holds(reason), F.lit(reason)) for reason in REASONS]
    return raw.withColumn("reasons", F.array_compact(F.array(*broken)))


def all_reasons_of() -> Column:
    """The rules that a record breaks and its values that staging could not type, as ``type:<column>``; an
    empty array for a record that can be staged, which is told by the conditions alone."""
    broken = {reason: ~_holds(reason) for reason in REASONS}
    broken |= {f"type:{name}": wrong for name, wrong in untypable().items()}
    named = F.array_compact(F.array(*[F.when(rule, F.lit(reason)) for reason, rule in broken.items()]))
    return F.when(reduce(lambda left, right: left | right, broken.values()), named).otherwise(
        F.array().cast("array<string>")
    )


def with_all_reasons(raw: DataFrame) -> DataFrame:
    """Add ``reasons`` for the rules and for values that staging could not type: ``type:<column>``."""
    return raw.withColumn("reasons", all_reasons_of())


def untypable() -> dict[str, Column]:
    """Staging columns that no rule covers -> whether their value has the wrong type."""
    covered = {"event_id", "event_type", "actor_id", "actor_login", "repo_id", "repo_name", "event_timestamp"}
    return {name: wrong for name, wrong in wrong_types().items() if name not in covered}


def valid_records(raw: DataFrame) -> DataFrame:
    """Records that satisfy every rule, unchanged."""
    return raw.where(is_valid())


def validation_summary(raw: DataFrame) -> DataFrame:
    """Rows (reason, dropped) for every rule, plus ``any`` and ``valid``; one pass, one small
    aggregate. A record that breaks two rules counts under both and once under ``any``."""
    checked = with_reasons(raw)
    counts = [
        F.count_if(F.array_contains("reasons", reason)).alias(f"r{i}")
        for i, reason in enumerate(REASONS)
    ]
    totals = [
        F.count_if(F.size("reasons") > 0).alias("r_any"),
        F.count_if(F.size("reasons") == 0).alias("r_valid"),
    ]
    labels = [(reason, f"r{i}") for i, reason in enumerate(REASONS)]
    labels += [("any", "r_any"), ("valid", "r_valid")]
    pairs = [part for label, column in labels for part in (F.lit(label), F.col(column))]
    return checked.agg(*counts, *totals).select(
        F.stack(F.lit(len(labels)), *pairs).alias("reason", "records")
    )
