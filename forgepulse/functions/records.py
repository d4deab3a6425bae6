"""Expressions over one semi-structured record."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def field(record: str, path: str, kind: str, strict: bool = True) -> Column:
    """Typed value at ``path``; missing and JSON null give NULL.

    A value that cannot be cast aborts the query when ``strict``, else it is NULL as well. The cast
    itself is always the lenient one: Spark moves it into the Parquet scan, below any filter or
    condition around it, where a strict cast would fail on records that are never asked for.
    """
    value = F.try_variant_get(F.col(record), path, kind)
    if not strict or not can_fail(kind):
        return value
    text = F.try_variant_get(F.col(record), path, "string")
    message = F.concat(F.lit(f"{path} is not a {kind}: "), text)
    return F.coalesce(value, F.when(json_type(record, path) != "VOID", F.raise_error(message)))


def can_fail(kind: str) -> bool:
    return kind not in ("string", "variant")


def is_wrong_type(record: str, path: str, kind: str) -> Column:
    """True when there is a value at ``path`` that does not convert to ``kind``."""
    return ~castable(record, path, kind) & (json_type(record, path) != "VOID")


def json_type(record: str, path: str) -> Column:
    """Type name of the value at ``path``: STRING, BIGINT, ...; VOID for null and for no value."""
    value = F.try_variant_get(F.col(record), path, "variant")
    return F.coalesce(F.schema_of_variant(value), F.lit("VOID"))


def castable(record: str, path: str, kind: str) -> Column:
    """True when a value is present at ``path`` and converts to ``kind``."""
    return F.try_variant_get(F.col(record), path, kind).isNotNull()


#: Stands after a text to tell that a parser read all of it; no text that holds it is accepted.
_END = "\u2403 end of text \u2403"


def text_records(text: Column) -> Column:
    """The records of one JSON text as an array of variants: the elements of its array or its single
    value; NULL when the text is not JSON or goes on after its value.

    A JSON parser stops after the first complete value and ignores what follows. Here the text is
    one element of an array with an end mark behind it: a text that ends the array early hides the
    mark, one that adds elements moves it, and both give NULL. Elements of an array become variants
    one by one, so the size limit of a variant applies to an event and not to a file.
    """
    def marked(kind: str, end: str) -> Column:
        whole = F.concat(F.lit("["), text, F.lit(f",{end}]"))
        # In a lambda the parsed array is one value; outside, each use would parse again.
        return F.array(F.from_json(whole, f"array<{kind}>"))

    def if_complete(parsed: Column, end: Callable[[Column], Column]) -> Column:
        complete = F.filter(parsed, lambda p: (F.size(p) == 2) & (end(F.get(p, F.lit(1))) == _END))
        return F.get(complete, F.lit(0))

    string = lambda value: F.try_variant_get(value, "$", "string")
    elements = if_complete(
        marked("array<variant>", f'["{_END}"]'), lambda last: string(F.get(last, F.lit(0)))
    )
    single = if_complete(marked("variant", f'"{_END}"'), string)
    records = F.when(
        F.regexp_like(text, F.lit(r"^\s*\[")), F.get(elements, F.lit(0))
    ).otherwise(F.slice(single, 1, 1))
    return F.when(~F.contains(text, F.lit(_END)), records)


def iso_utc(moment: Column) -> Column:
    """ISO-8601 text with a Z suffix for a zone-less timestamp that holds UTC."""
    return F.concat(F.replace(moment.cast("string"), F.lit(" "), F.lit("T")), F.lit("Z"))
