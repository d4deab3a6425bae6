"""Every registered query against its DuckDB counterpart, whole tables."""

from __future__ import annotations

import pytest

import __spark_entry__ as suite
from fixtures.oracle import ORACLE
from tests.compare import oracle_connection, oracle_rows, spark_rows

SF_DIR = "/root/testdata/sf0.01"
# Queries of this file's oracle; those of subpackages have tests of their own.
NAMES = [n.removeprefix("q_") for n in vars(suite) if n.startswith("q_")]


@pytest.fixture(scope="module")
def duck():
    return oracle_connection(SF_DIR)


@pytest.mark.parametrize("name", NAMES)
def test_query(spark, duck, name):
    schema, rows = spark_rows(suite.queries()[name](spark, SF_DIR))
    assert rows, "an empty result proves nothing"
    expected_schema, expected = oracle_rows(duck, ORACLE[name])
    assert schema == expected_schema
    assert rows == expected


def test_every_oracle_belongs_to_a_query():
    assert set(ORACLE) == set(NAMES)


def test_entry(spark):
    assert suite.entry(spark).count() > 0


def test_typed_staging_equals_staging_from_json(spark):
    from fixtures.envelope import raw_events, source_events, staged_events
    from forgepulse.operators.staging import stg_events

    events = source_events(spark, SF_DIR)
    typed = staged_events(events)
    parsed = stg_events(raw_events(events)).select(*typed.columns)
    assert parsed.schema.simpleString() == typed.schema.simpleString()
    assert parsed.exceptAll(typed).isEmpty() and typed.exceptAll(parsed).isEmpty()


SETTINGS = {
    "spark.sql.session.timeZone": "America/New_York",
    "spark.sql.ansi.enabled": "false",
    "spark.sql.adaptive.enabled": "false",
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.shuffle.partitions": "3",
    "spark.sql.variant.writeShredding.enabled": "false",
    "spark.sql.variant.pushVariantIntoScan": "false",
}


@pytest.fixture
def other_settings(spark):
    before = {key: spark.conf.get(key) for key in SETTINGS}
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    yield
    for key, value in before.items():
        spark.conf.set(key, value)


@pytest.mark.parametrize(
    "name",
    ["stg_events", "top_contributors", "event_trends", "trend_anomalies", "daily_rank", "retention",
     "validate_summary", "dq_relationships", "ingest_landing", "ingest_incremental", "full_build"],
)
def test_results_do_not_depend_on_session_settings(spark, duck, other_settings, name):
    _, rows = spark_rows(suite.queries()[name](spark, SF_DIR))
    assert rows == oracle_rows(duck, ORACLE[name])[1]
