import re
from pathlib import Path

import pytest

import __spark_entry__ as driver
from tagstream.plans.oracle import ORACLE
from tagstream.plans.queries import QUERIES
from tests.compare import duck, mismatch

DATA = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not Path(DATA).exists(), reason="needs the given tables")


@pytest.fixture(scope="module")
def tables():
    return duck(DATA)


def test_every_query_has_its_sql():
    assert QUERIES.keys() == ORACLE.keys()
    assert QUERIES.items() <= driver.queries().items() and ORACLE.items() <= driver.oracle_sql().items()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, tables, name):
    assert mismatch(driver.queries()[name](spark, DATA), tables, driver.oracle_sql()[name]) is None


def test_entry(spark):
    df = driver.entry(spark)
    assert df.columns == ["key", "val"] and df.count() > 0


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


SHUFFLES = {
    "message_source": 0, "parse_readings": 0, "event_epoch_seconds": 0, "rewrite_time_field": 0,
    "reading_entries": 0, "quarantine_bad_messages": 0, "cache_key_values": 0,
    "conform_to_table_schema": 0, "reject_unknown_tags": 0, "conform_double_10_3": 0,
    "producer_records": 0, "event_epoch_seconds_long_fields": 0,
    "latest_by_key": 1, "latest_by_namespace": 1, "latest_by_extra_key": 1, "first_by_key": 1,
    "live_keys_ttl": 1, "live_keys_out_of_order": 1, "insert_ignore_existing": 3, "infer_table_columns_first": 0,
    "offset_ranges": 1, "commit_offsets": 2, "batch_report": 1, "infer_table_columns": 0,
}


@pytest.mark.parametrize("name", sorted(SHUFFLES))
def test_plan(spark, name):
    text = plan(driver.queries()[name](spark, DATA))
    assert text.count("Exchange ") == SHUFFLES[name]
    assert "Python" not in text and "Arrow" not in text and "CartesianProduct" not in text
    parses = len(re.findall(r"parseJson", text))
    # The result's own text is read again, or there are two logs.
    twice = ("rewrite_time_field", "latest_by_key", "latest_by_namespace", "latest_by_extra_key", "insert_ignore_existing")
    assert parses <= 1 + (name in twice), "a message is parsed more than once"
    if SHUFFLES[name]:
        assert "partial_" in text


@pytest.mark.parametrize("name", ["resume_from_offsets", "resume_from_offsets_strict", "start_latest"])
def test_resume_plans(spark, name):
    """One join, the positions reduced on the map side; the log itself is not collected or crossed."""
    text = plan(driver.queries()[name](spark, DATA))
    assert len(re.findall("(?:BroadcastHash|SortMerge)Join", text)) == 1 and "partial_max" in text
    assert "Python" not in text and "CartesianProduct" not in text and "NestedLoop" not in text
