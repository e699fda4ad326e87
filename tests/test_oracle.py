"""Every registered query against DuckDB on the same tables."""

import math
import os
from collections import Counter

import duckdb
import pytest

import __spark_entry__ as contract
from workload import oracle, queries

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")
TABLES = ("events", "supplier", "customer")
# Row counts at sf0.01.
EXPECTED_ROWS = {
    "match_windowed": 9794,
    "match_batch": 9655,
    "valid_events": 6437,
    "absent_users": None,
    "backfill_web_users": 100,
    "backfill_web_users_limited": 50,
}


def normal(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 9)
    if hasattr(value, "tzinfo") and value.tzinfo is not None:
        return value.replace(tzinfo=None)
    return value


def bag(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(normal(row[i]) for i in order) for row in rows)


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    connection.execute("SET TimeZone='UTC'")
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS FROM '{SF_DIR}/{name}.parquet'")
    return connection


def test_every_query_has_an_oracle():
    assert set(queries.queries()) == set(oracle.oracle_sql())
    assert set(contract.oracle_sql()) <= set(contract.queries())


@pytest.mark.parametrize("name", sorted(queries.queries()))
def test_query_equals_oracle(spark, duck, name):
    ours = contract.queries()[name](spark, SF_DIR)
    rows = [tuple(r) for r in ours.collect()]
    theirs = duck.sql(contract.oracle_sql()[name])
    assert sorted(ours.columns) == sorted(theirs.columns)
    expected = bag(theirs.columns, theirs.fetchall())
    got = bag(ours.columns, rows)
    missing, extra = expected - got, got - expected
    assert not missing and not extra, (
        f"{len(rows)} rows; missing {sum(missing.values())}: {list(missing)[:3]}; "
        f"extra {sum(extra.values())}: {list(extra)[:3]}"
    )
    if SF_DIR.endswith("sf0.01") and EXPECTED_ROWS.get(name):
        assert len(rows) == EXPECTED_ROWS[name]


def test_verdict_counts(spark):
    if not SF_DIR.endswith("sf0.01"):
        pytest.skip("counts are for sf0.01")
    # Verdicts as written and with the numeric check.
    null, wrong = "Invalid due to null", "Invalid due to Data type"
    common = {
        (null, "ad_id"): 104,
        (null, "clicked"): 884,
        (null, "ctimestamp"): 103,
        (null, "latency"): 103,
        (null, "page_id"): 104,
        (null, "publisher_id"): 104,
        (null, "user_agent"): 104,
    }
    expected = {
        "validate_as_written": {**common, (wrong, "clicked"): 1851, ("", ""): 6437},
        "validate_numeric": {
            **common,
            (wrong, "ad_id"): 104,
            (wrong, "publisher_id"): 104,
            (wrong, "clicked"): 1805,
            ("", ""): 6275,
        },
    }
    for name, counts in expected.items():
        rows = contract.queries()[name](spark, SF_DIR)
        got = rows.groupBy("validity_status", "invalid_field").count().collect()
        assert {(r[0], r[1]): r[2] for r in got} == counts


def test_entry(spark):
    assert contract.entry(spark).count() > 0
