import pytest

from adstream.operators.validate import split_validity, validate_client_events
from adstream.schemas import CLIENT_EVENT
from tests.rows import clients, values

NULL, TYPE = "Invalid due to null", "Invalid due to Data type"


def verdicts(spark, *changes, **options):
    got = validate_client_events(clients(spark, *changes), **options)
    return [(r.validity_status, r.invalid_field) for r in got.collect()]


@pytest.mark.parametrize("first", range(len(CLIENT_EVENT.names)))
def test_first_failing_rule_wins(spark, first):
    fields = CLIENT_EVENT.names[first:]
    assert verdicts(spark, {f: None for f in fields}) == [(NULL, fields[0])]


def test_valid_row(spark):
    assert verdicts(spark, {}, {"clicked": "no"}) == [("", ""), ("", "")]


def test_clicked_values(spark):
    assert verdicts(spark, {"clicked": "unknown"}) == [(TYPE, "clicked")]
    assert verdicts(spark, {"clicked": "Yes"}) == [(TYPE, "clicked")]


def test_numeric_ids_are_not_checked_by_default(spark):
    assert verdicts(spark, {"ad_id": "abc", "publisher_id": "x9"}) == [("", "")]


@pytest.mark.parametrize("text", ["abc", "-1", "4.0", "", "1 "])
def test_numeric_check(spark, text):
    assert verdicts(spark, {"ad_id": text}, numeric_check=True) == [(TYPE, "ad_id")]
    assert verdicts(spark, {"publisher_id": text}, numeric_check=True) == [(TYPE, "publisher_id")]
    assert verdicts(spark, {"ad_id": None}, numeric_check=True) == [(NULL, "ad_id")]


def test_split_is_a_partition(spark):
    df = validate_client_events(clients(spark, {}, {"latency": None}, {"clicked": "maybe"}))
    valid, invalid = split_validity(df)
    assert valid.count() == 1
    assert values(invalid, "invalid_field") == [("clicked",), ("latency",)]
