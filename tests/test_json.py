import json

import pytest
from pyspark.sql import functions as F

from adstream.functions.jsontext import (
    encode_rows,
    parse_events,
    parse_notices,
    quarantined_events,
    quarantined_notices,
)
from adstream.sources.notices import batch_file_paths, completion_notices
from tests.rows import client_json, clients, values

MALFORMED = [
    "", "  ", "{bad", "[1]", '[{"ad_id":1}]', '"x"', "12", "null", None,
    '{"ad_id":1} trailing', '{"ad_id":1}{"ad_id":2}', '{"ad_id":1} {"ad_id":2}', '{"ad_id":1} x}',
    '{"ad_id":1},{"ad_id":2}', '{"ad_id":1}],[{"ad_id":2}', '{"ad_id":1},{"_end":"x"}',
    "{'ad_id':1}", '{"ad_id":1', "}{",
]


def raw(spark, texts):
    return spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "n int, value string")


def test_values_stay_text(spark):
    texts = ['{"ad_id":400}', '{"ad_id":"400"}', '{"ad_id":400.0}', '{"ad_id":"abc"}', '{"ad_id":null}', "{}"]
    got = parse_events(raw(spark, texts), "client")
    assert [r.ad_id for r in got.orderBy("n").collect()] == ["400", "400", "400.0", "abc", None, None]


def test_whitespace_and_bytes(spark):
    df = raw(spark, [' \n{"ad_id": 1}\t\r\n']).withColumn("value", F.col("value").cast("binary"))
    assert values(parse_events(df, "client"), "ad_id") == [("1",)]


@pytest.mark.parametrize("side", ["client", "server"])
def test_malformed_rows_are_set_aside(spark, side):
    df = raw(spark, [client_json(), *MALFORMED, "{}"])
    assert values(parse_events(df, side), "n") == [(0,), (len(MALFORMED) + 1,)]
    kept = quarantined_events(df, side)
    assert values(kept, "n", "value", "side") == sorted(
        ((i + 1, t, side) for i, t in enumerate(MALFORMED)), key=repr
    )


def test_each_row_is_parsed_once(spark, tmp_path):
    raw(spark, [client_json()]).write.parquet(f"{tmp_path}/raw")
    df = parse_events(spark.read.parquet(f"{tmp_path}/raw"), "client").where("ad_id = '400'")
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json") == 1


def test_encode_keeps_nulls_and_numbers(spark):
    df = clients(spark, {"ad_id": "abc", "latency": None, "user_id": "1"}, {"publisher_id": "007"})
    got = [json.loads(r.value) for r in encode_rows(df).orderBy("value").collect()]
    by_ad = {row["ad_id"]: row for row in got}
    assert set(by_ad) == {"abc", 400}
    assert by_ad["abc"]["latency"] is None and by_ad["abc"]["user_id"] == "1"
    assert by_ad[400]["publisher_id"] == "007" and by_ad[400]["ctimestamp"] == 100
    assert list(got[0]) == df.columns


def test_encode_round_trip(spark):
    df = clients(spark, {"user_agent": 'quote " and \\ and é'}, {"clicked": None})
    again = parse_events(encode_rows(df), "client")
    assert values(again, *df.columns) == values(df, *df.columns)


def test_notices(spark):
    notice = {
        "bucket": "s3://b",
        "data_frequency": "hourly",
        "folder_path": "20240101/07",
        "server_events_file": "server_events.json",
        "client_events_file": "client_events.json",
    }
    df = parse_notices(raw(spark, [json.dumps(notice), "nonsense"]))
    assert values(batch_file_paths(df), "client_path", "server_path") == [
        ("s3://b/20240101/07/client_events.json", "s3://b/20240101/07/server_events.json")
    ]
    assert [json.loads(r.value) for r in completion_notices(df).collect()] == [
        ["foldername", "s3://b/20240101/07"]
    ]


def test_incomplete_notices_are_set_aside(spark):
    texts = [
        '{"bucket":"b","folder_path":"x"}',
        "{}",
        "nonsense",
        '{"bucket":"b","folder_path":"x","client_events_file":"c","server_events_file":"s"}',
    ]
    assert values(parse_notices(raw(spark, texts)), "n") == [(3,)]
    kept = quarantined_notices(raw(spark, texts))
    assert values(kept, "value", "side") == sorted((t, "notice") for t in texts[:3])
