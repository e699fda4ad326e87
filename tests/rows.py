"""Literal events for tests."""

import json

from pyspark.sql import functions as F

from adstream.schemas import CLIENT_EVENT, SERVER_EVENT

CLIENT = {
    "ad_id": "400",
    "user_id": "u1",
    "publisher_id": "123",
    "page_id": "TECH_5",
    "ad_position": "LTOP1",
    "user_agent": "agent",
    "latency": "1000",
    "ctimestamp": "100",
    "clicked": "yes",
}
SERVER = {
    **{k: CLIENT[k] for k in ("ad_id", "user_id", "publisher_id", "page_id", "ad_position")},
    "user_agent": "agent",
    "server_id": "eu1",
    "stimestamp": "88",
}


def frame(spark, schema, default, changes):
    rows = [tuple({**default, **c}[f] for f in schema.names) for c in changes]
    return spark.createDataFrame(rows, schema).coalesce(2)


def clients(spark, *changes):
    return frame(spark, CLIENT_EVENT, CLIENT, changes or ({},))


def servers(spark, *changes):
    return frame(spark, SERVER_EVENT, SERVER, changes or ({},))


def client_json(**changes):
    event = {**CLIENT, "ad_id": 400, "publisher_id": 123, "latency": 1000, "ctimestamp": 100}
    return json.dumps({**event, **changes})


def server_json(**changes):
    return json.dumps({**SERVER, "ad_id": 400, "publisher_id": 123, "stimestamp": 88, **changes})


def messages(spark, rows):
    """``(epoch second, text)`` pairs as arrived messages."""
    df = spark.createDataFrame(rows, "ep bigint, value string")
    return df.select(F.timestamp_seconds("ep").alias("publish_ts"), "value")


def values(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)
