"""Records of feeds on a topic, with files in the place of the broker."""

import pytest
from pyspark.sql import functions as F

from adstream.operators.match import assign_window
from adstream.plans.batch import process_matched
from adstream.session import scratch_path
from adstream.streaming.sinks import Write, feed_messages, sent_once, topic_records
from tests.rows import clients, values
from tests.test_tables import dims

WRITES = [Write("stream", "r", 7), Write("stream", "r", 8), Write("stream", "other", 7), Write("batch", "r", 7, 1)]


@pytest.fixture
def outcome(spark):
    # The same beacon in two windows: equal texts of two rows.
    rows = clients(spark, {}, {}, {"user_id": "u2"}, {"latency": None}).coalesce(1)
    when = F.timestamp_seconds(F.monotonically_increasing_id() * 40)
    return process_matched(assign_window(rows.withColumn("publish_ts", when)), dims(spark))


def test_keys_tell_rows_and_not_replays(spark, outcome):
    messages = feed_messages(outcome, ("window", "publish_ts"), marked=True)
    n = messages.count()
    assert n == 4 + 3 and messages.select("value").distinct().count() < n
    keys = {w: [bytes(r.key) for r in topic_records(messages, w).collect()] for w in WRITES}
    for w, own in keys.items():
        assert len(set(own)) == n
        again = topic_records(messages.repartition(3), w)
        assert {bytes(r.key) for r in again.collect()} == set(own)
    assert len({k for own in keys.values() for k in own}) == n * len(WRITES)
    headers = {h.key: bytes(h.value) for h in topic_records(messages, WRITES[3]).first().headers}
    assert headers == {"run": b"r", "batch_id": b"7", "part": b"1", "feed": b"validated"}


@pytest.mark.parametrize("streaming", [False, True])
def test_a_reader_sees_replayed_messages_once(spark, outcome, streaming):
    messages = feed_messages(outcome, ("window", "publish_ts"), marked=True)
    path = scratch_path(spark, "topic")
    stamp = F.timestamp_seconds(F.lit(100)).alias("timestamp")
    # The first attempt of a batch died after it had sent some, the second sent all.
    for rows in (messages.where("feed = 'validated'"), messages):
        topic_records(rows, WRITES[0]).select("*", stamp).write.mode("append").parquet(path)
    topic_records(messages, WRITES[1]).select("*", stamp).write.mode("append").parquet(path)
    if not streaming:
        got = sent_once(spark.read.parquet(path))
    else:
        schema = spark.read.parquet(path).schema
        query = (
            sent_once(spark.readStream.schema(schema).option("maxFilesPerTrigger", "1").parquet(path))
            .writeStream.format("parquet")
            .option("path", f"{path}-out")
            .option("checkpointLocation", f"{path}-c")
            .trigger(availableNow=True)
            .start()
        )
        query.awaitTermination()
        got = spark.read.parquet(f"{path}-out")
    expected = [(v,) for (v,) in values(messages, "value")] * 2
    assert values(got.withColumn("value", F.col("value").cast("string")), "value") == sorted(expected, key=repr)


def test_cleanup_messages_are_told_by_their_text(spark):
    messages = spark.createDataFrame([("a", "cleanup"), ("b", "cleanup"), ("a", "cleanup")], "value string, feed string")
    records = topic_records(messages, WRITES[0])
    assert values(sent_once(records).select(F.col("value").cast("string")), "value") == [("a",), ("b",)]
