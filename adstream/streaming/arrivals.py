"""Arrival of messages: those that come too late for their window are kept apart, not dropped.

Spark drops rows behind the watermark of a stateful operator without a trace. The job here reads the
messages of all sides first. A stateful operator that holds no state but sees the watermark tells
for each message whether its window had closed when it came; both kinds are stored by one file
sink, whose log makes every row count once whatever is replayed.

Jobs that read the accepted messages lose none of them: a message was accepted because its window
was open by what all sides had brought before, and later readers never know more than that.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping
from functools import reduce

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout
from pyspark.sql.types import BooleanType, StringType, StructField, StructType, TimestampType

from adstream.operators.match import DELAY, WINDOW, with_arrival_watermark
from adstream.session import STREAM_CONF, configure, session_conf
from adstream.streaming.sinks import Sinks

FOLDER = "arrivals"
# Groups that the messages of a micro-batch are dealt into, and so tasks that may judge them.
SLOTS = 1024
ARRIVAL = StructType(
    [
        StructField("publish_ts", TimestampType()),
        StructField("value", StringType()),
        # The watermark that judged the message; NULL as long as a side has brought nothing.
        StructField("watermark", TimestampType()),
        StructField("late", BooleanType()),
        StructField("side", StringType()),
    ]
)


def _judged(width: int):
    def judge(
        key: tuple, frames: Iterator[pd.DataFrame], state: GroupState
    ) -> Iterator[pd.DataFrame]:
        watermark = state.getCurrentWatermarkMs()
        for frame in frames:
            end = (frame["us"] // width + 1) * width
            # A message without an arrival time belongs to no window.
            late = end.isna() | (end <= watermark * 1000)
            rows = frame[["side", "us", "value"]].assign(watermark=watermark, late=late)
            yield rows.astype({"us": "Int64"})

    return judge


def judged(messages: Mapping[str, DataFrame], delay: str = DELAY, width: str = WINDOW) -> DataFrame:
    """The messages of all sides with ``late``: whether their window had closed when they came.

    A window of ``width`` closes when every side has brought a message ``delay`` after its end, as
    for the match. Each side of ``messages`` has ``publish_ts`` and ``value``; a message without
    ``publish_ts`` is late.
    """
    sides = [
        with_arrival_watermark(rows, delay=delay).select(
            "publish_ts", "value", F.lit(side).alias("side"), F.unix_micros("publish_ts").alias("us")
        )
        for side, rows in messages.items()
    ]
    rows = reduce(DataFrame.unionByName, sides)
    rows = rows.withColumn("slot", F.pmod(F.xxhash64("value", "us"), F.lit(SLOTS)))
    width_us = int(pd.Timedelta(width).total_seconds() * 1_000_000)
    found = rows.groupBy("slot").applyInPandasWithState(
        _judged(width_us),
        "side string, us long, value string, watermark long, late boolean",
        "nothing int",
        "append",
        GroupStateTimeout.NoTimeout,
    )
    known = F.when(F.col("watermark") > 0, F.timestamp_millis("watermark"))
    times = {"publish_ts": F.timestamp_micros("us"), "watermark": known}
    return found.withColumns(times).select(*ARRIVAL.names)


def start_arrivals(
    spark: SparkSession,
    messages: Mapping[str, DataFrame],
    sinks: Sinks,
    checkpoint: str,
    delay: str = DELAY,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Store all messages below ``sinks.root``, by whether they are late and by side."""
    configure(spark)
    with session_conf(spark, STREAM_CONF):
        return (
            judged(messages, delay)
            .writeStream.queryName("arrivals")
            .outputMode("append")
            .option("checkpointLocation", checkpoint)
            .trigger(**(trigger or {"processingTime": "30 seconds"}))
            .partitionBy("late", "side")
            .format("parquet")
            .option("path", sinks.path(FOLDER))
            .start()
        )


def accepted_stream(spark: SparkSession, sinks: Sinks, side: str) -> DataFrame:
    """The accepted messages of one side as an unbounded frame, for the jobs that follow."""
    rows = spark.readStream.schema(ARRIVAL).parquet(sinks.path(FOLDER))
    return rows.where(~F.col("late") & (F.col("side") == side)).select("publish_ts", "value")


def read_arrivals(spark: SparkSession, sinks: Sinks) -> DataFrame:
    """All stored messages; those with ``late`` came after their window had closed."""
    return spark.read.schema(ARRIVAL).parquet(sinks.path(FOLDER))
