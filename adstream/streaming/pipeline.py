"""The continuous job over the two event streams."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from adstream.functions.jsontext import parse_events, quarantined_events
from adstream.operators.match import DELAY, assign_window, match_events, with_arrival_watermark
from adstream.plans.batch import process_matched, stage
from adstream.session import STREAM_CONF, configure, session_conf
from adstream.sources.dimensions import Dimensions
from adstream.streaming.sinks import (
    Sinks,
    Write,
    dealt_by_day,
    outcome_writes,
    run_of,
    run_together,
    write_rejected,
)

SOURCE = "stream"
DimensionSource = Dimensions | Callable[[], Dimensions]


def current(dims: DimensionSource) -> Dimensions:
    """A fixed snapshot, or a fresh one per micro-batch where a reader is given."""
    return dims() if callable(dims) else dims


def windowed_events(messages: DataFrame, side: str, delay: str = DELAY) -> DataFrame:
    """Decode messages, watermark them by arrival and assign their window."""
    events = parse_events(with_arrival_watermark(messages, delay=delay), side)
    return assign_window(events)


def matched_stream(
    client: DataFrame,
    server: DataFrame,
    delay: str = DELAY,
    order_by: Sequence[str] | None = None,
) -> DataFrame:
    """Matched beacons of two message streams, one stateful aggregation."""
    return match_events(
        windowed_events(client, "client", delay),
        windowed_events(server, "server", delay),
        ("window",),
        order_by,
    )


def start_stream(
    spark: SparkSession,
    client: DataFrame,
    server: DataFrame,
    dims: DimensionSource,
    sinks: Sinks,
    checkpoint: str,
    delay: str = DELAY,
    numeric_check: bool = False,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Start the job: match on the streams, all outputs from one micro-batch.

    A message that arrives more than ``delay`` behind the slower side's newest
    one is dropped, as its window may be closed. Choose it longer than a backlog
    can be uneven; :func:`watch_late` stores how many rows were dropped. Each micro-batch is staged once; validation, lookups and writes are then
    ordinary batch plans under AQE. A replayed batch overwrites its own staging
    folder and its own partitions.
    """

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        write = Write(SOURCE, run_of(spark), batch_id)
        day = F.date_format("window.start", "yyyyMMdd")
        matched = stage(spark, batch.withColumn("day", day), sinks.staging(write))
        if matched.isEmpty():
            return
        matched = dealt_by_day(matched, sinks.staging(write, "dealt"))
        agents = sinks.staging(write, "agents")
        outcome = process_matched(matched, current(dims), numeric_check, keep=("day",), agents=agents)
        internal = ("window", "publish_ts", "day")
        run_together(spark, *outcome_writes(outcome, sinks, write, internal))

    configure(spark)
    matched = matched_stream(client, server, delay)
    with session_conf(spark, STREAM_CONF):
        return (
            matched.writeStream.queryName("ad_events")
            .outputMode("append")
            .option("checkpointLocation", checkpoint)
            .trigger(**(trigger or {"processingTime": "30 seconds"}))
            .foreachBatch(write_batch)
            .start()
        )


class _LateRows(StreamingQueryListener):
    """Stores, for each micro-batch that dropped rows as late, how many."""

    def __init__(self, spark: SparkSession, sinks: Sinks):
        self.spark, self.sinks = spark, sinks

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        dropped = sum(s.numRowsDroppedByWatermark for s in progress.stateOperators)
        if dropped:
            watermark = progress.eventTime.get("watermark")
            row = (str(progress.id), progress.batchId, watermark, dropped)
            shape = "run string, batch_id long, watermark string, dropped long"
            rows = self.spark.createDataFrame([row], shape).coalesce(1)
            rows.write.mode("append").parquet(self.sinks.path("late_rows"))


def watch_late(spark: SparkSession, sinks: Sinks) -> StreamingQueryListener:
    """Store counts of rows dropped behind the watermark in ``late_rows``.

    Rows of a side are counted after the map-side step of the match, so equal
    keys of one task count once. Returns the listener, to be removed again.
    """
    listener = _LateRows(spark, sinks)
    spark.streams.addListener(listener)
    return listener


def start_quarantine(
    messages: DataFrame, side: str, sinks: Sinks, checkpoint: str, trigger: dict | None = None
) -> StreamingQuery:
    """Keep messages of one stream that do not decode. Stateless."""
    spark = configure(messages.sparkSession)

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        day = F.coalesce(F.date_format("publish_ts", "yyyyMMdd"), F.lit("none")).alias("day")
        rows = batch.select("publish_ts", "value", "side", day)
        write_rejected(rows, sinks, Write(SOURCE, run_of(spark), batch_id))

    return (
        quarantined_events(messages, side)
        .writeStream.queryName(f"quarantine_{side}")
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": "30 seconds"}))
        .foreachBatch(write_batch)
        .start()
    )
