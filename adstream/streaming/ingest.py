"""The job that ingests hourly folders as notices announce them."""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator, Sequence
from itertools import count, islice

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from adstream.functions.jsontext import (
    MALFORMED,
    decode,
    parse_notices,
    quarantined_notices,
    well_formed,
)
from adstream.operators.match import DELAY, WINDOW, match_events, with_arrival_watermark
from adstream.operators.validate import rule_counts
from adstream.plans.batch import process_matched, stage
from adstream.schemas import EVENT_SCHEMAS
from adstream.session import STREAM_CONF, configure, session_conf
from adstream.sources.events import listed_sizes, read_announced_lines
from adstream.sources.notices import batch_file_paths, completion_notices
from adstream.streaming.pipeline import DimensionSource, current
from adstream.streaming.sinks import (
    DEALT_CONF,
    STAGED_CONF,
    Sinks,
    Write,
    outcome_writes,
    run_of,
    run_together,
    several_days,
    together,
    write_accounts,
    write_feed,
    write_rejected,
)

SOURCE = "batch"
# Notices listed at once, and what one scan of their files may hold: the driver names the files of a
# scan to Spark. All are worked through, a slice after the other.
LISTED = 2048
SLICE_FILES = 50_000
SLICE_BYTES = 1 << 40
# Rows of a partition of the match before AQE joins small ones, so that none has to spill.
MATCHED_ROWS = 250_000
_INITIAL = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
SCOPE = ("folder_path",)
_SAID = ("bucket", "folder_path", "client_events_file", "server_events_file", "arrived")
_LINE = "folder_path string, arrived timestamp, day string, hour string"
_SIDES = ("client", "server")


def _read_counts() -> list[Column]:
    """What is counted where lines are decoded."""
    columns = []
    for side in _SIDES:
        own = F.col("side") == side
        columns.append(F.count_if(own).alias(f"{side}_read"))
        columns.append(F.count_if(own & F.col(MALFORMED)).alias(f"{side}_malformed"))
    return columns


def _announced(notices: DataFrame) -> Iterator[Row]:
    """Distinct notices in a fixed order, so that a replay meets the same slices.

    Of a notice that came twice the first arrival counts.
    """
    arrived = F.col("publish_ts") if "publish_ts" in notices.columns else F.lit(None)
    return (
        batch_file_paths(notices.withColumn("arrived", arrived.cast("timestamp")))
        .groupBy(*_SAID[:-1], "client_path", "server_path")
        .agg(F.min("arrived").alias("arrived"))
        .withColumn("said_day", F.nullif(F.regexp_extract("folder_path", "([0-9]{8})", 1), F.lit("")))
        .withColumn("day", F.coalesce("said_day", F.date_format("arrived", "yyyyMMdd"), F.lit("none")))
        .withColumn(
            "hour",
            F.nullif(F.regexp_extract("folder_path", "[0-9]{8}/(?:hour=)?([0-9]{2})$", 1), F.lit("")),
        )
        .orderBy("client_path", "server_path")
        .toLocalIterator()
    )


def _sizes(spark: SparkSession, paths: Sequence[str]) -> dict[str, tuple[int, int]]:
    """Files and bytes below each path that exists; missing ones are found by halving."""
    try:
        listed = {row.path: (row.files, row.bytes) for row in listed_sizes(spark, paths).collect()}
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        if len(paths) == 1:
            return {}
        half = len(paths) // 2
        return _sizes(spark, paths[:half]) | _sizes(spark, paths[half:])
    return {path: listed.get(path, (0, 0)) for path in paths}


def _slices(
    notices: Sequence[Row], sizes: dict[str, tuple[int, int]], most_files: int, most_bytes: int
) -> Iterator[list[Row]]:
    """Notices in turn, in slices of bounded files and bytes, but at least one notice."""
    held: list[Row] = []
    files = size = 0
    for row in notices:
        own = [sizes[path] for path in (row.client_path, row.server_path)]
        own_files, own_size = (sum(column) for column in zip(*own))
        if held and (files + own_files > most_files or size + own_size > most_bytes):
            yield held
            held, files, size = [], 0, 0
        held.append(row)
        files, size = files + own_files, size + own_size
    if held:
        yield held


def ingest_folders(
    spark: SparkSession,
    notices: DataFrame,
    dims: DimensionSource,
    sinks: Sinks,
    batch_id: int,
    numeric_check: bool = False,
    run: str = "none",
    scope: Sequence[str] = SCOPE,
    listed: int = LISTED,
    slice_files: int = SLICE_FILES,
    slice_bytes: int = SLICE_BYTES,
) -> None:
    """Match, process and store the folders of decoded notices.

    Keys match within ``scope``: the announced folder, or with ``("window",)``
    all folders announced in one window of the notices' arrival, for which they
    need ``publish_ts``. Files are listed in tasks, for ``listed`` notices at a
    time, and decoded into the staged copy in slices of bounded files and bytes;
    one match then covers all of them. A notice whose files are missing is kept
    in the quarantine, without a completion message, and stops no other.
    Completion messages are written last, when all rows they stand for are
    stored. What was read, matched, stored and rejected is counted in the same
    passes (:func:`~adstream.streaming.sinks.read_accounts`).
    """
    configure(spark)
    whole = Write(SOURCE, run, batch_id)
    staged: dict[str, DataFrame] = {}
    accounts: Counter[str] = Counter()
    announced = _announced(notices)
    for part in count():
        some = list(islice(announced, listed))
        if not some:
            break
        sizes = _sizes(spark, sorted({p for row in some for p in (row.client_path, row.server_path)}))
        here, missing = [], []
        for row in some:
            (here if row.client_path in sizes and row.server_path in sizes else missing).append(row)
        if missing:
            text = F.to_json(F.struct(*_SAID[:-1])).alias("value")
            lost = _said(spark, missing).select(text, F.lit("missing").alias("side"), "day")
            write_rejected(lost, sinks, Write(SOURCE, run, batch_id, part))
        for taken in _slices(here, sizes, slice_files, slice_bytes):
            read = Observation()
            decoded = _decoded(spark, taken, scope).observe(read, *_read_counts())
            frames = {"decoded": decoded, "done": _said(spark, taken)}
            # The first slice replaces what an earlier batch or attempt left.
            mode = "append" if staged else "overwrite"
            for name, frame in frames.items():
                frame.write.mode(mode).parquet(sinks.staging(whole, name))
                staged[name] = spark.read.schema(frame.schema).parquet(sinks.staging(whole, name))
            accounts.update(read.get)
    if staged:
        rows = sum(accounts[f"{side}_read"] for side in _SIDES)
        sized = {**STAGED_CONF, _INITIAL: str(_partitions(spark, rows))}
        with session_conf(spark, sized):
            accounts.update(_store(spark, staged["decoded"], dims, sinks, whole, numeric_check, scope))
        write_accounts(spark, accounts, sinks, whole)
        messages = completion_notices(staged["done"], "day").withColumn("feed", F.lit("cleanup"))
        write_feed(messages, sinks, "cleanup", sinks.cleanup_topic, whole)


def _partitions(spark: SparkSession, rows: int) -> int:
    """Partitions that so many rows are matched in, at least those of the session."""
    own = spark.conf.get(_INITIAL, None) or spark.conf.get("spark.sql.shuffle.partitions")
    return max(int(own), math.ceil(rows / MATCHED_ROWS))


def _said(spark: SparkSession, announced: Sequence[Row]) -> DataFrame:
    rows = [(*(row[n] for n in _SAID[:-1]), row.day) for row in announced]
    return spark.createDataFrame(rows, f"{', '.join(f'{n} string' for n in _SAID[:-1])}, day string")


def _decoded(spark: SparkSession, announced: Sequence[Row], scope: Sequence[str]) -> DataFrame:
    """The rows of both sides, each decoded once."""
    sides = []
    for side in _SIDES:
        paths = {
            row[f"{side}_path"]: (f"{row.bucket}/{row.folder_path}", row.arrived, row.day, row.hour)
            for row in announced
        }
        lines = read_announced_lines(spark, paths, _LINE)
        if "window" in scope:
            lines = lines.withColumn("window", F.window("arrived", WINDOW))
        decoded = decode(lines.drop("arrived"), EVENT_SCHEMAS[side])
        # Only malformed lines are wanted as they came.
        decoded = decoded.withColumn("value", F.when(F.col(MALFORMED), F.col("value")))
        sides.append(decoded.withColumn("side", F.lit(side)))
    return sides[0].unionByName(sides[1], allowMissingColumns=True)


def _store(
    spark: SparkSession,
    decoded: DataFrame,
    dims: DimensionSource,
    sinks: Sinks,
    write: Write,
    numeric_check: bool,
    scope: Sequence[str],
) -> Counter[str]:
    """Match the staged rows of both sides, process and write them; what became of them."""
    places = ("folder_path", "day", "hour", *(("window",) if "window" in scope else ()))
    events = [
        well_formed(decoded.where(F.col("side") == side)).select(*EVENT_SCHEMAS[side].names, *places)
        for side in _SIDES
    ]
    counted, stored, invalid = Observation(), Observation(), Observation()
    matched = match_events(*events, scope, counted=counted)
    # Staged once, with the rows of a day together where there are several.
    if several_days(decoded):
        matched = together(matched)
    with session_conf(spark, DEALT_CONF):
        matched = stage(spark, matched, sinks.staging(write))
    agents = sinks.staging(write, "agents")
    outcome = process_matched(matched, current(dims), numeric_check, keep=("day",), agents=agents)
    # Counted in the passes that write them.
    outcome = outcome._replace(
        impressions=outcome.impressions.observe(stored, F.count(F.lit(1)).alias("stored")),
        invalid=outcome.invalid.observe(invalid, F.count(F.lit(1)).alias("invalid"), *rule_counts()),
    )
    bad = decoded.where(MALFORMED).select("folder_path", "day", "hour", "value", "side")

    def quarantine() -> None:
        write_rejected(bad, sinks, write)

    internal = ("folder_path", "window", "day", "hour")
    run_together(spark, *outcome_writes(outcome, sinks, write, internal), quarantine)
    found: Counter[str] = Counter()
    for observed in (counted, stored, invalid):
        found.update({name: n or 0 for name, n in observed.get.items()})
    return found


def held_windows(messages: DataFrame, delay: str = DELAY) -> DataFrame:
    """Messages handed on when the window of their arrival has closed, all of a window together.

    A stateful aggregation holds the distinct messages of each open window, whatever micro-batches
    bring them, and lets them go when arrival has passed the window by ``delay``. Of equal messages
    of one window the first counts. Later ones Spark drops: keep them with
    :mod:`adstream.streaming.arrivals` in front.
    """
    window = F.window("publish_ts", WINDOW)
    held = with_arrival_watermark(messages, delay=delay).groupBy(window, "value")
    return held.agg(F.min("publish_ts").alias("publish_ts")).select("publish_ts", "value")


def start_notice_ingest(
    spark: SparkSession,
    messages: DataFrame,
    dims: DimensionSource,
    sinks: Sinks,
    checkpoint: str,
    numeric_check: bool = False,
    trigger: dict | None = None,
    scope: Sequence[str] = SCOPE,
    delay: str = DELAY,
    **sizes: int,
) -> StreamingQuery:
    """Start the ingest of announced folders, one batch job per micro-batch.

    It is a query of its own: it has its own trigger, and a folder that fails
    does not stop the event streams. Notices that do not decode or name no files
    are kept in the quarantine. With the scope ``("window",)`` notices wait until
    their window has closed (:func:`held_windows`), so all folders of a window
    are matched together. ``sizes`` are those of :func:`ingest_folders`.
    """
    configure(spark)

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        run = run_of(spark)
        write = Write(f"{SOURCE}_notices", run, batch_id)
        # A micro-batch of held windows is read several times, and its state only once.
        batch = stage(spark, batch, sinks.staging(write, "notices"))
        if batch.isEmpty():
            return
        bad = quarantined_notices(batch)
        day = F.coalesce(F.date_format("publish_ts", "yyyyMMdd"), F.lit("none")).alias("day")
        write_rejected(bad.select("publish_ts", "value", "side", day), sinks, write)
        notices = parse_notices(batch)
        ingest_folders(spark, notices, dims, sinks, batch_id, numeric_check, run, scope, **sizes)

    if "window" in scope:
        messages = held_windows(messages, delay)
    with session_conf(spark, STREAM_CONF):
        return (
            messages.writeStream.queryName("folder_notices")
            .outputMode("append")
            .option("checkpointLocation", checkpoint)
            .trigger(**(trigger or {"processingTime": "30 seconds"}))
            .foreachBatch(write_batch)
            .start()
        )
