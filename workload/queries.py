"""The registered queries: every operator over the whole of the given tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from functools import partial

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adstream.functions.jsontext import (
    encode_rows,
    parse_events,
    parse_notices,
    quarantined_events,
    quarantined_notices,
)
from adstream.functions.useragent import BROWSER_COLUMNS
from adstream.operators import enrich, users
from adstream.operators.match import assign_window, flatten_matches, match_events
from adstream.operators.validate import split_validity, validate_client_events
from adstream.plans import reports
from adstream.plans.batch import Outcome, run_batch, stage
from adstream.plans.compact import compact_days
from adstream.plans.incremental import REPORTS, backfill_new_users, read_report, refresh_report
from adstream.schemas import CLIENT_EVENT, TABLES, create_tables
from adstream.session import scratch_path, session_conf
from adstream.sources.dimensions import read_dimensions, read_table
from adstream.sources.events import read_message_stream
from adstream.sources.notices import batch_file_paths, completion_notices
from adstream.streaming.arrivals import accepted_stream, read_arrivals, start_arrivals
from adstream.streaming.ingest import start_notice_ingest
from adstream.streaming.pipeline import start_stream
from adstream.streaming.sinks import (
    PACKED_TEXT,
    PARTITIONS,
    Sinks,
    append_web_users,
    feed_messages,
    read_accounts,
)
from workload import inputs

Query = Callable[[SparkSession, str], DataFrame]

ORDER_BY = ("ctimestamp", "event_id", "latency")
EVENT = ("event_id", "win", *CLIENT_EVENT.names)
VERDICT = ("validity_status", "invalid_field")


def _client(spark: SparkSession, sf: str) -> DataFrame:
    return inputs.client_events(inputs.event_core(spark, sf))


def _matched_of(core: DataFrame) -> DataFrame:
    client = assign_window(inputs.client_events(core))
    server = assign_window(inputs.server_events(core))
    return match_events(client, server, ("window",), ORDER_BY)


def _matched_batch_of(core: DataFrame) -> DataFrame:
    return match_events(inputs.client_events(core), inputs.server_events(core), (), ORDER_BY)


def _matched(spark: SparkSession, sf: str) -> DataFrame:
    return _matched_of(inputs.event_core(spark, sf))


def _matched_batch(spark: SparkSession, sf: str) -> DataFrame:
    return _matched_batch_of(inputs.event_core(spark, sf))


def _validated(spark: SparkSession, sf: str, numeric_check: bool = False) -> DataFrame:
    return validate_client_events(_matched(spark, sf), numeric_check)


def _valid(spark: SparkSession, sf: str) -> DataFrame:
    return split_validity(_validated(spark, sf))[0]


def _outcome(spark: SparkSession, sf: str, staging: str | None = None) -> Outcome:
    core = inputs.event_core(spark, sf)
    client = assign_window(inputs.client_events(core))
    server = assign_window(inputs.server_events(core))
    dims = inputs.dimensions(spark, sf)
    return run_batch(client, server, dims, order_by=ORDER_BY, staging=staging)


def _impressions(spark: SparkSession, sf: str) -> DataFrame:
    return _outcome(spark, sf).impressions


def _damaged(spark: SparkSession, sf: str) -> DataFrame:
    raw = inputs.client_raw(inputs.event_core(spark, sf))
    return inputs.damaged(raw.select("event_id", "value"))


def parse(spark: SparkSession, sf: str) -> DataFrame:
    events = parse_events(_damaged(spark, sf), "client")
    return events.select("event_id", *CLIENT_EVENT.names)


def bad_notices(spark: SparkSession, sf: str) -> DataFrame:
    """Notices cut short, empty and no JSON, beside whole ones."""
    notices = inputs.notices(spark, sf)
    texts = F.array(
        F.to_json(F.struct("bucket", "folder_path")),
        F.lit("{}"),
        F.lit("no notice"),
        F.to_json(F.struct(*notices.columns)),
    )
    return quarantined_notices(notices.select(F.explode(texts).alias("value")))


def encode(spark: SparkSession, sf: str) -> DataFrame:
    events = _client(spark, sf).select("event_id", *CLIENT_EVENT.names)
    return encode_rows(events, "event_id")


def file_paths(spark: SparkSession, sf: str) -> DataFrame:
    paths = batch_file_paths(inputs.notices(spark, sf))
    return paths.select("bucket", "folder_path", "client_path", "server_path")


def decode_notices(spark: SparkSession, sf: str) -> DataFrame:
    notices = inputs.notices(spark, sf)
    return parse_notices(notices.select(F.to_json(F.struct(*notices.columns)).alias("value")))


def event_feed(spark: SparkSession, sf: str) -> DataFrame:
    internal = ("event_id", "win", "ep", "publish_ts", "window")
    outcome = _outcome(spark, sf, scratch_path(spark, "event_feed"))
    return feed_messages(outcome, internal).select("feed", "value")


def window_assign(spark: SparkSession, sf: str) -> DataFrame:
    return assign_window(_client(spark, sf)).select(
        "event_id",
        "ep",
        F.unix_timestamp("window.start").alias("window_start"),
        F.unix_timestamp("window.end").alias("window_end"),
    )


def flatten(spark: SparkSession, sf: str) -> DataFrame:
    core = inputs.event_core(spark, sf)
    batch, stream = _matched_batch_of(core), _matched_of(core)
    return flatten_matches(batch.select(*EVENT), stream.select(*EVENT))


def ad_position(spark: SparkSession, sf: str) -> DataFrame:
    found = enrich.enrich_ad_position(_valid(spark, sf), inputs.ad_position(spark))
    return found.select("event_id", "ad_position", "Location", "Size")


def advertiser(spark: SparkSession, sf: str) -> DataFrame:
    found = enrich.enrich_advertiser(_valid(spark, sf), inputs.advertiser(spark, sf))
    return found.select("event_id", "ad_id", "advertiser", "exchange", "campaign_id")


def page(spark: SparkSession, sf: str) -> DataFrame:
    found = enrich.enrich_page(_valid(spark, sf), inputs.page(spark))
    return found.select("event_id", "publisher_id", "page_id", "publisher", "article")


def user_agent_dim(spark: SparkSession, sf: str) -> DataFrame:
    return enrich.build_user_agent_dim(_client(spark, sf))


def browser(spark: SparkSession, sf: str) -> DataFrame:
    found = enrich.enrich_browser(_valid(spark, sf))
    return found.select("event_id", "user_agent", *BROWSER_COLUMNS)


def browser_lookup(spark: SparkSession, sf: str) -> DataFrame:
    """Agents parsed once each, then looked up, as the jobs do."""
    valid = stage(spark, _valid(spark, sf), scratch_path(spark, "browser_lookup"))
    found = enrich.enrich_browser(valid, enrich.build_user_agent_dim(valid))
    return found.select("event_id", "user_agent", *BROWSER_COLUMNS)


def backfill(spark: SparkSession, sf: str, limit: int | None = None) -> DataFrame:
    return users.backfill_web_users(_impressions(spark, sf), inputs.web_users(spark, sf), limit)


def users_after_backfill(spark: SparkSession, sf: str) -> DataFrame:
    """The stored user table after two runs of the backfill."""
    root = scratch_path(spark, "web_users")
    inputs.web_users(spark, sf).write.parquet(f"{root}/WebUsers")
    for _ in range(2):
        found = users.backfill_web_users(
            _impressions(spark, sf), read_table(spark, root, "WebUsers")
        )
        append_web_users(found, f"{root}/WebUsers")
    return read_table(spark, root, "WebUsers")


def batch_folders(spark: SparkSession, sf: str) -> DataFrame:
    """Matching within hour folders, where client time and then fields decide who is first."""
    core = inputs.event_core(spark, sf)
    folder = F.date_format(F.timestamp_seconds("ep"), "yyyyMMdd/HH").alias("folder_path")
    client = inputs.client_events(core).select(folder, *CLIENT_EVENT.names, "event_id")
    server = inputs.server_events(core).select(folder, *inputs.KEY_FIELDS)
    matched = match_events(client, server, ("folder_path",))
    return matched.select("event_id", *CLIENT_EVENT.names)


# The stream is replayed in so many slices of time, of which one arrives late.
REPLAY_SLICES, LATE_SLICE, LATE_BY = 6, 1, 3


def _turns(
    events: DataFrame, raw: Callable[[DataFrame], DataFrame], delay_s: int, files: int
) -> Iterator[DataFrame]:
    """The messages ``raw`` makes, in turns of arrival; the last turn's one closes all windows.

    Rows of ``events`` are dealt out, not the messages made of them, which are many times as large.
    """
    span = raw(inputs.core_of(events)).agg(F.min("ep").alias("first"), F.max("ep").alias("last"))
    first, last = (F.lit(second).cast("long") for second in span.first())
    slice_ = F.floor((F.expr(inputs.SECOND) - first) / ((last - first + 1) / REPLAY_SLICES)).cast("int")
    late = F.when(slice_ == LATE_SLICE, LATE_SLICE + LATE_BY + 0.5).otherwise(slice_)
    for turn in sorted([*range(REPLAY_SLICES), LATE_SLICE + LATE_BY + 0.5]):
        yield raw(inputs.core_of(events.where(late == turn).repartition(files))).select("publish_ts", "value")
    closing = F.timestamp_seconds(last + delay_s + 60).alias("publish_ts")
    yield events.sparkSession.range(1).select(closing, F.lit("{}").alias("value"))


def stream_pipeline(spark: SparkSession, sf: str) -> DataFrame:
    """Replay both sides as streams, a slice a micro-batch and one of them late; read the table."""
    root = scratch_path(spark, "stream_pipeline")
    events = inputs.table(spark, sf, "events")
    raw = {"client": inputs.client_raw, "server": inputs.server_raw}
    days = 60
    streams = {}
    for side, messages in raw.items():
        path = f"{root}/in/{side}"
        # A file from each core a turn: the source takes files by the time they appeared.
        files = spark.sparkContext.defaultParallelism
        for part in _turns(events, messages, days * 86400, files):
            part.write.mode("append").options(**PACKED_TEXT).json(path)
        streams[side] = read_message_stream(spark, "json", path, maxFilesPerTrigger=str(files))
    query = start_stream(
        spark,
        streams["client"],
        streams["server"],
        inputs.dimensions(spark, sf),
        Sinks(f"{root}/out"),
        f"{root}/checkpoint",
        delay=f"{days} days",
        trigger={"availableNow": True},
    )
    query.awaitTermination()
    return read_table(spark, f"{root}/out", "Ad_impressions")


def _hourly(spark: SparkSession, sf: str, root: str) -> DataFrame:
    """Lay events out as hourly folders; the notices that announce them."""
    arrived = F.timestamp_seconds("ep")
    second = F.timestamp_seconds(F.expr(inputs.SECOND))
    # Many small files: their number, not their bytes, is what the tasks share. Events are dealt
    # out, not the lines made of them, which are many times as large.
    tasks = 4 * spark.sparkContext.defaultParallelism
    events = inputs.table(spark, sf, "events").repartition(tasks, F.date_trunc("hour", second))
    core = inputs.core_of(events)
    sides = (
        (inputs.client_raw(core), "client_events.json"),
        (inputs.server_raw(core), "server_events.json"),
    )
    lines = [
        raw.select(
            "value",
            F.date_format(arrived, "yyyyMMdd").alias("day"),
            F.date_format(arrived, "HH").alias("hour"),
            F.lit(name).alias("file"),
        )
        for raw, name in sides
    ]
    folders = ["day", "hour", "file"]
    (
        lines[0]
        .unionByName(lines[1])
        .write.partitionBy(*folders)
        .options(**PACKED_TEXT)
        .text(f"{root}/hourly")
    )
    # Spark lays folders out as name=value; the notices say so.
    notices = inputs.notices(spark, sf, f"{root}/hourly").withColumns(
        {
            "folder_path": F.regexp_replace("folder_path", "^(.*)/(.*)$", "day=$1/hour=$2"),
            "client_events_file": F.lit("file=client_events.json"),
            "server_events_file": F.lit("file=server_events.json"),
        }
    )
    now = F.current_timestamp().alias("publish_ts")
    message = F.to_json(F.struct(*notices.columns)).alias("value")
    # Every other hour goes to the second of two runs.
    return notices.select(now, message, (F.crc32("folder_path") % 2).alias("run"))


_SHARED: dict[tuple[str, str, str], str] = {}


def _shared(spark: SparkSession, sf: str, name: str, table: str, make: Callable[[str], None]) -> str:
    """The root of what several queries of one session read; made once, unless it is gone."""
    key = (spark.sparkContext.applicationId, sf, name)
    if key in _SHARED:
        try:
            spark.read.format("binaryFile").load(f"{_SHARED[key]}/{table}")
        except AnalysisException:
            del _SHARED[key]
    if key not in _SHARED:
        root = scratch_path(spark, name)
        make(root)
        _SHARED[key] = root
    return _SHARED[key]


def _announced(spark: SparkSession, sf: str) -> tuple[str, DataFrame]:
    """The root of the hourly folders and their notices, as :func:`_hourly` lays them out."""

    def make(root: str) -> None:
        _hourly(spark, sf, root).write.parquet(f"{root}/announced")

    root = _shared(spark, sf, "hourly", "announced", make)
    return root, spark.read.parquet(f"{root}/announced")


def _ingest(spark: SparkSession, sf: str, root: str, runs: int = 1) -> None:
    """Announce all hourly folders to one or two ingest jobs on one root."""
    notices = _announced(spark, sf)[1]
    for run in range(runs):
        own = notices.where(F.col("run") == run) if runs > 1 else notices
        own.select("publish_ts", "value").write.json(f"{root}/notices/{run}")
        query = start_notice_ingest(
            spark,
            read_message_stream(spark, "json", f"{root}/notices/{run}"),
            inputs.dimensions(spark, sf),
            Sinks(f"{root}/out"),
            f"{root}/checkpoint/{run}",
            trigger={"availableNow": True},
        )
        query.awaitTermination()


def _ingested(spark: SparkSession, sf: str) -> str:
    """The root of one ingest of all folders, which the queries over its outputs share."""
    return _shared(spark, sf, "ingested", "out/cleanup", lambda root: _ingest(spark, sf, root))


def notice_ingest(spark: SparkSession, sf: str) -> DataFrame:
    """Ingest announced hourly folders; read the table."""
    return read_table(spark, f"{_ingested(spark, sf)}/out", "Ad_impressions")


def ingest_two_runs(spark: SparkSession, sf: str) -> DataFrame:
    """The same from two checkpoints, each with half the folders, into one table."""
    root = scratch_path(spark, "two_runs")
    _ingest(spark, sf, root, 2)
    return read_table(spark, f"{root}/out", "Ad_impressions")


# Notices of one window come in so many micro-batches, each of a job started anew.
NOTICE_TURNS = 3


def match_notice_window(spark: SparkSession, sf: str) -> DataFrame:
    """Ingest of folders announced in one window, over several micro-batches; it is the match's scope.

    After the window has closed, a folder is announced again: that notice is late and is kept apart.
    """
    root = scratch_path(spark, "notice_window")
    sinks = Sinks(f"{root}/out")
    notices = _announced(spark, sf)[1]
    turn = F.pmod(F.crc32("value"), F.lit(NOTICE_TURNS)).alias("turn")
    arrived = (F.lit("2024-03-01 00:00:05").cast("timestamp")).alias("publish_ts")
    late = notices.orderBy("value").limit(1).select(arrived, "value", F.lit(NOTICE_TURNS + 1).alias("turn"))
    closing = F.lit("2024-03-01 01:00:00").cast("timestamp").alias("publish_ts")
    end = spark.range(1).select(closing, F.lit("{}").alias("value"), F.lit(NOTICE_TURNS).alias("turn"))
    rows = notices.select(arrived, "value", turn).unionByName(end).unionByName(late)
    rows = stage(spark, rows, f"{root}/turns")
    now = {"availableNow": True}
    for turn in range(NOTICE_TURNS + 2):
        own = rows.where(F.col("turn") == turn).select("publish_ts", "value")
        own.write.mode("append").json(f"{root}/notices")
        arriving = {"notice": read_message_stream(spark, "json", f"{root}/notices")}
        start_arrivals(spark, arriving, sinks, f"{root}/arrivals", trigger=now).awaitTermination()
        start_notice_ingest(
            spark,
            accepted_stream(spark, sinks, "notice"),
            inputs.dimensions(spark, sf),
            sinks,
            f"{root}/checkpoint",
            trigger=now,
            scope=("window",),
        ).awaitTermination()
    return read_table(spark, f"{root}/out", "Ad_impressions")


# Slices of time of both sides in the order in which they arrive, and how late rows may be.
ARRIVAL_ORDER, ARRIVAL_DELAY_DAYS = (0, 2, 1, 3), 12


def late_rows_kept(spark: SparkSession, sf: str) -> DataFrame:
    """Every message of both sides, told by whether it came too late; a slice of time comes late."""
    root = scratch_path(spark, "late_rows")
    sinks = Sinks(f"{root}/out")
    core = inputs.event_core(spark, sf)
    span = core.agg(F.min("ep").alias("first"), F.max("ep").alias("last"))
    width = (F.col("last") - F.col("first") + 1) / len(ARRIVAL_ORDER)
    slice_ = F.floor((F.col("ep") - F.col("first")) / width).cast("int").alias("slice")
    raw = {"client": inputs.client_raw(core), "server": inputs.server_raw(core)}
    staged = {
        side: stage(
            spark, rows.join(F.broadcast(span)).select("publish_ts", "value", slice_), f"{root}/raw/{side}"
        )
        for side, rows in raw.items()
    }
    for turn in ARRIVAL_ORDER:
        for side, rows in staged.items():
            own = rows.where(F.col("slice") == turn).select("publish_ts", "value")
            own.write.mode("append").json(f"{root}/in/{side}")
        arriving = {side: read_message_stream(spark, "json", f"{root}/in/{side}") for side in raw}
        start_arrivals(
            spark,
            arriving,
            sinks,
            f"{root}/checkpoint",
            delay=f"{ARRIVAL_DELAY_DAYS} days",
            trigger={"availableNow": True},
        ).awaitTermination()
    stored = read_arrivals(spark, sinks)
    user = F.get_json_object("value", "$.user_id").alias("user_id")
    return stored.select("side", F.unix_timestamp("publish_ts").alias("ep"), user, "late")


def stored_invalid(spark: SparkSession, sf: str) -> DataFrame:
    root = _ingested(spark, sf)
    return read_table(spark, f"{root}/out", "Ad_impressions_Invalid")


def stored_feed(spark: SparkSession, sf: str) -> DataFrame:
    """The JSON feed files that the ingest job wrote."""
    root = _ingested(spark, sf)
    return spark.read.text(f"{root}/out/feed").select("feed", "value")


def cleanup_feed(spark: SparkSession, sf: str) -> DataFrame:
    """Completion messages, without the scratch folder in front."""
    root = _ingested(spark, sf)
    text = F.replace("value", F.lit(f"{_announced(spark, sf)[0]}/hourly"), F.lit(""))
    return spark.read.text(f"{root}/out/cleanup").select(text.alias("value"))


def batch_accounts(spark: SparkSession, sf: str) -> DataFrame:
    """What the ingest counted of all rows it read, matched, stored and rejected."""
    accounts = read_accounts(spark, Sinks(f"{_ingested(spark, sf)}/out"))
    return accounts.groupBy("measure").agg(F.sum("n").alias("n"))


def report_of_days(spark: SparkSession, sf: str) -> DataFrame:
    """Traffic by placement over the first two days of the stored table."""
    root = _ingested(spark, sf)
    first = F.min(F.col("ts").cast("date"))
    days = inputs.table(spark, sf, "events").agg(
        F.date_format(first, "yyyyMMdd").alias("a"), F.date_format(first + 1, "yyyyMMdd").alias("b")
    )
    since, until = days.first()
    stored = read_table(spark, f"{root}/out", "Ad_impressions", since, until)
    return reports.report_by_placement(stored)


def _grown(spark: SparkSession, sf: str, name: str, root: str, *jobs) -> None:
    """Copy a table of the shared ingest in steps: all days but the last, without some rows of the
    first day; those rows, in as many steps as there are jobs left; the last day. A job runs after
    each step."""
    stored = spark.read.parquet(f"{_ingested(spark, sf)}/out/{name}")
    first, last = stored.agg(F.min("day"), F.max("day")).first()
    # The only day of a table comes whole, as the last.
    late = (F.col("day") == first) & (F.col("day") < last) & (F.crc32("user_id") % 4 == 0)
    turns = len(jobs) - 2
    turn = F.shiftright(F.crc32("user_id"), 2) % turns
    later = [stored.where(late & (turn == n)).withColumn("run", F.lit(f"later{n}")) for n in range(turns)]
    steps = (stored.where(~late & (F.col("day") < last)), *later, stored.where(F.col("day") == last))
    for rows, job in zip(steps, jobs, strict=True):
        rows.write.mode("append").partitionBy(*PARTITIONS).parquet(f"{root}/{name}")
        job(str(last))


def impressions_after_compaction(spark: SparkSession, sf: str) -> DataFrame:
    """The stored table where days have been compacted, one of them twice, and rows came after.

    Of those, some came to the day compacted twice and are read beside its copy, the others are the
    last day, which is still open.
    """
    root = scratch_path(spark, "compaction")

    def compact(last: str) -> None:
        compact_days(spark, root, "Ad_impressions", last)

    def between(last: str) -> None:
        """Rows that come between compactions are read without one."""

    _grown(spark, sf, "Ad_impressions", root, compact, compact, between, between)
    return read_table(spark, root, "Ad_impressions")


def backfill_incremental(spark: SparkSession, sf: str) -> DataFrame:
    """The user table after runs of the backfill that each read the folders new to them."""
    root = scratch_path(spark, "backfill")
    inputs.web_users(spark, sf).write.parquet(f"{root}/WebUsers")

    def run(last: str) -> None:
        backfill_new_users(spark, root)

    _grown(spark, sf, "Ad_impressions", root, run, run, run)
    return read_table(spark, root, "WebUsers")


def _incremental_report(spark: SparkSession, sf: str, report: str) -> DataFrame:
    """A report from the counts of days, refreshed as the table grows."""
    root = scratch_path(spark, f"report_{report}")

    def run(last: str) -> None:
        refresh_report(spark, root, report)

    _grown(spark, sf, REPORTS[report][0], root, run, run, run)
    return read_report(spark, root, report)


def impressions_from_tables(spark: SparkSession, sf: str) -> DataFrame:
    """The batch job with dimensions read from tables that were defined and filled by SQL."""
    root = scratch_path(spark, "tables")
    database = f"adstream_{uuid.uuid4().hex}"
    create_tables(spark, root, database)
    frames = inputs.dimensions(spark, sf)
    named = {"Ad_position": frames.ad_position, "Advertiser": frames.advertiser, "Page": frames.page}
    for name, rows in named.items():
        whole = rows.withColumn("size", F.lit(None).cast("string")) if name == "Advertiser" else rows
        whole.select(*TABLES[name].names).write.insertInto(f"{database}.{name}")
    core = inputs.event_core(spark, sf)
    client, server = (assign_window(f(core)) for f in (inputs.client_events, inputs.server_events))
    outcome = run_batch(client, server, read_dimensions(spark, root), order_by=ORDER_BY)
    path = f"{database}.Ad_impressions"
    partition = {"day": F.lit("20240101"), "source": F.lit("sql"), "run": F.lit("none")}
    numbers = {"batch_id": F.lit(0).cast("long"), "part": F.lit(0)}
    with session_conf(spark, {"hive.exec.dynamic.partition.mode": "nonstrict"}):
        outcome.impressions.withColumns({**partition, **numbers}).write.insertInto(path)
    return spark.table(path).select(*TABLES["Ad_impressions"].names)


def queries() -> dict[str, Query]:
    return {
        "parse_events": parse,
        "quarantined_events": lambda s, d: quarantined_events(_damaged(s, d), "client"),
        "encode_events": encode,
        "parse_notices": decode_notices,
        "quarantined_notices": bad_notices,
        "batch_file_paths": file_paths,
        "completion_notices": lambda s, d: completion_notices(inputs.notices(s, d)),
        "tumbling_window_assign": window_assign,
        "match_windowed": lambda s, d: _matched(s, d).select(*EVENT),
        "match_batch": lambda s, d: _matched_batch(s, d).select(*EVENT),
        "match_batch_folders": batch_folders,
        "flatten_matches": flatten,
        "validate_as_written": lambda s, d: _validated(s, d).select(*EVENT, *VERDICT),
        "validate_numeric": lambda s, d: _validated(s, d, True).select(*EVENT, *VERDICT),
        "valid_events": lambda s, d: _valid(s, d).select(*EVENT),
        "invalid_events": lambda s, d: split_validity(_validated(s, d))[1].select(
            *EVENT, *VERDICT
        ),
        "enrich_ad_position": ad_position,
        "enrich_advertiser": advertiser,
        "enrich_page": page,
        "user_agent_dim": user_agent_dim,
        "enrich_browser": browser,
        "enrich_browser_lookup": browser_lookup,
        "ad_impressions": _impressions,
        "ad_impressions_invalid": lambda s, d: _outcome(s, d).invalid,
        "event_feed": event_feed,
        "distinct_users": lambda s, d: users.distinct_users(_impressions(s, d)),
        "absent_users": lambda s, d: users.absent_users(
            _impressions(s, d), inputs.web_users(s, d)
        ),
        "backfill_web_users": backfill,
        "backfill_web_users_limited": lambda s, d: backfill(s, d, users.BACKFILL_LIMIT),
        "web_users_after_backfill": users_after_backfill,
        "stream_pipeline": stream_pipeline,
        "notice_ingest": notice_ingest,
        "ingest_two_runs": ingest_two_runs,
        "match_notice_window": match_notice_window,
        "late_rows_kept": late_rows_kept,
        "stored_invalid": stored_invalid,
        "stored_feed": stored_feed,
        "cleanup_feed": cleanup_feed,
        "batch_accounts": batch_accounts,
        "report_of_days": report_of_days,
        "impressions_after_compaction": impressions_after_compaction,
        "impressions_from_tables": impressions_from_tables,
        "backfill_incremental": backfill_incremental,
        **{
            f"report_{name}_incremental": partial(_incremental_report, report=name)
            for name in REPORTS
        },
        "report_by_campaign": lambda s, d: reports.report_by_campaign(_impressions(s, d)),
        "report_by_page": lambda s, d: reports.report_by_page(_impressions(s, d)),
        "report_by_placement": lambda s, d: reports.report_by_placement(_impressions(s, d)),
        "report_latency": lambda s, d: reports.report_latency(_impressions(s, d)),
        "report_invalid": lambda s, d: reports.report_invalid(_outcome(s, d).invalid),
        "report_by_demographics": lambda s, d: reports.report_by_demographics(
            _impressions(s, d), inputs.web_users(s, d)
        ),
    }
