"""Replay-safe writes of one micro-batch to tables and feeds."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from adstream.functions.jsontext import encode_rows
from adstream.plans.batch import Outcome, stage
from adstream.schemas import WEB_USERS
from adstream.session import session_conf

# Every run writes to partitions of its own: a run is one checkpoint of one job, known by
# the id that the checkpoint gives its query, which restarts keep.
RUN = ("source", "run", "batch_id", "part")
PARTITIONS = ("day", *RUN)
# Spark's readers unpack it by the ending of the file names.
PACKED_TEXT = {"compression": "gzip", "zlib.compress.level": "BEST_SPEED"}


@dataclass(frozen=True)
class Write:
    """What one batch of a run, or one part of it, is known by."""

    source: str
    run: str
    batch_id: int
    part: int = 0


def run_of(spark: SparkSession) -> str:
    """The durable id of the streaming query whose micro-batch is running."""
    return spark.sparkContext.getLocalProperty("sql.streaming.queryId") or "none"


@dataclass(frozen=True)
class Sinks:
    """Where a job writes. Tables and file feeds live in folders below ``root``.

    With ``kafka`` options (``kafka.bootstrap.servers`` and so on) the feeds go
    to the topics named here instead of to files.
    """

    root: str
    kafka: Mapping[str, str] = field(default_factory=dict)
    feed_topic: str = "enriched_events"
    cleanup_topic: str = "cleanup"

    def path(self, name: str) -> str:
        return f"{self.root.rstrip('/')}/{name}"

    def staging(self, write: Write, name: str = "matched") -> str:
        return self.path(f"_staging/{write.source}/{write.run}/{name}")


def _mark(df: DataFrame, write: Write) -> DataFrame:
    return df.withColumns(
        {
            "source": F.lit(write.source),
            "run": F.lit(write.run),
            "batch_id": F.lit(write.batch_id).cast("bigint"),
            "part": F.lit(write.part),
        }
    )


def write_partitions(
    df: DataFrame,
    path: str,
    write: Write,
    partitions: tuple[str, ...],
    fmt: str = "parquet",
    mixed: bool = False,
) -> None:
    """Write one batch so that a replay of it replaces its first attempt.

    Rows are written from the tasks that hold them. Only ``mixed`` ones, where
    most tasks hold rows of several partitions, are rebalanced first: AQE then
    joins small partitions and splits a day that holds most of the rows.
    """
    rows = _mark(df, write)
    if mixed:
        rows = rows.hint("rebalance", *[F.col(p) for p in partitions])
    # Texts are many times the size of the rows they tell; parquet is compressed by itself.
    packed = PACKED_TEXT if fmt == "text" else {}
    (
        rows.write.mode("overwrite")
        .options(partitionOverwriteMode="dynamic", **packed)
        .partitionBy(*partitions)
        .format(fmt)
        .save(path)
    )


def write_feed(messages: DataFrame, sinks: Sinks, folder: str, topic: str, write: Write) -> None:
    """Append JSON messages (``value``, ``feed``, ``day``) to a topic or to a file feed (gzip).

    A topic keeps what a batch that died had sent before it is replayed: its records have keys by
    which :func:`sent_once` tells them from the replayed ones.
    """
    if sinks.kafka:
        records = topic_records(messages, write)
        records.write.format("kafka").options(**sinks.kafka).option("topic", topic).save()
        return
    rows = messages.select("value", "feed", "day")
    write_partitions(rows, sinks.path(folder), write, ("feed", *PARTITIONS), "text")


def row_mark(columns: Sequence[str]) -> Column:
    """128 bits that tell a row from all others of a batch, the same whenever it is computed."""
    halves = [F.xxhash64(F.lit(half), *[F.col(f"`{c}`") for c in columns]) for half in (0, 1)]
    return F.concat(*[F.lpad(F.lower(F.hex(half)), 16, "0") for half in halves])


def topic_records(messages: DataFrame, write: Write) -> DataFrame:
    """Messages as records of a topic: ``key``, ``value`` and ``headers``.

    The key names run, batch, part, feed and row, so it is equal for the copies of a message that a
    replay sends, and for no others. Rows are told by ``row_mark`` where they have it, as equal
    texts may stand for several rows, and else by their text.
    """
    place = f"{write.source}/{write.run}/{write.batch_id}/{write.part}"
    row = F.col("row_mark") if "row_mark" in messages.columns else row_mark(["value"])
    header = lambda name, value: F.struct(
        F.lit(name).alias("key"), value.cast("string").cast("binary").alias("value")
    )
    return messages.select(
        F.concat_ws("/", F.lit(place), "feed", row).cast("binary").alias("key"),
        F.col("value").cast("binary").alias("value"),
        F.array(
            header("run", F.lit(write.run)),
            header("batch_id", F.lit(write.batch_id)),
            header("part", F.lit(write.part)),
            header("feed", F.col("feed")),
        ).alias("headers"),
    )


def sent_once(records: DataFrame, time_column: str = "timestamp", within: str = "1 day") -> DataFrame:
    """Records of a feed's topic without the copies that replays sent; batch or stream.

    On a stream a key is remembered for ``within`` of the records' time, which has to exceed the
    time until a batch that died is replayed.
    """
    if not records.isStreaming:
        return records.dropDuplicates(["key"])
    return records.withWatermark(time_column, within).dropDuplicatesWithinWatermark(["key"])


def write_rejected(rows: DataFrame, sinks: Sinks, write: Write) -> None:
    """Keep rows that do not decode, by ``side`` and ``day``."""
    write_partitions(rows, sinks.path("quarantine"), write, ("side", *PARTITIONS))


ACCOUNTS = "measure string, n long"


def write_accounts(spark: SparkSession, counts: Mapping[str, int], sinks: Sinks, write: Write) -> None:
    """Keep what was counted of one batch; a replay replaces it."""
    rows = spark.createDataFrame(sorted(counts.items()), ACCOUNTS).coalesce(1)
    write_partitions(rows, sinks.path("accounts"), write, RUN)


def read_accounts(spark: SparkSession, sinks: Sinks) -> DataFrame:
    """``measure`` and ``n`` over all batches, and by ``source``, ``run``, ``batch_id`` and ``part``.

    Beacons read are malformed, unmatched, merged into another one, or matched; those matched are
    stored or invalid; those invalid are told by field.
    """
    return spark.read.parquet(sinks.path("accounts"))


def feed_messages(
    outcome: Outcome, drop: tuple[str, ...] = (), keep: tuple[str, ...] = (), marked: bool = False
) -> DataFrame:
    """Every validated row and every enriched row as JSON, told apart by ``feed``.

    ``drop`` names columns left out of the JSON, ``keep`` those put beside it. ``marked`` adds a
    ``row_mark`` of all columns, those left out as well.
    """
    drop = tuple(c for c in drop if c not in keep)
    beside = (*keep, "row_mark") if marked else keep

    def encoded(rows: DataFrame, feed: str) -> DataFrame:
        if marked:
            rows = rows.withColumn("row_mark", row_mark(rows.columns))
        return encode_rows(rows.drop(*drop), *beside).withColumn("feed", F.lit(feed))

    return encoded(outcome.validated, "validated").unionByName(
        encoded(outcome.enriched, "enriched")
    )


def run_together(spark: SparkSession, *writes: Callable[[], None]) -> None:
    """Run independent writes as concurrent Spark jobs; fail if any of them does.

    The last tasks of one then leave no executors idle. The threads take over
    the job group of the query, so stopping it stops them.
    """
    with ThreadPoolExecutor(len(writes)) as pool:
        running = [pool.submit(inheritable_thread_target(spark)(write)) for write in writes]
    for write in running:
        write.result()


def outcome_writes(
    outcome: Outcome, sinks: Sinks, write: Write, internal: tuple[str, ...]
) -> list[Callable[[], None]]:
    """The writes of both tables and the feed of one batch.

    ``internal`` names columns the feed leaves out. The table frames carry
    ``day``, the arrival day they are partitioned by: client clocks are free
    text, so a day taken from them could be any number of partitions.
    """

    def impressions() -> None:
        path = sinks.path("Ad_impressions")
        write_partitions(outcome.impressions, path, write, PARTITIONS)

    def invalid() -> None:
        path = sinks.path("Ad_impressions_Invalid")
        write_partitions(outcome.invalid, path, write, PARTITIONS)

    def feed() -> None:
        messages = feed_messages(outcome, internal, ("day",), marked=bool(sinks.kafka))
        write_feed(messages, sinks, "feed", sinks.feed_topic, write)

    return [impressions, invalid, feed]


def several_days(rows: DataFrame) -> bool:
    """Whether a stored batch meets more than one ``day``."""
    return len(rows.select("day").distinct().limit(2).collect()) > 1


# Shuffled bytes of a task where matched rows are dealt by day: the feed rows made of them are many
# times as large.
DEALT_BYTES = "16m"
DEALT_CONF = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": DEALT_BYTES}
# Bytes of a staged copy that a task reads: rows are many times as large as their packed columns,
# and few large tasks would spill what they sort and end far apart.
STAGED_CONF = {"spark.sql.files.maxPartitionBytes": "8m"}


def together(matched: DataFrame) -> DataFrame:
    """The rows of a day together, those of one user agent side by side.

    Agents are the longest texts of the tables and feeds, which then pack into fewer bytes in less
    time.
    """
    order = [name for name in ("day", "user_agent") if name in matched.columns]
    return matched.hint("rebalance", F.col("day")).sortWithinPartitions(*order)


def dealt_by_day(matched: DataFrame, path: str) -> DataFrame:
    """A staged batch, staged once more with the rows of a day together where it has several.

    The matched rows are a fraction of the tables and feeds made of them, which their tasks can then
    write as they are. AQE joins small days and splits large ones.
    """
    if not several_days(matched):
        return matched
    session = matched.sparkSession
    with session_conf(session, DEALT_CONF):
        return stage(session, together(matched), path)


def append_web_users(rows: DataFrame, path: str) -> None:
    """Append backfilled users that the table at ``path`` lacks.

    A second run adds none, the NULL user included: here NULL equals NULL.
    """
    there = rows.sparkSession.read.schema(WEB_USERS).parquet(path)
    there = there.select(F.col("user_id").alias("_known")).distinct()
    new = rows.join(there, F.col("user_id").eqNullSafe(F.col("_known")), "left_anti")
    new.write.mode("append").parquet(path)
