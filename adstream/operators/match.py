"""Match client beacons with server records.

A beacon counts when a server record with the same five-part key exists in the
same scope (a 30-second window, or a file folder); of several beacons with one
key, the least by ``order_by`` stands for all. That is neither an inner nor a
semi join: it is one aggregation over both sides tagged into one frame. One
shuffle carries each side once; the map-side step already reduces every key to
one row per task, so a key that holds a third of the rows never meets in one
task, and on a stream the state per key is one beacon and one flag.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from adstream.functions.keys import MATCH_KEY, match_key_cols
from adstream.schemas import CLIENT_EVENT

WINDOW = "30 seconds"
# How far messages may arrive out of order: a backlog read from uneven partitions.
DELAY = "10 minutes"
_ORDER, _ROW, _SERVER, _BEACONS = "_order", "_row", "_server", "_beacons"


def assign_window(
    df: DataFrame, time_column: str = "publish_ts", width: str = WINDOW
) -> DataFrame:
    """Add the tumbling ``window`` that a row's arrival time falls in."""
    return df.withColumn("window", F.window(F.col(time_column), width))


def with_arrival_watermark(
    df: DataFrame, time_column: str = "publish_ts", delay: str = DELAY
) -> DataFrame:
    """Let windows close as arrival time passes them.

    Goes on each side before the two are matched. The watermark is then the
    lesser of the two and the slower side still matches; one watermark on the
    union would be the greater and would drop the slower side as late.
    """
    return df.withWatermark(time_column, delay)


def _order_columns(client: DataFrame, order_by: Sequence[str] | None) -> list[Column]:
    if order_by:
        return [F.col(name) for name in order_by]
    return [F.col("ctimestamp").try_cast("bigint")]


def match_events(
    client: DataFrame,
    server: DataFrame,
    scope: Sequence[str] = ("window",),
    order_by: Sequence[str] | None = None,
    counted: Observation | None = None,
) -> DataFrame:
    """The first beacon of each key and scope that a server record confirms.

    ``order_by`` names the columns that decide which beacon is first, NULL
    lowest; the default is the client time. Remaining columns break ties, event
    fields before others, so the result does not depend on input order.

    ``counted`` observes, for bounded inputs, what became of the beacons:
    ``matched``, ``merged`` into a matched one, and ``unmatched``.
    """
    scope = list(scope)
    # The aggregation sorts, comparing columns from the left: after the scope
    # comes the field that tells most rows apart.
    keys = [f"_k_{name}" for name in MATCH_KEY]
    events = [name for name in CLIENT_EVENT.names if name in client.columns]
    payload = events + [n for n in client.columns if n not in events and n not in scope]
    order = [
        column.alias(f"{_ORDER}{i}")
        for i, column in enumerate(_order_columns(client, order_by))
    ]
    beacons = client.select(
        *scope,
        *match_key_cols(),
        F.struct(*order, *payload).alias(_ROW),
        F.lit(False).alias(_SERVER),
    )
    records = server.select(*scope, *match_key_cols(), F.lit(True).alias(_SERVER))
    groups = (
        beacons.unionByName(records, allowMissingColumns=True)
        .groupBy(*scope, *keys)
        .agg(
            F.min(_ROW).alias(_ROW),
            F.max(_SERVER).alias(_SERVER),
            *([F.count(_ROW).alias(_BEACONS)] if counted else []),
        )
    )
    if counted:
        groups = groups.observe(
            counted,
            F.count_if(F.col(_SERVER) & (F.col(_BEACONS) > 0)).alias("matched"),
            F.sum(F.when(F.col(_SERVER), F.greatest(F.col(_BEACONS) - 1, F.lit(0)))).alias("merged"),
            F.sum(F.when(~F.col(_SERVER), F.col(_BEACONS))).alias("unmatched"),
        )
    confirmed = groups.where(F.col(_SERVER) & F.col(_ROW).isNotNull())
    return confirmed.select(
        *[F.col(n) if n in scope else F.col(f"{_ROW}.{n}").alias(n) for n in client.columns]
    )


def flatten_matches(batch: DataFrame, stream: DataFrame) -> DataFrame:
    """Matches of both paths as one bag; equal rows are kept."""
    return batch.unionByName(stream)
