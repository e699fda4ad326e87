"""Session settings the jobs rely on, and the shared scratch folder."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Batch settings for a large cluster. Every one can be set at run time; the
# shuffle partition count is left to the deployment, AQE coalesces from there.
BATCH_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    # A task writes up to so many partitions side by side; beyond that it sorts its rows, and spills.
    "spark.sql.maxConcurrentOutputFileWriters": "64",
}

# State lives off-heap on local disk and is shipped as change logs; the slower
# of the two event streams holds the watermark back.
STREAM_CONF = {
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.sql.streaming.multipleWatermarkPolicy": "min",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the batch settings to a running session."""
    for key, value in BATCH_CONF.items():
        spark.conf.set(key, value)
    return spark


@contextmanager
def session_conf(spark: SparkSession, settings: dict[str, str]) -> Iterator[None]:
    """Set session options for the duration of a block, then restore them."""
    before = {key: spark.conf.get(key, None) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new folder name in storage that all executors share.

    Below ``spark.checkpoint.dir``, or below the warehouse where that is unset.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        base = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_scratch"
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"
