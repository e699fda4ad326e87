"""Shared folders, intermediate tables and Arrow text access for the text operators."""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Rows handed to Python at a time. A whole text is one value of a batch, so this bounds
# what a worker holds to that many texts, not to a share of the table.
BATCH_CONF = {"spark.sql.execution.arrow.maxRecordsPerBatch": "512"}


def prepare(spark: SparkSession) -> SparkSession:
    """Set what the text operators rely on: short Arrow batches."""
    for key, value in BATCH_CONF.items():
        spark.conf.set(key, value)
    return spark


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder name below ``spark.checkpoint.dir``, shared by driver and executors.

    Where that is unset (local tests) the folder lies below the warehouse.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        base = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_scratch"
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def saved(df: DataFrame, path: str) -> DataFrame:
    """Write a table and read it back: later steps survive the loss of any executor."""
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_column() -> F.Column:
    """The text as the contracts read it: NULL is the empty text."""
    return F.coalesce(F.col("text"), F.lit(""))


def with_plain_names(docs: DataFrame, *own: str) -> DataFrame:
    """``docs`` with its columns named by their places, but for ``own`` ones.

    No name of an operator then clashes with one of the table's, and no name needs quoting; give
    the table's names back with ``toDF(*docs.columns)``.
    """
    return docs.toDF(*[name if name in own else f"c{place}" for place, name in enumerate(docs.columns)])


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a text column and the offsets of its rows; NULL rows are empty."""
    column = column.fill_null("").cast(pa.large_string())
    offsets = np.frombuffer(column.buffers()[1], np.int64, len(column) + 1, column.offset * 8)
    start, end = int(offsets[0]), int(offsets[-1])
    data = column.buffers()[2]
    if data is None or start == end:
        return np.zeros(0, np.uint8), offsets - start
    return np.frombuffer(data, np.uint8, end - start, start), offsets - start
