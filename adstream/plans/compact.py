"""Compaction: closed days of the append tables rewritten into sized, sorted files."""

from __future__ import annotations

import math
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from adstream.schemas import PARTITION_COLUMNS
from adstream.session import configure, scratch_path
from adstream.sources.events import listed_sizes
from adstream.sources.stored import (
    PUBLISHED,
    copies_path,
    published,
    stored_schema,
    table_path,
    uncovered,
)

# Bytes of a file, and by what rows of a day are sorted, so that scans for one advertiser and a span of
# time skip most row groups.
FILE_BYTES = 256 << 20
SORTED_BY = {
    "Ad_impressions": ("advertiser", "timestamp"),
    "Ad_impressions_Invalid": ("invalid_field", "timestamp"),
}


def rewrite(
    spark: SparkSession, root: str, name: str, before: str, file_bytes: int = FILE_BYTES
) -> DataFrame | None:
    """Write new copies of the days before ``before`` that have folders no copy covers.

    Returns the rows to publish, or None where there is nothing to do. Until they are published
    no reader sees the copies.
    """
    open_ = uncovered(spark, root, name).where(F.col("day") < before)
    path = scratch_path(spark, "compact")
    open_.write.parquet(path)
    open_ = spark.read.schema(open_.schema).parquet(path)
    size = open_.agg(F.sum("bytes")).first()[0]
    if not size:
        return None
    old = published(spark, root, name).join(open_.select("day").distinct(), "day")
    # A folder is told by the values of its partition columns.
    parts = [c.split()[0].strip("`") for c in PARTITION_COLUMNS.split(", ")]
    named = F.concat_ws("/", *[F.concat(F.lit(f"{p}="), F.col(p).cast("string")) for p in parts[1:]])
    columns = stored_schema(name).names
    typed = StructType.fromDDL(PARTITION_COLUMNS)
    schema = StructType([*stored_schema(name).fields[:-1], *typed.fields])
    days = [row.day for row in open_.select("day").distinct().collect()]
    raw = spark.read.schema(schema).parquet(table_path(root, name)).where(F.col("day").isin(days))
    rows = raw.withColumn("folder", named).join(open_.select("day", "folder"), ["day", "folder"], "left_semi")
    rows = rows.select(*columns)
    base = f"{copies_path(root, name)}/versions"
    copied = [f"{base}/version={row.version}/day={row.day}" for row in old.collect()]
    if copied:
        reader = spark.read.schema(stored_schema(name)).option("basePath", base)
        rows = rows.unionByName(reader.parquet(*copied).select(*columns))
        # Of a day compacted before, the old copy is most of what is written again.
        size += listed_sizes(spark, copied).agg(F.sum("bytes")).first()[0]
    version = uuid.uuid4().hex
    sort = ["day", *SORTED_BY[name]]
    files = max(math.ceil(size / file_bytes), len(days))
    (
        rows.repartitionByRange(files, *sort)
        .sortWithinPartitions(*sort)
        .write.partitionBy("day")
        .parquet(f"{base}/version={version}")
    )
    covers = open_.groupBy("day").agg(F.collect_list("folder").alias("new"))
    known = covers.join(old.select("day", "seq", "covered"), "day", "left")
    return known.select(
        "day",
        F.lit(version).alias("version"),
        (F.coalesce("seq", F.lit(0).cast("long")) + 1).alias("seq"),
        F.concat("new", F.coalesce("covered", F.array().cast("array<string>"))).alias("covered"),
    )


def publish(spark: SparkSession, root: str, name: str, copies: DataFrame) -> None:
    """Make copies stand for their days: one file, that readers see whole or not at all."""
    path = f"{copies_path(root, name)}/published"
    rows = copies.to(spark.createDataFrame([], PUBLISHED).schema)
    rows.coalesce(1).write.mode("append").parquet(path)


def compact_days(
    spark: SparkSession, root: str, name: str, before: str, file_bytes: int = FILE_BYTES
) -> list[str]:
    """Rewrite days before ``before`` (``YYYYMMDD``) of the table ``name``; the days rewritten.

    Give a day that has ended. Rows that still come to a closed day stay beside its copy until the next
    compaction. A run that dies leaves files that nothing refers to, and changes no result.
    """
    configure(spark)
    copies = rewrite(spark, root, name, before, file_bytes)
    if copies is None:
        return []
    publish(spark, root, name, copies)
    return sorted(row.day for row in copies.select("day").collect())


def superseded(spark: SparkSession, root: str, name: str) -> DataFrame:
    """``value``: cleanup messages for folders that a published copy covers.

    As for ingested folders, removing them is another service's work; readers do without them. Leave
    time for readers that began before the copy was published.
    """
    rows = published(spark, root, name).select("day", F.explode("covered").alias("folder"))
    day = F.concat(F.lit(f"{table_path(root, name)}/day="), "day")
    return rows.select(F.to_json(F.array(F.lit("foldername"), F.concat_ws("/", day, "folder"))).alias("value"))
