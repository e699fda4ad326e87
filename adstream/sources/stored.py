"""The folders that the jobs append to, and the compacted copies that stand for some of them.

A job writes a folder for each of its micro-batches. Compaction rewrites closed days into few files
and publishes, in one commit, which folders the new copy of a day covers. Readers take the last
published copy of a day and beside it the folders that it does not cover, so a row is seen once
whenever they read: before, during or after a compaction, and after late rows of a closed day.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from adstream.schemas import TABLES

# What a job's folder is called below that of its day.
FOLDER = r"/day=([^/]+)/(source=[^/]+/run=[^/]+/batch_id=[^/]+/part=[^/]+)/[^/]+$"
FOLDERS = "day string, folder string, bytes long"
PUBLISHED = "day string, version string, seq long, covered array<string>"


def table_path(root: str, name: str) -> str:
    return f"{root.rstrip('/')}/{name}"


def copies_path(root: str, name: str) -> str:
    """Where compacted copies and what is published lie; Spark's listings of the table pass it over."""
    return f"{root.rstrip('/')}/_compacted/{name}"


def stored_schema(name: str) -> StructType:
    return StructType([*TABLES[name].fields, StructField("day", StringType())])


def or_empty(spark: SparkSession, read, schema: str | StructType) -> DataFrame:
    """What ``read`` finds, or no rows where nothing has been written yet."""
    try:
        return read()
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def published(spark: SparkSession, root: str, name: str) -> DataFrame:
    """The copy that stands for each compacted day: ``day``, ``version``, ``seq`` and ``covered``."""
    path = f"{copies_path(root, name)}/published"
    rows = or_empty(spark, lambda: spark.read.schema(PUBLISHED).parquet(path), PUBLISHED)
    last = F.max_by(F.struct("version", "seq", "covered"), F.struct("seq", "version")).alias("last")
    return rows.groupBy("day").agg(last).select("day", "last.*")


def folders(
    spark: SparkSession, root: str, name: str, days: Iterable[str] | None = None
) -> DataFrame:
    """``day``, ``folder`` and ``bytes`` of the folders that jobs have written, listed in tasks."""
    path = table_path(root, name)
    if days is not None:
        path = f"{path}/day={{{','.join(sorted(days))}}}"
    reader = spark.read.format("binaryFile").options(
        recursiveFileLookup="true", pathGlobFilter="*.parquet"
    )
    files = or_empty(spark, lambda: reader.load(path), "path string, length long")
    day, folder = F.regexp_extract("path", FOLDER, 1), F.regexp_extract("path", FOLDER, 2)
    found = files.select(day.alias("day"), folder.alias("folder"), "length").where("day <> ''")
    return found.groupBy("day", "folder").agg(F.sum("length").alias("bytes"))


def uncovered(spark: SparkSession, root: str, name: str, days: Iterable[str] | None = None) -> DataFrame:
    """Those of :func:`folders` that no published copy covers."""
    covered = published(spark, root, name).select("day", F.explode("covered").alias("folder"))
    return folders(spark, root, name, days).join(covered, ["day", "folder"], "left_anti")


def read_folders(spark: SparkSession, root: str, name: str, rows: Iterable) -> DataFrame:
    """The rows of some folders (with ``day`` and ``folder``), with ``day``."""
    path = table_path(root, name)
    paths = [f"{path}/day={row.day}/{row.folder}" for row in rows]
    schema = stored_schema(name)
    if not paths:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", path).parquet(*paths).select(*schema.names)


def read_stored(
    spark: SparkSession, root: str, name: str, since: str | None = None, until: str | None = None
) -> DataFrame:
    """All rows of a table that jobs append to, with ``day``; only folders of the days asked for."""

    def within(rows: DataFrame) -> DataFrame:
        rows = rows if since is None else rows.where(F.col("day") >= since)
        return rows if until is None else rows.where(F.col("day") <= until)

    schema = stored_schema(name)
    table = within(spark.read.schema(schema).parquet(table_path(root, name)))
    # One row for each compacted day.
    copies = within(published(spark, root, name)).select("day", "version").collect()
    if not copies:
        return table
    days = [row.day for row in copies]
    base = f"{copies_path(root, name)}/versions"
    paths = [f"{base}/version={row.version}/day={row.day}" for row in copies]
    copied = spark.read.schema(schema).option("basePath", base).parquet(*paths)
    # Rows that came to a day after its copy was published: a few folders, if any.
    later = read_folders(spark, root, name, uncovered(spark, root, name, days).collect())
    open_ = table.where(~F.col("day").isin(days)).select(*schema.names)
    return open_.unionByName(copied.select(*schema.names)).unionByName(later)
