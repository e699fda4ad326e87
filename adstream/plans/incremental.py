"""Backfill and reports that read only what was stored since their last run.

A job marks the folders that it has taken in, by the names that micro-batches give them; a later run
reads the folders without a mark. Marks are written last: a run that dies is repeated, and what
it had already written is replaced.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adstream.operators.users import backfill_web_users
from adstream.session import configure, scratch_path
from adstream.sources.stored import folders, or_empty, published, read_folders, read_stored
from adstream.streaming.sinks import append_web_users

MARKS = "name string, day string, folder string, run long"
USERS = "user_id string, run long"


def _marks_path(root: str, job: str) -> str:
    return f"{root.rstrip('/')}/_marks/{job}"


def unmarked(spark: SparkSession, root: str, name: str, job: str) -> tuple[DataFrame, int]:
    """Folders that ``job`` has not taken in, and the number of its next run.

    ``there`` tells whether the folder is still stored, or only the copy that covers it.
    """
    path = _marks_path(root, job)
    marks = or_empty(spark, lambda: spark.read.schema(MARKS).parquet(path), MARKS)
    run = (marks.agg(F.max("run")).first()[0] or 0) + 1
    written = folders(spark, root, name).select("day", "folder", F.lit(True).alias("there"))
    covered = published(spark, root, name).select("day", F.explode("covered").alias("folder"))
    every = written.unionByName(covered.withColumn("there", F.lit(False)))
    every = every.groupBy("day", "folder").agg(F.max("there").alias("there"))
    known = marks.where(F.col("name") == name).select("day", "folder")
    rows = every.join(known, ["day", "folder"], "left_anti")
    # The list is fixed now: a folder that comes while the job runs is left to the next run.
    path = scratch_path(spark, "unmarked")
    rows.write.parquet(path)
    return spark.read.schema(rows.schema).parquet(path), run


def mark(spark: SparkSession, root: str, name: str, job: str, rows: DataFrame, run: int) -> None:
    """Note folders as taken in."""
    marks = rows.select(F.lit(name).alias("name"), "day", "folder", F.lit(run).cast("long").alias("run"))
    marks.coalesce(1).write.mode("append").parquet(_marks_path(root, job))


def new_rows(spark: SparkSession, root: str, name: str, rows: DataFrame) -> DataFrame:
    """The rows of some folders; where only the copy of a day is left, all rows of that day."""
    there = read_folders(spark, root, name, rows.where("there").collect())
    gone = [row.day for row in rows.where("NOT there").select("day").distinct().collect()]
    if not gone:
        return there
    days = read_stored(spark, root, name, min(gone), max(gone)).where(F.col("day").isin(gone))
    return there.unionByName(days)


def backfill_new_users(
    spark: SparkSession, root: str, limit: int | None = None, name: str = "Ad_impressions"
) -> None:
    """Append the users to WebUsers that impressions mention and it lacks, or the first ``limit``.

    The distinct users of all impressions are kept beside the tables. A run adds those of new
    folders, and compares the kept users, never the impressions, with WebUsers.
    """
    configure(spark)
    root = root.rstrip("/")
    fresh, run = unmarked(spark, root, name, "backfill")
    path = f"{root}/_marks/users"
    known = or_empty(spark, lambda: spark.read.schema(USERS).parquet(path), USERS)
    # What a run that died has left is replaced.
    known = known.where(F.col("run") < run).select("user_id")
    users = new_rows(spark, root, name, fresh).select("user_id").distinct()
    seen = known.withColumnRenamed("user_id", "seen")
    users = users.join(seen, F.col("user_id").eqNullSafe(F.col("seen")), "left_anti")
    users.write.mode("overwrite").parquet(f"{path}/run={run}")
    known = spark.read.schema(USERS).parquet(path).select("user_id")
    people = spark.read.parquet(f"{root}/WebUsers").select("user_id")
    append_web_users(backfill_web_users(known, people, limit), f"{root}/WebUsers")
    mark(spark, root, name, "backfill", fresh, run)


# Reports whose measures add up: the table they are over and what they group by.
_HOUR = "hour"
REPORTS: dict[str, tuple[str, tuple[str, ...]]] = {
    "by_campaign": ("Ad_impressions", ("advertiser", "campaign_id", _HOUR)),
    "by_page": ("Ad_impressions", ("publisher", "page_id")),
    "by_placement": ("Ad_impressions", ("Location", "Size")),
    "invalid": ("Ad_impressions_Invalid", ("validity_status", "invalid_field")),
}


def refresh_report(spark: SparkSession, root: str, report: str) -> list[str]:
    """Count anew the days of which new folders have come; the days counted."""
    configure(spark)
    root = root.rstrip("/")
    name, group = REPORTS[report]
    fresh, run = unmarked(spark, root, name, f"report_{report}")
    days = sorted(row.day for row in fresh.select("day").distinct().collect())
    if not days:
        return []
    rows = read_stored(spark, root, name, days[0], days[-1]).where(F.col("day").isin(days))
    if _HOUR in group:
        rows = rows.withColumn(_HOUR, F.date_trunc("hour", "timestamp"))
    counts = rows.groupBy("day", *group).agg(
        F.count(F.lit(1)).alias("impressions"), F.count_if(F.col("clicked") == "yes").alias("clicks")
    )
    # A day's counts replace those of an earlier run, and of one that died.
    (
        counts.hint("rebalance", F.col("day"))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("day")
        .parquet(f"{root}/_marks/counts/{report}")
    )
    mark(spark, root, name, f"report_{report}", fresh, run)
    return days


def read_report(spark: SparkSession, root: str, report: str) -> DataFrame:
    """The report over all days counted; its rows are those of the report over the whole table."""
    _, group = REPORTS[report]
    counts = spark.read.parquet(f"{root.rstrip('/')}/_marks/counts/{report}")
    summed = counts.groupBy(*group).agg(F.sum("impressions").alias("impressions"), F.sum("clicks").alias("clicks"))
    if report == "invalid":
        return summed.select(*group, F.col("impressions").alias("events"))
    return summed.withColumn("click_rate", F.col("clicks") / F.col("impressions"))
