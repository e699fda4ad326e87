"""Periodic reports over the stored tables."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _traffic() -> list[Column]:
    clicks = F.count_if(F.col("clicked") == "yes")
    return [
        F.count(F.lit(1)).alias("impressions"),
        clicks.alias("clicks"),
        (clicks / F.count(F.lit(1))).alias("click_rate"),
    ]


def report_by_campaign(impressions: DataFrame) -> DataFrame:
    """Traffic by advertiser, campaign and hour."""
    hour = F.date_trunc("hour", "timestamp").alias("hour")
    return impressions.groupBy("advertiser", "campaign_id", hour).agg(*_traffic())


def report_by_page(impressions: DataFrame) -> DataFrame:
    """Traffic by publisher and page."""
    return impressions.groupBy("publisher", "page_id").agg(*_traffic())


def report_by_placement(impressions: DataFrame) -> DataFrame:
    """Traffic by location and size of the ad."""
    return impressions.groupBy("Location", "Size").agg(*_traffic())


def _range_start(name: str) -> Column:
    """Start of the range of a number; ranges grow with it, 1,024 to each doubling."""
    # The bits of the number, of a negative one those of its complement: abs() has none for the least.
    drop = f"greatest(length(bin({name} ^ shiftright({name}, 63))) - 11, 0)"
    return F.expr(f"shiftleft(shiftright({name}, {drop}), {drop})")


def report_latency(impressions: DataFrame) -> DataFrame:
    """Impressions, mean and 95th percentile latency by browser, system and device.

    The percentile is exact: the least latency that at least 95 of 100 known
    ones do not exceed. Impressions are counted per latency, and those counts
    per range of latencies; only ranges are ranked within a group, which has a
    bounded number of them, and then the latencies of the one range that holds
    the percentile.
    """
    group = ["Browser", "Client_OS", "Client_Device"]
    counts = impressions.groupBy(*group, "latency").agg(F.count(F.lit(1)).alias("n"))
    counts = counts.withColumn("start", _range_start("latency"))
    known = F.when(F.col("latency").isNotNull(), F.col("n")).otherwise(0)
    ranges = counts.groupBy(*group, "start").agg(
        F.sum("n").alias("n"),
        F.sum(known).alias("known"),
        F.sum(F.col("latency").cast("double") * F.col("n")).alias("sum"),
    )
    whole = Window.partitionBy(*group).orderBy("start")
    upto = whole.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    total = whole.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    ranked = ranges.withColumns(
        {
            "before": F.sum("known").over(upto) - F.col("known"),
            "total": F.sum("known").over(total),
        }
    ).withColumn("rank", F.expr("(total * 95 + 99) div 100"))
    inside = (F.col("before") < F.col("rank")) & (F.col("rank") <= F.col("before") + F.col("known"))
    groups = ranked.groupBy(*group).agg(
        F.sum("n").alias("impressions"), (F.sum("sum") / F.sum("known")).alias("mean_latency")
    )
    hit = ranked.where(inside).select(
        *[F.col(g).alias(f"_{g}") for g in group],
        F.col("start").alias("_start"),
        (F.col("rank") - F.col("before")).alias("rest"),
    )
    same = [F.col(g).eqNullSafe(F.col(f"_{g}")) for g in group]
    of_range = counts.join(hit, reduce(and_, [*same, F.col("start") == F.col("_start")]))
    by_latency = Window.partitionBy(*group).orderBy("latency").rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    reached = of_range.withColumn("upto", F.sum("n").over(by_latency)).where("upto >= rest")
    found = reached.groupBy(*[F.col(g).alias(f"_{g}") for g in group]).agg(
        F.min("latency").alias("p95_latency")
    )
    joined = groups.join(found, reduce(and_, same), "left")
    return joined.select(*group, "impressions", "mean_latency", "p95_latency")


def report_invalid(invalid: DataFrame) -> DataFrame:
    """Rejected beacons by status and field."""
    return invalid.groupBy("validity_status", "invalid_field").agg(
        F.count(F.lit(1)).alias("events")
    )


def report_by_demographics(impressions: DataFrame, web_users: DataFrame) -> DataFrame:
    """Traffic by country, gender, marital status and age of known users.

    Impressions are summed per user before the join, so it moves one row per
    user and a very active user is no hot key.
    """
    per_user = impressions.groupBy("user_id").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("clicked") == "yes").alias("c")
    )
    people = web_users.select("user_id", "Country", "GENDER", "MARITAL_STATUS", "Age")
    joined = per_user.join(people, "user_id")
    return joined.groupBy("Country", "GENDER", "MARITAL_STATUS", "Age").agg(
        F.sum("n").alias("impressions"),
        F.sum("c").alias("clicks"),
        (F.sum("c") / F.sum("n")).alias("click_rate"),
    )
