"""Stored tables: dimensions, impressions and web users."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from adstream.schemas import PARTITIONED, TABLES
from adstream.sources.stored import read_stored


def read_table(
    spark: SparkSession,
    root: str,
    name: str,
    since: str | None = None,
    until: str | None = None,
) -> DataFrame:
    """One warehouse table below ``root``; partition columns are left out.

    ``since`` and ``until`` are the first and last arrival day (``YYYYMMDD``) of
    a table stored by day; only folders of those days are read, or the compacted
    copies that stand for them.
    """
    schema = TABLES[name]
    if name in PARTITIONED:
        return read_stored(spark, root, name, since, until).select(*schema.names)
    return spark.read.schema(schema).parquet(f"{root.rstrip('/')}/{name}").select(*schema.names)


@dataclass(frozen=True)
class Dimensions:
    """The lookup tables of one run. Frames are lazy; nothing is collected."""

    ad_position: DataFrame
    advertiser: DataFrame
    page: DataFrame
    user_agent: DataFrame | None = None


def read_dimensions(spark: SparkSession, root: str) -> Dimensions:
    return Dimensions(
        ad_position=read_table(spark, root, "Ad_position"),
        advertiser=read_table(spark, root, "Advertiser"),
        page=read_table(spark, root, "Page"),
    )
