"""Rows as the two impression tables store them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, LongType, StructType

from adstream.schemas import AD_IMPRESSIONS, AD_IMPRESSIONS_INVALID


# The seconds a stored timestamp can hold, years 1 to 9999.
_FIRST_SECOND, _LAST_SECOND = -62135596800, 253402300799


def _stored(name: str, dtype: DataType) -> Column:
    if name == "timestamp":
        seconds = F.col("ctimestamp").try_cast("bigint")
        # Client clocks can say anything; one absurd second must not fail the job.
        known = F.when(seconds.between(_FIRST_SECOND, _LAST_SECOND), seconds)
        return F.timestamp_seconds(known).alias(name)
    if isinstance(dtype, LongType):
        return F.col(name).try_cast("bigint").alias(name)
    return F.col(name).cast(dtype).alias(name)


def _project(df: DataFrame, schema: StructType, extra: tuple[str, ...]) -> DataFrame:
    return df.select(*[_stored(f.name, f.dataType) for f in schema], *extra)


def to_ad_impressions(df: DataFrame, *extra: str) -> DataFrame:
    """Enriched rows as Ad_impressions; text a column cannot hold becomes NULL."""
    return _project(df, AD_IMPRESSIONS, extra)


def to_ad_impressions_invalid(df: DataFrame, *extra: str) -> DataFrame:
    """Rejected rows as Ad_impressions_Invalid, in table order."""
    return _project(df, AD_IMPRESSIONS_INVALID, extra)
