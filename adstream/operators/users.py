"""Backfill of web users that impressions mention but the user table lacks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adstream.schemas import WEB_USERS

# Demographics a backfilled user starts with.
DEFAULT_DEMOGRAPHICS = {
    "Age": 37,
    "Country": "USA",
    "GENDER": "MALE",
    "MARITAL_STATUS": "MARRIED",
    "INCOME": 50000,
}
# Fixed value: the most rows that one run of the original statement adds.
BACKFILL_LIMIT = 50


def distinct_users(impressions: DataFrame) -> DataFrame:
    return impressions.select("user_id").distinct()


def absent_users(impressions: DataFrame, web_users: DataFrame) -> DataFrame:
    """Distinct users without a row in ``web_users``; a NULL user is absent.

    Distinct comes first: it folds hot users on the map side and leaves the
    rows partitioned the way the anti join needs them.
    """
    return distinct_users(impressions).join(web_users.select("user_id"), "user_id", "left_anti")


def backfill_web_users(
    impressions: DataFrame, web_users: DataFrame, limit: int | None = None
) -> DataFrame:
    """Rows to append to WebUsers: all absent users with defaults, or the first ``limit``."""
    users = absent_users(impressions, web_users)
    if limit is not None:
        users = users.orderBy("user_id").limit(limit)
    defaults = [
        F.lit(value).cast(WEB_USERS[name].dataType).alias(name)
        for name, value in DEFAULT_DEMOGRAPHICS.items()
    ]
    return users.select("user_id", *defaults)
