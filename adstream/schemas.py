"""Schemas of events, notices and warehouse tables, and the table definitions."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import SparkSession
from pyspark.sql.types import (
    DataType,
    DecimalType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)


def _struct(**fields: DataType) -> StructType:
    return StructType([StructField(name, dtype, True) for name, dtype in fields.items()])


_S, _L, _T = StringType(), LongType(), TimestampType()

# Event fields are read as text: a typed parse would turn a value of the wrong
# type into NULL before validation could tell the two apart.
CLIENT_EVENT = _struct(
    ad_id=_S,
    user_id=_S,
    publisher_id=_S,
    page_id=_S,
    ad_position=_S,
    user_agent=_S,
    latency=_S,
    ctimestamp=_S,
    clicked=_S,
)
SERVER_EVENT = _struct(
    ad_id=_S,
    user_id=_S,
    publisher_id=_S,
    page_id=_S,
    ad_position=_S,
    user_agent=_S,
    server_id=_S,
    stimestamp=_S,
)
EVENT_SCHEMAS = {"client": CLIENT_EVENT, "server": SERVER_EVENT}

NOTICE = _struct(
    bucket=_S,
    data_frequency=_S,
    folder_path=_S,
    server_events_file=_S,
    client_events_file=_S,
)

PAGE = _struct(publisher_id=_L, page_id=_S, publisher=_S, article=_S)
ADVERTISER = _struct(ad_id=_L, advertiser=_S, exchange=_S, campaign_id=_L, size=_S)
AD_POSITION = _struct(ad_position=_S, Location=_S, Size=_S)
BROWSER = _struct(user_agent=_S, browser=_S, version=DecimalType(38, 9))
WEB_USERS = _struct(
    user_id=_S, Age=_L, Country=_S, GENDER=_S, MARITAL_STATUS=_S, INCOME=_L
)
AD_IMPRESSIONS = _struct(
    ad_id=_L,
    user_id=_S,
    publisher_id=_L,
    page_id=_S,
    ad_position=_S,
    latency=_L,
    timestamp=_T,
    clicked=_S,
    Location=_S,
    Size=_S,
    advertiser=_S,
    exchange=_S,
    campaign_id=_L,
    publisher=_S,
    article=_S,
    Browser=_S,
    Browser_version=_S,
    Client_OS=_S,
    Client_OS_Ver=_S,
    Client_Device=_S,
    Client_Device_Brand=_S,
    Client_Device_Model=_S,
)
AD_IMPRESSIONS_INVALID = _struct(
    ad_id=_L,
    user_id=_S,
    publisher_id=_L,
    page_id=_S,
    ad_position=_S,
    latency=_L,
    timestamp=_T,
    user_agent=_S,
    clicked=_S,
    validity_status=_S,
    invalid_field=_S,
)

TABLES = {
    "Page": PAGE,
    "Advertiser": ADVERTISER,
    "Ad_position": AD_POSITION,
    "Browser": BROWSER,
    "WebUsers": WEB_USERS,
    "Ad_impressions": AD_IMPRESSIONS,
    "Ad_impressions_Invalid": AD_IMPRESSIONS_INVALID,
}

# Tables the jobs append to, and the columns that name their folders.
PARTITIONED = ("Ad_impressions", "Ad_impressions_Invalid")
PARTITION_COLUMNS = "`day` string, `source` string, `run` string, `batch_id` bigint, `part` int"


def _there(spark: SparkSession, path: str) -> bool:
    try:
        spark.read.format("binaryFile").load(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return False
    return True


def create_tables(spark: SparkSession, root: str, database: str | None = None) -> None:
    """Define the seven tables as Parquet tables below ``root`` where absent.

    The two that the jobs write are partitioned as they are stored; partitions
    that are there are found, so run it again after new days.
    """
    prefix = f"`{database}`." if database else ""
    if database:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`")
    for name, schema in TABLES.items():
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
        parts = name in PARTITIONED
        by = ", ".join(c.split()[0] for c in PARTITION_COLUMNS.split(", "))
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {prefix}`{name}` "
            f"({columns}{', ' + PARTITION_COLUMNS if parts else ''}) USING parquet "
            f"{f'PARTITIONED BY ({by}) ' if parts else ''}LOCATION '{root.rstrip('/')}/{name}'"
        )
        if parts and _there(spark, f"{root.rstrip('/')}/{name}"):
            spark.catalog.recoverPartitions(f"{prefix}`{name}`")
