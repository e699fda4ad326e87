"""Notices that announce an hourly folder, and what is derived from them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def batch_file_paths(notices: DataFrame) -> DataFrame:
    """Add the client and the server file path of each announced folder."""
    return notices.select(
        "*",
        F.concat_ws("/", "bucket", "folder_path", "client_events_file").alias("client_path"),
        F.concat_ws("/", "bucket", "folder_path", "server_events_file").alias("server_path"),
    )


def completion_notices(notices: DataFrame, *keep: str) -> DataFrame:
    """The JSON message that tells the cleanup job a folder is processed."""
    folder = F.concat_ws("/", "bucket", "folder_path")
    return notices.select(*keep, F.to_json(F.array(F.lit("foldername"), folder)).alias("value"))
