"""Key columns. Keys stay separate columns: no separator to collide with."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MATCH_KEY = ("user_id", "ad_id", "page_id", "ad_position", "publisher_id")
PAGE_KEY = ("publisher_id", "page_id")


def none_text(column: Column | str) -> Column:
    """Text form of a key part in which NULL equals NULL, written ``None``."""
    column = F.col(column) if isinstance(column, str) else column
    return F.coalesce(column.cast("string"), F.lit("None"))


def match_key_cols(prefix: str = "_k_") -> list[Column]:
    """The five columns that identify one ad view on both sides."""
    return [none_text(name).alias(prefix + name) for name in MATCH_KEY]
