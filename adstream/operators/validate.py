"""Ordered validation of matched beacons."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adstream.schemas import CLIENT_EVENT

# The status texts and the accepted values of ``clicked``.
NULL_STATUS = "Invalid due to null"
TYPE_STATUS = "Invalid due to Data type"
CLICKED_VALUES = ("yes", "no")

_NUMERIC = ("ad_id", "publisher_id")


def _wrong_type(field: str, numeric_check: bool) -> Column | None:
    if field == "clicked":
        return ~F.col(field).isin(*CLICKED_VALUES)
    if numeric_check and field in _NUMERIC:
        return ~F.col(field).cast("string").rlike("^[0-9]+$")
    return None


def validate_client_events(df: DataFrame, numeric_check: bool = False) -> DataFrame:
    """Add ``validity_status`` and ``invalid_field`` for the first rule that fails.

    Both are empty on a valid row. Fields are tried in event order, each for
    NULL first. ``numeric_check`` also requires digits in the two numeric ids,
    which is off by default.
    """
    status, field = F, F
    for name in CLIENT_EVENT.names:
        rules = [(F.col(name).isNull(), NULL_STATUS)]
        wrong = _wrong_type(name, numeric_check)
        if wrong is not None:
            rules.append((wrong, TYPE_STATUS))
        for failed, text in rules:
            status, field = status.when(failed, text), field.when(failed, name)
    return df.withColumns(
        {"validity_status": status.otherwise(""), "invalid_field": field.otherwise("")}
    )


def rule_counts() -> list[Column]:
    """Counts of rejected rows by the field and the kind of the rule that failed."""
    kinds = {"null": NULL_STATUS, "type": TYPE_STATUS}
    return [
        F.count_if((F.col("invalid_field") == name) & (F.col("validity_status") == text)).alias(
            f"invalid_{name}_{kind}"
        )
        for name in CLIENT_EVENT.names
        for kind, text in kinds.items()
    ]


def split_validity(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Valid rows and invalid rows of a validated frame."""
    valid = (F.col("validity_status") == "") & (F.col("invalid_field") == "")
    return df.where(valid), df.where(~valid)
