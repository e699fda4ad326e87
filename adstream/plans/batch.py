"""The whole job over bounded inputs."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import replace
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession

from adstream.operators.enrich import build_user_agent_dim, enrich_events
from adstream.operators.match import match_events
from adstream.operators.project import to_ad_impressions, to_ad_impressions_invalid
from adstream.operators.validate import split_validity, validate_client_events
from adstream.session import configure
from adstream.sources.dimensions import Dimensions


class Outcome(NamedTuple):
    """What becomes of matched beacons."""

    validated: DataFrame
    enriched: DataFrame
    impressions: DataFrame
    invalid: DataFrame


def process_matched(
    matched: DataFrame,
    dims: Dimensions,
    numeric_check: bool = False,
    keep: Sequence[str] = (),
    agents: str | None = None,
) -> Outcome:
    """Validate, split, enrich and project matched beacons.

    ``keep`` names columns the two table projections carry in addition. Where
    ``matched`` is staged, so that it can be read twice, give a path for ``agents``:
    its user agents are parsed once each into a lookup table stored there, unless
    ``dims`` brings one. Plans over it see its true size, so a small one is broadcast;
    a bare aggregate is sized by its input, and all rows would be shuffled to meet it.
    """
    validated = validate_client_events(matched, numeric_check)
    valid, invalid = split_validity(validated)
    if agents and dims.user_agent is None:
        found = stage(matched.sparkSession, build_user_agent_dim(valid), agents)
        dims = replace(dims, user_agent=found)
    enriched = enrich_events(valid, dims)
    return Outcome(
        validated,
        enriched,
        to_ad_impressions(enriched, *keep),
        to_ad_impressions_invalid(invalid, *keep),
    )


def stage(spark: SparkSession, df: DataFrame, path: str) -> DataFrame:
    """Write a frame once and read it back, so several outputs share the work.

    The copy is in shared storage: it outlives executors, cuts the lineage, and
    later plans see its true size.
    """
    df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def run_batch(
    client: DataFrame,
    server: DataFrame,
    dims: Dimensions,
    scope: Sequence[str] = ("window",),
    order_by: Sequence[str] | None = None,
    numeric_check: bool = False,
    staging: str | None = None,
) -> Outcome:
    """Match and process bounded events.

    The frames returned are lazy. When more than one of them is to be written,
    give a ``staging`` path, or each write would match again.
    """
    configure(client.sparkSession)
    matched = match_events(client, server, scope, order_by)
    if staging:
        matched = stage(client.sparkSession, matched, staging)
    return process_matched(matched, dims, numeric_check, agents=staging and f"{staging}_agents")
