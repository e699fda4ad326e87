"""Lookups that add dimension and user-agent attributes.

No broadcast is forced. Spark broadcasts a dimension whose size it finds below
``spark.sql.autoBroadcastJoinThreshold`` (from the files when planning, from
the shuffled rows at run time) and otherwise sort-merges, where AQE splits the
partitions of hot keys.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce
from operator import and_, eq

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adstream.functions.keys import PAGE_KEY, none_text
from adstream.functions.useragent import (
    BROWSER_COLUMNS,
    BROWSER_RULES,
    OS_RULES,
    device_brand,
    device_model,
    first_browser,
    first_os,
    rule_name,
    rule_version,
)
from adstream.sources.dimensions import Dimensions

UNKNOWN = "Unknown"
_HIT, _ATTRS = "_hit", "_attrs"


def _lookup(
    df: DataFrame,
    dim: DataFrame,
    keys: Sequence[tuple[Column, Column]],
    attributes: Sequence[str],
    equal: Callable[[Column, Column], Column] = Column.eqNullSafe,
) -> DataFrame:
    """Left lookup that tells an absent key from a NULL attribute.

    ``keys`` pairs an event expression with a dimension expression, ``equal``
    compares them. A key the dimension lacks yields ``Unknown``; a key it has yields the
    attribute as it is. Of several rows with one key the least is taken, so the
    lookup never multiplies events.
    """
    names = [f"_d{i}" for i in range(len(keys))]
    values = F.struct(*[F.col(a).cast("string").alias(a) for a in attributes])
    rows = (
        dim.select(*[k.alias(n) for n, (_, k) in zip(names, keys)], values.alias(_ATTRS))
        .groupBy(*names)
        .agg(F.min(_ATTRS).alias(_ATTRS))
        .withColumn(_HIT, F.lit(True))
    )
    found = reduce(and_, [equal(k, F.col(n)) for n, (k, _) in zip(names, keys)])
    kept = [c for c in df.columns if c not in attributes]
    return df.join(rows, found, "left").select(
        *[df[c] for c in kept],
        *[
            F.when(F.col(_HIT), F.col(f"{_ATTRS}.{a}")).otherwise(F.lit(UNKNOWN)).alias(a)
            for a in attributes
        ],
    )


def enrich_ad_position(df: DataFrame, dim: DataFrame) -> DataFrame:
    """Add ``Location`` and ``Size`` of the ad position."""
    keys = [(df["ad_position"], dim["ad_position"])]
    return _lookup(df, dim, keys, ["Location", "Size"])


def enrich_advertiser(df: DataFrame, dim: DataFrame) -> DataFrame:
    """Add ``advertiser``, ``exchange`` and ``campaign_id`` (text) of the ad."""
    keys = [(df["ad_id"].cast("string"), dim["ad_id"].cast("string"))]
    return _lookup(df, dim, keys, ["advertiser", "exchange", "campaign_id"])


def enrich_page(df: DataFrame, dim: DataFrame) -> DataFrame:
    """Add ``publisher`` and ``article`` of the page a publisher shows."""
    keys = [(none_text(df[k]), none_text(dim[k])) for k in PAGE_KEY]
    return _lookup(df, dim, keys, ["publisher", "article"], eq)


def _parsed_agent(agent: Column) -> list[Column]:
    return [
        first_browser(agent).alias("_browser"),
        first_os(agent).alias("_os"),
        device_model(agent).alias("_model"),
    ]


def _attributes(agent: Column) -> dict[str, Column]:
    """The seven columns, from an agent and what :func:`_parsed_agent` found."""
    browser, system, model = F.col("_browser"), F.col("_os"), F.col("_model")
    return {
        "Browser": rule_name(BROWSER_RULES, browser),
        "Browser_version": rule_version(agent, BROWSER_RULES, browser),
        "Client_OS": rule_name(OS_RULES, system),
        "Client_OS_Ver": rule_version(agent, OS_RULES, system),
        "Client_Device": F.coalesce(model, F.lit("Other")),
        "Client_Device_Brand": device_brand(model),
        "Client_Device_Model": model,
    }


def _browser_attributes(df: DataFrame) -> DataFrame:
    agent = F.col("user_agent")
    kept = [c for c in df.columns if c not in BROWSER_COLUMNS]
    parsed = df.select(*kept, *_parsed_agent(agent))
    return parsed.select(*kept, *[c.alias(n) for n, c in _attributes(agent).items()])


def build_user_agent_dim(events: DataFrame) -> DataFrame:
    """One row per user agent seen, with its seven attributes.

    Reads one column; agents repeat so much that the map-side distinct leaves
    almost nothing to shuffle, and the patterns run once per agent.
    """
    return _browser_attributes(events.select("user_agent").distinct())


def enrich_browser(df: DataFrame, ua_dim: DataFrame | None = None) -> DataFrame:
    """Add browser, operating system and device of the user agent.

    By native expressions on each row, which needs no shuffle at all; with
    ``ua_dim`` by lookup, agents it lacks being parsed after the join.
    """
    if ua_dim is None:
        return _browser_attributes(df)
    known = ua_dim.select(F.col("user_agent").alias("_ua"), F.struct(*BROWSER_COLUMNS).alias("_d"))
    known = known.groupBy("_ua").agg(F.min("_d").alias("_d"))
    kept = [c for c in df.columns if c not in BROWSER_COLUMNS]
    joined = df.select(*kept).join(known, F.col("user_agent").eqNullSafe(F.col("_ua")), "left")
    joined = joined.withColumn("_unseen", F.when(F.col("_d").isNull(), F.col("user_agent")))
    unseen = F.col("_unseen")
    parsed = joined.select(*kept, "_d", "_unseen", *_parsed_agent(unseen))
    return parsed.select(
        *kept,
        *[
            F.when(F.col("_d").isNotNull(), F.col(f"_d.{name}")).otherwise(value).alias(name)
            for name, value in _attributes(unseen).items()
        ],
    )


def enrich_events(df: DataFrame, dims: Dimensions) -> DataFrame:
    """All four lookups. With small dimensions they share one stage, unshuffled."""
    df = enrich_ad_position(df, dims.ad_position)
    df = enrich_advertiser(df, dims.advertiser)
    df = enrich_page(df, dims.page)
    return enrich_browser(df, dims.user_agent)
