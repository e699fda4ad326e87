import datetime

from adstream.operators.project import to_ad_impressions, to_ad_impressions_invalid
from adstream.operators.users import absent_users, backfill_web_users
from adstream.operators.validate import validate_client_events
from adstream.plans.batch import process_matched
from adstream.schemas import (
    AD_IMPRESSIONS,
    AD_IMPRESSIONS_INVALID,
    AD_POSITION,
    ADVERTISER,
    PAGE,
    TABLES,
    WEB_USERS,
    create_tables,
)
from adstream.sources.dimensions import Dimensions, read_dimensions, read_table
from adstream.streaming.sinks import append_web_users
from tests.rows import clients, values


def dims(spark):
    return Dimensions(
        spark.createDataFrame([("LTOP1", "Left", "1x1")], AD_POSITION),
        spark.createDataFrame([(400, "Acme", "E", 77, "s")], ADVERTISER),
        spark.createDataFrame([(123, "TECH_5", "Pub", "art")], PAGE),
    )


def test_impressions_have_the_stored_shape(spark):
    got = process_matched(clients(spark, {}, {"ad_id": "abc"}), dims(spark)).impressions
    assert [(f.name, f.dataType) for f in got.schema] == [
        (f.name, f.dataType) for f in AD_IMPRESSIONS
    ]
    rows = {r.advertiser: r for r in got.collect()}
    assert rows["Acme"].ad_id == 400 and rows["Acme"].campaign_id == 77
    assert rows["Acme"].timestamp == datetime.datetime(1970, 1, 1, 0, 1, 40)
    assert rows["Unknown"].ad_id is None and rows["Unknown"].campaign_id is None


def test_invalid_rows_have_the_stored_shape(spark):
    got = process_matched(clients(spark, {"ctimestamp": None, "latency": "x"}), dims(spark)).invalid
    assert got.columns == AD_IMPRESSIONS_INVALID.names
    row = got.first()
    assert (row.latency, row.timestamp, row.invalid_field) == (None, None, "ctimestamp")


def test_absurd_client_times_are_stored_as_null(spark):
    times = ["soon", "9223372036854775807", "99999999999999999999", "-99999999999999", "1.5"]
    df = clients(spark, *[{"ctimestamp": t} for t in times])
    stored = process_matched(df, dims(spark)).impressions
    assert values(stored.distinct(), "timestamp") == [(None,)] and stored.count() == len(times)


def test_extra_columns(spark):
    df = validate_client_events(clients(spark)).selectExpr("*", "'20240101' AS day")
    assert to_ad_impressions_invalid(df, "day").columns[-1] == "day"
    enriched = process_matched(df, dims(spark)).enriched
    assert to_ad_impressions(enriched, "day").columns[-1] == "day"


def impressions(spark, users):
    row = {n: None for n in AD_IMPRESSIONS.names}
    rows = [tuple({**row, "user_id": u}.values()) for u in users]
    return spark.createDataFrame(rows, AD_IMPRESSIONS)


def users(spark, names):
    return spark.createDataFrame([(n, 1, "X", "F", "S", 1) for n in names], WEB_USERS)


def test_backfill(spark):
    seen = impressions(spark, ["b", "a", "a", None, "c"])
    got = backfill_web_users(seen, users(spark, ["c", None]))
    assert values(got, *got.columns) == [
        ("a", 37, "USA", "MALE", "MARRIED", 50000),
        ("b", 37, "USA", "MALE", "MARRIED", 50000),
        (None, 37, "USA", "MALE", "MARRIED", 50000),
    ]
    assert got.schema == WEB_USERS or got.columns == WEB_USERS.names
    assert backfill_web_users(seen, users(spark, ["c"]), limit=2).count() == 2
    assert values(absent_users(seen, users(spark, ["a", "b"])), "user_id") == [("c",), (None,)]


def test_backfill_runs_once(spark, tmp_path):
    root = str(tmp_path)
    stored = impressions(spark, ["a", "b", None]).selectExpr("*", "'20240101' AS day")
    stored.write.partitionBy("day").parquet(f"{root}/Ad_impressions")
    users(spark, ["a"]).write.parquet(f"{root}/WebUsers")
    for _ in range(2):
        rows = backfill_web_users(
            read_table(spark, root, "Ad_impressions"), read_table(spark, root, "WebUsers")
        )
        append_web_users(rows, f"{root}/WebUsers")
    assert values(read_table(spark, root, "WebUsers"), "user_id", "Age") == [
        ("a", 1),
        ("b", 37),
        (None, 37),
    ]


def test_days_are_pruned(spark, tmp_path):
    for day in ("20240101", "20240102", "20240103"):
        rows = impressions(spark, [day]).selectExpr("*", f"'{day}' AS day", "0 AS batch_id")
        rows.write.mode("append").partitionBy("day", "batch_id").parquet(f"{tmp_path}/Ad_impressions")
    some = read_table(spark, str(tmp_path), "Ad_impressions", since="20240102", until="20240102")
    assert values(some, "user_id") == [("20240102",)] and some.columns == AD_IMPRESSIONS.names
    plan = some._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(day" in plan


def test_tables_can_be_used_from_sql(spark, tmp_path):
    create_tables(spark, str(tmp_path), "ads")
    create_tables(spark, str(tmp_path), "ads")
    assert {t.name.lower() for t in spark.catalog.listTables("ads")} == {n.lower() for n in TABLES}
    for name, schema in TABLES.items():
        found = spark.table(f"ads.{name}").schema.fields
        assert [(f.name, f.dataType) for f in found[: len(schema)]] == [
            (f.name, f.dataType) for f in schema
        ]
    rows = impressions(spark, ["a", "b", "b"])
    rows.selectExpr("*", "'20240101'", "'sql'", "'r'", "0L", "0").write.insertInto("ads.Ad_impressions")
    users(spark, ["a"]).write.insertInto("ads.WebUsers")
    missing = backfill_web_users(spark.table("ads.Ad_impressions"), spark.table("ads.WebUsers"))
    missing.write.insertInto("ads.WebUsers")
    assert values(spark.table("ads.WebUsers"), "user_id", "Age") == [("a", 1), ("b", 37)]


def test_dimensions_are_read_by_name(spark, tmp_path):
    given = dims(spark)
    given.ad_position.write.parquet(f"{tmp_path}/Ad_position")
    given.advertiser.write.parquet(f"{tmp_path}/Advertiser")
    given.page.write.parquet(f"{tmp_path}/Page")
    found = read_dimensions(spark, str(tmp_path))
    assert found.advertiser.first() == given.advertiser.first()
    assert process_matched(clients(spark), found).impressions.first().publisher == "Pub"
