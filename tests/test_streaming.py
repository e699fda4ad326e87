import json

import pytest

from adstream.functions.jsontext import parse_events
from adstream.operators.match import assign_window, match_events
from adstream.plans.batch import process_matched
from adstream.schemas import CLIENT_EVENT, create_tables
from adstream.session import scratch_path
from adstream.sources.dimensions import read_table
from adstream.sources.events import read_message_stream
from adstream.streaming.ingest import ingest_folders, start_notice_ingest
from adstream.streaming.pipeline import (
    matched_stream,
    start_quarantine,
    start_stream,
    watch_late,
)
from adstream.streaming.sinks import PARTITIONS, Sinks, Write, write_partitions
from tests.rows import client_json, messages, server_json, values
from tests.test_tables import dims

NOW = {"availableNow": True}
END = [(10_000, "{}")]


@pytest.fixture
def root(spark):
    return scratch_path(spark, "test")


def put(spark, root, side, rows):
    messages(spark, rows).coalesce(1).write.mode("append").json(f"{root}/in/{side}")


def begin(spark, root, dimensions=None, trigger=NOW, checkpoint="checkpoint", delay="0 seconds"):
    return start_stream(
        spark,
        read_message_stream(spark, "json", f"{root}/in/client"),
        read_message_stream(spark, "json", f"{root}/in/server"),
        dimensions or dims(spark),
        Sinks(f"{root}/out"),
        f"{root}/{checkpoint}",
        delay=delay,
        trigger=trigger,
    )


def run(spark, root, **options):
    begin(spark, root, **options).awaitTermination()


@pytest.fixture
def live(spark, root):
    """Feed a running job in steps: ``live(client=rows, server=rows)``."""
    for side in ("client", "server"):
        put(spark, root, side, [])
    query = begin(spark, root, trigger={"processingTime": "0 seconds"})

    def step(**sides):
        for side, rows in sides.items():
            put(spark, root, side, rows)
        query.processAllAvailable()

    yield step
    query.stop()


def stored(spark, root, name="Ad_impressions"):
    return read_table(spark, f"{root}/out", name)


def view(second, user, **changes):
    return (
        [(second, client_json(user_id=user, **changes))],
        [(second, server_json(user_id=user))],
    )


def test_stream_equals_batch_over_several_micro_batches(spark, root):
    rows = {"client": [], "server": []}
    for i in range(60):
        client, server = view(i * 7, f"u{i % 9}", latency=i)
        rows["client"] += client if i % 5 else client * 2
        rows["server"] += server if i % 4 else []
    # The query is stopped and resumed between the parts.
    for part in range(2):
        for side, all_rows in rows.items():
            half = [r for r in all_rows if r[0] // 210 == part]
            put(spark, root, side, half + (END if part else []))
        run(spark, root)
    sides = {
        side: assign_window(parse_events(messages(spark, r), side)) for side, r in rows.items()
    }
    batch = process_matched(match_events(sides["client"], sides["server"]), dims(spark))
    columns = batch.impressions.columns
    expected = values(batch.impressions, *columns)
    assert len(expected) > 30
    assert values(stored(spark, root), *columns) == expected


def test_window_closes_when_both_sides_have_passed_it(spark, root, live):
    client, server = view(5, "a")
    live(client=client + [(29, client_json(user_id="z"))], server=server)
    # Only one side has moved on: its window may still receive the other's rows.
    live(client=END)
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        stored(spark, root)
    live(server=END)
    assert values(stored(spark, root), "user_id") == [("a",)]


def test_slow_side_still_matches_and_late_rows_are_dropped(spark, root, live):
    live(
        client=view(5, "a")[0] + [(65, client_json(user_id="b"))],
        server=[(1, server_json(user_id="x"))],
    )
    # The client side is a minute ahead; the server record arrives now.
    live(server=view(5, "a")[1] + [(65, server_json(user_id="b"))])
    # Both sides have passed the first window: a pair for it is late.
    client, server = view(6, "late")
    live(client=client, server=server)
    live(client=END, server=END)
    assert values(stored(spark, root), "user_id") == [("a",), ("b",)]


def test_outputs_of_one_stream(spark, root):
    put(
        spark,
        root,
        "client",
        [
            (1, client_json(user_id="ok")),
            (1, client_json(user_id="bad", clicked="unknown")),
            (1, client_json(user_id="null", latency=None)),
            (1, "{broken"),
            *END,
        ],
    )
    put(spark, root, "server", [(2, server_json(user_id=u)) for u in ("ok", "bad", "null")] + END)
    run(spark, root)
    assert values(stored(spark, root), "user_id", "campaign_id") == [("ok", 77)]
    invalid = stored(spark, root, "Ad_impressions_Invalid")
    assert values(invalid, "user_id", "validity_status", "invalid_field") == [
        ("bad", "Invalid due to Data type", "clicked"),
        ("null", "Invalid due to null", "latency"),
    ]
    feed = spark.read.format("text").load(f"{root}/out/feed")
    validated = [json.loads(r.value) for r in feed.where("feed = 'validated'").collect()]
    assert {r["user_id"] for r in validated} == {"ok", "bad", "null"}
    assert list(validated[0]) == [*CLIENT_EVENT.names, "validity_status", "invalid_field"]
    (enriched,) = [json.loads(r.value) for r in feed.where("feed = 'enriched'").collect()]
    assert (enriched["ad_id"], enriched["campaign_id"], enriched["Browser"]) == (400, 77, "Other")
    assert enriched["Client_Device_Model"] is None

    query = start_quarantine(
        read_message_stream(spark, "json", f"{root}/in/client"),
        "client",
        Sinks(f"{root}/out"),
        f"{root}/checkpoint_quarantine",
        NOW,
    )
    query.awaitTermination()
    kept = spark.read.parquet(f"{root}/out/quarantine")
    assert values(kept, "value", "side") == [("{broken", "client")]


def test_dimensions_can_be_read_per_micro_batch(spark, root):
    calls = []

    def reader():
        calls.append(1)
        return dims(spark)

    for side, rows in zip(("client", "server"), view(5, "a")):
        put(spark, root, side, rows + END)
    run(spark, root, dimensions=reader)
    assert calls and values(stored(spark, root), "advertiser") == [("Acme",)]


def test_replayed_batch_leaves_one_copy(spark, root):
    df = spark.range(10).selectExpr("id", "'20240101' AS day")
    for _ in range(2):
        write_partitions(df, f"{root}/t", Write("stream", "r", 3), PARTITIONS)
    write_partitions(df, f"{root}/t", Write("stream", "r", 4), PARTITIONS, mixed=True)
    write_partitions(df, f"{root}/t", Write("batch", "r", 3), PARTITIONS)
    write_partitions(df, f"{root}/t", Write("stream", "other", 3), PARTITIONS)
    write_partitions(df, f"{root}/t", Write("stream", "r", 3, part=1), PARTITIONS)
    assert spark.read.parquet(f"{root}/t").count() == 50


def test_a_new_checkpoint_keeps_what_is_stored(spark, root):
    for i, user in enumerate("ab"):
        for side, rows in zip(("client", "server"), view(5, user)):
            messages(spark, rows + END + [(1, "{x")]).coalesce(1).write.mode("overwrite").json(
                f"{root}/in/{side}"
            )
        run(spark, root, checkpoint=f"checkpoint{i}")
        query = start_quarantine(
            read_message_stream(spark, "json", f"{root}/in/client"),
            "client",
            Sinks(f"{root}/out"),
            f"{root}/bad{i}",
            NOW,
        )
        query.awaitTermination()
    assert values(stored(spark, root), "user_id") == [("a",), ("b",)]
    assert spark.read.text(f"{root}/out/feed").count() == 4
    assert spark.read.parquet(f"{root}/out/quarantine").count() == 2


def test_rows_within_the_delay_are_matched_and_later_ones_counted(spark, root):
    listener = watch_late(spark, Sinks(f"{root}/out"))
    try:
        for turn in (view(5, "a"), view(2000, "b"), view(1500, "c"), view(9000, "d"), view(10, "late")):
            for side, rows in zip(("client", "server"), turn):
                put(spark, root, side, rows)
            run(spark, root, delay="20 minutes")
        for side in ("client", "server"):
            put(spark, root, side, [(90_000, "{}")])
        run(spark, root, delay="20 minutes")
        assert values(stored(spark, root), "user_id") == [("a",), ("b",), ("c",), ("d",)]
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(30_000)
        assert spark.read.parquet(f"{root}/out/late_rows").agg({"dropped": "sum"}).first()[0] >= 1
    finally:
        spark.streams.removeListener(listener)


def test_stream_state_is_one_aggregation(spark, root):
    for side in ("client", "server"):
        put(spark, root, side, END)
    matched = matched_stream(
        read_message_stream(spark, "json", f"{root}/in/client"),
        read_message_stream(spark, "json", f"{root}/in/server"),
    )
    query = (
        matched.writeStream.format("noop")
        .option("checkpointLocation", f"{root}/c")
        .trigger(**NOW)
        .start()
    )
    query.awaitTermination()
    progress = [p for p in query.recentProgress if p["stateOperators"]]
    assert progress and len(progress[-1]["stateOperators"]) == 1


def test_text_stream_takes_arrival_from_the_file(spark, root):
    spark.createDataFrame([(client_json(),)], "value string").write.text(f"{root}/lines")
    lines = read_message_stream(spark, "text", f"{root}/lines")
    query = (
        parse_events(lines, "client")
        .writeStream.format("parquet")
        .option("checkpointLocation", f"{root}/c")
        .option("path", f"{root}/o")
        .trigger(**NOW)
        .start()
    )
    query.awaitTermination()
    row = spark.read.parquet(f"{root}/o").first()
    assert row.user_id == "u1" and row.publish_ts is not None


def put_folder(spark, bucket, folder, client, server):
    import os

    os.makedirs(f"{bucket}/{folder}")
    for name, lines in (("client_events.json", client), ("server_events.json", server)):
        with open(f"{bucket}/{folder}/{name}", "w") as out:
            out.write("\n".join(lines) + "\n")


def notice(bucket, folder):
    return {
        "bucket": str(bucket),
        "data_frequency": "hourly",
        "folder_path": folder,
        "server_events_file": "server_events.json",
        "client_events_file": "client_events.json",
    }


def test_announced_folders(spark, root, tmp_path):
    put_folder(
        spark,
        tmp_path,
        "20240101/00",
        [client_json(user_id="a"), client_json(user_id="a"), client_json(user_id="b"), "oops"],
        [server_json(user_id="a")],
    )
    # The same key in another folder is another view; b's record is elsewhere.
    put_folder(
        spark,
        tmp_path,
        "20240101/01",
        [client_json(user_id="a"), client_json(user_id="c", clicked=None)],
        [server_json(user_id=u) for u in "abc"],
    )
    texts = [json.dumps(notice(tmp_path, f"20240101/0{i}")) for i in (0, 1)]
    put(spark, root, "notices", [(0, t) for t in [*texts, texts[0], "no notice"]])
    sinks = Sinks(f"{root}/out")
    query = start_notice_ingest(
        spark,
        read_message_stream(spark, "json", f"{root}/in/notices"),
        dims(spark),
        sinks,
        f"{root}/checkpoint",
        trigger=NOW,
    )
    query.awaitTermination()
    assert values(stored(spark, root), "user_id") == [("a",), ("a",)]
    invalid = stored(spark, root, "Ad_impressions_Invalid")
    assert values(invalid, "user_id", "invalid_field") == [("c", "clicked")]
    kept = spark.read.parquet(f"{root}/out/quarantine")
    assert values(kept, "value", "side") == [("no notice", "notice"), ("oops", "client")]
    assert values(kept.where("side = 'client'"), "hour") == [("00",)]
    done = spark.read.text(f"{root}/out/cleanup")
    assert {tuple(json.loads(r.value)) for r in done.collect()} == {
        ("foldername", f"{tmp_path}/20240101/0{i}") for i in (0, 1)
    }
    days = spark.read.parquet(f"{root}/out/Ad_impressions")
    found = values(days, "day", "source", "run", "batch_id", "part")
    assert set(found) == {(20240101, "batch", query.id, 0, 0)}


def test_replayed_ingest_leaves_one_copy(spark, root, tmp_path):
    put_folder(spark, tmp_path, "20240101/00", [client_json()], [server_json()])
    notices = spark.createDataFrame([notice(tmp_path, "20240101/00")])
    for _ in range(2):
        ingest_folders(spark, notices, dims(spark), Sinks(f"{root}/out"), 7)
    assert stored(spark, root).count() == 1
    assert spark.read.text(f"{root}/out/cleanup").count() == 1


def test_both_jobs_fill_the_same_tables(spark, root, tmp_path):
    put_folder(spark, tmp_path, "20240101/00", [client_json()], [server_json()])
    notices = spark.createDataFrame([notice(tmp_path, "20240101/00")])
    ingest_folders(spark, notices, dims(spark), Sinks(f"{root}/out"), 0)
    for side, rows in zip(("client", "server"), view(5, "a")):
        put(spark, root, side, rows + END)
    run(spark, root)
    both = spark.read.parquet(f"{root}/out/Ad_impressions")
    assert values(both, "user_id", "source") == [("a", "stream"), ("u1", "batch")]
    create_tables(spark, f"{root}/out", "stored")
    from_sql = spark.sql("SELECT user_id, campaign_id FROM stored.Ad_impressions")
    assert values(from_sql, *from_sql.columns) == [("a", 77), ("u1", 77)]


def test_missing_folder_stops_no_other(spark, root, tmp_path):
    put_folder(spark, tmp_path, "20240101/00", [client_json()], [server_json()])
    folders = [notice(tmp_path, f"20240101/{hour}") for hour in ("00", "09")]
    notices = spark.createDataFrame(folders)
    ingest_folders(spark, notices, dims(spark), Sinks(f"{root}/out"), 0)
    assert stored(spark, root).count() == 1
    (done,) = spark.read.text(f"{root}/out/cleanup").collect()
    assert json.loads(done.value) == ["foldername", f"{tmp_path}/20240101/00"]
    (lost,) = spark.read.parquet(f"{root}/out/quarantine").collect()
    assert lost.side == "missing" and json.loads(lost.value)["folder_path"] == "20240101/09"


def test_folders_of_any_layout(spark, root, tmp_path):
    # Announced files may be folders, and need not lie below a day and an hour.
    for name, lines in (("client_events.json", client_json()), ("server_events.json", server_json())):
        df = spark.createDataFrame([(lines,)], "value string")
        df.write.text(f"{tmp_path}/2024-01-01_05/{name}")
    notices = spark.createDataFrame([notice(tmp_path, "2024-01-01_05")])
    notices = notices.selectExpr("*", "timestamp '2024-01-02 00:00:00' AS publish_ts")
    ingest_folders(spark, notices, dims(spark), Sinks(f"{root}/out"), 0)
    assert values(spark.read.parquet(f"{root}/out/Ad_impressions"), "day") == [(20240102,)]


def test_notices_go_in_slices_and_scopes(spark, root, tmp_path):
    put_folder(spark, tmp_path, "20240101/00", [client_json(user_id="a")], [])
    put_folder(spark, tmp_path, "20240101/01", [client_json(user_id="b")], [server_json(user_id="a")])
    rows = [notice(tmp_path, f"20240101/0{i}") for i in (0, 1)]
    notices = spark.createDataFrame(rows)
    notices = notices.selectExpr("*", "timestamp '2024-01-02 00:00:05' AS publish_ts")
    for name, scope, files in (("folder", ("folder_path",), 1), ("window", ("window",), 3)):
        sinks = Sinks(f"{root}/{name}")
        ingest_folders(spark, notices, dims(spark), sinks, 0, scope=scope, slice_files=files)
        assert spark.read.text(f"{root}/{name}/cleanup").count() == 2
    assert read_table(spark, f"{root}/folder", "Ad_impressions").count() == 0
    assert values(spark.read.parquet(f"{root}/window/Ad_impressions"), "user_id") == [("a",)]


def test_a_window_is_matched_over_all_slices(spark, root, tmp_path):
    beacons = [client_json(user_id="a"), client_json(user_id="b")]
    put_folder(spark, tmp_path, "20240101/00", beacons, [])
    put_folder(spark, tmp_path, "20240101/01", beacons[:1], [server_json(user_id="b"), "oops"])
    put_folder(spark, tmp_path, "20240101/02", [], [server_json(user_id="a")])
    rows = [notice(tmp_path, f"20240101/0{i}") for i in (0, 1, 2, 9)]
    notices = spark.createDataFrame(rows)
    notices = notices.selectExpr("*", "timestamp '2024-01-02 00:00:05' AS publish_ts")
    sinks = Sinks(f"{root}/out")
    for _ in range(2):  # the second is a replay
        ingest_folders(
            spark, notices, dims(spark), sinks, 0, scope=("window",), listed=3, slice_bytes=1
        )
        assert values(spark.read.parquet(f"{root}/out/Ad_impressions"), "user_id") == [("a",), ("b",)]
        assert spark.read.text(f"{root}/out/cleanup").count() == 3
        kept = spark.read.parquet(f"{root}/out/quarantine")
        # An empty line of each side, one that does not decode, and the missing notice.
        assert values(kept, "side") == [("client",), ("missing",), ("server",), ("server",)]


def test_file_layouts(spark):
    from adstream.sources.events import hour_folder

    paths = [
        "file:/b/20240101/07/client_events.json",
        "s3://b/day=20240101/hour=07/file=client_events.json/part-0",
        "file:/b/other/client_events.json",
    ]
    got = hour_folder(spark.createDataFrame([(p,) for p in paths], "path string"))
    assert values(got, "folder_path", "day", "hour") == [
        ("file:/b/20240101/07", "20240101", "07"),
        ("file:/b/other", None, None),
        ("s3://b/day=20240101/hour=07", "20240101", "07"),
    ]
