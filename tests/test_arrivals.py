"""Late messages, windows of notices over several micro-batches, and announced files."""

import json
import time
from collections import Counter

import pytest

from adstream.session import scratch_path
from adstream.sources import events
from adstream.sources.dimensions import read_table
from adstream.sources.events import listed_sizes, owners, read_message_stream
from adstream.streaming.arrivals import accepted_stream, read_arrivals, start_arrivals
from adstream.streaming.ingest import start_notice_ingest
from adstream.streaming.pipeline import start_stream
from adstream.streaming.sinks import Sinks
from tests.rows import client_json, messages, server_json, values
from tests.test_streaming import notice, put_folder
from tests.test_tables import dims

NOW = {"availableNow": True}


@pytest.fixture
def root(spark):
    return scratch_path(spark, "arrivals")


def put(spark, root, side, rows):
    messages(spark, rows).write.mode("append").json(f"{root}/in/{side}")


def arriving(spark, root, *sides):
    return {side: read_message_stream(spark, "json", f"{root}/in/{side}") for side in sides}


def test_late_messages_are_kept_apart(spark, root):
    sinks = Sinks(f"{root}/out")
    for side in ("client", "server"):
        put(spark, root, side, [])
    query = start_arrivals(
        spark,
        arriving(spark, root, "client", "server"),
        sinks,
        f"{root}/c",
        "10 seconds",
        {"processingTime": "0 seconds"},
    )
    try:
        put(spark, root, "client", [(5, "a"), (165, "b")])
        query.processAllAvailable()
        # The server side has brought nothing: no window has closed.
        put(spark, root, "client", [(1, "c")])
        put(spark, root, "server", [(100, "x")])
        query.processAllAvailable()
        # Both have passed 100 less the delay: windows that end by then have closed.
        put(spark, root, "client", [(29, "late"), (60, "late too"), (90, "in time"), (None, "never")])
        put(spark, root, "server", [(89, "late"), (90, "in time"), (90, "in time")])
        query.processAllAvailable()
    finally:
        query.stop()
    got = read_arrivals(spark, sinks)
    assert Counter(map(tuple, got.where("late").select("side", "value").collect())) == Counter(
        [("client", "late"), ("client", "late too"), ("client", "never"), ("server", "late")]
    )
    assert values(got.where("NOT late"), "side", "value") == [
        ("client", "a"), ("client", "b"), ("client", "c"), ("client", "in time"),
        ("server", "in time"), ("server", "in time"), ("server", "x"),
    ]
    (closed,) = got.where("value = 'late too'").selectExpr("unix_timestamp(watermark)").first()
    assert closed == 90


def test_the_match_drops_no_accepted_message(spark, root):
    sinks = Sinks(f"{root}/out")
    for turn in (0, 2000, 1500, 4000, 100, 90_000):
        for side, text in (("client", client_json), ("server", server_json)):
            put(spark, root, side, [(turn + i, text(user_id=f"u{turn + i}")) for i in range(3)])
        sides = arriving(spark, root, "client", "server")
        start_arrivals(spark, sides, sinks, f"{root}/a", "20 minutes", NOW).awaitTermination()
        start_stream(
            spark,
            accepted_stream(spark, sinks, "client"),
            accepted_stream(spark, sinks, "server"),
            dims(spark),
            sinks,
            f"{root}/s",
            "20 minutes",
            trigger=NOW,
        ).awaitTermination()
    late = {json.loads(r.value)["user_id"] for r in read_arrivals(spark, sinks).where("late").collect()}
    assert late == {"u100", "u101", "u102"}
    stored = {r.user_id for r in read_table(spark, f"{root}/out", "Ad_impressions").collect()}
    assert stored == {f"u{t + i}" for t in (0, 1500, 2000, 4000) for i in range(3)}


def test_a_window_of_notices_over_several_micro_batches(spark, root, tmp_path):
    folders = {
        "20240101/00": ([client_json(user_id="a"), client_json(user_id="b")], []),
        "20240101/01": ([client_json(user_id="a")], [server_json(user_id="b")]),
        "20240101/02": ([client_json(user_id="c")], [server_json(user_id="a")]),
        "20240101/03": ([client_json(user_id="d")], [server_json(user_id=u) for u in "cd"]),
    }
    for folder, (client, server) in folders.items():
        put_folder(spark, tmp_path, folder, client, server)
    texts = [json.dumps(notice(tmp_path, folder)) for folder in folders]
    sinks = Sinks(f"{root}/out")
    # Window [0, 30) in three micro-batches, with one notice twice; its end; a late notice.
    turns = [[(1, texts[0])], [(12, texts[1]), (13, texts[0])], [(29, texts[2])], [(700, "{}")], [(29, texts[3])]]
    for turn, rows in enumerate(turns):
        put(spark, root, "notice", rows)
        sides = arriving(spark, root, "notice")
        start_arrivals(spark, sides, sinks, f"{root}/a", trigger=NOW).awaitTermination()
        # The job starts anew for each micro-batch and finds the notices it held.
        start_notice_ingest(
            spark, accepted_stream(spark, sinks, "notice"), dims(spark), sinks, f"{root}/n",
            trigger=NOW, scope=("window",),
        ).awaitTermination()
        if turn < 3:
            with pytest.raises(Exception, match="PATH_NOT_FOUND"):
                read_table(spark, f"{root}/out", "Ad_impressions")
    stored = read_table(spark, f"{root}/out", "Ad_impressions")
    assert values(stored, "user_id") == [("a",), ("b",)]
    assert spark.read.text(f"{root}/out/cleanup").count() == 3
    assert values(read_arrivals(spark, sinks).where("late"), "value") == [(texts[3],)]


def test_a_file_is_found_by_its_folders(monkeypatch):
    announced = [f"/data/d{i:03}/client.json" for i in range(256)] + ["s3://b/x", "/data/d007", "/data/d00"]
    files = [f"file:///data/d{i:03}/client.json/part-{k}" for i in range(256) for k in range(1000)]
    calls = []
    place = events._place
    monkeypatch.setattr(events, "_place", lambda address: calls.append(1) or place(address))
    begun = time.perf_counter()
    found = list(owners([*files, "s3://b/x/y%20z", "s3://c/x", "file:/data/other"], announced))
    assert time.perf_counter() - begun < 20
    # Each address is taken apart once, whatever the number of announced paths.
    assert len(calls) == len(files) + 3 + len(announced)
    assert len(found) == len(files) + 1000 + 1
    assert ("s3://b/x/y%20z", "s3://b/x") in found
    assert {path for _, path in found} == set(announced) - {"/data/d00"}


def test_sizes_are_listed_in_tasks(spark, tmp_path):
    for name, texts in {"a b/one.json": ["xy"], "c/part": ["1", "234"], "empty": []}.items():
        (tmp_path / name).mkdir(parents=True)
        for i, text in enumerate(texts):
            (tmp_path / name / f"f{i}").write_text(text)
    (tmp_path / "single").write_text("12345")
    paths = [f"{tmp_path}/{n}" for n in ("a b/one.json", "c", "empty", "single")] + [f"file:{tmp_path}/c/part"]
    got = {(r.path, r.files, r.bytes) for r in listed_sizes(spark, paths).collect()}
    assert got == {
        (f"{tmp_path}/a b/one.json", 1, 2), (f"{tmp_path}/c", 2, 4),
        (f"file:{tmp_path}/c/part", 2, 4), (f"{tmp_path}/single", 1, 5),
    }


def test_missing_files_are_found_by_halving(spark, root, tmp_path):
    from adstream.streaming.ingest import ingest_folders

    for hour in range(6):
        if hour not in (1, 4):
            put_folder(spark, tmp_path, f"20240101/0{hour}", [client_json()], [server_json()])
    notices = spark.createDataFrame([notice(tmp_path, f"20240101/0{i}") for i in range(6)])
    ingest_folders(spark, notices, dims(spark), Sinks(f"{root}/out"), 0)
    assert read_table(spark, f"{root}/out", "Ad_impressions").count() == 4
    lost = spark.read.parquet(f"{root}/out/quarantine").where("side = 'missing'").collect()
    assert {json.loads(r.value)["folder_path"] for r in lost} == {"20240101/01", "20240101/04"}


def test_names_with_percent_signs(spark, root, tmp_path):
    from adstream.streaming.ingest import ingest_folders

    put_folder(spark, tmp_path, "20240101/a%20b c", [client_json()], [server_json()])
    notices = spark.createDataFrame([notice(tmp_path, "20240101/a%20b c")])
    ingest_folders(spark, notices, dims(spark), Sinks(f"{root}/out"), 0)
    assert read_table(spark, f"{root}/out", "Ad_impressions").count() == 1
