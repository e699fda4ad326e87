"""Compaction of closed days, and jobs that read only what is new."""

import json

import pytest
from pyspark.sql import functions as F

from adstream.operators.users import backfill_web_users
from adstream.plans import compact, incremental, reports
from adstream.schemas import AD_IMPRESSIONS, AD_IMPRESSIONS_INVALID, WEB_USERS
from adstream.session import scratch_path
from adstream.sources.dimensions import read_table
from adstream.sources.stored import folders, published, read_folders, uncovered
from adstream.streaming.ingest import ingest_folders
from adstream.streaming.sinks import PARTITIONS, Sinks, Write, read_accounts, write_partitions
from tests.rows import client_json, server_json, values
from tests.test_streaming import notice, put_folder
from tests.test_tables import dims
from workload import queries


@pytest.fixture
def root(spark):
    return scratch_path(spark, "stored")


def put(spark, root, day, batch_id, users, name="Ad_impressions", **changes):
    schema = AD_IMPRESSIONS if name == "Ad_impressions" else AD_IMPRESSIONS_INVALID
    rows = []
    for i, user in enumerate(users):
        row = dict.fromkeys(schema.names)
        row.update(user_id=user, ad_id=i, clicked="yes" if i % 3 == 0 else "no", page_id=f"p{i % 2}")
        rows.append(tuple({**row, **{k: v for k, v in changes.items() if k in row}}.values()))
    df = spark.createDataFrame(rows, schema).withColumn("day", F.lit(day))
    write_partitions(df, f"{root}/{name}", Write("stream", "r", batch_id), PARTITIONS)


def users(spark, root, **days):
    return [u for (u,) in values(read_table(spark, root, "Ad_impressions", **days), "user_id")]


def files_of(df):
    return {f.split("/Ad_impressions/")[-1].split("/source")[0] for f in df.inputFiles()}


def test_rows_are_seen_once_before_during_and_after_compaction(spark, root):
    for batch_id, day in enumerate(("20240101", "20240101", "20240102", "20240103")):
        put(spark, root, day, batch_id, [f"u{batch_id}", None])
    before = users(spark, root)
    # A run that dies before it publishes changes nothing.
    assert compact.rewrite(spark, root, "Ad_impressions", "20240103") is not None
    assert users(spark, root) == before and published(spark, root, "Ad_impressions").count() == 0
    assert compact.compact_days(spark, root, "Ad_impressions", "20240103") == ["20240101", "20240102"]
    assert users(spark, root) == before
    assert users(spark, root, since="20240102", until="20240102") == ["u2", None]
    read = read_table(spark, root, "Ad_impressions").inputFiles()
    assert any("_compacted" in f for f in read)
    # Nothing is left to do; late rows of a closed day come beside its copy, and into the next one.
    assert compact.compact_days(spark, root, "Ad_impressions", "20240103") == []
    put(spark, root, "20240101", 9, ["late"])
    after = sorted([*before, "late"], key=repr)
    assert sorted(users(spark, root), key=repr) == after
    assert [r.folder for r in uncovered(spark, root, "Ad_impressions", ["20240101"]).collect()] == [
        "source=stream/run=r/batch_id=9/part=0"
    ]
    assert compact.compact_days(spark, root, "Ad_impressions", "20240102") == ["20240101"]
    assert sorted(users(spark, root), key=repr) == after
    (row,) = published(spark, root, "Ad_impressions").where("day = '20240101'").collect()
    assert (row.seq, len(row.covered)) == (2, 3)


def test_a_replay_after_compaction_leaves_one_copy(spark, root):
    put(spark, root, "20240101", 0, ["a"])
    compact.compact_days(spark, root, "Ad_impressions", "20240102")
    put(spark, root, "20240101", 0, ["a"])
    assert users(spark, root) == ["a"]


def test_copies_are_sorted_and_sized(spark, root):
    put(spark, root, "20240101", 0, [f"u{i}" for i in range(3000)], advertiser=None)
    put(spark, root, "20240101", 1, [f"v{i}" for i in range(3000)], advertiser="A")
    compact.compact_days(spark, root, "Ad_impressions", "20240102", file_bytes=20_000)
    read = read_table(spark, root, "Ad_impressions")
    files = [f for f in read.inputFiles() if "_compacted" in f]
    assert 1 < len(files) < 20 and read.count() == 6000
    for file in files:
        found = [r.advertiser for r in spark.read.parquet(file).collect()]
        assert found == sorted(found, key=lambda a: (a is not None, a))


def test_a_second_copy_is_sized_by_all_its_rows(spark, root):
    for batch_id, name in enumerate("ABCD"):
        put(spark, root, "20240101", batch_id, [f"{name}{i}" for i in range(3000)], advertiser=name)
    for late in (8, 9):
        compact.compact_days(spark, root, "Ad_impressions", "20240102", file_bytes=20_000)
        put(spark, root, "20240101", late, [f"late{late}"])
    read = read_table(spark, root, "Ad_impressions")
    assert 1 < len([f for f in read.inputFiles() if "_compacted" in f]) < 20
    assert read.count() == 12002
    (row,) = published(spark, root, "Ad_impressions").collect()
    assert (row.seq, len(row.covered)) == (2, 5)


def compacted(spark, root, monkeypatch):
    """The registered query over a table of the ingest below ``root``, and where it compacts."""
    monkeypatch.setattr(queries, "_ingested", lambda spark, sf: root)
    monkeypatch.setattr(queries, "scratch_path", lambda spark, name: f"{root}/{name}")
    found = queries.impressions_after_compaction(spark, "no tables")
    return values(found, "user_id", "ad_id"), f"{root}/compaction"


def test_the_query_compacts_a_day_twice_and_rows_come_after(spark, root, monkeypatch):
    for batch_id, day in enumerate(("20240101", "20240101", "20240102", "20240103")):
        put(spark, f"{root}/out", day, batch_id, [f"{day}_{i}" for i in range(100)])
    rows, place = compacted(spark, root, monkeypatch)
    assert rows == values(read_table(spark, f"{root}/out", "Ad_impressions"), "user_id", "ad_id")
    copies = published(spark, place, "Ad_impressions").collect()
    assert {r.day: (r.seq, {f.split("/")[1] for f in r.covered}) for r in copies} == {"20240101": (2, {"run=r", "run=later0"}), "20240102": (1, {"run=r"})}
    beside = uncovered(spark, place, "Ad_impressions").collect()
    assert {(r.day, r.folder.split("/")[1]) for r in beside} == {("20240101", "run=later1"), ("20240103", "run=r")}


def test_the_query_has_the_rows_of_a_table_of_one_day_once(spark, root, monkeypatch):
    put(spark, f"{root}/out", "20240101", 0, [f"u{i}" for i in range(100)])
    rows, place = compacted(spark, root, monkeypatch)
    assert len(rows) == len(set(rows)) == 100 and published(spark, place, "Ad_impressions").count() == 0


def test_readers_do_without_removed_folders(spark, root, tmp_path):
    root = f"{tmp_path}/moved"
    put(spark, root, "20240101", 0, ["a"])
    compact.compact_days(spark, root, "Ad_impressions", "20240102")
    put(spark, root, "20240102", 1, ["b"])
    (message,) = compact.superseded(spark, root, "Ad_impressions").collect()
    kind, folder = json.loads(message.value)
    assert kind == "foldername" and folder.endswith("day=20240101/source=stream/run=r/batch_id=0/part=0")
    # The same table as if another service had removed what the message names.
    kept = f"{tmp_path}/kept"
    put(spark, kept, "20240102", 1, ["b"])
    spark.read.parquet(f"{root}/_compacted/Ad_impressions/published").write.parquet(
        f"{kept}/_compacted/Ad_impressions/published"
    )
    (version,) = [r.version for r in published(spark, root, "Ad_impressions").collect()]
    copy = f"_compacted/Ad_impressions/versions/version={version}"
    spark.read.parquet(f"{root}/{copy}").write.partitionBy("day").parquet(f"{kept}/{copy}")
    assert users(spark, kept) == ["a", "b"]
    rows, _ = incremental.unmarked(spark, kept, "Ad_impressions", "x")
    new = incremental.new_rows(spark, kept, "Ad_impressions", rows)
    assert values(new, "user_id") == [("a",), ("b",)]


def test_both_append_tables_are_compacted(spark, root):
    put(spark, root, "20240101", 0, ["a", "b"], "Ad_impressions_Invalid", invalid_field="clicked")
    compact.compact_days(spark, root, "Ad_impressions_Invalid", "20240102")
    stored = read_table(spark, root, "Ad_impressions_Invalid")
    assert values(stored, "user_id", "invalid_field") == [("a", "clicked"), ("b", "clicked")]


def people(spark, root):
    return [u for (u,) in values(read_table(spark, root, "WebUsers"), "user_id")]


def test_backfill_reads_only_new_folders(spark, root):
    spark.createDataFrame([("a", 1, "X", "F", "S", 2)], WEB_USERS).write.parquet(f"{root}/WebUsers")
    put(spark, root, "20240101", 0, ["a", "b", "b", None])
    incremental.backfill_new_users(spark, root)
    assert people(spark, root) == ["a", "b", None]
    put(spark, root, "20240102", 1, ["c", "b", None])
    fresh, run = incremental.unmarked(spark, root, "Ad_impressions", "backfill")
    assert run == 2
    assert files_of(read_folders(spark, root, "Ad_impressions", fresh.collect())) == {"day=20240102"}
    incremental.backfill_new_users(spark, root)
    full = backfill_web_users(read_table(spark, root, "Ad_impressions"), spark.createDataFrame([], WEB_USERS))
    assert set(people(spark, root)) == {"a"} | {r.user_id for r in full.collect()}
    assert len(people(spark, root)) == 4
    # Nothing new: nothing is read, nothing is added.
    incremental.backfill_new_users(spark, root)
    assert len(people(spark, root)) == 4


def test_a_backfill_that_died_is_repeated(spark, root, monkeypatch):
    spark.createDataFrame([], WEB_USERS).write.parquet(f"{root}/WebUsers")
    put(spark, root, "20240101", 0, ["a", "b"])
    with monkeypatch.context() as m:
        m.setattr(incremental, "mark", lambda *a: (_ for _ in ()).throw(RuntimeError("died")))
        with pytest.raises(RuntimeError):
            incremental.backfill_new_users(spark, root)
    incremental.backfill_new_users(spark, root)
    assert people(spark, root) == ["a", "b"]


def test_a_limited_backfill_goes_on_with_the_rest(spark, root):
    spark.createDataFrame([], WEB_USERS).write.parquet(f"{root}/WebUsers")
    put(spark, root, "20240101", 0, list("dacb"))
    for n in (3, 4, 4):
        incremental.backfill_new_users(spark, root, limit=3)
        assert people(spark, root) == list("abcd")[:n]


@pytest.mark.parametrize("report", sorted(incremental.REPORTS))
def test_reports_from_days_equal_the_whole(spark, root, report):
    name = incremental.REPORTS[report][0]
    whole = getattr(reports, f"report_{report}")
    put(spark, root, "20240101", 0, ["a", "b"], name)
    put(spark, root, "20240102", 1, list("abcdef"), name)
    assert incremental.refresh_report(spark, root, report) == ["20240101", "20240102"]
    put(spark, root, "20240102", 2, list("xyz"), name)
    put(spark, root, "20240103", 3, ["a"], name)
    compact.compact_days(spark, root, name, "20240102")
    assert incremental.refresh_report(spark, root, report) == ["20240102", "20240103"]
    assert incremental.refresh_report(spark, root, report) == []
    expected = whole(read_table(spark, root, name))
    got = incremental.read_report(spark, root, report)
    assert values(got, *expected.columns) == values(expected, *expected.columns)


def test_folders_are_listed(spark, root):
    assert folders(spark, root, "Ad_impressions").count() == 0
    put(spark, root, "20240101", 0, ["a"])
    (row,) = folders(spark, root, "Ad_impressions").collect()
    assert (row.day, row.folder) == ("20240101", "source=stream/run=r/batch_id=0/part=0") and row.bytes > 0


def test_accounts_of_a_batch_add_up(spark, root, tmp_path):
    put_folder(
        spark,
        tmp_path,
        "20240101/00",
        [client_json(user_id="a")] * 3
        + [client_json(user_id="b"), "oops", client_json(user_id="c", clicked=None), client_json(user_id="d", clicked="x")],
        [server_json(user_id=u) for u in "acdz"] + ["[]", "{", server_json(user_id="a")],
    )
    put_folder(spark, tmp_path, "20240101/01", [client_json(user_id="e")], [])
    notices = spark.createDataFrame([notice(tmp_path, f"20240101/0{i}") for i in (0, 1)])
    sinks = Sinks(f"{root}/out")
    for _ in range(2):  # the second is a replay
        ingest_folders(spark, notices, dims(spark), sinks, 0, slice_files=1)
        n = {r.measure: r.n for r in read_accounts(spark, sinks).collect()}
        assert (n["client_read"], n["server_read"], n["client_malformed"]) == (8, 8, 1)
        # An empty file has one empty line.
        assert n["server_malformed"] == 3
        assert (n["matched"], n["merged"], n["unmatched"]) == (3, 2, 2)
        assert n["client_read"] == n["client_malformed"] + n["matched"] + n["merged"] + n["unmatched"]
        assert n["matched"] == n["stored"] + n["invalid"] and n["stored"] == 1
        assert n["invalid"] == sum(v for k, v in n.items() if k.startswith("invalid_"))
        assert n["invalid_clicked_null"] == n["invalid_clicked_type"] == 1
