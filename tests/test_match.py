import random

from pyspark.sql import functions as F

from adstream.operators.match import assign_window, flatten_matches, match_events
from tests.rows import clients, frame, messages, servers, values
from adstream.schemas import CLIENT_EVENT


def test_one_row_per_key_not_a_join(spark):
    client = clients(spark, {"latency": "7", "ctimestamp": "9"}, {"latency": "8"})
    matched = match_events(client, servers(spark, {}, {}), ())
    assert values(matched, "latency", "ctimestamp") == [("7", "9")]
    assert matched.columns == client.columns


def test_both_sides_are_needed(spark):
    client = clients(spark, {"user_id": "a"}, {"user_id": "b"})
    server = servers(spark, {"user_id": "b"}, {"user_id": "c"})
    assert values(match_events(client, server, ()), "user_id") == [("b",)]
    assert match_events(client, servers(spark).where("false"), ()).count() == 0


def test_null_key_parts_match_each_other(spark):
    for field in ("ad_id", "publisher_id", "page_id", "user_id", "ad_position"):
        client = clients(spark, {field: None}, {field: "z"})
        matched = match_events(client, servers(spark, {field: None}), ())
        assert values(matched, field) == [(None,)]


def test_null_is_the_text_none(spark):
    matched = match_events(clients(spark, {"ad_id": "None"}), servers(spark, {"ad_id": None}), ())
    assert matched.count() == 1


def test_separators_inside_values_do_not_collide(spark):
    client = clients(spark, {"ad_position": "A#B", "user_id": "C"})
    server = servers(spark, {"ad_position": "A", "user_id": "B#C"})
    assert match_events(client, server, ()).count() == 0


def test_first_is_numeric_by_client_time_null_lowest(spark):
    client = clients(spark, {"ctimestamp": "100"}, {"ctimestamp": "99"})
    assert values(match_events(client, servers(spark), ()), "ctimestamp") == [("99",)]
    client = clients(spark, {"ctimestamp": "99"}, {"ctimestamp": None})
    assert values(match_events(client, servers(spark), ()), "ctimestamp") == [(None,)]


def test_order_by_decides(spark):
    client = clients(spark, {"latency": "5"}, {"latency": "4", "ctimestamp": "200"})
    matched = match_events(client, servers(spark), (), ["latency"])
    assert values(matched, "latency") == [("4",)]


def test_scope_keeps_folders_apart(spark):
    client = clients(spark).withColumn("folder_path", F.explode(F.array(F.lit("a"), F.lit("b"))))
    server = servers(spark).withColumn("folder_path", F.lit("b"))
    assert values(match_events(client, server, ("folder_path",)), "folder_path") == [("b",)]


def test_windows_are_aligned_and_half_open(spark):
    df = assign_window(messages(spark, [(0, "a"), (29, "b"), (30, "c")]))
    starts = df.select("value", F.unix_timestamp("window.start").alias("s"))
    assert values(starts, "value", "s") == [("a", 0), ("b", 0), ("c", 30)]


def test_pairs_across_a_boundary_do_not_match(spark):
    at = lambda s: F.timestamp_seconds(F.lit(s))
    client = assign_window(clients(spark).withColumn("publish_ts", at(30)))
    early = assign_window(servers(spark).withColumn("publish_ts", at(29)))
    late = assign_window(servers(spark).withColumn("publish_ts", at(59)))
    assert match_events(client, early).count() == 0
    assert match_events(client, late).count() == 1


def test_input_order_does_not_matter(spark):
    rng = random.Random(7)
    rows = [
        {
            "user_id": f"u{rng.randrange(20)}",
            "latency": str(rng.randrange(5)),
            "ctimestamp": rng.choice([None, "1", "2"]),
            "clicked": rng.choice([None, "yes", "no"]),
        }
        for _ in range(200)
    ]
    server = servers(spark, *[{"user_id": f"u{i}"} for i in range(0, 20, 2)])
    results = set()
    for _ in range(3):
        rng.shuffle(rows)
        got = match_events(clients(spark, *rows).repartition(5), server, ())
        results.add(tuple(values(got, *CLIENT_EVENT.names)))
    assert len(results) == 1 and len(results.pop()) == 10


def test_brute_force(spark):
    rng = random.Random(3)
    pick = lambda *options: rng.choice(options)
    key = lambda: {"ad_id": pick(None, "1", "2"), "user_id": pick("a", "b"), "page_id": pick(None, "p")}
    client = [{**key(), "latency": str(i), "ctimestamp": str(rng.randrange(50))} for i in range(60)]
    server = [key() for _ in range(6)]
    text = lambda row: (str(row["ad_id"]), row["user_id"], str(row["page_id"]))
    confirmed = {text(row) for row in server}
    expected = {}
    for row in client:
        if text(row) in confirmed:
            rank = (int(row["ctimestamp"]), row["latency"])
            expected[text(row)] = min(expected.get(text(row), rank), rank)
    got = match_events(clients(spark, *client), servers(spark, *server), ())
    assert sorted(r.latency for r in got.collect()) == sorted(r[1] for r in expected.values())


def test_hot_key_is_reduced_before_the_shuffle(spark):
    client = clients(spark).crossJoin(spark.range(3000)).drop("id").repartition(6)
    server = servers(spark).crossJoin(spark.range(3000)).drop("id").repartition(6)
    matched = match_events(client, server, ())
    plan = matched._jdf.queryExecution().executedPlan().toString()
    assert "partial_min" in plan
    assert matched.count() == 1


def test_flatten_keeps_equal_rows(spark):
    assert flatten_matches(clients(spark), clients(spark)).count() == 2


def test_extra_columns_are_carried(spark):
    client = frame(spark, CLIENT_EVENT, {n: "1" for n in CLIENT_EVENT.names}, [{}])
    client = client.withColumn("event_id", F.lit(5).cast("bigint"))
    server = client.select("ad_id", "user_id", "publisher_id", "page_id", "ad_position")
    assert values(match_events(client, server, ()), "event_id") == [(5,)]
