"""How the inputs of the replays are laid out."""

from datetime import datetime

from tests.rows import values
from workload import inputs
from workload.queries import LATE_BY, LATE_SLICE, REPLAY_SLICES, _turns

EVENTS = "event_id long, ts timestamp, user_id long, event_type string, value double"
ROWS = [(i, datetime(2024, 1, 1 + i // 20, i % 20), i % 7, "view", i / 10) for i in range(120)]


def planned(rows):
    return rows._jdf.queryExecution().executedPlan().toString()


def test_replay_deals_out_events_instead_of_messages(spark):
    events = spark.createDataFrame([*ROWS, (None, None, None, None, None)], EVENTS)
    turns = list(_turns(events, inputs.client_raw, 60, 3))
    assert len(turns) == REPLAY_SLICES + 2
    for rows in turns[:-1]:
        # From the top: messages are made above the exchange and nowhere below it.
        made, dealt = planned(rows).split("Exchange RoundRobin", 1)
        assert '"clicked":' in made and '"clicked":' not in dealt
    whole = inputs.client_raw(inputs.core_of(events)).where("ep IS NOT NULL")
    found = [row for rows in turns[:-1] for row in values(rows, "publish_ts", "value")]
    assert sorted(found) == sorted(values(whole, "publish_ts", "value"))
    first = [min([row[0] for row in values(rows, "publish_ts")], default=None) for rows in turns[:-1]]
    late = first.pop(LATE_SLICE + LATE_BY + 1)
    assert first.pop(LATE_SLICE) is None
    assert first == sorted(first) and first[0] < late < first[1]
    (closing,) = values(turns[-1], "publish_ts", "value")
    assert closing[1] == "{}" and (closing[0] - max(row[0] for row in found)).total_seconds() == 120
