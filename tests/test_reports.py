import math
import random

from adstream.plans import reports
from adstream.schemas import AD_IMPRESSIONS
from tests.rows import values


def impressions(spark, rows):
    blank = {n: None for n in AD_IMPRESSIONS.names}
    return spark.createDataFrame([tuple({**blank, **r}.values()) for r in rows], AD_IMPRESSIONS)


def test_latency_percentile_is_exact(spark):
    rng = random.Random(5)
    for size in (1, 19, 20, 21, 400):
        known = [rng.randrange(30) for _ in range(size)]
        rows = [{"Browser": "B", "latency": x} for x in [*known, None]]
        (got,) = reports.report_latency(impressions(spark, rows)).collect()
        assert got.p95_latency == sorted(known)[math.ceil(size * 95 / 100) - 1]
        assert got.impressions == size + 1
        assert abs(got.mean_latency - sum(known) / size) < 1e-9


def test_latency_percentile_over_a_wide_range(spark):
    rng = random.Random(6)
    rows, known = [], {}
    for i in range(600):
        group = rng.choice([None, "A", "B"])
        value = rng.choice([rng.randint(-5000, 5000), rng.randint(0, 10**12), -rng.randint(0, 2**50), 2**62])
        rows.append({"Browser": group, "latency": value})
        known.setdefault(group, []).append(value)
    got = {r.Browser: r.p95_latency for r in reports.report_latency(impressions(spark, rows)).collect()}
    assert got == {g: sorted(v)[math.ceil(len(v) * 95 / 100) - 1] for g, v in known.items()}


def test_latency_may_be_unknown_throughout(spark):
    (got,) = reports.report_latency(impressions(spark, [{"Browser": "B"}])).collect()
    assert (got.impressions, got.mean_latency, got.p95_latency) == (1, None, None)


def test_traffic(spark):
    rows = [{"publisher": "P", "clicked": c} for c in ("yes", "no", "no", "yes")]
    got = reports.report_by_page(impressions(spark, rows))
    assert values(got, "publisher", "impressions", "clicks", "click_rate") == [("P", 4, 2, 0.5)]


def test_latency_report_takes_any_number(spark):
    ends = [-(1 << 63), -(1 << 63) + 1, -1, 0, 1, 1024, (1 << 63) - 1, None]
    rows = [("b", "o", "d", n) for n in ends] + [("b", "o", "e", -(1 << 63))]
    df = spark.createDataFrame(rows, "Browser string, Client_OS string, Client_Device string, latency long")
    got = {r.Client_Device: (r.impressions, r.p95_latency) for r in reports.report_latency(df).collect()}
    assert got == {"d": (8, (1 << 63) - 1), "e": (1, -(1 << 63))}
