import pytest

from adstream.operators import enrich
from adstream.schemas import AD_POSITION, ADVERTISER, PAGE
from adstream.session import session_conf
from tests.rows import clients, values
from workload.inputs import USER_AGENTS


@pytest.fixture(params=["broadcast", "sort-merge"])
def joins(spark, request):
    limit = "10485760" if request.param == "broadcast" else "-1"
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": limit,
        "spark.sql.adaptive.autoBroadcastJoinThreshold": limit,
    }
    with session_conf(spark, settings):
        yield request.param


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_ad_position(spark, joins):
    dim = spark.createDataFrame([("LTOP1", "Left", None), ("X", "Top", "1x1")], AD_POSITION)
    df = clients(spark, {}, {"ad_position": "X"}, {"ad_position": "Y"})
    got = enrich.enrich_ad_position(df, dim)
    assert values(got, "ad_position", "Location", "Size") == [
        ("LTOP1", "Left", None),
        ("X", "Top", "1x1"),
        ("Y", "Unknown", "Unknown"),
    ]


def test_advertiser_compares_text(spark, joins):
    dim = spark.createDataFrame([(400, "Acme", None, 77, "s")], ADVERTISER)
    df = clients(spark, {}, {"ad_id": "401"}, {"ad_id": "400.0"}, {"ad_id": "abc"})
    got = enrich.enrich_advertiser(df, dim)
    assert values(got, "ad_id", "advertiser", "exchange", "campaign_id") == [
        ("400", "Acme", None, "77"),
        ("400.0", "Unknown", "Unknown", "Unknown"),
        ("401", "Unknown", "Unknown", "Unknown"),
        ("abc", "Unknown", "Unknown", "Unknown"),
    ]


def test_page_uses_both_parts(spark, joins):
    rows = [(123, "TECH_5", "Pub", "art"), (None, "TECH_5", "Nobody", None)]
    dim = spark.createDataFrame(rows, PAGE)
    df = clients(spark, {}, {"publisher_id": None}, {"page_id": "Z"})
    got = enrich.enrich_page(df, dim)
    assert values(got, "publisher_id", "page_id", "publisher", "article") == [
        ("123", "TECH_5", "Pub", "art"),
        ("123", "Z", "Unknown", "Unknown"),
        (None, "TECH_5", "Nobody", None),
    ]


def test_duplicate_dimension_keys_do_not_multiply(spark, joins):
    rows = [("LTOP1", "Right", "b"), ("LTOP1", "Left", "z"), ("LTOP1", "Left", "a")]
    dim = spark.createDataFrame(rows, AD_POSITION)
    got = enrich.enrich_ad_position(clients(spark, {}, {}), dim)
    assert values(got, "Location", "Size") == [("Left", "a"), ("Left", "a")]


def test_lookup_overwrites_earlier_attributes(spark):
    dim = spark.createDataFrame([("LTOP1", "Left", "a")], AD_POSITION)
    once = enrich.enrich_ad_position(clients(spark), dim)
    twice = enrich.enrich_ad_position(once, dim)
    assert twice.columns == once.columns and twice.count() == 1


def test_join_strategy_follows_the_size(spark, joins, tmp_path):
    rows = [(f"P{i}", "Left", "a") for i in range(100)]
    spark.createDataFrame(rows, AD_POSITION).write.parquet(f"{tmp_path}/dim")
    got = enrich.enrich_ad_position(clients(spark), spark.read.parquet(f"{tmp_path}/dim"))
    wanted = "BroadcastHashJoin" if joins == "broadcast" else "SortMergeJoin"
    assert wanted in plan(got)


def test_hot_key_beyond_broadcast(spark):
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "10KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    }
    dim = spark.createDataFrame([(400, "Acme", "E", 1, "s"), (401, "B", "E", 2, "s")], ADVERTISER)
    hot = clients(spark).crossJoin(spark.range(60000)).withColumnRenamed("id", "user_no")
    df = hot.unionByName(clients(spark, {"ad_id": "401"}).selectExpr("*", "-1L AS user_no"))
    with session_conf(spark, settings):
        got = enrich.enrich_advertiser(df.repartition(8), dim)
        assert len(got.where("advertiser = 'Acme'").select("user_no").collect()) == 60000
        got.collect()
        assert "skew=true" in plan(got)


# What each user agent resolves to.
GOLDEN = [
    ("Firefox", "47.0", "Windows", "6.1", "Other", None, None),
    ("Firefox", "42.0", "Mac OS X", "", "Mac", "Apple", "Mac"),
    ("Mobile Safari", "12.0", "iOS", "12.0", "iPhone", "Apple", "iPhone"),
    ("Chrome Mobile iOS", "69.0.3497.105", "iOS", "12.0", "iPhone", "Apple", "iPhone"),
    ("Mobile Safari", "11.0", "iOS", "11.0", "iPhone", "Apple", "iPhone"),
    ("Mobile Safari", "10.0", "iOS", "10.0.1", "iPhone9,3", "Apple", "iPhone9,3"),
    ("Chrome Mobile", "52.0.2743.98", "Android", "6.0.1", "SM-G920V", "Samsung", "SM-G920V"),
    ("Chrome Mobile WebView", "55.0.2883.91", "Android", "6.0.1", "SM-G935S", "Samsung", "SM-G935S"),
    ("Chrome Mobile", "62.0.3202.84", "Android", "8.0.0", "SM-G960F", "Samsung", "SM-G960F"),
    ("Chrome Mobile WebView", "60.0.3112.107", "Android", "7.0", "SM-G892A", "Samsung", "SM-G892A"),
    ("Edge", "12.246", "Windows", "10.0", "Other", None, None),
    ("Chrome", "51.0.2704.64", "Chrome OS", "8172.45.0", "Other", None, None),
    ("Safari", "9.0.2", "Mac OS X", "10.11.2", "Mac", "Apple", "Mac"),
    ("Firefox", "15.0.1", "Ubuntu", "", "Other", None, None),
    ("Chrome", "31.0.1650.0", "Chromecast", "1.5.16041", "CrKey", "Google", "CrKey"),
    ("Android", "4.0", "Android", "4.2.2", "NEO-X5-116A", "Generic", "NEO-X5-116A"),
    ("Chrome", "41.99900.2250.0242", "Android", "5.1", "AFTS", "Amazon", "AFTS"),
    ("Chrome Mobile WebView", "52.0.2743.98", "Android", "7.0", "Pixel C", "Google", "Pixel C"),
    ("Chrome Mobile WebView", "52.0.2743.98", "Android", "6.0.1", "SGP771", "Sony", "SGP771"),
    ("Chrome Mobile WebView", "55.0.2883.91", "Android", "6.0.1", "SHIELD Tablet K1", "NVIDIA", "SHIELD Tablet K1"),
]


def test_user_agents(spark):
    df = clients(spark, *[{"user_agent": a} for a in USER_AGENTS])
    got = enrich.enrich_browser(df)
    found = {r.user_agent: tuple(r[c] for c in enrich.BROWSER_COLUMNS) for r in got.collect()}
    assert [found[a] for a in USER_AGENTS] == GOLDEN


def test_unknown_user_agent(spark):
    got = enrich.enrich_browser(clients(spark, {"user_agent": "curl"}, {"user_agent": None}))
    other = ("Other", "", "Other", "", "Other", None, None)
    assert values(got, *enrich.BROWSER_COLUMNS) == [other, other]


def test_user_agent_dim_gives_the_same(spark, joins):
    agents = [*USER_AGENTS, "curl", None]
    df = clients(spark, *[{"user_agent": a} for a in agents for _ in range(3)])
    # Some agents are not in the dimension and are parsed in place.
    dim = enrich.build_user_agent_dim(df.where("user_agent LIKE '%Chrome%'"))
    assert dim.count() == sum("Chrome" in a for a in USER_AGENTS)
    columns = ("user_agent", *enrich.BROWSER_COLUMNS)
    assert values(enrich.enrich_browser(df, dim), *columns) == values(
        enrich.enrich_browser(df), *columns
    )
