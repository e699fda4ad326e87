"""Ad events and dimensions derived by Spark from the given tables.

``k = event_id % 97`` plants the cases FIXTURES.md lists: NULL and text ids,
missing fields, unconfirmed beacons and duplicates on either side.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adstream.schemas import CLIENT_EVENT
from adstream.session import configure
from adstream.sources.dimensions import Dimensions

# The user agents events are spread over.
USER_AGENTS = (
    "Mozilla/5.0 (Windows NT 6.1; Win64; x64; rv:47.0) Gecko/20100101 Firefox/47.0",
    "Mozilla/5.0 (Macintosh; Intel Mac OS X x.y; rv:42.0) Gecko/20100101 Firefox/42.0",
    "Mozilla/5.0 (iPhone; CPU iPhone OS 12_0 like Mac OS X) AppleWebKit/605.1.15 (KHTML, like Gecko) Version/12.0 Mobile/15E148 Safari/604.1",
    "Mozilla/5.0 (iPhone; CPU iPhone OS 12_0 like Mac OS X) AppleWebKit/605.1.15 (KHTML, like Gecko) CriOS/69.0.3497.105 Mobile/15E148 Safari/605.1",
    "Mozilla/5.0 (iPhone; CPU iPhone OS 11_0 like Mac OS X) AppleWebKit/604.1.34 (KHTML, like Gecko) Version/11.0 Mobile/15A5341f Safari/604.1",
    "Mozilla/5.0 (iPhone9,3; U; CPU iPhone OS 10_0_1 like Mac OS X) AppleWebKit/602.1.50 (KHTML, like Gecko) Version/10.0 Mobile/14A403 Safari/602.1",
    "Mozilla/5.0 (Linux; Android 6.0.1; SM-G920V Build/MMB29K) AppleWebKit/537.36 (KHTML, like Gecko) Chrome/52.0.2743.98 Mobile Safari/537.36",
    "Mozilla/5.0 (Linux; Android 6.0.1; SM-G935S Build/MMB29K; wv) AppleWebKit/537.36 (KHTML, like Gecko) Version/4.0 Chrome/55.0.2883.91 Mobile Safari/537.36",
    "Mozilla/5.0 (Linux; Android 8.0.0; SM-G960F Build/R16NW) AppleWebKit/537.36 (KHTML, like Gecko) Chrome/62.0.3202.84 Mobile Safari/537.36",
    "Mozilla/5.0 (Linux; Android 7.0; SM-G892A Build/NRD90M; wv) AppleWebKit/537.36 (KHTML, like Gecko) Version/4.0 Chrome/60.0.3112.107 Mobile Safari/537.36",
    "Mozilla/5.0 (Windows NT 10.0; Win64; x64) AppleWebKit/537.36 (KHTML, like Gecko) Chrome/42.0.2311.135 Safari/537.36 Edge/12.246",
    "Mozilla/5.0 (X11; CrOS x86_64 8172.45.0) AppleWebKit/537.36 (KHTML, like Gecko) Chrome/51.0.2704.64 Safari/537.36",
    "Mozilla/5.0 (Macintosh; Intel Mac OS X 10_11_2) AppleWebKit/601.3.9 (KHTML, like Gecko) Version/9.0.2 Safari/601.3.9",
    "Mozilla/5.0 (X11; Ubuntu; Linux x86_64; rv:15.0) Gecko/20100101 Firefox/15.0.1",
    "Mozilla/5.0 (CrKey armv7l 1.5.16041) AppleWebKit/537.36 (KHTML, like Gecko) Chrome/31.0.1650.0 Safari/537.36",
    "Mozilla/5.0 (Linux; U; Android 4.2.2; he-il; NEO-X5-116A Build/JDQ39) AppleWebKit/534.30 (KHTML, like Gecko) Version/4.0 Safari/534.30",
    "Mozilla/5.0 (Linux; Android 5.1; AFTS Build/LMY47O) AppleWebKit/537.36 (KHTML, like Gecko) Version/4.0 Chrome/41.99900.2250.0242 Safari/537.36",
    "Mozilla/5.0 (Linux; Android 7.0; Pixel C Build/NRD90M; wv) AppleWebKit/537.36 (KHTML, like Gecko) Version/4.0 Chrome/52.0.2743.98 Safari/537.36",
    "Mozilla/5.0 (Linux; Android 6.0.1; SGP771 Build/32.2.A.0.253; wv) AppleWebKit/537.36 (KHTML, like Gecko) Version/4.0 Chrome/52.0.2743.98 Safari/537.36",
    "Mozilla/5.0 (Linux; Android 6.0.1; SHIELD Tablet K1 Build/MRA58K; wv) AppleWebKit/537.36 (KHTML, like Gecko) Version/4.0 Chrome/55.0.2883.91 Safari/537.36",
)
# Domains of the event fields.
PUBLISHER_IDS = ("123", "125", "168", "189", "195")
PAGE_IDS = ("SPORTS_1", "FINANCE_3", "FASHION_4", "TECH_5", "GAMES_3", "FRONTPAGE_1")
AD_POSITIONS = ("LTOP1", "LTOP2", "BANNER1", "RBANNER1", "FOOTER1", "SCROLL1")

# The second in which a row of ``events`` happened.
SECOND = "unix_timestamp(CAST(ts AS TIMESTAMP))"

KEY_FIELDS = ("ad_id", "user_id", "publisher_id", "page_id", "ad_position")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return configure(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def _pick(values: tuple[str, ...], index: str) -> str:
    options = ", ".join(repr(v) for v in values)
    return f"get(array({options}), CAST(({index}) % {len(values)} AS INT))"


def event_core(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One ad view per event, before its two sides are told apart."""
    return core_of(table(spark, sf_dir, "events"))


def core_of(events: DataFrame) -> DataFrame:
    """The ad views of rows of ``events``, which are a fraction of the messages made of them."""
    base = events.selectExpr(
        "event_id",
        "user_id AS uid",
        "event_type AS et",
        "value",
        "event_id % 97 AS k",
        f"{SECOND} AS ep",
    )
    return base.selectExpr(
        "event_id",
        "k",
        "ep",
        "CAST(floor(ep / 30) AS BIGINT) * 30 AS win",
        "timestamp_seconds(ep) AS publish_ts",
        "CASE k WHEN 1 THEN NULL WHEN 2 THEN 'abc' ELSE CAST(400 + event_id % 100 AS STRING) END AS ad_id",
        "concat('u', CAST(uid AS STRING)) AS user_id",
        f"CASE k WHEN 3 THEN NULL WHEN 4 THEN 'x9' ELSE {_pick(PUBLISHER_IDS, 'event_id')} END AS publisher_id",
        f"CASE WHEN k <> 5 THEN {_pick(PAGE_IDS, 'event_id')} END AS page_id",
        f"{_pick(AD_POSITIONS, 'event_id + k')} AS ad_position",
        f"CASE WHEN k <> 8 THEN {_pick(USER_AGENTS, 'event_id')} END AS user_agent",
        "CASE WHEN k <> 9 THEN 1000 + CAST(floor(value * 100) AS BIGINT) % 3500 END AS latency",
        "CASE WHEN k <> 10 THEN ep + 12 END AS ctimestamp",
        """CASE WHEN et IN ('click', 'purchase') THEN 'yes' WHEN et = 'view' THEN 'no'
           WHEN et = 'signup' THEN 'unknown' WHEN k % 2 = 0 THEN 'no' END AS clicked""",
    )


def _copies(absent: int, doubled: int) -> str:
    """Each event once; not at all where ``k`` is ``absent``, twice where ``doubled``.

    The copies come out of one scan, numbered from 0.
    """
    return f"explode(CASE k WHEN {absent} THEN array() WHEN {doubled} THEN array(0, 1) ELSE array(0) END)"


def client_events(core: DataFrame) -> DataFrame:
    """Client side: a second, later beacon for some events, none for others."""
    later = {name: f"{name} + copy AS {name}" for name in ("latency", "ctimestamp")}
    return core.selectExpr("*", f"{_copies(absent=11, doubled=12)} AS copy").selectExpr(
        "event_id", "win", "ep", "publish_ts", *[later.get(n, n) for n in CLIENT_EVENT.names]
    )


def server_events(core: DataFrame) -> DataFrame:
    """Server side: some events have two records, some none."""
    rows = core.selectExpr("*", f"{_copies(absent=13, doubled=14)} AS copy")
    return rows.select(*KEY_FIELDS, "win", "ep", "publish_ts")


def _json(fields: dict[str, str]) -> str:
    """JSON text of one object: numbers where the text is one, strings, nulls."""
    parts = []
    for name, kind in fields.items():
        text = f"CAST({name} AS STRING)"
        quoted = f"concat('\"', {text}, '\"')"
        if kind == "id":
            quoted = f"CASE WHEN {text} RLIKE '^[0-9]+$' THEN {text} ELSE {quoted} END"
        parts.append(f"""'"{name}":', coalesce({text if kind == "number" else quoted}, 'null')""")
    return "concat('{', " + ", ',', ".join(parts) + ", '}') AS value"


CLIENT_JSON = _json(
    {
        "ad_id": "id",
        "user_id": "text",
        "publisher_id": "id",
        "page_id": "text",
        "ad_position": "text",
        "user_agent": "text",
        "latency": "number",
        "ctimestamp": "number",
        "clicked": "text",
    }
)
SERVER_JSON = _json(
    {
        "ad_id": "id",
        "user_id": "text",
        "publisher_id": "id",
        "page_id": "text",
        "ad_position": "text",
        "stimestamp": "number",
    }
)


def client_raw(core: DataFrame) -> DataFrame:
    """Client events as the JSON messages a beacon sends."""
    return client_events(core).selectExpr("event_id", "ep", "publish_ts", CLIENT_JSON)


def damaged(raw: DataFrame) -> DataFrame:
    """Messages of which some are malformed: two objects, or an object and more text."""
    return raw.withColumn(
        "value",
        F.expr(
            """CASE event_id % 89 WHEN 1 THEN concat(value, value) WHEN 2 THEN concat(value, ' ', value)
               WHEN 3 THEN concat(value, ' x}') WHEN 4 THEN substring(value, 1, length(value) - 1)
               WHEN 5 THEN concat(value, ',', value) ELSE value END"""
        ),
    )


def server_raw(core: DataFrame) -> DataFrame:
    """Server events as JSON messages."""
    events = server_events(core).withColumnRenamed("ep", "stimestamp")
    return events.selectExpr("stimestamp AS ep", "publish_ts", SERVER_JSON)


def _values(spark: SparkSession, columns: str, rows: list[tuple]) -> DataFrame:
    """A table of literals; unlike a parallelised list its size is known to the planner."""
    literal = ", ".join(
        "(" + ", ".join("NULL" if v is None else repr(v) for v in row) + ")" for row in rows
    )
    return spark.sql(f"SELECT * FROM VALUES {literal} AS t({columns})")


def ad_position(spark: SparkSession) -> DataFrame:
    rows = [
        ("LTOP1", "Left", "300x250"),
        ("LTOP2", "Left", "300x600"),
        ("BANNER1", "Top", "728x90"),
        ("RBANNER1", "Right", "160x600"),
        ("SCROLL1", "Scroll", None),
    ]
    return _values(spark, "ad_position, Location, Size", rows)


def advertiser(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Every tenth supplier has an ad that no event shows, so its own ad is unknown.
    key = F.col("s_suppkey")
    return table(spark, sf_dir, "supplier").select(
        F.when(key % 10 == 3, -key).otherwise(400 + key).alias("ad_id"),
        F.col("s_name").alias("advertiser"),
        F.when(key % 7 != 0, F.concat(F.lit("EX"), F.col("s_nationkey").cast("string"))).alias(
            "exchange"
        ),
        (1000 + key).alias("campaign_id"),
    )


def page(spark: SparkSession) -> DataFrame:
    publishers = [(123, "Pub A"), (125, "Pub B"), (168, "Pub C"), (189, "Pub D")]
    rows = [
        (number, name, title, None if name == "GAMES_3" else f"{title}/{name}")
        for number, title in publishers
        for name in ("SPORTS_1", "FINANCE_3", "FASHION_4", "TECH_5", "GAMES_3")
    ]
    pages = _values(spark, "publisher_id, page_id, publisher, article", rows)
    return pages.withColumn("publisher_id", F.col("publisher_id").cast("bigint"))


def dimensions(spark: SparkSession, sf_dir: str) -> Dimensions:
    return Dimensions(ad_position(spark), advertiser(spark, sf_dir), page(spark))


def web_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Two of three customers are users that no event mentions.
    key = F.col("c_custkey")
    letter = F.when(key % 3 == 0, "u").otherwise("x")
    return table(spark, sf_dir, "customer").select(
        F.concat(letter, key.cast("string")).alias("user_id"),
        (20 + key % 50).alias("Age"),
        F.lit("USA").alias("Country"),
        F.when(key % 2 == 0, "MALE").otherwise("FEMALE").alias("GENDER"),
        F.lit("MARRIED").alias("MARITAL_STATUS"),
        (F.floor("c_acctbal") * 10).alias("INCOME"),
    )


def notices(spark: SparkSession, sf_dir: str, bucket: str = "/data/hourly") -> DataFrame:
    """One notice per hour in which an event happened."""
    hour = F.date_trunc("hour", F.col("ts").cast("timestamp")).alias("hour")
    hours = table(spark, sf_dir, "events").select(hour).distinct()
    return hours.select(
        F.lit(bucket).alias("bucket"),
        F.lit("hourly").alias("data_frequency"),
        F.date_format("hour", "yyyyMMdd/HH").alias("folder_path"),
        F.lit("server_events.json").alias("server_events_file"),
        F.lit("client_events.json").alias("client_events_file"),
    )
