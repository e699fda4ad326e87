"""DuckDB SQL that gives the same rows as each query, on the same tables."""

from __future__ import annotations

from adstream.functions.useragent import BROWSER_COLUMNS
from adstream.schemas import AD_IMPRESSIONS, AD_IMPRESSIONS_INVALID, CLIENT_EVENT
from workload.inputs import USER_AGENTS

FIELDS = ", ".join(CLIENT_EVENT.names)
KEY = ("ad_id", "user_id", "publisher_id", "page_id", "ad_position")


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _key(alias: str) -> str:
    return ", ".join(f"coalesce({alias}.{k},'None')" for k in KEY)


def _same_key(a: str, b: str) -> str:
    return " AND ".join(f"coalesce({a}.{k},'None')=coalesce({b}.{k},'None')" for k in KEY)


def _matched(scope: str, order: str) -> str:
    c, s = (scope.format(t="c"), scope.format(t="s")) if scope else ("", "")
    partition = f"{c}, {_key('c')}" if scope else _key("c")
    same_scope = f"{s}={scope.format(t='x')} AND " if scope else ""
    return f"""SELECT * EXCLUDE (rn) FROM (
      SELECT c.*, row_number() OVER (PARTITION BY {partition} ORDER BY {order}) AS rn
      FROM client_events c) x
    WHERE rn = 1 AND EXISTS (SELECT 1 FROM server_events s
      WHERE {same_scope}{_same_key('s', 'x')})"""


BY_EVENT = "c.ctimestamp NULLS FIRST, c.event_id, c.latency"
BY_FIELDS = (
    "c.ctimestamp NULLS FIRST, c.user_agent NULLS FIRST, "
    "CAST(c.latency AS VARCHAR) NULLS FIRST, c.clicked NULLS FIRST"
)


def _verdict(source: str, numeric: bool) -> str:
    rules = []
    for name in CLIENT_EVENT.names:
        rules.append((f"{name} IS NULL", "Invalid due to null", name))
        if name == "clicked":
            rules.append((f"{name} NOT IN ('yes','no')", "Invalid due to Data type", name))
        elif numeric and name in ("ad_id", "publisher_id"):
            digits = f"NOT regexp_full_match({name}, '[0-9]+')"
            rules.append((digits, "Invalid due to Data type", name))
    status = " ".join(f"WHEN {test} THEN '{text}'" for test, text, _ in rules)
    field = " ".join(f"WHEN {test} THEN '{name}'" for test, _, name in rules)
    return (
        f"SELECT *, CASE {status} ELSE '' END AS validity_status, "
        f"CASE {field} ELSE '' END AS invalid_field FROM {source}"
    )


# What each agent of the inputs is, in their order, as the contract lists it:
# browser and version, system and version, device, brand, model.
AGENTS = (
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
)
# What is shown where there is no agent.
NO_AGENT = ("Other", "", "Other", "", "Other", None, None)


def _browser(source: str) -> str:
    def row(agent: str | None, values: tuple) -> str:
        texts = ("NULL" if v is None else _quoted(v) for v in (agent, *values))
        return f"({', '.join(texts)})"

    known = ", ".join([*map(row, USER_AGENTS, AGENTS), row(None, NO_AGENT)])
    names = ", ".join(BROWSER_COLUMNS)
    return (
        f"SELECT b_.*, {', '.join(f'a_.{n}' for n in BROWSER_COLUMNS)} FROM {source} b_ "
        f"JOIN (VALUES {known}) a_(agent_, {names}) ON b_.user_agent IS NOT DISTINCT FROM a_.agent_"
    )


def _attributes(dim: str, on: str, columns: tuple[str, ...]) -> tuple[str, str]:
    hit = f"{dim}_.hit"
    shown = ", ".join(
        f"CASE WHEN {hit} THEN CAST({dim}_.{c} AS VARCHAR) ELSE 'Unknown' END AS {c}"
        for c in columns
    )
    return shown, f"LEFT JOIN (SELECT *, TRUE AS hit FROM {dim}) {dim}_ ON {on}"


POSITION = _attributes("ad_position", "ad_position_.ad_position=v.ad_position", ("Location", "Size"))
ADVERTISER = _attributes(
    "advertiser",
    "CAST(advertiser_.ad_id AS VARCHAR)=v.ad_id",
    ("advertiser", "exchange", "campaign_id"),
)
PAGE = _attributes(
    "page",
    "CAST(page_.publisher_id AS VARCHAR)=v.publisher_id AND page_.page_id=v.page_id",
    ("publisher", "article"),
)


def _enriched(valid: str) -> str:
    looked_up = (
        f"SELECT v.*, {POSITION[0]}, {ADVERTISER[0]}, {PAGE[0]} FROM ({valid}) v "
        f"{POSITION[1]} {ADVERTISER[1]} {PAGE[1]}"
    )
    return _browser(f"({looked_up})")


_NUMBERS = ("ad_id", "publisher_id", "latency", "campaign_id")


def _stored(schema) -> str:
    def column(name: str) -> str:
        if name == "timestamp":
            return "make_timestamp(ctimestamp*1000000) AS timestamp"
        if name in _NUMBERS:
            return f"TRY_CAST({name} AS BIGINT) AS {name}"
        return name

    return ", ".join(column(name) for name in schema.names)


_AGENT_ROWS = ",".join(f"({i},{_quoted(a)})" for i, a in enumerate(USER_AGENTS))


def _json_value(name: str) -> str:
    if name in ("ad_id", "publisher_id", "campaign_id"):
        text = (
            f"CASE WHEN regexp_full_match({name},'[0-9]+') THEN {name} ELSE '\"'||{name}||'\"' END"
        )
    elif name in ("latency", "ctimestamp"):
        text = f"CAST({name} AS VARCHAR)"
    else:
        text = f"'\"'||{name}||'\"'"
    return f"coalesce({text},'null')"


def _json_object(names) -> str:
    return "'{'||" + "||','||".join(f"'\"{n}\":'||{_json_value(n)}" for n in names) + "||'}'"


VALIDATED = (*CLIENT_EVENT.names, "validity_status", "invalid_field")
ENRICHED = (
    *VALIDATED,
    *("Location", "Size", "advertiser", "exchange", "campaign_id", "publisher", "article"),
    *BROWSER_COLUMNS,
)

CTES = {
    "user_agents": f"SELECT * FROM (VALUES {_AGENT_ROWS}) t(ua_id, user_agent)",
    "base": """SELECT event_id, user_id AS uid, event_type AS et, value AS val, event_id % 97 AS k,
      CAST(floor(epoch(ts)) AS BIGINT) AS ep, CAST(floor(epoch(ts)/30) AS BIGINT)*30 AS win
      FROM events""",
    "event_core": """SELECT event_id, win, k, ep,
      CASE WHEN k=1 THEN NULL WHEN k=2 THEN 'abc' ELSE CAST(400+event_id%100 AS VARCHAR(20)) END AS ad_id,
      'u'||CAST(uid AS VARCHAR(20)) AS user_id,
      CASE WHEN k=3 THEN NULL WHEN k=4 THEN 'x9' ELSE CASE event_id%5 WHEN 0 THEN '123' WHEN 1 THEN '125' WHEN 2 THEN '168' WHEN 3 THEN '189' ELSE '195' END END AS publisher_id,
      CASE WHEN k=5 THEN NULL ELSE CASE event_id%6 WHEN 0 THEN 'SPORTS_1' WHEN 1 THEN 'FINANCE_3' WHEN 2 THEN 'FASHION_4' WHEN 3 THEN 'TECH_5' WHEN 4 THEN 'GAMES_3' ELSE 'FRONTPAGE_1' END END AS page_id,
      CASE (event_id+k)%6 WHEN 0 THEN 'LTOP1' WHEN 1 THEN 'LTOP2' WHEN 2 THEN 'BANNER1' WHEN 3 THEN 'RBANNER1' WHEN 4 THEN 'FOOTER1' ELSE 'SCROLL1' END AS ad_position,
      CASE WHEN k=8 THEN NULL ELSE u.user_agent END AS user_agent,
      CASE WHEN k=9 THEN NULL ELSE 1000+CAST(floor(val*100) AS BIGINT)%3500 END AS latency,
      CASE WHEN k=10 THEN NULL ELSE ep+12 END AS ctimestamp,
      CASE et WHEN 'click' THEN 'yes' WHEN 'view' THEN 'no' WHEN 'purchase' THEN 'yes' WHEN 'signup' THEN 'unknown' ELSE CASE WHEN k%2=0 THEN 'no' END END AS clicked
      FROM base JOIN user_agents u ON u.ua_id = event_id % 20""",
    "client_events": f"""SELECT event_id, win, ep, {FIELDS} FROM event_core WHERE k <> 11
      UNION ALL
      SELECT event_id, win, ep, ad_id, user_id, publisher_id, page_id, ad_position, user_agent,
        latency+1 AS latency, ctimestamp+1 AS ctimestamp, clicked FROM event_core WHERE k = 12""",
    "server_events": """SELECT ad_id, user_id, publisher_id, page_id, ad_position, win, ep AS stimestamp FROM event_core WHERE k <> 13
      UNION ALL
      SELECT ad_id, user_id, publisher_id, page_id, ad_position, win, ep AS stimestamp FROM event_core WHERE k = 14""",
    "client_raw": f"SELECT event_id, win, ep, {_json_object(CLIENT_EVENT.names)} AS value FROM client_events",
    "client_damaged": """SELECT event_id, win, ep, CASE event_id % 89 WHEN 1 THEN value||value
      WHEN 2 THEN value||' '||value WHEN 3 THEN value||' x}' WHEN 4 THEN value[:-2]
      WHEN 5 THEN value||','||value ELSE value END AS value,
      event_id % 89 BETWEEN 1 AND 5 AS bad FROM client_raw""",
    "ad_position": """SELECT * FROM (VALUES ('LTOP1','Left','300x250'),('LTOP2','Left','300x600'),('BANNER1','Top','728x90'),
      ('RBANNER1','Right','160x600'),('SCROLL1','Scroll',CAST(NULL AS VARCHAR(20)))) t(ad_position, Location, Size)""",
    "advertiser": """SELECT CASE WHEN s_suppkey%10=3 THEN -s_suppkey ELSE 400+s_suppkey END AS ad_id, s_name AS advertiser,
      CASE WHEN s_suppkey%7=0 THEN NULL ELSE 'EX'||CAST(s_nationkey AS VARCHAR(20)) END AS exchange,
      1000+s_suppkey AS campaign_id
      FROM supplier""",
    "page": """SELECT p.publisher_id, g.page_id, p.publisher,
      CASE WHEN g.page_id='GAMES_3' THEN NULL ELSE p.publisher||'/'||g.page_id END AS article
      FROM (VALUES (123,'Pub A'),(125,'Pub B'),(168,'Pub C'),(189,'Pub D')) p(publisher_id, publisher)
      CROSS JOIN (VALUES ('SPORTS_1'),('FINANCE_3'),('FASHION_4'),('TECH_5'),('GAMES_3')) g(page_id)""",
    "web_users": """SELECT CASE WHEN c_custkey%3=0 THEN 'u' ELSE 'x' END||CAST(c_custkey AS VARCHAR(20)) AS user_id, 20+c_custkey%50 AS Age, 'USA' AS Country,
      CASE WHEN c_custkey%2=0 THEN 'MALE' ELSE 'FEMALE' END AS GENDER, 'MARRIED' AS MARITAL_STATUS,
      CAST(floor(c_acctbal) AS BIGINT)*10 AS INCOME
      FROM customer""",
    "notices": """SELECT DISTINCT '/data/hourly' AS bucket, 'hourly' AS data_frequency,
      strftime(ts, '%Y%m%d/%H') AS folder_path, 'server_events.json' AS server_events_file,
      'client_events.json' AS client_events_file FROM events""",
    "matched": _matched("{t}.win", BY_EVENT),
    "matched_batch": _matched("", BY_EVENT),
    "matched_stream": _matched("{t}.win", BY_FIELDS),
    "client_hours": "SELECT * REPLACE (ep - ep % 3600 AS win) FROM client_events",
    "server_hours": "SELECT * REPLACE (stimestamp - stimestamp % 3600 AS win) FROM server_events",
    "matched_hours": _matched("{t}.win", BY_FIELDS)
    .replace("FROM client_events c", "FROM client_hours c")
    .replace("FROM server_events s", "FROM server_hours s"),
    "beacon_groups": f"""SELECT count(*) AS n, bool_or(known) AS known FROM (
      SELECT c.*, EXISTS (SELECT 1 FROM server_hours s WHERE s.win = c.win AND {_same_key("s", "c")}) AS known
      FROM client_hours c) c GROUP BY c.win, {_key("c")}""",
    "matched_fields": _matched("", BY_FIELDS),
    "validated_fields": _verdict("matched_fields", False),
    "validated": _verdict("matched", False),
    "validated_stream": _verdict("matched_stream", False),
    "validated_hours": _verdict("matched_hours", False),
    "validated_hours_of_days": """SELECT * FROM validated_hours WHERE
      CAST(make_timestamp(win * 1000000) AS DATE) <= (SELECT min(CAST(ts AS DATE)) + 1 FROM events)""",
    "turned": """SELECT side, ep, user_id,
      CAST(floor((ep - first_) / ((last_ - first_ + 1) / 4.0::DOUBLE)) AS INTEGER) AS slice
      FROM (SELECT 'client' AS side, ep, user_id FROM client_events
        UNION ALL SELECT 'server' AS side, stimestamp AS ep, user_id FROM server_events)
      CROSS JOIN (SELECT min(ep) AS first_, max(ep) AS last_ FROM event_core)""",
    "valid": "SELECT * FROM validated WHERE validity_status = ''",
    "invalid": "SELECT * FROM validated WHERE validity_status <> ''",
    "enriched": _enriched("SELECT * FROM valid"),
    "impressions": f"SELECT {_stored(AD_IMPRESSIONS)} FROM enriched",
    "impressions_invalid": f"SELECT {_stored(AD_IMPRESSIONS_INVALID)} FROM invalid",
}

# Which other blocks a block reads, found by name.
_NEEDS = {
    name: [other for other in CTES if other != name and f" {other}" in body.replace("\n", " ")]
    for name, body in CTES.items()
}


def sql(body: str) -> str:
    """``body`` with the blocks it reads, directly or not, put in front."""
    wanted, queue = set(), [n for n in CTES if f" {n}" in body.replace("\n", " ")]
    while queue:
        name = queue.pop()
        if name not in wanted:
            wanted.add(name)
            queue += _NEEDS[name]
    blocks = ",\n".join(f"{n} AS ({b})" for n, b in CTES.items() if n in wanted)
    return f"WITH {blocks}\n{body}" if blocks else body


EVENT = f"event_id, win, {FIELDS}"
EVENT_HOURS = f"event_id, {FIELDS}"
_TRAFFIC = (
    "count(*) AS impressions, count(*) FILTER (clicked='yes') AS clicks, "
    "count(*) FILTER (clicked='yes') / count(*) AS click_rate"
)


def _lookup(parts: tuple[str, str]) -> str:
    return f"SELECT v.event_id, {{k}}, {parts[0]} FROM valid v {parts[1]}"


def _impressions_from(validated: str) -> str:
    valid = f"SELECT * FROM {validated} WHERE validity_status = ''"
    return f"SELECT {_stored(AD_IMPRESSIONS)} FROM ({_enriched(valid)})"


_BACKFILL = """SELECT a.user_id, CAST(37 AS BIGINT) AS Age, 'USA' AS Country,
      'MALE' AS GENDER, 'MARRIED' AS MARITAL_STATUS, CAST(50000 AS BIGINT) AS INCOME
      FROM (SELECT DISTINCT user_id FROM impressions) a
      LEFT JOIN web_users u ON a.user_id = u.user_id
      WHERE u.user_id IS NULL"""

QUERIES = {
    "parse_events": "SELECT event_id, "
    + ", ".join(f"json_extract_string(value, '$.{n}') AS {n}" for n in CLIENT_EVENT.names)
    + " FROM client_damaged WHERE NOT bad",
    "quarantined_events": "SELECT event_id, value, 'client' AS side FROM client_damaged WHERE bad",
    "encode_events": "SELECT event_id, value FROM client_raw",
    "parse_notices": "SELECT * FROM notices",
    "quarantined_notices": """SELECT CASE n WHEN 0 THEN '{"bucket":"'||bucket||'","folder_path":"'||folder_path||'"}'
      WHEN 1 THEN '{}' ELSE 'no notice' END AS value, 'notice' AS side
      FROM notices CROSS JOIN (VALUES (0), (1), (2)) t(n)""",
    "batch_file_paths": """SELECT bucket, folder_path,
      bucket||'/'||folder_path||'/'||client_events_file AS client_path,
      bucket||'/'||folder_path||'/'||server_events_file AS server_path FROM notices""",
    "completion_notices": """SELECT '["foldername","'||bucket||'/'||folder_path||'"]' AS value
      FROM notices""",
    "tumbling_window_assign": "SELECT event_id, ep, win AS window_start, win+30 AS window_end FROM client_events",
    "match_windowed": f"SELECT {EVENT} FROM matched",
    "match_batch": f"SELECT {EVENT} FROM matched_batch",
    "flatten_matches": f"SELECT {EVENT} FROM matched_batch UNION ALL SELECT {EVENT} FROM matched",
    "validate_as_written": f"SELECT {EVENT}, validity_status, invalid_field FROM validated",
    "validate_numeric": f"SELECT {EVENT}, validity_status, invalid_field FROM ({_verdict(' matched', True)})",
    "valid_events": f"SELECT {EVENT} FROM valid",
    "invalid_events": f"SELECT {EVENT}, validity_status, invalid_field FROM invalid",
    "enrich_ad_position": _lookup(POSITION).format(k="v.ad_position"),
    "enrich_advertiser": _lookup(ADVERTISER).format(k="v.ad_id"),
    "enrich_page": _lookup(PAGE).format(k="v.publisher_id, v.page_id"),
    "user_agent_dim": _browser("(SELECT DISTINCT user_agent FROM client_events)"),
    "enrich_browser": _browser("(SELECT event_id, user_agent FROM valid)"),
    "enrich_browser_lookup": _browser("(SELECT event_id, user_agent FROM valid)"),
    "ad_impressions": "SELECT * FROM impressions",
    "ad_impressions_invalid": "SELECT * FROM impressions_invalid",
    "event_feed": f"""SELECT 'validated' AS feed, {_json_object(VALIDATED)} AS value FROM validated
      UNION ALL SELECT 'enriched' AS feed, {_json_object(ENRICHED)} AS value FROM enriched""",
    "distinct_users": "SELECT DISTINCT user_id FROM impressions",
    "absent_users": """SELECT a.user_id FROM (SELECT DISTINCT user_id FROM impressions) a
      LEFT JOIN web_users u ON a.user_id = u.user_id WHERE u.user_id IS NULL""",
    "backfill_web_users": _BACKFILL,
    "backfill_web_users_limited": f"{_BACKFILL} ORDER BY a.user_id LIMIT 50",
    "web_users_after_backfill": f"SELECT * FROM web_users UNION ALL {_BACKFILL}",
    "stream_pipeline": _impressions_from("validated_stream"),
    "notice_ingest": _impressions_from("validated_hours"),
    "ingest_two_runs": _impressions_from("validated_hours"),
    "match_notice_window": _impressions_from("validated_fields"),
    "match_batch_folders": f"SELECT {EVENT_HOURS} FROM matched_hours",
    "late_rows_kept": """SELECT side, ep, user_id, coalesce((ep // 30 + 1) * 30 <= closed, false) AS late FROM (
        SELECT *, CASE slice WHEN 0 THEN 0 WHEN 2 THEN 1 WHEN 1 THEN 2 ELSE 3 END AS turn FROM turned) t
      JOIN (SELECT turn, max(reached) OVER (ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) - 12 * 86400 AS closed
        FROM (SELECT CASE slice WHEN 0 THEN 0 WHEN 2 THEN 1 WHEN 1 THEN 2 ELSE 3 END AS turn, min(most) AS reached
          FROM (SELECT slice, side, max(ep) AS most FROM turned GROUP BY slice, side) GROUP BY slice)) USING (turn)""",
    "stored_invalid": f"SELECT {_stored(AD_IMPRESSIONS_INVALID)} FROM validated_hours WHERE validity_status <> ''",
    "stored_feed": f"""SELECT 'validated' AS feed, {_json_object(VALIDATED)} AS value FROM validated_hours
      UNION ALL SELECT 'enriched' AS feed, {_json_object(ENRICHED)} AS value
      FROM ({_enriched("SELECT * FROM validated_hours WHERE validity_status = ''")})""",
    "cleanup_feed": """SELECT '["foldername","/day='||strftime(ts, '%Y%m%d')||'/hour='||strftime(ts, '%H')||'"]' AS value
      FROM (SELECT DISTINCT date_trunc('hour', ts) AS ts FROM events)""",
    "batch_accounts": f"""SELECT 'client_read' AS measure, count(*) AS n FROM client_events
      UNION ALL SELECT 'server_read', count(*) FROM server_events
      UNION ALL SELECT unnest(['client_malformed', 'server_malformed']), 0
      UNION ALL SELECT 'matched', count(*) FROM beacon_groups WHERE known
      UNION ALL SELECT 'merged', CAST(sum(n - 1) AS BIGINT) FROM beacon_groups WHERE known
      UNION ALL SELECT 'unmatched', CAST(sum(n) AS BIGINT) FROM beacon_groups WHERE NOT known
      UNION ALL SELECT 'stored', count(*) FROM validated_hours WHERE validity_status = ''
      UNION ALL SELECT 'invalid', count(*) FROM validated_hours WHERE validity_status <> ''
      UNION ALL SELECT 'invalid_' || f || '_' || k, (SELECT count(*) FROM validated_hours
        WHERE invalid_field = f AND validity_status = CASE k WHEN 'null' THEN 'Invalid due to null' ELSE 'Invalid due to Data type' END)
      FROM (SELECT unnest({list(CLIENT_EVENT.names)}) AS f) CROSS JOIN (SELECT unnest(['null', 'type']) AS k)""",
    "report_of_days": f"""SELECT Location, Size, {_TRAFFIC} FROM (
      {_impressions_from("validated_hours_of_days")}) GROUP BY ALL""",
    "impressions_after_compaction": _impressions_from("validated_hours"),
    "impressions_from_tables": "SELECT * FROM impressions",
    "backfill_incremental": f"""SELECT * FROM web_users UNION ALL {_BACKFILL.replace("FROM impressions", f"FROM ({_impressions_from('validated_hours')})")}""",
    "report_by_campaign_incremental": f"""SELECT advertiser, campaign_id, date_trunc('hour', timestamp) AS hour,
      {_TRAFFIC} FROM ({_impressions_from("validated_hours")}) GROUP BY ALL""",
    "report_by_page_incremental": f"SELECT publisher, page_id, {_TRAFFIC} FROM ({_impressions_from('validated_hours')}) GROUP BY ALL",
    "report_by_placement_incremental": f"SELECT Location, Size, {_TRAFFIC} FROM ({_impressions_from('validated_hours')}) GROUP BY ALL",
    "report_invalid_incremental": """SELECT validity_status, invalid_field, count(*) AS events
      FROM validated_hours WHERE validity_status <> '' GROUP BY ALL""",
    "report_by_campaign": f"""SELECT advertiser, campaign_id, date_trunc('hour', timestamp) AS hour,
      {_TRAFFIC} FROM impressions GROUP BY ALL""",
    "report_by_page": f"SELECT publisher, page_id, {_TRAFFIC} FROM impressions GROUP BY ALL",
    "report_by_placement": f"SELECT Location, Size, {_TRAFFIC} FROM impressions GROUP BY ALL",
    "report_latency": """SELECT Browser, Client_OS, Client_Device, count(*) AS impressions,
      avg(latency) AS mean_latency, quantile_disc(latency, 0.95) AS p95_latency
      FROM impressions GROUP BY ALL""",
    "report_invalid": """SELECT validity_status, invalid_field, count(*) AS events
      FROM impressions_invalid GROUP BY ALL""",
    "report_by_demographics": f"""SELECT Country, GENDER, MARITAL_STATUS, Age, {_TRAFFIC}
      FROM impressions JOIN web_users USING (user_id) GROUP BY ALL""",
}


def oracle_sql() -> dict[str, str]:
    return {name: sql(body) for name, body in QUERIES.items()}
