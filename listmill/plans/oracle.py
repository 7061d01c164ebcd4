"""For each registered query the SQL that gives its result straight from the tables' columns."""

from __future__ import annotations

from listmill.plans import derived as d
from listmill.plans.queries import (
    CUT_OFF,
    EVENT_DATE,
    EVENT_TOPIC,
    FETCH_STATUS,
    LISTING_CUSTOMER,
    LISTING_ORDER,
    READ_UNTIL,
    RELATED,
    RESET_PARTITION,
    RESET_TO,
    RESET_TOPIC,
)

OFFSET = f"{d.DAYS} * 1000000000000 + l_partkey * 10 + l_linenumber"
LINE_URL = f"concat('{d.LISTING_URL}', {d.PROP_TYPE}, '-3rum-', l_orderkey)"
ORDER_URL = f"concat('{d.LISTING_URL}villa-3rum-', o_orderkey)"
SHIP_DATE = "CAST(l_shipdate AS DATE)"
ARRIVAL = (
    f"CASE WHEN {SHIP_DATE} < DATE '{d.SPLIT}' THEN DATE '{d.DAY_1}' ELSE DATE '{d.DAY_2}' END"
)
LISTED = f"NOT {d.BROKEN} AND {d.HAS_INT_ID}"
SOLD_LISTED = f"NOT {d.BROKEN}"

EVENT_BRONZE = f"""
    CAST(user_id AS VARCHAR) AS key, props AS value, '{EVENT_TOPIC}' AS topic,
    CAST(user_id % 4 AS INT) AS partition, event_id AS "offset", ts AS "timestamp",
    CAST(0 AS INT) AS "timestampType" """

READ_BEFORE = f"""
    SELECT event_type AS topic, CAST(user_id % 4 AS INT) AS partition, max(event_id) + 1 AS next_offset
    FROM events WHERE CAST(ts AS DATE) < DATE '{READ_UNTIL}' AND event_type <> 'signup'
    GROUP BY ALL"""


def _parsed(fields: dict, name: str) -> str:
    """Select list: the values that parsing the page object has to give."""
    items = []
    for field, value in fields.items():
        if isinstance(value, dict):
            items.append(_parsed(value, f"{name}_{field}"))
        elif isinstance(value, list):
            items.append(f"concat_ws(',', {', '.join(value)}) AS {name}_{field}")
        else:
            items.append(f"{value[1] if isinstance(value, tuple) else value} AS {name}_{field}")
    return ", ".join(items)


FORSALE = _parsed(d.FORSALE, "props")
CANONICAL = _parsed(d.CANONICAL, "props")
SOLD = _parsed(d.SOLD, "sold_props")
HOME_ID = f"CASE WHEN {d.NO_HOME} THEN NULL ELSE TRY_CAST(l_orderkey AS INT) END"


def _json_fields(fields: dict) -> str:
    """JSON text of the fields as the page says them, each behind a comma; nulls are left out."""
    items = []
    for field, value in fields.items():
        if isinstance(value, dict):
            items.append(f"""',"{field}":{{' || substr({_json_fields(value)}, 2) || '}}'""")
        elif isinstance(value, list):
            items.append(f"""',"{field}":' || CAST(to_json([{', '.join(value)}]) AS VARCHAR)""")
        else:
            said = value[0] if isinstance(value, tuple) else value
            items.append(
                f"""CASE WHEN ({said}) IS NULL THEN '' ELSE ',"{field}":' || CAST(to_json({said}) AS VARCHAR) END"""
            )
    return f"({' || '.join(items)})"


def _object(fields: dict) -> str:
    """Text of the page object, line break and wrong values included."""
    rest = {k: v for k, v in fields.items() if k not in ("id", "water_distance")}
    distance = ""
    if "water_distance" in fields:
        distance = f"""',"water_distance":', l_partkey, CASE WHEN {d.DISTANCE_IS_FRACTION} THEN '.5' ELSE '' END,"""
    return f"""concat('{{', CASE WHEN {d.OBJECT_ON_TWO_LINES} THEN chr(10) ELSE '' END, '"id":',
        CASE WHEN {d.ID_IS_TEXT} THEN '"n/a"' ELSE CAST(l_orderkey AS VARCHAR) END,
        {distance} {_json_fields(rest)}, '}}')"""


TRAILING = f"""CASE WHEN {d.TRAILING_KEYS} THEN ',"user":{{"login":false}}' ELSE '' END"""

FORSALE_PAGE = f"""concat('<!DOCTYPE html>', chr(10), '<html><head><meta charset="utf-8"><script>', chr(10),
    CASE WHEN {d.NO_DATA_LAYER} THEN 'var x = 1;' ELSE
        concat('dataLayer =', CASE WHEN {d.BREAK_BEFORE_BRACKET} THEN concat(chr(10), '  ') ELSE ' ' END,
            '[{{"page":"listing","property":', {_object(d.FORSALE)}, {TRAILING}, '}}];') END,
    chr(10), '</script></head>', chr(10), '<body><h1>Listing ', l_orderkey, '</h1></body></html>')"""


def _silver(date: str, target: str) -> str:
    """Rows of all line items before one per key is kept, with their order."""
    common = f"""{date} AS ingestion_date, {LINE_URL} AS url, CAST(l_linenumber AS DOUBLE) AS collected_on,
        {d.PROP_TYPE} AS prop_type, {OFFSET} AS pos, {d.PARTITION} AS part"""
    if target == "sold":
        return f"""SELECT {common}, CAST(l_orderkey AS BIGINT) AS sold_id, {HOME_ID} AS listing_id, {SOLD}
            FROM lineitem WHERE {SOLD_LISTED}"""
    props = {"forsale": FORSALE, "canonical": CANONICAL}[target]
    return f"""SELECT {common}, CAST(l_orderkey AS VARCHAR) AS listing_id, {props}
        FROM lineitem WHERE {LISTED}"""


def _latest(rows: str, key: str, within: str = "") -> str:
    return f"""SELECT * FROM ({rows}) QUALIFY row_number() OVER (PARTITION BY {within}{key}
        ORDER BY ingestion_date DESC, collected_on DESC, pos DESC, part DESC) = 1"""


def _refined(target: str) -> str:
    key = "sold_id" if target == "sold" else "listing_id"
    return f"SELECT * EXCLUDE (pos, part) FROM ({_latest(_silver(SHIP_DATE, target), key)})"


def _upserted(target: str, merge_key: str = "listing_id") -> str:
    """Both days refined, then the second day's rows in place of the first's."""
    key = "sold_id" if target == "sold" else "listing_id"
    rows = _latest(_silver(ARRIVAL, target), key, "ingestion_date, ")
    return f"""WITH days AS ({rows})
        SELECT * EXCLUDE (pos, part) FROM days WHERE ingestion_date = DATE '{d.DAY_2}'
        UNION ALL BY NAME
        SELECT * EXCLUDE (pos, part) FROM days t WHERE ingestion_date = DATE '{d.DAY_1}'
          AND NOT EXISTS (SELECT 1 FROM days s WHERE s.ingestion_date = DATE '{d.DAY_2}'
                          AND s.{merge_key} = t.{merge_key})"""


LINES = f"""SELECT l_orderkey AS listing_id, l_extendedprice AS price,
    CASE WHEN l_linestatus = 'F' THEN DATE '{d.DAY_1}' ELSE DATE '{d.DAY_2}' END AS ingestion_date
    FROM lineitem"""
ORDERS = f"""SELECT {d.ORDER_KEY} AS listing_id, o_totalprice AS price,
    CASE WHEN o_orderstatus = 'F' THEN DATE '{d.DAY_1}' ELSE DATE '{d.DAY_2}' END AS ingestion_date
    FROM orders"""


def _each_match(condition: str) -> str:
    return f"""WITH t AS ({LINES}), s AS ({ORDERS})
        SELECT t.listing_id,
            CASE WHEN s.listing_id IS NULL THEN t.price ELSE s.price END AS price,
            CASE WHEN s.listing_id IS NULL THEN t.ingestion_date ELSE s.ingestion_date END AS ingestion_date
        FROM t LEFT JOIN s ON s.listing_id = t.listing_id AND {condition}
        UNION ALL
        SELECT listing_id, price, ingestion_date FROM s
        WHERE listing_id NOT IN (SELECT listing_id FROM t)"""


def _embedded(found: str, number: str, fields: dict) -> str:
    return f"""SELECT CAST(l_orderkey AS VARCHAR) AS url_key, {OFFSET} AS "offset", {d.PARTITION} AS partition,
        md5(CASE WHEN {found} THEN concat({_object(fields)}, {TRAILING}) ELSE '' END) AS text_md5,
        CASE WHEN {found} AND NOT ({d.ID_IS_TEXT}) THEN {number} END AS id FROM lineitem"""


HAS_OBJECT = f"NOT ({d.NO_DATA_LAYER} OR {d.OBJECT_ON_TWO_LINES})"

SAMPLED = f"""SELECT url FROM (SELECT {ORDER_URL} AS url FROM orders)
    ORDER BY md5(concat('%s', url)), url LIMIT 2400"""

SITEMAP_URLS = f"""
    SELECT o_orderkey, o_orderstatus, concat('{LISTING_ORDER}', o_orderkey) AS url FROM orders
    UNION ALL
    SELECT o_orderkey, o_orderstatus, concat('{LISTING_CUSTOMER}', o_custkey, '&x=1') FROM orders
    WHERE o_orderstatus <> 'F'"""

ORACLE = {
    "log_read": f"SELECT {EVENT_BRONZE} FROM events",
    "offset_resume": f"""
        SELECT event_type AS topic, CAST(user_id % 4 AS INT) AS partition, event_id AS "offset", props AS value
        FROM events LEFT JOIN ({READ_BEFORE}) b
          ON b.topic = event_type AND b.partition = user_id % 4
        WHERE event_id >= coalesce(next_offset, 0)""",
    "offset_latest": """
        SELECT event_type AS topic, CAST(user_id % 4 AS INT) AS partition, max(event_id) AS "offset"
        FROM events GROUP BY ALL""",
    "offset_latest_record": """
        SELECT event_type AS topic, CAST(user_id % 4 AS INT) AS partition,
            max(event_id) AS "offset", arg_max(props, event_id) AS value
        FROM events GROUP BY ALL""",
    "offset_commit": """
        WITH stored AS (
            SELECT target, event_type AS topic, user_id % 4 AS partition, max(event_id) + 1 AS next_offset
            FROM events, (VALUES ('forsale'), ('sold')) v(target) GROUP BY ALL
            UNION ALL
            SELECT 'forsale', event_type, 11, min(event_id) + 1 FROM events GROUP BY ALL)
        SELECT target, topic, concat('{', string_agg(concat('"', partition, '":', next_offset), ','
            ORDER BY partition), '}') AS offsets
        FROM stored GROUP BY target, topic""",
    "offset_reset": f"""
        SELECT event_type AS topic, CAST(user_id % 4 AS INT) AS partition, event_id AS "offset", props AS value
        FROM events
        WHERE event_type = '{RESET_TOPIC}' AND user_id % 4 = {RESET_PARTITION} AND event_id >= {RESET_TO}""",
    "ingest_today": """
        SELECT CAST(user_id % 4 AS INT) AS partition, event_id AS "offset", true AS is_today FROM events""",
    "bronze_ingest": f"""
        SELECT {EVENT_BRONZE}, CASE WHEN event_id < coalesce((
                SELECT max(event_id) + 1 FROM events b
                WHERE CAST(b.ts AS DATE) < DATE '{READ_UNTIL}' AND b.user_id % 4 = e.user_id % 4), 0)
            THEN DATE '{d.DAY_1}' ELSE DATE '{d.DAY_2}' END AS ingestion_date
        FROM events e""",
    "bronze_for_date": f"""
        SELECT {EVENT_BRONZE}, CAST(ts AS DATE) AS ingestion_date FROM events
        WHERE CAST(ts AS DATE) = DATE '{EVENT_DATE}'""",
    "stream_ingest": f"""
        SELECT * EXCLUDE (event_type) REPLACE (event_type AS topic) FROM (
            SELECT {EVENT_BRONZE}, CAST(ts AS DATE) AS ingestion_date, event_type FROM events)""",
    "envelope_encode": """
        SELECT page_id, url, html AS source, CAST(page_id AS DOUBLE) + 0.25 AS "timestamp" FROM pages""",
    "envelope_parse": f"""
        SELECT {SHIP_DATE} AS ingestion_date, {OFFSET} AS "offset", {d.PARTITION} AS partition, {LINE_URL} AS url,
            CAST(l_linenumber AS DOUBLE) AS collected_on, CAST(l_orderkey AS VARCHAR) AS url_key,
            {d.PROP_TYPE} AS prop_type, md5({FORSALE_PAGE}) AS source_md5
        FROM lineitem""",
    "url_key": """
        SELECT page_id, tail, list_extract(string_split(tail, '-'), -1) AS url_key,
            list_extract(string_split(tail, '-'), 1) AS prop_type
        FROM (SELECT page_id, list_extract(string_split(url, '/'), -1) AS tail FROM pages)""",
    "url_id_whole": "SELECT page_id, list_extract(string_split(url, '-'), -1) AS id FROM pages",
    "datalayer_property": _embedded(HAS_OBJECT, "l_orderkey", d.FORSALE),
    "datalayer_sold": _embedded(HAS_OBJECT, "l_orderkey", d.SOLD),
    "props_forsale": f"""
        SELECT {OFFSET} AS "offset", {d.PARTITION} AS partition, {FORSALE} FROM lineitem WHERE {LISTED}""",
    "props_canonical": f"""
        SELECT {OFFSET} AS "offset", {d.PARTITION} AS partition, {CANONICAL} FROM lineitem WHERE {LISTED}""",
    "props_sold": f"""
        SELECT {OFFSET} AS "offset", {d.PARTITION} AS partition, {HOME_ID} AS prop_id, {SOLD}
        FROM lineitem WHERE {SOLD_LISTED}""",
    "latest_per_key": """
        SELECT * FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_orderkey
            ORDER BY l_shipdate DESC, l_linenumber DESC, l_partkey DESC, l_suppkey DESC) = 1""",
    "refine_forsale": _refined("forsale"),
    "refine_sold": _refined("sold"),
    "refine_canonical": _refined("canonical"),
    "refine_rejects": f"""
        SELECT {OFFSET} AS "offset", {d.PARTITION} AS partition, CAST(l_orderkey AS VARCHAR) AS url_key,
            CASE WHEN {d.NO_DATA_LAYER} THEN 'no data layer' WHEN {d.OBJECT_ON_TWO_LINES} THEN 'no object'
                ELSE 'id of another type' END AS reason
        FROM lineitem WHERE NOT ({LISTED})""",
    "upsert_first_run": f"SELECT *, false AS before, true AS after FROM ({LINES})",
    "upsert_forsale": _upserted("forsale"),
    "upsert_sold": _upserted("sold"),
    "upsert_sold_by_sale": _upserted("sold", "sold_id"),
    "upsert_canonical": _upserted("canonical"),
    "upsert_each_match": _each_match("true"),
    "upsert_only_newer": _each_match("s.ingestion_date >= t.ingestion_date"),
    "upsert_conflicts": f"""
        SELECT l_orderkey AS listing_id, count(*) AS copies FROM lineitem
        WHERE l_orderkey IN (SELECT listing_id FROM ({ORDERS}))
        GROUP BY l_orderkey HAVING count(*) > 1""",
    "run_metrics": f"""
        SELECT for_date, count(*) AS records, count(DISTINCT listed) AS stored
        FROM (SELECT {ARRIVAL} AS for_date, CASE WHEN {LISTED} THEN l_orderkey END AS listed FROM lineitem)
        GROUP BY for_date""",
    "daily_run": _upserted("forsale"),
    "daily_run_sold": _upserted("sold"),
    "stream_refine": _upserted("forsale"),
    "frontier_unvisited": f"""
        SELECT {LINE_URL} AS url, l_linenumber, l_shipdate FROM lineitem
        WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_orderkey = l_orderkey AND o_orderstatus = 'F')""",
    "visited_buckets": f"""
        SELECT {LINE_URL} AS url, l_linenumber, l_shipdate FROM lineitem
        WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_orderkey = l_orderkey AND o_orderstatus IN ('F', 'P'))""",
    "frontier_commit": f"""
        SELECT 'pending' AS part, {ORDER_URL} AS item FROM orders WHERE o_orderstatus <> 'F'
        UNION ALL SELECT 'visited', CAST(o_orderkey AS VARCHAR) FROM orders
        UNION ALL SELECT 'visited', CAST(o_orderkey AS VARCHAR) FROM orders WHERE o_orderstatus = 'F'""",
    "pending_add": f"SELECT {ORDER_URL} AS url FROM orders UNION SELECT {LINE_URL} FROM lineitem",
    "frontier_sample": SAMPLED % "1:",
    "frontier_round": f"""
        WITH urls AS (SELECT {ORDER_URL} AS url, o_orderstatus = 'F' AS seen FROM orders),
            drawn AS ({SAMPLED % "2:"})
        SELECT 'fetch' AS part, url AS item FROM urls JOIN drawn USING (url) WHERE NOT seen
        UNION ALL
        SELECT 'pending', url FROM urls WHERE NOT seen OR url NOT IN (SELECT url FROM drawn)""",
    "link_extract": """
        SELECT page_id, unnest(regexp_extract_all(html, 'href="([^"]+)"', 1)) AS link FROM pages""",
    "link_extract_scoped": """
        SELECT page_id, unnest(list_append(regexp_extract_all(
            regexp_extract(html, '(?s)<nav>(.*?)</nav>', 1), 'href="([^"]+)"', 1),
            concat('/second-', page_id)) || ['/bracket', '/plain', '/good', '/r?a&b&c']) AS link
        FROM pages""",
    "link_extract_sold": """
        SELECT page_id, unnest([concat('https://www.example.org/salda/villa-', page_id), concat(
            'https://www.example.org/salda/a-1">y</a> <a class="b" href="https://www.example.org/salda/b-',
            page_id)]) AS link
        FROM pages""",
    "related_link": "SELECT DISTINCT url FROM pages WHERE url LIKE 'https://%'",
    "sitemap_urls": f"""
        SELECT o_orderkey, url, false AS broken FROM ({SITEMAP_URLS}) WHERE NOT {CUT_OFF}
        UNION ALL SELECT o_orderkey, NULL, true FROM orders WHERE {CUT_OFF}""",
    "sitemap_files": f"SELECT url FROM ({SITEMAP_URLS})",
    "sitemap_round": f"""
        SELECT o_orderkey, url FROM ({SITEMAP_URLS}) WHERE NOT (o_orderstatus = 'F' AND url LIKE '{LISTING_ORDER}%')""",
    "fetch_round": f"""
        WITH p AS (
            SELECT page_id, url, {RELATED} AS related, list_extract(string_split(url, '-'), -1) AS id,
                {FETCH_STATUS} < 300 AS ok
            FROM pages)
        SELECT 'message' AS part, url AS item FROM p WHERE ok
        UNION ALL SELECT DISTINCT 'pending', u FROM (
            SELECT related AS u FROM p WHERE ok OR page_id % 3 = 0 UNION SELECT url FROM p WHERE page_id % 2 = 0)
        WHERE u NOT IN (SELECT url FROM p WHERE ok)
        UNION ALL SELECT DISTINCT 'visited', id FROM p WHERE ok OR page_id % 4 = 0""",
    "fetch_ok": """
        SELECT event_id, CAST(CASE event_type WHEN 'view' THEN 299 ELSE 200 END AS INT) AS status FROM events
        WHERE event_type NOT IN ('error', 'signup')""",
}
