"""The same results as :mod:`callflow.plans.queries` in ANSI SQL on the given tables."""

from __future__ import annotations

from callflow.plans.inputs import MADE_FIELDS

# The call export and what normalising makes of it: n has all rows, g the good ones.
CALLS = r"""
WITH src AS (
  SELECT event_id AS seq,
    CASE WHEN event_id % 97 = 0 THEN '' ELSE CAST(event_id % 4000 AS VARCHAR) END AS call_raw,
    CASE event_id % 50 WHEN 0 THEN '' WHEN 1 THEN 'NULL' WHEN 2 THEN 'abc' WHEN 3 THEN '12.5'
      ELSE CAST(user_id AS VARCHAR) END AS lead_raw,
    event_type, ts AS date_time,
    CASE event_id % 40 WHEN 0 THEN '' WHEN 1 THEN '1:2' WHEN 2 THEN '0:00:00'
      WHEN 3 THEN 'x:y:z' WHEN 4 THEN '1:2:3:4'
      ELSE concat(CAST(event_id % 3 AS VARCHAR), ':', CAST(event_id % 60 AS VARCHAR),
                  ':', CAST(user_id % 60 AS VARCHAR)) END AS dur_raw
  FROM events),
n AS (
  SELECT seq, date_time, event_type AS call_type,
    nullif(nullif(call_raw, ''), 'NULL') AS call_id,
    nullif(nullif(lead_raw, ''), 'NULL') AS lead_text,
    md5(concat('Supplier#', lpad(lead_raw, 9, '0'))) AS broker_id,
    CASE WHEN regexp_matches(lead_raw, '^\s*[+-]?[0-9]+\s*$')
      THEN try_cast(trim(lead_raw) AS INTEGER) END AS lead_id,
    CASE WHEN regexp_matches(dur_raw, '^\s*[+-]?[0-9]+\s*:\s*[+-]?[0-9]+\s*:\s*[+-]?[0-9]+\s*$')
      THEN nullif(try_cast(trim(split_part(dur_raw, ':', 1)) AS BIGINT) * 3600
                + try_cast(trim(split_part(dur_raw, ':', 2)) AS BIGINT) * 60
                + try_cast(trim(split_part(dur_raw, ':', 3)) AS BIGINT), 0) END AS talk_time
  FROM src),
g AS (
  SELECT seq, call_id, 'Velocify' AS call_platform, broker_id, lead_id, call_type, date_time,
    CAST(talk_time AS INTEGER) AS talk_time
  FROM n
  WHERE call_id IS NOT NULL AND (lead_text IS NULL OR lead_id IS NOT NULL)),
latest AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY call_id ORDER BY seq DESC) AS rn FROM g) AS t
  WHERE rn = 1)
"""

BROKERS = """
SELECT md5(s_name) AS broker_id, s_name AS broker_name,
  concat('+1555', lpad(CAST(s_suppkey AS VARCHAR), 7, '0')) AS phonenumber,
  concat('broker', CAST(s_suppkey AS VARCHAR), '@example.com') AS email,
  CAST(s_suppkey % 200 AS VARCHAR) AS extension, n_name AS state,
  CASE WHEN s_acctbal > 5000 THEN 'Sr' ELSE 'Jr' END AS role
FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey
"""

TRANSCRIPTS = """
SELECT md5(CAST(conv_id AS VARCHAR)) AS transcript_id, CAST(conv_id AS VARCHAR) AS call_id, text AS transcript
FROM (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC) AS rn
      FROM conversations) AS t
WHERE rn = 1
"""

LATEST_CALLS = CALLS + """
SELECT call_id, call_platform, broker_id, lead_id, call_type, date_time, talk_time FROM latest
"""

CHUNKS = """
SELECT o_orderkey, CAST(floor((row_number() OVER (ORDER BY o_orderkey) - 1) / 2000) + 1 AS INTEGER) AS part
FROM orders
"""

REJECTS = CALLS + """
SELECT seq, CASE WHEN call_id IS NULL THEN 'call_id_missing' ELSE 'lead_id_not_integer' END AS reason
FROM n WHERE call_id IS NULL OR (lead_text IS NOT NULL AND lead_id IS NULL)
"""

NEW_LEADS = CALLS + """
SELECT CAST(s_suppkey AS INTEGER) AS lead_id, s_name AS source, CAST(NULL AS TIMESTAMP) AS creation_date FROM supplier
UNION ALL
SELECT lead_id, 'Velocify', date_time
FROM (SELECT *, row_number() OVER (PARTITION BY lead_id ORDER BY seq) AS rn FROM n WHERE lead_id IS NOT NULL) AS t
WHERE rn = 1 AND NOT EXISTS (SELECT 1 FROM supplier AS s WHERE s.s_suppkey = t.lead_id)
"""

REPLACED_LEADS = """
WITH b AS (
  SELECT CAST(user_id AS INTEGER) AS lead_id, event_type AS source,
    CASE WHEN value > 20 THEN NULL ELSE 'Open' END AS lead_status,
    CAST(CAST(floor(value) AS BIGINT) AS VARCHAR) AS lead_score, ts AS creation_date
  FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS rn FROM events) AS t
  WHERE rn = 1)
SELECT lead_id, source, lead_status, lead_score, creation_date FROM b
UNION ALL
SELECT CAST(c_custkey AS INTEGER), c_mktsegment, CAST(NULL AS VARCHAR), CAST(NULL AS VARCHAR), CAST(NULL AS TIMESTAMP)
FROM customer AS c WHERE NOT EXISTS (SELECT 1 FROM b WHERE b.lead_id = c.c_custkey)
"""

WANTED = """
SELECT call_id, concat('https://rec.example/', CAST(event_id AS VARCHAR)) AS url, concat(call_id, '.mp3') AS target_key
FROM (SELECT event_id, CAST(event_id % 4000 AS VARCHAR) AS call_id,
        row_number() OVER (PARTITION BY event_id % 4000 ORDER BY event_id DESC) AS rn
      FROM events WHERE event_type = 'purchase' AND event_id % 97 <> 0) AS t
WHERE rn = 1
"""

MADE = ", ".join(
    f"CASE WHEN o_orderkey % 2 = {k % 2} THEN concat('{name} ', CAST(o_orderkey AS VARCHAR)) END AS {name}"
    for k, name in enumerate(MADE_FIELDS)
)

TWO_ARRIVALS = CALLS + """
SELECT call_id, call_platform, broker_id, lead_id, call_type, date_time, talk_time
FROM (SELECT *, row_number() OVER (PARTITION BY call_id ORDER BY seq % 3 <> 0 DESC, seq DESC) AS rn FROM g) AS t
WHERE rn = 1
"""

TWO_FETCHES = """
SELECT CAST(event_id % 4000 AS VARCHAR) AS id, strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') AS start_time,
  strftime(ts, '%Y-%m-%d') AS dt
FROM (SELECT *, row_number() OVER (
        PARTITION BY event_id % 4000 ORDER BY floor(event_id / 100) % 3 <> 0 DESC, event_id DESC) AS rn
      FROM events) AS t
WHERE rn = 1
"""

CHAINS = """
WITH RECURSIVE numbered AS (SELECT DISTINCT CAST(floor(event_id / 10) AS BIGINT) AS number FROM events),
nodes AS (
  SELECT CAST(floor(number / 700) AS BIGINT) AS feed, CAST(number AS VARCHAR) AS page,
    CASE WHEN number % 10 = 9 THEN NULL WHEN number % 50 = 24 THEN CAST(number - 4 AS VARCHAR)
      WHEN number % 40 = 33 THEN CAST(number + 3 AS VARCHAR) ELSE CAST(number + 1 AS VARCHAR) END AS following
  FROM numbered WHERE number % 30 <> 12),
leads AS (
  SELECT t.feed, t.page, min(s.page) AS before FROM nodes AS s JOIN nodes AS t ON s.feed = t.feed AND s.following = t.page
  GROUP BY t.feed, t.page),
walk AS (
  SELECT feed, page, page AS chain, CAST(0 AS BIGINT) AS place FROM nodes AS n
  WHERE NOT EXISTS (SELECT 1 FROM leads AS l WHERE l.feed = n.feed AND l.page = n.page)
  UNION ALL
  SELECT l.feed, l.page, chain, place + 1 FROM walk AS w JOIN leads AS l ON l.feed = w.feed AND l.before = w.page),
around AS (
  SELECT feed, page, page AS other FROM nodes AS n
  WHERE NOT EXISTS (SELECT 1 FROM walk AS w WHERE w.feed = n.feed AND w.page = n.page)
  UNION
  SELECT a.feed, a.page, l.page FROM around AS a JOIN leads AS l ON l.feed = a.feed AND l.before = a.other),
low AS (SELECT feed, page, min(other) AS chain FROM around GROUP BY feed, page),
rounds AS (
  SELECT feed, page, chain, CAST(0 AS BIGINT) AS place FROM low WHERE page = chain
  UNION ALL
  SELECT l.feed, l.page, chain, place + 1 FROM rounds AS r JOIN leads AS l ON l.feed = r.feed AND l.before = r.page
  WHERE l.page <> chain),
placed AS (SELECT * FROM walk UNION ALL SELECT * FROM rounds)
SELECT n.feed, n.page, chain, place,
  CASE WHEN following IS NULL THEN 'end' WHEN l.page IS NULL THEN 'open' WHEN l.before <> n.page THEN 'joined'
    WHEN l.page = chain THEN 'loop' END AS ends
FROM nodes AS n JOIN placed AS p ON p.feed = n.feed AND p.page = n.page
LEFT JOIN leads AS l ON l.feed = n.feed AND l.page = n.following
"""

ALL: dict[str, str] = {
    "duration_seconds": CALLS + "SELECT seq, talk_time FROM n",
    "clean_text": CALLS + "SELECT seq, call_id, lead_text, lead_id, CAST(NULL AS VARCHAR) AS absent FROM n",
    "object_keys": """
SELECT c_custkey, concat(c_name, '.json') AS record_key, concat(c_name, '.mp3') AS recording_key,
  c_name AS call_id, concat(c_name, '-part', CAST(c_nationkey AS VARCHAR), '.csv') AS chunk_key,
  md5(c_name) AS stable_id
FROM customer
""",
    "iso_times": "SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S.%fZ') AS iso FROM events",
    "time_formats": """
SELECT event_id, CASE WHEN event_id % 5 < 3 THEN date_trunc('second', ts)
  WHEN event_id % 5 = 3 THEN CAST(CAST(ts AS DATE) AS TIMESTAMP) END AS read
FROM events
""",
    "csv_scan": "SELECT conv_id, turn, role, text FROM conversations",
    "large_csv_scan": "SELECT doc_id, lang, text FROM documents",
    "csv_mixed_headers": CALLS + """
SELECT n.call_id, n.lead_text, n.call_type AS origin,
  CASE WHEN n.seq % 3 = 2 THEN NULL
    ELSE CASE n.call_type WHEN 'purchase' THEN concat('https://rec.example/', CAST(n.seq AS VARCHAR))
      WHEN 'error' THEN NULL ELSE concat('pending ', CAST(n.seq AS VARCHAR)) END END AS recording
FROM n
""",
    "row_order": """
SELECT o_orderkey, row_number() OVER (PARTITION BY floor(o_orderkey / 10000) ORDER BY o_orderkey) - 1 AS place FROM orders
""",
    "resume_rows": """
SELECT o_orderkey, o_orderpriority, place FROM (
  SELECT o_orderkey, o_orderpriority, CAST(floor(o_orderkey / 10000) AS BIGINT) AS f,
    row_number() OVER (PARTITION BY floor(o_orderkey / 10000) ORDER BY o_orderkey) - 1 AS place FROM orders) AS t
WHERE place >= f * 37 % 2500
""",
    "list_files": "SELECT c_nationkey AS nation, CAST(1 AS BIGINT) AS files FROM customer GROUP BY 1",
    "json_scan": """
SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k,
  concat('{"k":', json_extract_string(props, '$.k'), '}') AS json
FROM events
""",
    "page_records": """
SELECT CAST(floor(event_id / 100) AS BIGINT) AS page,
  CAST(row_number() OVER (PARTITION BY floor(event_id / 100) ORDER BY event_id) - 1 AS INTEGER) AS place,
  CAST(event_id % 4000 AS VARCHAR) AS id, strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') AS start_time
FROM events
""",
    "open_cursor": "SELECT CAST(CAST(floor(max(event_id) / 100) AS BIGINT) + 1 AS VARCHAR) AS cursor FROM events",
    "page_counts": "SELECT CAST(floor(event_id / 100) AS BIGINT) AS page, count(*) AS n FROM events GROUP BY 1",
    "numbered_pages": f"""
SELECT CAST(floor(o_orderkey / 100) AS BIGINT) + 1 AS page,
  CAST(row_number() OVER (PARTITION BY floor(o_orderkey / 100) ORDER BY o_orderkey) - 1 AS INTEGER) AS place,
  CAST(o_orderkey AS VARCHAR) AS id, strftime(o_orderdate, '%Y-%m-%d') AS start_time,
  o_orderpriority AS campaign, o_orderstatus AS lead_status, CAST(o_custkey AS VARCHAR) AS person_id, {MADE}
FROM orders
""",
    "pages_complete": """
SELECT page AS last_page, n < 100 AS complete
FROM (SELECT CAST(floor(o_orderkey / 100) AS BIGINT) + 1 AS page, count(*) AS n FROM orders GROUP BY 1) AS p
ORDER BY page DESC LIMIT 1
""",
    "page_gaps": """
WITH kept AS (
  SELECT DISTINCT n % 3 AS feed, CAST(floor(n / 3) AS BIGINT) AS number
  FROM (SELECT CAST(floor(o_orderkey / 100) AS BIGINT) + 1 AS n FROM orders) AS p
  WHERE n % 7 <> 3 AND n % 11 NOT IN (4, 5)),
before AS (SELECT feed, number, lag(number, 1, -1) OVER (PARTITION BY feed ORDER BY number) + 1 AS start FROM kept)
SELECT feed, start AS first_missing, number - 1 AS last_missing, number - start AS n FROM before WHERE number > start
""",
    "cursor_chains": CHAINS,
    "malformed_records": "SELECT event_id, concat(props, '}') AS raw FROM events WHERE event_type = 'error'",
    "wanted_records": """
SELECT call_id, url, concat(call_id, '.mp3') AS target_key
FROM (SELECT CAST(event_id % 4000 AS VARCHAR) AS call_id, props AS url,
        row_number() OVER (PARTITION BY event_id % 4000 ORDER BY event_id DESC) AS rn
      FROM events WHERE event_type = 'purchase') AS t
WHERE rn = 1
""",
    "source_filters": """
SELECT event_id, ts FROM events
WHERE event_type IN ('view', 'click') AND props IS NOT NULL AND props <> '' AND ts >= TIMESTAMP '2024-01-20 00:00:00'
""",
    "calls_yesterday": "SELECT event_id, ts FROM events WHERE CAST(ts AS DATE) = DATE '2024-01-15'",
    "table_scan": "SELECT * FROM customer",
    "stored_tables": CALLS + """
SELECT c_mktsegment AS source, call_type, count(*) AS calls, max(talk_time) AS longest
FROM latest LEFT JOIN customer ON lead_id = c_custkey GROUP BY c_mktsegment, call_type
""",
    "feed_union": CALLS + """
SELECT call_id, call_type AS origin, CAST(NULL AS BIGINT) AS turn FROM n
UNION ALL SELECT CAST(conv_id AS VARCHAR), CAST(NULL AS VARCHAR), turn FROM conversations
""",
    "reject_rows": REJECTS,
    "reject_reasons": CALLS + """, c AS (
  SELECT 'calls' AS feed, seq, CASE WHEN call_id IS NULL THEN 'call_id_missing'
    WHEN lead_text IS NOT NULL AND lead_id IS NULL THEN 'lead_id_not_integer'
    WHEN seq % 11 = 0 THEN 'time_unparsable' WHEN seq % 13 = 0 THEN 'talk_time_out_of_range' END AS reason
  FROM n
  UNION ALL
  SELECT 'leads', event_id, CASE WHEN event_id % 7 = 0 THEN 'lead_id_missing'
    WHEN event_id % 7 = 1 THEN 'lead_id_not_integer' WHEN event_id % 11 = 0 THEN 'time_unparsable' END
  FROM events)
SELECT feed, seq, reason FROM c WHERE reason IS NOT NULL
""",
    "upsert_calls": LATEST_CALLS,
    "upsert_prefiltered": LATEST_CALLS,
    "upsert_buckets": LATEST_CALLS,
    "upsert_leads": REPLACED_LEADS,
    "leads_of_both_feeds": CALLS + """, stored AS (
  SELECT CAST(c_custkey * 2 AS INTEGER) AS lead_id, c_mktsegment AS source, CAST(NULL AS TIMESTAMP) AS creation_date
  FROM customer
  UNION ALL
  SELECT CAST(s_suppkey AS INTEGER), s_name, CAST(NULL AS TIMESTAMP) FROM supplier AS s
  WHERE NOT EXISTS (SELECT 1 FROM customer AS c WHERE c.c_custkey * 2 = s.s_suppkey))
SELECT lead_id, source, creation_date FROM stored
UNION ALL
SELECT lead_id, 'Velocify', date_time
FROM (SELECT *, row_number() OVER (PARTITION BY lead_id ORDER BY seq) AS rn FROM n WHERE lead_id IS NOT NULL) AS t
WHERE rn = 1 AND NOT EXISTS (SELECT 1 FROM stored AS s WHERE s.lead_id = t.lead_id)
""",
    "upsert_transcripts": """
SELECT md5(CAST(conv_id AS VARCHAR)) AS transcript_id, CAST(conv_id AS VARCHAR) AS call_id, text AS transcript
FROM (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS first,
        row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC) AS last FROM conversations) AS t
WHERE (last = 1 AND (conv_id % 3 <> 1 OR conv_id % 2 = 1)) OR (first = 1 AND conv_id % 2 = 0 AND conv_id % 3 = 1)
""",
    "brokers": f"""
SELECT b.broker_id, b.broker_name, b.phonenumber, b.email, b.extension, b.state,
  CASE WHEN s_suppkey % 2 = 0 OR s_suppkey % 3 = 0 THEN b.role ELSE 'Old' END AS role
FROM ({BROKERS}) AS b JOIN supplier ON s_name = b.broker_name
""",
    "empty_tables": """
SELECT name, n FROM (VALUES ('stage', 0), ('customer', 0), ('call', 0), ('broker', 0), ('transcript', 0)) AS v(name, n)
UNION ALL SELECT 'lead', count(*) FROM customer
""",
    "insert_absent_leads": NEW_LEADS,
    "insert_values": """
SELECT p_partkey, p_name FROM part
UNION ALL SELECT * FROM (VALUES (5, 'fixture five'), (6, 'fixture six')) AS v(p_partkey, p_name)
""",
    "update_where": """
SELECT o_orderkey, o_orderstatus,
  CASE WHEN o_orderstatus = 'P' THEN 'updated' ELSE o_orderpriority END AS o_orderpriority
FROM orders
""",
    "delete_where": """
SELECT o_orderkey, o_orderpriority FROM orders WHERE NOT coalesce(o_orderpriority = '5-LOW', false)
""",
    "call_broker_transcript": CALLS + f""", b AS ({BROKERS}), tr AS ({TRANSCRIPTS})
SELECT c.call_id, c.call_platform, c.broker_id, c.lead_id, c.call_type,
  CAST(NULL AS BOOLEAN) AS call_forwarded, c.date_time, c.talk_time, CAST(NULL AS VARCHAR) AS outcome,
  tr.transcript, b.broker_name, b.phonenumber, b.email, b.extension, b.state, b.role,
  CAST(NULL AS VARCHAR) AS broker_tenure
FROM latest AS c
LEFT JOIN b ON c.broker_id = b.broker_id
LEFT JOIN tr ON c.call_id = tr.call_id
""",
    "report_doubled_brokers": CALLS + f""", b AS (
  SELECT x.*, s_suppkey FROM ({BROKERS}) AS x JOIN supplier ON s_name = x.broker_name), both_rows AS (
  SELECT broker_id, broker_name, role FROM b
  UNION ALL SELECT broker_id, broker_name, 'again' FROM b WHERE s_suppkey % 2 = 0)
SELECT c.call_id, c.broker_id, t.broker_name, t.role FROM latest AS c LEFT JOIN both_rows AS t ON c.broker_id = t.broker_id
""",
    "fk_orphans": CALLS + """
SELECT g.seq, g.lead_id FROM g
WHERE g.lead_id IS NOT NULL AND NOT EXISTS (SELECT 1 FROM supplier AS s WHERE s.s_suppkey = g.lead_id)
""",
    "fk_orphan_keys": CALLS + """
SELECT g.lead_id, count(*) AS n FROM g
WHERE g.lead_id IS NOT NULL AND NOT EXISTS (SELECT 1 FROM supplier AS s WHERE s.s_suppkey = g.lead_id)
GROUP BY g.lead_id
""",
    "pk_duplicates": CALLS + "SELECT call_id, count(*) AS n FROM g GROUP BY call_id HAVING count(*) > 1",
    "pk_broken": CALLS + """
SELECT call_id, count(*) AS n FROM n GROUP BY call_id HAVING count(*) > 1 OR call_id IS NULL
""",
    "overlong_text": """
SELECT doc_id, 'source' AS column_name, CAST(strlen(text) AS INTEGER) AS octets FROM documents WHERE strlen(text) > 255
UNION ALL SELECT doc_id, 'lead_status', CAST(strlen(lang) AS INTEGER) FROM documents WHERE strlen(lang) > 255
UNION ALL SELECT doc_id, 'lead_score', CAST(strlen(source) AS INTEGER) FROM documents WHERE strlen(source) > 255
""",
    "json_export": """
SELECT event_id AS id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k
FROM events WHERE json_extract_string(props, '$.k') NOT IN ('0', '', 'false', 'null', '{}', '[]')
""",
    "land_records": """
SELECT CAST(event_id % 4000 AS VARCHAR) AS id, strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') AS start_time,
  strftime(ts, '%Y-%m-%d') AS dt
FROM (SELECT *, row_number() OVER (PARTITION BY event_id % 4000 ORDER BY event_id DESC) AS rn FROM events) AS t
WHERE rn = 1
""",
    "land_two_fetches": TWO_FETCHES,
    "chunk_rows": CHUNKS,
    "chunk_counts": f"SELECT part, count(*) AS n FROM ({CHUNKS}) AS c GROUP BY part",
    "pending_recordings": WANTED + " AND call_id NOT IN (SELECT CAST(conv_id AS VARCHAR) FROM conversations)",
    "retention_expired": """
SELECT event_id FROM events WHERE ts < TIMESTAMP '2024-02-14 00:00:00' - INTERVAL '2592000' SECOND
""",
    "retention_kept": """
SELECT event_id FROM events WHERE NOT coalesce(ts < TIMESTAMP '2024-02-14 00:00:00' - INTERVAL '2592000' SECOND, false)
""",
    "export_chunks": """
SELECT f, part, count(*) AS n, min(o_orderkey) AS first_key, max(o_orderkey) AS last_key
FROM (SELECT o_orderkey, f, CAST((row_number() OVER (PARTITION BY f ORDER BY o_orderkey) - 1) // 2000 + 1 AS INTEGER) AS part
      FROM (SELECT o_orderkey, CAST(floor(o_orderkey / 10000) AS BIGINT) AS f FROM orders) AS o) AS t
GROUP BY f, part
""",
    "unknown_recordings": """
SELECT 'unknown' AS call_id, concat('https://rec.example/', CAST(max(event_id) AS VARCHAR)) AS url,
  'unknown.mp3' AS target_key
FROM events WHERE event_type = 'purchase' HAVING count(*) > 0
""",
    "stream_calls": LATEST_CALLS,
    "stream_two_batches": TWO_ARRIVALS,
    "stream_put_again": TWO_ARRIVALS,
    "stream_pages": TWO_FETCHES,
    "stream_new_leads": NEW_LEADS,
    "stream_rejects": REJECTS,
    "stream_recordings": WANTED,
    "stream_leads": REPLACED_LEADS,
}
