"""What the named queries should return, stated in SQL over the same tables."""

from __future__ import annotations

REQ = "req AS (SELECT page_id, url, regexp_extract(url, '^[a-z]+://([^/:?#]+)', 1) AS host FROM pages)"

STATE = (
    REQ
    + """,
host_state AS (
  SELECT host, count(*) AS count, CASE WHEN count(*) >= 9 AND NOT starts_with(host, 'www.') THEN '1' ELSE '0' END AS status
  FROM req GROUP BY host)"""
)

# What the parser must make of the derived request texts, told from the pages alone.
PARSED = (
    REQ
    + """,
base AS (
  SELECT page_id, url, host, CAST(page_id AS VARCHAR) AS no,
    regexp_replace(url, '^[a-z]+://[^/?#]+', '') AS rest, split_part(url, '://', 1) AS scheme,
    page_id % 2 = 0 AS is_get, page_id % 34 = 17 AS junk, page_id % 10 = 0 AS plain
  FROM pages JOIN (SELECT page_id, host FROM req) USING (page_id)),
every AS (
  SELECT page_id, no,
    CASE WHEN is_get THEN 'GET' WHEN junk OR page_id % 21 = 0 THEN NULL WHEN page_id % 13 = 0 THEN 'PUT' ELSE 'POST' END
      AS action_type,
    CASE WHEN is_get THEN page_id % 22 = 0 AND NOT plain ELSE junk OR page_id % 21 = 0 END AS bad,
    CASE WHEN junk OR page_id % 7 = 0 THEN '' ELSE host END AS host,
    CASE WHEN junk THEN '' WHEN is_get THEN rest || CASE WHEN page_id % 3 = 0
           THEN CASE WHEN contains(rest, '?') THEN '&' ELSE '?' END || 'token=[redacted]' ELSE '' END
           || CASE WHEN page_id % 9 = 2 THEN CASE WHEN contains(rest, '?') THEN '&' ELSE '?' END || 'k=[redacted]' ELSE '' END
         WHEN page_id % 21 = 0 THEN '' ELSE url END AS url,
    NOT is_get AND page_id % 3 = 1 AS has_username,
    CASE WHEN is_get THEN page_id % 6 = 0 AND NOT plain ELSE page_id % 3 = 1 OR page_id % 9 = 6 END AS has_password,
    CASE WHEN is_get THEN page_id % 9 = 2 OR (page_id % 9 = 8 AND NOT plain) ELSE page_id % 9 = 5 END AS has_key,
    CASE WHEN is_get AND plain THEN ''
      WHEN is_get
      THEN CASE WHEN page_id % 9 = 8 THEN 'memo[[:]][redacted][[--]]' ELSE '' END || 'page[[:]]' || no || CASE WHEN page_id % 6 = 0 THEN '[[--]]password[[:]][redacted]' ELSE '' END
           || '[[--]]title[[:]]' || host
      ELSE 'authorization[[:]][redacted][[--]]referer[[:]]' || url
        || CASE WHEN page_id % 9 = 7 THEN '[[--]]x-csrf-1[[:]][redacted]' ELSE '' END END AS fields,
    CASE WHEN NOT is_get THEN '[{"key":"page","value":"' || no || '"},{"key":"scheme","value":"' || scheme || '"},'
      || CASE WHEN page_id % 3 = 1 THEN '{"key":"username","value":"[redacted]"},{"key":"password","value":"[redacted]"},'
         ELSE '' END
      || CASE WHEN page_id % 9 = 6 THEN '{"key":"userpass","value":"[redacted]"},' ELSE '' END
      || CASE WHEN page_id % 9 = 5 THEN '{"key":"ref","value":"[redacted]"},' ELSE '' END
      || '{"key":"note","value":"will GET it"}]' END AS request_parameters
  FROM base),
parsed AS (SELECT * FROM every WHERE NOT bad),
framed AS (
  SELECT page_id, host || '|| action_type[[:]]' || action_type
    || CASE WHEN action_type = 'GET'
       THEN '[[--]]host[[:]]' || host || CASE WHEN fields <> '' THEN '[[--]]' || fields ELSE '' END
         || '[[--]]url[[:]]' || url
       ELSE '[[--]]authorization[[:]][redacted][[--]]host[[:]]' || host || '[[--]]'
         || split_part(fields, '[[--]]', 2) || '[[--]]request_parameters[[:]]' || request_parameters
         || '[[--]]url[[:]]' || url || CASE WHEN page_id % 9 = 7 THEN '[[--]]x-csrf-1[[:]][redacted]' ELSE '' END END AS line
  FROM parsed WHERE host <> '')"""
)

# The request texts themselves.
TEXTS = (
    REQ
    + """,
base AS (
  SELECT page_id, url, host, CAST(page_id AS VARCHAR) AS no, 'PLANTED-SECRET-' || page_id AS secret,
    regexp_replace(url, '^[a-z]+://[^/?#]+', '') AS rest, split_part(url, '://', 1) AS scheme,
    CASE WHEN page_id % 4 = 0 THEN '"' ELSE '\\"' END AS q, page_id % 3 AS day_no, page_id // 1000 AS chunk
  FROM req),
parts AS (
  SELECT *,
    CASE WHEN page_id % 7 <> 0
      THEN 'Host: ' || CASE WHEN page_id % 8 = 3 THEN upper(host) ELSE host END || CASE WHEN page_id % 4 < 2 THEN ':8080' ELSE '' END || chr(10) ELSE '' END AS host_line,
    q || 'Page' || q || '[[:]]' || q || no || q || ',' || q || 'Title' || q || '[[:]]' || q || host || q
      || CASE WHEN page_id % 6 = 0 THEN ',' || q || 'Password' || q || '[[:]]' || q || secret || q ELSE '' END
      || CASE WHEN page_id % 9 = 8 THEN ',' || q || 'Memo' || q || '[[:]]' || q || 'PLANTED9xQ2mZ7kL4vT8' || no || q ELSE '' END AS members
  FROM base),
texts AS (
  SELECT page_id, 20240101 + day_no AS day, chunk,
    no || CASE WHEN page_id % 2 = 0 THEN '.html' ELSE '.txt' END AS entry,
    CASE WHEN page_id % 34 = 17 THEN 'hello world' WHEN page_id % 2 = 0 THEN
      'GET ' || rest || CASE WHEN page_id % 3 = 0
        THEN CASE WHEN contains(rest, '?') THEN '&' ELSE '?' END || 'token=' || secret ELSE '' END
        || CASE WHEN page_id % 9 = 2
        THEN CASE WHEN contains(rest, '?') THEN '&' ELSE '?' END || 'k=AKIAPLANTEDSECRET' || no ELSE '' END
        || ' HTTP/1.1' || chr(10) || host_line || 'Cookie: sid=' || secret
        || CASE WHEN page_id % 10 = 0 THEN ''
                WHEN page_id % 22 = 0 THEN chr(10) || chr(10) || '{"data":'
                WHEN page_id % 4 = 0 THEN chr(10) || chr(10) || '{"data":{' || members || '}}'
                ELSE chr(10) || chr(10) || '{"data":"{' || members || '}"}' END
    ELSE
      CASE WHEN page_id % 21 = 0 THEN 'POST/broken'
           ELSE CASE WHEN page_id % 13 = 0 THEN 'PUT ' ELSE 'POST ' END || CASE WHEN page_id % 5 = 0 THEN scheme || '://bob:' || secret || '@' || host || rest
                                ELSE url END || ' HTTP/1.1' END
        || chr(10) || host_line || 'Referer: ' || url || chr(10) || 'Authorization: Basic ' || secret || chr(10)
        || CASE WHEN page_id % 9 = 7 THEN 'X-Csrf-1: ' || secret || chr(10) ELSE '' END || chr(10)
        || 'Page[[:]]' || no || chr(10) || 'Scheme[[:]]' || scheme || chr(10) || 'Empty[[:]]' || chr(10)
        || CASE WHEN page_id % 3 = 1 THEN 'Username[[:]]PLANTED-USER-' || no || chr(10)
             || 'Password[[:]]' || secret || chr(10) ELSE '' END
        || CASE WHEN page_id % 9 = 6 THEN 'UserPass[[:]]' || secret || chr(10) ELSE '' END
        || CASE WHEN page_id % 9 = 5 THEN 'Ref[[:]]eyJhbGciOiJIUzI1NiJ9.' || secret || '.c2lnbmF0dXJlMQ' || chr(10) ELSE '' END
        || 'GET it now' || chr(10) || 'Note[[:]]will GET it' END AS text
  FROM parts)"""
)

EVENT_LINE = (
    "'by[[:]]' || user_id || '[[--]]event[[:]]' || event_id || '[[--]]none[[:]][[--]]type[[:]]' || event_type"
)


def _with(ctes: str, select: str) -> str:
    return f"WITH {ctes}\n{select}"


UNLISTED = "SELECT * FROM req WHERE host <> '' AND host NOT IN (SELECT host FROM host_state WHERE status <> '0')"
RANKED = f"SELECT host, count(*) AS count FROM ({UNLISTED}) GROUP BY host ORDER BY count DESC, host"
HALVES = (
    REQ
    + """,
old AS (
  SELECT host, count(*) AS count, CASE WHEN count(*) >= 9 AND NOT starts_with(host, 'www.') THEN '1' ELSE '0' END AS status
  FROM req WHERE page_id % 2 = 0 GROUP BY host),
new AS (SELECT host, count(*) AS count FROM req WHERE page_id % 2 = 1 GROUP BY host)"""
)
MERGED = """SELECT host, coalesce(old.count, 0) + coalesce(new.count, 0) AS count, coalesce(status, '0') AS status
FROM old FULL OUTER JOIN new USING (host)"""
TUMBLING = "strftime(date_trunc('day', ts), '%Y-%m-%d %H:%M:%S') AS window_start"

ORACLE: dict[str, str] = {
    # sources
    "scan_days_after": "SELECT event_id, event_type FROM events WHERE CAST(ts AS DATE) > DATE '2024-01-15'",
    "zip_listing": _with(
        TEXTS, "SELECT DISTINCT day, 'part-' || chunk || '.zip' AS name FROM texts"
    ),
    "zip_days_after": _with(
        TEXTS, "SELECT DISTINCT day, 'part-' || chunk || '.zip' AS name FROM texts WHERE day > 20240101"
    ),
    "zip_entries": _with(TEXTS, "SELECT day, entry, length(text) AS n_chars, md5(text) AS text_md5 FROM texts"),
    "listing_sorted": _with(
        TEXTS, "SELECT DISTINCT true AS is_dir, CAST(day AS VARCHAR) AS name FROM texts ORDER BY name"
    ),
    "archived_requests": _with(
        PARSED,
        """SELECT 20240101 + page_id % 3 AS day,
        no || CASE WHEN page_id % 2 = 0 THEN '.html' ELSE '.txt' END AS entry,
        host, url, action_type, has_password, fields FROM parsed""",
    ),
    "stream_source_counts": "SELECT event_type, count(*) AS count FROM events GROUP BY event_type",
    "state_keys": _with(REQ, "SELECT DISTINCT host FROM req ORDER BY host"),
    "state_lookup": _with(STATE, "SELECT * FROM host_state WHERE host = (SELECT min(host) FROM req)"),
    # scalar functions
    "request_host": _with(PARSED, "SELECT page_id, host FROM every"),
    "request_url": _with(PARSED, "SELECT page_id, url FROM every"),
    "request_method": _with(PARSED, "SELECT page_id, action_type FROM every"),
    "json_fields": "SELECT event_id, json_extract_string(props, '$.k') AS k, "
    "CAST(len(json_keys(props)) AS BIGINT) AS n_fields FROM events",
    "payload_fields": _with(PARSED, "SELECT page_id, fields FROM parsed WHERE action_type = 'GET'"),
    "form_params": _with(PARSED, "SELECT page_id, request_parameters FROM parsed WHERE action_type = 'POST'"),
    "kv_array": """SELECT event_id, '[{"key":"k","value":"' || json_extract_string(props, '$.k') || '"}]' AS pairs
        FROM events""",
    "headers": _with(PARSED, "SELECT page_id, fields AS headers FROM parsed WHERE action_type = 'POST'"),
    "redacted_props": "SELECT event_id, 'k[[:]][redacted]' AS props FROM events",
    "redacted_requests": _with(
        PARSED,
        "SELECT page_id, host, url, action_type, has_username, has_password, fields, request_parameters FROM parsed",
    ),
    "encode_map": f"SELECT event_id, {EVENT_LINE} AS line FROM events",
    "decode_map": "SELECT event_id, event_type AS m_type, CAST(event_id AS VARCHAR) AS m_event, "
    "CAST(user_id AS VARCHAR) AS m_by, '' AS m_none FROM events",
    "framed_lines": _with(PARSED, "SELECT line AS value FROM framed"),
    "frame_key": f"SELECT event_id, event_type AS key, {EVENT_LINE} AS line FROM events",
    "scalar_suite": """SELECT p_partkey, p_name AS trimmed, lower(p_type) AS lowered, substr(p_name, 1, 3) AS head,
        replace(p_name, ' ', '[[:]]') AS replaced, split_part(p_name, ' ', 2) AS second,
        replace(p_name, ' ', '[[--]]') AS joined, ends_with(p_name, 'ring') AS ends,
        CAST(replace(p_brand, 'Brand#', '') AS INTEGER) AS number, p_type = 'SMALL' AS blank,
        true AS uuid_ok, true AS millis_ok FROM part""",
    # filters
    "nonblank_key": _with(
        REQ, "SELECT page_id, host FROM req WHERE page_id % 7 <> 0 AND page_id % 11 <> 0 AND host <> ''"
    ),
    "nonblank_all": "SELECT p_partkey, p_brand AS brand, p_type AS type FROM part "
    "WHERE p_brand <> 'Brand#2' AND p_type <> 'SMALL'",
    "key_equals": "SELECT event_id, user_id FROM events WHERE event_type = 'purchase'",
    "drop_bad_records": _with(PARSED, "SELECT action_type, count(*) AS kept FROM parsed GROUP BY action_type"),
    "bad_records": _with(
        PARSED,
        "SELECT action_type, count(*) AS records, count(*) FILTER (bad) AS bad_records FROM every GROUP BY action_type",
    ),
    "listed_hosts": _with(STATE, "SELECT host, status FROM host_state WHERE status <> '0'"),
    # joins
    "unlisted_requests": _with(STATE, f"SELECT page_id, host, url FROM ({UNLISTED})"),
    "enrich_with_state": _with(
        HALVES,
        """SELECT page_id, host, coalesce(count, 0) AS known_count, coalesce(status, '0') AS known_status
        FROM req LEFT JOIN old USING (host)""",
    ),
    "unlisted_spread": _with(STATE, f"SELECT page_id, host, url FROM ({UNLISTED})"),
    "unlisted_stream": _with(STATE, f"SELECT page_id, host, host || '|| ' || url AS line FROM ({UNLISTED})"),
    "sift_archives": _with(
        PARSED
        + """,
        listed AS (SELECT host FROM req GROUP BY host HAVING count(*) >= 9 AND NOT starts_with(host, 'www.'))""",
        """SELECT no || CASE WHEN page_id % 2 = 0 THEN '.html' ELSE '.txt' END AS entry, line
        FROM framed JOIN parsed USING (page_id) WHERE host NOT IN (SELECT host FROM listed)""",
    ),
    # aggregations
    "host_counts": _with(REQ, "SELECT host, count(*) AS count FROM req GROUP BY host"),
    "state_merge": _with(HALVES, MERGED),
    "state_table": _with(HALVES, MERGED),
    "total_count": "SELECT count(*) AS total_count FROM pages",
    "distinct_per_key": "SELECT DISTINCT event_type, user_id FROM events",
    "exposure_by_host": _with(
        PARSED,
        """SELECT host, count(*) AS requests, count(*) FILTER (has_username) AS with_username,
        count(*) FILTER (has_password) AS with_password, count(*) FILTER (action_type <> 'GET') AS with_basic,
        0::BIGINT AS with_bearer, count(*) FILTER (action_type = 'GET') AS with_session,
        count(*) FILTER (action_type <> 'GET' AND page_id % 5 = 0) AS with_userinfo,
        count(*) FILTER (has_key) AS with_key,
        count(*) FILTER (NOT starts_with(url, 'https://')) AS exposed,
        count(*) FILTER (NOT starts_with(url, 'https://')) / count(*) AS exposed_share
        FROM parsed GROUP BY host""",
    ),
    # order, ordinals, sets
    "hosts_by_count": _with(STATE, RANKED),
    "state_by_count": _with(STATE, "SELECT * FROM host_state ORDER BY count DESC, host"),
    "top_hosts": _with(REQ, "SELECT host, count(*) AS count FROM req GROUP BY host ORDER BY count DESC, host LIMIT 10"),
    "batch_ordinals": """SELECT event_id, strftime(ts, '%Y-%m-%d') AS day,
        row_number() OVER (PARTITION BY CAST(ts AS DATE) ORDER BY event_id) AS ordinal FROM events""",
    "time_ordinals": "SELECT event_id, row_number() OVER (ORDER BY ts, event_id) AS ordinal FROM events",
    "union_keys": _with(
        REQ, "SELECT host FROM req WHERE page_id % 2 = 0 UNION SELECT host FROM req WHERE page_id % 2 = 1"
    ),
    "key_difference": _with(STATE, "SELECT host FROM host_state EXCEPT SELECT host FROM host_state WHERE status = '0'"),
    # batches, windows, streams
    "count_batches": """WITH numbered AS (
          SELECT event_type, row_number() OVER (ORDER BY event_id) - 1 AS n FROM events)
        SELECT n // 2000 AS batch, event_type, count(*) AS count, CAST(max(n % 2000 + 1) AS INTEGER) AS last_seq
        FROM numbered GROUP BY ALL""",
    "archive_rows": _with(
        PARSED,
        """SELECT (row_number() OVER (ORDER BY page_id) - 1) // 100 AS batch,
        CAST((row_number() OVER (ORDER BY page_id) - 1) % 100 + 1 AS INTEGER) AS seq, line FROM framed""",
    ),
    "json_by_key": "SELECT event_id, user_id, event_type FROM events",
    "tumbling_counts": f"SELECT {TUMBLING}, event_type, count(*) AS count FROM events GROUP BY ALL",
    "windowed_distinct": f"SELECT DISTINCT {TUMBLING}, event_type, user_id FROM events",
    "windowed_distinct_stream": f"SELECT DISTINCT {TUMBLING}, event_type, user_id FROM events",
    # Days 11 to 19 come last, when the watermark, a day behind the last event, has passed their windows.
    "late_events": f"""SELECT DISTINCT {TUMBLING}, event_type, user_id, NULL::BIGINT AS event_id, 'window' AS kind
        FROM events WHERE day(ts) NOT BETWEEN 11 AND 19
        UNION ALL SELECT {TUMBLING}, event_type, user_id, event_id, 'late' FROM events WHERE day(ts) BETWEEN 11 AND 19""",
    "count_or_time_batches": """WITH RECURSIVE numbered AS (
          SELECT event_type, ts, row_number() OVER (PARTITION BY event_type ORDER BY ts) AS i,
            count(*) OVER (PARTITION BY event_type) AS n, max(ts) OVER () AS latest,
            count(*) OVER (PARTITION BY event_type ORDER BY ts
              RANGE BETWEEN UNBOUNDED PRECEDING AND INTERVAL '12 hours' - INTERVAL '1 microsecond' FOLLOWING) AS through FROM events),
        starts AS (SELECT *, least(i + 30, through + 1) AS next FROM numbered),
        batch AS (
          SELECT event_type, 0::BIGINT AS batch, i, next, ts, n, latest FROM starts WHERE i = 1
          UNION ALL SELECT s.event_type, batch + 1, s.i, s.next, s.ts, s.n, s.latest
          FROM batch b JOIN starts s ON s.event_type = b.event_type AND s.i = b.next)
        SELECT event_type, batch, epoch_us(b.ts) AS first, epoch_us(l.ts) AS last, b.next - b.i AS rows,
          CASE WHEN b.next - b.i = 30 THEN 'count' ELSE 'time' END AS closed_by
        FROM batch b JOIN numbered l USING (event_type) WHERE l.i = b.next - 1
          AND (b.next - b.i = 30 OR b.next <= b.n OR b.ts + INTERVAL '12 hours' <= b.latest - INTERVAL '1 hour')""",
    "fan_out": """SELECT 'by_type' AS step, event_type AS key, count(*) AS count FROM events GROUP BY ALL
        UNION ALL SELECT 'by_day', strftime(ts, '%Y-%m-%d'), count(*) FROM events GROUP BY ALL""",
    "running_counts": _with(REQ, "SELECT host, count(*) AS count, '0' AS status FROM req GROUP BY host"),
    "running_counts_two_writers": _with(REQ, "SELECT host, 2 * count(*) AS count, '0' AS status FROM req GROUP BY host"),
    "late_file_stream": _with(REQ, "SELECT page_id, host FROM req"),
    "resumed_ingest": _with(
        PARSED, "SELECT 20240101 + page_id % 3 AS day, host, count(*) AS requests FROM parsed GROUP BY ALL"
    ),
    "added_to_finished_day": _with(
        PARSED,
        """SELECT 20240101 + page_id % 3 AS day, no || CASE WHEN page_id % 2 = 0 THEN '.html' ELSE '.txt' END AS entry,
        host, url, page_id % 4 = 3 AS added FROM parsed""",
    ),
    "listing_two_writers": _with(
        STATE
        + """,
        crc_table AS MATERIALIZED (
          SELECT list(list_reduce([b] || range(8), lambda c, i: xor(c >> 1, CASE WHEN c & 1 = 1 THEN 3988292384 ELSE 0 END))
            ORDER BY b) AS t FROM range(256) AS x(b)),
        shared AS (
          SELECT host, status, xor(list_reduce([4294967295] || list_transform(string_split(host, ''), lambda s: ascii(s)::BIGINT),
            lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) % 8 = 0 AS turned
          FROM host_state, crc_table)""",
        "SELECT host, CASE WHEN turned THEN CASE status WHEN '0' THEN '1' ELSE '0' END ELSE status END AS status, turned FROM shared",
    ),
    "stopped_and_restarted": _with(REQ, "SELECT host, count(*) AS count, '0' AS status FROM req GROUP BY host"),
    # steps by name
    "steps_from_spec": _with(STATE, RANKED),
    "stream_from_spec": _with(
        STATE, f"SELECT host, count(*) AS count, count(*) AS archived, count(DISTINCT url) AS lines FROM ({UNLISTED}) GROUP BY host"
    ),
    "archives_to_archive": _with(
        PARSED,
        """SELECT (row_number() OVER (ORDER BY page_id) - 1) // 100 AS batch,
        CAST((row_number() OVER (ORDER BY page_id) - 1) % 100 + 1 AS INTEGER) AS seq, line FROM framed""",
    ),
}
