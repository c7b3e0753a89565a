"""The same queries as SQL over the same tables, for checking."""

from __future__ import annotations

TRAFFIC = """
traffic AS (
  SELECT event_id, ts AS event_time, CAST(user_id AS VARCHAR) AS client_ip,
         CAST(json_extract(props, '$.k') AS BIGINT) AS c2s_pkt_num,
         CAST(json_extract(props, '$.k') AS BIGINT) % 7 AS s2c_pkt_num,
         CAST(floor(value * 100) AS BIGINT) AS c2s_byte_num,
         CAST(floor(value * 10) AS BIGINT) AS s2c_byte_num
  FROM events)"""

HOSTS = TRAFFIC + """,
hosts AS (
  SELECT time_bucket(INTERVAL '1 hour', event_time) + INTERVAL '1 hour' AS window_end, client_ip,
         count(*) AS session_num,
         CAST(sum(c2s_pkt_num) AS BIGINT) AS c2s_pkt_num, CAST(sum(s2c_pkt_num) AS BIGINT) AS s2c_pkt_num,
         CAST(sum(c2s_byte_num) AS BIGINT) AS c2s_byte_num, CAST(sum(s2c_byte_num) AS BIGINT) AS s2c_byte_num
  FROM traffic GROUP BY ALL)"""


def _ranked(order_by: str, measure: str, closed: bool = False) -> str:
    where = "WHERE window_end <= (SELECT max(ts) - INTERVAL '5 seconds' FROM events)" if closed else ""
    return HOSTS + f""",
ranked AS (
  SELECT CAST(row_number() OVER (PARTITION BY window_end ORDER BY {measure} DESC, client_ip) AS INTEGER) AS rank,
         client_ip, session_num, '{order_by}' AS order_by,
         c2s_pkt_num, s2c_pkt_num, c2s_byte_num, s2c_byte_num, epoch_ms(window_end) AS window_end_ms
  FROM hosts {where}
  QUALIFY rank <= 5)"""


#: Every seventh event arrives a step late; a step's watermark is that of all steps before it.
LATE_HOSTS = """
WITH arrived AS MATERIALIZED (
  SELECT event_id, CAST(floor(event_id * 4 / (SELECT max(event_id) + 1 FROM events)) AS INT)
                   + CASE WHEN event_id % 7 = 3 THEN 1 ELSE 0 END AS step,
         time_bucket(INTERVAL '1 hour', ts) + INTERVAL '1 hour' AS closes, ts
  FROM events
),
marks AS (
  SELECT step, max(max(ts)) OVER (ORDER BY step ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) - INTERVAL '5 seconds' AS mark
  FROM arrived GROUP BY step
),
on_time AS (SELECT event_id FROM arrived JOIN marks USING (step) WHERE mark IS NULL OR closes > mark),
""" + _ranked("session_num", "session_num", closed=True).replace("FROM events)", "FROM events SEMI JOIN on_time USING (event_id))", 1) \
    + " SELECT * FROM ranked"


def _report(order_by: str, measure: str, head: str, closed: bool = False) -> str:
    return "WITH " + _ranked(order_by, measure, closed) + f"""
SELECT window_end_ms,
       repeat('=', 36) || chr(10) || {head} || string_agg(
         'No' || (rank - 1) || ': ' || chr(9) || '客户端IP=' || client_ip || ' ' || chr(9) || '会话次数=' || session_num
         || ' ' || chr(9) || 'c2s包数=' || c2s_pkt_num || ' ' || chr(9) || 's2c包数' || s2c_pkt_num
         || ' ' || chr(9) || 'c2s字节数=' || c2s_byte_num || ' ' || chr(9) || 's2c字节数' || s2c_byte_num
         || ' ' || chr(9) || '时间戳是 :' || window_end_ms || ' ' || chr(9) || 'orerby：' || order_by || chr(10),
         '' ORDER BY rank)
       || repeat('=', 36) || chr(10) || chr(10) AS report
FROM ranked GROUP BY window_end_ms"""


SESSIONS = "session_num"
BYTES = "(c2s_byte_num + s2c_byte_num)"
PACKETS = "(c2s_pkt_num + s2c_pkt_num)"

LINES = """
lines AS (
  SELECT event_id AS seq, ts AS arrival_ts, event_type || ',' || (user_id % 20) AS value FROM events)"""

NUMBERS = """
numbers AS (
  SELECT event_id AS seq, ts AS arrival_ts, user_id, event_type,
         CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events)"""

WORD_WINDOWS = LINES + """,
words AS (
  SELECT arrival_ts, unnest(string_split(lower(value), ',')) AS word FROM lines),
counted AS (
  SELECT time_bucket(INTERVAL '1 hour', arrival_ts) + o.off * INTERVAL '1 hour' AS window_end, word, count(*) AS cnt
  FROM words CROSS JOIN (VALUES (1), (2)) o(off) WHERE length(word) > 0 GROUP BY ALL)"""


def _word_top_n(where: str = "") -> str:
    return "WITH " + WORD_WINDOWS + f"""
SELECT window_end AS bucket_end, window_end AS source_window_end, word, cnt,
       CAST(row_number() OVER (PARTITION BY window_end ORDER BY cnt DESC, word) AS INTEGER) AS rank
FROM counted {where} QUALIFY rank <= 5"""


def _session(key: str, gap: str, measures: str, ranks: str = "") -> str:
    return "WITH " + NUMBERS + f""",
marked AS (
  SELECT *, CASE WHEN arrival_ts - lag(arrival_ts) OVER w <= INTERVAL '{gap}' THEN 0 ELSE 1 END AS opens
  FROM numbers WINDOW w AS (PARTITION BY {key} ORDER BY arrival_ts)),
named AS (
  SELECT *, sum(opens) OVER (PARTITION BY {key} ORDER BY arrival_ts ROWS UNBOUNDED PRECEDING) AS sid FROM marked)
SELECT min(arrival_ts) AS window_start, max(arrival_ts) + INTERVAL '{gap}' AS window_end, {key}, {measures}
FROM named GROUP BY {key}, sid {ranks}"""


def _tokens(split: str, strip: str) -> str:
    # Trailing empty fields go; a text of delimiters alone has no field, an empty text has one.
    return f"""
WITH bodies AS (SELECT text, rtrim(text, {strip}) AS body FROM documents),
words AS (
  SELECT unnest(CASE WHEN text = '' THEN [''] WHEN body = '' THEN [] ELSE {split} END) AS word FROM bodies)
SELECT word, count(*) AS total FROM words GROUP BY word"""


WS = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
WS_SPLIT = r"string_split_regex(body, '[ \t\n\x0B\f\r]')"

def _alerts(key: str, threshold: int, times: int) -> str:
    return f"""
WITH breaches AS (
  SELECT {key} AS key, event_id AS seq, value, row_number() OVER (PARTITION BY {key} ORDER BY event_id) AS no
  FROM events WHERE value >= {threshold}),
placed AS (SELECT *, (no - 1) // {times} + 1 AS alert_no, (no - 1) % {times} AS pos FROM breaches)
SELECT key, CAST(alert_no AS BIGINT) AS alert_no, max(seq) OVER (PARTITION BY key, alert_no) AS last_seq, key || ' 超过指定阈值 ' AS message, CAST(pos AS BIGINT) AS pos, value
FROM placed QUALIFY count(*) OVER (PARTITION BY key, alert_no) = {times}"""


ALERTS = _alerts("user_id", 100, 3)

RUNNING_CLICKS = """
WITH """ + LINES + """,
words AS (SELECT seq, unnest(string_split(value, ',')) AS word FROM lines)
SELECT seq, word, CAST(row_number() OVER (ORDER BY seq) AS BIGINT) AS total FROM words WHERE word = 'click'"""

RUNNING_MAX = """
SELECT event_id AS seq, CAST(user_id AS VARCHAR) AS word, CAST(floor(value) AS BIGINT) AS count,
       CAST(max(floor(value)) OVER (PARTITION BY user_id ORDER BY event_id ROWS UNBOUNDED PRECEDING) AS BIGINT) AS largest
FROM events"""

LATEST_COUNT = "WITH " + LINES + """
SELECT word, count(*) AS total FROM (SELECT unnest(string_split(value, ',')) AS word FROM lines) GROUP BY word"""

LATEST_LARGEST = """
SELECT CAST(user_id AS VARCHAR) AS word, CAST(max(floor(value)) AS BIGINT) AS largest FROM events GROUP BY user_id"""

COUNT_ALL = "WITH " + NUMBERS + """,
placed AS (SELECT k, seq, (row_number() OVER (ORDER BY seq) - 1) // 5 AS window_no FROM numbers)
SELECT CAST(window_no AS BIGINT) AS window_no, max(seq) AS last_seq, CAST(sum(k) AS BIGINT) AS total
FROM placed GROUP BY window_no HAVING count(*) = 5"""

def _count_slide(key: str) -> str:
    return "WITH " + NUMBERS + f"""
SELECT {key}, row_number() OVER w AS fired_at, seq AS last_seq,
       CAST(sum(k) OVER (w ROWS BETWEEN 4 PRECEDING AND CURRENT ROW) AS BIGINT) AS total
FROM numbers WINDOW w AS (PARTITION BY {key} ORDER BY seq) QUALIFY fired_at % 2 = 0"""


COUNT_SLIDE = _count_slide("user_id")


def _running(aggregate: str, out: str) -> str:
    return "WITH " + NUMBERS + f"""
SELECT seq, event_type, k, CAST({aggregate}(k) OVER (
         PARTITION BY event_type ORDER BY seq ROWS UNBOUNDED PRECEDING) AS BIGINT) AS {out}
FROM numbers"""


CLOSED = "WHERE window_end <= (SELECT max(ts) - INTERVAL '5 seconds' FROM events)"

SQL: dict[str, str] = {
    "top_hosts_by_sessions": "WITH " + _ranked("session_num", SESSIONS) + " SELECT * FROM ranked",
    "top_hosts_by_bytes": "WITH " + _ranked("bytes", BYTES) + " SELECT * FROM ranked",
    "top_hosts_by_packets": "WITH " + _ranked("packets", PACKETS) + " SELECT * FROM ranked",
    "top_hosts_flattened": "WITH " + _ranked("packets", PACKETS) + " SELECT * FROM ranked",
    "top_hosts_report": _report("session_num", SESSIONS, "''"),
    "top_hosts_report_with_time": _report(
        "bytes", BYTES, "'时间: ' || strftime(make_timestamp(window_end_ms * 1000), '%Y-%m-%d %H:%M:%S.0') || chr(10)"
    ),
    "window_agg": "WITH " + HOSTS + """
        SELECT window_end - INTERVAL '1 hour' AS window_start, * FROM hosts""",
    "two_metric_agg": "WITH " + HOSTS + """
        SELECT window_end - INTERVAL '1 hour' AS window_start, window_end, client_ip, session_num,
               c2s_pkt_num + s2c_pkt_num AS pkt_num, c2s_byte_num + s2c_byte_num AS byte_num FROM hosts""",
    "word_top_n": _word_top_n(),
    "json_window_count": "WITH " + NUMBERS + """
        SELECT time_bucket(INTERVAL '1 hour', arrival_ts) AS window_start,
               time_bucket(INTERVAL '1 hour', arrival_ts) + INTERVAL '1 hour' AS window_end, k, count(*) AS cnt
        FROM numbers GROUP BY ALL""",
    "json_window_sum": "WITH " + NUMBERS + """
        SELECT time_bucket(INTERVAL '1 hour', arrival_ts) AS window_start,
               time_bucket(INTERVAL '1 hour', arrival_ts) + INTERVAL '1 hour' AS window_end, event_type,
               CAST(sum(k) AS BIGINT) AS total
        FROM numbers GROUP BY ALL""",
    "sliding_sum": "WITH " + LINES + """
        SELECT time_bucket(INTERVAL '1 hour', arrival_ts) + (o.off - 3) * INTERVAL '1 hour' AS window_start,
               time_bucket(INTERVAL '1 hour', arrival_ts) + o.off * INTERVAL '1 hour' AS window_end,
               value AS word, count(*) AS cnt
        FROM lines CROSS JOIN (VALUES (1), (2), (3)) o(off) GROUP BY ALL""",
    "sliding_sum_long": "WITH " + NUMBERS + """
        SELECT time_bucket(INTERVAL '1 hour', arrival_ts) + (o.off - 24) * INTERVAL '1 hour' AS window_start,
               time_bucket(INTERVAL '1 hour', arrival_ts) + o.off * INTERVAL '1 hour' AS window_end,
               event_type, count(*) AS cnt, CAST(sum(k) AS BIGINT) AS total, max(k) AS largest
        FROM numbers CROSS JOIN range(1, 25) o(off) GROUP BY ALL""",
    "tumbling_all_reduce": "WITH " + NUMBERS + """
        SELECT time_bucket(INTERVAL '3 hours', arrival_ts) AS window_start,
               time_bucket(INTERVAL '3 hours', arrival_ts) + INTERVAL '3 hours' AS window_end,
               arg_min(event_type, seq) AS word, CAST(sum(k) AS BIGINT) AS cnt
        FROM numbers GROUP BY 1, 2""",
    "window_all_count": "WITH " + LINES + """
        SELECT time_bucket(INTERVAL '1 hour', arrival_ts) AS window_start,
               time_bucket(INTERVAL '1 hour', arrival_ts) + INTERVAL '1 hour' AS window_end, count(*) AS cnt
        FROM lines GROUP BY 1, 2""",
    "session_sum": _session("user_id", "1 hour", "count(*) AS cnt, CAST(sum(k) AS BIGINT) AS total"),
    "session_sum_by_type": _session("event_type", "5 minutes", "CAST(sum(k) AS BIGINT) AS total"),
    "running_sum_by_type": _running("sum", "total"),
    "running_max_by_type": _running("max", "largest"),
    "threshold_alerts_by_type": _alerts("event_type", 20, 7),
    "count_window_slide_by_type": _count_slide("event_type"),
    "count_window_all_split": COUNT_ALL,
    "count_window_all": COUNT_ALL,
    "count_window_slide": COUNT_SLIDE,
    "json_parse_defaults": """
        SELECT event_id, CAST(user_id AS VARCHAR) AS client_ip, 0 AS session_num,
               CAST(json_extract(props, '$.k') AS INTEGER) AS c2s_pkt_num, 0 AS s2c_pkt_num,
               0 AS c2s_byte_num, 0 AS s2c_byte_num, CAST(0 AS BIGINT) AS recv_time
        FROM events""",
    "json_rejects": "SELECT event_id, substr(props, 1, 5) AS value FROM events WHERE event_type = 'error'",
    "renamed_traffic": """
        SELECT event_id, CAST(user_id AS VARCHAR) AS source, 0 AS session_num, 0 AS c2s_pkt_num, 0 AS s2c_pkt_num,
               0 AS c2s_byte_num, 0 AS s2c_byte_num, epoch_us(ts) // 1000 AS __time
        FROM events""",
    "student_records": """
        SELECT event_id, event_type AS name,
               CASE WHEN event_type = 'view' THEN 0 ELSE CAST(json_extract(props, '$.k') AS INTEGER) END AS age
        FROM events""",
    "word_count_lines": "SELECT event_id, event_type AS word, user_id AS count FROM events",
    "line_pairs": """
        SELECT event_id AS seq, event_type AS first, CAST(user_id % 20 AS VARCHAR) AS second FROM events""",
    "tokenise_lower_count": """
        SELECT word, count(*) AS total
        FROM (SELECT unnest(string_split(lower(text), ',')) AS word FROM documents)
        WHERE length(word) > 0 GROUP BY word""",
    "tokenise_comma": _tokens("string_split(body, ',')", "','"),
    "tokenise_space": _tokens("string_split(body, ' ')", "' '"),
    "tokenise_ws": _tokens(WS_SPLIT, WS),
    "tokens_per_document": f"""
        WITH stripped AS (
          SELECT doc_id, text, rtrim(text, ',') AS c, rtrim(text, ' ') AS s, rtrim(text, {WS}) AS body,
                 string_split_regex(text, '[.] ?') AS stops FROM documents)
        SELECT doc_id,
               CASE WHEN text = '' THEN 1 WHEN c = '' THEN 0 ELSE len(string_split(c, ',')) END AS by_comma,
               CASE WHEN text = '' THEN 1 WHEN s = '' THEN 0 ELSE len(string_split(s, ' ')) END AS by_space,
               CASE WHEN text = '' THEN 1 WHEN body = '' THEN 0 ELSE len({WS_SPLIT}) END AS by_whitespace,
               CASE WHEN text = '' THEN 1 ELSE coalesce(list_max(list_transform(
                 range(1, len(stops) + 1), lambda i: CASE WHEN stops[i] <> '' THEN i ELSE 0 END)), 0) END AS by_stop
        FROM stripped""",
    "append_suffix": "WITH " + LINES + " SELECT seq, value || 'aaaaa' AS value FROM lines",
    "keep_word": "WITH " + LINES + """
        SELECT seq, word, CAST(1 AS BIGINT) AS cnt
        FROM (SELECT seq, unnest(string_split(value, ',')) AS word FROM lines) WHERE word = 'click'""",
    "running_word_count": RUNNING_CLICKS,
    "running_sum": "WITH " + NUMBERS + """
        SELECT seq, user_id, k,
               CAST(sum(k) OVER (PARTITION BY user_id ORDER BY seq ROWS UNBOUNDED PRECEDING) AS BIGINT) AS total
        FROM numbers""",
    "running_max": RUNNING_MAX,
    "latest_count": LATEST_COUNT,
    "latest_largest": LATEST_LARGEST,
    "breach_flags": "SELECT event_id AS seq, 'dsadsad' AS message FROM events WHERE value > 100",
    "threshold_alerts": ALERTS,
    # Streams replayed to the end: windows are out once max(ts) - 5 s has passed their end.
    "stream_top_hosts": "WITH " + _ranked("session_num", SESSIONS, closed=True) + " SELECT * FROM ranked",
    "stream_top_hosts_late": LATE_HOSTS,
    "stream_top_hosts_by_timer": "WITH " + _ranked("session_num", SESSIONS, closed=True) + " SELECT * FROM ranked",
    "stream_top_hosts_report": _report("packets", PACKETS, "''", closed=True),
    "stream_word_top_n": _word_top_n(CLOSED),
    "stream_sliding_long": "WITH " + NUMBERS + f"""
        SELECT * FROM (
          SELECT time_bucket(INTERVAL '1 hour', arrival_ts) + (o.off - 12) * INTERVAL '1 hour' AS window_start,
                 time_bucket(INTERVAL '1 hour', arrival_ts) + o.off * INTERVAL '1 hour' AS window_end,
                 event_type, count(*) AS cnt, CAST(sum(k) AS BIGINT) AS total, max(k) AS largest
          FROM numbers CROSS JOIN range(1, 13) o(off) GROUP BY ALL) {CLOSED}""",
    "stream_json_window_count": "WITH " + NUMBERS + f"""
        SELECT * FROM (
          SELECT time_bucket(INTERVAL '1 hour', arrival_ts) AS window_start,
                 time_bucket(INTERVAL '1 hour', arrival_ts) + INTERVAL '1 hour' AS window_end, k, count(*) AS cnt
          FROM numbers GROUP BY ALL) {CLOSED}""",
    "stream_window_all_count": "WITH " + LINES + f"""
        SELECT * FROM (
          SELECT time_bucket(INTERVAL '1 hour', arrival_ts) AS window_start,
                 time_bucket(INTERVAL '1 hour', arrival_ts) + INTERVAL '1 hour' AS window_end, count(*) AS cnt
          FROM lines GROUP BY 1, 2) {CLOSED}""",
    "stream_session_sum": "SELECT * FROM (" + _session(
        "user_id", "1 hour", "count(*) AS cnt, CAST(sum(k) AS BIGINT) AS total") + f") {CLOSED}",
    "stream_word_count": LATEST_COUNT,
    "stream_running_max": LATEST_LARGEST,
    "stream_record_counts": "WITH " + LINES + """
SELECT seq AS line, word, row_number() OVER (PARTITION BY word ORDER BY seq, place) AS total
FROM (SELECT seq, unnest(string_split(value, ',')) AS word, unnest(range(len(string_split(value, ',')))) AS place FROM lines)""",
    "stream_record_maxima": RUNNING_MAX.replace("event_id AS seq", "event_id AS line"),
    "stream_breach_flags": "SELECT event_id AS seq, 'dsadsad' AS message FROM events WHERE value > 100",
    "stream_threshold_alerts": f"SELECT * EXCLUDE (alert_no) FROM ({ALERTS})",
    "stream_count_window_slide": f"SELECT user_id AS key, fired_at, last_seq, total FROM ({COUNT_SLIDE})",
    "batched_threshold_alerts": f"SELECT * EXCLUDE (alert_no) FROM ({ALERTS})",
    "batched_count_window_all": f"SELECT last_seq, total FROM ({COUNT_ALL})",
    "batched_count_window_slide": f"SELECT user_id, last_seq, total FROM ({COUNT_SLIDE})",
    "batched_running_sum": "WITH " + NUMBERS + """
        SELECT seq, user_id, k,
               CAST(sum(k) OVER (PARTITION BY user_id ORDER BY seq ROWS UNBOUNDED PRECEDING) AS BIGINT) AS total
        FROM numbers""",
    "batched_running_max": "WITH " + NUMBERS + """
        SELECT seq, user_id, k,
               max(k) OVER (PARTITION BY user_id ORDER BY seq ROWS UNBOUNDED PRECEDING) AS largest
        FROM numbers""",
}
