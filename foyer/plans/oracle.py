"""The answers in SQL, computed from the given tables without the feed in between."""

from __future__ import annotations

from foyer.plans.batch import OPENED, SEGMENT, SINCE

_TICKETS = """
WITH items AS (
  SELECT *,
    CAST(round(l_extendedprice * 100) AS BIGINT) AS cents,
    strftime(l_shipdate, '%Y-%m-01 ') || lpad(CAST(l_partkey % 4 * 6 + 5 AS VARCHAR), 2, '0') || ':20:00' AS start
  FROM lineitem
), tickets AS (
  SELECT
    concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey) AS "ticketCode",
    mark AS "isRefund",
    CAST(l_suppkey % 5 AS VARCHAR) AS "cinemaInnerCode",
    CAST(l_linenumber % 3 AS VARCHAR) AS "hallCode",
    start AS "movieShowStartTime",
    lpad(CAST(l_partkey % 10 AS VARCHAR), 3, '0') || CAST(l_suppkey % 3 AS VARCHAR) || '02342019' AS "movieCode",
    lpad(CAST(l_partkey % 10 AS VARCHAR), 3, '0') || '02342019' AS movie,
    'C' || CAST(l_suppkey % 5 AS VARCHAR) || 'X' || CAST(l_partkey % 100 AS VARCHAR) AS show_code,
    cents,
    cents * l_linenumber // 8 AS first_item,
    l_discount = 0 AS unpaid,
    CASE WHEN l_discount = 0 THEN 0 ELSE cents END AS pay,
    l_linenumber, l_shipdate
  FROM (
    SELECT *, CASE WHEN l_linenumber <> 7 THEN 'N' END AS mark FROM items
    UNION ALL
    SELECT *, 'Y' AS mark FROM items WHERE l_returnflag = 'R'
  )
), keyed AS (
  SELECT *, "cinemaInnerCode" AS cinema, "hallCode" AS hall,
    substr("movieShowStartTime", 1, 10) AS show_date, substr("movieShowStartTime", 12, 5) AS show_time
  FROM tickets
), presale AS (
  SELECT strftime(CAST("movieShowStartTime" AS TIMESTAMP) - INTERVAL 6 HOUR, '%Y-%m-%d') AS date_id,
    substr("movieShowStartTime", 12) AS show_time, "cinemaInnerCode", "movieCode", l_shipdate,
    CASE WHEN "isRefund" = 'N' THEN 1 ELSE -1 END AS sign, pay
  FROM tickets WHERE l_linenumber <> 6
)
"""
_KEY = "cinema, hall, show_date, show_time, movie"
_PRESALE_KEY = 'date_id, show_time, "cinemaInnerCode", "movieCode"'
_SIGNED = "CAST(sum(sign) AS BIGINT) AS ticket_num, CAST(sum(sign * pay) AS BIGINT) AS ticket_amt"

_PAIRS = f"""{_TICKETS}
SELECT {_KEY}, CAST(count(*)::HUGEINT * count(*) AS DECIMAL(38,0)) AS pairs,
  CAST(count(*)::HUGEINT * sum(pay)::HUGEINT AS DECIMAL(38,0)) AS amount
FROM keyed GROUP BY {_KEY}"""

_RUNNING_SALES = f"""{_TICKETS}
SELECT {_KEY}, count(*) AS tickets, CAST(CAST(sum(pay) AS BIGINT) // 100 AS DOUBLE) AS amount
FROM keyed GROUP BY {_KEY}"""

_BOX_OFFICE = f"""{_TICKETS}
SELECT {_PRESALE_KEY}, {_SIGNED} FROM presale WHERE date_id >= '{SINCE}' GROUP BY {_PRESALE_KEY}"""

_SEEDED = f"{_BOX_OFFICE} HAVING max(l_shipdate) >= '{OPENED}'"

_ID_COUNTS = """
SELECT CAST(user_id AS VARCHAR) AS id, count(*) AS n FROM events WHERE event_type <> 'error' GROUP BY 1"""

_SHOW_CODES = f"""{_TICKETS}
SELECT {_KEY}, count(DISTINCT show_code) AS show_codes FROM keyed GROUP BY {_KEY}"""

_WINDOWS = """
SELECT strftime(time_bucket(INTERVAL 5 SECOND, ts), '%Y-%m-%d %H:%M:%S') AS window_start, token, count(*) AS n
FROM (SELECT ts, unnest(string_split(event_type || ' ' || props, ' ')) AS token FROM events) GROUP BY 1, 2"""

_SPACES = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
_COMMA_LINES = "SELECT text || ',' || lang || ', ' || source || ',,' AS value FROM documents"


def _words(lines: str, kept: str, parts: str, token: str = "token") -> str:
    """Count tokens of ``lines``: ``kept`` is the text without its final delimiters."""
    return f"""
WITH lines AS ({lines}), ends AS (SELECT value, {kept} AS kept FROM lines),
tokens AS (SELECT unnest({parts}) AS token FROM ends WHERE kept <> '' OR value = '')
SELECT {token} AS token, count(*) AS n FROM tokens GROUP BY 1"""


ORACLES = {
    "ticket_sales_batch": f"""{_TICKETS}
SELECT {_KEY}, count(*) AS tickets, CAST(sum(pay) AS BIGINT) AS amount, 1 AS shows
FROM keyed GROUP BY {_KEY}""",
    "explode_ticket_array": f"""{_TICKETS}
SELECT "ticketCode", "isRefund", "cinemaInnerCode", "movieShowStartTime", "movieCode" FROM tickets""",
    "showing_key": f"""{_TICKETS}
SELECT "ticketCode", "isRefund", {_KEY} FROM keyed""",
    "ticket_pay_sum": f"""{_TICKETS}
SELECT "ticketCode", "isRefund", pay, pay AS loose_pay FROM tickets""",
    "distinct_shows_per_key": _SHOW_CODES,
    "running_distinct_shows": _SHOW_CODES,
    "fanout_join_sales": _PAIRS,
    "fanout_join_two_sides": _PAIRS,
    "fanout_join_stream": _PAIRS,
    "presale_box_office": _BOX_OFFICE,
    "presale_seeded_state": _SEEDED,
    "stateful_idle_timeout": _SEEDED,
    "landed_log_distinct_orders": f"""{_TICKETS}
SELECT DISTINCT "ticketCode", "isRefund", "cinemaInnerCode", "hallCode", "movieShowStartTime", "movieCode",
  cents AS "ticketPrice" FROM (
  SELECT DISTINCT *, CASE WHEN unpaid THEN NULL ELSE first_item END FROM tickets)""",
    "landed_orders_count_by_cinema": f"""{_TICKETS}
SELECT "cinemaInnerCode", count(*) AS cnt FROM (
  SELECT DISTINCT "ticketCode", "isRefund", "cinemaInnerCode", "movieShowStartTime", cents, unpaid FROM tickets)
GROUP BY 1""",
    "orders_json_count_by_cinema": f"""{_TICKETS}
SELECT "cinemaInnerCode", count(*) AS cnt FROM tickets GROUP BY 1""",
    "array_sum": f"""{_TICKETS}
SELECT "ticketCode", "isRefund", pay AS total FROM tickets""",
    "dominant_pay_mode": f"""{_TICKETS}
SELECT "ticketCode", "isRefund",
  CASE WHEN unpaid THEN NULL WHEN first_item >= cents - first_item THEN 'card' ELSE 'cash' END AS pay_mode
FROM tickets""",
    "business_date": """
SELECT event_id, strftime(ts - INTERVAL 6 HOUR, '%Y-%m-%d') AS date_id, strftime(ts, '%H:%M:%S') AS show_time
FROM events""",
    "relative_dates": """
SELECT event_id, strftime(ts, '%Y-%m-%d') AS today, strftime(ts + INTERVAL 1 DAY, '%Y%m%d') AS tomorrow,
  strftime(ts, '%Y%m%d%H%M%S') AS batch_time FROM events""",
    "json_field_filter": """
SELECT event_id AS id, 'Show_Details' AS sync_type, props FROM events WHERE event_type = 'view'""",
    "catalog_point_filter": f"SELECT * FROM customer WHERE c_mktsegment = '{SEGMENT}'",
    "batch_word_count": _words(
        "SELECT unnest(string_split(text, chr(10))) AS value FROM documents",
        "rtrim(value, ' ')", "string_split(kept, ' ')",
    ),
    "regex_space_token_count": _words(
        "SELECT text AS value FROM documents",
        f"rtrim(value, {_SPACES})", "regexp_split_to_array(kept, '[ \\t\\n\\x0B\\f\\r]')",
    ),
    "csv_token_count": _words(_COMMA_LINES, "rtrim(value, ',')", "string_split(kept, ',')"),
    "csv_token_running": _words(
        _COMMA_LINES, "rtrim(value, ',')", "string_split(kept, ',')", f"trim(token, {_SPACES})"
    ),
    "pipe_token_count": _words(
        "SELECT p_brand || '||' || p_type || '|' || p_name || '||' AS value FROM part",
        "rtrim(value, '|')", "string_split(kept, '|')",
    ),
    "flatten_nested_arrays": """
SELECT l_orderkey, l_linenumber, unnest([l_quantity, l_extendedprice, l_discount]) AS element FROM lineitem""",
    "ticket_sales_running": _RUNNING_SALES,
    "restart_from_checkpoint": _RUNNING_SALES,
    "running_id_count": _ID_COUNTS,
    "stream_upsert_snapshot": _ID_COUNTS,
    "tumbling_window_count": _WINDOWS,
    "late_window_count": _WINDOWS,
    "every_key_each_batch": _ID_COUNTS,
}
