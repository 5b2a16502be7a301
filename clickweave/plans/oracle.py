"""DuckDB oracle SQL for the query catalog.

Each query is a ``WITH`` chain over the pre-registered driver views (``events``, ``part``). The
first links restate, in plain SQL, the same adapter and definitions the Spark operators use:

* ``click``    the events -> click-schema adapter (FIXTURES.md)
* ``clean``    the null-safe reject rule removed
* ``silver``   single-window sessionization (the reference's literal definition)
* ``metrics``  session metrics per (user_id, session_index)

Spark computes the same results differently (chunked sessionization, map-side aggregation);
equality of the two is the correctness check.
"""

from __future__ import annotations

from clickweave.sources.driver_events import (
    DUPLICATE_MOD,
    NEGATIVE_PRICE_MOD,
    NULL_PRICE_MOD,
    NULL_SESSION_MOD,
    NULL_USER_MOD,
)

CLICK = f"""click AS (
    SELECT e.event_id AS src_event_id,
           e.ts AS event_timestamp,
           CASE e.event_type WHEN 'click' THEN 'cart' WHEN 'signup' THEN 'remove_from_cart'
                ELSE e.event_type END AS event_type,
           CAST(json_extract_string(e.props, '$.k') AS INTEGER) AS product_id,
           p.p_type AS category_id,
           CASE WHEN p.p_partkey % 10 = 0 THEN NULL
                WHEN p.p_partkey % 10 = 1 THEN lower(p.p_type)
                ELSE lower(p.p_type) || '.' || split_part(p.p_name, ' ', 2) END AS category_code,
           p.p_brand AS brand,
           CASE WHEN e.event_id % {NULL_PRICE_MOD} = 0 THEN NULL
                WHEN e.event_id % {NEGATIVE_PRICE_MOD} = 0 THEN -e.value
                ELSE e.value END AS price,
           CASE WHEN e.event_id % {NULL_USER_MOD} = 0 THEN NULL ELSE e.user_id END AS user_id,
           CASE WHEN e.event_id % {NULL_SESSION_MOD} = 0 THEN NULL
                ELSE CAST(e.user_id AS VARCHAR) || '-' || strftime(e.ts, '%Y%m%d') END AS user_session
    FROM events e
    LEFT JOIN part p ON p.p_partkey = CAST(json_extract_string(e.props, '$.k') AS INTEGER)
)"""

CLICK_DUPS = f"""click_dups AS (
    SELECT * FROM click UNION ALL SELECT * FROM click WHERE src_event_id % {DUPLICATE_MOD} = 0
)"""

REASON = """NULLIF(concat_ws(',',
        CASE WHEN user_id IS NULL THEN 'null_user_id' END,
        CASE WHEN coalesce(price < 0, false) THEN 'negative_price' END), '')"""

CLEAN = f"""clean AS (SELECT * FROM click WHERE {REASON} IS NULL)"""


def surrogate_key(*parts: str) -> str:
    texts = ", ".join(f"coalesce({p}, '_null_')" for p in parts)
    return f"md5(concat_ws('-', {texts}))"


_TS_TEXT = "strftime(event_timestamp, '%Y-%m-%d %H:%M:%S')"
SPEC_KEY = surrogate_key("CAST(user_id AS VARCHAR)", _TS_TEXT, "lower(trim(event_type))")
UNIQUE_KEY = surrogate_key("CAST(user_id AS VARCHAR)", _TS_TEXT, "lower(trim(event_type))", "CAST(src_event_id AS VARCHAR)")

STG = f"""stg AS (
    SELECT {UNIQUE_KEY} AS event_id,
           event_timestamp, lower(trim(event_type)) AS event_type, product_id, category_id,
           lower(trim(category_code)) AS category_code, lower(trim(brand)) AS brand,
           CAST(price AS DOUBLE) AS price, user_id, user_session, src_event_id
    FROM click WHERE user_id IS NOT NULL AND NOT coalesce(price < 0, false)
)"""

_ORDER = "ORDER BY event_timestamp, src_event_id"


def silver(timeout: int, source: str = "stg") -> str:
    return f"""lagged AS (
    SELECT *, lag(event_timestamp) OVER (PARTITION BY user_id {_ORDER}) AS prev_ts
    FROM {source} WHERE user_id IS NOT NULL AND event_timestamp IS NOT NULL
), flagged AS (
    SELECT * EXCLUDE (prev_ts),
           date_diff('second', prev_ts, event_timestamp) AS idle_seconds,
           CASE WHEN prev_ts IS NULL OR date_diff('second', prev_ts, event_timestamp) > {timeout}
                THEN 1 ELSE 0 END AS session_flag
    FROM lagged
), indexed AS (
    SELECT *, CAST(sum(session_flag) OVER (PARTITION BY user_id {_ORDER}
                   ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS session_index
    FROM flagged
), silver AS (
    SELECT *, CAST(user_id AS VARCHAR) || '_' || CAST(session_index AS VARCHAR) AS computed_session_id,
           CAST(row_number() OVER (PARTITION BY user_id, session_index {_ORDER}) AS BIGINT) AS event_seq
    FROM indexed
)"""


METRICS = """metrics AS (
    SELECT CAST(user_id AS VARCHAR) || '_' || CAST(session_index AS VARCHAR) AS computed_session_id,
           user_id,
           min(event_timestamp) AS session_start,
           max(event_timestamp) AS session_end,
           date_diff('second', min(event_timestamp), max(event_timestamp)) AS session_duration_sec,
           count(*) AS total_events,
           CAST(count_if(event_type = 'view') AS BIGINT) AS view_count,
           CAST(count_if(event_type = 'cart') AS BIGINT) AS cart_count,
           CAST(count_if(event_type = 'remove_from_cart') AS BIGINT) AS remove_count,
           CAST(count_if(event_type = 'purchase') AS BIGINT) AS purchase_count,
           count(DISTINCT product_id) AS distinct_products,
           count(DISTINCT category_code) AS distinct_categories,
           avg(CASE WHEN event_type = 'view' THEN CAST(price AS DOUBLE) END) AS avg_price_viewed,
           max(CASE WHEN event_type = 'view' THEN CAST(price AS DOUBLE) END) AS max_price_viewed,
           count_if(event_type = 'purchase') > 0 AS is_purchased
    FROM silver GROUP BY user_id, session_index
)"""

FEATURE_STORE = """features AS (
    SELECT computed_session_id, user_id, session_start, session_end, session_duration_sec,
           CAST(hour(session_start) AS INTEGER) AS hour_of_day_start,
           CAST(dayofweek(session_start) + 1 AS INTEGER) AS day_of_week_start,
           total_events, view_count, cart_count, remove_count, distinct_products, distinct_categories,
           avg_price_viewed, max_price_viewed, is_purchased,
           strftime(session_start, '%Y-%m') AS data_partition
    FROM metrics
)"""


FCT = """fct AS (
    SELECT event_id, event_timestamp, CAST(event_timestamp AS DATE) AS event_date, event_type, product_id,
           list_extract(string_split(category_code, '.'), 1) AS category_l1,
           list_extract(string_split(category_code, '.'), 2) AS category_l2,
           brand, price, user_id, user_session, computed_session_id
    FROM silver
)"""


def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


def gold(timeout: int, *extra: str) -> str:
    """``WITH click, stg, silver(timeout), metrics[, extra…]``"""
    return with_(CLICK, STG, silver(timeout), METRICS, *extra)


def silver_chain(timeout: int, *extra: str) -> str:
    """``WITH click, stg, silver(timeout)[, extra…]``"""
    return with_(CLICK, STG, silver(timeout), *extra)


def rounded(table: str) -> str:
    """All columns of ``metrics`` or ``features``, the average rounded for comparison."""
    return f"SELECT * REPLACE (round(avg_price_viewed, 6) AS avg_price_viewed) FROM {table}"
