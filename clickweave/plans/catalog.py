"""Query catalog: one Spark query per operator of the inventory, each paired with DuckDB oracle SQL.

``QUERIES[name](spark, sf_dir) -> DataFrame``; ``ORACLE[name]`` is the matching SQL over the
driver views. Column names and types are aligned on both sides.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickweave.operators import sessions as ses
from clickweave.plans import medallion as m
from clickweave.plans import oracle as o

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


#: Digits to which a query's computed averages, sums and ratios are rounded, here and in the SQL
#: beside it, so that two engines' order of additions does not show. Operators do not round.
ROUNDED = {
    "avg_price_viewed": 6, "revenue": 2, "match_rate": 6, "view_to_cart_rate": 6, "cart_to_purchase_rate": 6,
    "session_conversion_rate": 6, "roc_auc": 9, "pr_auc": 9, "psi": 6, "mean": 6, "stddev": 6,
    "rate_base": 6, "rate_cur": 6, "shift": 6, "z": 6, "rate_shift": 6, "max_shift": 6, "ks": 9, "critical": 9,
}


def query(name: str, sql: str | None = None):
    def deco(fn: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            df = fn(spark, sf_dir)
            digits = {c: ROUNDED[c] for c, kind in df.dtypes if kind == "double" and c in ROUNDED}
            return df.withColumns({c: F.round(c, d) for c, d in digits.items()}) if digits else df

        run.__name__, run.__doc__ = fn.__name__, fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return deco


# ---------------------------------------------------------------------------------------------
# Silver sessions

_SILVER_COLS = (
    "src_event_id",
    "user_id",
    "event_timestamp",
    "event_type",
    "idle_seconds",
    "session_flag",
    "session_index",
    "computed_session_id",
)
_SILVER_SQL_COLS = ", ".join(_SILVER_COLS)


@query("w4_sessionize_30m", o.silver_chain(1800) + f"SELECT {_SILVER_SQL_COLS} FROM silver")
def w4_sessionize_30m(spark, sf_dir):
    return m.silver(spark, sf_dir, m.TIMEOUT_SHORT).select(*_SILVER_COLS)


@query("w4_sessionize_12h", o.silver_chain(43200) + f"SELECT {_SILVER_SQL_COLS} FROM silver")
def w4_sessionize_12h(spark, sf_dir):
    return m.silver(spark, sf_dir, m.TIMEOUT_LONG).select(*_SILVER_COLS)


@query(
    "w5_event_sequence",
    o.silver_chain(43200) + "SELECT src_event_id, computed_session_id, event_seq FROM silver",
)
def w5_event_sequence(spark, sf_dir):
    return m.silver(spark, sf_dir, m.TIMEOUT_LONG).select("src_event_id", "computed_session_id", "event_seq")


@query(
    "d10_unsessionizable",
    o.with_(o.CLICK)
    + "SELECT CAST(count_if(user_id IS NULL OR event_timestamp IS NULL) AS BIGINT) AS unsessionizable_rows FROM click",
)
def d10_unsessionizable(spark, sf_dir):
    """Rows a sessionizer must leave out (NULL user or NULL time), counted on the raw clicks."""
    return ses.unsessionizable(m.clicks(spark, sf_dir))


_MATCH_SQL = """SELECT count(*) AS n_user_sessions, CAST(count_if(one) AS BIGINT) AS n_matched,
       round(avg(CAST(one AS DOUBLE)), 6) AS match_rate
FROM (SELECT user_session, min(computed_session_id) = max(computed_session_id) AS one
      FROM silver WHERE user_session IS NOT NULL GROUP BY user_session)"""


@query("a9_match_rate", o.silver_chain(1800) + _MATCH_SQL)
def a9_match_rate(spark, sf_dir):
    return ses.session_match_rate(m.silver(spark, sf_dir, m.TIMEOUT_SHORT, with_sequence=False))


@query("a9_match_rate_12h", o.silver_chain(43200) + _MATCH_SQL)
def a9_match_rate_12h(spark, sf_dir):
    return ses.session_match_rate(m.silver(spark, sf_dir, m.TIMEOUT_LONG, with_sequence=False))


# ---------------------------------------------------------------------------------------------
# A1: session metrics


@query("a1_session_metrics", o.gold(1800) + o.rounded("metrics"))
def a1_session_metrics(spark, sf_dir):
    return m.metrics(spark, sf_dir, m.TIMEOUT_SHORT)


@query("a1_session_metrics_12h", o.gold(43200) + o.rounded("metrics"))
def a1_session_metrics_12h(spark, sf_dir):
    return m.metrics(spark, sf_dir, m.TIMEOUT_LONG)


# ---------------------------------------------------------------------------------------------
# Bronze split; P5-P8 staging; P10; P16, W6 deduplication

_CLICK_COLS = ", ".join(
    ["src_event_id", "event_timestamp", "event_type", "product_id", "category_id", "category_code", "brand",
     "price", "user_id", "user_session"]
)


@query("p1_rejects", o.with_(o.CLICK) + f"SELECT *, {o.REASON} AS reject_reason FROM click WHERE {o.REASON} IS NOT NULL")
def p1_rejects(spark, sf_dir):
    return m.rejected_clicks(spark, sf_dir)


@query("p2_clean", o.with_(o.CLICK, o.CLEAN) + "SELECT * FROM clean")
def p2_clean(spark, sf_dir):
    return m.clean_clicks(spark, sf_dir)


@query("p5_staging", o.with_(o.CLICK, o.STG) + "SELECT * FROM stg")
def p5_staging(spark, sf_dir):
    return m.staged(spark, sf_dir)


@query(
    "p7_surrogate_key",
    o.with_(o.CLICK, o.STG) + f"SELECT src_event_id, {o.SPEC_KEY} AS spec_event_id, event_id FROM stg",
)
def p7_surrogate_key(spark, sf_dir):
    from clickweave.functions.columns import surrogate_key
    from clickweave.operators.staging import SURROGATE_KEY_COLUMNS

    st = m.staged(spark, sf_dir)
    spec = surrogate_key(SURROGATE_KEY_COLUMNS, time_cols=("event_timestamp",))
    return st.select("src_event_id", spec.alias("spec_event_id"), "event_id")


@query(
    "p10_category_levels",
    o.with_(o.CLICK, o.STG)
    + """SELECT src_event_id, category_code,
       list_extract(string_split(category_code, '.'), 1) AS category_l1,
       list_extract(string_split(category_code, '.'), 2) AS category_l2 FROM stg""",
)
def p10_category_levels(spark, sf_dir):
    from clickweave.operators.star import with_category_levels

    return with_category_levels(m.staged(spark, sf_dir)).select(
        "src_event_id", "category_code", "category_l1", "category_l2"
    )


@query("p16_dedup", o.with_(o.CLICK, o.CLICK_DUPS) + "SELECT DISTINCT * FROM click_dups")
def p16_dedup(spark, sf_dir):
    from clickweave.operators.staging import drop_exact_duplicates

    return drop_exact_duplicates(m.clicks(spark, sf_dir, with_duplicates=True))


@query(
    "w6_dedup_keep_first",
    o.with_(o.CLICK, o.CLICK_DUPS)
    + f"""SELECT {_CLICK_COLS} FROM (
    SELECT *, row_number() OVER (PARTITION BY user_id, event_timestamp, event_type ORDER BY src_event_id) AS rn
    FROM click_dups) WHERE rn = 1""",
)
def w6_dedup_keep_first(spark, sf_dir):
    from clickweave.operators.staging import keep_first

    return keep_first(
        m.clicks(spark, sf_dir, with_duplicates=True), ["user_id", "event_timestamp", "event_type"], ["src_event_id"]
    )


_BRONZE_COLS = (
    "event_timestamp", "event_type", "product_id", "category_id", "category_code", "brand", "price", "user_id",
    "user_session", "event_date",
)


@query(
    "s1_csv_ingest",
    o.with_(o.CLICK, o.CLEAN)
    + """SELECT CAST(date_trunc('second', event_timestamp) AS TIMESTAMP) AS event_timestamp, event_type, product_id,
       category_id, category_code, brand, CAST(price AS FLOAT) AS price, CAST(user_id AS INTEGER) AS user_id,
       user_session, CAST(event_timestamp AS DATE) AS event_date
FROM clean""",
)
def s1_csv_ingest(spark, sf_dir):
    """Driver events rendered as raw gzip CSV in the scratch folder, then the full bronze path:
    PERMISSIVE read with the fixed schema, staged parse, reject split, time parse, event_date."""
    from clickweave.plans.bronze import bronze_frames
    from clickweave.session import ensure_checkpoint_dir, scratch_path
    from clickweave.sources.driver_events import write_raw_csv

    ensure_checkpoint_dir(spark)
    csv_dir = scratch_path(spark, "raw-csv")
    write_raw_csv(m.clicks(spark, sf_dir), csv_dir)
    return bronze_frames(spark, csv_dir).clean.select(*_BRONZE_COLS)


@query(
    "s1_csv_rejects",
    o.with_(o.CLICK)
    + f"""SELECT CAST(product_id AS INTEGER) AS product_id, CAST(price AS FLOAT) AS price,
       CAST(user_id AS INTEGER) AS user_id, {o.REASON} AS reject_reason
FROM click WHERE {o.REASON} IS NOT NULL""",
)
def s1_csv_rejects(spark, sf_dir):
    from clickweave.plans.bronze import bronze_frames
    from clickweave.session import ensure_checkpoint_dir, scratch_path
    from clickweave.sources.driver_events import write_raw_csv

    ensure_checkpoint_dir(spark)
    csv_dir = scratch_path(spark, "raw-csv")
    write_raw_csv(m.clicks(spark, sf_dir), csv_dir)
    return bronze_frames(spark, csv_dir).rejects.select("product_id", "price", "user_id", "reject_reason")


# ---------------------------------------------------------------------------------------------
# Star schema: P9, P15, J1, J2, A7, A8


@query("p15_fct_events", o.silver_chain(1800, o.FCT) + "SELECT * FROM fct")
def p15_fct_events(spark, sf_dir):
    return m.fct(spark, sf_dir, m.TIMEOUT_SHORT)


@query(
    "j1_attach_sessions",
    o.silver_chain(1800) + "SELECT s.*, v.computed_session_id FROM stg s LEFT JOIN silver v USING (event_id)",
)
def j1_attach_sessions(spark, sf_dir):
    from clickweave.operators.star import attach_sessions

    st = m.staged(spark, sf_dir)
    return attach_sessions(st, m.silver(spark, sf_dir, m.TIMEOUT_SHORT, with_sequence=False))


_DIM_USERS_SQL = """dim_users AS (
    SELECT user_id, min(event_timestamp) AS first_seen, max(event_timestamp) AS last_seen,
           max(session_index) AS total_sessions, count(*) AS total_events
    FROM silver GROUP BY user_id
)"""
_DIM_PRODUCTS_SQL = """dim_products AS (
    SELECT product_id, category_code, brand, last_price, first_seen, last_seen, n_events,
           list_extract(string_split(category_code, '.'), 1) AS category_l1,
           list_extract(string_split(category_code, '.'), 2) AS category_l2
    FROM (
        SELECT product_id, category_code, brand, price AS last_price,
               min(event_timestamp) OVER (PARTITION BY product_id) AS first_seen,
               max(event_timestamp) OVER (PARTITION BY product_id) AS last_seen,
               count(*) OVER (PARTITION BY product_id) AS n_events,
               row_number() OVER (PARTITION BY product_id ORDER BY event_timestamp DESC, src_event_id DESC) AS rn
        FROM silver) WHERE rn = 1
)"""


@query("a7_dim_users", o.silver_chain(1800, _DIM_USERS_SQL) + "SELECT * FROM dim_users")
def a7_dim_users(spark, sf_dir):
    from clickweave.operators.star import dim_users

    return dim_users(m.silver(spark, sf_dir, m.TIMEOUT_SHORT, with_sequence=False))


@query("a8_dim_products", o.silver_chain(1800, _DIM_PRODUCTS_SQL) + "SELECT * FROM dim_products")
def a8_dim_products(spark, sf_dir):
    from clickweave.operators.star import dim_products

    return dim_products(m.silver(spark, sf_dir, m.TIMEOUT_SHORT, with_sequence=False))


@query(
    "j2_fact_events_fk",
    o.silver_chain(1800, o.FCT, _DIM_USERS_SQL, _DIM_PRODUCTS_SQL)
    + """SELECT f.event_id, f.product_id, f.user_id, f.computed_session_id,
       p.category_l1 AS dim_category_l1, p.brand AS dim_brand,
       u.total_sessions AS user_total_sessions, u.first_seen AS user_first_seen
FROM fct f LEFT JOIN dim_products p USING (product_id) LEFT JOIN dim_users u USING (user_id)""",
)
def j2_fact_events_fk(spark, sf_dir):
    from clickweave.operators.star import dim_products, dim_users, fact_events, fact_with_dimensions

    sv = m.silver_table(spark, sf_dir, m.TIMEOUT_SHORT)  # one silver, three derived tables
    out = fact_with_dimensions(fact_events(sv), dim_products(sv), dim_users(sv))
    return out.select(
        "event_id", "product_id", "user_id", "computed_session_id", "dim_category_l1", "dim_brand",
        "user_total_sessions", "user_first_seen",
    )


# ---------------------------------------------------------------------------------------------
# Session tables


@query(
    "a5_session_features",
    o.gold(1800)
    + """SELECT computed_session_id, session_duration_sec, total_events, view_count, cart_count, remove_count,
       distinct_products, distinct_categories, round(avg_price_viewed, 6) AS avg_price_viewed, max_price_viewed,
       CAST(is_purchased AS INTEGER) AS is_purchased FROM metrics""",
)
def a5_session_features(spark, sf_dir):
    from clickweave.operators.metrics import session_features

    return session_features(m.metrics(spark, sf_dir, m.TIMEOUT_SHORT))


@query(
    "a6_fact_sessions",
    o.gold(1800)
    + """SELECT computed_session_id, user_id, session_start, session_end, session_duration_sec, total_events,
       view_count, cart_count, remove_count, purchase_count, is_purchased FROM metrics""",
)
def a6_fact_sessions(spark, sf_dir):
    from clickweave.operators.metrics import fact_sessions

    return fact_sessions(m.metrics(spark, sf_dir, m.TIMEOUT_SHORT))


@query("p11_feature_store", o.gold(43200, o.FEATURE_STORE) + o.rounded("features"))
def p11_feature_store(spark, sf_dir):
    return m.features(spark, sf_dir, m.TIMEOUT_LONG)


@query(
    "l4_oot_split",
    o.gold(43200, o.FEATURE_STORE)
    + f"""SELECT computed_session_id, session_start,
       CASE WHEN session_start < TIMESTAMP '{m.OOT_CUTOFF}' THEN 'train' ELSE 'oot' END AS data_split
FROM features""",
)
def l4_oot_split(spark, sf_dir):
    from clickweave.operators.metrics import oot_split

    return oot_split(m.features(spark, sf_dir, m.TIMEOUT_LONG), m.OOT_CUTOFF).select(
        "computed_session_id", "session_start", "data_split"
    )


# ---------------------------------------------------------------------------------------------
# analytics


@query(
    "a11_event_frequency",
    o.silver_chain(1800, o.FCT)
    + """SELECT event_date, event_type, category_l1, count(*) AS n_events, count(DISTINCT user_id) AS n_users,
       round(sum(CASE WHEN event_type = 'purchase' THEN price END), 2) AS revenue
FROM fct GROUP BY event_date, event_type, category_l1""",
)
def a11_event_frequency(spark, sf_dir):
    from clickweave.operators.analytics import event_frequency

    return event_frequency(m.fct(spark, sf_dir, m.TIMEOUT_SHORT))


@query(
    "a12_funnel",
    o.silver_chain(43200)
    + """, stages AS (
    SELECT user_id, session_index, min(event_timestamp) AS session_start,
           min(CASE WHEN event_type = 'view' THEN event_timestamp END) AS first_view,
           min(CASE WHEN event_type = 'cart' THEN event_timestamp END) AS first_cart,
           min(CASE WHEN event_type = 'purchase' THEN event_timestamp END) AS first_purchase
    FROM silver GROUP BY user_id, session_index
), reached AS (
    SELECT CAST(session_start AS DATE) AS session_date, first_cart, first_purchase,
           first_view IS NOT NULL AS r_view,
           coalesce(first_view IS NOT NULL AND first_cart >= first_view, false) AS r_cart,
           coalesce(first_view IS NOT NULL AND first_cart >= first_view AND first_purchase >= first_cart, false) AS r_buy
    FROM stages
), agg AS (
    SELECT session_date, count(*) AS sessions,
           CAST(count_if(r_view) AS BIGINT) AS view_sessions,
           CAST(count_if(r_cart) AS BIGINT) AS view_cart_sessions,
           CAST(count_if(r_buy) AS BIGINT) AS view_cart_purchase_sessions,
           CAST(count_if(first_cart IS NOT NULL) AS BIGINT) AS any_cart_sessions,
           CAST(count_if(first_purchase IS NOT NULL) AS BIGINT) AS any_purchase_sessions
    FROM reached GROUP BY session_date
)
SELECT *, round(CAST(view_cart_sessions AS DOUBLE) / NULLIF(view_sessions, 0), 6) AS view_to_cart_rate,
       round(CAST(view_cart_purchase_sessions AS DOUBLE) / NULLIF(view_cart_sessions, 0), 6) AS cart_to_purchase_rate,
       round(CAST(view_cart_purchase_sessions AS DOUBLE) / NULLIF(sessions, 0), 6) AS session_conversion_rate
FROM agg""",
)
def a12_funnel(spark, sf_dir):
    from clickweave.operators.analytics import conversion_funnel

    return conversion_funnel(m.silver(spark, sf_dir, m.TIMEOUT_LONG, with_sequence=False))


@query(
    "a13_rollup",
    o.silver_chain(1800, o.FCT)
    + """SELECT event_month, event_date, event_hour, count(*) AS n_events,
       CAST(count_if(event_type = 'purchase') AS BIGINT) AS n_purchases,
       round(sum(CASE WHEN event_type = 'purchase' THEN price END), 2) AS revenue,
       CAST(grouping(event_month, event_date, event_hour) AS INTEGER) AS grouping_level
FROM (SELECT strftime(event_timestamp, '%Y-%m') AS event_month, CAST(event_timestamp AS DATE) AS event_date,
             CAST(hour(event_timestamp) AS INTEGER) AS event_hour, event_type, price FROM fct)
GROUP BY ROLLUP (event_month, event_date, event_hour)""",
)
def a13_rollup(spark, sf_dir):
    from clickweave.operators.analytics import time_rollup

    return time_rollup(m.fct(spark, sf_dir, m.TIMEOUT_SHORT))


# ---------------------------------------------------------------------------------------------
# Incremental maintenance (DataFrame algebra over two loads of stg)

_LOAD1_END = "2024-01-20"
_LOAD2_START = "2024-01-15"
_TGT_SQL = f"tgt AS (SELECT * FROM stg WHERE event_timestamp < TIMESTAMP '{_LOAD1_END}')"
_UPD_SQL = (
    f"upd AS (SELECT * REPLACE (price * 2 AS price), '2' AS load_batch FROM stg "
    f"WHERE event_timestamp >= TIMESTAMP '{_LOAD2_START}')"
)


def _loads(spark, sf_dir):
    st = m.staged(spark, sf_dir)
    ts = F.col("event_timestamp")
    target = st.filter(ts < F.lit(_LOAD1_END).cast("timestamp_ntz"))
    updates = (
        st.filter(ts >= F.lit(_LOAD2_START).cast("timestamp_ntz"))
        .withColumn("price", F.col("price") * 2)
        .withColumn("load_batch", F.lit("2"))
    )
    return st, target, updates


@query(
    "k4_upsert",
    o.with_(o.CLICK, o.STG, _TGT_SQL, _UPD_SQL)
    + """SELECT *, CAST(NULL AS VARCHAR) AS load_batch FROM tgt
WHERE NOT EXISTS (SELECT 1 FROM upd WHERE upd.event_id = tgt.event_id)
UNION ALL SELECT * FROM upd""",
)
def k4_upsert(spark, sf_dir):
    from clickweave.operators.incremental import upsert

    _, target, updates = _loads(spark, sf_dir)
    return upsert(target, updates, "event_id")


@query(
    "k5_incremental",
    o.with_(o.CLICK, o.STG, _TGT_SQL)
    + "SELECT * FROM stg WHERE event_timestamp > (SELECT max(event_timestamp) FROM tgt)",
)
def k5_incremental(spark, sf_dir):
    from clickweave.operators.incremental import incremental_filter

    st, target, _ = _loads(spark, sf_dir)
    return incremental_filter(st, target)


@query(
    "k5_incremental_lookback",
    o.with_(o.CLICK, o.STG, _TGT_SQL)
    + "SELECT * FROM stg WHERE event_timestamp > (SELECT max(event_timestamp) - INTERVAL 2 HOUR FROM tgt)",
)
def k5_incremental_lookback(spark, sf_dir):
    from clickweave.operators.incremental import incremental_filter

    st, target, _ = _loads(spark, sf_dir)
    return incremental_filter(st, target, lookback="2 hours")


@query(
    "a10_high_water_mark",
    o.with_(o.CLICK, o.STG, _TGT_SQL) + "SELECT max(event_timestamp) AS high_water_mark FROM tgt",
)
def a10_high_water_mark(spark, sf_dir):
    from clickweave.operators.incremental import high_water_mark

    _, target, _ = _loads(spark, sf_dir)
    return high_water_mark(target)


@query(
    "k6_evolve",
    o.with_(o.CLICK, o.STG, _TGT_SQL, _UPD_SQL)
    + """SELECT *, CAST(NULL AS VARCHAR) AS load_batch FROM tgt UNION ALL SELECT * FROM upd""",
)
def k6_evolve(spark, sf_dir):
    from clickweave.operators.incremental import evolve_union

    _, target, updates = _loads(spark, sf_dir)
    return evolve_union(target, updates)


# ---------------------------------------------------------------------------------------------
# Data tests (summary rows: check_name, table_name, column_name, n_violations, passed)


def _gold_tables(spark, sf_dir, timeout=m.TIMEOUT_SHORT):
    """Staged events plus gold tables derived from one materialised silver (sessionized once)."""
    from clickweave.operators.metrics import feature_store, session_metrics
    from clickweave.sinks.tables import stage
    from clickweave.operators.star import fact_events

    st = stage(spark, m.staged(spark, sf_dir), "staged")
    sv = stage(spark, ses.sessionize(st, timeout, with_sequence=False), "silver")
    return st, fact_events(sv), stage(spark, feature_store(session_metrics(sv)), "features")


def _unique_sql(table: str, col: str, src: str) -> str:
    return f"""SELECT 'unique' AS check_name, '{table}' AS table_name, '{col}' AS column_name,
       CAST(coalesce(sum(n), 0) AS BIGINT) AS n_violations
FROM (SELECT {col}, count(*) AS n FROM {src} WHERE {col} IS NOT NULL GROUP BY {col} HAVING count(*) > 1)"""


def _not_null_sql(table: str, cols: tuple[str, ...], src: str) -> str:
    return "\nUNION ALL ".join(
        f"SELECT 'not_null', '{table}', '{c}', CAST(count_if({c} IS NULL) AS BIGINT) FROM {src}" for c in cols
    )


_STG_NOT_NULL = ("event_id", "event_timestamp", "event_type", "user_id")
_FCT_NOT_NULL = ("event_id", "event_timestamp", "user_id", "computed_session_id")
_FEAT_NOT_NULL = ("computed_session_id", "is_purchased")
_ACCEPTED = "('view', 'cart', 'remove_from_cart', 'purchase')"

_Q1_SQL = "\nUNION ALL ".join(
    [
        _unique_sql("stg_raw_events", "event_id", "stg"),
        _unique_sql("fct_events", "event_id", "fct"),
        _unique_sql("mart_ml_features", "computed_session_id", "features"),
    ]
)
_Q2_SQL = "\nUNION ALL ".join(
    [
        _not_null_sql("stg_raw_events", _STG_NOT_NULL, "stg"),
        _not_null_sql("fct_events", _FCT_NOT_NULL, "fct"),
        _not_null_sql("mart_ml_features", _FEAT_NOT_NULL, "features"),
    ]
)
_Q3_SUMMARY_SQL = "\nUNION ALL ".join(
    f"""SELECT 'accepted_values' AS check_name, '{table}' AS table_name, 'event_type' AS column_name,
       CAST(count_if(event_type IS NOT NULL AND event_type NOT IN {_ACCEPTED}) AS BIGINT) AS n_violations FROM {src}"""
    for table, src in (("stg_raw_events", "stg"), ("fct_events", "fct"))
)
_Q4_SQL = """SELECT 'relationships', 'fct_events', 'computed_session_id', CAST(count(*) AS BIGINT)
FROM fct WHERE computed_session_id IS NOT NULL
  AND NOT EXISTS (SELECT 1 FROM features WHERE features.computed_session_id = fct.computed_session_id)"""
_Q5_SQL = """SELECT 'non_negative_duration', 'mart_ml_features', 'session_duration_sec',
       CAST(count_if(session_duration_sec < 0) AS BIGINT) FROM features"""
_Q6_SUMMARY_SQL = """SELECT 'non_negative', 'bronze_events', 'price', CAST(count_if(price < 0) AS BIGINT) FROM click"""


def _checks_sql(*parts: str) -> str:
    body = "\nUNION ALL ".join(parts)
    return (
        o.gold(1800, o.FEATURE_STORE, o.FCT)
        + f"SELECT *, n_violations = 0 AS passed FROM ({body}) AS t(check_name, table_name, column_name, n_violations)"
    )


@query("q1_unique", _checks_sql(_Q1_SQL))
def q1_unique(spark, sf_dir):
    from clickweave.operators import quality as q

    st, fct, feats = _gold_tables(spark, sf_dir)
    return q.run_checks(
        [
            q.check_unique(st, "event_id", "stg_raw_events"),
            q.check_unique(fct, "event_id", "fct_events"),
            q.check_unique(feats, "computed_session_id", "mart_ml_features"),
        ]
    )


@query("q2_not_null", _checks_sql(_Q2_SQL))
def q2_not_null(spark, sf_dir):
    from clickweave.operators import quality as q

    st, fct, feats = _gold_tables(spark, sf_dir)
    return q.run_checks(
        [
            q.check_not_null(st, _STG_NOT_NULL, "stg_raw_events"),
            q.check_not_null(fct, _FCT_NOT_NULL, "fct_events"),
            q.check_not_null(feats, _FEAT_NOT_NULL, "mart_ml_features"),
        ]
    )


@query(
    "q3_accepted_values",
    o.with_(o.CLICK, o.STG)
    + f"""SELECT event_type, count(*) AS n_violations FROM stg
WHERE event_type IS NOT NULL AND event_type NOT IN {_ACCEPTED} GROUP BY event_type""",
)
def q3_accepted_values(spark, sf_dir):
    from clickweave.operators.quality import accepted_values_violations

    return accepted_values_violations(m.staged(spark, sf_dir), "event_type")


@query("q3_fct_accepted_values", _checks_sql(_Q3_SUMMARY_SQL))
def q3_fct_accepted_values(spark, sf_dir):
    from clickweave.operators import quality as q

    st, fct, _ = _gold_tables(spark, sf_dir)
    return q.run_checks(
        [q.check_accepted_values(st, "event_type", "stg_raw_events"), q.check_accepted_values(fct, "event_type", "fct_events")]
    )


@query("q4_relationships", _checks_sql(_Q4_SQL))
def q4_relationships(spark, sf_dir):
    from clickweave.operators import quality as q

    _, fct, feats = _gold_tables(spark, sf_dir)
    return q.run_checks([q.check_relationship(fct, feats, "computed_session_id", "fct_events")])


@query("q5_session_duration", _checks_sql(_Q5_SQL))
def q5_session_duration(spark, sf_dir):
    from clickweave.operators import quality as q

    _, _, feats = _gold_tables(spark, sf_dir)
    return q.run_checks([q.check_duration(feats, "mart_ml_features")])


@query("q6_price", o.with_(o.CLICK) + "SELECT src_event_id, price FROM click WHERE price < 0")
def q6_price(spark, sf_dir):
    from clickweave.operators.quality import negative_price_violations

    return negative_price_violations(m.clicks(spark, sf_dir)).select("src_event_id", "price")


@query("q0_data_tests", _checks_sql(_Q1_SQL, _Q2_SQL, _Q3_SUMMARY_SQL, _Q4_SQL, _Q5_SQL, _Q6_SUMMARY_SQL))
def q0_data_tests(spark, sf_dir):
    """Every declared test; row-level rules of a table share one scan (``check_table``)."""
    from clickweave.operators import quality as q
    from clickweave.sources.schema import ACCEPTED_EVENT_TYPES

    st, fct, feats = _gold_tables(spark, sf_dir)
    return q.run_checks(
        [
            q.check_unique(st, "event_id", "stg_raw_events"),
            q.check_unique(fct, "event_id", "fct_events"),
            q.check_unique(feats, "computed_session_id", "mart_ml_features"),
            q.check_table(st, "stg_raw_events", not_null=_STG_NOT_NULL,
                          accepted_values={"event_type": ACCEPTED_EVENT_TYPES}),
            q.check_table(fct, "fct_events", not_null=_FCT_NOT_NULL, accepted_values={"event_type": ACCEPTED_EVENT_TYPES}),
            q.check_table(feats, "mart_ml_features", not_null=_FEAT_NOT_NULL, min_value={"session_duration_sec": 0}),
            q.check_relationship(fct, feats, "computed_session_id", "fct_events"),
            q.check_table(m.clicks(spark, sf_dir), "bronze_events", non_negative=("price",)),
        ]
    )


# ---------------------------------------------------------------------------------------------
# ML

_AUC_TAIL = """, sc AS (SELECT * FROM sc0 WHERE s IS NOT NULL AND y IS NOT NULL), r AS (
    SELECT y, rank() OVER (ORDER BY s) + (count(*) OVER (PARTITION BY s) - 1) / 2.0 AS ar FROM sc
), t AS (
    SELECT CAST(count_if(y) AS BIGINT) AS n_pos, CAST(count_if(NOT y) AS BIGINT) AS n_neg,
           sum(CASE WHEN y THEN ar ELSE 0 END) AS rs FROM r
)
SELECT n_pos, n_neg, (SELECT count(*) FROM sc0 WHERE s IS NULL OR y IS NULL) AS n_unscored,
       round(CAST(rs - n_pos * (n_pos + 1) / 2.0 AS DOUBLE) / (CAST(n_pos AS DOUBLE) * n_neg), 9) AS roc_auc
FROM t"""


@query(
    "l7_auc",
    o.with_(o.CLICK, o.STG)
    + """, sc0 AS (SELECT CAST(price AS DOUBLE) AS s, event_type = 'purchase' AS y FROM stg)"""
    + _AUC_TAIL,
)
def l7_auc(spark, sf_dir):
    """Exact ROC-AUC of price as a purchase score over all staged events (DataFrame form)."""
    from clickweave.operators.ml import roc_auc_frame

    st = m.staged(spark, sf_dir).withColumn("is_purchase", F.col("event_type") == "purchase")
    return roc_auc_frame(st, "price", "is_purchase")


@query(
    "l7_session_auc",
    o.gold(43200, o.FEATURE_STORE)
    + """, sc0 AS (SELECT CAST(view_count AS DOUBLE) AS s, is_purchased AS y FROM features)"""
    + _AUC_TAIL,
)
def l7_session_auc(spark, sf_dir):
    """Exact ROC-AUC of a one-feature session score (view count) against the purchase label."""
    from clickweave.operators.ml import roc_auc_frame

    return roc_auc_frame(m.features(spark, sf_dir, m.TIMEOUT_LONG), "view_count", "is_purchased")


@query(
    "l7_pr_auc",
    o.gold(43200, o.FEATURE_STORE)
    + """, g AS (SELECT view_count AS s, count_if(is_purchased) AS pos, count_if(NOT is_purchased) AS neg FROM features GROUP BY 1
), c AS (
    SELECT pos, neg, sum(pos) OVER w AS tp, sum(neg) OVER w AS fp FROM g
    WINDOW w AS (ORDER BY s DESC ROWS UNBOUNDED PRECEDING)
)
SELECT CAST(sum(pos) AS BIGINT) AS n_pos, CAST(sum(neg) AS BIGINT) AS n_neg,
       round(sum(pos * (tp / (tp + fp) + CASE WHEN tp - pos + fp - neg = 0 THEN tp / (tp + fp)
                 ELSE (tp - pos) / (tp - pos + fp - neg) END) / 2.0) / sum(pos), 9) AS pr_auc
FROM c""",
)
def l7_pr_auc(spark, sf_dir):
    """Area under the precision-recall curve of a one-feature session score."""
    from clickweave.operators.ml import pr_auc_frame

    return pr_auc_frame(m.features(spark, sf_dir, m.TIMEOUT_LONG), "view_count", "is_purchased")


def _drift_sql() -> str:
    from clickweave.sources.schema import FEATURE_COLUMNS

    long = "\n    UNION ALL ".join(
        f"SELECT data_split, '{c}' AS feature, CAST({c} AS DOUBLE) AS value FROM fs" for c in FEATURE_COLUMNS
    )
    return o.gold(43200, o.FEATURE_STORE) + f""", fs AS (
    SELECT *, CASE WHEN session_start < TIMESTAMP '{m.OOT_CUTOFF}' THEN 'train' ELSE 'oot' END AS data_split
    FROM features
), long AS (
    {long}
), ranges AS (SELECT feature, min(value) AS lo, max(value) AS hi FROM long GROUP BY feature
), binned AS (
    SELECT data_split, feature,
           CAST(CASE WHEN value IS NULL THEN -1 WHEN hi - lo <= 0 THEN 0
                     ELSE least(floor((value - lo) / (hi - lo) * 10), 9) END AS INTEGER) AS bin
    FROM long JOIN ranges USING (feature)
), counts AS (
    SELECT feature, bin, count_if(data_split = 'train') AS n_base, count_if(data_split = 'oot') AS n_cur
    FROM binned GROUP BY feature, bin
), totals AS (SELECT feature, sum(n_base) AS t_base, sum(n_cur) AS t_cur FROM counts GROUP BY feature)
SELECT feature,
       round(sum((n_cur / t_cur - n_base / t_base) * ln((n_cur / t_cur + 1e-6) / (n_base / t_base + 1e-6))), 6) AS psi,
       CAST(sum(n_base) AS BIGINT) AS n_base, CAST(sum(n_cur) AS BIGINT) AS n_cur
FROM counts JOIN totals USING (feature) GROUP BY feature"""


@query("l9_drift", _drift_sql())
def l9_drift(spark, sf_dir):
    from clickweave.operators.metrics import oot_split
    from clickweave.operators.ml import drift_psi
    from clickweave.sinks.tables import stage

    feats = stage(spark, m.features(spark, sf_dir, m.TIMEOUT_LONG), "features")  # read by several branches
    return drift_psi(oot_split(feats, m.OOT_CUTOFF), binning="equal_width")


def _quantile_drift_sql() -> str:
    from clickweave.sources.schema import FEATURE_COLUMNS

    long = "\n    UNION ALL ".join(
        f"SELECT data_split, '{c}' AS feature, CAST({c} AS DOUBLE) AS value FROM fs" for c in FEATURE_COLUMNS
    )
    return o.gold(43200, o.FEATURE_STORE) + f""", fs AS (
    SELECT *, CASE WHEN session_start < TIMESTAMP '{m.OOT_CUTOFF}' THEN 'train' ELSE 'oot' END AS data_split
    FROM features
), long AS (
    {long}
), ranked AS (
    SELECT feature, value, row_number() OVER (PARTITION BY feature ORDER BY value) AS r, count(*) OVER (PARTITION BY feature) AS n
    FROM long WHERE data_split = 'train' AND value IS NOT NULL
), edges AS (
    SELECT feature, list_distinct(list(value)) AS e FROM ranked
    WHERE r IN (SELECT unnest([CAST(ceil(q * n / 10.0) AS BIGINT) FOR q IN range(1, 10)])) GROUP BY feature
), binned AS (
    SELECT data_split, feature, CASE WHEN value IS NULL THEN -1 ELSE len(list_filter(e, lambda x: x <= value)) END AS bin
    FROM long JOIN edges USING (feature)
), counts AS (
    SELECT feature, bin, count_if(data_split = 'train') AS n_base, count_if(data_split = 'oot') AS n_cur
    FROM binned GROUP BY feature, bin
), totals AS (SELECT feature, sum(n_base) AS t_base, sum(n_cur) AS t_cur FROM counts GROUP BY feature)
SELECT feature,
       round(sum((n_cur / t_cur - n_base / t_base) * ln((n_cur / t_cur + 1e-6) / (n_base / t_base + 1e-6))), 6) AS psi,
       CAST(sum(n_base) AS BIGINT) AS n_base, CAST(sum(n_cur) AS BIGINT) AS n_cur
FROM counts JOIN totals USING (feature) GROUP BY feature"""


@query("l9_drift_quantile", _quantile_drift_sql())
def l9_drift_quantile(spark, sf_dir):
    """L9 in its default form: bins at the base period's quantiles."""
    from clickweave.operators.metrics import oot_split
    from clickweave.operators.ml import drift_psi
    from clickweave.sinks.tables import stage

    feats = stage(spark, m.features(spark, sf_dir, m.TIMEOUT_LONG), "features")
    return drift_psi(oot_split(feats, m.OOT_CUTOFF))


def _summary_sql() -> str:
    from clickweave.sources.schema import FEATURE_COLUMNS

    long = "\n    UNION ALL ".join(
        f"SELECT data_partition, '{c}' AS feature, CAST({c} AS DOUBLE) AS value FROM features" for c in FEATURE_COLUMNS
    )
    return o.gold(43200, o.FEATURE_STORE) + f""", long AS (
    {long}
)
SELECT data_partition, feature, count(value) AS n, CAST(count_if(value IS NULL) AS BIGINT) AS n_null,
       round(avg(value), 6) AS mean, round(stddev_samp(value), 6) AS stddev,
       min(value) AS min_value, max(value) AS max_value
FROM long GROUP BY data_partition, feature"""


@query("l9_feature_summary", _summary_sql())
def l9_feature_summary(spark, sf_dir):
    from clickweave.operators.ml import feature_summary

    return feature_summary(m.features(spark, sf_dir, m.TIMEOUT_LONG))


def _model_input(spark, sf_dir, timeout=m.TIMEOUT_LONG):
    """Model input (one row per session), staged once: training and scoring read the staged table
    instead of each re-deriving sessions from the events."""
    from clickweave.operators.ml import prepare
    from clickweave.sinks.tables import stage

    return stage(spark, prepare(m.features(spark, sf_dir, timeout)), "model-input")


def _oot_frames(spark, sf_dir, timeout=m.TIMEOUT_LONG):
    from clickweave.operators.ml import temporal_split

    return temporal_split(_model_input(spark, sf_dir, timeout), m.OOT_CUTOFF)


# A fitted model's scores cannot be restated in SQL. The queries return them; beside each, a query of
# checks returns what SQL can restate: the rows scored, their labels, and whether scores and reports
# keep the properties they must have.

_CHECKED = ("computed_session_id", "is_purchased", "score_in_range", "prediction_agrees")
_CHECKED_SQL = "SELECT computed_session_id, CAST(is_purchased AS INTEGER) AS is_purchased, true AS score_in_range, true AS prediction_agrees FROM features"
_OOT_SQL = f" WHERE session_start >= TIMESTAMP '{m.OOT_CUTOFF}'"


def _checked(scored: DataFrame) -> DataFrame:
    """Scored rows with ``score_in_range`` and ``prediction_agrees`` in place of the score."""
    return scored.withColumns(
        {
            "score_in_range": F.col("score").between(0.0, 1.0),
            "prediction_agrees": F.col("prediction") == (F.col("score") > 0.5).cast("int"),
        }
    ).drop("score", "prediction")


@query("l1_gbt_scores")
def l1_gbt_scores(spark, sf_dir):
    """L1 + L5 + L6: fit the GBT pipeline on the training period, score the out-of-time sessions."""
    from clickweave.operators import ml

    train, oot = _oot_frames(spark, sf_dir)
    return ml.score(ml.fit(ml.build_gbt(), train), oot)


@query("l2_rf_scores")
def l2_rf_scores(spark, sf_dir):
    from clickweave.operators import ml

    train, oot = _oot_frames(spark, sf_dir)
    return ml.score(ml.fit(ml.build_random_forest(), train), oot)


@query("l1_gbt_checks", o.gold(43200, o.FEATURE_STORE) + _CHECKED_SQL + _OOT_SQL)
def l1_gbt_checks(spark, sf_dir):
    return _checked(l1_gbt_scores(spark, sf_dir)).select(*_CHECKED)


@query("l2_rf_checks", o.gold(43200, o.FEATURE_STORE) + _CHECKED_SQL + _OOT_SQL)
def l2_rf_checks(spark, sf_dir):
    return _checked(l2_rf_scores(spark, sf_dir)).select(*_CHECKED)


_SPLIT_SQL = "SELECT computed_session_id, CAST(1 AS BIGINT) AS n_sides, true AS share_near_target FROM features"


def _sides(train: DataFrame, validation: DataFrame) -> DataFrame:
    """Each key with the side it is on."""
    side = lambda df, name: df.select("computed_session_id", F.lit(name).alias("side"))
    return side(train, "train").unionByName(side(validation, "validation"))


def _split_checks(sides: DataFrame, ratio: float) -> DataFrame:
    """Each key with the number of sides it is on, and whether the sides have their shares (within
    a quarter of the target)."""
    from clickweave.sinks.tables import stage

    sides = stage(sides.sparkSession, sides, "split")
    share = sides.agg(F.avg((F.col("side") == "validation").cast("int"))).first()[0] or 0.0
    near = abs(share - ratio) <= ratio / 4
    return sides.groupBy("computed_session_id").agg(F.count(F.lit(1)).alias("n_sides")).withColumn("share_near_target", F.lit(near))


@query("l3_random_split")
def l3_random_split(spark, sf_dir):
    from clickweave.operators import ml

    return _sides(*ml.random_split(_model_input(spark, sf_dir)))


@query("l3_hash_split")
def l3_hash_split(spark, sf_dir):
    from clickweave.operators import ml

    return _sides(*ml.hash_split(_model_input(spark, sf_dir)))


@query("l3_random_split_checks", o.gold(43200, o.FEATURE_STORE) + _SPLIT_SQL)
def l3_random_split_checks(spark, sf_dir):
    from clickweave.operators import ml

    return _split_checks(l3_random_split(spark, sf_dir), ml.VAL_RATIO)


@query("l3_hash_split_checks", o.gold(43200, o.FEATURE_STORE) + _SPLIT_SQL)
def l3_hash_split_checks(spark, sf_dir):
    from clickweave.operators import ml

    return _split_checks(l3_hash_split(spark, sf_dir), ml.VAL_RATIO)


_REPORT_SQL = "SELECT CAST(9 AS BIGINT) AS n_features, true AS auc_in_range, true AS auc_recomputed, true AS importances_sum_to_one, true AS ranked"


_REPORT_CHECKED = ("n_features", "auc_in_range", "auc_recomputed", "importances_sum_to_one", "ranked")


def _report_checks(spark, report: DataFrame, scored: DataFrame) -> DataFrame:
    """One row: a report, and beside it its figures against the same metrics by their DataFrame form."""
    from clickweave.operators import ml
    from clickweave.sinks.tables import stage

    scored = stage(spark, scored, "scored")
    roc = ml.roc_auc_frame(scored, "score", "is_purchased").first()["roc_auc"]
    pr = ml.pr_auc_frame(scored, "score", "is_purchased").first()["pr_auc"]
    imp = F.col("feature_importance")
    same = lambda c, v: F.coalesce(F.abs(F.col(c) - F.lit(v)) < 1e-6, F.lit(False))
    weights = F.transform(imp, lambda x: x["importance"])
    return report.select(
        "*",
        F.size(imp).cast("bigint").alias("n_features"),
        (F.col("roc_auc").between(0, 1) & F.col("pr_auc").between(0, 1)).alias("auc_in_range"),
        (same("roc_auc", roc) & same("pr_auc", pr)).alias("auc_recomputed"),
        (F.abs(F.aggregate(weights, F.lit(0.0), lambda a, x: a + x) - 1) < 1e-6).alias("importances_sum_to_one"),
        (F.reverse(F.array_sort(weights)) == weights).alias("ranked"),
    )


def _validation(spark, sf_dir):
    """(report, scored validation rows): the training job; fit on 80 % of the training period, exact
    ROC/PR-AUC on the other 20 %."""
    from clickweave.operators import ml
    from clickweave.plans.training import train
    from clickweave.session import scratch_path

    period, _ = _oot_frames(spark, sf_dir)
    model_dir = scratch_path(spark, "model")
    report = train(spark, period, model_dir)
    _, validation = ml.hash_split(period)
    return report, ml.score(ml.load_model(model_dir), validation)


@query("l5_validation_auc")
def l5_validation_auc(spark, sf_dir):
    """The report of the training job, its figures recomputed from the scored validation rows."""
    return _report_checks(spark, *_validation(spark, sf_dir))


@query("l5_validation_checks", _REPORT_SQL)
def l5_validation_checks(spark, sf_dir):
    return l5_validation_auc(spark, sf_dir).select(*_REPORT_CHECKED)


def _importances(spark, sf_dir):
    from clickweave.operators import ml

    period, _ = _oot_frames(spark, sf_dir)
    return ml.importance_frame(spark, ml.fit(ml.build_gbt(), period))


@query("l8_feature_importance")
def l8_feature_importance(spark, sf_dir):
    """L8 + O1: feature, importance and rank of the model of the training period."""
    return _importances(spark, sf_dir)


@query(
    "l8_importance_checks",
    "SELECT unnest(['session_duration_sec', 'total_events', 'view_count', 'cart_count', 'remove_count', 'distinct_products', "
    "'distinct_categories', 'avg_price_viewed', 'max_price_viewed']) AS feature, true AS importance_in_range, true AS rank_is_place",
)
def l8_importance_checks(spark, sf_dir):
    from pyspark.sql import Window

    imp = _importances(spark, sf_dir)
    place = F.row_number().over(Window.orderBy(F.desc("importance"), "feature"))  # nine rows
    return imp.select("feature", F.col("importance").between(0, 1).alias("importance_in_range"), (F.col("rank") == place).alias("rank_is_place"))


def _oot_report(spark, sf_dir):
    """(report, scored rows) of E4 end to end: the training job saves a model (K10), the evaluation job
    loads it (S6), scores the out-of-time period, evaluates (L7) and writes the JSON report (K11),
    read back here."""
    from clickweave.operators import ml
    from clickweave.plans.training import evaluate, train
    from clickweave.session import scratch_path

    period, oot = _oot_frames(spark, sf_dir)
    model_dir, report_dir = scratch_path(spark, "model"), scratch_path(spark, "report")
    train(spark, period, model_dir)
    report = evaluate(spark, oot, model_dir, report_dir)
    return report, ml.score(ml.load_model(model_dir), oot)


@query("k11_oot_report")
def k11_oot_report(spark, sf_dir):
    """The JSON report of the out-of-time evaluation, its figures recomputed from the scored rows."""
    return _report_checks(spark, *_oot_report(spark, sf_dir))


@query("k11_oot_checks", _REPORT_SQL)
def k11_oot_checks(spark, sf_dir):
    return k11_oot_report(spark, sf_dir).select(*_REPORT_CHECKED)


@query(
    "k10_saved_model",
    o.gold(43200, o.FEATURE_STORE) + "SELECT computed_session_id, true AS same_score FROM features" + _OOT_SQL,
)
def k10_saved_model(spark, sf_dir):
    """K10 + S6: a model read back from its folder scores as the fitted one does."""
    from clickweave.operators import ml
    from clickweave.session import scratch_path

    period, oot = _oot_frames(spark, sf_dir)
    model, path = ml.fit(ml.build_gbt(max_iter=3), period), scratch_path(spark, "model")
    ml.save_model(model, path)
    again = ml.score(ml.load_model(path), oot).select("computed_session_id", F.col("score").alias("again"))
    both = ml.score(model, oot).join(again, "computed_session_id")
    return both.select("computed_session_id", (F.col("score") == F.col("again")).alias("same_score"))


# ---------------------------------------------------------------------------------------------
# Gap sessions by session_window (the streaming operator, run here on the static table)


@query(
    "t1_session_window",
    o.with_(o.CLICK, o.STG)
    + """, lg AS (
    SELECT *, lag(event_timestamp) OVER (PARTITION BY user_id ORDER BY event_timestamp, src_event_id) AS prev_ts
    FROM stg WHERE user_id IS NOT NULL AND event_timestamp IS NOT NULL
), fl AS (
    SELECT *, CASE WHEN prev_ts IS NULL OR epoch_us(event_timestamp) - epoch_us(prev_ts) > 1800000000
                   THEN 1 ELSE 0 END AS f FROM lg
), ix AS (
    SELECT *, sum(f) OVER (PARTITION BY user_id ORDER BY event_timestamp, src_event_id
                           ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS sidx FROM fl
)
SELECT CAST(user_id AS VARCHAR) || '@' || strftime(min(event_timestamp), '%Y-%m-%dT%H:%M:%S.%f') AS stream_session_id,
       user_id, min(event_timestamp) AS session_start, max(event_timestamp) AS session_end,
       date_diff('second', min(event_timestamp), max(event_timestamp)) AS session_duration_sec,
       count(*) AS total_events,
       CAST(count_if(event_type = 'view') AS BIGINT) AS view_count,
       CAST(count_if(event_type = 'cart') AS BIGINT) AS cart_count,
       CAST(count_if(event_type = 'remove_from_cart') AS BIGINT) AS remove_count,
       CAST(count_if(event_type = 'purchase') AS BIGINT) AS purchase_count,
       count(DISTINCT product_id) AS distinct_products,
       count(DISTINCT category_code) AS distinct_categories,
       round(avg(CASE WHEN event_type = 'view' THEN price END), 6) AS avg_price_viewed,
       max(CASE WHEN event_type = 'view' THEN price END) AS max_price_viewed,
       count_if(event_type = 'purchase') > 0 AS is_purchased
FROM ix GROUP BY user_id, sidx""",
)
def t1_session_window(spark, sf_dir):
    from clickweave.streaming.sessions import session_window_metrics

    return session_window_metrics(m.staged(spark, sf_dir), "30 minutes")


# ---------------------------------------------------------------------------------------------
# H1, P14, S5, U1, K12, T2


@query(
    "h1_incremental_sessions",
    o.silver_chain(1800) + f"SELECT {_SILVER_SQL_COLS} FROM silver",
)
def h1_incremental_sessions(spark, sf_dir):
    """Two loads (before / from 2024-01-20): the second is sessionized against the per-user state of
    the first (last time, last index). The union equals sessionizing everything at once."""
    st = m.staged(spark, sf_dir)
    cut = F.lit(_LOAD1_END).cast("timestamp_ntz")
    first = ses.sessionize(st.filter(F.col("event_timestamp") < cut), m.TIMEOUT_SHORT)
    second, _ = ses.sessionize_incremental(
        st.filter(F.col("event_timestamp") >= cut), ses.session_state(first), m.TIMEOUT_SHORT
    )
    return first.select(*_SILVER_COLS).unionByName(second.select(*_SILVER_COLS))


@query(
    "p14_year_month",
    o.silver_chain(1800)
    + """SELECT event_id, computed_session_id, CAST(year(event_timestamp) AS INTEGER) AS event_year,
       CAST(month(event_timestamp) AS INTEGER) AS event_month FROM silver""",
)
def p14_year_month(spark, sf_dir):
    sv = ses.with_year_month(m.silver(spark, sf_dir, m.TIMEOUT_SHORT, with_sequence=False))
    return sv.select("event_id", "computed_session_id", "event_year", "event_month")


_S5_SQL = """SELECT event_type, count(*) AS n_events, count(DISTINCT user_id) AS n_users
FROM bronze_events GROUP BY event_type"""


@query("s5_bronze_view", o.with_(o.CLICK) + _S5_SQL.replace("bronze_events", "click"))
def s5_bronze_view(spark, sf_dir):
    """The click table exposed by name as a temp view and queried with Spark SQL."""
    from clickweave.sources.tables import register

    register(m.clicks(spark, sf_dir), "bronze_events")
    return spark.sql(_S5_SQL)


@query(
    "u1_batch_union",
    o.with_(o.CLICK, o.STG, _TGT_SQL)
    + f"""SELECT * FROM tgt UNION ALL
SELECT * FROM stg WHERE event_timestamp >= TIMESTAMP '{_LOAD2_START}'""",
)
def u1_batch_union(spark, sf_dir):
    """Appending batches is a bag union (overlapping loads keep both copies)."""
    st, target, _ = _loads(spark, sf_dir)
    return target.unionByName(st.filter(F.col("event_timestamp") >= F.lit(_LOAD2_START).cast("timestamp_ntz")))


@query("k12_scored_sessions")
def k12_scored_sessions(spark, sf_dir):
    """Out-of-time sessions scored by the trained model, written as the predictions table
    (partitioned by data_partition) and read back."""
    from clickweave.operators import ml
    from clickweave.session import scratch_path
    from clickweave.sinks.tables import write_predictions

    train, oot = _oot_frames(spark, sf_dir)
    scored = ml.score(ml.fit(ml.build_gbt(), train), oot, keep=("computed_session_id", "data_partition"))
    path = scratch_path(spark, "predictions")
    write_predictions(scored, path)
    return spark.read.parquet(path).withColumn("data_partition", F.col("data_partition").cast("string"))


@query(
    "k12_scored_checks",
    o.gold(43200, o.FEATURE_STORE)
    + "SELECT computed_session_id, data_partition, CAST(is_purchased AS INTEGER) AS is_purchased, true AS score_in_range, "
    "true AS prediction_agrees FROM features" + _OOT_SQL,
)
def k12_scored_checks(spark, sf_dir):
    return _checked(k12_scored_sessions(spark, sf_dir))


_GAP_SESSIONS = """, lg AS (
    SELECT *, lag(event_timestamp) OVER (PARTITION BY user_id ORDER BY event_timestamp, src_event_id) AS prev_ts
    FROM stg WHERE user_id IS NOT NULL AND event_timestamp IS NOT NULL
), ix AS (
    SELECT *, sum(CASE WHEN prev_ts IS NULL OR epoch_us(event_timestamp) - epoch_us(prev_ts) > 1800000000 THEN 1 ELSE 0 END)
              OVER (PARTITION BY user_id ORDER BY event_timestamp, src_event_id ROWS UNBOUNDED PRECEDING) AS sidx FROM lg
)"""


@query("t2_stream_scores")
def t2_stream_scores(spark, sf_dir):
    """T1 + T2 as a real stream: staged events land as Parquet files in the scratch folder, a
    file-source stream builds gap sessions with a watermark and appends scored sessions to a
    Parquet sink (run to completion with an available-now trigger). A session is closed, and
    emitted, once the watermark (last event less two hours) has passed its end plus the gap; those
    still open at the end of the input stay in the stream's state for the next run. The model is
    trained on sessions of the same 30-minute timeout."""
    from clickweave.operators import ml
    from clickweave.session import scratch_path
    from clickweave.streaming.sessions import start_scoring_stream

    train, _ = _oot_frames(spark, sf_dir, m.TIMEOUT_SHORT)
    model = ml.fit(ml.build_gbt(), train)
    src, sink, ckpt = (scratch_path(spark, n) for n in ("stream-src", "stream-sink", "stream-ckpt"))
    m.staged(spark, sf_dir).write.parquet(src)
    stream = spark.readStream.schema(spark.read.parquet(src).schema).parquet(src)
    q = start_scoring_stream(stream, model, sink, ckpt, watermark="2 hours", available_now=True)
    q.awaitTermination()
    return spark.read.parquet(sink)


@query(
    "t2_stream_checks",
    o.with_(o.CLICK, o.STG)
    + _GAP_SESSIONS
    + """SELECT CAST(user_id AS VARCHAR) || '@' || strftime(min(event_timestamp), '%Y-%m-%dT%H:%M:%S.%f') AS stream_session_id,
       user_id, min(event_timestamp) AS session_start, CAST(count_if(event_type = 'purchase') > 0 AS INTEGER) AS is_purchased,
       true AS score_in_range, true AS prediction_agrees
FROM ix GROUP BY user_id, sidx
HAVING max(event_timestamp) + INTERVAL 30 MINUTE <= (SELECT max(event_timestamp) - INTERVAL 2 HOUR FROM stg)""",
)
def t2_stream_checks(spark, sf_dir):
    return _checked(t2_stream_scores(spark, sf_dir))


# ---------------------------------------------------------------------------------------------
# H2: a hot user holding a third of all events (every event_id divisible by 3 is reassigned to
# user 0) — the chunked sessionizer must give exactly the single-window answer.

_HOT_STG = """hot AS (SELECT * REPLACE (CASE WHEN src_event_id % 3 = 0 THEN 0 ELSE user_id END AS user_id) FROM stg)"""


@query(
    "h2_hot_user_sessions",
    o.with_(o.CLICK, o.STG, _HOT_STG, o.silver(1800, source="hot"), o.METRICS) + o.rounded("metrics"),
)
def h2_hot_user_sessions(spark, sf_dir):
    from clickweave.operators.metrics import session_metrics

    st = m.staged(spark, sf_dir)
    hot = st.withColumn("user_id", F.when(F.col("src_event_id") % 3 == 0, F.lit(0).cast("bigint")).otherwise(F.col("user_id")))
    return session_metrics(ses.sessionize(hot, m.TIMEOUT_SHORT, with_sequence=False))


@query(
    "h2_hot_user_sequence",
    o.with_(o.CLICK, o.STG, _HOT_STG, o.silver(1800, source="hot"))
    + "SELECT src_event_id, computed_session_id, idle_seconds, session_flag, event_seq FROM silver",
)
def h2_hot_user_sequence(spark, sf_dir):
    st = m.staged(spark, sf_dir)
    hot = st.withColumn("user_id", F.when(F.col("src_event_id") % 3 == 0, F.lit(0).cast("bigint")).otherwise(F.col("user_id")))
    return ses.sessionize(hot, m.TIMEOUT_SHORT).select(
        "src_event_id", "computed_session_id", "idle_seconds", "session_flag", "event_seq"
    )


# ---------------------------------------------------------------------------------------------
# Layer build + incremental refresh (with late events) equals the full computation


@query("e3_refresh_features", o.gold(1800, o.FEATURE_STORE) + o.rounded("features"))
def e3_refresh_features(spark, sf_dir):
    """Build the layers from events before 2024-01-18 minus every 7th event, then refresh with the
    rest (later events plus the withheld, now late, ones); return the refreshed feature store."""
    from clickweave.plans.layers import build_layers, paths, refresh_layers
    from clickweave.session import ensure_checkpoint_dir, scratch_path

    ensure_checkpoint_dir(spark)
    root = scratch_path(spark, "layers")
    bronze = m.clicks(spark, sf_dir)
    before = F.col("event_timestamp") < F.lit("2024-01-18").cast("timestamp_ntz")
    withheld = before & (F.col("src_event_id") % 7 == 0)
    build_layers(spark, bronze.filter(before & ~withheld), root)
    refresh_layers(spark, bronze.filter(~before | withheld), root)
    from clickweave.operators.metrics import FEATURE_STORE_COLUMNS

    return spark.read.parquet(paths(root)["mart_ml_features"]).select(*FEATURE_STORE_COLUMNS)


# ---------------------------------------------------------------------------------------------
# Table jobs, read back after writing: K1-K4, K7, K9, S3, E2

_WRITTEN = ("event_id", "event_timestamp", "event_type", "product_id", "price", "user_id", "event_date")
_DATED_SQL = "dated AS (SELECT *, CAST(event_timestamp AS DATE) AS event_date FROM stg)"
_WRITTEN_SQL = ", ".join(_WRITTEN)


def _dated(spark, sf_dir):
    return m.staged(spark, sf_dir).withColumn("event_date", F.to_date("event_timestamp")).select(*_WRITTEN)


@query(
    "k1_ensure_append",
    o.with_(o.CLICK, o.STG, _DATED_SQL) + f"SELECT {_WRITTEN_SQL} FROM dated UNION ALL SELECT {_WRITTEN_SQL} FROM dated WHERE event_type = 'cart'",
)
def k1_ensure_append(spark, sf_dir):
    """K1 + O3 + K2: create an empty catalog table, twice (the second is a no-op), then append two
    batches; read by name."""
    import uuid

    from clickweave.session import scratch_path
    from clickweave.sinks import tables

    df, path = _dated(spark, sf_dir), scratch_path(spark, "appended")
    name = f"appended_{uuid.uuid4().hex[:10]}"
    for _ in range(2):
        qualified = tables.ensure_table(spark, name, df, path)
    tables.append(df, path, name=name)
    tables.append(df.filter(F.col("event_type") == "cart"), path, name=name)
    return spark.table(qualified).select(*_WRITTEN)


def _two_files(spark, sf_dir):
    """Two folders, each with raw CSV files of the same layout: users by parity."""
    from clickweave.session import scratch_path
    from clickweave.sources.driver_events import write_raw_csv

    clicks, out = m.clicks(spark, sf_dir), []
    for parity in (0, 1):
        path = scratch_path(spark, "raw-csv")
        write_raw_csv(clicks.filter(F.coalesce(F.col("user_id"), F.lit(0)) % 2 == parity), path)
        out.append(path)
    return out


@query(
    "k3_quarantine",
    o.with_(o.CLICK)
    + f"""SELECT CAST(product_id AS INTEGER) AS product_id, CAST(price AS FLOAT) AS price,
       CAST(user_id AS INTEGER) AS user_id, {o.REASON} AS reject_reason
FROM click WHERE {o.REASON} IS NOT NULL""",
)
def k3_quarantine(spark, sf_dir):
    """K3: rejects of two ingested batches, read back after each batch was ingested twice."""
    from clickweave.plans.bronze import ingest
    from clickweave.session import scratch_path

    table, dlq = scratch_path(spark, "bronze"), scratch_path(spark, "quarantine")
    for source in _two_files(spark, sf_dir):
        for _ in range(2):
            ingest(spark, source, table, table_name=None, dlq_dir=dlq).release()
    return spark.read.parquet(dlq).select("product_id", "price", "user_id", "reject_reason")


@query(
    "s3_batches",
    o.with_(o.CLICK, o.CLEAN)
    + """SELECT coalesce(user_id, 0) % 2 AS parity, count(*) AS n_events, count(DISTINCT CAST(event_timestamp AS DATE)) AS n_days,
       CAST(1 AS BIGINT) AS sources_kept_apart FROM clean GROUP BY 1""",
)
def s3_batches(spark, sf_dir):
    """S3: files of two folders ingested by one job; each keeps its own batch (a batch holds users of
    one parity only), and ingesting all of them again changes nothing."""
    from clickweave.plans.bronze import ingest
    from clickweave.session import scratch_path

    table, sources = scratch_path(spark, "bronze"), _two_files(spark, sf_dir)
    for _ in range(2):
        ingest(spark, sources, table, table_name=None).release()
    parity = F.coalesce(F.col("user_id"), F.lit(0)).cast("bigint") % 2
    bronze = spark.read.parquet(table).withColumn("parity", parity)
    mixed = bronze.groupBy("batch", "batch_source").agg(F.min("parity").alias("lo"), F.max("parity").alias("hi"))
    apart = mixed.agg(F.max(F.col("hi") - F.col("lo"))).first()[0] == 0
    return bronze.groupBy("parity").agg(
        F.count(F.lit(1)).alias("n_events"), F.count_distinct("event_date").alias("n_days"), F.lit(int(apart)).cast("bigint").alias("sources_kept_apart")
    )


@query(
    "k4_upsert_table",
    o.with_(o.CLICK, o.STG, _TGT_SQL, _UPD_SQL)
    + """SELECT event_id, event_timestamp, event_type, product_id, price, user_id FROM tgt
WHERE NOT EXISTS (SELECT 1 FROM upd WHERE upd.event_id = tgt.event_id)
UNION ALL SELECT event_id, event_timestamp, event_type, product_id, price, user_id FROM upd""",
)
def k4_upsert_table(spark, sf_dir):
    """K4 on disk, partitioned by a nullable column: the second load holds every update twice and is
    merged twice."""
    from clickweave.session import scratch_path
    from clickweave.sinks import tables

    _, target, updates = _loads(spark, sf_dir)
    part = F.when(F.col("src_event_id") % 5 > 0, F.to_date("event_timestamp")).alias("part")
    cols = ["event_id", "event_timestamp", "event_type", "product_id", "price", "user_id", "src_event_id"]
    path = scratch_path(spark, "upserted")
    updates = updates.unionByName(updates)
    tables.upsert_table(spark, path, target.select(*cols, part), "event_id", ["part"])
    for _ in range(2):
        tables.upsert_table(spark, path, updates.select(*cols, part), "event_id", ["part"])
    return spark.read.parquet(path).select(*cols[:-1])


@query(
    "k9_rebuild",
    o.silver_chain(1800).replace("FROM click WHERE", "FROM click WHERE event_timestamp >= TIMESTAMP '2024-01-20' AND")
    + "SELECT event_id, computed_session_id, CAST(year(event_timestamp) AS INTEGER) AS event_year, CAST(month(event_timestamp) AS INTEGER) AS event_month FROM silver",
)
def k9_rebuild(spark, sf_dir):
    """K9: a full build over an earlier, larger one leaves nothing of it."""
    from clickweave.plans.layers import build_layers, paths
    from clickweave.session import scratch_path

    root, bronze = scratch_path(spark, "layers"), m.clicks(spark, sf_dir)
    build_layers(spark, bronze.withColumn("event_timestamp", F.expr("event_timestamp - INTERVAL 40 DAYS")), root)
    build_layers(spark, bronze.filter(F.col("event_timestamp") >= F.lit("2024-01-20").cast("timestamp_ntz")), root)
    return spark.read.parquet(paths(root)["silver"]).select("event_id", "computed_session_id", "event_year", "event_month")


@query("k7_clustered", o.gold(1800, o.FEATURE_STORE) + "SELECT is_purchased, data_partition, count(*) AS n_sessions, true AS clustered FROM features GROUP BY 1, 2")
def k7_clustered(spark, sf_dir):
    """K7: the written mart, by (is_purchased, data_partition); ``clustered``: within a file, sessions
    of one label precede those of the other."""
    from clickweave.plans.layers import build_layers, paths
    from clickweave.session import scratch_path

    root = scratch_path(spark, "layers")
    build_layers(spark, m.clicks(spark, sf_dir), root)
    mart = spark.read.parquet(paths(root)["mart_ml_features"]).withColumns(
        {"_file": F.col("_metadata.file_path"), "_row": F.col("_metadata.row_index")}
    )
    per_file = mart.groupBy("_file").agg(
        F.max(F.when(~F.col("is_purchased"), F.col("_row"))).alias("last_no"), F.min(F.when(F.col("is_purchased"), F.col("_row"))).alias("first_yes")
    )
    bad = per_file.filter(F.col("last_no") > F.col("first_yes")).count()
    return mart.groupBy("is_purchased", F.col("data_partition").cast("string").alias("data_partition")).agg(
        F.count(F.lit(1)).alias("n_sessions"), F.lit(bad == 0).alias("clustered")
    )


@query(
    "k5_session_start",
    o.gold(43200, o.FEATURE_STORE)
    + f"SELECT computed_session_id, session_start FROM features WHERE session_start > (SELECT max(session_start) FROM features WHERE session_start < TIMESTAMP '{_LOAD1_END}')",
)
def k5_session_start(spark, sf_dir):
    """K5 on the mart's own time column: sessions that start after the last one loaded."""
    from clickweave.operators.incremental import incremental_filter

    feats = m.features(spark, sf_dir, m.TIMEOUT_LONG).select("computed_session_id", "session_start")
    return incremental_filter(feats, feats.filter(F.col("session_start") < F.lit(_LOAD1_END).cast("timestamp_ntz")), "session_start")


@query(
    "e2_build_layers",
    o.gold(1800, o.FEATURE_STORE, o.FCT)
    + """SELECT (SELECT count(*) FROM fct) AS n_events, (SELECT count(DISTINCT event_id) FROM fct) AS n_event_ids,
       (SELECT count(*) FROM features) AS n_sessions, (SELECT count(*) FROM stg WHERE src_event_id % 50 = 0) AS repeated,
       CAST(0 AS BIGINT) AS unsessionizable, true AS tests_passed,
       (SELECT count(*) FROM fct WHERE event_type NOT IN ('view', 'cart', 'remove_from_cart', 'purchase')) AS foreign_types""",
)
def e2_build_layers(spark, sf_dir):
    """E2 on clicks with exact duplicates: one row per event id in the written tables, the repeated
    and left-out rows counted in the run log, all data tests passed but accepted_values of the events'
    type, which has exactly the rows of the foreign type that the driver's events hold."""
    from clickweave.plans.layers import build_layers, paths
    from clickweave.session import scratch_path
    from clickweave.sinks.tables import stage

    root = scratch_path(spark, "layers")
    tests = build_layers(spark, m.clicks(spark, sf_dir, with_duplicates=True), root)
    foreign = (F.col("check_name") == "accepted_values") & (F.col("table_name") == "fct_events") & (F.col("column_name") == "event_type")
    tests = stage(spark, tests.withColumn("foreign", foreign), "data-tests")  # a row a test
    passed = tests.filter("NOT passed AND NOT foreign").isEmpty()
    foreign_types = tests.filter("foreign").first()["n_violations"]
    p = paths(root)
    fct, mart = spark.read.parquet(p["fct_events"]), spark.read.parquet(p["mart_ml_features"])
    counts = fct.agg(F.count(F.lit(1)).alias("n_events"), F.count_distinct("event_id").alias("n_event_ids"))
    log = spark.read.parquet(p["run_log"]).select("repeated", "unsessionizable")  # one row
    out = counts.withColumn("n_sessions", F.lit(mart.count()).cast("bigint")).join(F.broadcast(log))
    return out.withColumns({"tests_passed": F.lit(passed), "foreign_types": F.lit(foreign_types).cast("bigint")})


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Session metrics at the 30-minute timeout."""
    return a1_session_metrics(spark, sf_dir)


__all__ = ["QUERIES", "ORACLE", "flagship"]


from clickweave.plans import catalog_mechanisms as _mechanisms  # noqa: E402,F401  (registers its queries)
