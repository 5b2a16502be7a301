"""Star schema over silver events: FACT_EVENTS / ``fct_events`` (P9, P10, P15), DIM_USERS (A7),
DIM_PRODUCTS (A8), the session-id attach join (J1) and fact -> dimension lookups (J2).

Join strategy is left to Catalyst/AQE: a dimension is broadcast only while its statistics stay
under ``spark.sql.autoBroadcastJoinThreshold`` (AQE re-checks with measured sizes); otherwise a
sort-merge join, with AQE skew-join splitting hot keys of the fact side.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickweave.functions.columns import category_level

FACT_EVENT_COLUMNS = (
    "event_id",
    "event_timestamp",
    "event_date",
    "event_type",
    "product_id",
    "category_l1",
    "category_l2",
    "brand",
    "price",
    "user_id",
    "user_session",
    "computed_session_id",
)


def with_event_date(df: DataFrame, ts_col: str = "event_timestamp") -> DataFrame:
    """``event_date = DATE(event_timestamp)``."""
    return df.withColumn("event_date", F.to_date(ts_col))


def with_category_levels(df: DataFrame, code_col: str = "category_code") -> DataFrame:
    """P10: ``category_l1``, ``category_l2`` = first and second dot segment (NULL if absent)."""
    return df.withColumn("category_l1", category_level(code_col, 1)).withColumn(
        "category_l2", category_level(code_col, 2)
    )


def fact_events(silver: DataFrame, *, keep: tuple[str, ...] = ()) -> DataFrame:
    """``fct_events`` / FACT_EVENTS. The session id is carried from silver (no join)."""
    out = with_category_levels(with_event_date(silver))
    return out.select(*FACT_EVENT_COLUMNS, *keep)


def attach_sessions(staged: DataFrame, silver: DataFrame, key: str = "event_id") -> DataFrame:
    """Attach ``computed_session_id`` from silver to staged events by event key (left join).
    Prefer ``fact_events(silver)`` when silver already carries the event columns: it avoids
    shuffling both sides by event key."""
    return staged.join(silver.select(key, "computed_session_id"), key, "left")


def dim_users(silver: DataFrame) -> DataFrame:
    """DIM_USERS: first and last seen, number of sessions (the index is dense, so its max is
    the distinct count), number of events."""
    return silver.groupBy("user_id").agg(
        F.min("event_timestamp").alias("first_seen"),
        F.max("event_timestamp").alias("last_seen"),
        F.max("session_index").alias("total_sessions"),
        F.count(F.lit(1)).alias("total_events"),
    )


def dim_products(events: DataFrame, *, with_order_key: bool = False) -> DataFrame:
    """DIM_PRODUCTS: one row per product; attributes from its latest event by
    ``(event_timestamp, src_event_id)`` (D6), plus first/last seen and event count.
    ``with_order_key`` keeps the winning row's ``latest_order`` struct, which lets a refresh merge
    a new batch into the stored dimension without rereading history (``merge_dim_products``)."""
    order_cols = [c for c in ("event_timestamp", "src_event_id") if c in events.columns]
    latest = F.max_by(
        F.struct("category_code", "brand", F.col("price").alias("last_price"), F.struct(*order_cols).alias("order")),
        F.struct(*order_cols),
    )
    agg = events.groupBy("product_id").agg(
        latest.alias("_latest"),
        F.min("event_timestamp").alias("first_seen"),
        F.max("event_timestamp").alias("last_seen"),
        F.count(F.lit(1)).alias("n_events"),
    )
    out = agg.select(
        "product_id",
        F.col("_latest.category_code").alias("category_code"),
        F.col("_latest.brand").alias("brand"),
        F.col("_latest.last_price").alias("last_price"),
        "first_seen",
        "last_seen",
        "n_events",
        *([F.col("_latest.order").alias("latest_order")] if with_order_key else []),
    )
    return with_category_levels(out)


def merge_dim_users(old: DataFrame, batch: DataFrame) -> DataFrame:
    """Fold a batch's DIM_USERS rows into the stored ones (all four columns are algebraic)."""
    o, n = old.alias("o"), batch.alias("n")
    return o.join(n, "user_id", "full_outer").select(
        "user_id",
        F.least("o.first_seen", "n.first_seen").alias("first_seen"),
        F.greatest("o.last_seen", "n.last_seen").alias("last_seen"),
        F.greatest("o.total_sessions", "n.total_sessions").alias("total_sessions"),
        (F.coalesce("o.total_events", F.lit(0)) + F.coalesce("n.total_events", F.lit(0))).alias("total_events"),
    )


def merge_dim_products(old: DataFrame, batch: DataFrame) -> DataFrame:
    """Fold a batch's DIM_PRODUCTS rows (``with_order_key=True``) into the stored ones: the row
    with the later ``latest_order`` supplies the attributes; times and counts combine."""
    o, n = old.alias("o"), batch.alias("n")
    take_new = F.col("o.latest_order").isNull() | (F.col("n.latest_order") > F.col("o.latest_order"))
    pick = lambda c: F.when(take_new, F.col(f"n.{c}")).otherwise(F.col(f"o.{c}")).alias(c)
    out = o.join(n, "product_id", "full_outer").select(
        "product_id",
        pick("category_code"),
        pick("brand"),
        pick("last_price"),
        F.least("o.first_seen", "n.first_seen").alias("first_seen"),
        F.greatest("o.last_seen", "n.last_seen").alias("last_seen"),
        (F.coalesce("o.n_events", F.lit(0)) + F.coalesce("n.n_events", F.lit(0))).alias("n_events"),
        pick("latest_order"),
    )
    return with_category_levels(out)


def fact_with_dimensions(fct: DataFrame, products: DataFrame, users: DataFrame) -> DataFrame:
    """Resolve fact foreign keys to dimension attributes (left joins)."""
    p = products.select("product_id", F.col("category_l1").alias("dim_category_l1"), F.col("brand").alias("dim_brand"))
    u = users.select("user_id", F.col("total_sessions").alias("user_total_sessions"), F.col("first_seen").alias("user_first_seen"))
    return fct.join(p, "product_id", "left").join(u, "user_id", "left")
