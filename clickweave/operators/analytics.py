"""Questions the fact table answers: event frequency (A11), conversion funnel (A12) and
time-series rollups (A13). All are single grouped aggregates (map-side combined)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def event_frequency(fct: DataFrame, by: tuple[str, ...] = ("event_date", "event_type", "category_l1")) -> DataFrame:
    """Events, distinct users and purchase revenue per ``by`` group."""
    return fct.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n_events"),
        F.count_distinct("user_id").alias("n_users"),
        F.sum(F.when(F.col("event_type") == "purchase", F.col("price"))).alias("revenue"),
    )


def session_funnel_stages(silver: DataFrame) -> DataFrame:
    """Per session, the first time of each funnel stage and the ordered stage reached (H5):
    view, then cart at or after the first view, then purchase at or after the first cart."""
    t = F.col("event_timestamp")
    first = lambda et: F.min(F.when(F.col("event_type") == et, t))
    s = silver.groupBy("user_id", "session_index").agg(
        F.min(t).alias("session_start"),
        first("view").alias("first_view"),
        first("cart").alias("first_cart"),
        first("purchase").alias("first_purchase"),
    )
    viewed = F.col("first_view").isNotNull()
    carted = viewed & (F.col("first_cart") >= F.col("first_view"))
    bought = carted & (F.col("first_purchase") >= F.col("first_cart"))
    return s.select(
        "user_id",
        "session_index",
        "session_start",
        "first_view",
        "first_cart",
        "first_purchase",
        viewed.alias("reached_view"),
        F.coalesce(carted, F.lit(False)).alias("reached_cart"),
        F.coalesce(bought, F.lit(False)).alias("reached_purchase"),
    )


def conversion_funnel(silver: DataFrame, by: tuple[str, ...] = ("session_date",)) -> DataFrame:
    """Ordered funnel view -> cart -> purchase per session-start date: sessions reaching each
    step, step conversion rates, and the unordered counts (any cart / any purchase)."""
    st = session_funnel_stages(silver).withColumn("session_date", F.to_date("session_start"))
    agg = st.groupBy(*by).agg(
        F.count(F.lit(1)).alias("sessions"),
        F.count_if("reached_view").alias("view_sessions"),
        F.count_if("reached_cart").alias("view_cart_sessions"),
        F.count_if("reached_purchase").alias("view_cart_purchase_sessions"),
        F.count_if(F.col("first_cart").isNotNull()).alias("any_cart_sessions"),
        F.count_if(F.col("first_purchase").isNotNull()).alias("any_purchase_sessions"),
    )
    rate = lambda a, b: F.col(a).cast("double") / F.nullif(F.col(b), F.lit(0))
    return agg.select(
        *by,
        "sessions",
        "view_sessions",
        "view_cart_sessions",
        "view_cart_purchase_sessions",
        "any_cart_sessions",
        "any_purchase_sessions",
        rate("view_cart_sessions", "view_sessions").alias("view_to_cart_rate"),
        rate("view_cart_purchase_sessions", "view_cart_sessions").alias("cart_to_purchase_rate"),
        rate("view_cart_purchase_sessions", "sessions").alias("session_conversion_rate"),
    )


def time_rollup(fct: DataFrame, ts_col: str = "event_timestamp") -> DataFrame:
    """Hour -> day -> month rollup of events, purchases and revenue, with subtotal rows per
    day and month and a grand total; ``grouping_level`` is Spark's ``grouping_id()`` (bit set =
    column rolled up). Events are first counted per hour; only those rows are expanded into the
    four levels."""
    bought = F.col("event_type") == "purchase"
    hours = fct.groupBy(F.to_date(ts_col).alias("event_date"), F.hour(ts_col).alias("event_hour")).agg(
        F.count(F.lit(1)).alias("_events"),
        F.count_if(bought).alias("_purchases"),
        F.sum(F.when(bought, F.col("price"))).alias("_revenue"),
    )
    hours = hours.withColumn("event_month", F.date_format("event_date", "yyyy-MM"))
    return hours.rollup("event_month", "event_date", "event_hour").agg(
        F.sum("_events").alias("n_events"),
        F.sum("_purchases").alias("n_purchases"),
        F.sum("_revenue").alias("revenue"),
        F.grouping_id().cast("int").alias("grouping_level"),
    )
