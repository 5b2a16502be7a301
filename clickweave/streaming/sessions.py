"""Structured Streaming sessions (T1) and scoring of closed sessions.

T1 uses ``session_window``: a session is a run of a user's events where each next event comes at
most ``gap`` after the previous one (microsecond precision; the batch sessionizer compares whole
seconds, so the two agree on whole-second data and may differ only in the sub-second band).
A running ``session_index`` would need unbounded per-user state, so the streaming key is
(user, session start). The watermark bounds late data and state: a session is emitted (append
mode) once the watermark passes its end, and events later than the watermark are dropped.

Distinct counts use ``size(collect_set(...))``: exact distinct aggregates are not supported on
streams, and a session's distinct products are few.
"""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from clickweave.functions.columns import epoch_seconds, utc_instant
from clickweave.operators.ml import prepare, score
from clickweave.sources.schema import FEATURE_COLUMNS, LABEL_COLUMN


def session_window_metrics(
    events: DataFrame,
    gap: str = "30 minutes",
    *,
    watermark: str | None = "2 hours",
    user_col: str = "user_id",
    ts_col: str = "event_timestamp",
) -> DataFrame:
    """A1's metrics per gap session, for a stream (or a static DataFrame, same plan)."""
    src = events.filter(F.col(user_col).isNotNull() & F.col(ts_col).isNotNull()).withColumn(
        "_event_time", utc_instant(ts_col)
    )
    if watermark and events.isStreaming:
        src = src.withWatermark("_event_time", watermark)
    is_view = F.col("event_type") == "view"
    count_type = lambda et: F.count_if(F.col("event_type") == et)
    agg = src.groupBy(F.col(user_col), F.session_window("_event_time", gap).alias("session")).agg(
        F.min(ts_col).alias("session_start"),
        F.max(ts_col).alias("session_end"),
        (F.max(epoch_seconds(ts_col)) - F.min(epoch_seconds(ts_col))).alias("session_duration_sec"),
        F.count(F.lit(1)).alias("total_events"),
        count_type("view").alias("view_count"),
        count_type("cart").alias("cart_count"),
        count_type("remove_from_cart").alias("remove_count"),
        count_type("purchase").alias("purchase_count"),
        F.size(F.collect_set("product_id")).cast("bigint").alias("distinct_products"),
        F.size(F.collect_set("category_code")).cast("bigint").alias("distinct_categories"),
        F.avg(F.when(is_view, F.col("price").cast("double"))).alias("avg_price_viewed"),
        F.max(F.when(is_view, F.col("price").cast("double"))).alias("max_price_viewed"),
    )
    return agg.select(
        F.concat(F.col(user_col).cast("string"), F.lit("@"), F.date_format("session_start", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"))
        .alias("stream_session_id"),
        F.col(user_col),
        "session_start",
        "session_end",
        "session_duration_sec",
        "total_events",
        "view_count",
        "cart_count",
        "remove_count",
        "purchase_count",
        "distinct_products",
        "distinct_categories",
        "avg_price_viewed",
        "max_price_viewed",
        (F.col("purchase_count") > 0).alias(LABEL_COLUMN),
    )


def score_sessions(sessions: DataFrame, model: PipelineModel) -> DataFrame:
    """Apply a fitted pipeline (L1) to session rows, stream or batch."""
    feats = prepare(sessions.select("stream_session_id", "user_id", "session_start", *FEATURE_COLUMNS, LABEL_COLUMN))
    return score(model, feats, keep=("stream_session_id", "user_id", "session_start"))


def start_scoring_stream(
    events: DataFrame,
    model: PipelineModel,
    sink_path: str,
    checkpoint_path: str,
    *,
    gap: str = "30 minutes",
    watermark: str = "2 hours",
    available_now: bool = False,
    processing_time: str | None = None,
) -> StreamingQuery:
    """T1 + T2 as a running query: closed sessions are scored and appended to a Parquet sink.
    The checkpoint (offsets + session state) must be on the shared folder so a restarted driver or
    lost executors resume exactly where they stopped."""
    scored = score_sessions(session_window_metrics(events, gap, watermark=watermark), model)
    writer = (
        scored.writeStream.format("parquet")
        .outputMode("append")
        .option("path", sink_path)
        .option("checkpointLocation", checkpoint_path)
    )
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif processing_time:
        writer = writer.trigger(processingTime=processing_time)
    return writer.start()
