"""Staging (``stg_raw_events``): normalise (P5), cast (P6), surrogate key (P7), filter (P8) and
deduplication (P16, W6).

Deduplication is written as aggregation, not as a window: ``dropDuplicates`` and the keyed
keep-first (``min_by`` of a row struct) both combine map-side, so a key repeated in a third of the
input still shuffles one row per map task, where ``row_number() over (partition by key)`` would
send every copy to one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickweave.functions.columns import normalized, surrogate_key

# Key columns of the surrogate key as specified (user, event time, event type).
SURROGATE_KEY_COLUMNS = ("user_id", "event_timestamp", "event_type")

STAGED_COLUMNS = (
    "event_id",
    "event_timestamp",
    "event_type",
    "product_id",
    "category_id",
    "category_code",
    "brand",
    "price",
    "user_id",
    "user_session",
    "src_event_id",
)


def stage_events(
    bronze: DataFrame,
    *,
    extra_key_cols: Sequence[str] = ("src_event_id",),
    drop_rejects: bool = True,
) -> DataFrame:
    """``stg_raw_events``: lower/trim of event_type, brand and category_code; product_id to int,
    user_id to bigint, price to double, time to ``timestamp_ntz``; ``event_id`` = md5 surrogate key
    over user, time (whole seconds) and type plus ``extra_key_cols`` (D4: without a source id two
    same-type events of a user in one second collide, R5); rows with NULL user or negative price
    removed (null-safe)."""
    extra = [c for c in extra_key_cols if c in bronze.columns]
    typed = {
        "event_timestamp": F.col("event_timestamp").cast("timestamp_ntz"),
        "event_type": normalized("event_type"),
        "product_id": F.col("product_id").cast("int"),
        "category_id": F.col("category_id").cast("string"),
        "category_code": normalized("category_code"),
        "brand": normalized("brand"),
        "price": F.col("price").cast("double"),
        "user_id": F.col("user_id").cast("bigint"),
        "user_session": F.col("user_session").cast("string"),
    }
    for c in extra:
        typed[c] = F.col(c)
    key_parts = [
        F.date_format(typed[c], "yyyy-MM-dd HH:mm:ss") if c == "event_timestamp" else typed[c]
        for c in (*SURROGATE_KEY_COLUMNS, *extra)
    ]
    typed["event_id"] = surrogate_key(key_parts)
    out = bronze
    if drop_rejects:
        out = out.filter(F.col("user_id").isNotNull() & ~F.coalesce(F.col("price") < 0, F.lit(False)))
    return out.select(*[typed[c].alias(c) for c in STAGED_COLUMNS if c in typed])


def drop_exact_duplicates(df: DataFrame, subset: Sequence[str] | None = None) -> DataFrame:
    """Remove exact duplicate events (all columns, or ``subset``)."""
    return df.dropDuplicates(list(subset)) if subset else df.dropDuplicates()


def keep_first(df: DataFrame, key: Sequence[str], order_by: Sequence[str]) -> DataFrame:
    """One row per ``key``: the one with the smallest ``order_by`` tuple. Written as a grouped
    ``min_by`` so copies of a hot key are combined before the shuffle."""
    key = list(key)
    rest = [c for c in df.columns if c not in key]
    order = F.struct(*[F.col(c) for c in order_by])
    picked = df.groupBy(*key).agg(F.min_by(F.struct(*[F.col(c) for c in rest]), order).alias("_row"))
    return picked.select(*key, *[F.col(f"_row.{c}").alias(c) for c in rest]).select(*df.columns)
