"""Fixed schemas of the click-event model (S2) and the column lists used across layers."""

from __future__ import annotations

from pyspark.sql.types import (
    FloatType,
    IntegerType,
    StringType,
    StructField,
    StructType,
)

# Fixed values (must equal the reference): raw event layout, corrupt-record column name,
# accepted event types and the timestamp pattern of the raw files.
CORRUPT_COLUMN = "_corrupt_record"
RAW_EVENT_SCHEMA = StructType(
    [
        StructField("event_time", StringType(), nullable=False),
        StructField("event_type", StringType(), nullable=False),
        StructField("product_id", IntegerType(), nullable=False),
        StructField("category_id", StringType(), nullable=True),
        StructField("category_code", StringType(), nullable=True),
        StructField("brand", StringType(), nullable=True),
        StructField("price", FloatType(), nullable=True),
        StructField("user_id", IntegerType(), nullable=False),
        StructField("user_session", StringType(), nullable=True),
        StructField(CORRUPT_COLUMN, StringType(), nullable=True),
    ]
)
ACCEPTED_EVENT_TYPES = ("view", "cart", "remove_from_cart", "purchase")
RAW_TIME_PATTERN = "yyyy-MM-dd HH:mm:ss z"

# The nine model features, in the order the reference's model configuration lists them.
FEATURE_COLUMNS = (
    "session_duration_sec",
    "total_events",
    "view_count",
    "cart_count",
    "remove_count",
    "distinct_products",
    "distinct_categories",
    "avg_price_viewed",
    "max_price_viewed",
)
LABEL_COLUMN = "is_purchased"
