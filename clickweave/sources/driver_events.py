"""Adapter from the driver's generic ``events`` + ``part`` tables to the click schema.

The mapping is deterministic and written once more, as SQL, in ``plans.oracle`` so that the DuckDB
oracle and Spark see identical inputs. The join to ``part`` is a plain equi-join: Spark broadcasts
``part`` only while its scan statistics stay under ``spark.sql.autoBroadcastJoinThreshold`` (and AQE
re-plans from the measured shuffle size), otherwise it is a sort-merge join whose hot product ids
AQE's skew-join splits.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickweave.sources.tables import read_table

# Fixed values of the adapter (see FIXTURES.md): source event type -> click event type, and the
# residues that inject null prices, negative prices, null users, null source sessions, duplicates.
EVENT_TYPE_MAP = {"view": "view", "click": "cart", "signup": "remove_from_cart", "purchase": "purchase"}
NULL_PRICE_MOD = 89
NEGATIVE_PRICE_MOD = 97
NULL_USER_MOD = 83
NULL_SESSION_MOD = 71
DUPLICATE_MOD = 50
# Fixed input contract of the driver tables (the columns the adapter reads, with their types).
EVENTS_SCHEMA = "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, props STRING"
PART_SCHEMA = "p_partkey BIGINT, p_name STRING, p_brand STRING, p_type STRING"


def click_events(spark: SparkSession, sf_dir: str, *, with_duplicates: bool = False) -> DataFrame:
    """Driver ``events`` joined to ``part`` and mapped to the click schema (see FIXTURES.md)."""
    ev = read_table(spark, sf_dir, "events", EVENTS_SCHEMA)
    part = read_table(spark, sf_dir, "part", PART_SCHEMA)

    et = F.col("event_type")
    mapped_type = et
    for src, dst in EVENT_TYPE_MAP.items():
        if src != dst:
            mapped_type = F.when(et == src, F.lit(dst)).otherwise(mapped_type)

    k = F.get_json_object("props", "$.k").cast("int")
    ev = ev.withColumn("k", k)
    joined = ev.join(part, ev["k"] == part["p_partkey"], "left")  # an unknown product keeps its event

    eid = F.col("event_id")
    kind = F.col("k") % 10
    p_type = F.lower(F.col("p_type"))
    out = joined.select(
        eid.alias("src_event_id"),
        F.col("ts").alias("event_timestamp"),
        mapped_type.alias("event_type"),
        F.col("k").alias("product_id"),
        F.col("p_type").alias("category_id"),
        F.when(kind == 0, F.lit(None).cast("string"))
        .when(kind == 1, p_type)
        .otherwise(F.concat(p_type, F.lit("."), F.split_part(F.col("p_name"), F.lit(" "), F.lit(2))))
        .alias("category_code"),
        F.col("p_brand").alias("brand"),
        F.when(eid % NULL_PRICE_MOD == 0, F.lit(None).cast("double"))
        .when(eid % NEGATIVE_PRICE_MOD == 0, -F.col("value"))
        .otherwise(F.col("value"))
        .alias("price"),
        F.when(eid % NULL_USER_MOD == 0, F.lit(None).cast("bigint")).otherwise(F.col("user_id")).alias("user_id"),
        F.when(eid % NULL_SESSION_MOD == 0, F.lit(None).cast("string"))
        .otherwise(F.concat(F.col("user_id").cast("string"), F.lit("-"), F.date_format("ts", "yyyyMMdd")))
        .alias("user_session"),
    )
    if with_duplicates:
        out = out.unionByName(out.filter(F.col("src_event_id") % DUPLICATE_MOD == 0))
    return out


def write_raw_csv(clicks: DataFrame, path: str) -> None:
    """Render click events as the raw CSV layout (``event_time`` text with zone, header, gzip) —
    how the bronze ingest is exercised on data derived from the driver tables."""
    raw = clicks.select(
        F.concat(F.date_format("event_timestamp", "yyyy-MM-dd HH:mm:ss"), F.lit(" UTC")).alias("event_time"),
        "event_type",
        "product_id",
        "category_id",
        "category_code",
        "brand",
        "price",
        "user_id",
        "user_session",
    )
    raw.write.mode("overwrite").option("header", "true").option("compression", "gzip").csv(path)
