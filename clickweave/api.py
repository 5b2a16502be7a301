"""Drop-in function names for users coming from the reference's Python API.

Same names, arguments and return shapes; each delegates to the Spark-first operators of this
package (see the module noted on each). Differences are deliberate and documented in README
(D1 null-safe rejects, D9 UTC wall clock, Parquet instead of a table-format catalog).
"""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.sql import DataFrame, SparkSession

from clickweave.operators import ingest as _ingest
from clickweave.operators import metrics as _metrics
from clickweave.operators import ml as _ml
from clickweave.operators import sessions as _sessions
from clickweave.operators import star as _star
from clickweave.sinks import tables as _tables
from clickweave.sources import csv_events as _csv
from clickweave.sources.schema import FEATURE_COLUMNS, RAW_EVENT_SCHEMA

__all__ = [
    "RAW_EVENT_SCHEMA",
    "FEATURE_COLUMNS",
    "read_raw_stream",
    "split_clean_and_dlq",
    "enrich_and_repartition",
    "ensure_table_exists",
    "write_to_table",
    "write_to_dlq",
    "calculate_session_boundaries",
    "evaluate_session_match_rate",
    "build_dim_products",
    "build_dim_users",
    "build_fact_events",
    "build_fact_sessions",
    "build_session_features",
    "build_pipeline",
    "split_data",
    "evaluate",
    "extract_feature_importance",
    "write_metrics",
]


def read_raw_stream(spark: SparkSession, file_path: str) -> DataFrame:
    """CSV(.gz) with header, fixed schema, PERMISSIVE (``sources.csv_events``). Stage it with
    ``sources.csv_events.stage_raw`` before splitting if more than one action follows (M2)."""
    return _csv.read_raw_events(spark, file_path, with_batch=False)


def split_clean_and_dlq(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(clean, dlq)`` (``operators.ingest.split_rejects``; NULL price is clean, D1)."""
    return _ingest.split_rejects(df)


def enrich_and_repartition(df: DataFrame, num_partitions: int = 8) -> DataFrame:
    """Parse ``event_time`` to ``event_timestamp`` and rebalance."""
    return _ingest.rebalance(_ingest.parse_event_time(df), num_partitions)


def ensure_table_exists(spark: SparkSession, table_name: str, df: DataFrame, path: str) -> str:
    """Create the table (partitioned by ``event_date``) if absent; returns its qualified name (K1).
    ``df`` must carry ``event_date`` (``operators.star.with_event_date``)."""
    return _tables.ensure_table(spark, table_name, df, path, ("event_date",))


def write_to_table(df: DataFrame, path: str, table_name: str | None = None) -> None:
    """Append rows partitioned by ``event_date`` (K2)."""
    _tables.append(df, path, ("event_date",), name=table_name)


def write_to_dlq(df: DataFrame, dlq_dir: str, batch_tag: str) -> None:
    """Quarantine rows under ``dlq_dir/batch=<tag>`` as snappy Parquet (K3)."""
    _tables.write_rejects(df, dlq_dir, batch_tag)


def calculate_session_boundaries(df: DataFrame, timeout_seconds: int = 1800) -> DataFrame:
    """Sessionization (W1-W5, ``operators.sessions.sessionize``; skew-safe chunking)."""
    return _sessions.sessionize(df, timeout_seconds)


def evaluate_session_match_rate(df: DataFrame) -> float | None:
    """Share of source sessions mapping to exactly one computed session."""
    return _sessions.match_rate_value(df)


def build_dim_products(df: DataFrame) -> DataFrame:
    return _star.dim_products(df)


def build_dim_users(df: DataFrame) -> DataFrame:
    return _star.dim_users(df)


def build_fact_events(df: DataFrame) -> DataFrame:
    return _star.fact_events(df)


def build_fact_sessions(df: DataFrame) -> DataFrame:
    return _metrics.fact_sessions(_metrics.session_metrics(df))


def build_session_features(df: DataFrame) -> DataFrame:
    return _metrics.session_features(_metrics.session_metrics(df))


def build_pipeline() -> Pipeline:
    return _ml.build_gbt()


def split_data(df: DataFrame, val_ratio: float = 0.2, seed: int = 42) -> tuple[DataFrame, DataFrame]:
    return _ml.random_split(df, val_ratio, seed)


def evaluate(predictions_df: DataFrame) -> dict:
    """``{'roc_auc', 'pr_auc'}`` from a ``PipelineModel.transform`` output (probability column) or a
    frame with ``score``."""
    df = predictions_df
    if "score" not in df.columns:
        from pyspark.ml.functions import vector_to_array
        from pyspark.sql import functions as F

        df = df.withColumn("score", F.get(vector_to_array("probability"), 1))
    return _ml.evaluate(df)


def extract_feature_importance(model: PipelineModel, feature_cols: list[str]) -> list[tuple[str, float]]:
    return _ml.feature_importance(model, feature_cols)


def write_metrics(metrics: dict, feature_importance: list[tuple[str, float]], output_path: str) -> None:
    """The JSON report, written by Spark (works for any filesystem Spark can write)."""
    spark = SparkSession.getActiveSession()
    if spark is None:
        raise RuntimeError("write_metrics needs an active SparkSession")
    _ml.write_metrics(_ml.metrics_report(spark, metrics, feature_importance), output_path)
