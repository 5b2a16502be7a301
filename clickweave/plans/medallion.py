"""End-to-end compositions over the driver tables: click events -> clean (bronze rules) ->
silver sessions -> gold session metrics. Every function returns a lazy DataFrame; nothing is
collected."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from clickweave.operators.ingest import split_rejects
from clickweave.operators.metrics import session_metrics
from clickweave.operators.metrics import feature_store
from clickweave.operators.sessions import sessionize
from clickweave.operators.staging import stage_events
from clickweave.operators.star import fact_events
from clickweave.sources.driver_events import click_events

TIMEOUT_SHORT = 1800
TIMEOUT_LONG = 43200
OOT_CUTOFF = "2024-01-24"


def clicks(spark: SparkSession, sf_dir: str, *, with_duplicates: bool = False) -> DataFrame:
    return click_events(spark, sf_dir, with_duplicates=with_duplicates)


def clean_clicks(spark: SparkSession, sf_dir: str) -> DataFrame:
    clean, _ = split_rejects(clicks(spark, sf_dir))
    return clean


def rejected_clicks(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, rejects = split_rejects(clicks(spark, sf_dir))
    return rejects


def staged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``stg_raw_events`` over the adapted click events (rejects removed, key added)."""
    return stage_events(clicks(spark, sf_dir))


def silver(spark: SparkSession, sf_dir: str, timeout: int = TIMEOUT_SHORT, **kw) -> DataFrame:
    return sessionize(staged(spark, sf_dir), timeout, **kw)


def fct(spark: SparkSession, sf_dir: str, timeout: int = TIMEOUT_SHORT) -> DataFrame:
    return fact_events(silver(spark, sf_dir, timeout, with_sequence=False))


def metrics(spark: SparkSession, sf_dir: str, timeout: int = TIMEOUT_SHORT) -> DataFrame:
    return session_metrics(silver(spark, sf_dir, timeout, with_sequence=False))


def features(spark: SparkSession, sf_dir: str, timeout: int = TIMEOUT_SHORT) -> DataFrame:
    """``mart_ml_features``."""
    return feature_store(metrics(spark, sf_dir, timeout))


def silver_table(spark: SparkSession, sf_dir: str, timeout: int = TIMEOUT_SHORT) -> DataFrame:
    """Silver sessionized once and written to the shared scratch folder, read back as a table —
    the lineage cut a job makes before deriving several gold tables from the same silver."""
    from clickweave.sinks.tables import stage

    return stage(spark, silver(spark, sf_dir, timeout, with_sequence=False), "silver")
