"""Model jobs: train on the training period, evaluate out of time.

``train`` splits its input, fits, measures on the held-out part and saves the model; ``evaluate``
loads a model, scores a later period and writes the report. Both return the report: one row with
ROC-AUC, PR-AUC and the ranked importances.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline
from pyspark.sql import DataFrame, SparkSession

from clickweave.operators import ml
from clickweave.operators.incremental import latest_per_key
from clickweave.operators.metrics import feature_store, session_metrics
from clickweave.operators.sessions import DEFAULT_TIMEOUT_SECONDS, sessionize
from clickweave.operators.staging import stage_events
from clickweave.plans.bronze import bronze_frames


def train(
    spark: SparkSession,
    features: DataFrame,
    model_dir: str,
    *,
    pipeline: Pipeline | None = None,
    val_ratio: float = ml.VAL_RATIO,
    seed: int = ml.SEED,
) -> DataFrame:
    """Fit on ``1 - val_ratio`` of ``features`` (the feature store, or its ``prepare``d form), save the
    model to ``model_dir`` and report on the rest."""
    rows = ml.prepare(features)
    fit_on, held_out = ml.hash_split(rows, val_ratio=val_ratio, seed=seed)
    model = ml.fit(pipeline or ml.build_gbt(seed=seed), fit_on)
    ml.save_model(model, model_dir)
    return ml.metrics_report(spark, ml.evaluate(ml.score(model, held_out)), ml.feature_importance(model))


def evaluate(spark: SparkSession, features: DataFrame, model_dir: str, report_dir: str | None = None) -> DataFrame:
    """Score ``features`` with the model in ``model_dir`` and report; with ``report_dir`` the report is
    written as JSON and returned as read back."""
    model = ml.load_model(model_dir)
    scored = ml.score(model, ml.prepare(features))
    report = ml.metrics_report(spark, ml.evaluate(scored), ml.feature_importance(model))
    if report_dir is None:
        return report
    ml.write_metrics(report, report_dir)
    return spark.read.schema(report.schema).json(report_dir)


def features_from_raw(spark: SparkSession, sources: str | Sequence[str], *, timeout_seconds: int = DEFAULT_TIMEOUT_SECONDS) -> DataFrame:
    """S4 for raw input: the feature store of CSV files, through the same steps as the tables (staged parse,
    reject split, one row per event, sessions, features). A test period can so be given to ``evaluate`` as
    it was delivered, without having been ingested."""
    events = latest_per_key(stage_events(bronze_frames(spark, sources).clean), ["event_id"])
    return feature_store(session_metrics(sessionize(events, timeout_seconds, with_sequence=False)))


def evaluate_raw(
    spark: SparkSession, sources: str | Sequence[str], model_dir: str, report_dir: str | None = None, *, timeout_seconds: int = DEFAULT_TIMEOUT_SECONDS
) -> DataFrame:
    """``evaluate`` on raw CSV files."""
    return evaluate(spark, features_from_raw(spark, sources, timeout_seconds=timeout_seconds), model_dir, report_dir)
