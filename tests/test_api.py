"""The reference-style function names run end to end on the hostile CSV and the driver tables."""

import gzip
import os

from pyspark.sql import functions as F

from clickweave import api
from clickweave.operators.ml import prepare as ml_prepare
from clickweave.plans import medallion as m
from clickweave.sources.csv_events import stage_raw

from testdata import SF_SMALL
from test_ingest import HEADER, ROWS


def test_ingest_names(spark, tmp_dir):
    path = os.path.join(tmp_dir, "x.csv.gz")
    with gzip.open(path, "wt") as fh:
        fh.write("\n".join([HEADER, *ROWS]) + "\n")
    raw = stage_raw(spark, api.read_raw_stream(spark, path))
    clean, dlq = api.split_clean_and_dlq(raw)
    assert (clean.count(), dlq.count()) == (4, 6)
    api.write_to_dlq(dlq, os.path.join(tmp_dir, "dlq"), "x_csv_gz")
    assert spark.read.parquet(os.path.join(tmp_dir, "dlq")).count() == 6
    prepared = api.enrich_and_repartition(clean.drop("event_timestamp").withColumnRenamed("event_time_text", "event_time"), 2)
    prepared = prepared.withColumn("event_date", F.to_date("event_timestamp"))
    table = os.path.join(tmp_dir, "bronze")
    name = api.ensure_table_exists(spark, "bronze_api", prepared, table)
    api.write_to_table(prepared, table, name)
    assert spark.table(name).count() == 4


def test_processing_and_ml_names(spark, tmp_dir):
    silver = api.calculate_session_boundaries(m.staged(spark, SF_SMALL))
    assert 0 < api.evaluate_session_match_rate(silver) <= 1
    assert api.build_dim_products(silver).count() > 0 and api.build_dim_users(silver).count() > 0
    assert api.build_fact_events(silver).count() == silver.count()
    assert api.build_fact_sessions(silver).count() == api.build_session_features(silver).count()
    feats = ml_prepare(m.features(spark, SF_SMALL))
    train, val = api.split_data(feats)
    model = api.build_pipeline().fit(train)
    metrics = api.evaluate(model.transform(val))
    imp = api.extract_feature_importance(model, list(api.FEATURE_COLUMNS))
    api.write_metrics(metrics, imp, os.path.join(tmp_dir, "m"))
    assert set(spark.read.json(os.path.join(tmp_dir, "m")).columns) >= {"roc_auc", "pr_auc", "feature_importance"}
