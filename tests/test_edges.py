"""Degenerate inputs: empty tables, one class only, constant features."""

import datetime as dt

from pyspark.sql import functions as F

from clickweave.operators import ml
from clickweave.operators import quality as q
from clickweave.operators.analytics import conversion_funnel, time_rollup
from clickweave.operators.incremental import upsert
from clickweave.operators.metrics import feature_store, session_metrics
from clickweave.operators.sessions import session_match_rate, sessionize
from clickweave.operators.star import dim_products, dim_users, fact_events

SCHEMA = (
    "src_event_id long, event_timestamp timestamp_ntz, event_type string, product_id int, category_id string, "
    "category_code string, brand string, price double, user_id long, user_session string, event_id string"
)


def test_empty_input_everywhere(spark):
    empty = spark.createDataFrame([], SCHEMA)
    sv = sessionize(empty, 1800)
    assert sv.count() == 0
    assert session_metrics(sv).count() == 0 and feature_store(session_metrics(sv)).count() == 0
    assert conversion_funnel(sv).count() == 0
    assert time_rollup(fact_events(sv)).count() == 0  # Spark emits no grand-total row for empty input
    assert dim_users(sv).count() == 0 and dim_products(sv).count() == 0
    assert session_match_rate(sv).collect()[0].match_rate is None
    assert upsert(empty, empty, "event_id").count() == 0
    res = q.check_table(empty, "t", not_null=["event_id"], non_negative=["price"]).collect()
    assert all(r.n_violations == 0 for r in res)


def test_auc_one_class_is_null(spark):
    df = spark.createDataFrame([(0.1, 1), (0.5, 1)], "s double, y int")
    r = ml.roc_auc_frame(df, "s", "y").collect()[0]
    assert (r.n_pos, r.n_neg, r.roc_auc) == (2, 0, None)
    assert ml.roc_auc_frame(spark.createDataFrame([], "s double, y int"), "s", "y").collect()[0].roc_auc is None


def test_drift_with_constant_feature_and_empty_period(spark):
    t = dt.datetime(2024, 1, 1)
    rows = [("train", 1.0, t), ("train", 1.0, t), ("oot", 1.0, t)]
    df = spark.createDataFrame(rows, "data_split string, x double, session_start timestamp_ntz")
    r = ml.drift_psi(df, feature_cols=["x"]).collect()[0]
    assert abs(r.psi) < 1e-9 and (r.n_base, r.n_cur) == (2, 1)
    only_train = df.filter("data_split = 'train'")
    assert [r.psi for r in ml.drift_psi(only_train, feature_cols=["x"]).collect()] == [None]
