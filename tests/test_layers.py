"""Full layer build, and incremental refresh equal to a full build."""

import os

from pyspark.sql import functions as F

from clickweave.plans import medallion as m
from clickweave.plans.layers import build_layers, paths, refresh_layers

from testdata import SF_SMALL

CUT = "2024-01-18"


def _rows(df, cols):
    """Averages are stored unrounded; additions in another order may differ in the last digits."""
    return sorted(tuple(round(v, 6) if isinstance(v, float) else v for v in r) for r in df.select(*cols).collect())


def test_refresh_equals_full_build(spark, tmp_dir):
    bronze = m.clicks(spark, SF_SMALL)
    full_root, inc_root = os.path.join(tmp_dir, "full"), os.path.join(tmp_dir, "inc")
    checks = {(r.check_name, r.column_name, r.table_name): r for r in build_layers(spark, bronze, full_root).collect()}
    assert checks[("unique", "event_id", "fct_events")].passed
    assert checks[("relationships", "computed_session_id", "fct_events")].passed
    ts = F.col("event_timestamp")
    build_layers(spark, bronze.filter(ts < F.lit(CUT).cast("timestamp_ntz")), inc_root)
    late = refresh_layers(spark, bronze.filter(ts >= F.lit(CUT).cast("timestamp_ntz")), inc_root)
    assert late.count() == 0
    pf, pi = paths(full_root), paths(inc_root)
    fcols = ["event_id", "computed_session_id", "event_date", "category_l1", "price"]
    assert _rows(spark.read.parquet(pf["fct_events"]), fcols) == _rows(spark.read.parquet(pi["fct_events"]), fcols)
    gcols = ["computed_session_id", "total_events", "session_duration_sec", "distinct_products", "is_purchased",
             "avg_price_viewed", "data_partition"]
    assert _rows(spark.read.parquet(pf["mart_ml_features"]), gcols) == _rows(spark.read.parquet(pi["mart_ml_features"]), gcols)
    ucols = ["user_id", "first_seen", "last_seen", "total_sessions", "total_events"]
    assert _rows(spark.read.parquet(pf["dim_users"]), ucols) == _rows(spark.read.parquet(pi["dim_users"]), ucols)
    pcols = ["product_id", "category_code", "brand", "last_price", "first_seen", "last_seen", "n_events", "category_l2"]
    assert _rows(spark.read.parquet(pf["dim_products"]), pcols) == _rows(spark.read.parquet(pi["dim_products"]), pcols)
    scols = ["user_id", "last_event_timestamp", "last_session_index", "last_session_events", "last_session_start"]
    assert _rows(spark.read.parquet(pf["session_state"]), scols) == _rows(spark.read.parquet(pi["session_state"]), scols)
    ev_cols = ["event_id", "session_index", "event_seq", "idle_seconds", "session_flag", "event_month"]
    assert _rows(spark.read.parquet(pf["silver"]), ev_cols) == _rows(spark.read.parquet(pi["silver"]), ev_cols)
    # re-applying the same batch changes nothing (its events are already in silver)
    late2 = refresh_layers(spark, bronze.filter(ts >= F.lit(CUT).cast("timestamp_ntz")), inc_root)
    assert late2.count() == 0
    assert spark.read.parquet(pi["silver"]).count() == spark.read.parquet(pf["silver"]).count()
    _assert_same_layers(spark, full_root, inc_root)


def _assert_same_layers(spark, a_root, b_root):
    pa, pb = paths(a_root), paths(b_root)
    spec = {
        "silver": ["event_id", "session_index", "computed_session_id", "event_seq", "idle_seconds", "session_flag", "event_month"],
        "fct_events": ["event_id", "computed_session_id", "event_date", "category_l1", "price"],
        "mart_ml_features": ["computed_session_id", "total_events", "session_duration_sec", "distinct_products",
                             "is_purchased", "avg_price_viewed", "data_partition"],
        "dim_users": ["user_id", "first_seen", "last_seen", "total_sessions", "total_events"],
        "dim_products": ["product_id", "category_code", "brand", "last_price", "first_seen", "last_seen", "n_events"],
        "session_state": ["user_id", "last_event_timestamp", "last_session_index", "last_session_events", "last_session_start"],
    }
    for table, cols in spec.items():
        assert _rows(spark.read.parquet(pa[table]), cols) == _rows(spark.read.parquet(pb[table]), cols), table


def test_refresh_with_late_events_equals_full_build(spark, tmp_dir):
    """Events withheld from the first load arrive late (older than their users' stored state) in
    the second batch: those users are recomputed, everything equals a full build; a re-delivery of
    the same batch is a no-op."""
    bronze = m.clicks(spark, SF_SMALL)
    full_root, inc_root = os.path.join(tmp_dir, "full2"), os.path.join(tmp_dir, "inc2")
    build_layers(spark, bronze, full_root)
    ts = F.col("event_timestamp")
    before = ts < F.lit(CUT).cast("timestamp_ntz")
    withheld = before & (F.col("src_event_id") % 7 == 0)
    build_layers(spark, bronze.filter(before & ~withheld), inc_root)
    batch = bronze.filter(~before | withheld)
    late = refresh_layers(spark, batch, inc_root)
    assert late.count() > 0
    _assert_same_layers(spark, full_root, inc_root)
    assert refresh_layers(spark, batch, inc_root).count() == 0
    _assert_same_layers(spark, full_root, inc_root)
