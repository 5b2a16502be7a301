"""Hand-computed cases for staging, star schema and analytics operators."""

import datetime as dt
import gzip
import hashlib
import os

from pyspark.sql import functions as F

from clickweave.operators.analytics import conversion_funnel, event_frequency, session_funnel_stages, time_rollup
from clickweave.operators.ingest import split_rejects
from clickweave.operators.metrics import session_metrics
from clickweave.operators.sessions import sessionize
from clickweave.operators.staging import stage_events
from clickweave.operators.star import dim_products, dim_users, fact_events
from clickweave.plans.bronze import bronze_frames, ingest

T0 = dt.datetime(2024, 3, 1, 10, 0, 0)
CLICK = (
    "src_event_id long, event_timestamp timestamp_ntz, event_type string, product_id int, category_id string, "
    "category_code string, brand string, price double, user_id long, user_session string"
)


def clicks(spark, rows):
    return spark.createDataFrame(rows, CLICK)


def ev(i, sec, et, user=1, product=1, code="a.b", price=1.0, session="s"):
    return (i, T0 + dt.timedelta(seconds=sec), et, product, "c", code, "B", price, user, session)


def test_staging_normalises_keys_and_filters(spark):
    rows = [
        (1, T0, " VIEW ", 1, "c", " Electronics.Phone ", " Apple ", 5.0, 7, "s"),
        (2, T0, "cart", 1, "c", None, None, -1.0, 7, "s"),  # negative price: dropped
        (3, T0, "cart", 1, "c", None, None, None, None, "s"),  # null user: dropped
        (4, T0, "cart", 1, "c", None, None, None, 8, "s"),  # null price: kept
    ]
    out = {r.src_event_id: r for r in stage_events(clicks(spark, rows)).collect()}
    assert sorted(out) == [1, 4]
    r = out[1]
    assert (r.event_type, r.category_code, r.brand) == ("view", "electronics.phone", "apple")
    text = "-".join(["7", T0.strftime("%Y-%m-%d %H:%M:%S"), "view", "1"])
    assert r.event_id == hashlib.md5(text.encode()).hexdigest()


def test_surrogate_key_null_token(spark):
    from clickweave.functions.columns import surrogate_key

    df = spark.createDataFrame([(None, "x")], "a string, b string")
    got = df.select(surrogate_key(["a", "b"]).alias("k")).collect()[0].k
    assert got == hashlib.md5(b"_null_-x").hexdigest()


def test_reject_split_is_null_safe(spark):
    rows = [ev(1, 0, "view", price=None), ev(2, 0, "view", price=-2.0), ev(3, 0, "view", user=None)]
    clean, rejects = split_rejects(clicks(spark, rows))
    assert [r.src_event_id for r in clean.collect()] == [1]
    assert sorted((r.src_event_id, r.reject_reason) for r in rejects.collect()) == [
        (2, "negative_price"), (3, "null_user_id")]


def test_funnel_order_matters(spark):
    rows = [
        # session 1: view -> cart -> purchase (full funnel)
        ev(1, 0, "view"), ev(2, 10, "cart"), ev(3, 20, "purchase"),
        # session 2 (user 2): cart before any view, then view, then purchase: reaches view only
        ev(4, 0, "cart", user=2), ev(5, 10, "view", user=2), ev(6, 20, "purchase", user=2),
        # session 3 (user 3): view only
        ev(7, 0, "view", user=3),
    ]
    sv = sessionize(clicks(spark, rows), 1800)
    st = {r.user_id: r for r in session_funnel_stages(sv).collect()}
    assert (st[1].reached_view, st[1].reached_cart, st[1].reached_purchase) == (True, True, True)
    assert (st[2].reached_view, st[2].reached_cart, st[2].reached_purchase) == (True, False, False)
    assert (st[3].reached_view, st[3].reached_cart) == (True, False)
    f = conversion_funnel(sv).collect()[0]
    assert (f.sessions, f.view_sessions, f.view_cart_sessions, f.view_cart_purchase_sessions) == (3, 3, 1, 1)
    assert (f.any_cart_sessions, f.any_purchase_sessions) == (2, 2)
    assert abs(f.view_to_cart_rate - 1 / 3) < 1e-6 and f.cart_to_purchase_rate == 1.0


def test_rollup_levels(spark):
    rows = [ev(1, 0, "view"), ev(2, 3600, "purchase", price=2.5), ev(3, 86400, "purchase", price=1.25)]
    fct = fact_events(sessionize(stage_events(clicks(spark, rows)), 1800))
    r = time_rollup(fct).collect()
    total = [x for x in r if x.grouping_level == 7][0]
    assert (total.n_events, total.n_purchases, total.revenue) == (3, 2, 3.75)
    assert len([x for x in r if x.grouping_level == 3]) == 1  # one month
    assert len([x for x in r if x.grouping_level == 1]) == 2  # two days
    assert len([x for x in r if x.grouping_level == 0]) == 3  # three (day, hour) cells
    freq = [(x.event_date.isoformat(), x.event_type, x.category_l1, x.n_events) for x in event_frequency(fct).collect()]
    assert sorted(f for f in freq if f[1] == "purchase") == [("2024-03-01", "purchase", "a", 1), ("2024-03-02", "purchase", "a", 1)]


def test_dims(spark):
    rows = [
        ev(1, 0, "view", product=5, code="x.old", price=1.0),
        ev(3, 50, "view", product=5, code="x.new", price=2.0),
        ev(2, 50, "view", product=5, code="x.tie-lower-id", price=3.0),  # same time, lower id: loses
        ev(4, 10, "view", user=2, product=6, code=None),
        ev(5, 5000, "view", user=2, product=6, code="y"),
    ]
    sv = sessionize(stage_events(clicks(spark, rows)), 1800)
    p = {r.product_id: r for r in dim_products(sv).collect()}
    assert (p[5].category_code, p[5].last_price, p[5].category_l1, p[5].category_l2, p[5].n_events) == (
        "x.new", 2.0, "x", "new", 3)
    assert (p[6].category_l1, p[6].category_l2) == ("y", None)
    u = {r.user_id: r for r in dim_users(sv).collect()}
    assert (u[1].total_sessions, u[2].total_sessions, u[2].total_events) == (1, 2, 2)


def test_metrics_hand_computed(spark):
    rows = [
        ev(1, 0, "view", product=1, code="a", price=10.0),
        ev(2, 30, "view", product=2, code="b", price=20.0),
        ev(3, 60, "cart", product=2, code="b", price=20.0),
        ev(4, 61, "purchase", product=2, code=None, price=None),
        ev(5, 5000, "remove_from_cart", product=3, code="c"),
    ]
    m = {r.computed_session_id: r for r in session_metrics(sessionize(clicks(spark, rows), 1800)).collect()}
    a, b = m["1_1"], m["1_2"]
    assert (a.total_events, a.view_count, a.cart_count, a.purchase_count, a.remove_count) == (4, 2, 1, 1, 0)
    assert (a.distinct_products, a.distinct_categories, a.session_duration_sec) == (2, 2, 61)
    assert (a.avg_price_viewed, a.max_price_viewed, a.is_purchased) == (15.0, 20.0, True)
    assert (b.total_events, b.avg_price_viewed, b.is_purchased, b.session_duration_sec) == (1, None, False, 0)


HEADER = "event_time,event_type,product_id,category_id,category_code,brand,price,user_id,user_session"


def _csv(path, lines):
    with gzip.open(path, "wt") as fh:
        fh.write("\n".join([HEADER, *lines]) + "\n")


def test_multi_file_ingest_and_append(spark, tmp_dir):
    a = os.path.join(tmp_dir, "events-2019-10.csv.gz")
    b = os.path.join(tmp_dir, "events-2019-11.csv.gz")
    _csv(a, ["2019-10-01 00:00:00 UTC,view,1,1,x,y,1.0,1,s", "2019-10-02 00:00:00 UTC,view,1,1,x,y,-1.0,1,s"])
    _csv(b, ["2019-11-01 00:00:00 UTC,cart,2,1,x,y,2.0,2,s"])
    res = bronze_frames(spark, [a, b])
    tags = sorted((r.batch, r.n) for r in res.clean.groupBy("batch").agg(F.count(F.lit(1)).alias("n")).collect())
    assert tags == [("events-2019-10_csv_gz", 1), ("events-2019-11_csv_gz", 1)]
    assert [r.batch for r in res.rejects.collect()] == ["events-2019-10_csv_gz"]
    table = os.path.join(tmp_dir, "t")
    ingest(spark, [a, b], table, table_name=None, replace_batches=False)
    ingest(spark, [a, b], table, table_name=None, replace_batches=False)
    assert spark.read.parquet(table).count() == 4  # plain append is not idempotent (K2)


def test_approx_distinct_option_close_to_exact(spark):
    from clickweave.plans import medallion as m

    from testdata import SF_SMALL

    sv = m.silver(spark, SF_SMALL, 43200, with_sequence=False)
    exact = {r.computed_session_id: r.distinct_products for r in session_metrics(sv).collect()}
    approx = {r.computed_session_id: r.distinct_products for r in session_metrics(sv, distinct=0.01).collect()}
    expand = {r.computed_session_id: r.distinct_products for r in session_metrics(sv, distinct="expand").collect()}
    assert expand == exact
    assert exact.keys() == approx.keys()
    assert sum(abs(exact[k] - approx[k]) for k in exact) <= 0.02 * sum(exact.values())
