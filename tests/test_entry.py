"""Driver contract of __spark_entry__: flagship rows and schema, oracle keys, every query builds."""

import re

import __spark_entry__ as entry
from clickweave.plans import catalog

from testdata import SF_CHECK


def test_entry_flagship(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert df.columns[:2] == ["computed_session_id", "user_id"]
    assert entry.entry(spark).schema == df.schema


def test_oracle_keys_are_queries_and_names_are_clean():
    q, o = entry.queries(), entry.oracle_sql()
    assert set(o) <= set(q)
    assert len(o) >= 50
    for name in catalog.QUERIES:
        assert re.fullmatch(r"[a-z][a-z0-9]*_[a-z0-9_]+", name), name
    # the training-data queries, if installed, have names of their own
    assert all(n == "pipeline" or re.match(r"op\d+_", n) for n in set(q) - set(catalog.QUERIES))


def test_every_query_builds(spark):
    jobs = ("s1_", "s3_", "s4_", "p16_stream", "t1_running", "t1_late", "a13_distinct", "k1_", "k3_", "k4_upsert_table", "k4_upsert_files", "k7", "k9", "k10", "k11", "k12", "t2", "e2", "e3", "l1", "l2", "l5", "l8")
    lazy = [n for n in catalog.QUERIES if not n.startswith(jobs)]
    for name in lazy:
        df = entry.queries()[name](spark, SF_CHECK)
        assert df.columns, name


def test_results_do_not_depend_on_shuffle_partitions(spark):
    names = ["w5_event_sequence", "a1_session_metrics", "a8_dim_products", "l7_auc", "a12_funnel"]
    old = spark.conf.get("spark.sql.shuffle.partitions")
    out = {}
    try:
        for n_parts in ("3", "13"):
            spark.conf.set("spark.sql.shuffle.partitions", n_parts)
            out[n_parts] = {q: sorted(map(tuple, entry.queries()[q](spark, SF_CHECK).collect())) for q in names}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    for q in names:
        assert out["3"][q] == out["13"][q], q


def test_results_do_not_depend_on_session_time_zone(spark):
    names = ["w4_sessionize_30m", "p11_feature_store", "a13_rollup", "s1_csv_ingest", "t1_session_window"]
    old = spark.conf.get("spark.sql.session.timeZone")
    out = {}
    try:
        for tz in ("UTC", "America/New_York"):
            spark.conf.set("spark.sql.session.timeZone", tz)
            out[tz] = {q: sorted(map(str, entry.queries()[q](spark, SF_CHECK).collect())) for q in names}
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    for q in names:
        assert out["UTC"][q] == out["America/New_York"][q], q
