"""Quality checks, incremental algebra (C4), on-disk upsert, sinks and star-schema joins."""

import os

from pyspark.sql import functions as F

from clickweave.operators import quality as q
from clickweave.operators.incremental import evolve_union, high_water_mark, incremental_filter, latest_per_key, upsert
from clickweave.operators.sessions import sessionize
from clickweave.operators.staging import keep_first
from clickweave.operators.star import attach_sessions, fact_events
from clickweave.plans import medallion as m
from clickweave.sinks import tables

from testdata import SF_SMALL


def test_upsert_fixture_c4(spark):
    old = spark.createDataFrame([("a", 1), ("b", 2)], "k string, v int")
    new = spark.createDataFrame([("b", 3, "x"), ("c", 4, "y")], "k string, v int, extra string")
    once = upsert(old, new, "k")
    twice = upsert(once, new, "k")
    got = sorted((r.k, r.v, r.extra) for r in once.collect())
    assert got == [("a", 1, None), ("b", 3, "x"), ("c", 4, "y")]
    assert sorted(map(tuple, twice.collect())) == sorted(map(tuple, once.collect()))


def test_evolve_and_high_water(spark):
    a = spark.createDataFrame([(1,)], "x int")
    b = spark.createDataFrame([(2, "n")], "x int, y string")
    assert sorted(map(tuple, evolve_union(a, b).collect())) == [(1, None), (2, "n")]
    empty = spark.createDataFrame([], "event_timestamp timestamp_ntz")
    assert high_water_mark(empty).collect()[0][0] is None
    inc = spark.createDataFrame([(1,)], "x int").withColumn("event_timestamp", F.current_timestamp().cast("timestamp_ntz"))
    assert incremental_filter(inc, empty).count() == 1


def test_upsert_table_on_disk_is_idempotent(spark, tmp_dir):
    st = m.staged(spark, SF_SMALL).withColumn("event_date", F.to_date("event_timestamp"))
    path = os.path.join(tmp_dir, "fct")
    first = st.filter(F.col("event_date") < "2024-01-20")
    tables.replace_partitions(first, path, ["event_date"])
    upd = st.filter(F.col("event_date") >= "2024-01-15").withColumn("price", F.col("price") * 2)
    tables.upsert_table(spark, path, upd, "event_id", ["event_date"])
    tables.upsert_table(spark, path, upd, "event_id", ["event_date"])
    out = spark.read.parquet(path)
    assert out.count() == st.count()
    assert out.groupBy("event_id").count().filter("count > 1").count() == 0
    late = out.filter(F.col("event_date") >= "2024-01-15").join(st.select("event_id", F.col("price").alias("p0")), "event_id")
    assert late.filter(~F.col("price").eqNullSafe(F.col("p0") * 2)).count() == 0


def test_clustered_and_silver_layout(spark, tmp_dir):
    fct = m.fct(spark, SF_SMALL)
    p = os.path.join(tmp_dir, "clustered")
    tables.write_clustered(fct, p, ["event_date"], ["event_type"], num_partitions=4)
    assert spark.read.parquet(p).count() == fct.count()
    s = os.path.join(tmp_dir, "silver")
    tables.write_silver(m.silver(spark, SF_SMALL), s)
    back = spark.read.parquet(s)
    assert {"event_year", "event_month"} <= set(back.columns)
    assert back.filter("event_month = 1").count() == back.count()
    view = tables.materialize(fct, "view", name="fct_events_v")
    assert view.count() == fct.count()


def test_checks_pass_and_fail(spark):
    st = m.staged(spark, SF_SMALL)
    feats = m.features(spark, SF_SMALL)
    res = q.run_checks(
        [
            q.check_unique(st, "event_id", "stg"),
            q.check_not_null(st, ["event_id", "user_id"], "stg"),
            q.check_duration(feats, "features"),
            q.check_accepted_values(st, "event_type", "stg"),
        ]
    ).collect()
    by = {(r.check_name, r.column_name): r for r in res}
    assert by[("unique", "event_id")].passed and by[("not_null", "user_id")].passed
    assert not by[("accepted_values", "event_type")].passed  # 'error' events stay as violations
    dup = st.unionByName(st.limit(3))
    assert q.unique_violations(dup, "event_id").count() == 3
    child = spark.createDataFrame([("a",), ("z",), (None,)], "k string")
    parent = spark.createDataFrame([("a",)], "k string")
    assert [r.k for r in q.relationship_violations(child, parent, "k").collect()] == ["z"]


def test_keep_first_picks_smallest_order(spark):
    df = spark.createDataFrame([("k", 3, "c"), ("k", 1, "a"), ("j", 2, "b")], "key string, o int, v string")
    got = sorted(map(tuple, keep_first(df, ["key"], ["o"]).collect()))
    assert got == [("j", 2, "b"), ("k", 1, "a")]


def test_attach_sessions_equals_carried_column(spark):
    sv = m.silver(spark, SF_SMALL, with_sequence=False)
    joined = attach_sessions(m.staged(spark, SF_SMALL), sv).select("event_id", "computed_session_id")
    carried = fact_events(sv).select("event_id", "computed_session_id")
    assert joined.exceptAll(carried).count() == 0 and joined.count() == carried.count()


def test_check_table_single_scan_rules(spark):
    df = spark.createDataFrame(
        [("a", "view", 5.0, 10), (None, "error", -1.0, -30), ("c", None, None, -90)],
        "k string, event_type string, price double, session_duration_sec int",
    )
    out = {(r.check_name, r.column_name): r.n_violations for r in q.check_table(
        df, "t", not_null=["k", "event_type"], accepted_values={"event_type": ["view", "cart"]},
        non_negative=["price"], min_value={"session_duration_sec": -60},
    ).collect()}
    assert out == {
        ("not_null", "k"): 1, ("not_null", "event_type"): 1, ("accepted_values", "event_type"): 1,
        ("non_negative", "price"): 1, ("non_negative_duration", "session_duration_sec"): 1,
    }


def test_clustered_write_spreads_a_hot_key(spark, tmp_dir):
    """90 % of rows share one (event_date, event_type): the row-hash range tiebreaker spreads them
    over several range partitions (files) instead of one task."""
    import glob

    df = spark.range(20000).select(
        F.when(F.col("id") % 10 == 0, F.lit("2024-01-02")).otherwise(F.lit("2024-01-01")).cast("date").alias("event_date"),
        F.when(F.col("id") % 10 == 0, F.lit("cart")).otherwise(F.lit("view")).alias("event_type"),
        F.col("id").alias("event_id"),
    )
    path = os.path.join(tmp_dir, "hot")
    tables.write_clustered(df, path, ["event_date"], ["event_type"], num_partitions=8)
    hot_files = glob.glob(os.path.join(path, "event_date=2024-01-01", "*.parquet"))
    assert len(hot_files) >= 4
    assert spark.read.parquet(path).count() == 20000


def test_silver_write_spreads_a_month(spark, tmp_dir):
    rows = spark.range(4000).selectExpr("id AS src_event_id", "id % 7 AS user_id", "timestamp_ntz'2024-01-05 00:00:00' + make_interval(0, 0, 0, 0, 0, id) AS event_timestamp")
    path, merge = os.path.join(tmp_dir, "silver"), "spark.sql.adaptive.coalescePartitions.enabled"
    old = spark.conf.get(merge)
    try:
        spark.conf.set(merge, "false")  # what a large month's tasks are
        tables.write_silver(rows, path)
    finally:
        spark.conf.set(merge, old)
    back = spark.read.parquet(path)
    per_file = [r["count"] for r in back.groupBy(F.input_file_name()).count().collect()]
    assert len(per_file) > 1 and max(per_file) < 2000
    assert back.select("event_year", "event_month").distinct().collect() == [(2024, 1)]
    assert back.drop("event_year", "event_month").exceptAll(rows).isEmpty() and back.count() == 4000


def test_dealt_silver_is_written_without_a_second_shuffle(spark, tmp_dir):
    """The staged events move once, by user and chunk, and are written from there; a month is in several files."""
    rows = spark.range(4000).selectExpr(
        "id AS src_event_id", "id % 7 AS user_id", "timestamp_ntz'2024-01-05 00:00:00' + make_interval(0, 0, 0, 0, 0, id) AS event_timestamp"
    )
    path, keys = os.path.join(tmp_dir, "silver"), ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold")
    old = [spark.conf.get(k) for k in keys]
    try:
        spark.conf.set(keys[0], "false")
        spark.conf.set(keys[1], "-1")
        tables.write_silver(sessionize(rows, 1800), path, dealt=True)
    finally:
        for k, v in zip(keys, old, strict=True):
            spark.conf.set(k, v)
    back = spark.read.parquet(path)
    per_file = [r["count"] for r in back.groupBy(F.input_file_name()).count().collect()]
    assert len(per_file) > 1 and max(per_file) < 4000
    want = sessionize(rows, 1800)
    assert back.drop("event_year", "event_month").exceptAll(want).isEmpty() and back.count() == want.count() == 4000


def test_latest_per_key_counts_copies(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (1, "b"), (None, "c"), (None, None), (2, "d")], "k int, v string")
    got = latest_per_key(df, ["k"], copies="n").collect()
    assert {(r.k, r.v, r.n) for r in got} == {(1, "b", 3), (None, "c", 2), (2, "d", 1)}
    assert {(r.k, r.n) for r in latest_per_key(df.select("k"), ["k"], copies="n").collect()} == {(1, 3), (None, 2), (2, 1)}
