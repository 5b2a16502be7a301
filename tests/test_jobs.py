"""Table jobs lose and repeat nothing: batches, upserts, rebuilds, retries, zones, late events."""

import gzip
import os
import time

import pytest
from pyspark.sql import functions as F

from clickweave.functions.columns import utc_instant
from clickweave.operators.incremental import upsert
from clickweave.operators.ingest import parse_event_time
from clickweave.plans import layers
from clickweave.plans import medallion as m
from clickweave.plans.bronze import ingest
from clickweave.plans.layers import build_layers, paths, recover, refresh_layers
from clickweave.sinks import tables

from testdata import SF_SMALL
from test_ingest import HEADER
from test_layers import _assert_same_layers


def _write(folder, rows, name="b1.csv.gz"):
    os.makedirs(folder, exist_ok=True)
    path = os.path.join(folder, name)
    with gzip.open(path, "wt") as f:
        f.write("\n".join([HEADER, *rows]) + "\n")
    return path


def _row(day, user, price="1.0"):
    return f"2019-10-{day:02d} 00:00:00 UTC,view,1,1,x,y,{price},{user},s{user}"


def _users(spark, table):
    return sorted(r.user_id for r in spark.read.parquet(table).collect())


def test_files_of_one_name_in_two_folders(spark, tmp_dir):
    table = os.path.join(tmp_dir, "bronze")
    for folder, users in (("a", (1, 2)), ("b", (3, 4))):
        path = _write(os.path.join(tmp_dir, folder), [_row(d, u) for d, u in zip((1, 2), users)])
        for _ in range(2):
            ingest(spark, path, table, table_name=None).release()
    assert _users(spark, table) == [1, 2, 3, 4]


def test_a_corrected_shorter_file_replaces_its_batch(spark, tmp_dir):
    table, dlq, folder = (os.path.join(tmp_dir, n) for n in ("bronze", "dlq", "in"))
    other = _write(folder, [_row(1, 9), _row(5, 8, "-1.0")], "other.csv.gz")
    ingest(spark, other, table, table_name=None, dlq_dir=dlq)
    path = _write(folder, [_row(1, 1), _row(2, 2), _row(3, 3), _row(3, 4, "-1.0")])
    ingest(spark, path, table, table_name=None, dlq_dir=dlq)
    assert (_users(spark, table), _users(spark, dlq)) == ([1, 2, 3, 9], [4, 8])
    _write(folder, [_row(2, 2)])
    ingest(spark, path, table, table_name=None, dlq_dir=dlq)
    assert (_users(spark, table), _users(spark, dlq)) == ([2, 9], [8])


def test_one_line_in_two_files_has_one_id(spark, tmp_dir):
    paths_ = [_write(os.path.join(tmp_dir, f), [_row(1, 1)], f"{f}.csv.gz") for f in "xy"]
    rows = ingest(spark, paths_, os.path.join(tmp_dir, "bronze"), table_name=None).clean.collect()
    assert len(rows) == 2 and len({r.src_event_id for r in rows}) == 1


def test_upsert_with_null_partitions_and_repeated_keys(spark, tmp_dir):
    path = os.path.join(tmp_dir, "t")
    schema = "id int, v int, part string"
    tables.upsert_table(spark, path, spark.createDataFrame([(1, 1, None), (2, 1, "2020-01-01"), (None, 1, "a")], schema), "id", ["part"])
    new = spark.createDataFrame([(3, 1, None), (3, 2, None), (None, 5, "a"), (None, 4, "a")], schema)
    for _ in range(2):
        tables.upsert_table(spark, path, new, "id", ["part"])
    got = sorted(((r.id, r.v) for r in spark.read.schema(schema).parquet(path).collect()), key=repr)
    assert got == sorted([(1, 1), (2, 1), (3, 2), (None, 5)], key=repr)
    one = upsert(new, new, "id").collect()
    assert sorted((r.v for r in one)) == [2, 5]


def test_swapped_partitions_disappear_when_empty(spark, tmp_dir):
    path = os.path.join(tmp_dir, "t")
    df = spark.createDataFrame([(1, "a b"), (2, None), (3, "c")], "id int, part string")
    df.write.partitionBy("part").parquet(path)
    tables.swap_partitions(df.filter("id = 9"), path, ["part"], df.filter("id < 3").select("part"))
    assert [r.id for r in spark.read.parquet(path).collect()] == [3]


def test_rebuild_leaves_nothing_of_a_larger_build(spark, tmp_dir):
    bronze, small = m.clicks(spark, SF_SMALL), os.path.join(tmp_dir, "small")
    few = bronze.filter(F.col("event_timestamp") >= F.lit("2024-01-20").cast("timestamp_ntz"))
    root = os.path.join(tmp_dir, "l")
    build_layers(spark, bronze.withColumn("event_timestamp", F.expr("event_timestamp - INTERVAL 40 DAYS")), root)
    build_layers(spark, few, root)
    build_layers(spark, few, small)
    _assert_same_layers(spark, root, small)


def _split(spark, cut="2024-01-18"):
    bronze = m.clicks(spark, SF_SMALL)
    before = F.col("event_timestamp") < F.lit(cut).cast("timestamp_ntz")
    withheld = before & (F.col("src_event_id") % 7 == 0)
    return bronze, bronze.filter(before & ~withheld), bronze.filter(~before | withheld)


@pytest.mark.parametrize("fail_at", [0, 1, 2, 4, 6])
def test_refresh_may_fail_anywhere_and_run_again(spark, tmp_dir, monkeypatch, fail_at):
    bronze, old, new = _split(spark)
    full, inc = os.path.join(tmp_dir, "full"), os.path.join(tmp_dir, "inc")
    build_layers(spark, bronze, full)
    build_layers(spark, old, inc)
    reads, inner = [], layers._Log.get

    def get(self, name):
        reads.append(name)
        if len(reads) > fail_at:
            raise RuntimeError("lost")
        return inner(self, name)

    monkeypatch.setattr(layers._Log, "get", get)
    with pytest.raises(RuntimeError):
        refresh_layers(spark, new, inc)
    monkeypatch.undo()
    refresh_layers(spark, new, inc)
    _assert_same_layers(spark, full, inc)
    assert recover(spark, inc) == 0


def test_refresh_that_fails_while_computing_changes_nothing(spark, tmp_dir, monkeypatch):
    bronze, old, new = _split(spark)
    full, inc = os.path.join(tmp_dir, "full"), os.path.join(tmp_dir, "inc")
    build_layers(spark, bronze, full)
    build_layers(spark, old, inc)
    monkeypatch.setattr(layers, "dim_products", lambda *a, **k: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        refresh_layers(spark, new, inc)
    monkeypatch.undo()
    refresh_layers(spark, new, inc)
    _assert_same_layers(spark, full, inc)


def test_a_batch_with_repeated_events_counts_them_once(spark, tmp_dir):
    bronze, old, new = _split(spark)
    full, inc = os.path.join(tmp_dir, "full"), os.path.join(tmp_dir, "inc")
    checks = build_layers(spark, bronze.unionByName(bronze), full).collect()
    assert all(r.passed for r in checks if r.check_name != "accepted_values")  # the data has another type
    build_layers(spark, old, inc)
    refresh_layers(spark, new.unionByName(new), inc)
    _assert_same_layers(spark, full, inc)
    log = {r.kind: r for r in spark.read.parquet(paths(inc)["run_log"]).collect()}
    assert log["refresh"].repeated * 2 == log["refresh"].rows_in


def test_build_stages_its_batch_once(spark, tmp_dir, monkeypatch):
    bronze, names, stage = m.clicks(spark, SF_SMALL, with_duplicates=True), [], tables.stage
    monkeypatch.setattr(tables, "stage", lambda spark, df, name: names.append(name) or stage(spark, df, name))
    events, counts = layers.staged_events(spark, bronze)
    rows = layers.stage_events(bronze)
    got, n, kept = counts.first(), rows.count(), rows.select("event_id").distinct().count()
    assert names == ["staged-events"]
    assert (got.rows_in, got.repeated) == (n, n - kept) and n > kept == events.count()
    assert events.columns == rows.columns and events.exceptAll(rows).isEmpty()
    layers.release(spark, events)
    assert not os.path.exists(events._scratch)
    assert tuple(layers.staged_events(spark, bronze.limit(0))[1].first()) == (0, 0, 0)


def test_rows_without_time_are_counted(spark, tmp_dir):
    bronze = m.clicks(spark, SF_SMALL).limit(200)
    gone = bronze.withColumn("event_timestamp", F.when(F.col("src_event_id") % 2 == 0, F.col("event_timestamp")))
    root = os.path.join(tmp_dir, "l")
    build_layers(spark, gone, root)
    log = spark.read.parquet(paths(root)["run_log"]).first()
    kept = spark.read.parquet(paths(root)["silver"]).count()
    assert log.unsessionizable > 0 and log.rows_in - log.repeated - log.unsessionizable == kept


def test_refresh_under_another_driver_zone(spark, tmp_dir, monkeypatch):
    schema = "src_event_id bigint, event_timestamp timestamp_ntz, event_type string, product_id int, category_id string, category_code string, brand string, price double, user_id bigint, user_session string"
    import datetime as dt

    row = lambda i, minute: (i, dt.datetime(2024, 3, 1, 0, minute), "view", 1, "c", "a.b", "x", 1.0, 5, "s")
    root = os.path.join(tmp_dir, "l")
    monkeypatch.setenv("TZ", "America/Los_Angeles")
    time.tzset()
    try:
        build_layers(spark, spark.createDataFrame([row(1, 0)], schema), root)
        refresh_layers(spark, spark.createDataFrame([row(2, 10), row(3, 20)], schema), root)
        got = spark.read.parquet(paths(root)["mart_ml_features"]).collect()
    finally:
        monkeypatch.undo()
        time.tzset()
    assert [(r.total_events, r.session_duration_sec) for r in got] == [(3, 1200)]


def test_hours_that_a_zone_repeats_stay_apart(spark):
    texts = ["2019-11-03 05:30:00 UTC", "2019-11-03 06:30:00 UTC", "2019-03-10 07:30:00 UTC", "1969-12-31 23:59:59 UTC", "no time"]
    df = spark.createDataFrame([(t,) for t in texts], "event_time string")
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        out = parse_event_time(df)
        got = [None if r.t is None else r.t for r in out.select(F.col("event_timestamp").cast("string").alias("t")).collect()]
        back = out.select((F.unix_micros(utc_instant("event_timestamp")) / 1_000_000).cast("bigint").alias("s")).collect()
        exact = spark.sql("SELECT TIMESTAMP_NTZ'2019-11-03 05:30:00.123457' AS t, TIMESTAMP_NTZ'1969-12-31 23:59:59.5' AS u")
        micros = exact.select(F.unix_micros(utc_instant("t")).alias("t"), F.unix_micros(utc_instant("u")).alias("u")).first()
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert got == [t.removesuffix(" UTC") for t in texts[:4]] + [None]
    assert [r.s for r in back] == [1572759000, 1572762600, 1552203000, -1, None]
    assert (micros.t, micros.u) == (1572759000123457, -500000)


def test_a_late_event_leaves_earlier_months_alone(spark, tmp_dir):
    import datetime as dt

    schema = "src_event_id bigint, event_timestamp timestamp_ntz, event_type string, product_id int, category_id string, category_code string, brand string, price double, user_id bigint, user_session string"
    rows = [(i, dt.datetime(2024, 1 + i % 6, 10, i % 24), "view", 1, "c", "a.b", "x", float(i), i % 3, "s") for i in range(120)]
    late = (999, dt.datetime(2024, 5, 9, 12), "purchase", 1, "c", "a.b", "x", 1.0, 1, "s")
    root, full = os.path.join(tmp_dir, "l"), os.path.join(tmp_dir, "full")
    build_layers(spark, spark.createDataFrame(rows, schema), root)
    build_layers(spark, spark.createDataFrame([*rows, late], schema), full)

    def files():
        return {os.path.join(d, f) for d, _, fs in os.walk(paths(root)["silver"]) for f in fs if f.endswith(".parquet")}

    before = files()
    assert refresh_layers(spark, spark.createDataFrame([late], schema), root).count() == 1
    gone = {f.split("event_month=")[1].split("/")[0] for f in before - files()}
    assert gone <= {"4", "5", "6"} and "5" in gone
    _assert_same_layers(spark, full, root)
