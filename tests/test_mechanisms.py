"""Stateful sessions, incremental ingest, streaming dedup, sketches and drift."""

import math
import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from clickweave.operators import drift, sketches
from clickweave.operators.sessions import sessionize_by_user
from clickweave.streaming import dedup, stateful

SCHEMA = "user_id bigint, event_timestamp timestamp_ntz, src_event_id bigint, event_type string"


def _events(spark, rows):
    at = lambda s: F.timestamp_seconds(F.lit(1_700_000_000) + F.col(s)).cast("timestamp_ntz")
    df = spark.createDataFrame(rows, "user_id bigint, sec bigint, src_event_id bigint, event_type string")
    return df.select("user_id", at("sec").alias("event_timestamp"), "src_event_id", "event_type")


def _write(df, path, k):
    df.coalesce(1).write.mode("append").parquet(path)
    return path


def _run(spark, tmp_dir, loads, **parameters):
    """Events of each load through the stateful sessionizer, restarted after every load."""
    own = spark.newSession()
    own.conf.set(*stateful.STORE)
    src, sink, late, ckpt = (os.path.join(tmp_dir, n) for n in ("src", "sink", "late", "ckpt"))
    n = 0
    for k, load in enumerate(loads):
        _write(load, src, k)
        n += load.where("user_id IS NOT NULL AND event_timestamp IS NOT NULL").count()
        stream = own.readStream.schema(load.schema).parquet(src)
        run = stateful.start_running_sessions(stream, sink, late, ckpt, idle_seconds=1, **parameters)
        stateful.run_out(run, own, [sink, late], n, wait_seconds=120)
    return spark.read.parquet(sink).drop("batch_id"), spark.read.parquet(late).drop("batch_id")


def test_running_sessions_continue_over_restarts(spark, tmp_dir):
    """Disorder inside a load, equal times, a user seen once, a session that goes on in the next load."""
    rng = np.random.default_rng(4)
    rows = [(int(u), int(s), i, "view") for i, (u, s) in enumerate(zip(rng.integers(0, 4, 120), rng.integers(0, 30_000, 120), strict=True))]
    rows += [(0, rows[0][1], 500, "cart"), (9, 15_000, 501, "view"), (None, 5, 502, "view")]
    halves = [[r for r in rows if (r[1] < 15_000) == first] for first in (True, False)]
    got, late = _run(spark, tmp_dir, [_events(spark, h) for h in halves])
    want = sessionize_by_user(_events(spark, rows)).select(*got.columns)
    assert got.count() == len(rows) - 1 and late.count() == 0
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()


def test_late_events_are_kept_apart(spark, tmp_dir):
    first = [(1, 1000, 1, "view"), (1, 1100, 2, "view"), (2, 50, 3, "view")]
    second = [(1, 1100, 1, "cart"), (1, 1100, 9, "cart"), (1, 400, 4, "cart"), (2, 60, 5, "view"), (3, 7, 6, "view")]
    got, late = _run(spark, tmp_dir, [_events(spark, first), _events(spark, second)], lateness_seconds=0)
    assert sorted(r["src_event_id"] for r in late.collect()) == [1, 4]  # not after what was given out
    assert {(r["user_id"], r["src_event_id"]): (r["session_index"], r["event_seq"]) for r in got.collect()} == {
        (1, 1): (1, 1), (1, 2): (1, 2), (1, 9): (1, 3), (2, 3): (1, 1), (2, 5): (1, 2), (3, 6): (1, 1),
    }


def test_dedup_state_is_bounded(spark, tmp_dir):
    """Repetitions go, also after a restart; keys behind the horizon leave the state."""
    src, sink, ckpt = (os.path.join(tmp_dir, n) for n in ("src", "sink", "ckpt"))
    state = []
    for k in range(5):
        rows = [(u, 3600 * k + u, 1000 * k + u, "view") for u in range(100)]
        again = [(u, 3600 * (k - 1) + u, 1000 * (k - 1) + u, "view") for u in range(90, 100)] if k else []
        _write(_events(spark, rows + rows[:7] + again), src, k)
        stream = spark.readStream.schema(SCHEMA).parquet(src)
        run = dedup.start_dedup(stream, ["src_event_id"], sink, ckpt, horizon="70 minutes")
        run.awaitTermination()
        state.append(run.lastProgress.stateOperators[0].numRowsTotal)
    got = [r[0] for r in spark.read.parquet(sink).select("src_event_id").collect()]
    assert sorted(got) == [1000 * k + u for k in range(5) for u in range(100)]
    assert max(state) <= 300


def test_ingest_takes_new_files_once(spark, tmp_dir):
    from clickweave.plans.bronze import bronze_frames
    from clickweave.streaming.ingest import start_ingest

    folder, table, dlq, ckpt = (os.path.join(tmp_dir, n) for n in ("raw", "table", "dlq", "ckpt"))
    head = "event_time,event_type,product_id,category_id,category_code,brand,price,user_id,user_session\n"
    line = "2024-01-0{d} 10:00:00 UTC,view,{i},c,a.b,x,{p},{u},s\n"
    for d in (1, 2, 3):
        os.makedirs(f"{folder}/day{d}")
        with open(f"{folder}/day{d}/events.csv", "w") as f:  # one name in each folder
            f.write(head + line.format(d=d, i=1, p=2.5, u=7) + line.format(d=d, i=2, p=-1, u=7) + line.format(d=d, i="x", p=1, u=8))
        run = start_ingest(spark, folder, table, ckpt, dlq_dir=dlq)
        run.awaitTermination()
        assert run.lastProgress.numInputRows == 3
    start_ingest(spark, folder, table, os.path.join(tmp_dir, "fresh"), dlq_dir=dlq, max_files=1).awaitTermination()
    once = bronze_frames(spark, [f"{folder}/day{d}" for d in (1, 2, 3)])
    cols = ["event_timestamp", "product_id", "price", "batch", "batch_source"]
    assert sorted(map(tuple, spark.read.parquet(table).select(*cols).collect())) == sorted(map(tuple, once.clean.select(*cols).collect()))
    assert spark.read.parquet(dlq).groupBy("reject_reason").count().count() == once.rejects.groupBy("reject_reason").count().count()
    assert spark.read.parquet(dlq).count() == once.rejects.count() == 6
    once.release()


def test_distinct_sketches_merge(spark):
    at = "timestamp_seconds(1700000000 + id % 200000)"
    fct = spark.range(60_000).selectExpr(f"cast({at} AS timestamp_ntz) AS event_timestamp", "id % 7001 AS user_id", "id % 11 AS product_id")
    hours = sketches.hourly_distinct(fct, ("user_id", "product_id"))
    got = sketches.merged_distinct(hours, {"all": F.lit(1)}, ("user_id", "product_id")).first()
    assert got["n_events"] == 60_000 and got["n_product_id"] == 11
    assert abs(got["n_user_id"] / 7001 - 1) < 4 * sketches.hll_error()
    assert sketches.hourly_distinct(fct.limit(0)).count() == 0


def _features(spark, n=4000, seed=0):
    rng = np.random.default_rng(seed)
    a, b = rng.normal(size=n), rng.integers(0, 5, n).astype(float)
    split = np.where(np.arange(n) % 3 == 0, "oot", "train")
    a = np.where(split == "oot", a + 0.4, a)
    hit = rng.random(n) < np.where(split == "oot", 0.5, 0.2)
    rows = [(str(s), None if i % 50 == 0 else float(x), float(y), bool(h)) for i, (s, x, y, h) in enumerate(zip(split, a, b, hit, strict=True))]
    return spark.createDataFrame(rows, "data_split string, a double, b double, is_purchased boolean"), rows


def test_ks_distance_by_brute_force(spark):
    df, rows = _features(spark)
    got = {r["feature"]: r for r in drift.ks_distance(df, feature_cols=["a", "b"]).collect()}
    for i, name in ((1, "a"), (2, "b")):
        x, y = (np.sort([r[i] for r in rows if r[0] == s and r[i] is not None]) for s in ("train", "oot"))
        grid = np.concatenate([x, y])
        want = np.abs(np.searchsorted(x, grid, "right") / len(x) - np.searchsorted(y, grid, "right") / len(y)).max()
        assert math.isclose(got[name]["ks"], want, rel_tol=1e-12) and (got[name]["n_base"], got[name]["n_cur"]) == (len(x), len(y))
    assert got["a"]["drifted"] and not got["b"]["drifted"]


def test_label_rates_find_concept_drift(spark):
    df, rows = _features(spark)
    rates = drift.label_rates(df, feature_cols=["a", "b"], bins=5)
    b = {r["bin"]: r for r in rates.where("feature = 'b'").collect()}
    for k in range(5):
        x, y = ([r[3] for r in rows if r[0] == s and r[2] == k] for s in ("train", "oot"))
        assert math.isclose(b[k]["rate_base"], np.mean(x)) and math.isclose(b[k]["shift"], np.mean(y) - np.mean(x))
        assert b[k]["z"] > 3
    assert rates.where("feature = 'a' AND bin = -1").count() == 1
    got = {r["feature"]: r for r in drift.concept_drift(rates).collect()}
    assert 0.2 < got["b"]["rate_shift"] < 0.4 and got["b"]["n_bins"] == 5
    assert drift.concept_drift(drift.label_rates(df.limit(0), feature_cols=["a"])).count() == 0


def test_psi_from_sketches_is_near_the_exact_one(spark):
    df, rows = _features(spark, 9000)
    kept = sketches.quantile_sketches(df, ["data_split"], ["a", "b"])  # stored once a period
    base, cur = (sketches.merged_quantiles(kept.where(F.col("data_split") == s)) for s in ("train", "oot"))
    got = {r["feature"]: r for r in sketches.sketched_psi(base, cur).collect()}
    x, y = (np.array([r[1] for r in rows if r[0] == s and r[1] is not None]) for s in ("train", "oot"))
    edges = np.quantile(x, np.arange(1, 10) / 10)
    p, q = (np.diff(np.concatenate([[0], np.searchsorted(np.sort(v), edges, "right") / len(v), [1]])) for v in (x, y))
    want = ((q - p) * np.log((q + 1e-6) / (p + 1e-6))).sum()
    assert got["a"]["psi"] == pytest.approx(want, abs=0.05) and got["b"]["psi"] < 0.02
    assert got["a"]["n_base"] == len(x)


def test_prefix_sums_over_a_hot_key(spark):
    df = spark.range(20_000).selectExpr("IF(id % 10 = 0, id % 3, 7) AS k", "id AS o", "id % 5 AS v")
    got = drift.prefix_sums(df, ["k"], ["o"], {"run": "v"})
    assert got.columns == ["k", "o", "v", "run"]
    from pyspark.sql import Window

    w = Window.partitionBy("k").orderBy("o").rowsBetween(Window.unboundedPreceding, 0)
    assert got.exceptAll(df.withColumn("run", F.sum("v").over(w))).isEmpty() and got.count() == 20_000


def test_write_checks_equal_a_scan(spark, tmp_dir):
    """Each row is counted once, also behind the range exchange of a clustered write."""
    from clickweave.operators import quality as q
    from clickweave.sinks.tables import write_clustered

    df = spark.range(5000).selectExpr("id AS event_id", "IF(id % 7 = 0, NULL, id) AS user_id", "IF(id % 5 = 0, 'x', 'view') AS event_type", "id % 3 AS d", "id - 40 AS price")
    rules = {"not_null": ("event_id", "user_id"), "accepted_values": {"event_type": ("view",)}, "non_negative": ("price",), "min_value": {"d": 1}}
    checks = q.WriteChecks("t", **rules)
    path = os.path.join(tmp_dir, "t")
    write_clustered(df, path, ["d"], ["event_type"], num_partitions=4, checks=checks)
    want = q.check_table(spark.read.parquet(path), "t", **rules)
    assert sorted(map(tuple, checks.summary().collect())) == sorted(map(tuple, want.collect()))
    assert checks.rows == 5000


def test_bucketed_joins_by_brute_force(spark, tmp_dir):
    from clickweave.sinks import bucketed as b

    t = spark.range(200).selectExpr("IF(id % 10 = 3, NULL, id) AS k", "id AS a", "concat('s', id) AS computed_session_id")
    u = spark.range(150, 260).selectExpr("id AS k", "-id AS a", "1 AS extra")
    names = [f"t_bucket_{os.path.basename(tmp_dir).replace('-', '_')}_{i}" for i in range(2)]
    left, right = (b.write_bucketed(df, n, "k", 4, os.path.join(tmp_dir, n)) for df, n in zip((t, u), names, strict=True))
    assert sorted(r[0] for r in b.unmatched(left, right, "k").select("k").collect()) == [i for i in range(150) if i % 10 != 3]
    got = {(r["k"], r["a"], r["extra"]) for r in b.merged(left, right, "k").collect()}
    assert got == {(None if i % 10 == 3 else i, i, None) for i in range(200) if i < 150 or i % 10 == 3} | {(i, -i, 1) for i in range(150, 260)}
    assert b.attach(right, left, "k").where("computed_session_id IS NULL").count() == 60 + 5
    b.drop_bucketed(spark, *names)
    assert not spark.catalog.tableExists(names[0])


def test_upsert_rewrites_only_files_with_updated_keys(spark, tmp_dir):
    from clickweave.sinks import tables

    path = os.path.join(tmp_dir, "t")
    rows = spark.range(400).selectExpr("IF(id = 7, NULL, id) AS k", "id AS v", "id % 2 AS d")
    rows.repartitionByRange(8, "v").write.partitionBy("d").parquet(path)  # eight files a day, by key
    files = lambda: {r[0] for r in spark.read.parquet(path).select(F.col("_metadata.file_path")).distinct().collect()}
    before = files()
    upd = spark.createDataFrame([(10, -1, 0), (11, -2, 1), (None, -3, 1), (900, -4, 0)], "k bigint, v bigint, d bigint").withColumn("extra", F.lit("x"))
    assert tables.upsert_files(spark, path, upd, "k", ["d"]) == 2
    assert len(before & files()) == len(before) - 2
    want = {(i, i, i % 2, None) for i in range(400) if i not in (7, 10, 11)} | {(10, -1, 0, "x"), (11, -2, 1, "x"), (None, -3, 1, "x"), (900, -4, 0, "x")}
    got = lambda: sorted(map(repr, map(tuple, spark.read.option("mergeSchema", "true").parquet(path).select("k", "v", "d", "extra").collect())))
    assert got() == sorted(map(repr, want))
    tables.upsert_files(spark, path, upd, "k", ["d"])
    assert got() == sorted(map(repr, want))
    # a run that stopped after it had appended: its rows are there twice, until it runs again
    hit = spark.read.option("mergeSchema", "true").parquet(path).where("k IN (10, 900)")
    hit.write.mode("append").partitionBy("d").parquet(path)
    tables.upsert_files(spark, path, upd, "k", ["d"])
    assert got() == sorted(map(repr, want))


def test_running_state_is_one_value_read_and_written_once_a_batch():
    import pandas as pd

    class Handle:
        value, calls, timers = None, 0, set()

        def getValueState(self, name, schema, ttl=None):
            return self

        def get(self):
            self.calls += 1
            return self.value

        def update(self, value):
            self.calls += 1
            self.value = value

        def registerTimer(self, at):
            self.timers.add(at)

        def deleteTimer(self, at):
            self.timers.remove(at)

    class Clock:
        now = 0

        def getCurrentProcessingTimeInMs(self):
            self.now += 1
            return self.now

    handle, clock = Handle(), Clock()
    machine = stateful._processor(1800, 10**12, 5, None)
    machine.init(handle)
    batch = lambda ids: iter([pd.DataFrame({"event_us": [1_000_000 * (i % 97) for i in ids], "event_order": list(ids)})])
    for k in range(4):
        assert list(machine.handleInputRows((7,), batch(range(500 * k, 500 * k + 500)), clock)) == []
    assert handle.calls == 8 and handle.timers == {9}  # 4 + idle
    (out,) = machine.handleExpiredTimer((7,), clock, None)
    assert len(out) == 2000 and out["event_seq"].tolist() == list(range(1, 2001)) and not out["late"].any()
    assert list(zip(out["event_us"], out["event_order"])) == sorted((1_000_000 * (i % 97), i) for i in range(2000))
    (out,) = machine.handleInputRows((7,), batch([0]), clock)
    assert out["late"].tolist() == [True] and out[["session_index", "idle_seconds", "session_flag", "event_seq"]].isna().all(axis=None)


def test_a_stream_that_works_is_waited_for(spark, tmp_dir):
    spark.range(3).write.mode("overwrite").parquet(tmp_dir)

    class Query:
        looks = stopped = 0

        @property
        def status(self):
            self.looks += 1
            if self.looks == 3:
                spark.range(2).write.mode("append").parquet(tmp_dir)
            return {"isTriggerActive": True}

        def exception(self):
            return None

        def stop(self):
            self.stopped += 1

    query = Query()
    stateful.run_out(query, spark, [tmp_dir], 5, wait_seconds=0.5)
    assert query.stopped == 1

    class Idle(Query):
        status = {"isTriggerActive": False}

    with pytest.raises(RuntimeError):
        stateful.run_out(Idle(), spark, [tmp_dir], 6, wait_seconds=0.5)
