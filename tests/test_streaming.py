"""A Parquet-file stream of staged events gives the same sessions as the batch sessionizer
on whole-second data, and closed sessions are scored into an append-only sink."""

import os

from pyspark.sql import functions as F

from clickweave.operators import ml
from clickweave.operators.metrics import session_metrics
from clickweave.operators.sessions import sessionize
from clickweave.plans import medallion as m
from clickweave.streaming.sessions import session_window_metrics, start_scoring_stream

from testdata import SF_SMALL

KEY = ["user_id", "session_start", "total_events", "purchase_count", "distinct_products"]


def _whole_second_events(spark):
    st = m.staged(spark, SF_SMALL)
    return st.withColumn(
        "event_timestamp", F.date_format("event_timestamp", "yyyy-MM-dd HH:mm:ss").cast("timestamp_ntz")
    )


def _write_source(spark, df, path):
    """Events plus one sentinel event 30 days after the last, which moves the watermark past
    every real session so all of them are emitted in append mode."""
    last = df.select(F.max("event_timestamp")).scalar()
    sentinel = df.limit(1).withColumn("event_timestamp", last)
    sentinel = sentinel.select(
        *[
            (F.lit(-1).cast("bigint").alias(c) if c == "user_id"
             else (F.col(c) + F.expr("INTERVAL 30 DAYS")).alias(c) if c == "event_timestamp" else F.col(c))
            for c in df.columns
        ]
    )
    sentinel = sentinel.select(*df.columns)
    df.unionByName(sentinel).write.mode("overwrite").parquet(path)


def test_stream_sessions_equal_batch(spark, tmp_dir):
    ev = _whole_second_events(spark)
    src = os.path.join(tmp_dir, "src")
    _write_source(spark, ev, src)
    stream = spark.readStream.schema(spark.read.parquet(src).schema).parquet(src)
    q = (
        session_window_metrics(stream, "30 minutes", watermark="1 hour")
        .writeStream.format("memory").queryName("t1_sessions").outputMode("append")
        .option("checkpointLocation", os.path.join(tmp_dir, "ckpt"))
        .trigger(availableNow=True).start()
    )
    q.awaitTermination(300)
    got = spark.table("t1_sessions").filter(F.col("user_id") != -1).select(*KEY)
    expected = session_metrics(sessionize(ev, 1800)).select(*KEY)
    assert got.count() == expected.count() > 0
    assert got.exceptAll(expected).count() == 0 and expected.exceptAll(got).count() == 0


def test_scoring_stream_appends_scored_sessions(spark, tmp_dir):
    ev = _whole_second_events(spark)
    train = ml.prepare(session_metrics(sessionize(ev, 1800)))
    model = ml.fit(ml.build_gbt(max_iter=3, max_depth=3), train)
    src = os.path.join(tmp_dir, "src2")
    _write_source(spark, ev, src)
    stream = spark.readStream.schema(spark.read.parquet(src).schema).parquet(src)
    sink = os.path.join(tmp_dir, "scored")
    q = start_scoring_stream(stream, model, sink, os.path.join(tmp_dir, "ckpt2"), watermark="1 hour", available_now=True)
    q.awaitTermination(300)
    out = spark.read.parquet(sink)
    assert out.count() == train.count()
    assert out.filter((F.col("score") < 0) | (F.col("score") > 1)).count() == 0


def test_watermark_drops_late_events(spark, tmp_dir):
    """An event older than the watermark (max event time - delay) in a later micro-batch is
    dropped; the on-time session is emitted once."""
    import datetime as dt

    schema = "src_event_id long, user_id long, event_timestamp timestamp_ntz, event_type string, product_id int, category_code string, price double"
    t0 = dt.datetime(2024, 1, 1)
    src = os.path.join(tmp_dir, "wm")
    batch1 = [(1, 1, t0, "view", 1, "a", 1.0), (2, 9, t0 + dt.timedelta(days=1), "view", 1, "a", 1.0)]
    batch2 = [(3, 1, t0 + dt.timedelta(minutes=5), "view", 2, "a", 1.0)]  # 1 day behind the watermark
    spark.createDataFrame(batch1, schema).coalesce(1).write.mode("append").parquet(src)
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(src)
    q = (
        session_window_metrics(stream, "30 minutes", watermark="1 hour")
        .writeStream.format("memory").queryName("wm_sessions").outputMode("append")
        .option("checkpointLocation", os.path.join(tmp_dir, "wm_ckpt")).start()
    )
    q.processAllAvailable()
    spark.createDataFrame(batch2, schema).write.mode("append").parquet(src)
    q.processAllAvailable()
    q.stop()
    rows = spark.table("wm_sessions").filter("user_id = 1").collect()
    assert [(r.total_events, r.distinct_products) for r in rows] == [(1, 1)]


def test_restart_from_checkpoint_is_exactly_once(spark, tmp_dir):
    """Stop after the first files, add more, restart on the same checkpoint: the sink holds the
    same sessions as one uninterrupted run, none twice (file-source offsets + state + sink log)."""
    ev = _whole_second_events(spark)
    train = ml.prepare(session_metrics(sessionize(ev, 1800)))
    model = ml.fit(ml.build_gbt(max_iter=2, max_depth=2), train)
    cut = ev.select(F.expr("percentile_approx(unix_timestamp(event_timestamp), 0.5)")).first()[0]
    early = ev.filter(F.unix_timestamp("event_timestamp") < cut)
    late = ev.filter(F.unix_timestamp("event_timestamp") >= cut)

    src, sink, ckpt = (os.path.join(tmp_dir, n) for n in ("rs_src", "rs_sink", "rs_ckpt"))
    early.write.mode("append").parquet(src)
    schema = spark.read.parquet(src).schema
    q = start_scoring_stream(spark.readStream.schema(schema).parquet(src), model, sink, ckpt, watermark="1 hour", available_now=True)
    q.awaitTermination(300)
    _write_source(spark, late, os.path.join(src, "more"))
    q = start_scoring_stream(
        spark.readStream.schema(schema).option("recursiveFileLookup", "true").parquet(src), model, sink, ckpt,
        watermark="1 hour", available_now=True,
    )
    q.awaitTermination(300)
    out = spark.read.parquet(sink).filter("user_id != -1")
    assert out.groupBy("stream_session_id").count().filter("count > 1").count() == 0
    expected = session_metrics(sessionize(ev, 1800)).count()
    assert out.count() == expected
