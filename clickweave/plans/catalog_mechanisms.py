"""Queries of the streaming, sketch and drift operators, registered beside those of ``catalog``."""

from __future__ import annotations

from pyspark.sql import functions as F

from clickweave.plans import medallion as m
from clickweave.plans import oracle as o
from clickweave.plans import catalog as c
from clickweave.plans.catalog import _BRONZE_COLS, _SILVER_COLS, _SILVER_SQL_COLS, ORACLE, query

_LOADS = ("2024-01-11", "2024-01-21")
_LOAD_SQL = "TIMESTAMP '{}'"


def _in_load(k: int, ts: str = "event_timestamp"):
    """Rows of load ``k`` of three, by event time (rows without a time are in the first)."""
    at = F.lit(_LOADS[min(k, 1)]).cast("timestamp_ntz")
    before = F.coalesce(F.col(ts) < at, F.lit(True))
    return before if k == 0 else ~before if k == 2 else ~_in_load(0, ts) & ~_in_load(2, ts)


def _scratch(spark, *names):
    from clickweave.session import scratch_path

    return [scratch_path(spark, n) for n in names]


# ---------------------------------------------------------------------------------------------
# T1 with W4's running session ids; late events


def _stateful(spark, src, schema, **options):
    """(stream, session): a stream of the files under ``src`` in a session of its own, which names the state
    store that stateful variables need."""
    from clickweave.streaming.stateful import STORE

    own = spark.newSession()
    own.conf.set(*STORE)
    reader = own.readStream.schema(schema)
    for k, v in options.items():
        reader = reader.option(k, v)
    return reader.parquet(src), own


@query("t1_running_sessions", o.silver_chain(1800) + f"SELECT {_SILVER_SQL_COLS.replace('event_type, ', '')}, event_seq FROM silver")
def t1_running_sessions(spark, sf_dir):
    """Three loads of staged events stream, some files a micro-batch, through the stateful sessionizer: what
    comes out, timers included, is the batch W4 (no event is late, since a load's files come together)."""
    from clickweave.streaming.stateful import run_out, start_running_sessions

    src, sink, late, ckpt = _scratch(spark, "stream-src", "stream-sink", "stream-late", "stream-ckpt")
    events = m.staged(spark, sf_dir).where("user_id IS NOT NULL AND event_timestamp IS NOT NULL")
    for k in range(3):
        events.where(_in_load(k)).write.mode("append").parquet(src)
    stored = spark.read.parquet(src)
    stream, own = _stateful(spark, src, stored.schema, maxFilesPerTrigger=8)
    run = start_running_sessions(stream, sink, late, ckpt, lateness_seconds=11 * 86400, idle_seconds=5)
    run_out(run, own, [sink, late], stored.count())
    return spark.read.parquet(sink).select(*[c for c in _SILVER_COLS if c != "event_type"], "event_seq")


@query(
    "t1_late_events",
    o.with_(o.CLICK, o.STG)
    + f"""SELECT a.user_id, a.src_event_id, a.event_timestamp FROM stg a
WHERE a.event_timestamp < TIMESTAMP '{_LOADS[1]}'
  AND a.user_id IN (SELECT user_id FROM stg WHERE event_timestamp >= TIMESTAMP '{_LOADS[1]}')""",
)
def t1_late_events(spark, sf_dir):
    """The last load comes first and is given out; whatever of its users arrives afterwards, with the earlier
    loads, is late: it is in the late table, not lost."""
    from clickweave.streaming.stateful import run_out, start_running_sessions

    src, sink, late, ckpt = _scratch(spark, "stream-src", "stream-sink", "stream-late", "stream-ckpt")
    events = m.staged(spark, sf_dir).where("user_id IS NOT NULL AND event_timestamp IS NOT NULL")
    for part in (events.where(_in_load(2)), events.where(~_in_load(2))):
        part.write.mode("append").parquet(src)
        stored = spark.read.parquet(src)
        stream, own = _stateful(spark, src, stored.schema)
        run_out(start_running_sessions(stream, sink, late, ckpt, idle_seconds=2), own, [sink, late], stored.count())
    return spark.read.parquet(late).select("user_id", "src_event_id", "event_timestamp")


# ---------------------------------------------------------------------------------------------
# Files ingested as they arrive


@query("s1_stream_ingest", ORACLE["s1_csv_ingest"])
def s1_stream_ingest(spark, sf_dir):
    """Raw CSV files added in three runs, each taken by a run of the ingest stream; then everything is replayed
    with a fresh checkpoint. The table equals the one-shot ingest of all files."""
    from clickweave.sources.driver_events import write_raw_csv
    from clickweave.streaming.ingest import start_ingest

    folder, table, dlq, ckpt, fresh = _scratch(spark, "raw-csv", "bronze", "quarantine", "ingest-ckpt", "ingest-ckpt")
    clicks = m.clicks(spark, sf_dir)
    for k in range(3):
        write_raw_csv(clicks.where(_in_load(k)), f"{folder}/run-{k}")
        start_ingest(spark, folder, table, ckpt, dlq_dir=dlq).awaitTermination()
    start_ingest(spark, folder, table, fresh, dlq_dir=dlq).awaitTermination()
    return spark.read.parquet(table).select(*_BRONZE_COLS)


# ---------------------------------------------------------------------------------------------
# P16 on a stream


@query("p16_stream_dedup", ORACLE["p16_dedup"])
def p16_stream_dedup(spark, sf_dir):
    """Clicks with repeated rows in three loads; the second and third load deliver some rows of the load before
    once more, and the stream is restarted between them."""
    from clickweave.streaming.dedup import start_dedup

    src, sink, ckpt = _scratch(spark, "stream-src", "stream-sink", "stream-ckpt")
    clicks = m.clicks(spark, sf_dir, with_duplicates=True)
    for k in range(3):
        load = clicks.where(_in_load(k))
        if k:
            load = load.unionByName(clicks.where(_in_load(k - 1) & (F.col("src_event_id") % 3 == 0)))
        load.write.mode("append").parquet(src)
        stream = spark.readStream.schema(clicks.schema).parquet(src)
        start_dedup(stream, ["src_event_id"], sink, ckpt, horizon="31 days").awaitTermination()
    return spark.read.parquet(sink)


# ---------------------------------------------------------------------------------------------
# Distinct users from stored sketches; L9: quantiles and PSI from stored sketches


@query(
    "a13_distinct_sketches",
    o.silver_chain(1800, o.FCT)
    + """, periods AS (
    SELECT 'day' AS level, CAST(event_timestamp AS DATE) AS period, user_id, product_id FROM fct
    UNION ALL SELECT 'month', CAST(date_trunc('month', event_timestamp) AS DATE), user_id, product_id FROM fct)
SELECT level, period, count(*) AS n_events, count(DISTINCT user_id) AS users, count(DISTINCT product_id) AS products,
       true AS users_within, true AS products_within, true AS merge_agrees FROM periods GROUP BY level, period""",
)
def a13_distinct_sketches(spark, sf_dir):
    """Hourly sketches, kept as a table, merged into days and months, beside the exact counts: the estimates lie
    within four standard errors of these, and of a sketch made of the period in one go."""
    from clickweave.operators.sketches import hll_error, hourly_distinct, merged_distinct
    from clickweave.sinks.tables import stage

    kinds, near = ("user_id", "product_id"), 4 * hll_error()
    fct = stage(spark, m.fct(spark, sf_dir, m.TIMEOUT_SHORT).select("event_timestamp", *kinds), "fct")
    hours = stage(spark, hourly_distinct(fct, kinds), "hours")
    out = None
    for level, unit in (("day", "day"), ("month", "month")):
        period = F.to_date(F.date_trunc(unit, "event_date"))
        merged = merged_distinct(hours, {"period": period}, kinds).drop("user_id_sketch", "product_id_sketch")
        exact = fct.groupBy(F.to_date(F.date_trunc(unit, "event_timestamp")).alias("period")).agg(
            F.count_distinct("user_id").alias("users"), F.count_distinct("product_id").alias("products"),
            F.hll_sketch_estimate(F.hll_sketch_agg("user_id", 12)).alias("at_once"),
        )
        close = lambda a, b: F.abs(F.col(a) - F.col(b)) <= near * F.col(b)
        rows = merged.join(exact, "period").select(
            F.lit(level).alias("level"), "period", "n_events", "users", "products", close("n_user_id", "users").alias("users_within"),
            close("n_product_id", "products").alias("products_within"), close("n_user_id", "at_once").alias("merge_agrees"),
        )
        out = rows if out is None else out.unionByName(rows)
    return out


def _features_sql() -> str:
    from clickweave.sources.schema import FEATURE_COLUMNS

    long = "\n    UNION ALL ".join(
        f"SELECT data_split, session_start, is_purchased, '{c}' AS feature, CAST({c} AS DOUBLE) AS value FROM fs" for c in FEATURE_COLUMNS
    )
    return o.gold(43200, o.FEATURE_STORE) + f""", fs AS (
    SELECT *, CASE WHEN session_start < TIMESTAMP '{m.OOT_CUTOFF}' THEN 'train' ELSE 'oot' END AS data_split FROM features
), long AS (
    {long}
)"""


def _split_features(spark, sf_dir):
    from clickweave.operators.metrics import oot_split
    from clickweave.sinks.tables import stage

    return oot_split(stage(spark, m.features(spark, sf_dir, m.TIMEOUT_LONG), "features"), m.OOT_CUTOFF)


@query(
    "l9_quantile_sketches",
    _features_sql()
    + """SELECT feature, unnest([0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9])::DOUBLE AS q, count(value) AS n, true AS within
FROM long GROUP BY feature HAVING count(value) > 0""",
)
def l9_quantile_sketches(spark, sf_dir):
    """A sketch of every feature and day, merged over all days: the rank that a merged quantile has among the
    feature's values is off by no more than the sketch's bound."""
    from clickweave.operators.sketches import KLL_RANK_ERROR, merged_quantiles, quantile_sketches
    from clickweave.sinks.tables import stage
    from clickweave.sources.schema import FEATURE_COLUMNS

    cols = list(FEATURE_COLUMNS)
    feats = _split_features(spark, sf_dir).withColumn("day", F.to_date("session_start"))
    daily = stage(spark, quantile_sketches(feats, ["day"]), "sketches")
    ranks = [i / 10 for i in range(1, 10)]
    merged = merged_quantiles(daily).select(
        "feature", F.kll_sketch_get_n_double("sketch").alias("n"),
        F.explode(F.arrays_zip(F.array(*map(F.lit, ranks)).alias("q"), F.kll_sketch_get_quantile_double("sketch", F.array(*map(F.lit, ranks))).alias("v"))).alias("x"),
    )
    merged = stage(spark, merged.select("feature", "n", F.col("x.q").alias("q"), F.col("x.v").alias("v")), "quantiles")  # nine a feature
    long = feats.select(*[F.col(c).cast("double").alias(c) for c in cols]).unpivot([], cols, "feature", "value").where("value IS NOT NULL")
    held = long.groupBy("feature", "value").agg(F.count(F.lit(1)).alias("c")).join(F.broadcast(merged), "feature")
    place = held.groupBy("feature", "q", "n").agg(F.sum(F.when(F.col("value") < F.col("v"), F.col("c")).otherwise(0)).alias("below"), F.sum(F.when(F.col("value") <= F.col("v"), F.col("c")).otherwise(0)).alias("upto"))
    off = F.greatest(F.col("below") / F.col("n") - F.col("q"), F.col("q") - F.col("upto") / F.col("n"))
    return place.select("feature", "q", "n", (off <= KLL_RANK_ERROR).alias("within"))


# ---------------------------------------------------------------------------------------------
# Concept drift and the Kolmogorov-Smirnov distance

_RATES_SQL = """, ranges AS (SELECT feature, min(value) AS lo, max(value) AS hi FROM long GROUP BY feature
), binned AS (
    SELECT data_split, feature, is_purchased,
           CAST(CASE WHEN value IS NULL THEN -1 WHEN hi - lo <= 0 THEN 0
                     ELSE least(floor((value - lo) / (hi - lo) * 10), 9) END AS INTEGER) AS bin
    FROM long JOIN ranges USING (feature)
), counts AS (
    SELECT feature, bin, count_if(data_split = 'train') AS n_base, count_if(data_split = 'train' AND is_purchased) AS h_base,
           count_if(data_split = 'oot') AS n_cur, count_if(data_split = 'oot' AND is_purchased) AS h_cur
    FROM binned GROUP BY feature, bin
), rates AS (
    SELECT feature, bin, CAST(n_base AS BIGINT) AS n_base, CAST(n_cur AS BIGINT) AS n_cur, h_base / NULLIF(n_base, 0)::DOUBLE AS rate_base,
           h_cur / NULLIF(n_cur, 0)::DOUBLE AS rate_cur, (h_base + h_cur) / (n_base + n_cur)::DOUBLE AS p FROM counts
), shifts AS (SELECT *, rate_cur - rate_base AS shift FROM rates)
"""


@query(
    "l9_label_rates",
    _features_sql()
    + _RATES_SQL
    + """SELECT feature, bin, n_base, n_cur, round(rate_base, 6) AS rate_base, round(rate_cur, 6) AS rate_cur, round(shift, 6) AS shift,
       round(shift / NULLIF(sqrt(p * (1 - p) * (1.0 / NULLIF(n_base, 0) + 1.0 / NULLIF(n_cur, 0))), 0), 6) AS z FROM shifts""",
)
def l9_label_rates(spark, sf_dir):
    from clickweave.operators.drift import label_rates

    return label_rates(_split_features(spark, sf_dir))


@query(
    "l9_concept_drift",
    _features_sql()
    + _RATES_SQL
    + """SELECT feature, round(sum(abs(shift) * n_cur) / sum(n_cur), 6) AS rate_shift, round(max(abs(shift)), 6) AS max_shift, count(*) AS n_bins
FROM shifts WHERE shift IS NOT NULL GROUP BY feature""",
)
def l9_concept_drift(spark, sf_dir):
    from clickweave.operators.drift import concept_drift, label_rates

    return concept_drift(label_rates(_split_features(spark, sf_dir)))


@query(
    "l9_ks_distance",
    _features_sql()
    + """, per AS (
    SELECT feature, value, count_if(data_split = 'train') AS b, count_if(data_split = 'oot') AS c FROM long WHERE value IS NOT NULL GROUP BY feature, value
), run AS (
    SELECT feature, sum(b) OVER w AS ub, sum(c) OVER w AS uc, sum(b) OVER (PARTITION BY feature) AS n_base, sum(c) OVER (PARTITION BY feature) AS n_cur
    FROM per WINDOW w AS (PARTITION BY feature ORDER BY value)
), dist AS (
    SELECT feature, CAST(n_base AS BIGINT) AS n_base, CAST(n_cur AS BIGINT) AS n_cur, max(abs(ub / n_base::DOUBLE - uc / n_cur::DOUBLE)) AS ks
    FROM run GROUP BY feature, n_base, n_cur
), crit AS (SELECT *, sqrt(-ln(0.025) / 2) * sqrt((n_base + n_cur) / (n_base * n_cur)::DOUBLE) AS critical FROM dist)
SELECT feature, round(ks, 9) AS ks, n_base, n_cur, round(critical, 9) AS critical, ks > critical AS drifted FROM crit""",
)
def l9_ks_distance(spark, sf_dir):
    from clickweave.operators.drift import ks_distance

    return ks_distance(_split_features(spark, sf_dir))


# ---------------------------------------------------------------------------------------------
# J1, J3, J4 over bucketed tables; Q2, Q3, Q5 counted by the write itself

BUCKETS = 8


def _bucketed(spark, df, key):
    import uuid

    from clickweave.sinks.bucketed import write_bucketed

    (path,) = _scratch(spark, "bucketed")
    return write_bucketed(df, f"bucketed_{uuid.uuid4().hex[:12]}", key, BUCKETS, path)


@query("j1_bucketed_attach", ORACLE["j1_attach_sessions"])
def j1_bucketed_attach(spark, sf_dir):
    """J1 between staged events and silver, both written bucketed by event id: no exchange."""
    from clickweave.sinks.bucketed import attach

    staged = _bucketed(spark, m.staged(spark, sf_dir), "event_id")
    return attach(staged, _bucketed(spark, m.silver(spark, sf_dir, m.TIMEOUT_SHORT, with_sequence=False), "event_id"))


@query(
    "j3_bucketed_orphans",
    o.gold(1800, o.FCT)
    + """SELECT f.event_id, f.computed_session_id FROM fct f
WHERE NOT EXISTS (SELECT 1 FROM metrics s WHERE s.computed_session_id = f.computed_session_id AND s.total_events > 1)""",
)
def j3_bucketed_orphans(spark, sf_dir):
    """J3 between events and the sessions of more than one event, both bucketed by session: the events whose
    session is not among them."""
    from clickweave.operators.metrics import session_metrics
    from clickweave.operators.star import fact_events
    from clickweave.sinks.bucketed import unmatched

    silver = m.silver_table(spark, sf_dir)
    fct = _bucketed(spark, fact_events(silver), "computed_session_id")
    long = _bucketed(spark, session_metrics(silver).where("total_events > 1"), "computed_session_id")
    return unmatched(fct, long, "computed_session_id").select("event_id", "computed_session_id")


@query("k4_bucketed_upsert", ORACLE["k4_upsert"])
def k4_bucketed_upsert(spark, sf_dir):
    from clickweave.sinks.bucketed import merged

    _, target, updates = c._loads(spark, sf_dir)
    return merged(_bucketed(spark, target, "event_id"), _bucketed(spark, updates, "event_id"), "event_id")


@query(
    "q2_write_checks",
    c._checks_sql(
        c._not_null_sql("fct_events", c._FCT_NOT_NULL, "fct"),
        c._Q3_SUMMARY_SQL.split("UNION ALL ")[1],
        c._not_null_sql("mart_ml_features", c._FEAT_NOT_NULL, "features"),
        c._Q5_SQL,
    ),
)
def q2_write_checks(spark, sf_dir):
    """The row-level data tests of facts and features, counted while the tables are written."""
    from clickweave.operators import quality as q
    from clickweave.operators.metrics import feature_store, session_metrics
    from clickweave.operators.star import fact_events
    from clickweave.plans.layers import FCT_LAYOUT, FCT_RULES, MART_LAYOUT, MART_RULES
    from clickweave.sinks.tables import write_clustered

    silver, out = m.silver_table(spark, sf_dir), []
    for name, df, layout, rules in (
        ("fct_events", fact_events(silver), FCT_LAYOUT, FCT_RULES),
        ("mart_ml_features", feature_store(session_metrics(silver)), MART_LAYOUT, MART_RULES),
    ):
        checks = q.WriteChecks(name, **rules)
        write_clustered(df, *_scratch(spark, name), **layout, checks=checks)
        out.append(checks.summary())
    return q.run_checks(out)


@query("k4_upsert_files", ORACLE["k4_upsert_table"])
def k4_upsert_files(spark, sf_dir):
    """K4 on disk, rewriting only the files that hold an updated key; every update comes twice and is merged
    twice."""
    from clickweave.sinks.tables import upsert_files

    _, target, updates = c._loads(spark, sf_dir)
    part = F.when(F.col("src_event_id") % 5 > 0, F.to_date("event_timestamp")).alias("part")
    cols = ["event_id", "event_timestamp", "event_type", "product_id", "price", "user_id", "src_event_id"]
    (path,) = _scratch(spark, "upserted")
    updates = updates.unionByName(updates)
    upsert_files(spark, path, target.select(*cols, part), "event_id", ["part"])
    for _ in range(2):
        upsert_files(spark, path, updates.select(*cols, part), "event_id", ["part"])
    return spark.read.parquet(path).select(*cols[:-1])


# ---------------------------------------------------------------------------------------------
# A test period given as raw CSV


_RAW_CLICK = """raw_click AS (
    SELECT * REPLACE (date_trunc('second', event_timestamp) AS event_timestamp, CAST(CAST(price AS FLOAT) AS DOUBLE) AS price,
                      CAST(user_id AS INTEGER) AS user_id) FROM click
)"""
#: Raw rows have no source id: rows alike in all raw columns are one event.
_RAW_STG = """raw_stg AS (
    SELECT DISTINCT event_timestamp, lower(trim(event_type)) AS event_type, product_id, category_id, lower(trim(category_code)) AS category_code,
           lower(trim(brand)) AS brand, price, CAST(user_id AS BIGINT) AS user_id, user_session, 0 AS src_event_id
    FROM raw_click WHERE user_id IS NOT NULL AND NOT coalesce(price < 0, false)
)"""


@query(
    "s4_raw_features",
    o.with_(o.CLICK, _RAW_CLICK, _RAW_STG, o.silver(43200, "raw_stg"), o.METRICS, o.FEATURE_STORE) + o.rounded("features"),
)
def s4_raw_features(spark, sf_dir):
    """The features that an evaluation on raw CSV files scores."""
    from clickweave.plans.training import features_from_raw
    from clickweave.sources.driver_events import write_raw_csv

    (folder,) = _scratch(spark, "raw-csv")
    write_raw_csv(m.clicks(spark, sf_dir), folder)
    return features_from_raw(spark, folder, timeout_seconds=m.TIMEOUT_LONG)


@query("k11_raw_report")
def k11_raw_report(spark, sf_dir):
    """A model trained on the tables, evaluated on the later period's raw CSV files."""
    from clickweave.plans.training import evaluate_raw, train
    from clickweave.sources.driver_events import write_raw_csv

    folder, model_dir, report_dir = _scratch(spark, "raw-csv", "model", "report")
    later = F.col("event_timestamp") >= F.lit(m.OOT_CUTOFF).cast("timestamp_ntz")
    write_raw_csv(m.clicks(spark, sf_dir).where(later), folder)
    train(spark, c._oot_frames(spark, sf_dir)[0], model_dir)
    return evaluate_raw(spark, folder, model_dir, report_dir, timeout_seconds=m.TIMEOUT_LONG)
