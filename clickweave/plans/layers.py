"""Silver and gold layer jobs (E2/E3): full build and incremental refresh of the Parquet tables.

Layout under ``root``: ``silver`` (by event_year/event_month, K9), ``fct_events`` (by event_date,
K7 clustered on event_type), ``mart_ml_features`` (by data_partition, clustered on is_purchased),
``dim_users``, ``dim_products``, ``session_state`` (one row per user, H1) and ``run_log`` (a row of
counts per run: events in, repeated, without user or time). Gold always reads *written* data.

Events are deduplicated by their content key before sessions are built (P16).

A refresh costs in proportion to the new batch, not to the history:

* the batch is sessionized against the stored per-user state (H1);
* features are recomputed only for sessions the batch touched, reading silver only from the
  earliest start of a session the batch may continue (partition-pruned on year/month);
* dimensions and state are merged algebraically with the batch's own aggregates;
* a user with late events (older than their stored last event) is recomputed from the session
  before the earliest of them: earlier months and their files stay as they are;
* re-delivered events are recognised by ``event_id`` and change nothing.

A refresh is safe to repeat at any point. It first computes everything it will write into a log
folder under ``root``, marks the log ready, then applies it by steps that may run twice (partition
swaps, whole-table replacements, an append that skips events already there), and deletes the log. A
refresh that finds a ready log finishes it first; an unfinished log is discarded.
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickweave.functions.columns import epoch_seconds, wall_clock_literal
from clickweave.operators import quality as q
from clickweave.operators.incremental import latest_per_key
from clickweave.operators.metrics import feature_store, session_metrics
from clickweave.operators.sessions import (
    advance_state,
    session_state,
    sessionize,
    split_late,
    unsessionizable,
    with_year_month,
)
from clickweave.operators.staging import stage_events
from clickweave.operators.star import dim_products, dim_users, fact_events, merge_dim_products, merge_dim_users
from clickweave.session import hadoop_path, release
from clickweave.sinks import tables
from clickweave.sources.schema import ACCEPTED_EVENT_TYPES

SILVER_PARTITIONS = ("event_year", "event_month")
FCT_LAYOUT = {"partition_cols": ["event_date"], "cluster_cols": ["event_type"]}
MART_LAYOUT = {"partition_cols": ["data_partition"], "cluster_cols": ["is_purchased"]}
FCT_RULES = {
    "not_null": ("event_id", "event_timestamp", "user_id", "computed_session_id"),
    "accepted_values": {"event_type": ACCEPTED_EVENT_TYPES},
}
MART_RULES = {"not_null": ("computed_session_id", "is_purchased"), "min_value": {"session_duration_sec": 0}}
_LOG, _READY = "_refresh", "_READY"


def paths(root: str) -> dict[str, str]:
    names = ("silver", "fct_events", "mart_ml_features", "dim_users", "dim_products", "session_state", "run_log")
    return {n: os.path.join(root, n) for n in names}


def staged_events(spark: SparkSession, bronze: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(events, counts): the batch's events, one row per ``event_id`` (P16), staged; and one row of
    counts: ``rows_in``, ``repeated``, ``unsessionizable`` (no user or time, D10). Each event carries
    how many copies it had into the staged table, so the batch itself is read and staged once."""
    staged = tables.stage(spark, latest_per_key(stage_events(bronze), ["event_id"], copies="_copies"), "staged-events")
    events = staged.drop("_copies")
    events._scratch = staged._scratch  # for ``release``
    left_out = unsessionizable(events).first()["unsessionizable_rows"]
    rows, kept = staged.agg(F.coalesce(F.sum("_copies"), F.lit(0)), F.count(F.lit(1))).first()
    counts = spark.createDataFrame([(rows, rows - kept, left_out)], "rows_in bigint, repeated bigint, unsessionizable bigint")
    return events, counts


def _log_run(counts: DataFrame, kind: str, path: str) -> None:
    counts.select(F.lit(kind).alias("kind"), F.current_timestamp().alias("at"), "*").coalesce(1).write.mode("append").parquet(path)


def build_layers(spark: SparkSession, bronze: DataFrame, root: str, *, timeout_seconds: int = 1800) -> DataFrame:
    """Full build from a bronze DataFrame: every table is replaced as a whole. Returns the data-test
    summary over the written tables; the counts of repeated and left-out rows are in ``run_log``."""
    p = paths(root)
    _discard(spark, os.path.join(root, _LOG))
    events, counts = staged_events(spark, bronze)
    tables.write_silver(sessionize(events, timeout_seconds), p["silver"], dealt=True)
    silver = spark.read.parquet(p["silver"])
    watched = q.WriteChecks("fct_events", **FCT_RULES), q.WriteChecks("mart_ml_features", **MART_RULES)
    tables.write_clustered(fact_events(silver), p["fct_events"], **FCT_LAYOUT, checks=watched[0])
    tables.write_clustered(feature_store(session_metrics(silver)), p["mart_ml_features"], **MART_LAYOUT, checks=watched[1])
    dim_users(silver).write.mode("overwrite").parquet(p["dim_users"])
    dim_products(silver, with_order_key=True).write.mode("overwrite").parquet(p["dim_products"])
    session_state(silver).write.mode("overwrite").parquet(p["session_state"])
    _log_run(counts, "build", p["run_log"])
    release(spark, events)
    return data_tests(spark, root, row_rules=[w.summary() for w in watched])


def _month() -> F.Column:
    return F.col("event_year") * 100 + F.col("event_month")


def _month_number(bound: str) -> int:
    return int(bound[:4]) * 100 + int(bound[5:7])


def _from_month(ts_col: str, bound: str) -> F.Column:
    """Rows at or after ``bound`` (ISO text), with the month partitions pruned."""
    return (_month() >= _month_number(bound)) & (F.col(ts_col) >= wall_clock_literal(bound))


def _least(df: DataFrame, column: F.Column) -> str | None:
    return df.agg(F.min(column).cast("string").alias("b")).first()["b"]


def _discard(spark: SparkSession, path: str) -> None:
    fs, hpath = hadoop_path(spark, path)
    fs.delete(hpath, True)


class _Log:
    """The folder a refresh writes its results to before it touches the tables."""

    def __init__(self, spark: SparkSession, root: str, run: str):
        self.spark, self.root, self.path = spark, root, os.path.join(root, _LOG, run)

    def put(self, name: str, df: DataFrame) -> DataFrame:
        path = os.path.join(self.path, name)
        df.write.mode("overwrite").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def get(self, name: str) -> DataFrame:
        return self.spark.read.parquet(os.path.join(self.path, name))

    def mark_ready(self) -> None:
        fs, mark = hadoop_path(self.spark, os.path.join(self.path, _READY))
        fs.create(mark, True).close()

    def is_ready(self) -> bool:
        fs, mark = hadoop_path(self.spark, os.path.join(self.path, _READY))
        return fs.exists(mark)

    def apply(self, *, again: bool = False) -> None:
        """Bring the tables to the logged results; may run any number of times."""
        spark, p = self.spark, paths(self.root)
        tables.swap_partitions(self.get("silver_swap"), p["silver"], SILVER_PARTITIONS, self.get("silver_touched"))
        add = self.get("silver_add")
        if again:
            low = _least(add, F.col("event_timestamp"))
            if low is not None:
                held = spark.read.parquet(p["silver"]).filter(_from_month("event_timestamp", low))
                add = add.join(held.select("event_id"), "event_id", "left_anti")
        add.write.mode("append").partitionBy(*SILVER_PARTITIONS).parquet(p["silver"])
        for name, layout in (("fct_events", FCT_LAYOUT), ("mart_ml_features", MART_LAYOUT)):
            tables.swap_partitions(
                self.get(name), p[name], layout["partition_cols"], self.get(f"{name}_touched"), cluster_cols=layout["cluster_cols"]
            )
        for name in ("dim_users", "dim_products", "session_state"):
            self.get(name).write.mode("overwrite").parquet(p[name])
        _log_run(self.get("counts"), "refresh", p["run_log"])
        _discard(spark, self.path)


def recover(spark: SparkSession, root: str) -> int:
    """Finish refreshes that were interrupted while applying, discard those that had not got so far;
    returns how many were finished."""
    fs, folder = hadoop_path(spark, os.path.join(root, _LOG))
    done = 0
    if fs.exists(folder):
        for status in fs.listStatus(folder):
            log = _Log(spark, root, status.getPath().getName())
            if log.is_ready():
                log.apply(again=True)
                done += 1
            else:
                _discard(spark, log.path)
    return done


def refresh_layers(spark: SparkSession, new_bronze: DataFrame, root: str, *, timeout_seconds: int = 1800) -> DataFrame:
    """Incremental refresh with a new bronze batch; returns the late events that forced a user
    recompute (events at or before their user's stored last event that silver did not hold yet).

    * users without new late events: the batch continues their stored state (H1), silver gets
      an append, gold an upsert or algebraic merge;
    * users with new late events: recomputed from the session before the earliest of them; their
      silver rows from there on are rewritten in the months these occupy, their gold rows
      replaced. Re-delivered events (already in silver) are recognised by ``event_id``.

    May be repeated after a failure at any point (see the module's text).
    """
    recover(spark, root)
    p = paths(root)
    log = _Log(spark, root, uuid.uuid4().hex[:12])
    late_new = _compute(spark, new_bronze, p, log, timeout_seconds)
    log.mark_ready()
    log.apply()
    return late_new


def _redo_points(late_new: DataFrame, mart: DataFrame, timeout_seconds: int) -> DataFrame:
    """One row per user with late events: ``redo_from`` and the state before it. If the last stored
    session that began at or before the earliest late event ended longer than the timeout before
    it, the redo starts with that event; else with that session's start; without one, with the
    event."""
    first = late_new.groupBy("user_id").agg(F.min("event_timestamp").alias("late_ts"))
    index = F.substring_index("computed_session_id", "_", -1).cast("bigint")
    earlier = mart.select("user_id", "session_start", "session_end", index.alias("index")).join(first, "user_id")
    earlier = earlier.filter(F.col("session_start") <= F.col("late_ts"))
    point = earlier.groupBy("user_id").agg(F.max(F.struct("index", "session_start", "session_end")).alias("s"))
    ends = earlier.select("user_id", F.col("index").alias("last"), "session_end")
    before = point.join(ends, ["user_id"], "left").groupBy("user_id", "s").agg(
        F.max(F.when(F.col("last") == F.col("s.index") - 1, F.col("session_end"))).alias("end_before")
    )
    apart = epoch_seconds("late_ts") - epoch_seconds("s.session_end") > timeout_seconds
    return first.join(before, "user_id", "left").select(
        "user_id",
        F.when(apart, F.col("late_ts")).otherwise(F.coalesce("s.session_start", "late_ts")).alias("redo_from"),
        F.when(apart, F.col("s.session_end")).otherwise(F.col("end_before")).alias("last_event_timestamp"),
        F.coalesce(F.when(apart, F.col("s.index")).otherwise(F.col("s.index") - 1), F.lit(0)).alias("last_session_index"),
        F.lit(0).cast("bigint").alias("last_session_events"),
    )


def _compute(spark: SparkSession, new_bronze: DataFrame, p: dict[str, str], log: _Log, timeout_seconds: int) -> DataFrame:
    """Everything the refresh will write, into ``log``; returns the late events (staged)."""
    events, counts = staged_events(spark, new_bronze)
    log.put("counts", counts)
    state = spark.read.parquet(p["session_state"])
    stored, mart = spark.read.parquet(p["silver"]), spark.read.parquet(p["mart_ml_features"])
    silver_cols = [c for c in stored.columns if c not in SILVER_PARTITIONS]
    event_cols = events.columns
    in_silver = [*silver_cols, *SILVER_PARTITIONS]

    # Late events silver does not hold yet (lookup bounded to the months from the earliest one).
    fresh, late = split_late(events, state, timeout_seconds=timeout_seconds)
    low = _least(late, F.col("event_timestamp"))
    if low is not None:
        known = stored.filter(_from_month("event_timestamp", low)).select("event_id")
        late = late.join(known, "event_id", "left_anti")
    late_new = tables.stage(spark, late, "late-new")
    redo_at = tables.stage(spark, _redo_points(late_new, mart, timeout_seconds), "redo-points")

    normal = fresh.join(redo_at.select("user_id"), "user_id", "left_anti")
    add = sessionize(normal, timeout_seconds, state=state).select(*silver_cols)
    add = log.put("silver_add", with_year_month(add).select(*in_silver))

    # Users with late events, from their redo point on.
    tail = stored.limit(0)
    low = _least(redo_at, F.col("redo_from"))
    if low is not None:
        tail = stored.filter(_from_month("event_timestamp", low))
    points = redo_at.select("user_id", "redo_from")
    old_tail = tail.join(points, "user_id").filter(F.col("event_timestamp") >= F.col("redo_from"))
    batch_redo = tables.stage(
        spark, fresh.join(points, "user_id", "left_semi").unionByName(late_new), "late-users-batch"
    )
    redo_events = old_tail.select(*event_cols).unionByName(batch_redo)
    redo = sessionize(redo_events, timeout_seconds, state=redo_at).select(*silver_cols)
    redo = tables.stage(spark, with_year_month(redo).select(*in_silver), "redo-silver")
    months = redo.select(*SILVER_PARTITIONS).distinct()
    gone = (F.col("s.user_id") == F.col("r.user_id")) & (F.col("s.event_timestamp") >= F.col("r.redo_from"))
    whole = stored if low is None else stored.filter(_month() >= _month_number(low))  # months that may be rewritten
    kept = whole.join(F.broadcast(months), list(SILVER_PARTITIONS), "left_semi").alias("s").join(points.alias("r"), gone, "left_anti")
    log.put("silver_swap", kept.select(*in_silver).unionByName(redo))
    log.put("silver_touched", months)

    changed = fact_events(add).unionByName(fact_events(redo))
    changed = tables.stage(spark, changed, "changed-facts")
    fct = tables.merged_partitions(spark, p["fct_events"], changed, ["event_id"], ["event_date"])
    log.put("fct_events", fct)
    log.put("fct_events_touched", changed.select("event_date").distinct())

    # Features of the sessions the batch touched: silver from the earliest session it may continue.
    reach = add.select("user_id", "event_timestamp").join(state.select("user_id", "last_session_start"), "user_id", "left")
    low = _least(reach, F.least("last_session_start", "event_timestamp"))
    scope = add
    if low is not None:
        ids = add.select("computed_session_id").distinct()
        scope = stored.filter(_from_month("event_timestamp", low)).join(ids, "computed_session_id", "left_semi")
        scope = scope.select(*in_silver).unionByName(add)
    feats = feature_store(session_metrics(scope)).unionByName(feature_store(session_metrics(redo)))
    feats = tables.stage(spark, feats, "new-features")
    replaced = mart.alias("f").join(
        points.alias("r"), (F.col("f.user_id") == F.col("r.user_id")) & (F.col("f.session_start") >= F.col("r.redo_from")), "left_semi"
    )
    touched = feats.select("data_partition").unionByName(replaced.select("data_partition")).distinct()
    touched = log.put("mart_ml_features_touched", touched)
    rest = mart.join(F.broadcast(touched), "data_partition", "left_semi").alias("f")
    rest = rest.join(
        points.alias("r"), (F.col("f.user_id") == F.col("r.user_id")) & (F.col("f.session_start") >= F.col("r.redo_from")), "left_anti"
    )
    rest = rest.join(feats.select("computed_session_id"), "computed_session_id", "left_anti")
    log.put("mart_ml_features", rest.select(*feats.columns).unionByName(feats))

    # Dimensions and state: merged with the batch's own rows only.
    new_rows = add.select(*event_cols).unionByName(batch_redo.select(*event_cols))
    sessions = redo.groupBy("user_id").agg(F.max("session_index").alias("_sessions"))
    batch_users = batch_redo.withColumn("session_index", F.lit(0).cast("bigint"))
    users = merge_dim_users(spark.read.parquet(p["dim_users"]), dim_users(add).unionByName(dim_users(batch_users)))
    users = users.join(sessions, "user_id", "left").withColumn("total_sessions", F.coalesce("_sessions", "total_sessions"))
    log.put("dim_users", users.drop("_sessions"))
    products = merge_dim_products(spark.read.parquet(p["dim_products"]), dim_products(new_rows, with_order_key=True))
    log.put("dim_products", products)
    new_state = advance_state(state, add).join(points, "user_id", "left_anti")
    log.put("session_state", new_state.unionByName(session_state(redo)))
    release(spark, events, redo_at, batch_redo, redo, changed, feats)
    return late_new


def data_tests(spark: SparkSession, root: str, *, row_rules: list[DataFrame] | None = None) -> DataFrame:
    """Q1-Q5 over the written gold tables. ``row_rules``: the summaries of the row-level rules where the
    write has counted them; else the tables are scanned for them."""
    p = paths(root)
    fct = spark.read.parquet(p["fct_events"])
    feats = spark.read.parquet(p["mart_ml_features"])
    if row_rules is None:
        row_rules = [q.check_table(fct, "fct_events", **FCT_RULES), q.check_table(feats, "mart_ml_features", **MART_RULES)]
    return q.run_checks(
        [
            q.check_unique(fct, "event_id", "fct_events"),
            q.check_relationship(fct, feats, "computed_session_id", "fct_events"),
            q.check_unique(feats, "computed_session_id", "mart_ml_features"),
            *row_rules,
        ]
    )
